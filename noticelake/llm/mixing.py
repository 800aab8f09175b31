"""Mixing sources to target weights by hierarchical budgeting (operator 1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticelake.llm.common import checkpoint, fresh, join_sized

#: The sources of a domain; all others are of the domain ``web``.
DOMAINS = {"reference": ["src1", "src2", "src3", "src4"], "forum": ["src5", "src6", "src7", "src8", "src9"]}
#: Weights of domains and, within each domain, of languages; a name that is not listed weighs 1. Sources weigh their tokens.
DOMAIN_WEIGHTS = {"web": 6, "reference": 3, "forum": 3}
LANGUAGE_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 2}
LEVELS = ("domain", "language", "source")
#: A range of so many documents is put in order by itself.
SMALL = 250
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r]+")), F.lit(0)).cast("long")


def _leaf(domains: dict[str, list[str]]) -> dict[str, Column]:
    domain = F.lit("web")
    for name, sources in domains.items():
        domain = F.when(F.col("source").isin(sources), name).otherwise(domain)
    return {"domain": domain, "language": F.coalesce(F.col("lang"), F.lit("")), "source": F.coalesce(F.col("source"), F.lit(""))}


def _weight(name: str, weights: dict[str, float] | None) -> Column:
    if weights is None:
        return F.col("tokens").cast("double")
    out = F.lit(1.0)
    for k, w in weights.items():
        out = F.when(F.col(name) == k, float(w)).otherwise(out)
    return out


def _share(parents: DataFrame | None, leaves: DataFrame, depth: int, weights: dict[str, float] | None, budget: Column) -> DataFrame:
    """Budgets of the nodes at a depth: in proportion to weight, no node more than it can fill; what one cannot take goes to its siblings.

    Children are taken in order of capacity per weight. Those that the rest of the budget would overfill come
    first and get their capacity, all others share what is left by weight. As a node's capacity is that of its
    leaves, a shortage leaves a subtree only when nobody in it can take more.
    """
    path = list(LEVELS[: depth + 1])
    nodes = leaves.groupBy(*path).agg(F.sum("tokens").alias("tokens"), F.sum("capacity").alias("capacity"))
    nodes = nodes.join(parents, path[:-1]) if parents is not None else nodes.withColumn("budget", budget)
    nodes = nodes.withColumn("w", _weight(path[-1], weights))
    siblings = Window.partitionBy(*path[:-1]) if depth else Window.partitionBy(F.lit(0))
    order = siblings.orderBy(F.when(F.col("w") > 0, F.col("capacity") / F.col("w")).otherwise(0.0), path[-1])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    nodes = nodes.withColumn("rest", F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0)))
    nodes = nodes.withColumn("others", F.sum("w").over(siblings) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    nodes = nodes.withColumn("full", (F.col("capacity") * F.col("others") <= F.col("rest") * F.col("w")).cast("int"))
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full") == 1, F.col("capacity"))).over(siblings), F.lit(0))
    weight = F.sum("w").over(siblings) - F.coalesce(F.sum(F.when(F.col("full") == 1, F.col("w"))).over(siblings), F.lit(0.0))
    nodes = nodes.withColumn("left", left).withColumn("weight", weight)
    share = F.when(F.col("full") == 1, F.col("capacity")).otherwise(F.floor(F.col("left") * F.col("w") / F.col("weight")))
    return nodes.select(*path, share.cast("long").alias("budget"))


def _order(doc_id: Column, epoch: Column, seed: str) -> Column:
    """A document's place in an epoch, as a hash in hexadecimal digits."""
    return F.md5(F.concat_ws("|", F.lit(seed), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def plan(slim: DataFrame, fraction: float, max_epochs: int, weights: list, seed: str) -> DataFrame:
    """For each leaf its budget, whole epochs and, of the epoch after these, the last place that the budget takes.

    slim has doc_id, the leaf and tokens of each document. The last epoch's prefix is found from the tokens in
    each of 256 ranges of places, then in each of 256 parts of the one range of each leaf where its budget ends, and so on until
    such ranges are small. A leaf of which a weight is 0 can take nothing.
    """
    positive = F.lit(True)
    for level, w in zip(LEVELS, weights, strict=True):
        positive = positive & (_weight(level, w) > 0)
    leaves = slim.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    leaves = checkpoint(leaves.withColumn("capacity", F.when(positive, F.col("tokens") * max_epochs).otherwise(0)))
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    budgets = None
    for depth in range(len(LEVELS)):
        budgets = _share(budgets, leaves, depth, weights[depth], F.lit(int(total * fraction)).cast("long"))
    budgets = budgets.join(leaves.select(*LEVELS, "tokens"), list(LEVELS)).withColumnRenamed("tokens", "total")
    budgets = budgets.withColumn("epochs", F.when(F.col("total") > 0, F.floor(F.col("budget") / F.col("total"))).otherwise(0).cast("long"))
    budgets = checkpoint(budgets.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("total")))
    placed = join_sized(slim, budgets.where(F.col("rest") > 0), list(LEVELS), "inner").withColumn("place", _order(F.col("doc_id"), F.col("epochs"), seed))
    placed = checkpoint(placed.select(*LEVELS, "rest", "tokens", "place").withColumn("before", F.lit(0).cast("long")))
    for digits in range(2, 33, 2):
        up_to = F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("range"))
        ranges = placed.groupBy(*LEVELS, "rest", "before", F.substring("place", 1, digits).alias("range")).agg(F.sum("tokens").alias("n"), F.count(F.lit(1)).alias("docs"))
        ranges = ranges.withColumn("start", F.col("before") + up_to - F.col("n"))
        cut = checkpoint(ranges.where((F.col("start") < F.col("rest")) & (F.col("rest") <= F.col("start") + F.col("n"))).select(*LEVELS, "range", "start", "docs"))
        inside = join_sized(placed.withColumn("range", F.substring("place", 1, digits)), cut, [*LEVELS, "range"], "inner")
        placed = inside.select(*LEVELS, "rest", "tokens", "place", F.col("start").alias("before"))
        if (cut.agg(F.max("docs")).first()[0] or 0) <= SMALL:
            break
        placed = checkpoint(placed)
    inside = placed.groupBy(*LEVELS, "rest", "before", "place").agg(F.sum("tokens").alias("n"))
    sofar = F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("place"))
    last = inside.withColumn("start", F.col("before") + sofar - F.col("n")).where(F.col("start") < F.col("rest")).groupBy(*LEVELS).agg(F.max("place").alias("last"))
    return checkpoint(budgets.join(last, list(LEVELS), "left").select(*LEVELS, "budget", "epochs", "last"))


def mix(docs: DataFrame, fraction: float = 1.0, max_epochs: int = 4, domains: dict | None = None, domain_weights: dict | None = None, language_weights: dict | None = None, source_weights: dict | None = None, seed: str = SEED, prefix: str = "mix_") -> DataFrame:
    """docs, all columns, with ``mix_`` domain, language, source, tokens and copies.

    The budget is ``fraction`` of all tokens (words parted by white space). A leaf of the tree domain, language,
    source gets the budget of the weights, at most ``max_epochs`` times its tokens. copies is how many epochs take the document: all
    whole epochs that the leaf's budget pays for and, in the order of the last epoch's seeded hash, the
    prefix at whose end the budget is reached. Documents are taken whole, so a leaf exceeds its budget by less than one
    document; rows of equal doc_id in one leaf are taken or left together. A null language or source is the empty name, a null
    text has no tokens and comes with its leaf's whole epochs, an empty table gives an empty result.
    """
    leaf = {fresh(docs, prefix + k): v for k, v in _leaf(DOMAINS if domains is None else domains).items()}
    names = dict(zip(LEVELS, leaf, strict=True))
    tokens, epochs, last = (fresh(docs, prefix + n) for n in ("tokens", "epochs", "last"))
    weights = [DOMAIN_WEIGHTS if domain_weights is None else domain_weights, LANGUAGE_WEIGHTS if language_weights is None else language_weights, source_weights]
    rows = docs.withColumns(leaf).withColumn(tokens, word_count(F.col("text")))
    slim = checkpoint(rows.select("doc_id", *[F.col(n).alias(k) for k, n in names.items()], F.col(tokens).alias("tokens")))
    made = plan(slim, fraction, max_epochs, weights, seed)
    made = made.select(*[F.col(k).alias(n) for k, n in names.items()], F.col("epochs").alias(epochs), F.col("last").alias(last))
    rows = join_sized(rows, made, list(leaf), "left")
    within = F.coalesce((_order(F.col("doc_id"), F.col(epochs), seed) <= F.col(last)).cast("int"), F.lit(0))
    copies = (F.coalesce(F.col(epochs), F.lit(0)) + within).cast("int").alias(fresh(docs, prefix + "copies"))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], *leaf, tokens, copies)


def mixture(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, domain, language, source, tokens, copies (0: not taken)."""
    rows = mix(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source"))
    return rows.select("doc_id", F.col("mix_domain").alias("domain"), F.col("mix_language").alias("language"), F.col("mix_source").alias("source"), F.col("mix_tokens").alias("tokens"), F.col("mix_copies").alias("copies"))


def apply_mixture(docs: DataFrame) -> DataFrame:
    """The rows of docs, all their columns unchanged, each as often as the mixture takes it."""
    rows = mix(docs)
    copies = rows.columns[-1]
    return rows.withColumn(copies, F.explode(F.array_repeat(F.lit(1), F.col(copies)))).select(*[F.col(f"`{c}`") for c in docs.columns])


def _level_sql(depth: int) -> str:
    path = LEVELS[: depth + 1]
    keys, parent = ", ".join(path), ", ".join(path[:-1])
    weights = (DOMAIN_WEIGHTS, LANGUAGE_WEIGHTS, None)[depth]
    w = "CAST(sum(tokens) AS DOUBLE)" if weights is None else f"CAST(CASE {path[-1]} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END AS DOUBLE)"
    part = f"PARTITION BY {parent}" if depth else ""
    source = f"leaves JOIN share{depth - 1} USING ({parent})" if depth else "leaves, (SELECT sum(tokens) AS budget FROM leaves)"
    order = f"({part} ORDER BY CASE WHEN w > 0 THEN capacity / w ELSE 0 END, {path[-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""
nodes{depth} AS (SELECT {keys}, {w} AS w, sum(tokens) * 4 AS capacity, any_value(budget) AS budget FROM {source} GROUP BY {keys}),
sorted{depth} AS (SELECT *, budget - coalesce(sum(capacity) OVER {order}, 0) AS rest, sum(w) OVER ({part}) - coalesce(sum(w) OVER {order}, 0) AS others FROM nodes{depth}),
filled{depth} AS (SELECT *, capacity * others <= rest * w AS is_full FROM sorted{depth}),
share{depth} AS (SELECT {keys}, CAST(CASE WHEN is_full THEN capacity ELSE floor((budget - coalesce(sum(capacity) FILTER (is_full) OVER ({part}), 0)) * w
  / (sum(w) OVER ({part}) - coalesce(sum(w) FILTER (is_full) OVER ({part}), 0))) END AS BIGINT) AS budget FROM filled{depth}),"""


ORACLE_SQL = rf"""
WITH docs AS (
  SELECT doc_id, CASE {" ".join(f"WHEN source IN ({', '.join(repr(s) for s in v)}) THEN '{k}'" for k, v in DOMAINS.items())} ELSE 'web' END AS domain,
    coalesce(lang, '') AS language, coalesce(source, '') AS source, CAST(coalesce(len(regexp_extract_all(text, '[^ \t\n\r]+')), 0) AS BIGINT) AS tokens
  FROM documents),
leaves AS (SELECT domain, language, source, CAST(sum(tokens) AS BIGINT) AS tokens FROM docs GROUP BY ALL),
{"".join(_level_sql(d) for d in range(3))}
plans AS (SELECT *, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs, budget - epochs * tokens AS rest FROM share2 JOIN leaves USING (domain, language, source)),
placed AS (SELECT docs.*, epochs, rest, md5(concat_ws('|', '{SEED}', epochs, coalesce(CAST(doc_id AS VARCHAR), ''))) AS place FROM docs JOIN plans USING (domain, language, source)),
summed AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, language, source ORDER BY place) - sum(tokens) OVER (PARTITION BY domain, language, source, place) AS start FROM placed)
SELECT doc_id, domain, language, source, tokens, CAST(epochs + CASE WHEN start < rest THEN 1 ELSE 0 END AS INTEGER) AS copies FROM summed
"""

"""A Merkle manifest of a dataset by traversal scheduling (operator 11).

Leaves stand in aligned blocks of 512. A pass over the blocks gives their roots by treehash stacks, and the same passes
over the roots give the tree above them. Then each block is traversed leaf by leaf: an authentication path is held for
the leaf at hand, a treehash a level computes the run that comes next on that level one leaf a step, so that it is
ready when the path moves there, and the path of the block's root in the tree above, which all its leaves share, is
appended.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticelake.llm.common import checkpoint, crc32_sql, join_sized, partitions

#: Nodes of a run, levels of a block, and the leaves of one.
ARITY, HEIGHT = 8, 3
BLOCK = ARITY**HEIGHT


def digest(*inputs: str) -> str:
    """H: the lowercase hex sha256 of the inputs, concatenated."""
    return sha256("".join(inputs).encode()).hexdigest()


class Treehash:
    """Takes the nodes of level 0 one by one and keeps an unfinished run a level, and the nodes of the level asked for."""

    def __init__(self, level: int):
        self.runs: list[list[str]] = [[] for _ in range(level + 1)]

    def push(self, node: str, level: int = 0) -> None:
        self.runs[level].append(node)
        if len(self.runs[level]) == ARITY and level + 1 < len(self.runs):
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.runs[level] = self.runs[level], []
        self.push(digest(*run), level + 1)

    def finish(self) -> list[str]:
        """The nodes of the level asked for; last runs may be short."""
        for level in range(len(self.runs) - 1):
            if self.runs[level]:
                self._close(level)
        return self.runs[-1]


def height_of(n: int) -> int:
    """Levels of a block's tree in a sequence of n nodes: all of a block's if there are more blocks, else until one node remains."""
    height = 0
    while n > 1 and height < HEIGHT:
        n, height = -(-n // ARITY), height + 1
    return height


def root_of(nodes: list[str], height: int) -> str:
    stack = Treehash(height)
    for node in nodes:
        stack.push(node)
    return stack.finish()[0]


def traverse(nodes: list[str], height: int) -> Iterator[list[str]]:
    """For each node of a block, in order, its path in it: on each level ``siblings before|siblings after``.

    Beside the block's nodes there are, a level, the run that the path goes through and a stack that computes the next run.
    """
    spans = [ARITY ** (level + 1) for level in range(height)]  # leaves under a run of each level
    path: list[list[str]] = []
    for level, span in enumerate(spans):
        first = Treehash(level)
        for node in nodes[:span]:
            first.push(node)
        path.append(first.finish())
    ahead = [Treehash(level) for level in range(height)]
    for i in range(len(nodes)):
        out = []
        for level, span in enumerate(spans):
            if i and i % span == 0:
                path[level], ahead[level] = ahead[level].finish(), Treehash(level)
            if i + span < len(nodes):
                ahead[level].push(nodes[i + span])
            own = i * ARITY // span % ARITY
            run = path[level]
            out.append("".join(run[:own]) + "|" + "".join(run[own + 1 :]))
        yield out


def fold(node: str, path: list[str]) -> str:
    """The root that a node and its siblings give."""
    for level in path:
        before, after = level.split("|")
        node = digest(before, node, after)
    return node


def positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """rows, checkpointed, with ``idx``, gapless from 0 in the order of each group, and ``n``, the group's rows.

    Rows are sorted in ranges of (group, order), of which a group may fill many; equal ones are dealt by a number of their own. What the
    ranges add up to is a row for each range and group in it.
    """
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    keys = [group, *order, "_row"]
    placed = numbered.repartitionByRange(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    placed = checkpoint(placed.drop("_row").withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_at", 33)))
    pieces = placed.groupBy(group, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(group, "_range", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"), F.sum("_rows").over(Window.partitionBy(group)).alias("n"))
    found = join_sized(placed, checkpoint(starts), [group, "_range"], "inner")
    return found.withColumn("idx", F.col("_start") + F.col("_at") - F.col("_first")).drop("_at", "_range", "_first", "_start")


NODES = "tree string, idx long, node string, n long"
PATHS = "tree string, idx long, path array<string>, subroot string, root string"


def _blocks(nodes: DataFrame) -> DataFrame:
    """The next level of nodes (tree, idx, node, n): a root for each block."""

    def roots(block: pa.Table) -> pa.Table:
        block = block.sort_by("idx")
        n = block["n"][0].as_py()
        root = root_of(block["node"].to_pylist(), height_of(n))
        return pa.table([block["tree"][:1], pa.array([block["block"][0].as_py()]), pa.array([root]), pa.array([-(-n // BLOCK)])], names=["tree", "idx", "node", "n"])

    held = nodes.select("tree", "idx", "node", "n", F.expr(f"idx div {BLOCK}").alias("block"))
    return held.groupBy("tree", "block").applyInArrow(roots, NODES)


def grow(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The levels of blocks over leaves (tree, idx, node, n), which are the first, and (tree, node, level): each tree's root and the last level it has nodes on."""
    levels, tops = [leaves], []
    while True:
        above = checkpoint(_blocks(levels[-1]))
        tops.append(above.where("n = 1").select("tree", "node", F.lit(len(levels) - 1).alias("level")))
        if above.where("n > 1").isEmpty():
            return levels, reduce(DataFrame.union, tops)
        levels.append(above.where("n > 1"))


def _held(nodes: DataFrame, uppers: DataFrame):
    """Blocks of nodes together with the one path that each of them has above it."""
    nodes = nodes.withColumn("block", F.expr(f"idx div {BLOCK}"))
    return nodes.groupBy("tree", "block").cogroup(uppers.withColumnRenamed("idx", "block").groupBy("tree", "block"))


def descend(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The paths above each block of levels[0], (tree, idx, path, subroot, root), from those of the trees' roots: tops has (tree, level, path, subroot, root)."""

    def paths(nodes: pa.Table, upper: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("idx")
        above = upper["path"][0].as_py()
        made = [[*path, *above] for path in traverse(nodes["node"].to_pylist(), height_of(nodes["n"][0].as_py()))]
        shared = [pa.array([upper[c][0].as_py()] * len(made), pa.string()) for c in ("subroot", "root")]
        return pa.table([nodes["tree"], nodes["idx"], pa.array(made, pa.list_(pa.string())), *shared], names=["tree", "idx", "path", "subroot", "root"])

    def ending(level: int) -> DataFrame:
        return tops.where(F.col("level") == level).select("tree", F.lit(0).cast("long").alias("idx"), "path", "subroot", "root")

    uppers = ending(len(levels) - 1)
    for level in range(len(levels) - 1, 0, -1):
        uppers = checkpoint(_held(levels[level], uppers).applyInArrow(paths, PATHS)).union(ending(level - 1))
    return uppers


def document_leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, tampered): the leaf of each row, and that of its tampered text or null if it is not tampered.

    ``tree`` names the row's language, and orders as it does: ``-`` for null, else ``=`` and the language.
    """
    text = F.col("text")
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)

    def leaf(last) -> F.Column:
        values = [*(F.col(c).cast("string") for c in ("doc_id", "source", "lang", "n_chars")), last]
        return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]), 256)

    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-"))
    return docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf(text).alias("leaf"), F.when(picked, leaf(lower)).alias("tampered"))


MANIFEST = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _proofs(rows: pa.Table, upper: pa.Table) -> pa.Table:
    rows = rows.sort_by("idx")
    leaves, tampered = rows["node"].to_pylist(), rows["tampered"].to_pylist()
    above, subroot, root = (upper[c][0].as_py() for c in ("path", "subroot", "root"))
    shared = "".join(above).replace("|", "")
    folded: dict[str, str] = {}  # block roots, which most leaves share, to what they give above
    proofs, ends = [], []
    for leaf, other, path in zip(leaves, tampered, traverse(leaves, height_of(rows["n"][0].as_py())), strict=True):
        proofs.append(digest("".join(path).replace("|", ""), shared))
        top = fold(other or leaf, path)
        if top not in folded:
            folded[top] = fold(top, above)
        ends.append(folded[top])
    n = len(leaves)
    columns = [rows["doc_id"], rows["node"], pa.array([subroot] * n), pa.array([root] * n), pa.array(proofs), pa.array(ends), pa.array([e == root for e in ends])]
    return pa.table(columns, names=[c.split()[0] for c in MANIFEST.split(", ")])


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Of one language a null doc_id comes first, rows of one doc_id are in the order of their leaves, and repeated rows stay rows with a proof each.
    A null doc_id is not tampered with. A null value counts as ``-`` and an empty text as ``0:``. An only row is leaf, subroot and root, and its
    proof is the digest of nothing. An empty table gives an empty result; columns other than doc_id, source, lang, n_chars and text are not read.
    """
    rows = checkpoint(document_leaves(docs))
    leaves = checkpoint(positions(rows, "tree", ["doc_id", "leaf"]).withColumnRenamed("leaf", "node"))
    levels, subroots = grow(leaves)
    subroots = checkpoint(subroots)
    # the subroots are the leaves of the tree on top
    names = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node", "level")
    ordered = checkpoint(positions(names, "tree", ["name"]))
    upper_levels, top = grow(ordered)
    top = top.select("tree", "level", F.array().cast("array<string>").alias("path"), F.col("node").alias("subroot"), F.col("node").alias("root"))
    uppers = descend(upper_levels, top)

    def tops(nodes: pa.Table, upper: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("idx")
        above = upper["path"][0].as_py()
        made = [[*path, *above] for path in traverse(nodes["node"].to_pylist(), height_of(nodes["n"][0].as_py()))]
        root = pa.array([upper["root"][0].as_py()] * len(made))
        return pa.table([nodes["name"], nodes["level"], pa.array(made, pa.list_(pa.string())), nodes["node"], root], names=["tree", "level", "path", "subroot", "root"])

    tops_of_trees = checkpoint(_held(ordered, uppers).applyInArrow(tops, "tree string, level int, path array<string>, subroot string, root string"))
    return _held(leaves, descend(levels, tops_of_trees)).applyInArrow(_proofs, MANIFEST)


def _oracle_sql(depth: int = 8, top_depth: int = 4) -> str:
    """DuckDB SQL for manifest() of tables of up to 8^depth rows a language and 8^top_depth languages: a table for each level of each tree."""
    values = lambda text: " || ".join(f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')" for v in ("doc_id", "source", "lang", "n_chars", text))
    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    run = "PARTITION BY lang, idx // 8 ORDER BY idx"

    def level(name: str, source: str) -> str:
        return f"""{name} AS MATERIALIZED (
            SELECT lang, idx, node, n,
                   coalesce(string_agg(node, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
                   coalesce(string_agg(node, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
            FROM ({source}))"""

    def above(name: str) -> str:
        return f"SELECT lang, idx // 8 AS idx, CASE WHEN n = 1 THEN node ELSE sha256(node || after) END AS node, (n + 7) // 8 AS n FROM {name} WHERE idx % 8 = 0"

    ctes = [
        f"""rows AS MATERIALIZED (
            SELECT doc_id, lang, sha256({values("text")}) AS leaf,
                   CASE WHEN ({crc32_sql("doc_id::VARCHAR")}) % 3 = 0 THEN sha256({values(lower)}) END AS tampered
            FROM documents)""",
        """leaves AS MATERIALIZED (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM rows)""",
        level("t0", "SELECT lang, idx, leaf AS node, n FROM leaves"),
        *(level(f"t{k}", above(f"t{k - 1}")) for k in range(1, depth + 1)),
        level("u0", f"SELECT '' AS lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, node, count(*) OVER () AS n FROM t{depth}"),
        *(level(f"u{k}", above(f"u{k - 1}")) for k in range(1, top_depth + 1)),
        f"names AS MATERIALIZED (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, node AS subroot FROM t{depth})",
        "f0 AS (SELECT doc_id, leaf, subroot, place, l.lang, l.idx, '' AS proof, coalesce(tampered, leaf) AS own FROM leaves l JOIN names s ON l.lang IS NOT DISTINCT FROM s.lang)",
    ]
    steps = [(f"t{k}", f"t.lang IS NOT DISTINCT FROM f.lang AND t.idx = f.idx // {8**k}") for k in range(depth)] + [(f"u{k}", f"t.idx = f.place // {8**k}") for k in range(top_depth)]
    for i, (name, on) in enumerate(steps):
        ctes.append(
            f"""f{i + 1} AS MATERIALIZED (
            SELECT f.* REPLACE (f.proof || t.before || t.after AS proof, CASE WHEN t.n = 1 THEN f.own ELSE sha256(t.before || f.own || t.after) END AS own)
            FROM f{i} f JOIN {name} t ON {on})"""
        )
    return f"""WITH {", ".join(ctes)}
        SELECT doc_id, leaf, subroot, r.node AS root, sha256(proof) AS proof_sha256, own AS folded_root, own = r.node AS verified
        FROM f{len(steps)} CROSS JOIN u{top_depth} r"""


ORACLE_SQL = _oracle_sql()

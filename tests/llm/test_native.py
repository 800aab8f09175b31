"""Chat formatting, sharding and mixing."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import xxhash
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from noticelake.llm import chat, mixing, sharding

TURNS = "conv_id long, turn long, role string, text string"
TABLE = "doc_id long, text string, lang string, source string, n_chars long"


def _expected(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        told = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


TEXT = st.one_of(st.none(), st.text(alphabet="\\#<>+/: \nturnaé日", max_size=12), st.sampled_from(["### assistant: ", "\n</turn>\n", "<+>", "\\", "\\#", "### a: b\n</turn>\n### c: d"]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.sampled_from(["user", "assistant", "system", "a: b", "x\n#"])), TEXT), max_size=30))
def test_conversations_come_back(spark, rows):
    df = spark.createDataFrame(rows, TURNS).withColumns({"formatted": F.lit("x"), "messages": F.lit(1)})
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.digests(chat.format_conversations(df)).collect()}
    assert got == _expected(rows)


def test_format_and_mask(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b<"), (1, 2, "assistant", "c\\"), (1, 3, "assistant", "")]
    r = chat.format_conversations(spark.createDataFrame(rows, TURNS)).first()
    assert r["formatted"] == "### user: a\n<+>\nb\\<\n</turn>\n### assistant: c\\\\\n<+>\n\n</turn>\n"
    assert [(s["message"], s["length"]) for s in r["loss_spans"]] == [(1, 3), (1, 0)]
    assert chat.with_control_case(spark, spark.createDataFrame(rows, TURNS)).where("conv_id = -7").count() == 2


def _tree_shard(key, regions, seed="shards-1"):
    import math

    def pick(path, weights):
        if len(weights) == 1:
            return 0
        draws = []
        for i, w in enumerate(weights):
            h = xxhash.xxh64(f"{seed}|{path}/{i}|{key}".encode(), seed=42).intdigest() >> 11
            draws.append((-math.log((h + 0.5) / 2**53) / w, i))
        return min(draws)[1]

    r = pick("", [w for w, _ in regions])
    k = pick(f"/{r}", [w for w, _ in regions[r][1]])
    s = pick(f"/{r}/{k}", [w for w, _ in regions[r][1][k][1]])
    return regions[r][1][k][1][s][1]


def test_sharding(spark):
    rng = random.Random(5)
    rows = [(i, "é" * rng.randrange(40)) for i in range(3000)] + [(7, "same")] * 3 + [(None, None), (None, "x"), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"shard": F.lit("clash"), "_rank": F.lit(0), "slot": F.lit(9)})
    got = sharding.shard_documents(df).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        if r["doc_id"] is not None:
            assert r["shard"] == _tree_shard(str(r["doc_id"]), sharding.hash_tree())
            assert r["grown_shard"] in (r["shard"], 24)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(24))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    moved = sum(r["grown_shard"] == 24 for r in got) / len(got)
    assert 0.02 < moved < 0.06
    assert sharding.shard_documents(df.limit(0)).count() == 0


def test_weights_of_the_tree(spark):
    tree = [(3.0, [(1.0, [(1.0, 0)])]), (1.0, [(1.0, [(2.0, 1), (1.0, 2)])])]
    n = Counter(r["s"] for r in spark.range(20000).select(sharding.tree_shard(F.col("id"), tree).alias("s")).collect())
    assert abs(n[0] / 20000 - 0.75) < 0.02 and abs(n[1] / n[2] - 2) < 0.25


def _mixture(rows, domains, dw, lw, seed, epochs=4):
    """By brute force: budgets by repeated filling, then one seeded walk through each leaf."""
    docs = []
    for doc_id, text, lang, source in rows:
        domain = next((d for d, s in domains.items() if source in s), "web")
        docs.append(((domain, lang or "", source or ""), doc_id, len(re.findall(r"[^ \t\n\r]+", text or ""))))
    leaves = Counter()
    for leaf, _, n in docs:
        leaves[leaf] += n

    def fill(budget, children):  # name -> (weight, capacity)
        out, open_ = {}, dict(children)
        while open_:
            total = sum(w for w, _ in open_.values())
            over = [k for k, (w, c) in open_.items() if c * total <= budget * w]
            if not over:
                return out | {k: int(budget * w / total) for k, (w, c) in open_.items()}
            first = min(over, key=lambda k: (open_[k][1] / open_[k][0] if open_[k][0] else 0, k))
            out[first] = open_[first][1]
            budget -= open_.pop(first)[1]
        return out

    cap = lambda p: sum(n for leaf, n in leaves.items() if leaf[: len(p)] == p) * epochs
    kids = lambda p: sorted({leaf[: len(p) + 1] for leaf in leaves if leaf[: len(p)] == p})
    weight = lambda p: dw.get(p[0], 1) if len(p) == 1 else lw.get(p[1], 1) if len(p) == 2 else leaves[p]
    budgets = {(): sum(leaves.values())}
    for _ in range(3):
        budgets = {k: v for p, b in budgets.items() for k, v in fill(b, {c: (float(weight(c)), cap(c)) for c in kids(p)}).items()}
    out = []
    for leaf, total in leaves.items():
        whole = budgets[leaf] // total if total else 0
        rest, sofar = budgets[leaf] - whole * total, 0
        walk = defaultdict(list)
        for lf, doc_id, n in docs:
            if lf == leaf:
                walk[hashlib.md5(f"{seed}|{whole}|{'' if doc_id is None else doc_id}".encode()).hexdigest()].append((doc_id, n))
        for _, same in sorted(walk.items()):
            out += [(doc_id, n, whole + (sofar < rest)) for doc_id, n in same]
            sofar += sum(n for _, n in same)
    return Counter(out)


def test_nothing_goes_where_a_weight_is_zero(spark):
    rows = [(i, "w " * 10, "en", f"src{i % 2}") for i in range(60)]
    df = spark.createDataFrame([(*r, 1) for r in rows], TABLE)
    taken = lambda **w: {r["mix_domain"]: r["n"] for r in mixing.mix(df, **w).groupBy("mix_domain").agg(F.sum("mix_copies").alias("n")).collect()}
    assert taken(domain_weights={"web": 0, "reference": 0}) == {"web": 0, "reference": 0}
    assert taken(domain_weights={"web": 0}, fraction=0.5) == {"web": 0, "reference": 30}
    assert taken(domain_weights={"web": 0}, max_epochs=1) == {"web": 0, "reference": 30}
    assert set(taken(language_weights={"en": 0}).values()) == {0}


def test_prefix_of_a_large_leaf(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SMALL", 2)  # ranges of ranges
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 9)), "en", rng.choice(["src0", "src1"])) for i in range(3000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], TABLE)
    got = Counter((r["doc_id"], r["tokens"], r["copies"]) for r in mixing.mixture(df).collect())
    assert got == _mixture(rows, mixing.DOMAINS, mixing.DOMAIN_WEIGHTS, mixing.LANGUAGE_WEIGHTS, mixing.SEED)


def test_mixing_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randrange(30)), rng.choice(["en", "en", "en", "de", None]), rng.choice(["src0"] * 6 + ["src1", "src5", "src7", None])) for i in range(800)]
    rows += [(5, "a b", "en", "src0")] * 3 + [(None, "x y z", "en", "src1"), (None, None, None, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], TABLE).withColumns({"mix_tokens": F.lit("clash"), "tokens": F.lit(0), "domain": F.lit("d")})
    got = Counter((r["doc_id"], r["tokens"], r["copies"]) for r in mixing.mixture(df).collect())
    assert got == _mixture(rows, mixing.DOMAINS, mixing.DOMAIN_WEIGHTS, mixing.LANGUAGE_WEIGHTS, mixing.SEED)
    taken = mixing.apply_mixture(df)
    assert taken.columns == df.columns and taken.count() == sum(c * n for (_, _, c), n in got.items())
    assert mixing.mixture(df.limit(0)).count() == 0 and mixing.apply_mixture(df.limit(0)).count() == 0


def test_shortage_goes_to_siblings_first(spark):
    rows = [(i, "w " * 10, "en", "src1") for i in range(1)] + [(10 + i, "w " * 10, "de", "src2") for i in range(50)] + [(100 + i, "w " * 10, "en", "src0") for i in range(50)]
    df = spark.createDataFrame([(*r, 1) for r in rows], TABLE)
    got = mixing.mix(df, max_epochs=1, domain_weights={"web": 1, "reference": 1}, language_weights={"en": 9, "de": 1}, fraction=0.5)
    tokens = {r["d"]: r["n"] for r in got.groupBy(F.col("mix_domain").alias("d")).agg(F.sum(F.col("mix_tokens") * F.col("mix_copies")).alias("n")).collect()}
    assert tokens["reference"] >= 250 and tokens["reference"] - tokens["web"] <= 20

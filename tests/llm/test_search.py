"""The similarity join, the tree search and the pipeline."""

import importlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from noticelake.llm import simjoin, vectors

SF = "/root/testdata/sf0.001"
TABLE = "doc_id long, text string"


def _set(text):
    w = re.findall(r"\w+", (text or "").lower())
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def _brute(rows, threshold=0.8):
    sets = [_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = defaultdict(lambda: float("inf"))
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], float("inf") if doc_id is None else doc_id)
    return Counter((doc_id, None if least[find(i)] == float("inf") else least[find(i)], links[i]) for i, (doc_id, _) in enumerate(rows))


def _corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("aeiou") + rng.choice("klmnop") + str(rng.randrange(30))
    rows, n = [], 0
    for _ in range(60):
        base = [word() for _ in range(rng.choice([3, 8, 40, 150]))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                w[rng.randrange(len(w))] = word()
            rows.append((n, rng.choice([" ", "  ", ", "]).join(w)))
            n += 1
    passage = [word() for _ in range(30)]
    rows += [(n + i, " ".join(passage + [word() for _ in range(60)])) for i in range(25)]
    rows += [(7, rows[7][1]), (None, rows[3][1]), (900, None), (901, ""), (902, "!!"), (903, "one two"), (904, "ONE Two!"), (None, None)]
    return rows


@pytest.mark.parametrize("full", [simjoin.FULL, 4])
def test_join_against_brute_force(spark, full):
    rows = _corpus(1)
    df = spark.createDataFrame(rows, TABLE).withColumns({"links": F.lit("clash"), "text_key": F.lit(0), "class": F.lit(1)})
    got = simjoin.similar_classes(df, full=full)
    assert Counter((r["doc_id"], r["class_id"], r["links"]) for r in got.collect()) == _brute(rows)


def test_one_of_each(spark):
    rows = _corpus(2)
    df = spark.createDataFrame(rows, TABLE).withColumn("first", F.lit("kept"))
    kept = simjoin.one_of_each(df)
    assert kept.columns == df.columns
    classes = {c for _, c, _ in _brute(rows)} - {None}
    assert {r["doc_id"] for r in kept.collect()} - {None} == classes
    assert simjoin.one_of_each(df.limit(0)).count() == 0 and simjoin.linked_documents(df.limit(0)).count() == 0


def test_shingles_in_batches_equal_those_alone():
    texts = [t or "" for _, t in _corpus(3)] + ["a_b c-d é1 日本 x", "", " "]
    for alone, together in zip([simjoin.shingles([t])[0] for t in texts], simjoin.shingles(texts), strict=True):
        assert (alone == together).all()
    for t, s in zip(texts, simjoin.shingles(texts), strict=True):
        assert len(s) == len(_set(t))


EMBEDDINGS = "vec_id long, embedding array<float>"


def _nearest(rows, k=10):
    good = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and len(v) == 4 and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, x in good:
        if q % 100 == 0:
            found = sorted((float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in good if i != q)
            out[q] = [(i, d) for d, i in found[:k]]
    return out


def test_search_of_few_rows_is_exact(spark):
    rng = np.random.default_rng(2)
    f = lambda v: [float(np.float32(x)) for x in v]
    rows = [(i, f(rng.normal(size=4))) for i in range(300)] + [(400 + i, f([1, 2, 3, 4])) for i in range(30)]
    rows += [(500, None), (501, [0.0] * 4), (502, [1.0, None, 1.0, 1.0]), (503, [1.0, float("nan"), 1.0, 1.0]), (504, [float("inf")] * 4), (505, [1.0]), (506, []), (None, f([1, 1, 1, 1])), (7, f([1, 0, 0, 0]))]
    df = spark.createDataFrame(rows, EMBEDDINGS).withColumns({"leaf": F.lit("clash"), "v": F.lit(1)})
    got = defaultdict(list)
    for r in vectors.search(df, F.col("vec_id") % 100 == 0, recall=1.0, leaf_rows=20, calibrated=1000).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
        assert len(got[r["query_id"]]) == r["rank"]
    want = _nearest(rows)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]] and np.allclose([d for _, d in got[q]], [d for _, d in want[q]], rtol=1e-12)
    assert vectors.search(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert vectors.search(df.where("vec_id = 100"), F.col("vec_id") % 100 == 0).count() == 0


def test_search_reaches_the_recall(spark, monkeypatch):
    monkeypatch.setattr(vectors, "LEAF", 60)
    monkeypatch.setattr(vectors, "GROUP", 40)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 4)) * 4
    rows = [(i, [float(x) for x in (centres[i % 30] + rng.normal(size=4)).astype(np.float32)]) for i in range(6000)] + [(10_000 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(3000)]
    levels = []
    split = vectors._split
    monkeypatch.setattr(vectors, "_split", lambda *a: levels.append(1) or split(*a))
    got = defaultdict(list)
    found = vectors.search(spark.createDataFrame(rows, EMBEDDINGS), F.col("vec_id") % 100 == 0, sample=150, leaf_rows=20)
    for r in found.orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    assert len(levels) > 1
    want = _nearest(rows)
    assert set(got) == set(want) and all(len(x) == 10 for x in got.values())
    assert np.mean([len(set(got[q]) & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.95
    assert got[10_500] == list(range(10_000, 10_010))  # of equal vectors the smallest ids


def test_tree_opens_every_leaf_once():
    x = np.random.default_rng(4).normal(size=(500, 3))
    tree = vectors.fit(x, 20)
    assert sorted(leaf for _, leaf in tree.open(x[0])) == list(range(tree.leaves))
    assert vectors.fit(np.ones((50, 3)), 5).leaves == 1
    assert [next(tree.open(tree.centroids[i]))[1] for i in range(len(tree.leaf)) if tree.leaf[i] >= 0][0] in range(tree.leaves)


def test_pipeline(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    assert len(pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for i, (_, stage) in enumerate(pipeline.STAGES):
        docs = stage(spark, docs, SF)
        if i < 4:
            assert docs.columns == columns
            docs = spark.createDataFrame(docs.collect(), docs.schema)
            assert docs.count()
    run = pipeline.run(spark, SF).toPandas()
    assert run["length"].sum() == docs.toPandas()["length"].sum() and (run["length"] > 0).all()


def test_stages_of_odd_rows(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    rng = random.Random(31)
    words = {"en": ["the", "and", "ing", "ation", "ther"], "de": ["der", "und", "schaft", "keit", "ung"]}
    text = lambda lang, n: " ".join("".join(rng.choice(words[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))
    rows = [(i, text(lang, rng.randrange(20, 90)), lang, f"src{i % 3}", 1) for i, lang in enumerate(rng.choice(["en", "de"]) for _ in range(200))]
    rows += [(300, None, "en", None, None), (301, "", None, "src1", 0), (302, "!! 12", "de", "src1", 5), (None, text("en", 40), "en", "src0", 1), (5, rows[5][1], rows[5][2], "src2", 1), (303, text("de", 20_000), "de", "src1", 1), (304, text("en", 30), None, "src1", 1), (305, text("de", 30), "xx", "src1", 1)]
    rows += [rows[7]] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({"keep": F.lit("k"), "first": F.lit(1), "tokens": F.lit("t"), "lang_pred": F.lit("l"), "partition": F.lit(0), "run": F.lit("r"), "links": F.lit(2)})
    sizes = []
    for _, stage in pipeline.STAGES[:4]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns
        sizes.append((docs.count(), kept.count()))
        assert stage(spark, docs.limit(0), SF).count() == 0
        docs = spark.createDataFrame(kept.collect(), docs.schema)
    ids = {r["doc_id"] for r in docs.collect()}
    assert sizes[0][1] >= 0.95 * sizes[0][0] - 3 and sizes[1][1] >= 0.95 * sizes[1][0] and not ids & {300, 301, 302}
    pieces = pipeline.pack(spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == len(ids) and pipeline.pack(spark, docs.limit(0), SF).count() == 0
    one = spark.createDataFrame([(1, text("en", 30), "en", "src1", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in pipeline.STAGES[:4]:
        assert stage(spark, one, SF).count() >= 1


def test_registered_queries_run(spark):
    from noticelake.llm import queries

    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES) == list(range(1, 14))
    for name in ("op3_pages", "op6_vectors"):
        assert queries.QUERIES[name](spark, SF).count() > 0

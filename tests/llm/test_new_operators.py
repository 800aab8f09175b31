"""Merkle manifest, toxicity and spelling variants against plain loops, on rows of every odd kind."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from noticelake.llm import merkle, spelling, toxicity

TABLE = "doc_id long, text string, lang string, source string, n_chars long"


def _h(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def _values(*values):
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _tree(nodes):
    """The root of nodes and, for each, its siblings before and after on each level."""
    paths = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for p, i in zip(paths, at, strict=True):
            run = nodes[i // 8 * 8 : i // 8 * 8 + 8]
            p.append((run[: i % 8], run[i % 8 + 1 :]))
        nodes = [_h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        at = [i // 8 for i in at]
    return nodes[0], paths


def _manifest(rows):
    by = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        lower = None if text is None else re.sub("[A-Z]", lambda m: m[0].lower(), text)
        picked = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        leaf = _values(doc_id, source, lang, n_chars, text)
        by[lang].append((doc_id is not None, doc_id or 0, leaf, doc_id, _values(doc_id, source, lang, n_chars, lower) if picked else leaf))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by[lang].sort()
        trees[lang] = _tree([r[2] for r in by[lang]])
    root, tops = _tree([trees[x][0] for x in langs])
    out = []
    for lang, top in zip(langs, tops, strict=True):
        for (_, _, leaf, doc_id, own), path in zip(by[lang], trees[lang][1], strict=True):
            proof = ""
            for before, after in [*path, *top]:
                proof += "".join(before + after)
                own = _h(*before, own, *after)
            out.append((doc_id, leaf, trees[lang][0], root, _h(proof), own, own == root))
    return Counter(out)


def _documents(n, seed=1):
    r = random.Random(seed)
    langs = ["en"] * 6 + ["de", "é", None, ""]
    rows = [(i, r.choice(["Ab c", "ab", "", None, "ÀÉ x", "Q" * 50]), r.choice(langs), r.choice(["s", None]), r.choice([1, None])) for i in range(n)]
    return rows + [(None, "A", "en", None, None), (None, "B", "en", None, None), (3, "Other", "en", "s", 1), *rows[:5], (-7, "X", "only", "s", 0)]


@pytest.mark.parametrize("n", [0, 1, 9, 1300])
def test_manifest_is_the_plain_tree(spark, n):
    rows = _documents(n) if n > 1 else [(5, "Ab", None, "s", 2)][:n]
    df = spark.createDataFrame(rows, TABLE).withColumns({"tree": F.lit("x"), "idx": F.lit(1), "node": F.lit(2), "n": F.lit(0), "_row": F.lit(3)})
    assert Counter(tuple(r) for r in merkle.manifest(df).collect()) == (_manifest(rows) if rows else Counter())


def test_manifest_keeps_order_when_a_language_fills_many_ranges(spark):
    rows = [(i * 7 % 5000, "T%d" % i, "en", "s", 1) for i in range(5000)] + [(1, "T", "en", "s", 1)] * 300
    df = spark.createDataFrame(rows, TABLE).repartition(7)
    assert Counter(tuple(r) for r in merkle.manifest(df).collect()) == _manifest(rows)


def test_traversal_holds_little():
    """A path is followed with a run and a stack a level, whatever the number of leaves."""
    leaves = [_h(str(i)) for i in range(512)]
    _, paths = _tree(leaves)
    for path, expected in zip(merkle.traverse(leaves, 3), paths, strict=True):
        assert path == ["".join(b) + "|" + "".join(a) for b, a in expected]
    stack = merkle.Treehash(3)
    for node in leaves:
        stack.push(node)
        assert all(len(run) < 8 for run in stack.runs[:-1])


WORDS = ["garden", "gardens", "gardem", "gardenss", "arden", "gaarden", "window", "wndow", "Wîndow", "ÀBCDEFÿ", "aaaaaa", "aaaaaaa", "aaaaab", "banana", "bananas", "ananas", "bananna", "short", "réunion", "reunion"]


def _spellings(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]

    forms, count = {}, {}
    for w in n:
        found = [x for x in n if near(w, x)]
        count[w] = len(found)
        best = min(found, key=lambda x: (-n[x], x), default=None)
        forms[w] = best if best and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while forms[root]:
            root = forms[root]
        out.add((w, forms[w], root, n[w], count[w], n[forms[w]] if forms[w] else None))
    return out


def test_spellings_are_those_of_all_pairs(spark):
    r = random.Random(2)
    rows = [(None, None), (1, ""), (None, "garden " * 7), (2, "x" * 3000 + " garden")]
    rows += [(i, " ".join(r.choices(WORDS, weights=[2000, 300, 50, 30, 9, 8, 900, 90] + [60] * 12, k=60)).replace(" ", r.choice([" ", "-", "1", "\n"]))) for i in range(200)]
    letters = "abé"
    rows += [(1000 + i, " ".join("".join(r.choices(letters, k=r.choice([6, 6, 7]))) for _ in range(300))) for i in range(60)]
    rows += rows[5:8]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit("x"), "n": F.lit(1), "key": F.lit(2)})
    expected = _spellings(rows)
    assert len(expected) > 500 and any(x[1] and x[1] != x[2] for x in expected)
    assert {tuple(x) for x in spelling.group_spellings(df).collect()} == expected
    assert spelling.group_spellings(df.limit(0)).count() == 0


def test_keys_meet_for_each_single_edit():
    r = random.Random(3)
    for _ in range(3000):
        a = "".join(r.choices("abc", k=r.randint(6, 12)))
        i = r.randrange(len(a) + 1)
        b = r.choice([a[:i] + r.choice("abcd") + a[i:], a[:i] + r.choice("abcd") + a[i + 1 :]])
        frequency = {x + y: r.randint(1, 4) for x in "abcd" for y in "abcd"}
        if len(b) >= 6 and a != b:
            longest = max(len(a), len(b))
            assert {k for k in spelling.keys(a, frequency) & spelling.keys(b, frequency) if k[0] == longest}


def test_long_texts_are_cut_at_no_run():
    text = "Abcdef " * 1000 + "g" * 500 + "×" * 40 + " Ûabcdé "
    assert [x for found in spelling.runs(text, 64) for x in found] == [x for found in spelling.runs(text) for x in found] == re.findall("[a-zÀ-ÿ]{6,}", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def test_features_are_words_pairs_and_openings():
    def feats(text):
        return {int(x) for _, f in toxicity.features([text]) for x in f}

    assert feats("") == set() and feats("a") and len(feats("one two six")) == 3 + 2 + 1 + 3
    assert feats("Idiot clown") == feats("  idiot, CLOWN!")
    assert feats("one two") & feats("two one") < feats("one two")
    both = toxicity.features(["one two", "six"])
    assert {int(x) for owner, f in both for o, x in zip(owner, f, strict=True) if o == 1} == feats("six")


def test_long_texts_have_the_features_of_the_whole():
    r = random.Random(4)
    text = " ".join("".join(r.choices("abcdefgé", k=r.randint(1, 9))) for _ in range(3000))
    whole = {int(x) for _, f in toxicity.features([text]) for x in f}
    parts = {int(x) for (lot,) in toxicity._lots([text], 500) for _, f in toxicity.features([lot]) for x in f}
    assert parts == whole


def test_ftrl_goes_on_from_given_weights():
    a = toxicity.Ftrl()
    for _ in range(30):
        a.learn(np.array([1, 2, toxicity.BIAS]), 1)
        a.learn(np.array([2, 3, toxicity.BIAS]), 0)
    at = np.flatnonzero(a.weights(np.arange(toxicity.SIZE + 1)))
    b = toxicity.Ftrl()
    b.start(at, a.weights(at), a.n[at])
    assert np.allclose(b.weights(at), a.weights(at)) and a.weights(np.array([1]))[0] > 0 > a.weights(np.array([3]))[0]


def test_toxicity_on_held_out_rows(spark):
    r = random.Random(5)
    vocabulary = ["".join(r.choices("abcdefgh", k=6)) for _ in range(300)]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 5 == 0
        words = r.choices(vocabulary, k=60)
        if toxic:
            for _ in range(4):
                words[r.randrange(60)] = r.choice(["idiot", "moron", "stupid" + "".join(r.choices("xyz", k=3))])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    labels += [(None, 1), (7, None), (10**9, 1), (11, 1), (11, 0), *labels[:50]]
    rows += [(None, None), (2000, ""), (2001, None), rows[3], (2002, "word " * 5000 + "moron")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"label": F.lit("x"), "score": F.lit(1), "toxic": F.lit(1)})
    marked = spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("text", F.lit("x"))
    found = toxicity.toxicity_documents(df, marked).collect()
    assert len(found) == len(rows) and all(0 <= x["score"] <= 1 and x["predicted"] == (x["score"] >= 0.5) for x in found)
    held = [x for x in found if x["held_out"] and x["doc_id"] is not None and x["doc_id"] < 900]
    assert all(x["held_out"] == (zlib.crc32(str(x["doc_id"]).encode()) % 5 == 0) for x in found if x["doc_id"] is not None)
    right = sum(x["predicted"] == (x["doc_id"] % 5 == 0) for x in held)
    assert right >= 0.97 * len(held)
    empty = {x["score"] for x in found if x["doc_id"] in (None, 2000, 2001)}
    assert len(empty) == 1
    none = toxicity.toxicity_documents(df, marked.limit(0)).collect()
    assert {x["score"] for x in none} == {0.0} and toxicity.toxicity_documents(df.limit(0), marked).count() == 0


def test_sample_of_labels_is_bounded(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"))
    labels = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic"))
    assert 400 < toxicity.labelled(docs, labels, most=600).count() < 800


def test_sql_is_the_queries_own(spark, tmp_path):
    from noticelake.llm import queries

    rows = _documents(400, seed=9)
    spark.createDataFrame(rows, TABLE).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = queries.QUERIES["op11_merkle"](spark, str(tmp_path))
    expected = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE_SQL['op11_merkle']})").fetchall()
    assert Counter(tuple(r) for r in got.collect()) == Counter(expected)

"""N-gram Jaccard join by chosen paths (operator 7).

Documents are sets of word shingles. In each run a set chooses a few of its shingles by a hash that all sets
share; sets that chose the same shingle meet in a bucket. A bucket that is too full is split again, and its parts
too, by shingles chosen under the hash of their path, until a part is small or its sets no longer part. Buckets are compared by brute
force. Runs are repeated until a sample of sets, held against all others, has the target recall.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.llm.common import checkpoint, fresh, join_sized, pieces, slices, tidy
from noticelake.llm.langid import letters

WORDS, THRESHOLD = 5, 0.8
#: The share of links to find, and the sets, about, whose links are counted exactly to measure it.
RECALL, MEASURED = 0.999, 1500
#: A bucket of more sets than this is split; one that does not part is compared in blocks of half as many.
FULL = 1024
#: How many shingles a set chooses within a full bucket; how often buckets are split; the share of its sets that a part of a bucket of near copies has.
DEEPER, DEPTH, ALIKE = 2.5, 4, 0.5
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_WORD_CHARS: list[np.ndarray] = []


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    return x ^ (x >> np.uint64(29))


def _word_chars() -> np.ndarray:
    if not _WORD_CHARS:
        table = letters().copy()
        table[[i for i in range(0x3000) if chr(i).isalnum() or chr(i) == "_"]] = True
        _WORD_CHARS.append(table)
    return _WORD_CHARS[0]


def _word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hashes of all words of the lower-cased texts, and where those of each text begin."""
    lowered = [f"{t.lower()} " for t in texts]
    code = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _word_chars()[code]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    starts, stops = edges[::2], edges[1::2]
    bounds = np.searchsorted(starts, np.concatenate(([0], np.cumsum([len(t) for t in lowered]))))
    # a word's hash is the sum of its characters' hashes by their place in the word
    place = np.arange(len(code), dtype=np.uint64)
    place -= np.repeat(np.concatenate(([0], starts)).astype(np.uint64), np.diff(np.concatenate(([0], starts, [len(code)]))))
    each = _mix((code.astype(np.uint64) + (place << np.uint64(24))) * _M1)
    each[~inside] = 0
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(each)))
    return _mix(sums[stops] - sums[starts]), bounds


def shingles(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """For each text the sorted 64-bit hashes of its runs of ``words`` lower-cased words; fewer words are one shingle, none is none."""
    if len(texts) == 1:  # it may be long
        word = np.concatenate([_word_hashes([p])[0] for p in pieces(texts[0])])
        bounds = np.array([0, len(word)])
    else:
        word, bounds = _word_hashes(texts)
    m = max(len(word) - words + 1, 0)
    run = np.zeros(m, np.uint64)
    for k in range(words):
        run = _mix((run ^ word[k : k + m]) * _M1)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(run[a : b - words + 1]))
        elif b > a:
            h = np.zeros(1, np.uint64)
            for k in range(a, b):
                h = _mix((h ^ word[k : k + 1]) * _M1)
            out.append(h)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def runs_for(recall: float, threshold: float = THRESHOLD, depth: int = 1) -> int:
    """Runs that find a pair at the threshold with this chance, if its buckets are split ``depth`` times.

    The chosen shingles that both sets have are as many as a Poisson variable with the mean of those chosen times
    the sets' shared part, and one at each level leads to a common bucket.
    """
    shared = 2 * threshold / (1 + threshold)
    found = (1 - math.exp(-shared / threshold)) * (1 - math.exp(-shared * DEEPER)) ** depth
    return math.ceil(math.log(1 - recall) / math.log(1 - found))


def _chosen(s: np.ndarray, path: int, expected: float) -> np.ndarray:
    """Paths that lead on from ``path``: by each shingle whose hash under the path is small enough for the set's size."""
    h = _mix((s ^ np.uint64(path)) * _M1)
    limit = min(expected / max(len(s), 1), 1.0)
    return np.unique(_mix(h[h <= np.uint64(min(int(limit * 2.0**64), 2**64 - 1))] + np.uint64(path))).view(np.int64)


def _digest(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _rows(columns: dict[str, list], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) for c, t in types.items()], names=list(types))


def _sketch(runs: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            sets = shingles(texts)
            paths = [np.concatenate([_chosen(s, r + 1, 1 / threshold) for r in range(runs)]) if len(s) else np.zeros(0, np.int64) for s in sets]
            columns = [part.column("doc_id"), part.column("text_key"), pa.array([_digest(s) for s in sets], pa.binary()), pa.array(paths, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "digest", "paths"])

    return run


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of each full bucket that a set goes to, with the bucket's size."""
    types = {"digest": pa.binary(), "bucket": pa.int64(), "whole": pa.int64()}
    for part, texts in slices(batches):
        out: dict[str, list] = {c: [] for c in types}
        for s, digest, full in zip(shingles(texts), part.column("digest").to_pylist(), part.column("full").to_pylist(), strict=True):
            if _digest(s) == digest:
                for at in full:
                    found = _chosen(s, at["bucket"] & (2**64 - 1), DEEPER).tolist()
                    for c, values in zip(types, ([digest] * len(found), found, [at["n"]] * len(found)), strict=True):
                        out[c] += values
        yield _rows(out, types)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the set of each candidate, whose text comes first."""
    for part, texts in slices(batches):
        sets = shingles(texts)
        same = pa.array([_digest(s) == d for s, d in zip(sets, part.column("digest").to_pylist(), strict=True)])
        names = [n for n in part.schema.names if n != "text"]
        out = pa.RecordBatch.from_arrays([*[part.column(n) for n in names], pa.array([s.tobytes() for s in sets], pa.binary())], names=[*names, "shingles"])
        yield out.filter(same)


def _compare(group: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links within a bucket (or between two of its blocks) that no smaller bucket shared by both sets also has.

    One row for each set with links: how many documents it links to, and one link to the first set of its
    part of the bucket, so a bucket of n sets gives n rows at most.
    """
    group = group.drop_duplicates("digest")
    n = len(group)
    bucket, low, high = (int(group[c].iloc[0]) for c in ("bucket", "low", "high"))
    sets = [np.frombuffer(x, np.uint64) for x in group["shingles"]]
    sizes = np.array([len(s) for s in sets], np.float32)
    owner = np.repeat(np.arange(n), sizes.astype(np.int64))
    codes, _ = pd.factorize(np.concatenate(sets))
    often = np.bincount(codes)
    shared = often > 1
    number = np.cumsum(shared) - 1
    keep = shared[codes]
    codes, owner = number[codes[keep]], owner[keep]
    both = np.zeros((n, n), np.float32)
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    width = max(1, (1 << 22) // n)
    total = int(codes[-1]) + 1 if len(codes) else 0
    for start in range(0, total, width):
        a, b = np.searchsorted(codes, (start, start + width))
        m = np.zeros((n, min(width, total - start)), np.float32)
        m[owner[a:b], codes[a:b] - start] = 1
        both += m @ m.T
    linked = both * (1 + threshold) >= threshold * (sizes[:, None] + sizes[None, :]) - 1e-3
    np.fill_diagonal(linked, False)
    if low != high:
        block = group["block"].to_numpy()
        linked &= block[:, None] != block[None, :]
    earlier = [[x for x in b if x < bucket] for b in group["buckets"]]
    names = {x: i for i, x in enumerate(sorted({x for e in earlier for x in e}))}
    if names:
        m = np.zeros((n, len(names)), np.float32)
        for i, e in enumerate(earlier):
            m[i, [names[x] for x in e]] = 1
        linked &= m @ m.T == 0
    links = linked.astype(np.float64) @ group["copies"].to_numpy(np.float64)
    root = np.full(n, -1)
    for i in range(n):
        if root[i] < 0 and linked[i].any():
            root[i], front = i, np.array([i])
            while len(front):
                front = np.flatnonzero(linked[front].any(axis=0) & (root < 0))
                root[front] = i
    at = np.flatnonzero(root >= 0)
    d = group["digest"].to_numpy()
    return pd.DataFrame({"digest": d[at], "links": links[at].astype(np.int64), "root": d[root[at]]})


def _components(links: DataFrame) -> DataFrame:
    """(digest, component): the smallest digest that links lead to, by hooking to smaller neighbours and jumping."""
    edges = checkpoint(links.where(F.col("digest") != F.col("root")).select(F.col("digest").alias("a"), F.col("root").alias("b")).distinct())
    both = edges.union(edges.select("b", "a"))
    labels = checkpoint(both.groupBy(F.col("a").alias("digest")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    while True:
        near = both.join(labels.select(F.col("digest").alias("b"), "component"), "b").groupBy(F.col("a").alias("digest")).agg(F.min("component").alias("best"))
        hooked = labels.join(near, "digest").select("digest", F.col("component").alias("old"), F.least("component", "best").alias("component"))
        over = labels.select(F.col("digest").alias("component"), F.col("component").alias("further"))
        jumped = hooked.join(over, "component").select("digest", "old", F.least("component", "further").alias("component"))
        jumped = checkpoint(jumped)
        changed = jumped.where(F.col("old") != F.col("component")).limit(1).count()
        labels = jumped.select("digest", "component")
        if not changed:
            return labels


def _sized(rows: DataFrame) -> DataFrame:
    """(bucket, n) of the buckets with two sets or more; of those that hold the very same sets only one stays."""
    n = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("digest")).alias("x"), F.bit_xor(F.xxhash64("digest", F.lit(1))).alias("y"))
    return n.where(F.col("n") > 1).groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", "n")


def _buckets(rows: DataFrame, sets: DataFrame, full: int) -> DataFrame:
    """(digest, bucket, n): the buckets of each set that are compared, after all splitting."""
    chosen = sets.select("digest", F.explode("paths").alias("bucket"))
    level = checkpoint(chosen.join(_sized(chosen), "bucket").select("digest", "bucket", "n"))
    final = level.where(F.col("n") <= full)
    deep = level.where(F.col("n") > full)
    for depth in range(DEPTH):
        if not deep.limit(1).count():
            return final
        asked = deep.groupBy("digest").agg(F.collect_list(F.struct("bucket", "n")).alias("full"))
        asked = checkpoint(asked.join(sets.select("digest", F.col("own.doc_id").alias("doc_id")), "digest"))
        texts = join_sized(rows, asked, ["doc_id"], "inner", row_bytes=300).select("text", "digest", "full")
        split = checkpoint(texts.mapInArrow(tidy(_split), "digest binary, bucket long, whole long").distinct())
        level = checkpoint(split.join(_sized(split), "bucket"))
        ends = (F.col("n") <= full) | (F.col("n") > ALIKE * F.col("whole")) | F.lit(depth == DEPTH - 1)
        final = final.unionByName(level.where(ends).select("digest", "bucket", "n"))
        deep = level.where(~ends).select("digest", "bucket", "n")
    return final


def _links(rows: DataFrame, sets: DataFrame, threshold: float, full: int) -> DataFrame:
    """(digest, links, root) of all links found between different sets, see _compare."""
    of = _buckets(rows, sets, full).groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("own_buckets"))
    candidates = checkpoint(of.join(sets.select("digest", "copies", F.col("own.doc_id").alias("doc_id")), "digest"))
    filled = join_sized(rows, candidates, ["doc_id"], "inner", row_bytes=400).select("text", "digest", "copies", "own_buckets")
    filled = filled.mapInArrow(tidy(_sets), "digest binary, copies long, own_buckets array<struct<bucket: long, n: long>>, shingles binary")
    at = filled.select("digest", "copies", "shingles", F.col("own_buckets.bucket").alias("buckets"), F.explode("own_buckets").alias("at"))
    at = at.select("*", "at.bucket", F.when(F.col("at.n") > full, F.ceil(F.col("at.n") / (full // 2))).otherwise(1).cast("int").alias("blocks")).drop("at")
    at = at.withColumn("block", F.pmod(F.xxhash64("digest", F.lit(7)), F.col("blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(F.col("block"), o).alias("low"), F.greatest(F.col("block"), o).alias("high")))
    tasks = at.withColumn("pair", F.explode(pairs)).select("digest", "copies", "shingles", "buckets", "bucket", "block", "pair.low", "pair.high")
    return checkpoint(tasks.groupBy("bucket", "low", "high").applyInPandas(lambda g: _compare(g, threshold), "digest binary, links long, root binary"))


def measured_recall(rows: DataFrame, sets: DataFrame, found: DataFrame, threshold: float = THRESHOLD, measured: int = MEASURED, longest: int = 20_000) -> float:
    """The share of links found, of those that about ``measured`` sets, taken by a hash, have to all rows; 1 if they have none.

    These sets, of at most ``longest`` shingles each, go to every task, and each row's set is compared with all of them.
    """
    spark = rows.sparkSession
    share = min(1.0, measured / max(sets.count(), 1))
    picked = sets.where(F.pmod(F.xxhash64(F.lit("measured"), "digest"), F.lit(1 << 20)) < int(share * (1 << 20))).select("digest", "copies", F.col("own.doc_id").alias("doc_id"))
    picked = checkpoint(picked.limit(4 * measured))
    sample = rows.join(F.broadcast(picked), "doc_id").select("text", "digest", "copies").mapInArrow(tidy(_sets), "digest binary, copies long, shingles binary")
    asked = {r["digest"]: (r["copies"], r["shingles"]) for r in sample.where(F.length("shingles") <= 8 * longest).toLocalIterator()}
    asked = {bytes(d): (n, np.frombuffer(x, np.uint64)) for d, (n, x) in asked.items()}
    digests = list(asked)
    owner = np.repeat(np.arange(len(digests)), [len(asked[d][1]) for d in digests])
    keys = np.concatenate([np.zeros(0, np.uint64), *[asked[d][1] for d in digests]])
    order = np.argsort(keys, kind="stable")
    sent = spark.sparkContext.broadcast((keys[order], owner[order], np.array([len(asked[d][1]) for d in digests])))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owner, sizes = sent.value
        links = np.zeros(len(sizes), np.int64)
        for _, texts in slices(batches):
            for s in shingles(texts):
                low, high = np.searchsorted(keys, s), np.searchsorted(keys, s, side="right")
                hit = np.flatnonzero(high > low)
                if len(hit):
                    both = np.bincount(np.concatenate([owner[a:b] for a, b in zip(low[hit].tolist(), high[hit].tolist(), strict=True)]), minlength=len(sizes))
                    links += both * (1 + threshold) >= threshold * (sizes + len(s)) - 1e-3
        yield _rows({"at": np.flatnonzero(links), "links": links[links > 0]}, {"at": pa.int64(), "links": pa.int64()})

    exact = {digests[r["at"]]: r["n"] for r in rows.select("text").mapInArrow(tidy(count), "at long, links long").groupBy("at").agg(F.sum("links").alias("n")).collect()}
    mine = found.join(F.broadcast(picked.select("digest")), "digest").groupBy("digest").agg(F.sum("links").alias("n")).collect()
    got = sum(r["n"] for r in mine if bytes(r["digest"]) in asked)
    want = sum(exact.get(d, 0) - asked[d][0] for d in digests)
    return min(1.0, got / want) if want > 0 else 1.0


def similar_classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, full: int = FULL, runs: int | None = None) -> DataFrame:
    """One row per row of docs: doc_id, text_key (md5 of the text), class_id, links, first.

    Two documents are linked if their sets of five-word shingles (lower case; words are runs of letters, digits
    and _) have a Jaccard similarity of ``threshold`` or more. links counts the other rows that a document is linked to;
    a class is a connected component and class_id its smallest doc_id, null last. Documents of equal sets are one
    set throughout and need no pairs. The runs (``runs_for`` the recall, if not given) are doubled until the measured recall is reached,
    at most three times, and a recall that is lower even then is an error. A document of fewer than five words is one shingle; one without words,
    and a null text, is linked to nothing and its own class. first marks the class's row with the smallest (doc_id, text_key).
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.md5("text"))
    runs = runs or runs_for(recall, threshold)
    own = F.min(F.struct("doc_id", "text_key")).alias("own")
    for _ in range(4):
        sketched = checkpoint(rows.mapInArrow(tidy(_sketch(runs, threshold)), "doc_id long, text_key string, digest binary, paths array<long>"))
        sets = sketched.where(F.col("digest").isNotNull()).groupBy("digest").agg(own, F.count(F.lit(1)).alias("copies"), F.first("paths").alias("paths"))
        sets = checkpoint(sets)
        found = _links(rows, sets, threshold, full)
        if (reached := measured_recall(rows, sets, found, threshold)) >= recall:
            break
        runs *= 2
    else:
        raise RuntimeError(f"{runs // 2} runs reach a recall of {reached:.4f} and not {recall}; give more runs")

    links = found.groupBy("digest").agg(F.sum("links").alias("links"))
    named = _components(found).join(sets.select("digest", "own"), "digest")
    smallest = named.groupBy("component").agg(F.min("own").alias("class"))
    linked = named.join(smallest, "component").select("digest", "class").join(links, "digest", "left")
    classes = checkpoint(sets.select("digest", "own", "copies").join(linked, "digest", "left").select("digest", F.coalesce("class", "own").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")))
    out = sketched.drop("paths").join(classes, "digest", "left")
    me = F.struct("doc_id", "text_key")
    out = out.withColumn("class", F.coalesce("class", me))
    back = lambda c: F.nullif(c, F.lit((1 << 63) - 1))
    return out.select(back(F.col("doc_id")).alias("doc_id"), "text_key", back(F.col("class.doc_id")).alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("links"), (F.col("class") == me).alias("first"))


def linked_documents(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, class_id, links (see similar_classes)."""
    return similar_classes(docs).select("doc_id", "class_id", "links")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each class, all its columns unchanged: that with the smallest doc_id; of fully repeated rows any one.

    Documents without words are classes of their own; those of one doc_id and one text count as one.
    """
    found = checkpoint(similar_classes(docs).where("first").groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("rows")))
    kept_id, kept_key = fresh(docs, "kept_id"), fresh(docs, "kept_key")
    keep = found.select(F.col("doc_id").alias(kept_id), F.col("text_key").alias(kept_key))
    on = F.col("doc_id").cast("long").eqNullSafe(F.col(kept_id)) & (F.md5(F.coalesce("text", F.lit(""))) == F.col(kept_key))
    kept = docs.join(F.broadcast(keep) if keep.count() * 150 <= 64 << 20 else keep, on, "left_semi")
    repeated = found.where(F.col("rows") > 1).limit(1).count()
    return kept.dropDuplicates(["doc_id", "text"]) if repeated else kept

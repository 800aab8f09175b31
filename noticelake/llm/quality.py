"""Quality by an interpolated modified Kneser-Ney character n-gram model of trusted text (operator 8).

The distinct n-grams of a run of texts, with how often trusted ones hold them, are packed by shard. Merged shard
by shard they are the counts of the highest order; the lower orders count left extensions, and a join on the
context and one on the suffix give each n-gram of the corpus, seen in trusted text or not, its interpolated probability.
For scores the runs' n-grams meet the probabilities shard by shard, and the answers meet the run's texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelake.llm.common import checkpoint, fresh, partitions, slices, tidy

ORDER = 5
START, END = "\x02", "\x03"
#: Bytes of text of a run; the runs of a partition are cut the same way whenever it is read.
RUN = 32 << 20
_M = np.uint64(0x9E3779B97F4A7C15)


def _windows(texts: list[str], chars: int = 1 << 18) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Lots of the texts with marks of start and end, the places where an n-gram starts, and the texts these are of; a long text comes in several windows."""
    lots: list[list[int]] = []
    size = 0
    for i, t in enumerate(texts):
        if not lots or size + len(t) > chars:
            lots.append([])
            size = 0
        lots[-1].append(i)
        size += len(t)
    for lot in lots:
        marked = [START * (ORDER - 1) + texts[i] + END for i in lot]
        if len(marked) == 1:
            for i in range(0, len(marked[0]) - ORDER + 1, chars):
                window = marked[0][i : i + chars + ORDER - 1]
                yield window, np.arange(len(window) - ORDER + 1), np.full(len(window) - ORDER + 1, lot[0], np.int32)
        else:
            within = np.repeat(np.arange(len(lot), dtype=np.int32), [len(t) - (ORDER - 1) for t in marked])
            yield "".join(marked), np.arange(len(within)) + within.astype(np.int64) * (ORDER - 1), within + np.int32(lot[0])


def _keys(joined: str) -> np.ndarray:
    """For each place a 64-bit key of the n-gram that starts there."""
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    m = len(code) - ORDER + 1
    key = np.zeros(m, np.uint64)
    for k in range(ORDER):
        key = (key ^ code[k : k + m]) * _M
        key ^= key >> np.uint64(32)
    return key


def _point_keys(points: np.ndarray) -> np.ndarray:
    """The keys of n-grams given as rows of code points."""
    key = np.zeros(len(points), np.uint64)
    for k in range(ORDER):
        key = (key ^ points[:, k].astype(np.uint64)) * _M
        key ^= key >> np.uint64(32)
    return key


def _pack(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x).tobytes(), 3)


def _unpack(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


class Places:
    """Where keys stand in an array of distinct ones in order. Keys are hashes, so their first bits tell the place within a few steps."""

    def __init__(self, keys: np.ndarray):
        bits = len(keys).bit_length() + 1
        self.keys, self.shift = keys, np.uint64(64 - bits)
        before = np.cumsum(np.bincount((keys >> self.shift).view(np.int64), minlength=1 << bits), dtype=np.int32)
        self.first = np.append(np.int32(0), np.minimum(before[:-1], max(len(keys) - 1, 0)))

    def find(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each key its place, or any where there is none, and whether it is there."""
        if not len(self.keys):
            return np.zeros(len(asked), np.int32), np.zeros(len(asked), bool)
        at = self.first[(asked >> self.shift).view(np.int64)]
        late = np.flatnonzero(self.keys[at] < asked)
        for _ in range(16):
            late = late[at[late] < len(self.keys) - 1]
            if not len(late):
                break
            at[late] += 1
            late = late[self.keys[at[late]] < asked[late]]
        if len(late):  # more keys than chance gives begin with the same bits
            at[late] = np.minimum(np.searchsorted(self.keys, asked[late]), len(self.keys) - 1)
        return at, self.keys[at] == asked


class Grams:
    """Distinct n-grams with counts: keys in order, the code points of each and its count.

    An addition holds each key once. Counts of known keys are added where they stand; only new ones wait, for a merge in lots.
    """

    def __init__(self, lot: int = 1 << 18):
        self.keys, self.points, self.n = np.zeros(0, np.uint64), np.zeros((0, ORDER), np.uint32), np.zeros(0, np.int64)
        self.new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.lot, self.rows, self.places = lot, 0, Places(self.keys)

    def count(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Count known keys, in any order and any number of times, where ``counts``; which of them are not known."""
        at, known = self.places.find(keys)
        if (counted := known & counts).any():
            self.n += np.bincount(at[counted], minlength=len(self.n))
        return np.flatnonzero(~known)

    def add(self, keys: np.ndarray, points: np.ndarray, n: np.ndarray) -> None:
        at, known = self.places.find(keys)
        if known.any():
            self.n[at[known]] += n[known]
            keys, points, n = keys[~known], points[~known], n[~known]
        self.new.append((keys, points, n))
        self.rows += len(keys)
        if self.rows > self.lot + len(self.keys) // 8:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.rows:
            keys, first, place = np.unique(np.concatenate([k for k, _, _ in self.new]), return_index=True, return_inverse=True)
            n = np.bincount(place, np.concatenate([n for _, _, n in self.new]), len(keys)).astype(np.int64)
            points = np.concatenate([p for _, p, _ in self.new])[first]
            at = np.searchsorted(self.keys, keys)
            self.keys, self.points, self.n = np.insert(self.keys, at, keys), np.insert(self.points, at, points, axis=0), np.insert(self.n, at, n)
            self.places = Places(self.keys)
        self.new, self.rows = [], 0
        return self.keys, self.points, self.n


def _run_numbers(batches: Iterator[pa.RecordBatch], size: int, partition: str) -> Iterator[tuple[int, pa.RecordBatch, list[str]]]:
    """Rows in order with the number of their run, made of their partition's number and that of the characters before them; batches have no say in it.

    The partition is a column: a task's own number is not it where Spark joins tables in a union.
    """
    before = 0
    for part, texts in slices(batches, chars=1 << 20):
        base = part.column(partition)[0].as_py() << 32
        texts = [t or "" for t in texts]
        starts = before + np.cumsum([0, *[len(t) for t in texts]])
        before = int(starts[-1])
        runs = starts[:-1] // size
        cuts = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), len(texts)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            yield base + int(runs[i]), part.slice(i, j - i), texts[i:j]


ASKED = "run long, shard int, grams binary, n binary"


def _asked(docs: DataFrame, shards: int, size: int = RUN) -> DataFrame:
    """For each run of docs(text, trusted) and each shard its distinct n-grams and how often trusted texts hold them."""

    def rows(run: int, found: Grams) -> pa.RecordBatch:
        keys, points, n = found.merge()
        of = keys % np.uint64(shards)
        order = np.lexsort((*points.T[::-1], of))
        points, n = points[order], n[order]
        cuts = np.searchsorted(of[order], np.arange(shards + 1, dtype=np.uint64)).tolist()
        full = [(s, slice(a, b)) for s, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b]
        columns = [pa.array([run] * len(full), pa.int64()), pa.array([s for s, _ in full], pa.int32())]
        packed = [pa.array([_pack(points[at].T) for _, at in full], pa.binary()), pa.array([_pack(n[at].astype(np.uint32)) for _, at in full], pa.binary())]
        return pa.RecordBatch.from_arrays([*columns, *packed], names=["run", "shard", "grams", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, found = -1, Grams()
        for number, part, texts in _run_numbers(batches, size, "partition"):
            if number != current and current >= 0:
                yield rows(current, found)
                found = Grams()
            current = number
            trusted = part.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
            for joined, at, owner in _windows(texts):
                keys, counts = _keys(joined)[at], trusted[owner]
                if len(new := found.count(keys, counts)):
                    keys, first, place = np.unique(keys[new], return_index=True, return_inverse=True)
                    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
                    found.add(keys, code[at[new[first]][:, None] + np.arange(ORDER)], np.bincount(place[counts[new]], minlength=len(keys)))
        if current >= 0:
            yield rows(current, found)

    return docs.select("text", "trusted", F.spark_partition_id().alias("partition")).mapInArrow(tidy(run), ASKED)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one shard after the other; each of its n-grams comes out once, with its count."""

    def rows(found: Grams) -> Iterator[pa.RecordBatch]:
        _, points, n = found.merge()
        for i in range(0, len(n), 100_000):
            text = np.ascontiguousarray(points[i : i + 100_000], "<u4").tobytes().decode("utf-32-le", "surrogatepass")
            yield pa.RecordBatch.from_arrays([pa.array([text[j : j + ORDER] for j in range(0, len(text), ORDER)], pa.string()), pa.array(n[i : i + 100_000], pa.int64())], names=["gram", "n"])

    shard, found = -1, Grams()
    for b in batches:
        for s, grams, n in zip(b.column("shard").to_pylist(), b.column("grams"), b.column("n"), strict=True):
            if s != shard:
                yield from rows(found)
                shard, found = s, Grams()
            points = np.ascontiguousarray(_unpack(grams.as_py(), np.uint32).reshape(ORDER, -1).T)
            order = np.argsort(keys := _point_keys(points))
            found.add(keys[order], points[order], _unpack(n.as_py(), np.uint32)[order].astype(np.int64))
    yield from rows(found)


def _discount(c: Column, d: list[float]) -> Column:
    return F.when(c == 0, 0.0).when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])


def _discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Modified Kneser-Ney's three discounts from counts of counts; a half of the count where too few n-grams tell."""
    if not (n1 and n2 and n3):
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    return [min(max(k - (k + 1) * y * b / a, 0.05), k) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]


def probabilities(asked: DataFrame) -> DataFrame:
    """(gram, logp) of every n-gram of asked: the interpolated modified Kneser-Ney model of all its trusted text."""
    n = partitions(asked.sparkSession)
    orders = {ORDER: checkpoint(asked.select("shard", "grams", "n").repartition(n, "shard").sortWithinPartitions("shard").mapInArrow(tidy(_merged), "gram string, n long"))}
    for k in range(ORDER - 1, 0, -1):
        orders[k] = checkpoint(orders[k + 1].groupBy(F.substring("gram", 2, k).alias("gram")).agg(F.count_if(F.col("n") > 0).alias("n")))
    below: DataFrame | None = None
    for k in range(1, ORDER + 1):
        rows = orders[k]
        t = rows.agg(*[F.count_if(F.col("n") == i).alias(f"n{i}") for i in (1, 2, 3, 4)], F.sum("n").alias("total"), F.count_if(F.col("n") > 0).alias("kinds")).first()
        d = _discounts(t["n1"], t["n2"], t["n3"], t["n4"])
        c = F.col("n")
        if below is None:
            total, kinds = float(t["total"] or 1), t["kinds"] or 0
            mass = (d[0] * t["n1"] + d[1] * t["n2"] + d[2] * (kinds - t["n1"] - t["n2"])) / total if kinds else 1.0
            p = (c - _discount(c, d)) / total + mass / (kinds + 1)
            below = rows.select("gram", p.alias("p"))
            continue
        rows = rows.select("gram", "n", F.substring("gram", 1, k - 1).alias("context"), F.substring("gram", 2, k - 1).alias("suffix"))
        contexts = rows.where(c > 0).groupBy("context").agg(F.sum("n").alias("total"), (F.sum(_discount(c, d)) / F.sum("n")).alias("mass"))
        rows = rows.join(contexts, "context", "left").join(below.withColumnRenamed("gram", "suffix"), "suffix")
        p = F.when(F.col("total").isNull(), F.col("p")).otherwise((c - _discount(c, d)) / F.col("total") + F.col("mass") * F.col("p"))
        below = checkpoint(rows.select("gram", p.alias("p")))
    return below.select("gram", F.log("p").alias("logp"))


def _by_shard(shards: int):
    """The probabilities, packed by shard: many rows for one shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                keys = _keys("".join(b.column("gram").to_pylist()))[::ORDER]
                value = b.column("logp").to_numpy().astype(np.float32)
                of = (keys % np.uint64(shards)).astype(np.int64)
                found = np.unique(of).tolist()
                packed = [pa.array([x[of == s].tobytes() for s in found], pa.binary()) for x in (keys, value)]
                yield pa.RecordBatch.from_arrays([pa.nulls(len(found), pa.int64()), pa.array(found, pa.int32()), *packed], names=["run", "shard", "grams", "n"])

    return run


def _valued(got: list[tuple[np.ndarray, np.ndarray]]) -> tuple[Places, np.ndarray]:
    keys, values = np.concatenate([k for k, _ in got]), np.concatenate([v for _, v in got])
    order = np.argsort(keys)
    return Places(keys[order]), values[order]


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one shard after the other, its probabilities (without a run) first; each run's n-grams come out with theirs."""
    shard, got, places, values = -1, [], None, None
    for b in batches:
        out = []
        for run, s, grams, n in zip(b.column("run").to_pylist(), b.column("shard").to_pylist(), b.column("grams"), b.column("n"), strict=True):
            if s != shard:
                shard, got, places = s, [], None
            if run is None:
                got.append((np.frombuffer(grams.as_py(), np.uint64), np.frombuffer(n.as_py(), np.float32)))
                continue
            if places is None:
                places, values = _valued(got)
                got = []
            at, known = places.find(_point_keys(np.ascontiguousarray(_unpack(grams.as_py(), np.uint32).reshape(ORDER, -1).T)))
            if not known.all():
                raise KeyError("an n-gram of the corpus has no probability")
            out.append((run, grams.as_py(), _pack(values[at])))
        if out:
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["run", "grams", "data"])


def _carried(size: int, partition: str):
    """The rows, packed, with the numbers of their runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part, _ in _run_numbers(batches, size, partition):
            sink = pa.BufferOutputStream()
            part = part.drop_columns([partition])
            with pa.ipc.new_stream(sink, part.schema) as w:
                w.write_batch(part)
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.nulls(1, pa.binary()), pa.array([zstandard.compress(sink.getvalue(), 3)], pa.binary())], names=["run", "grams", "data"])

    return run


def _scored(kept: list[str], names: list[str]):
    """Rows of one run after the other, its n-grams' probabilities first; its texts' sums come out with the columns ``kept``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, got, places, values = None, [], None, None
        for b in batches:
            for number, grams, data in zip(b.column("run").to_pylist(), b.column("grams"), b.column("data"), strict=True):
                if number != current:
                    current, got, places = number, [], None
                if grams.is_valid:
                    got.append((_point_keys(np.ascontiguousarray(_unpack(grams.as_py(), np.uint32).reshape(ORDER, -1).T)), _unpack(data.as_py(), np.float32)))
                    continue
                if places is None:
                    places, values = _valued(got)
                    got = []
                for part in pa.ipc.open_stream(zstandard.decompress(data.as_py())):
                    texts = [t or "" for t in part.column("text").to_pylist()]
                    nll = np.zeros(len(texts))
                    for joined, at, owner in _windows(texts):
                        place, known = places.find(_keys(joined)[at])
                        if not known.all():
                            raise KeyError("the rows of a run are not those that asked")
                        nll -= np.bincount(owner, values[place].astype(np.float64), len(texts))
                    columns = [part.column(c) for c in kept]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(nll), pa.array([len(t) + 1 for t in texts], pa.int64())], names=names)

    return run


def with_scores(docs: DataFrame, logp: DataFrame, nll: str, chars: str, kept: list[str] | None = None, asked: DataFrame | None = None, size: int = RUN) -> DataFrame:
    """docs (only the columns ``kept``, if given) with the negative log probability of its text and the number of characters that this sums.

    A run's distinct n-grams (``asked``, made here if not given) meet the probabilities shard by shard, and go back to
    the run, where its texts wait. Neither passes through the driver; a task holds one shard of the probabilities
    and one run's. docs is read twice and must have the same rows in the same partitions both times, as a table of files has; else an error tells.
    """
    n = partitions(docs.sparkSession)
    kept = kept or docs.columns
    if asked is None:
        asked = _asked(docs.select("text", F.lit(False).alias("trusted")), n, size)
    packed = logp.mapInArrow(tidy(_by_shard(n)), ASKED)
    both = packed.unionByName(asked).repartition(n, "shard").sortWithinPartitions("shard", F.asc_nulls_first("run"))
    answers = both.mapInArrow(tidy(_answers), "run long, grams binary, data binary")
    partition = fresh(docs, "partition")
    texts = docs.select(*[F.col(f"`{c}`") for c in kept], *([] if "text" in kept else ["text"]), F.spark_partition_id().alias(partition)).mapInArrow(tidy(_carried(size, partition)), "run long, grams binary, data binary")
    rows = answers.unionByName(texts).repartition(n, "run").sortWithinPartitions("run", F.col("grams").isNull())
    fields = {f.name: f for f in docs.schema.fields}
    schema = T.StructType([*[fields[c] for c in kept], T.StructField(nll, T.DoubleType()), T.StructField(chars, T.LongType())])
    return rows.mapInArrow(tidy(_scored(kept, [f.name for f in schema.fields])), schema)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The documents to which labels give quality 1 and toxic 0, and in no row anything else."""
    clean = F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))
    each = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(clean).alias("clean"))
    return each.where("clean").select("doc_id")


def classify(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, prior: float = 200.0, kept: list[str] | None = None, size: int = RUN) -> DataFrame:
    """docs, all columns (or those of ``kept``), with ``perplexity``, ``threshold`` and ``keep`` added (names with _ behind where docs has them).

    Trusted are the documents that labels give quality 1 and toxic 0; a fifth of them, by a hash of doc_id, only sets
    the thresholds, all others train. A document's log perplexity is taken together with ``prior`` characters
    of the mean one of its language, so that a short text is not judged by a few characters. The threshold
    is the language's ``quantile`` over the held-out trusted documents; a language (or null) with too few of
    them to have one beyond it (fewer than 1 / (1 - quantile)) gets its mean times the ``quantile`` of all held-out documents' distances to the means of their languages (without any, the mean
    of those means), and all is kept where nothing is trusted. A null text is empty and
    counts its end alone. Repeated rows stay rows; an empty table gives an empty result.
    """
    ids = checkpoint(trusted_ids(labels))
    mark, nll, chars, limit = (fresh(docs, n) for n in ("trusted", "nll", "scored_chars", "limit"))
    known = ids.select(F.col("doc_id").alias(mark + "_id"), F.lit(True).alias(mark))
    small = ids.count() <= 1_000_000
    flag = lambda df: df.join(F.broadcast(known) if small else known, F.col("doc_id") == F.col(mark + "_id"), "left").drop(mark + "_id")
    apart = F.pmod(F.xxhash64(F.lit("quality"), F.col("doc_id").cast("long")), F.lit(5)) == 0
    flagged = flag(docs)
    if not small:  # a shuffled join gives no order to rely on: written, its rows stay where they are
        flagged = checkpoint(flagged)
        docs = flagged.drop(mark)
    trains = F.coalesce(F.col(mark) & ~apart, F.lit(False))
    asked = checkpoint(_asked(flagged.select("text", trains.alias("trusted")), partitions(docs.sparkSession), size))
    logp = probabilities(asked)
    judges = flagged.where(F.col(mark) & apart).select("lang", "text")
    judged = checkpoint(with_scores(judges, logp, "nll", "chars", ["lang"], size=size).hint("rebalance"))  # few numbers: not a file for each shuffle partition
    means = judged.groupBy("lang").agg((F.sum("nll") / F.sum("chars")).alias("mean"), F.count(F.lit(1)).alias("docs"))
    shrunk = lambda s, n, mean: (s + prior * mean) / (n + prior)
    each = judged.join(means.withColumnRenamed("lang", "l"), F.col("lang").eqNullSafe(F.col("l"))).withColumn("x", shrunk(F.col("nll"), F.col("chars"), F.col("mean")))
    each = checkpoint(each.select("lang", "mean", "docs", "x"))
    table = each.groupBy("lang").agg(F.first("mean").alias("mean"), F.first("docs").alias("docs"), F.percentile_approx("x", quantile, 10_000).alias("limit"))
    table = checkpoint(table.select(F.col("lang").alias(limit + "_lang"), F.col("mean").alias(limit + "_mean"), F.when(F.col("docs") * (1 - quantile) >= 1 - 1e-9, F.col("limit")).alias(limit)))
    above = each.agg(F.percentile_approx(F.col("x") - F.col("mean"), quantile, 10_000)).first()[0]
    overall = table.agg(F.avg(limit + "_mean")).first()[0]
    scored = with_scores(docs, logp, nll, chars, kept, asked, size)
    scored = scored.join(F.broadcast(table) if table.count() <= 10_000 else table, F.col("lang").eqNullSafe(F.col(limit + "_lang")), "left")
    middle = F.coalesce(F.col(limit + "_mean"), F.lit(overall).cast("double"))
    top = F.coalesce(F.col(limit), middle + F.lit(above).cast("double"))
    own = shrunk(F.col(nll), F.col(chars), F.coalesce(middle, F.lit(0.0)))
    out = [F.exp(own).alias(fresh(docs, "perplexity")), F.exp(top).alias(fresh(docs, "threshold")), F.coalesce(own <= top, F.lit(True)).alias(fresh(docs, "keep"))]
    return scored.select(*[F.col(f"`{c}`") for c in kept or docs.columns], *out)


def quality_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, lang, perplexity, threshold, keep (see classify)."""
    return classify(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang"), labels, kept=["doc_id", "lang"])


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, all their columns unchanged, that the classifier keeps."""
    return classify(docs, labels).where(F.col(fresh(docs, "keep"))).select(*[F.col(f"`{c}`") for c in docs.columns])

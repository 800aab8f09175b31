"""Context-triggered piecewise hashing (operator 5).

A rolling hash over seven bytes triggers the ends of chunks; each chunk gives one of 64 characters. A
fingerprint is ``block:chunks at block:chunks at twice the block``; two are compared by edit distance at
the block size that they share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.llm.common import partitions, slices

SMALLEST, WINDOW, LONG = 3, 7, 64
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes that are worked on at a time, so a long text needs little more memory than itself.
BLOCK = 1 << 18
_POWERS: list[np.ndarray] = []  # of the base and of its inverse modulo 2^64


def _powers() -> list[np.ndarray]:
    if not _POWERS:
        for base in (_BASE, _INVERSE):
            steps = np.full(BLOCK + 1, base, np.uint64)
            steps[0] = 1
            _POWERS.append(np.multiply.accumulate(steps))
    return _POWERS


def _rolling(a: np.ndarray) -> np.ndarray:
    """At each byte a hash of the seven bytes that end there: their sum, a weighted sum and a shifted xor."""
    roll, shifted = np.zeros(len(a), np.uint32), np.zeros(len(a), np.uint32)
    for k in range(min(WINDOW, len(a))):
        part = a[: len(a) - k]
        roll[k:] += part * np.uint32(WINDOW - k + 1)
        shifted[k:] ^= part << np.uint32(5 * k)
    return roll + shifted


def _marks(a: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the rolling hash triggers at a block size, and one more than the hash there."""
    places, hashes = [], []
    for start in range(0, len(a), BLOCK):
        before = min(start, WINDOW - 1)
        roll = _rolling(a[start - before : start + BLOCK].astype(np.uint32))[before:]
        at = np.flatnonzero(roll % np.uint32(size) == size - 1)
        places.append(at + start)
        hashes.append(roll[at].astype(np.int64) + 1)
    return np.concatenate(places), np.concatenate(hashes)


def _sums(a: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """At each edge the sum of (byte + 1) times the base's power of its place, of all bytes before it."""
    out, total = np.zeros(len(edges), np.uint64), np.zeros(1, np.uint64)
    for start in range(0, len(a), BLOCK):
        part = a[start : start + BLOCK]
        first, last = np.searchsorted(edges, (start, start + len(part)), side="right")
        cuts = edges[first:last] - start
        terms = (part + np.uint64(1)) * _powers()[0][: len(part)]
        scale = np.uint64(pow(_BASE, start, 1 << 64))
        pieces = np.add.reduceat(terms, np.concatenate(([0], cuts[cuts < len(part)]))) * scale
        upto = total + np.cumsum(pieces)
        out[first:last] = upto[: last - first]
        total = upto[-1:]
    return out


def fingerprint(data: bytes) -> str:
    """Of the whole data, in time in proportion to its length. No data: ``3::``.

    The block size starts from the length; it is doubled while there are more than 64 chunks and halved while there
    are fewer than 32 and half of it gives no more than 64, so no rest of the text is folded into one character. A
    stretch without boundaries is cut into pieces of a fixed length, a sixteenth to an eighth of the text.
    """
    n = len(data)
    if not n:
        return f"{SMALLEST}::"
    a = np.frombuffer(data, np.uint8)
    block = SMALLEST
    while block * LONG < n:
        block *= 2
    piece = 4 * block
    finest = max(SMALLEST, block // 8)
    marks, hashes = _marks(a, finest)
    ends = np.array([0, n])

    def cut(size: int, piece: int) -> np.ndarray:
        """Where chunks start, and the end of the text."""
        nonlocal finest, marks, hashes
        if size < finest:
            finest = max(SMALLEST, size // 8)
            marks, hashes = _marks(a, finest)
        at = marks[hashes % size == 0] + 1
        edges = np.concatenate((ends[:1], at, ends[1:] if not len(at) or at[-1] < n else ends[:0]))
        more = (np.diff(edges) - 1) // piece  # of each chunk so many more pieces
        if not more.any():
            return edges
        first = np.repeat(np.cumsum(more) - more, more)
        return np.sort(np.concatenate((edges, np.repeat(edges[:-1], more) + piece * (np.arange(len(first)) - first + 1))))

    edges = cut(block, piece)
    while len(edges) - 1 > LONG:
        block *= 2
        edges = cut(block, piece)
    while block > SMALLEST and len(edges) - 1 < LONG // 2:
        finer = cut(block // 2, piece)
        if len(finer) - 1 > LONG:
            break
        block, edges = block // 2, finer

    def signature(edges: np.ndarray) -> str:
        sums = _sums(a, edges)
        starts = edges[:-1]
        inverses = _powers()[1][starts] if n <= BLOCK else np.array([pow(_INVERSE, x, 1 << 64) for x in starts.tolist()], np.uint64)
        h = (sums[1:] - sums[:-1]) * inverses
        h ^= h >> np.uint64(29)
        return ALPHABET[((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(58)).astype(np.int64)].tobytes().decode()

    return f"{block}:{signature(edges)}:{signature(cut(2 * block, 2 * piece))}"


def _common(x: str, y: str) -> bool:
    """Whether both have a substring of seven characters (fewer, if one is short) in common; chance does not give that."""
    g = min(WINDOW, max(1, min(len(x), len(y)) // 4))
    return not {x[i : i + g] for i in range(len(x) - g + 1)}.isdisjoint(y[i : i + g] for i in range(len(y) - g + 1))


def _similar(pairs: list[tuple[str, str]]) -> np.ndarray:
    """1 - D / (length + length), where D is the edit distance (a replacement counts 2), for many pairs at once."""
    out = np.zeros(len(pairs))
    todo = [i for i, (x, y) in enumerate(pairs) if x and y and _common(x, y)]
    for part in (todo[i : i + 2048] for i in range(0, len(todo), 2048)):
        x = np.array([list(pairs[i][0].encode().ljust(LONG, b"\1")) for i in part], np.uint8)
        y = np.array([list(pairs[i][1].encode().ljust(LONG, b"\2")) for i in part], np.uint8)
        same = np.zeros((len(part), LONG + 1), np.int16)
        for k in range(LONG):
            met = np.zeros_like(same)
            met[:, 1:] = same[:, :-1] + (y == x[:, k : k + 1])
            same = np.maximum.accumulate(np.maximum(met, same), axis=1)
        total = np.array([len(pairs[i][0]) + len(pairs[i][1]) for i in part])
        out[part] = 2 * same[:, -1] / total
    return out


def likeness(pairs: list[tuple[str, str]]) -> np.ndarray:
    """0 to 1 for each pair of fingerprints; 1 for equal ones, 0 if their block sizes are not within a factor of two."""
    asked: list[tuple[str, str]] = []
    owner: list[int] = []
    out = np.zeros(len(pairs))
    for i, (p, q) in enumerate(pairs):
        if p == q:
            out[i] = 1
            continue
        (b, x, xx), (c, y, yy) = p.split(":"), q.split(":")
        b, c = int(b), int(c)
        for pair in [(x, y), (xx, yy)] if b == c else [(x, yy)] if b == 2 * c else [(xx, y)] if c == 2 * b else []:
            asked.append(pair)
            owner.append(i)
    np.maximum.at(out, owner, _similar(asked))
    return out


def _below(bounds: list[int], key: Column) -> Column:
    """How many of the sorted bounds are smaller than key, in two steps of about the square root of their number."""
    if not bounds:
        return F.lit(0)
    width = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    smaller = lambda array: F.size(F.filter(array, lambda b: b < key))
    whole = smaller(F.array(*[F.lit(g[-1]).cast("long") for g in groups]))  # groups all of which are smaller
    nested = F.array(*[F.array(*[F.lit(b).cast("long") for b in g]) for g in [*groups, []]]) if len(groups) else F.array()
    return (whole * width + smaller(F.get(nested, whole))).cast("int")


def _ordered(docs: DataFrame) -> DataFrame:
    """docs in ranges of doc_id, each range in order and followed by a guest: the first row of the next one.

    Only the bounds of the ranges and the first place in each come to the driver, at most one of each for
    a shuffle partition. The text is shuffled once. The last range's guest is the very first row. A doc_id that so many rows
    have that it fills several ranges is dealt among them by a hash of the text, and is in order by it.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    key = F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long"))
    found = rows.agg(F.percentile_approx(key, [(i + 1) / n for i in range(n - 1)] or [1.0], 10 * n)).first()[0] or []
    found = sorted(found)
    often = {b: found.count(b) for b in set(found) if found.count(b) > 1}
    place = _below(found, F.col("_key"))
    if often:
        share = F.coalesce(F.create_map(*[F.lit(x).cast(t) for b, m in often.items() for x, t in ((b, "long"), (m, "long"))])[F.col("_key")], F.lit(1))
        place = place + F.floor(F.shiftrightunsigned(F.col("_hash"), 1) / F.lit(float(1 << 63)) * share).cast("int")
    # only a doc_id that fills ranges needs the hash; all others are ordered by doc_id and then by text
    spread = F.col("_key").isin(list(often)) if often else F.lit(False)
    placed = rows.withColumn("_key", key).withColumn("_hash", F.when(spread, F.xxhash64("text")).otherwise(F.lit(0)).cast("long"))
    placed = placed.withColumn("_order", F.shiftrightunsigned("_hash", 1)).withColumn("_range", place)
    firsts = sorted((r[0], tuple(r[1])) for r in placed.groupBy("_range").agg(F.min(F.struct("_key", "_order"))).collect())
    # the range before the one that a first place opens
    at = {r: i for i, (r, _) in enumerate(firsts)}
    size = max(at, default=0) + 1
    opens = F.array(*[F.struct(F.lit(firsts[at[r]][1][0]).cast("long").alias("k"), F.lit(firsts[at[r]][1][1]).cast("long").alias("o"), F.lit(firsts[at[r] - 1][0]).alias("r")) if r in at else F.lit(None).cast("struct<k: bigint, o: bigint, r: int>") for r in range(size)])
    mine = F.get(opens, F.col("_range"))
    guest = F.when((mine.k == F.col("_key")) & (mine.o == F.col("_order")), mine.r)
    own, visiting = F.struct(F.col("_range").alias("r"), F.lit(0).alias("g")), F.struct(guest.alias("r"), F.lit(1).alias("g"))
    both = placed.withColumn("_at", F.explode(F.array_compact(F.array(own, F.when(guest.isNotNull(), visiting)))))
    both = both.select("doc_id", "text", "_key", "_order", F.col("_at.r").alias("_range"), F.col("_at.g").alias("_guest"))
    return both.repartitionById(n, "_range").sortWithinPartitions("_range", "_guest", "_key", "_order", "text")


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: tuple | None = None  # the own row that waits for the one after it

    def made(rows: list[tuple]) -> pa.RecordBatch:
        likenesses = [likeness([(r[3], r[4]) for r in rows]), likeness([(r[3], r[5]) for r in rows])]
        columns = zip(*[r[:5] for r in rows], strict=True)
        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(columns, types, strict=True)], *map(pa.array, likenesses)], names=[c.split()[0] for c in SCHEMA.split(", ")])

    for part, texts in slices(batches):
        rows = []
        ids, places, guests = (part.column(c).to_pylist() for c in ("doc_id", "_range", "_guest"))
        for doc_id, text, place, guest in zip(ids, texts, places, guests, strict=True):
            if held and held[2] != place:
                raise ValueError("a range has no guest")
            if guest and not held:
                continue
            own = fingerprint(text.encode())
            if held:
                before_id, before, _, before_print = held
                half = len(before) // 2
                edited = (before[: len(before) - half] + text[:half]).encode()
                rows.append((before_id, len(before), hashlib.sha256(edited).hexdigest(), before_print, fingerprint(edited), own))
            held = None if guest else (doc_id, text, place, own)
        if rows:
            yield made(rows)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """One row per row of docs: the fingerprints of its text and of its edited text, and their likenesses.

    Order is by doc_id, a null one first, ties by text (by a hash of it, where one doc_id has more rows than a range
    holds); the document after the last one is the first, so an only row is followed by itself. A null text is
    empty: it has 0 characters and the fingerprint ``3::``. An empty table gives an empty result; other columns are not read.
    """
    return _ordered(docs).select("doc_id", "text", "_range", "_guest").mapInArrow(_edit, SCHEMA)

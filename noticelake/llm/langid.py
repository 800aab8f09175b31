"""Language identification by language-bitmask n-gram filters (operator 10).

A bit-sliced Bloom filter holds one bit of every language in each of its slots: the AND of an n-gram's few
slots names all languages that contain it. A text's n-grams are counted for each language, the counts are
corrected for the filter's false positives, and the largest decides.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelake.llm.common import checkpoint, fresh, pieces, slices, tidy

ORDERS = (2, 3, 4)
HASHES = 2
#: The chance that an n-gram outside a language passes its filter: what the size is chosen for, and the most that is let happen; the most slots, and those of a block.
FALSE_POSITIVES, TOO_FALSE, MOST_SLOTS, BLOCK = 0.01, 0.25, 1 << 24, 1 << 16
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the keys of all n-grams of the lower-cased texts, and the numbers of the texts they stand in.

    What is not a letter parts words; an n-gram lies in one word, with the marks of its start and end.
    """
    lowered = [f" {t.lower()} " for t in texts]
    code = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in lowered])
    letter = letters()[code]
    keep = letter.copy()  # of each run of other characters in a text one stays
    keep[1:] |= letter[:-1] | (owner[1:] != owner[:-1])
    keep[:1] = True
    code, owner, letter = np.where(letter, code, 32).astype(np.uint64)[keep], owner[keep], letter[keep]
    for n in ORDERS:
        m = len(code) - n + 1
        if m <= 0:
            continue
        key = np.full(m, n, np.uint64)
        whole = np.ones(m, bool)
        for k in range(n):
            key = (key ^ code[k : k + m]) * _M1
            key ^= key >> np.uint64(31)
            if 0 < k < n - 1:
                whole &= letter[k : k + m]
        whole &= letter[:m] | letter[n - 1 : n - 1 + m] if n == 2 else True
        whole &= owner[:m] == owner[n - 1 : n - 1 + m]
        yield key[whole], owner[:m][whole]


def slots(keys: np.ndarray, size: int) -> list[np.ndarray]:
    a = keys * _M2
    step = (a >> np.uint64(7)) | np.uint64(1)
    return [((a + np.uint64(i) * step) >> np.uint64(20)) & np.uint64(size - 1) for i in range(HASHES)]


@dataclass
class Filters:
    """languages in order; masks: for each group of 63 languages an array of a bit mask for each slot."""

    languages: list[str]
    masks: np.ndarray

    def false_positives(self) -> np.ndarray:
        """For each language the chance that an n-gram outside passes: its share of set bits, to the power of the hashes."""
        bits = [np.count_nonzero(self.masks[i // 63] >> np.uint64(i % 63) & np.uint64(1)) for i in range(len(self.languages))]
        return (np.array(bits) / self.masks.shape[1]) ** HASHES

    def shares(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """For each text the number of its n-grams, and for each language the corrected share of those in its filter."""
        total = np.zeros(len(texts))
        hits = np.zeros((len(texts), len(self.languages)))
        for lot in _windows(texts):
            for keys, owner in grams(lot):
                total += np.bincount(owner, minlength=len(texts))
                at = slots(keys, self.masks.shape[1])
                for g, masks in enumerate(self.masks):
                    found = masks[at[0]]
                    for x in at[1:]:
                        found = found & masks[x]
                    for i in range(63 * g, min(63 * g + 63, len(self.languages))):
                        hits[:, i] += np.bincount(owner, (found >> np.uint64(i - 63 * g)) & np.uint64(1), len(texts))
        fp = self.false_positives()
        n = np.maximum(total, 1)[:, None]
        return total, np.clip((hits / n - fp) / np.maximum(1 - fp, 1e-9), 0, 1)


def _windows(texts: list[str | None]) -> Iterator[list[str]]:
    """The texts as one lot; a single one, which may be long, comes in pieces that hold its very n-grams."""
    if len(texts) == 1:
        yield from ([piece] for piece in pieces(texts[0] or ""))
    elif texts:
        yield [t or "" for t in texts]


COUNTED = "gram long, lang string, fold int, n long, texts long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams, and of the texts that hold them, by language and fold, summed over runs of texts before they are shuffled."""
    for part, texts in slices(batches):
        of = pd.MultiIndex.from_arrays([part.column("lang").to_pylist(), part.column("fold").to_pylist()])
        for (lang, fold), rows in pd.Series(range(len(texts))).groupby(of).indices.items():
            for lot in _windows([texts[i] for i in rows]):
                for keys, owner in grams(lot):
                    if len(keys):
                        codes, distinct = pd.factorize(keys)
                        n = np.bincount(codes, minlength=len(distinct))
                        held = np.bincount(pd.unique(codes * np.int64(len(lot)) + owner) // len(lot), minlength=len(distinct))
                        m = len(distinct)
                        columns = [pa.array(distinct.view(np.int64)), pa.array([lang] * m, pa.string()), pa.array(np.full(m, fold, np.int32)), pa.array(n.astype(np.int64)), pa.array(held.astype(np.int64))]
                        yield pa.RecordBatch.from_arrays(columns, names=["gram", "lang", "fold", "n", "texts"])


def held_out(doc_id: Column) -> Column:
    """Documents whose crc32(doc_id as text) is divisible by 5; a null doc_id is one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _counted(labelled: DataFrame) -> DataFrame:
    """(gram, lang, fold, n, texts) of labelled (text, lang, fold); rows with a null in text or lang are left out."""
    counts = labelled.select("text", "lang", "fold").dropna().mapInArrow(tidy(_count), COUNTED)
    return checkpoint(counts.groupBy("gram", "lang", "fold").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts")))


def filter_size(n: int, false_positives: float = FALSE_POSITIVES, most: int = MOST_SLOTS) -> int:
    """Slots (a power of two) for n n-grams at a chance of false positives; with more than ``most`` that chance rises."""
    needed = HASHES * n / -math.log1p(-(false_positives ** (1 / HASHES)))
    return min(most, 1 << max(16, math.ceil(math.log2(max(needed, 1)))))


def least_count(histograms: dict[str, dict[int, int]], most: int = MOST_SLOTS) -> int:
    """How often an n-gram must occur in a language to count: the least power of two with which the filter of ``most`` slots has a chance of false positives of TOO_FALSE at most.

    histograms: for each language how many n-grams occur 2^k to 2^(k + 1) - 1 times. Rare n-grams tell least of a language, and are most of a large corpus; all count as long as they fit.
    """
    room = most * -math.log1p(-(TOO_FALSE ** (1 / HASHES))) / HASHES
    k = 0
    while any(sum(n for b, n in h.items() if b >= k) > room for h in histograms.values()):
        k += 1
    return 1 << k


def _filters(counts: DataFrame, size: int | None, share: float, most: int = MOST_SLOTS) -> Filters:
    """Filters of counts (gram, lang, n, texts). A gram counts only if ``texts`` is over 0 and its language holds it least_count times.

    The bits come to the driver as blocks of 65,536 slots: 8 bytes a slot, of ``most`` slots for 63 languages.
    """
    held = F.col("texts") > 0
    found = counts.groupBy("lang", F.floor(F.log2("n")).cast("int").alias("k")).agg(F.sum("n").alias("total"), F.count_if(held).alias("grams")).collect()
    languages = sorted({r["lang"] for r in found})
    histograms = {x: {r["k"]: r["grams"] for r in found if r["lang"] == x} for x in languages}
    least = least_count(histograms, most)
    size = size or filter_size(max((sum(n for k, n in h.items() if 1 << k >= least) for h in histograms.values()), default=0), most=most)
    if not languages:
        return Filters([], np.zeros((0, size), np.uint64))
    totals = {x: float(sum(r["total"] for r in found if r["lang"] == x)) for x in languages}
    number, total = (F.create_map(*[F.lit(x) for pair in pairs for x in pair]) for pairs in ([(x, i) for i, x in enumerate(languages)], totals.items()))
    rows = counts.select("gram", "n", "texts", number[F.col("lang")].alias("i"), (F.col("n") / total[F.col("lang")]).alias("f"))
    highest = F.max("f").over(Window.partitionBy("gram"))
    rows = rows.withColumn("most", highest).where((F.col("f") >= share * F.col("most")) & held & (F.col("n") >= least))
    masks = rows.groupBy("gram", (F.col("i") / 63).cast("int").alias("part")).agg(F.expr("bit_or(shiftleft(1L, i % 63))").alias("mask"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at = slots(b["gram"].to_numpy().view(np.uint64), size)
            yield pd.DataFrame({"slot": np.concatenate(at).astype(np.int64), "part": np.tile(b["part"], HASHES), "mask": np.tile(b["mask"], HASHES)})

    def block(bits: pa.Table) -> pa.Table:
        out = np.zeros(min(size, BLOCK), np.int64)
        out[bits["slot"].to_numpy() % BLOCK] = bits["mask"].to_numpy()
        return pa.table([bits["part"][:1], bits["block"][:1], pa.array([out.tobytes()])], names=["part", "block", "bits"])

    bits = masks.mapInPandas(place, "slot long, part int, mask long").groupBy("slot", "part").agg(F.bit_or("mask").alias("mask"))
    blocks = bits.withColumn("block", F.expr(f"slot div {BLOCK}")).groupBy("part", "block").applyInArrow(block, "part int, block long, bits binary")
    table = np.zeros(((len(languages) + 62) // 63, size), np.uint64)
    for r in blocks.collect():
        start = r["block"] * BLOCK
        table[r["part"], start : start + BLOCK] = np.frombuffer(r["bits"], np.uint64)
    return Filters(languages, table)


def learn(labelled: DataFrame, size: int | None = None, share: float = 0.2) -> Filters:
    """Filters of all n-grams of all labelled rows (text, lang); rows with a null in either are left out.

    An n-gram belongs to the languages in which its frequency is at least ``share`` of that in the language
    where it is most frequent, so words that strayed into a language do not count. The filter has ``size`` slots,
    or as many as the language with the most n-grams needs (see filter_size), and takes n-grams from a number of occurrences on that lets it serve (see least_count).
    """
    return _filters(_counted(labelled.withColumn("fold", F.lit(0))), size, share)


def fold(text: Column) -> Column:
    """0 or 1, by a hash of the text, so that copies of a text are in one fold."""
    return F.pmod(F.xxhash64(F.lit("language"), text), F.lit(2)).cast("int")


def learn_folds(labelled: DataFrame, size: int | None = None, share: float = 0.2) -> list[Filters]:
    """For each fold the filters that the other fold's rows teach.

    An n-gram counts if three texts of its language hold it; one is enough in a language with fewer than 30
    texts in the fold.
    """
    rows = labelled.select("text", "lang", fold(F.col("text")).alias("fold"))
    counts = _counted(rows)
    sizes = {(r["lang"], r["fold"]): r["count"] for r in rows.dropna().groupBy("lang", "fold").count().collect()}
    out = []
    for other in (1, 0):
        few = [lang for (lang, f), n in sizes.items() if f == other and n < 30]
        enough = (F.col("texts") >= 3) | F.col("lang").isin(few)
        out.append(_filters(counts.where(F.col("fold") == other).withColumn("texts", F.when(enough, F.col("texts")).otherwise(0)), size, share))
    return out


def identify(docs: DataFrame, filters: Filters | list[Filters], lang: str = "lang_pred", score: str = "score", by: str | None = None) -> DataFrame:
    """docs with lang and score added, in a streaming pass over their ``text``.

    lang is ``und`` with score 0 for a null text or one without a letter (or if nothing was learned), else
    the language with the largest corrected share of the text's n-grams, ties to the first by name; score
    is that share. Languages, sources and ids are not read. With ``by``, a column of docs, filters is a list
    and that column says which of them judge a row.
    """
    sent = docs.sparkSession.sparkContext.broadcast(filters if by else [filters])
    schema = T.StructType([*docs.schema.fields, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            judges = part.column(by).to_numpy(zero_copy_only=False) if by else np.zeros(len(texts), np.int64)
            langs, scores = ["und"] * len(texts), np.zeros(len(texts))
            for j, found in enumerate(sent.value):
                rows = np.flatnonzero(judges == j)
                if len(rows) and found.languages:
                    total, shares = found.shares([texts[i] for i in rows])
                    best = shares.argmax(axis=1)
                    for i in np.flatnonzero(total):
                        langs[rows[i]], scores[rows[i]] = found.languages[best[i]], shares[i, best[i]]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(scores)], names=[*part.schema.names, lang, score])

    return docs.mapInArrow(tidy(run), schema)


def language_documents(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score; learned from the documents not held out.

    Null texts are ``und``; null languages teach nothing; repeated rows stay rows; empty tables give an empty
    result; very long texts are read whole; columns other than doc_id, text and lang are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    filters = learn(rows.where(~held_out(F.col("doc_id"))))
    found = identify(rows.select("doc_id", "text"), filters)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.85) -> DataFrame:
    """The rows of docs, all their columns unchanged, whose text is in one of the languages that docs teaches.

    Each text is judged by filters that the other fold taught, so neither it nor a copy of it vouches for itself.
    Rejected are texts without letters and texts with a score under their language's limit. The limit is ``least``
    of the median score of the rows that are labelled with the language and found to be of it, or that median less
    four times its distance to the lower quartile if this is lower; both stand although some of the labelled rows
    are junk. A language with fewer than 20 such rows gets the limit of all of them. A text with letters that nobody can judge stays: one whose
    labelled language the other fold does not teach, and any if that fold teaches none. Null and empty texts go, repeated rows
    stay or go together, and an empty table gives an empty result.
    """
    lang, score, part = fresh(docs, "lang_pred"), fresh(docs, "lang_score"), fresh(docs, "lang_fold")
    filters = learn_folds(docs)
    found = checkpoint(identify(docs.withColumn(part, fold(F.col("text"))), filters, lang, score, part))
    untaught = F.lit(False)
    for j, f in enumerate(filters):
        unknown = F.coalesce(~F.col("lang").isin(f.languages), F.lit(False)) if f.languages else F.lit(True)
        untaught = untaught | ((F.col(part) == j) & unknown)
    untaught = untaught & F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}")
    clean = found.where(F.col("lang") == F.col(lang))
    quartiles = F.percentile_approx(score, [0.25, 0.5], 10_000)
    limit = lambda q: min(least * q[1], q[1] - 4 * (q[1] - q[0]))
    each = {r["l"]: limit(r["q"]) for r in clean.groupBy(F.col(lang).alias("l")).agg(quartiles.alias("q"), F.count(F.lit(1)).alias("n")).where("n >= 20").collect()}
    overall = clean.agg(quartiles).first()[0]
    rest = F.lit(limit(overall) if overall else 0.0)
    limits = F.coalesce(F.create_map(*[F.lit(x) for pair in each.items() for x in pair])[F.col(lang)], rest) if each else rest
    return found.where(untaught | ((F.col(lang) != "und") & (F.col(score) >= limits))).drop(lang, score, part)

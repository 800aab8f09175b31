"""Grouping of spelling variants by a rare-first q-gram prefix filter (operator 13).

One edit changes at most two of a word's bigrams, so two words one edit apart have an unchanged bigram among the
three of each that are rarest over all words. It lies before the edit, where both words begin alike up to it, or
behind it, where they end alike from it: that is the position limit, taken exactly. The rest of the word, which
holds the edit, is limited in turn: its first or its second half is the same. Words that agree in such a key are
compared.
"""

from __future__ import annotations

import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.llm.common import checkpoint, crc32_sql, slices

#: Runs of letters after A to Z, and no other letters, are lower-cased; shorter ones give no word.
RUN = re.compile("[a-zÀ-ÿ]{6,}")
LETTER = re.compile("[A-Za-zÀ-ÿ]")
#: Words have at least so many code points and occur at least so often; a form occurs at least so many times as often as its word.
SHORTEST, RAREST, RATIO = 6, 5, 5
#: One run in so many loses a code point.
DAMAGE = 199
RARE = 3


def runs(text: str, window: int = 1 << 20) -> Iterator[list[str]]:
    """The text's lower-cased runs of SHORTEST or more letters, in lists of those that end in one window of the text."""
    start = 0
    while start < len(text):
        end = min(start + window, len(text))
        while end < len(text) and LETTER.match(text, end - 1):  # no run is cut
            end += 1
        yield RUN.findall(text[start:end].encode().lower().decode())  # of bytes only A to Z become lower case
        start = end


def damaged(prefix: int, run: str) -> str:
    """The lower-cased run, without one code point if crc32 of ``<doc_id>:<run>`` is divisible by DAMAGE. prefix: the crc32 of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), prefix)
    if h % DAMAGE:
        return run
    i = h % len(run)
    return run[:i] + run[i + 1 :]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and their occurrences, summed over many texts before they are shuffled."""
    counts: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
        counts.clear()
        return batch

    for part, texts in slices(batches):
        for doc_id, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
            prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for found in runs(text or ""):
                for run, n in Counter(found).items():
                    word = damaged(prefix, run)
                    if len(word) >= SHORTEST:
                        counts[word] += n
                if len(counts) > 300_000:
                    yield out()
    if counts:
        yield out()


def words(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of docs (doc_id, text) that occur at least RAREST times."""
    counted = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(_count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= RAREST)


def bigrams(word: str) -> list[str]:
    return [word[i : i + 2] for i in range(len(word) - 1)]


def rarest(word: str, frequency: dict[str, int]) -> list[int]:
    """Places of the word's RARE rarest bigrams; ties go to the smaller bigram, then to the earlier place, alike in all words."""
    return [i for _, _, i in sorted((frequency.get(g, 0), g, i) for i, g in enumerate(bigrams(word)))[:RARE]]


def keys(word: str, frequency: dict[str, int]) -> set[tuple[int, str, str]]:
    """(longest, head, tail): what the word may have in common with words one edit away.

    ``longest`` is the length of the longer word of a pair, which is this one or has one code point more. Each of
    the rarest bigrams stands for an edit behind it (the head up to it stays) or before it (the tail from it stays);
    of the code points left, one fewer than the longer word has, the first or the second half stays too.
    """
    found = set()
    n = len(word)
    for i in rarest(word, frequency):
        for longest in (n, n + 1):
            if (left := longest - 1 - (i + 2)) >= 0:
                half = left // 2
                found.add((longest, word[: i + 2 + half], ""))
                found.add((longest, word[: i + 2], word[n - (left - half) :]))
            if (left := longest - 1 - (n - i)) >= 0:
                half = left // 2
                found.add((longest, word[:half], word[i:]))
                found.add((longest, "", word[i - (left - half) :]))
    return found


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): each pair of words exactly one edit apart once, of a checkpointed vocabulary (word, n).

    The bigrams' frequencies, which order them, come to the driver: at most 90 x 90 of them, as words have letters of one range only.
    """
    places = F.sequence(F.lit(1), F.length("word") - 1)
    grams = vocabulary.select(F.explode(F.transform(places, lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("gram"))
    frequency = {r["gram"]: r["count"] for r in grams.groupBy("gram").count().collect()}

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in range(0, b.num_rows, 2000):
                rows = b.slice(start, 2000)
                made: list[tuple[str, bool, str, int]] = []
                for word, n in zip(rows.column("word").to_pylist(), rows.column("n").to_pylist(), strict=True):
                    made += [(f"{m} {head} {tail}", m == len(word), word, n) for m, head, tail in keys(word, frequency)]
                columns = zip(*made, strict=True)
                types = (pa.string(), pa.bool_(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["key", "long", "word", "n"])

    held = vocabulary.mapInArrow(keyed, "key string, long boolean, word string, n long")
    held = held.select(F.xxhash64("key").alias("key"), "long", "word", "n")  # what two keys of one hash bring together fails the comparison
    a = held.where("long").select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    b = held.select("key", "long", F.col("word").alias("b"), F.col("n").alias("n_b"))
    met = a.join(b, (a["key"] == b["key"]) & (~F.col("long") | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "n_a", "b", "n_b").distinct()


def _roots(formed: DataFrame) -> DataFrame:
    """(word, root) of a checkpointed (word, form): where following forms ends.

    A form occurs RATIO times as often as its word, so a chain has at most log(the largest n) links and the
    doublings are known beforehand.
    """
    top = formed.agg(F.max("form_n")).first()[0] or 1
    links, most = 1, top
    while most >= RATIO * RAREST:
        links, most = links + 1, most // RATIO
    chains = formed.select("word", F.col("form").alias("root"))
    covered = 1
    while covered < links:
        ahead = chains.select(F.col("word").alias("root"), F.col("root").alias("next"))
        chains = checkpoint(chains.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
        covered *= 2
    return chains


def group_spellings(docs: DataFrame) -> DataFrame:
    """One row per word of docs: word, form, root, n, n_near, form_n.

    A null or empty text has no words; a null doc_id counts as an empty one; repeated rows count as often as they
    are there; of near words with the same n the first in code-point order is the form; very long texts are read
    whole; an empty table gives an empty result; columns other than doc_id and text are not read.
    """
    vocabulary = checkpoint(words(docs))
    pairs = near_pairs(vocabulary)
    both = F.array(F.struct(F.col("a").alias("word"), F.col("n_b").alias("n"), F.col("b").alias("near")), F.struct(F.col("b").alias("word"), F.col("n_a").alias("n"), F.col("a").alias("near")))
    near = pairs.select(F.inline(both)).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    held = vocabulary.join(near, "word", "left").withColumn("form_n", -F.col("best.less"))
    formed = F.col("form_n") >= RATIO * F.col("n")
    held = checkpoint(held.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best.form")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n")))
    roots = _roots(held.where("form is not null"))
    return held.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: Near words are found by what is left of both without one code point, which is the same.
ORACLE_SQL = f"""WITH RECURSIVE found AS MATERIALIZED (
    SELECT doc_id, translate(run, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
    WHERE length(run) >= {SHORTEST} GROUP BY ALL),
hashed AS MATERIALIZED (SELECT run, n, {crc32_sql("concat(doc_id, ':', run)")} AS h FROM found),
words AS MATERIALIZED (
    SELECT word, sum(n)::BIGINT AS n
    FROM (SELECT n, CASE WHEN h % {DAMAGE} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
    WHERE length(word) >= {SHORTEST} GROUP BY word HAVING sum(n) >= {RAREST}),
cut AS MATERIALIZED (
    SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS MATERIALIZED (
    SELECT a.word AS word, b.word AS near FROM cut a JOIN cut b USING (rest, i) WHERE a.word <> b.word
    UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.rest = w.word
    UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.rest = w.word),
best AS MATERIALIZED (
    SELECT p.word, count(*) AS n_near, max(o.n) AS most, arg_min(p.near, (-o.n, encode(p.near))) AS near FROM pairs p JOIN words o ON o.word = p.near GROUP BY ALL),
held AS MATERIALIZED (
    SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= {RATIO} * n THEN near END AS form, CASE WHEN most >= {RATIO} * n THEN most END AS form_n
    FROM words w LEFT JOIN best USING (word)),
chain AS (
    SELECT word, word AS root FROM held
    UNION ALL SELECT c.word, h.form FROM chain c JOIN held h ON h.word = c.root WHERE h.form IS NOT NULL)
SELECT h.word, h.form, c.root, h.n, h.n_near, h.form_n
FROM held h JOIN chain c ON c.word = h.word JOIN held e ON e.word = c.root WHERE e.form IS NULL"""

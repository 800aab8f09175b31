"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams (operator 12)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.llm.common import checkpoint, join_sized, pieces, slices
from noticelake.llm.langid import held_out

#: Hashed features, and the one beside them that every text has.
SIZE = 1 << 20
BIAS = SIZE
#: Words' openings of these lengths are features as well: a stem speaks in forms never seen.
OPENINGS = range(3, 9)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []
_WORD: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the hash's base and of its inverse, modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        m, made = max(n, 1 << 20), []
        for base in (_BASE, _BACK):
            factors = np.full(m, base, np.uint64)
            factors[0] = 1
            made.append(np.cumprod(factors, dtype=np.uint64))
        _POWERS[:] = made
    return _POWERS[0][:n], _POWERS[1][:n]


def _mixed(keys: np.ndarray, kind: int) -> np.ndarray:
    keys = (keys ^ np.uint64(kind * 0xD6E8FEB86659FD93 % (1 << 64))) * np.uint64(0xC2B2AE3D27D4EB4F)
    keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return ((keys ^ (keys >> np.uint64(32))) & np.uint64(SIZE - 1)).astype(np.int64)


def features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(numbers of texts, hashed features) for words, for two words in a row, for two with one between, and for each length of openings.

    A word is a run of letters and digits, lower-cased. A feature comes as often as it stands in the text.
    """
    if not _WORD:
        _WORD.append(np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000))
    lowered = [f" {t.lower()} " for t in texts]
    code = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _WORD[0][code]
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])[starts]
    power, back = _powers(len(code) + 1)
    sums = np.zeros(len(code) + 1, np.uint64)
    np.cumsum((code + np.uint64(1)) * power[:-1], out=sums[1:])

    def hashed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (sums[b] - sums[a]) * back[a]

    words = hashed(starts, ends)
    out = [(owner, _mixed(words, 1))]
    for kind, far in ((2, 1), (3, 2)):
        if len(words) > far:
            within = owner[:-far] == owner[far:]
            out.append((owner[far:][within], _mixed(words[:-far] * np.uint64(_BASE) + words[far:], kind)[within]))
    for n in OPENINGS:
        long = ends - starts >= n
        out.append((owner[long], _mixed(hashed(starts[long], starts[long] + n), 3 + n)))
    return out


def _lots(texts: list[str | None], chars: int = 1 << 20) -> Iterator[list[str]]:
    """The texts as one lot; a single one, which may be long, comes in pieces that begin with the last two words of the piece before, so that no feature is lost."""
    if len(texts) == 1 and len(texts[0] or "") > chars:
        tail = ""
        for piece in pieces(texts[0], chars):
            whole = tail + piece
            yield [whole]
            tail = _last_words(whole)
    elif texts:
        yield [t or "" for t in texts]


def _last_words(text: str) -> str:
    """The end of the text from its last word but one."""
    at = len(text)
    for _ in range(2):
        while at and not text[at - 1].isalnum():
            at -= 1
        while at and text[at - 1].isalnum():
            at -= 1
    return text[at:]


@dataclass
class Ftrl:
    """The state of each coordinate. alpha, beta: its learning rate; l1 keeps weak ones at 0, but for the bias; l2 keeps all small."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.1

    def __post_init__(self):
        self.z, self.n = np.zeros(SIZE + 1), np.zeros(SIZE + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        l1 = np.where(at == BIAS, 0, self.l1)
        return np.where(np.abs(z) > l1, (np.sign(z) * l1 - z) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2), 0)

    def start(self, at: np.ndarray, w: np.ndarray, n: np.ndarray) -> None:
        """Go on from given weights and sums of squared gradients."""
        self.n[at] = n
        self.z[at] = -w * ((self.beta + np.sqrt(n)) / self.alpha + self.l2) - np.where(at == BIAS, 0, np.sign(w) * self.l1)

    def learn(self, at: np.ndarray, label: int) -> None:
        """One step for a text with these distinct features (the bias among them)."""
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
        n = self.n[at]
        more = n + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(n)) / self.alpha * w
        self.n[at] = more


def _distinct(texts: list[str | None], wanted: np.ndarray | None = None) -> list[np.ndarray]:
    """For each text its distinct features, or those of them that are wanted (a flag a feature)."""
    found: list[np.ndarray] = []
    for lot in _lots(texts):
        for owner, feature in features(lot):
            key = owner * SIZE + feature
            found.append(np.unique(key if wanted is None else key[wanted[feature]]))
    keys = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return np.split(keys % SIZE, np.searchsorted(keys, np.arange(1, len(texts)) * SIZE))


#: A model: its coordinates, their weights and sums of squared gradients.
Model = tuple[np.ndarray, np.ndarray, np.ndarray]
NOTHING: Model = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
WEIGHTS = "at long, w double, n double"
#: Features held at a time while a task goes over them ``passes`` times: 64 MB.
HELD = 1 << 24


def labelled(docs: DataFrame, labels: DataFrame, most: int = 1 << 18) -> DataFrame:
    """(doc_id, text, label) of the rows of docs that teach: not held out, and labelled toxic or not, but not both.

    Of more than ``most`` labelled ids about so many are taken, by a hash of the id: this bounds what is joined, shuffled and learned.
    """
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label")).where("label in (0, 1) and doc_id is not null")
    ids = ids.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    ids = checkpoint(ids)
    if (n := ids.count()) > most:
        ids = ids.where(F.shiftrightunsigned(F.xxhash64(F.lit("taught"), "doc_id"), 11) / F.lit(float(1 << 53)) < most / n)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return join_sized(rows, checkpoint(ids), ["doc_id"], "inner", row_bytes=64)


def learn(rows: DataFrame, rounds: int = 2, passes: int = 3, shard: int = 8192) -> Model:
    """Weights from rows (doc_id, text, label), by rounds of parameter mixing.

    Rows are dealt into shards of about ``shard`` rows. Each learns its rows, starting from the weights of the round before, and sends its weights
    that are not 0. A coordinate gets the mean of those it was sent if at least half of the shards sent one. The model has at most SIZE
    coordinates, and L1 leaves a few hundred to thousands of them.
    """
    shards = -(-rows.count() // shard)
    if not shards:
        return NOTHING
    dealt = checkpoint(rows.repartition(shards).sortWithinPartitions(F.xxhash64("doc_id"), "text", "label"))
    model = NOTHING

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ftrl = Ftrl()
        ftrl.start(*model)
        held: list[tuple[np.ndarray, int]] = []
        size = taught = 0

        def teach() -> None:
            for _ in range(passes):
                for at, label in held:
                    ftrl.learn(at, label)
            held.clear()

        for part, texts in slices(batches):
            for at, label in zip(_distinct(texts), part.column("label").to_pylist(), strict=True):
                held.append((np.append(at, BIAS).astype(np.int32), label))
                size += len(at)
                taught += 1
                if size > HELD:
                    teach()
                    size = 0
        teach()
        if taught:
            at = np.flatnonzero(ftrl.weights(np.arange(SIZE + 1)))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(ftrl.weights(at)), pa.array(ftrl.n[at])], names=["at", "w", "n"])

    for _ in range(rounds):
        sent = dealt.select("text", "label").mapInArrow(run, WEIGHTS)
        mixed = sent.groupBy("at").agg(F.avg("w").alias("w"), F.avg("n").alias("n"), F.count(F.lit(1)).alias("shards")).where(F.col("shards") * 2 >= shards)
        found = mixed.select("at", "w", "n").orderBy("at").toArrow()
        model = tuple(found.column(c).to_numpy() for c in ("at", "w", "n"))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of docs (doc_id, text), in a streaming pass; the score is 0 if nothing was learned. Only the coordinates and their weights are sent to the tasks."""
    sent = docs.sparkSession.sparkContext.broadcast(model[:2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w = sent.value
        weights = np.zeros(SIZE + 1)
        weights[at] = w
        wanted = weights[:SIZE] != 0
        for part, texts in slices(batches):
            sums = np.array([weights[BIAS] + weights[found].sum() for found in _distinct(texts, wanted)])
            scores = 1 / (1 + np.exp(-np.clip(sums, -30, 30))) if len(at) else np.zeros(len(sums))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    return docs.mapInArrow(run, "doc_id long, score double")


def toxicity_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted.

    Labels teach only where they are not held out; a null label, a label of a document that is not there and one of an id that is labelled both
    ways teach nothing; repeated labels count once, and repeated rows of docs each teach and are scored. A null or empty text
    has the score of the bias; a row with a null doc_id is held out; without labels all scores are 0; empty tables give an empty result; very long
    texts are read whole; columns other than doc_id, text and toxic are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = score(rows, learn(labelled(docs, labels)))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

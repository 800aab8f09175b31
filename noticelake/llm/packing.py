"""Hierarchical multi-length packing (operator 2).

Every task tokenizes its rows and packs them by itself, so no row is shuffled. A document's ids are cut
at the longest context size; what is left over is routed to the tier of the smallest context size that
holds it. A window is opened by the longest waiting piece, and its gap is filled from its own tier and the
shorter ones, longest fitting piece first; what still fits nothing is filled by cutting a shorter
piece. Full windows leave at once, so a task holds a bounded number of ids, however many it reads.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_right, insort
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.llm.common import give_back, tidy

SEPARATOR = 1
TIERS = (128, 256, 512, 1024, 2048)
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, context int, step_group long"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]

_MARKS = "".join(chr(i) for i in range(33, 127) if chr(i) != "'" and not chr(i).isalnum())
_PLAIN = "^[A-Za-zªµºÀ-ÖØ-öø-įı-ſ]*$"
_ENCODERS: dict[str, "WordEncoder"] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of ranges, one range after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class WordEncoder:
    """Ids of texts, word by word, from the tokenizer file's own model.

    The tokenizer splits at white space before anything else, so a text's ids are those of its
    blank-parted chunks in a row. Each distinct chunk of a lot of texts is looked at once. One of plain Latin
    letters with punctuation behind is parted into these two, and they go to the model straight, a word once for
    all its spellings in capitals; any other one goes through the whole tokenizer. The ids of pieces met before are kept,
    those met last if there are over ``most``.
    """

    def __init__(self, path: str, most: int = 300_000):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.most, self.lots = most, 0
        self.known, self.met = pa.array([], pa.string()), np.zeros(0, np.int64)
        self.ids, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int32)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.bytes_as = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in visible)}

    def _piece(self, piece: str) -> list[int]:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(self.bytes_as)
        return [t.id for t in self.model.tokenize(piece)] if piece else []

    def _learn(self, new: pa.StringArray) -> None:
        plain = pc.match_substring_regex(pc.ascii_rtrim(new, characters=_MARKS), _PLAIN).to_pylist()
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(new)], pa.int32()), new), " ")[0].as_py().split(" ")  # no chunk holds a blank
        ids, lengths = array("I"), []
        for text, direct in zip(texts, plain, strict=True):
            found = self._piece(text) if direct else self.whole.encode(text, add_special_tokens=False).ids
            ids.extend(found)
            lengths.append(len(found))
        self.known, self.met = pa.concat_arrays([self.known, new]), np.append(self.met, np.full(len(new), self.lots))
        self.ids, self.lengths = np.append(self.ids, np.asarray(ids, np.uint32)), np.append(self.lengths, np.asarray(lengths, np.int32))

    def _look_up(self, pieces: pa.StringArray) -> np.ndarray:
        """The numbers of distinct pieces among those known."""
        self.lots += 1
        at = pc.index_in(pieces, value_set=self.known)
        if at.null_count and len(self.known) + at.null_count > self.most and len(self.known):
            self.met[at.drop_null().to_numpy()] = self.lots
            left = np.sort(np.argsort(-self.met, kind="stable")[: max(self.most // 2, len(at) - at.null_count)])
            starts = np.cumsum(self.lengths, dtype=np.int64) - self.lengths
            self.ids = self.ids[_places(starts[left], self.lengths[left])]
            self.known, self.met, self.lengths = self.known.take(pa.array(left)), self.met[left], self.lengths[left]
            at = pc.index_in(pieces, value_set=self.known)
        found = pc.fill_null(at, -1).to_numpy().copy()
        self.met[found[found >= 0]] = self.lots
        if at.null_count:
            found[found < 0] = np.arange(len(self.known), len(self.known) + at.null_count)
            self._learn(pieces.filter(pc.is_null(at)))
        return found

    def _chunks(self, chunks: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of distinct chunks, where each one's start there and how many it has."""
        words = pc.ascii_rtrim(chunks, characters=_MARKS)
        plain = pc.match_substring_regex(words, _PLAIN)
        size = pc.binary_length(chunks).to_numpy()
        behind = np.where(plain.to_numpy(zero_copy_only=False), size - pc.binary_length(words).to_numpy(), 0)
        _, offsets, data = chunks.buffers()
        starts = np.frombuffer(offsets, np.int32)[chunks.offset : chunks.offset + len(chunks)]
        marks = np.frombuffer(data, np.uint8)[_places(starts + size - behind, behind)] if behind.any() else np.zeros(0, np.uint8)
        marks = pa.StringArray.from_buffers(len(chunks), pa.py_buffer(np.append(0, np.cumsum(behind)).astype(np.int32)), pa.py_buffer(marks))
        pieces = pa.concat_arrays([pc.if_else(plain, pc.utf8_lower(words), chunks), marks]).dictionary_encode()
        at = self._look_up(pieces.dictionary)[pieces.indices.to_numpy().reshape(2, -1).T]
        lengths = self.lengths[at]
        starts = np.cumsum(self.lengths, dtype=np.int64) - self.lengths
        ids = self.ids[_places(starts[at].ravel(), lengths.ravel())]
        lengths = lengths.sum(1)
        return ids, np.cumsum(lengths) - lengths, lengths

    def encode_all(self, texts: pa.StringArray) -> Iterator[np.ndarray]:
        """The ids of each text; what is held beside grows with all texts together."""
        parts = pc.ascii_split_whitespace(texts)
        offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        parts = parts.flatten().dictionary_encode()
        ids, starts, lengths = self._chunks(parts.dictionary)
        of = parts.indices.to_numpy()
        for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            at = of[i:j]
            yield ids[_places(starts[at], lengths[at])]

    def encode(self, text: str, chars: int = 1 << 20) -> np.ndarray:
        parts, start = [], 0
        while len(text) - start > chars:  # a long text comes in windows that end at a blank
            stop = max(text.rfind(" ", start, start + chars), text.rfind("\n", start, start + chars))
            if stop < 0:
                break
            parts.append(self._encode(text[start:stop]))
            start = stop + 1
        parts.append(self._encode(text[start:] if start else text))
        return np.concatenate(parts) if len(parts) > 1 else parts[0]

    def _encode(self, text: str) -> np.ndarray:
        return next(self.encode_all(pa.array([text], pa.string())))


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


class Waiting:
    """Pieces by length, longest fitting first; equal lengths in the order in which they came."""

    def __init__(self):
        self.by: dict[int, deque] = {}
        self.lengths: list[int] = []
        self.ids = 0

    def put(self, piece: tuple) -> None:
        n = piece[2]
        if n not in self.by:
            self.by[n] = deque()
            insort(self.lengths, n)
        self.by[n].append(piece)
        self.ids += n

    def take(self, most: int) -> tuple | None:
        k = bisect_right(self.lengths, most)
        if not k:
            return None
        n = self.lengths[k - 1]
        piece = self.by[n].popleft()
        if not self.by[n]:
            del self.by[n]
            self.lengths.pop(k - 1)
        self.ids -= n
        return piece


class Packer:
    """Packs pieces (doc, start, length) into windows of the tiers' sizes; ``full`` gets (context, pieces)."""

    def __init__(self, tiers: Iterable[int] = TIERS, hold: int = 1 << 20):
        self.tiers, self.hold = sorted(tiers), hold
        self.waiting = Waiting()
        self.full: list[tuple[int, list[tuple]]] = []

    def add(self, doc: int, n: int) -> None:
        longest = self.tiers[-1]
        whole = n - n % longest
        for start in range(0, whole, longest):
            self.full.append((longest, [(doc, start, longest)]))
        if n > whole:
            self.waiting.put((doc, whole, n - whole))
        if self.waiting.ids > self.hold:
            self.pack(self.hold // 2)

    def _fill(self, context: int, first: tuple) -> None:
        window, gap = [first], context - first[2]
        while gap:
            piece = self.waiting.take(gap)
            if piece is None:  # only longer ones wait: cut the shortest of them
                piece = self.waiting.take(self.waiting.lengths[0])
                doc, start, n = piece
                self.waiting.put((doc, start + gap, n - gap))
                piece = (doc, start, gap)
            window.append(piece)
            gap -= piece[2]
        self.full.append((context, window))

    def pack(self, leave: int = 0) -> None:
        while self.waiting.ids > leave:
            if leave and self.waiting.ids < self.tiers[-1]:
                return  # more is to come that fills the gap
            first = self.waiting.take(self.tiers[-1])
            context = next(t for t in self.tiers if t >= first[2])
            while context > first[2] and self.waiting.ids < context - first[2]:
                # too few ids are left for this tier: cut down to the largest tier that the piece fills
                smaller = [t for t in self.tiers if t <= first[2]]
                if not smaller:
                    break
                doc, start, n = first
                context = smaller[-1]
                if n > context:
                    self.waiting.put((doc, start + context, n - context))
                first = (doc, start, context)
            if self.waiting.ids < context - first[2]:  # the last ids of all: one padded window
                window = [first]
                while (piece := self.waiting.take(self.tiers[-1])) is not None:
                    window.append(piece)
                self.full.append((self.tiers[-1], window))
                return
            self._fill(context, first)


def _encoded(enc: WordEncoder, batches: Iterable[pa.RecordBatch], lot: int = 1 << 22) -> Iterator[tuple[int | None, np.ndarray]]:
    """Each row's first column and the ids of its second, a text; texts go to the encoder in lots of about so many bytes, one of half as many or more alone."""
    for b in batches:
        if not b.num_rows:
            continue
        size = pc.binary_length(b.column(1)).to_numpy().astype(np.int64)
        alone = size >= lot // 2
        lots = np.cumsum(np.where(alone, 0, size)) // lot
        cuts = np.flatnonzero((np.diff(lots) != 0) | alone[1:] | alone[:-1]) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(size)], strict=True):
            part = b.slice(i, j - i)
            if j - i == 1:
                found = [enc.encode(t.as_py()) for t in part.column(1)]
            else:
                found = enc.encode_all(part.column(1).cast(pa.string()))
            yield from zip(part.column(0).to_pylist(), found, strict=True)
            found = None
            give_back()  # else what a lot took stands beside what the next one takes


def _pack(batches: Iterable[pa.RecordBatch], tokenizer: str, tiers: tuple, group_tokens: int, partition: int) -> Iterator[pa.RecordBatch]:
    enc, packer = encoder(tokenizer), Packer(tiers)
    docs: dict[int, tuple] = {}
    left: dict[int, int] = {}
    serial, sequences, longest = 0, 0, max(tiers)
    groups: dict[int, list[int]] = {}  # tier -> [windows in its open step group, number of that group]
    group = 0
    base = partition << 32

    def flush() -> pa.RecordBatch:
        nonlocal sequences, group
        rows = []
        for context, window in packer.full:
            open_group = groups.get(context)
            if open_group is None or open_group[0] * context >= group_tokens:
                groups[context] = open_group = [0, group]
                group += 1
            open_group[0] += 1
            offset = 0
            for doc, start, n in window:
                doc_id, ids = docs[doc]
                rows.append((doc_id, start, n, zlib.crc32(ids[start : start + n]), len(ids), base + sequences, offset, context, base + open_group[1]))
                offset += n
                left[doc] -= n
                if not left[doc]:
                    del docs[doc], left[doc]
            sequences += 1
        packer.full.clear()
        columns = zip(*rows, strict=True) if rows else [[]] * len(NAMES)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "context" else pa.int64()) for n, c in zip(NAMES, columns, strict=True)], names=NAMES)

    for doc_id, ids in _encoded(enc, batches):
        ids = np.append(ids, np.uint32(SEPARATOR)).astype("<u4", copy=False)
        docs[serial] = (doc_id, ids)
        left[serial] = len(ids)
        packer.add(serial, len(ids))
        serial += 1
        if len(packer.full) * longest > 1 << 20:
            yield flush()
    packer.pack()
    yield flush()


def pack_documents(docs: DataFrame, tokenizer: str | None = None, tiers: tuple = TIERS, group_tokens: int = 1 << 16) -> DataFrame:
    """Pieces of packed sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, context, step_group.

    Every row of docs is one document of its own, repeated rows and a null doc_id too; a null or empty text
    is the separator alone; an empty table gives an empty result; other columns are not read. Each id lies
    in exactly one piece. A sequence has ``context`` places, and all but the last one of a task are full. A
    step group holds windows of one context and as many of them as make up ``group_tokens`` places, so the
    groups of all tiers weigh the same. The ids of sequences and groups start with the task's number.
    """
    tokenizer = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        yield from _pack(batches, tokenizer, tiers, group_tokens, TaskContext.get().partitionId())

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(tidy(run), SCHEMA)

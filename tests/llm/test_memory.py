"""What the Python workers of the pipeline's stages hold."""

import random
import re
import subprocess
import sys
import tracemalloc
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from noticelake.llm import quality
from noticelake.llm.common import tidy

MB = 1 << 20


class Caught:
    """Stands for a DataFrame and keeps the function that its tasks would run."""

    def select(self, *columns):
        return self

    def mapInArrow(self, f, schema):  # noqa: N802
        self.run = f
        return self


def held() -> float:
    return sum(map(int, re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def prose(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(3, 9))) for _ in range(8000)]
    return [" ".join(rng.choices(words, k=500)) for _ in range(n)]


def asking(texts: list[str]) -> tuple:
    """The function that gathers a run's n-grams, and its input."""
    df = Caught()
    quality._asked(df, 3)
    columns = [pa.array(texts), pa.array([i % 3 == 0 for i in range(len(texts))]), pa.array([7] * len(texts), pa.int64())]
    return df.run, pa.RecordBatch.from_arrays(columns, names=["text", "trusted", "partition"])


def test_gathering_the_ngrams_of_a_run_takes_little_beside_them(spark):
    run, batch = asking(prose(2000, 1))
    tracemalloc.start()
    try:
        out = list(run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    grams = sum(len(quality._unpack(n, np.uint32)) for b in out for n in b.column("n").to_pylist())
    assert grams > 100_000 and peak < 40 * MB + 100 * grams, (peak / MB, grams)


def test_known_ngrams_are_not_sorted_again(monkeypatch):
    run, batch = asking(prose(1500, 3))
    sizes, unique = [], np.unique
    monkeypatch.setattr(np, "unique", lambda x, *more, **named: sizes.append(len(x)) or unique(x, *more, **named))
    list(run(iter([batch])))
    assert sum(sizes) < sum(map(len, batch.column("text").to_pylist())) // 2, sizes


@pytest.mark.parametrize("bits", [64, 20, 6])
def test_places_of_keys(bits):
    rng = np.random.default_rng(bits)
    keys = np.unique(np.append(rng.integers(0, (1 << bits) - 1, 5000, np.uint64, endpoint=True), [np.uint64(0), np.uint64((1 << 64) - 1)]))
    for held_keys in (keys, keys[1:-1], keys[:1], keys[-1:], keys[:0]):
        asked = rng.permutation(np.concatenate([keys, keys + np.uint64(1), keys]))
        at, known = quality.Places(held_keys).find(asked)
        assert (known == np.isin(asked, held_keys)).all() and (held_keys[at[known]] == asked[known]).all()


def test_ngrams_are_counted_once_each_however_they_are_merged():
    rng = random.Random(2)
    for lot in (0, 3, 50, 1 << 18):
        found, want = quality.Grams(lot), Counter()
        for _ in range(40):
            some = rng.sample(range(200), rng.randrange(30))
            n = [rng.randrange(4) for _ in some]
            want.update(dict(zip(some, n, strict=True)))
            points = np.array(some, np.uint32).reshape(-1, 1) + np.zeros(quality.ORDER, np.uint32)
            found.add(np.array(some, np.uint64) * 7, points, np.array(n, np.int64))
        keys, points, n = found.merge()
        assert keys.tolist() == sorted(7 * k for k in want) and (points == keys[:, None] // 7).all()
        assert dict(zip((keys // 7).tolist(), n.tolist(), strict=True)) == dict(want)
    assert [len(x) for x in quality.Grams().merge()] == [0, 0, 0]


def test_lots_of_texts_hold_each_ngram_once():
    texts = ["", "abc", "x" * 30, "", "de", "y" * 9, "z" * 100]
    want = [(i, m[k : k + quality.ORDER]) for i, t in enumerate(texts) for m in [quality.START * (quality.ORDER - 1) + t + quality.END] for k in range(len(m) - quality.ORDER + 1)]
    for chars in (1, 4, 10, 33, 1 << 18):
        assert [(int(o), joined[a : a + quality.ORDER]) for joined, at, owner in quality._windows(texts, chars) for a, o in zip(at, owner, strict=True)] == want
    assert list(quality._windows([])) == []


FREES = """
import numpy as np
from tests.llm.test_memory import held, tidy

def work(batches):
    arrays = [np.ones(100_000, np.uint8) for _ in range(2000)]
    kept.append(np.ones(100_000, np.uint8))  # stands at the heap's end, so that what is under it stays
    yield from batches

kept = []
before = held()
list(tidy(work)(iter([])))
print(held() - before)
"""


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_a_worker_gives_back_what_a_task_freed():
    done = subprocess.run([sys.executable, "-c", FREES], capture_output=True, text=True, check=True, cwd=Path(__file__).parents[2])
    assert float(done.stdout) < 25, done.stdout


ENCODES = """
import pyarrow as pa
from noticelake.llm import packing
from noticelake.llm.common import give_back
from tests.llm.test_memory import held, prose

enc = packing.encoder(packing.default_tokenizer())
batch = pa.RecordBatch.from_arrays([pa.array(range(3500)), pa.array(prose(3500, 5))], names=["doc_id", "text"])
give_back()
before = held()
ids = sum(len(x) for _, x in packing._encoded(enc, [batch]))
print(held() - before)
"""


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_the_encoder_gives_back_what_a_lot_took():
    done = subprocess.run([sys.executable, "-c", ENCODES], capture_output=True, text=True, check=True, cwd=Path(__file__).parents[2])
    assert float(done.stdout) < 12, done.stdout


def test_tidy_passes_rows_and_errors_on():
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2])], names=["a"])
    assert list(tidy(lambda batches: (b.slice(1) for b in batches))(iter([batch]))) == [batch.slice(1)]
    with pytest.raises(ZeroDivisionError):
        list(tidy(lambda batches: (1 // 0 for _ in batches))(iter([batch])))


def test_scores_of_the_judges_are_not_a_file_for_each_shuffle_partition(spark, monkeypatch):
    written, checkpoint = {}, quality.checkpoint

    def noted(df):
        done = checkpoint(df)
        written[tuple(done.columns)] = done.rdd.getNumPartitions()
        return done

    monkeypatch.setattr(quality, "checkpoint", noted)
    n = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(prose(40, 4))], "doc_id long, text string, lang string")
        labels = docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic")
        assert quality.classify(docs, labels).count() == 40
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", n)
    assert written["lang", "nll", "chars"] == 1, written

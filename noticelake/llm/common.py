"""Small helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import functools
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and read it back, so that a lost executor costs no recomputation.

    The folder is the cluster's ``spark.checkpoint.dir``. Where none is set, one is made on a local master (tests);
    on a cluster that is an error, as executors do not share the driver's folders.
    """
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="noticelake-")
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", chars: int = 1 << 19, records: int = 1000) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Runs of rows of a bounded number of bytes of ``column``, at least one row each, with that column's values.

    Only a run's values are Python objects at a time, however large the batch is that holds them.
    """
    for b in batches:
        lengths = pc.fill_null(pc.binary_length(b.column(column)), 0).to_pylist()
        start = size = 0
        for i, n in enumerate(lengths):
            if i > start and (size + n > chars or i - start >= records):
                yield b.slice(start, i - start), b.column(column).slice(start, i - start).to_pylist()
                start, size = i, 0
            size += n
        if start < len(lengths):
            yield b.slice(start), b.column(column).slice(start).to_pylist()


def give_back() -> None:
    """Return what this process has freed to the system: the C library and Arrow's pool keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, for mapInArrow, with the memory of its arrays given back at its end: Python workers live on for the next tasks, and idle beside those of other stages."""

    @functools.wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def pieces(text: str, chars: int = 1 << 20) -> Iterator[str]:
    """The text in pieces of at most so many characters, each but the last ending at a character that no word holds.

    Only a word of more than 4096 characters may be cut, at the same place in equal texts.
    """
    start = 0
    while len(text) - start > chars:
        end = start + chars
        stop = next((i for i in range(end, max(start, end - 4096), -1) if not (text[i - 1].isalnum() or text[i - 1] == "_")), end)
        yield text[start:stop]
        start = stop
    yield text[start:]


def join_sized(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", max_bytes: int = 64 << 20, row_bytes: int = 200) -> DataFrame:
    """Join to a checkpointed side: broadcast it if its counted rows of about ``row_bytes`` fit into ``max_bytes``, else shuffle both.

    The count is of a table already written, so it costs one pass over that small table; above the bound
    Spark's own join (with adaptive skew splitting) takes over.
    """
    return left.join(F.broadcast(right) if right.count() * row_bytes <= max_bytes else right, on, how)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc32_sql(text: str) -> str:
    """A DuckDB expression for the unsigned crc32 of a text's UTF-8 bytes (null: null), by its definition: a table of the remainders of all half bytes."""
    table = []
    for half in range(16):
        for _ in range(4):
            half = half >> 1 ^ (0xEDB88320 if half & 1 else 0)
        table.append(half)
    halves = f"list_transform(range(strlen({text}) * 2), lambda k: strpos('0123456789ABCDEF', substr(hex(encode({text})), k + 2 - 2 * (k % 2), 1)) - 1)"
    step = f"xor(r >> 4, ({table}::BIGINT[])[(xor(r, h) & 15) + 1])"
    return f"CASE WHEN {text} IS NOT NULL THEN xor(list_reduce(list_prepend(4294967295::BIGINT, {halves}::BIGINT[]), lambda r, h: {step}), 4294967295::BIGINT) END"

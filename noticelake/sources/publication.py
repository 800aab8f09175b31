"""What a run publishes, all of it or nothing; and the removal of retired sources from JSON of any shape."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

#: The documents of a run.
OUTPUTS = ("jobs", "requirement-report", "qa-report", "debug-report")
POINTER = "current"


@dataclass
class _Written(WriterCommitMessage):
    documents: list[tuple[str, str]]


class _Writer(DataSourceWriter):
    """Tasks check their documents and hand them over; the commit writes them to a version of its own and then moves the pointer to it."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.expected = options.get("outputs", ",".join(OUTPUTS)).split(",")

    def write(self, rows: Iterator[Any]) -> WriterCommitMessage:
        documents = []
        for row in rows:
            json.loads(row["document"])  # a document that is none stops the run
            documents.append((row["name"], row["document"]))
        return _Written(documents)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        documents = [d for m in messages if m for d in m.documents]
        if sorted(n for n, _ in documents) != sorted(self.expected):
            raise ValueError(f"a run publishes {self.expected} once each, not {sorted(n for n, _ in documents)}")
        store, root = pafs.FileSystem.from_uri(self.path)
        version = uuid.uuid4().hex
        store.create_dir(f"{root}/{version}", recursive=True)
        for name, text in documents:
            with store.open_output_stream(f"{root}/{version}/{name}.json") as out:
                out.write(text.encode())
        with store.open_output_stream(f"{root}/{version}.{POINTER}") as out:
            out.write(version.encode())
        store.move(f"{root}/{version}.{POINTER}", f"{root}/{POINTER}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Nothing was written, and what was published before stays."""


class Publication(DataSource):
    """The format ``publication``: a row (name, document) for each of a run's JSON documents, of which none is seen before all are there.

    path is an address that the driver's process reaches (a shared folder or an object store). The documents are bounded by contract, a feed of 200 jobs and reports
    by institution, and only they pass through the commit.
    """

    @classmethod
    def name(cls) -> str:
        return "publication"

    def schema(self) -> str:
        return "name string, document string"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options)


def document(rows: DataFrame, name: str, order: list[str], most: int = 200) -> DataFrame:
    """One row (name, document): the first ``most`` rows in order as a JSON array."""
    first = rows.orderBy(*order).limit(most)
    listed = F.transform(F.array_sort(F.collect_list(F.struct(*[F.col(o).alias(f"_{i}") for i, o in enumerate(order)], F.struct(*rows.columns).alias("row")))), lambda x: x["row"])
    return first.agg(F.to_json(listed).alias("document")).select(F.lit(name).alias("name"), "document")


def publish(documents: DataFrame, path: str, outputs: tuple[str, ...] = OUTPUTS) -> None:
    """Publish all documents (name, document) together: if one is missing, repeated or no JSON, or a task fails for good, the version before stays as it is."""
    documents.sparkSession.dataSource.register(Publication)
    documents.select("name", "document").write.format("publication").option("path", path).option("outputs", ",".join(outputs)).mode("append").save()


def published(spark: SparkSession, path: str) -> dict[str, Any]:
    """The documents of the version that is published; empty before the first."""
    store, root = pafs.FileSystem.from_uri(path)
    if store.get_file_info(f"{root}/{POINTER}").type == pafs.FileType.NotFound:
        return {}
    version = store.open_input_stream(f"{root}/{POINTER}").read().decode()
    files = store.get_file_info(pafs.FileSelector(f"{root}/{version}"))
    return {f.base_name.removesuffix(".json"): json.loads(store.open_input_stream(f.path).read()) for f in files}


def _retired(value: Any, names: frozenset[str]) -> bool:
    return isinstance(value, dict) and isinstance(value.get("org"), str) and value["org"] in names


def _scrubbed(value: Any, names: frozenset[str]) -> Any:
    if isinstance(value, list):
        return [_scrubbed(x, names) for x in value if not _retired(x, names)]
    if isinstance(value, dict):
        return {k: _scrubbed(x, names) for k, x in value.items() if k not in names and not _retired(x, names)}
    return value


def scrubbed(text: Column, names: list[str]) -> Column:
    """JSON text without the objects whose org is one of names and the fields of such a name, at any depth.

    The outermost value stays. Text that holds none of the names, is no JSON or loses nothing comes back byte for byte. names are the few sources that were retired.
    """
    held = frozenset(names)

    @F.pandas_udf(T.StringType())
    def scrub(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> str | None:
            try:
                value = json.loads(t) if t else t
            except ValueError:
                return t
            kept = _scrubbed(value, held)
            return t if kept == value else json.dumps(kept, ensure_ascii=False)

        return texts.map(one)

    # escaped names are no substring of the text, so a backslash is read too
    suspect = F.exists(F.array(*[F.lit(n) for n in held]) if held else F.array().cast("array<string>"), lambda n: text.contains(n)) | text.contains("\\u")
    return F.when(suspect, scrub(F.when(suspect, text))).otherwise(text)

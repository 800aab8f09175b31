"""Streams: the bounded history of stage runs, and the incremental merge of jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from noticelake.operators.publish import preferred_jobs

KEEP = 20


def _latest(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Keep the last runs by time; a run that came before (same organisation and time) does not count twice."""
    runs = dict(zip(*state.get, strict=True)) if state.exists else {}
    for b in batches:
        for at, health in zip(b["at"], b["health"], strict=True):
            runs.setdefault(at.isoformat(), health)
    kept = sorted(runs.items())[-KEEP:]
    state.update(([a for a, _ in kept], [h for _, h in kept]))
    yield pd.DataFrame({"org": [key[0]], "runs": [len(kept)], "latest": [kept[-1][0]], "health": [kept[-1][1]], "healthy": [sum(h == "healthy" for _, h in kept)]})


def history_stream(runs: DataFrame) -> DataFrame:
    """From a stream of org, at (timestamp) and health: for each organisation seen in a batch, its history of at most 20 runs in numbers."""
    return runs.groupBy("org").applyInPandasWithState(
        _latest,
        "org string, runs int, latest string, health string, healthy int",
        "at array<string>, health array<string>",
        "update",
        GroupStateTimeout.NoTimeout,
    )


def windowed_health(runs: DataFrame, window: str = "1 day", late: str = "1 day") -> DataFrame:
    """Runs and healthy runs of each window; rows later than the watermark are left out."""
    return runs.withWatermark("at", late).groupBy(F.window("at", window), "org").agg(F.count(F.lit(1)).alias("runs"), F.count_if(F.col("health") == "healthy").alias("healthy"))


def merge_batches(read: Callable[[], DataFrame], write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: the published jobs and a batch of new ones become one table of preferred jobs.

    read gives the current table and write replaces it by a version named by the batch; a batch that runs twice
    writes the same version again: a published job stays before those of the batch, and these are in the order of their content.
    """

    def merge(batch: DataFrame, number: int) -> None:
        both = read().withColumn("_age", F.lit(0)).unionByName(batch.withColumn("_age", F.lit(1)), allowMissingColumns=True)
        content = F.to_json(F.struct(*[c for c in both.columns if c != "_age"]))
        both = both.withColumn("_order", F.concat(F.col("_age").cast("string"), F.sha2(content, 256)))
        write(preferred_jobs(both, "_order").drop("_age", "_order"), number)

    return merge

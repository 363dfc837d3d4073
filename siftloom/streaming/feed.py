"""A live feed of posts: filtered ingest, and quotas by key in order of arrival."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType


def ingest(stream: DataFrame, steps: list[Callable[[DataFrame], DataFrame]], path: str, checkpoint: str):
    """Runs the same DataFrame steps that batches use over a stream and appends the rows to Parquet files, exactly once."""
    for step in steps:
        stream = stream.transform(step)
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").start()


class _Count(StatefulProcessor):
    """Counts a key's occurrences and tells for each row whether the key was still below the limit."""

    def __init__(self, limit: int) -> None:
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", StructType([StructField("n", LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:  # noqa: N802
        n = self.count.get()[0] if self.count.exists() else 0
        batch = pd.concat(list(rows)).sort_values("ord")
        below = []
        for occurrences in batch["occ"]:
            below.append(n < self.limit)
            n += int(occurrences)
        self.count.update((n,))
        yield pd.DataFrame({"row": batch["row"].to_numpy(), "below": below})

    def close(self) -> None:
        pass


def quota_marks(stream: DataFrame, row: str, keys: str, order: str, limit: int) -> DataFrame:
    """(row, below) for each row and key of a stream: whether the key had come up fewer than ``limit`` times.

    State is one number for each key. Rows are counted in order of ``order`` within a micro-batch and by batch
    across batches. A row passes if any of its marks is true: quota_sink() puts them together for each batch.
    A row without keys has one mark, which is true.
    """
    keyless = stream.where(F.coalesce(F.size(keys), F.lit(0)) < 1).select(F.col(row).cast("long").alias("row"), F.lit(True).alias("below"))
    exploded = stream.select(F.col(row).cast("long").alias("row"), F.col(order).cast("long").alias("ord"), F.explode(keys).alias("key"))
    # a key that a row names twice is counted twice, but marked once
    occ = exploded.withColumn("occ", F.lit(1).cast("long"))
    marks = occ.groupBy("key").transformWithStateInPandas(_Count(limit), "row long, below boolean", outputMode="Append", timeMode="None")
    return marks.union(keyless)


def quota_sink(marks: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str):
    """Gives ``write`` the passing row ids of each micro-batch."""

    def each(batch: DataFrame, number: int) -> None:
        write(batch.groupBy("row").agg(F.max("below").alias("ok")).where("ok").select("row"), number)

    return marks.writeStream.foreachBatch(each).outputMode("append").option("checkpointLocation", checkpoint).start()

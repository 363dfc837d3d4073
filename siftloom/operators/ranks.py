"""Row numbers in a total order, counted within ranges and added up, so that no task sees a whole table or a whole hot key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftloom.session import materialize, private


def number_rows(rows: DataFrame, order: list[Column | str], name: str = "row", within: list[str] | None = None, first: int = 1, parts: int | None = None) -> DataFrame:
    """Adds ``name``: each row's number in the order, within equal values of the columns ``within`` if there are any, from ``first`` on.

    Rows are dealt into ranges of (within, order), which are numbered each by itself; what goes before a range is a sum over the numbers of
    rows of ranges, one row for each range and key in it. Null is a value of its own. Rows that the order doesn't tell apart are numbered in any
    order. ``parts`` is the number of ranges, by default Spark's. The result rests on a stored table.
    """
    keys = list(within or [])
    part, n, start, of_part, *of_keys = private(rows.withColumn(name, F.lit(0)), "_part", "_n", "_start", "_of_part", *(f"_of_{i}" for i in range(len(keys))))
    by = [F.col(k) for k in keys] + [F.col(c) if isinstance(c, str) else c for c in order]
    dealt = rows.repartitionByRange(parts, *by) if parts else rows.repartitionByRange(*by)
    dealt = materialize(dealt.withColumn(part, F.spark_partition_id()), "ranges")
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(part, *keys).agg(F.count("*").alias(n)).withColumn(start, F.coalesce(F.sum(n).over(before), F.lit(0)))
    starts = starts.select(F.col(part).alias(of_part), *(F.col(k).alias(o) for k, o in zip(keys, of_keys, strict=True)), start)
    same = F.col(part) == F.col(of_part)
    for k, o in zip(keys, of_keys, strict=True):
        same = same & F.col(k).eqNullSafe(F.col(o))
    place = F.row_number().over(Window.partitionBy(part, *keys).orderBy(*by[len(keys) :]))
    numbered = dealt.withColumn(n, place).join(starts, same)
    return numbered.select(*rows.columns, (F.col(n) + F.col(start) + (first - 1)).cast("long").alias(name))

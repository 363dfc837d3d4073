"""Selection: quotas on a feed, fair shares of lists, label propagation from crops, selection of a data set."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of a key that are numbered together, about.
GROUP = 4096


def key_quota(rows: DataFrame, row: str, keys: str, order: list[str], limit: int) -> DataFrame:
    """Rows of a feed, in order, any of whose keys has come up fewer than ``limit`` times before; rows without keys pass. 0: no limit.

    While a key is below its limit every row with it passes, so a key's count is its number of occurrences
    so far: a running number within the key. Only the first ``limit`` rows of a key need it, which are
    found by a ranked limit before rows of a key meet.
    """
    if limit <= 0:
        return rows
    seen = rows.select(row, *order, F.explode(keys).alias("_key")).groupBy("_key", row, *order).agg(F.count("*").alias("_occ"))
    w = Window.partitionBy("_key").orderBy(*order)
    # of a key's rows the first ``limit`` hold all that can pass
    first = seen.withColumn("_place", F.row_number().over(w)).where(F.col("_place") <= limit)
    before = F.coalesce(F.sum("_occ").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    passing = first.withColumn("_before", before).where(F.col("_before") < limit).select(row).distinct()
    return rows.join(passing.withColumnRenamed(row, "_pass"), F.col(row) == F.col("_pass"), "left").where(
        F.col("_pass").isNotNull() | (F.coalesce(F.size(keys), F.lit(0)) <= 0)
    ).drop("_pass")


def follow_up_keys(wanted: DataFrame, rows: DataFrame, keys: str) -> DataFrame:
    """(key) of wanted keys that no row has."""
    return wanted.select("key").join(rows.select(F.explode(keys).alias("key")).distinct(), "key", "left_anti")


def fair_share_quotas(sizes: dict, n: int) -> dict:
    """How many of each list are taken: in rounds, each list still with rows, in order, gives max(left // lists, 1) rows at most, until n are taken."""
    taken, open_lists, first = {k: 0 for k in sizes}, list(sizes), True
    while n > 0 and open_lists:
        quota, again = max(n // len(open_lists), 1), []
        for k in open_lists:
            if n <= 0:
                break
            give = min(quota, sizes[k] - taken[k], n)
            taken[k] += give
            n -= give
            if sizes[k] > taken[k]:
                again.append(k)
        open_lists = again
    return taken


def fair_share(rows: DataFrame, group: str, list_id: str, order: list, n: int) -> DataFrame:
    """Rows selected from lists, n from each group by fair shares. Quotas are worked out on the table of list sizes alone."""
    kinds = {c: rows.schema[c].dataType.simpleString() for c in (group, list_id)}

    def share(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list_id)
        quota = fair_share_quotas(dict(zip(pdf[list_id], pdf["n"], strict=True)), n)
        return pdf[[group, list_id]].assign(quota=[quota[k] for k in pdf[list_id]])

    quotas = rows.groupBy(group, list_id).agg(F.count("*").alias("n")).groupBy(group).applyInPandas(share, f"{group} {kinds[group]}, {list_id} {kinds[list_id]}, quota long")
    placed = rows.withColumn("_place", F.row_number().over(Window.partitionBy(group, list_id).orderBy(*order)))
    return placed.join(quotas, [group, list_id]).where("_place <= quota").drop("_place", "quota")


def propagate_labels(crops: DataFrame, parents: DataFrame, overwrite: bool) -> DataFrame:
    """(item_id, characters) of parents after their crops' labels.

    ``crops``: item_id, parent_id, ord, character (null in noise folders); ``parents``: item_id, characters. With
    ``overwrite``, or without characters of its own, a parent gets each distinct label of its crops, in
    order. Otherwise a label replaces those of its own that have the same base name, the last one winning,
    and none is added. A crop that is its own parent changes nothing.
    """
    given = crops.where((F.col("item_id") != F.col("parent_id")) & F.col("character").isNotNull())
    labels = given.groupBy("parent_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "character"))), lambda s: s["character"]).alias("new"))
    joined = parents.join(labels, parents.item_id == labels.parent_id, "left")
    fresh = F.array_distinct(F.col("new"))

    def form(own: Column) -> Column:
        same = F.filter("new", lambda x: F.substring_index(x, "|", 1) == F.substring_index(own, "|", 1))
        return F.coalesce(F.get(same, F.size(same) - 1), own)

    force = F.lit(overwrite) | F.coalesce(F.size("characters") <= 0, F.lit(True))
    out = F.when(F.col("new").isNull(), F.col("characters")).when(force, fresh).otherwise(F.transform("characters", form))
    return joined.select("item_id", out.alias("characters"))


def large_crop_selection(crops: DataFrame, originals: DataFrame) -> DataFrame:
    """(item_id, came_from): classified crops, but the parent for a crop over half its area, then originals; each item once.

    ``crops``: item_id, parent_id, area, parent_area; ``originals``: item_id.
    """
    whole = (F.col("parent_id") != F.col("item_id")) & (F.col("area") > 0.5 * F.col("parent_area"))
    chosen = crops.select(F.when(whole, F.col("parent_id")).otherwise(F.col("item_id")).alias("item_id"), F.lit(0).alias("rank"))
    every = chosen.unionByName(originals.select("item_id", F.lit(1).alias("rank")))
    return every.groupBy("item_id").agg(F.when(F.min("rank") == 0, "classified").otherwise("raw").alias("came_from"))


def sample_rows(rows: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows by a seeded hash of the key, all if there are fewer."""
    return rows.orderBy(F.xxhash64(F.lit(seed), key), key).limit(n)


def top_by_score(rows: DataFrame, score: str, name: str, n: int) -> DataFrame:
    return rows.orderBy(F.desc(score), F.desc(name)).limit(n)

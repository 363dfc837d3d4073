"""Core tags of characters: mining, categories and removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftloom.functions.tags import CORE_STOP_WORDS


def tag_frequency(items: DataFrame, tags: Column) -> DataFrame:
    """(tag, n) over lists of names."""
    return items.select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


def core_tags(items: DataFrame, frequency: float = 0.4) -> DataFrame:
    """(character, tag, n, n_items) of tags that at least ``frequency`` of a character's own items have.

    ``items``: item_id, characters (names), tags (names). Only items of one character count. Tags with a
    stop word among their words are left out.
    """
    single = items.where((F.size("characters") == 1) & F.col("tags").isNotNull()).select(F.get("characters", F.lit(0)).alias("character"), "tags")
    totals = single.groupBy("character").agg(F.count("*").alias("n_items"))
    counts = single.select("character", F.explode("tags").alias("tag")).groupBy("character", "tag").agg(F.count("*").alias("n"))
    stops = F.array(*map(F.lit, CORE_STOP_WORDS))
    return (
        counts.join(totals, "character").where(F.col("n") >= frequency * F.col("n_items"))
        .where(~F.arrays_overlap(F.split("tag", r"[\W_]+"), stops)).select("character", "tag", "n", "n_items")
    )


def categories(core: DataFrame, is_dropped: Column, is_init: Column, embedding: Column) -> DataFrame:
    """(character, tag, kept, dropped, emb_init) flags of core tags.

    Characters with the same embedding share the emb_init tags that all of them have; other emb_init
    tags lose the flag, and shared ones are not kept.
    """
    flagged = core.select("character", "tag", embedding.alias("embedding"), is_dropped.alias("dropped"), is_init.alias("init"))
    forms = flagged.groupBy("embedding").agg(F.countDistinct("character").alias("forms"))
    shared = flagged.where("init").groupBy("embedding", "tag").agg(F.countDistinct("character").alias("having")).join(forms, "embedding")
    shared = shared.where("having = forms").select("embedding", "tag", F.lit(True).alias("shared"))
    return flagged.join(shared, ["embedding", "tag"], "left").select(
        "character", "tag", (~F.col("dropped") & F.col("shared").isNull()).alias("kept"), "dropped",
        (F.col("init") & F.col("shared").isNotNull()).alias("emb_init"),
    )


def drop_core_tags(items: DataFrame, dropped: DataFrame) -> DataFrame:
    """``items`` (item_id, characters, tags as names) without the tags that are dropped for any of their characters.

    ``dropped``: (character, tag).
    """
    lists = dropped.groupBy("character").agg(F.collect_set("tag").alias("drop"))
    mine = items.select("item_id", F.explode("characters").alias("character")).join(lists, "character").groupBy("item_id").agg(
        F.array_distinct(F.flatten(F.collect_list("drop"))).alias("drop")
    )
    joined = items.join(mine, "item_id", "left")
    return joined.withColumn("tags", F.when(F.col("drop").isNull(), F.col("tags")).otherwise(F.array_except("tags", "drop"))).drop("drop")


def unknown_characters(items: DataFrame, core: DataFrame) -> DataFrame:
    """(character) of items that has no core tags."""
    return items.select(F.explode("characters").alias("character")).distinct().join(core.select("character").distinct(), "character", "left_anti")


#: Words that an image type's embedding starts from.
TYPE_INIT = {"screenshots": "anime screencap", "booru": "masterpiece"}


def merge_emb_init(old: DataFrame | None, names: DataFrame, image_types: list[str], found: DataFrame | None = None, overwrite: bool = False) -> DataFrame:
    """(name, init) of embeddings: the old ones (name, init), unless they are to be overwritten; ``names`` (name) without one, with no words; image types
    without one, with their default words, which may be empty; then the words found (name, init) that a name doesn't have yet, after its own, in their order."""
    spark, none = names.sparkSession, F.array().cast("array<string>")
    types = spark.createDataFrame([(t, [TYPE_INIT.get(t, "")]) for t in image_types], "name string, init array<string>")
    rows = names.select("name", none.alias("init"), F.lit(1).alias("turn")).unionByName(types.withColumn("turn", F.lit(2)))
    if old is not None and not overwrite:
        rows = rows.unionByName(old.select("name", "init", F.lit(0).alias("turn")))
    # the first that there is: an old one, then a name
    first = rows.groupBy("name").agg(F.min_by("init", "turn").alias("init"))
    if found is None:
        return first
    more = found.select("name", F.col("init").alias("more"))
    had, new = F.coalesce("init", none), F.coalesce("more", none)
    # without words of its own a name takes those found as they are
    return first.join(more, "name", "full").select("name", F.when(F.col("init").isNull(), new).otherwise(F.concat(had, F.filter(new, lambda t: ~F.array_contains(had, t)))).alias("init"))

"""Folder layout of items as a manifest of paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftloom.functions import names as N


def arrange(items: DataFrame, levels: tuple[str, ...], most_characters: int = 6, least_combination: int = 1, extension: str = ".png") -> DataFrame:
    """Adds ``path``: a folder for each level, and the item's file.

    Levels: image_type, n_characters, character (names), character_string (whole descriptions). Combinations of
    characters with fewer items than ``least_combination`` become character_others; their sizes are
    a partial aggregate that joins back.
    """
    bases = F.transform("characters", lambda c: N.base_name(c))
    named = {
        "image_type": F.coalesce("type", F.lit("none")), "n_characters": N.folder_n_characters(bases, most_characters),
        "character": N.folder_characters(bases), "character_string": N.folder_characters(F.col("characters")),
    }
    out = items.withColumns({f"_{x}": named[x] for x in levels})
    if "character" in levels and least_combination > 1:
        sizes = out.groupBy("_character").agg(F.count("*").alias("_n"))
        out = out.join(sizes, "_character").withColumn("_character", F.when(F.col("_n") < least_combination, "character_others").otherwise(F.col("_character"))).drop("_n")
    path = F.concat_ws("/", *(F.col(f"_{x}") for x in levels), F.concat("item_id", F.lit(extension)))
    return out.withColumn("path", N.sanitize(path)).drop(*(f"_{x}" for x in levels))

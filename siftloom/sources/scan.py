"""Scans and sinks of image folders, sidecar files and rule files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftloom.sources.sidecars import plain_path

#: Image endings in the order in which they are listed.
IMAGES = ("png", "jpg", "jpeg", "webp", "gif")
#: Names that mean nobody.
NOBODY = ("unknown", "anonymous")
LIST_FIELDS = {"character": "characters", "characters": "characters", "copyright": "copyright", "artist": "artist", "general": "tags", "tags": "tags"}
SCALAR_FIELDS = ("rating", "score", "fav_count")


def manifest(spark: SparkSession, folder: str, endings: tuple[str, ...] = IMAGES) -> DataFrame:
    """(path, folder, filename, group_id, length, rank) of the images below a folder; contents aren't read.

    ``rank`` is the place of the ending; (rank, path) is the order in which images are taken.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    ending = F.lower(F.substring_index("path", ".", -1))
    directory = F.regexp_replace("path", "/[^/]*$", "")
    group = F.regexp_replace(F.regexp_replace(F.substring_index(directory, "/", -1), r"[\W_]+", "_"), "^_+|_+$", "")
    rank = F.array_position(F.array(*map(F.lit, endings)), ending).cast("int")
    return files.where(ending.isin(*endings)).select(
        "path", directory.alias("folder"), F.substring_index("path", "/", -1).alias("filename"), group.alias("group_id"), "length", rank.alias("rank")
    )


def base_key(path: Column) -> Column:
    """A file's path without its ending."""
    return F.regexp_replace(path, r"\.[^./]*$", "")


def comma_sidecars(spark: SparkSession, folder: str, ending: str) -> DataFrame:
    """(base, values) of text files ``*.{ending}`` with values between commas; blank values are dropped."""
    files = spark.read.option("recursiveFileLookup", True).option("wholetext", True).option("pathGlobFilter", f"*.{ending}").text(folder)
    values = F.filter(F.transform(F.split("value", ","), lambda x: F.trim(x)), lambda x: x != "")
    return files.select(base_key(plain_path(F.col("_metadata.file_path"))).alias("base"), values.alias("values"))


def key_value_lines(lines: DataFrame) -> DataFrame:
    """(path, field, values) of ``field: a, b`` lines (path, line_no, line): lists without blank and nameless values, white space as
    underscores, under their common names; scalars as one value. The last line of a field wins."""
    field = F.lower(F.trim(F.regexp_extract("line", "^([^:]*):", 1)))
    text = F.trim(F.regexp_extract("line", "^[^:]*:(.*)$", 1))
    names = F.create_map(*[F.lit(x) for kv in {**LIST_FIELDS, **{s: s for s in SCALAR_FIELDS}}.items() for x in kv])
    items = F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: (x != "") & ~x.isin(*NOBODY))
    values = F.when(field.isin(*SCALAR_FIELDS), F.array(text)).otherwise(F.transform(items, lambda x: F.regexp_replace(x, r"\s+", "_")))
    named = lines.select("path", "line_no", F.element_at(names, field).alias("field"), values.alias("values")).where(F.col("field").isNotNull())
    return named.groupBy("path", "field").agg(F.max_by("values", "line_no").alias("values"))


def class_map(rows: DataFrame) -> DataFrame:
    """(old, new) of a table (ord, old, new): without a new name a class keeps its own; the last of equal old names wins."""
    return rows.groupBy("old").agg(F.max_by(F.coalesce("new", "old"), "ord").alias("new"))


def captions_sink(items: DataFrame, path: str) -> None:
    """Writes (path, caption) rows with a caption as JSON lines, by folder of the image."""
    kept = items.where(F.coalesce("caption", F.lit("")) != "")
    kept.select(F.concat(base_key(F.col("path")), F.lit(".txt")).alias("path"), "caption").write.mode("overwrite").json(path)


def wildcard_lines(core: DataFrame) -> DataFrame:
    """(character, line_no, line) of core tags (character, kept, emb_init, dropped): name; name and kept tags; name and all, where it is longer."""
    name = F.array("character")
    kept, whole = F.concat(name, F.col("kept")), F.array_distinct(F.concat(name, F.col("kept"), F.col("emb_init"), F.col("dropped")))
    lines = F.filter(F.array(name, F.when(F.size("kept") > 0, kept), F.when(F.size(whole) > F.size(kept), whole)), lambda x: x.isNotNull())
    return core.select("character", F.posexplode(F.transform(lines, lambda x: F.array_join(x, ", "))).alias("line_no", "line"))

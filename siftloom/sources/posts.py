"""Records of sites and files: flattening, numbering, re-association."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: List fields of a site's record and what they become.
TAG_STRINGS = {"tag_string_character": "characters", "tag_string_copyright": "copyright", "tag_string_artist": "artist", "tag_string_general": "tags"}
KEPT = ("score", "md5", "rating", "fav_count")


def flatten_site(records: DataFrame, site: str) -> DataFrame:
    """Splits the tag strings that are there into lists, keeps score, md5, rating and favourites, and names the site."""
    lists = {new: F.split(F.trim(F.col(old)), r"\s+") for old, new in TAG_STRINGS.items() if old in records.columns}
    rest = [c for c in records.columns if c not in TAG_STRINGS]
    return records.select(*rest, *(v.alias(k) for k, v in lists.items()), F.lit(site).alias("site"))


def number_episodes(files: DataFrame, folder: str, order: list[str], first: int | None = None, parsed: Column | None = None) -> DataFrame:
    """Adds ``episode``: place in the folder from ``first`` on, if given, else the parsed number, else the place; and ``prefix`` for frames."""
    place = F.row_number().over(Window.partitionBy(folder).orderBy(*order)) - 1
    episode = place + first if first is not None else F.coalesce(parsed, place) if parsed is not None else place
    return files.withColumn("episode", episode.cast("int")).withColumn("prefix", F.concat(F.lit("_EP"), "episode", F.lit("_")))


def duplicate_names(files: DataFrame, name: str) -> DataFrame:
    """(name, n) of base names that come up more than once: what is attached to them can't be told apart."""
    return files.groupBy(name).agg(F.count("*").alias("n")).where("n > 1")


def relink(crops: DataFrame, sources: DataFrame) -> DataFrame:
    """(crop, source): the first source whose base name is the crop's without its last part; null if there is none."""
    firsts = sources.groupBy("base").agg(F.min("source").alias("source"))
    return crops.withColumn("base", F.regexp_replace("crop", "_[^_]*$", "")).join(firsts, "base", "left").select("crop", "source")


def group_by_base(files: DataFrame, base: Column, name: Column) -> DataFrame:
    """(base, files): sorted names of the files that share a base."""
    return files.groupBy(base.alias("base")).agg(F.array_sort(F.collect_list(name)).alias("files"))


def output_metadata(items: DataFrame, kind: str, extension: str, folder: Column | None = None, size: Column | None = None) -> DataFrame:
    """Items as they are written: the type is the image type, the file has the new extension. With ``folder`` current_path is the file there;
    ``size`` is the image's new size. ``path`` stays: it is where the image came from."""
    out = items.withColumn("filename", F.regexp_replace("filename", r"\.[^.]*$", "." + extension)).withColumn("type", F.lit(kind))
    if folder is not None:
        out = out.withColumn("current_path", F.concat_ws("/", folder, "filename"))
    return out if size is None else out.withColumn("image_size", size)

"""Filters of items, posts and detections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def rating_filter(items: DataFrame, allowed: list[str]) -> DataFrame:
    """Rows whose rating, or its class (s and g: safe; q and e: r18), is allowed; no rating is s. Adds ``mapped``; an unknown rating has none."""
    rated = F.coalesce("rating", F.lit("s"))
    mapped = F.when(rated.isin("s", "g"), "safe").when(rated.isin("q", "e"), "r18")
    return items.withColumn("mapped", mapped).where(rated.isin(*allowed) | F.coalesce(F.col("mapped").isin(*allowed), F.lit(False)))


def min_size(items: DataFrame, width: Column, height: Column, least: int) -> DataFrame:
    return items.where(F.least(width, height) >= least)


def min_detections(detections: DataFrame, least: int, score: float, item: str = "item") -> DataFrame:
    """(item, n) of items with so many detections of this score or more."""
    return detections.where(F.col("score") >= score).groupBy(item).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def face_summary(detections: DataFrame, items: DataFrame, score: float, ratio: float, height: Column, width: Column | None = None) -> DataFrame:
    """(item, n_faces, fh_ratio) of every item: faces of enough score and no edge over ``ratio`` times the other; the tallest over ``height``.

    With ``width`` also ``facepos``: left, top, right and bottom of each such face in parts of the image, in order of ``det``, then of the edges."""
    w, h = F.col("r") - F.col("l"), F.col("b") - F.col("t")
    good = detections.where((F.col("score") >= score) & (w <= ratio * h) & (h <= ratio * w))
    made = [F.count("*").alias("n_faces"), F.max(h / height).alias("fh_ratio")]
    if width is not None:
        place = F.array(F.col("l") / width, F.col("t") / height, F.col("r") / width, F.col("b") / height)
        made.append(F.transform(F.array_sort(F.collect_list(F.struct("det", "l", "t", "r", "b", place.alias("p")))), lambda x: x["p"]).alias("facepos"))
    both = items.join(good.groupBy("item").agg(*made), "item", "left")
    columns = ["item", F.coalesce("n_faces", F.lit(0)).alias("n_faces"), F.coalesce("fh_ratio", F.lit(0.0)).alias("fh_ratio")]
    return both.select(*columns, *([] if width is None else [F.coalesce("facepos", F.array().cast("array<array<double>>")).alias("facepos")]))


def count_between(items: DataFrame, n: Column, low: int | None, high: int | None) -> DataFrame:
    """Rows whose count is within the bounds; a missing bound is open."""
    ok = F.lit(True)
    if low is not None:
        ok = ok & (n >= low)
    if high is not None:
        ok = ok & (n <= high)
    return items.where(ok)


def first_submitter(rows: DataFrame, title: str, rank: Column, episode: Column, first: int | None, last: int | None) -> DataFrame:
    """Rows of the wanted episodes (unknown ones pass), and of those only the first submitter's of each title."""
    wanted = F.lit(True)
    if first is not None:
        wanted = wanted & (episode >= first)
    if last is not None:
        wanted = wanted & (episode <= last)
    kept = rows.where(episode.isNull() | wanted).withColumn("_rank", rank)
    best = kept.groupBy(title).agg(F.min("_rank").alias("_best"))
    return kept.join(best, title).where("_rank = _best").drop("_rank", "_best")


def portion(frames: DataFrame, folder: str, number: str, which: str) -> DataFrame:
    """Frames of the first or last third of each folder, by number."""
    most = frames.groupBy(folder).agg(F.expr(f"max({number}) div 3").alias("_third"))
    joined = frames.join(most, folder)
    ok = F.col(number) <= F.col("_third") if which == "first" else F.col(number) > 2 * F.col("_third")
    return joined.where(ok).drop("_third")


def first_face(detections: DataFrame, score: float, ratio: float, items: DataFrame | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """The first detection of each item, by ``det`` and then by ``ties``, that has over this score and no edge over ``ratio`` times the other. Of ``items`` (item), if given, those without one stay, with nulls."""
    w, h = F.col("r") - F.col("l"), F.col("b") - F.col("t")
    good = detections.where((F.col("score") > score) & (F.greatest(w, h) <= ratio * F.least(w, h)))
    place = F.row_number().over(Window.partitionBy("item").orderBy("det", *ties))
    first = good.withColumn("_place", place).where("_place = 1").drop("_place")
    return first if items is None else items.select("item").join(first, "item", "left")

"""Repeats of image folders from weights of a folder tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def glob_to_regex(pattern: Column) -> Column:
    """A whole-path regular expression of a glob: * is any text, ? any character, [abc] and [a-c] one of these, [!abc] none of them. An open bracket without an end is itself."""
    parts = F.regexp_extract_all(pattern, F.lit(r"\[!?\]?[^\]]*\]|[\s\S]"), F.lit(0))

    def one(x: Column) -> Column:
        inside = F.regexp_replace(F.regexp_replace(F.substr(x, F.lit(2), F.length(x) - 2), r"([\\\[\]^&])", r"\\$1"), "^!", "^")
        return F.when(x == "*", ".*").when(x == "?", ".").when(F.length(x) > 1, F.concat(F.lit("["), inside, F.lit("]"))).otherwise(F.regexp_replace(x, r"([^A-Za-z0-9_\s/-])", r"\\$1"))

    return F.concat(F.lit("(?s)^"), F.array_join(F.transform(parts, one), ""), F.lit("$"))


def folder_weights(nodes: DataFrame, weights: DataFrame) -> DataFrame:
    """(path, weight) of nodes (path): the weight of an equal base name, else of the first pattern in order that fits the path, else 1.

    ``weights`` (ord, pattern, weight) is a rule file. Names are joined by equality; only rules with a wildcard meet every node, and whether
    they are sent to all tasks goes by their size.
    """
    rules = weights.select("ord", "pattern", "weight")
    # a pattern without a wildcard fits a name, before all others, or the path that it is
    keys = F.array(F.struct(F.lit(0).alias("kind"), F.substring_index("path", "/", -1).alias("pattern")), F.struct(F.lit(1).alias("kind"), F.col("path").alias("pattern")))
    equal = nodes.select("path", F.inline(keys)).join(rules, "pattern").select("path", "kind", "ord", "weight")
    wild = rules.where(F.col("pattern").rlike(r"[*?\[]")).select("ord", "weight", glob_to_regex(F.col("pattern")).alias("regex"))
    met = nodes.select("path").join(wild, F.expr("path rlike regex")).select("path", F.lit(1).alias("kind"), "ord", "weight")
    best = equal.unionByName(met).groupBy("path").agg(F.min_by("weight", F.struct("kind", "ord")).alias("weight"))
    return nodes.select("path").join(best, "path", "left").select("path", F.coalesce("weight", F.lit(1.0)).alias("weight"))


def balance(folders: DataFrame, weights: DataFrame, min_multiply: float = 1.0, max_multiply: float = 100.0) -> DataFrame:
    """(path, n, prob, raw, multiply) of folders that hold images (path, n).

    Weights are shared out level by level among a folder's children, its own images counting as one more
    child of the folder's own weight; a folder's probability is the product along its path. Repeats are
    probabilities for each image, scaled so that the smallest is ``min_multiply``, rounded and capped.
    """
    held = folders.where("n > 0").withColumn("parts", F.split("path", "/"))
    steps = held.select("path", F.explode(F.sequence(F.lit(1), F.size("parts"))).alias("depth"), "parts")
    steps = steps.select("path", "depth", F.array_join(F.slice("parts", F.lit(1), F.col("depth")), "/").alias("node"), F.array_join(F.slice("parts", F.lit(1), F.col("depth") - 1), "/").alias("parent"))
    nodes = steps.select(F.col("node").alias("path"), "parent").distinct()
    weighted = nodes.join(folder_weights(nodes, weights), "path")
    own = held.select("path").join(weighted, "path").select(F.col("path").alias("node"), F.col("weight").alias("own"))
    children = weighted.groupBy(F.col("parent").alias("node")).agg(F.sum("weight").alias("below"))
    sums = children.join(own, "node", "full").select("node", (F.coalesce("below", F.lit(0.0)) + F.coalesce("own", F.lit(0.0))).alias("total"), "own", "below")
    share = steps.join(weighted.select(F.col("path").alias("node"), "weight"), "node").join(sums.select(F.col("node").alias("parent"), "total"), "parent")
    along = share.groupBy("path").agg(F.transform(F.array_sort(F.collect_list(F.struct("depth", (F.col("weight") / F.col("total")).alias("s")))), lambda x: x["s"]).alias("s"))
    along = along.withColumn("p", F.aggregate("s", F.lit(1.0), lambda a, x: a * x))
    # images of a folder with children share its probability with them
    rest = sums.select(F.col("node").alias("path"), F.when(F.col("below").isNull(), 1.0).otherwise(F.col("own") / F.col("total")).alias("rest"))
    prob = held.join(along, "path").join(rest, "path").select("path", "n", (F.col("p") * F.col("rest")).alias("prob"))
    least = prob.agg(F.min(F.col("prob") / F.col("n")).alias("least"))
    raw = F.col("prob") / F.col("n") / F.col("least") * min_multiply
    # one row of one number on the other side
    return prob.crossJoin(F.broadcast(least)).select("path", "n", "prob", raw.alias("raw"), F.least(F.rint(raw * 100) / 100, F.lit(float(max_multiply))).alias("multiply"))


def repeat_totals(balanced: DataFrame) -> DataFrame:
    return balanced.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("multiply")).alias("virtual"))


def source_manifest(folders: DataFrame, balanced: DataFrame) -> DataFrame:
    """(path, repeat) of folders with images: the rounded multiply, 1 where there is none."""
    return folders.where("n > 0").join(balanced.select("path", "multiply"), "path", "left").select("path", F.coalesce(F.rint("multiply"), F.lit(1.0)).cast("int").alias("repeat"))

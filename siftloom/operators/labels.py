"""Class labels: splits, votes, accuracy, vocabularies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftloom.operators.ranks import number_rows
from siftloom.session import private

#: Ids of a vocabulary's special tokens.
PAD, UNK, CLS, SEP, MASK = range(5)


def stratified_split(rows: DataFrame, label: str, order: list, share: float) -> DataFrame:
    """Adds ``part``: the first int(n * share) rows of each class are ``train``, the rest ``test``."""
    place, n, of = private(rows.withColumn("part", F.lit(0)), "_place", "_n", "_of")
    placed = number_rows(rows, order, place, [label])
    sizes = rows.groupBy(F.col(label).alias(of)).agg(F.count("*").alias(n))
    both = placed.join(sizes, F.col(label).eqNullSafe(F.col(of)))
    return both.withColumn("part", F.when(F.col(place) <= F.floor(F.col(n) * share), "train").otherwise("test")).select(*rows.columns, "part")


def top_k_hits(rows: DataFrame, ks: tuple[int, ...]) -> DataFrame:
    """(top{k}..., n): rows whose target class is among the k of highest probability; ties go to the lower class.

    ``rows``: item, target, probs (array). A target's rank is the number of classes before it.
    """
    own = F.get("probs", F.col("target"))
    ahead = F.size(F.filter(F.transform("probs", lambda p, i: (p > own) | ((p == own) & (i < F.col("target")))), lambda b: b))
    return rows.select(ahead.alias("ahead")).agg(*(F.count(F.when(F.col("ahead") < k, 1)).alias(f"top{k}") for k in ks), F.count("*").alias("n"))


def two_model_vote(first: DataFrame, second: DataFrame, threshold: float) -> DataFrame:
    """(item, character): each model's likeliest class; the likelier of both if over the threshold, else unknown. ``ood`` is unknown."""
    a = first.groupBy("item").agg(F.max_by("class", "p").alias("ca"), F.max("p").alias("pa"))
    b = second.groupBy("item").agg(F.max_by("class", "p").alias("cb"), F.max("p").alias("pb"))
    best = F.when(F.col("pa") > F.col("pb"), F.col("ca")).otherwise(F.col("cb"))
    return a.join(b, "item").select("item", F.when((F.greatest("pa", "pb") <= threshold) | (best == "ood"), "unknown").otherwise(best).alias("character"))


def model_vote(scores: DataFrame, threshold: float, other: DataFrame | None = None, outfits: DataFrame | None = None) -> DataFrame:
    """(item, character) of class probabilities (item, class, p): the likeliest class if it is over the threshold, else unknown; ``ood`` is unknown.

    With a second model (``other``) the likelier of both models' classes counts, the second one's if they are equal. With ``outfits`` (item, class, p) a known
    character without an outfit gets the likeliest one after a comma, if over the threshold and not ``others``. Ties within a model go to the smaller class.
    """

    def best(rows: DataFrame, c: str, p: str) -> DataFrame:
        return rows.groupBy("item").agg(F.min(F.struct((-F.col("p")).alias("p"), "class")).alias("b")).select("item", F.col("b.class").alias(c), (-F.col("b.p")).alias(p))

    rows = best(scores, "c", "p")
    if other is not None:
        second = F.col("p2") >= F.col("p")
        rows = rows.join(best(other, "c2", "p2"), "item").select("item", F.when(second, F.col("c2")).otherwise(F.col("c")).alias("c"), F.greatest("p", "p2").alias("p"))
    rows = rows.select("item", F.when((F.col("p") <= threshold) | (F.col("c") == "ood"), "unknown").otherwise(F.col("c")).alias("character"))
    if outfits is None:
        return rows
    worn = best(outfits, "outfit", "po").where((F.col("po") > threshold) & (F.col("outfit") != "others")).select("item", "outfit")
    bare = F.col("outfit").isNotNull() & ~F.col("character").contains(",") & (F.col("character") != "unknown")
    return rows.join(worn, "item", "left").select("item", F.when(bare, F.concat_ws(", ", "character", "outfit")).otherwise(F.col("character")).alias("character"))


def vocabulary(tokens: DataFrame, least: int) -> DataFrame:
    """(token, n, id) of tokens seen so often, numbered after the special ones by first appearance. ``tokens``: token, ord."""
    counted = tokens.groupBy("token").agg(F.count("*").alias("n"), F.min("ord").alias("first")).where(F.col("n") >= least)
    return number_rows(counted, ["first", "token"], "id", first=MASK + 1).select("token", "n", "id")


def encode_tokens(ids: Column, length: int) -> Column:
    """CLS, the ids (null: UNK), SEP, cut and padded to ``length``."""
    inner = F.slice(F.transform(ids, lambda x: F.coalesce(x, F.lit(UNK))), 1, length - 2)
    whole = F.concat(F.array(F.lit(CLS)), inner, F.array(F.lit(SEP)))
    return F.concat(whole, F.array_repeat(F.lit(PAD), length - F.size(whole)))


#: Names of a vocabulary's special tokens, by id.
SPECIAL = ("[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]")


def decode_tokens(rows: DataFrame, ids: str, words: DataFrame, key: str) -> DataFrame:
    """(key, words) of lists of ids through a vocabulary (token, id), in order; ids without a word, and null ones, are [UNK]. A null or empty list has no words."""
    spark = rows.sparkSession
    every = words.select("id", "token").unionByName(spark.createDataFrame(list(enumerate(SPECIAL)), "id long, token string"))
    said = rows.select(key, F.posexplode(ids).alias("at", "id")).join(every, "id", "left").groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", F.coalesce("token", F.lit(SPECIAL[UNK])).alias("token")))), lambda x: x["token"]).alias("words")
    )
    return rows.select(key).distinct().join(said, key, "left").select(key, F.coalesce("words", F.array().cast("array<string>")).alias("words"))

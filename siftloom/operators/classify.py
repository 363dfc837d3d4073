"""Classification of items by clusters, references and known characters, as one job of stored versions of the labels."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftloom.operators import cluster as K
from siftloom.operators import similar as S
from siftloom.operators.fields import inherit_presence, merge_references
from siftloom.operators.near import Near
from siftloom.operators.select import fair_share
from siftloom.session import _folder, materialize


class Versions:
    """Tables of a job's stages. With a folder each is kept there, and a stage that an earlier run has completed is read, not run again."""

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        self.spark, self.folder, self.ran = spark, folder and folder.rstrip("/"), []

    def step(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if not self.folder:
            self.ran.append(name)
            return materialize(make(), name)
        path = f"{self.folder}/{name}"
        files, done = _folder(self.spark, f"{path}/_SUCCESS")
        if not files.exists(done):
            self.ran.append(name)
            make().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)


@dataclass(frozen=True)
class Thresholds:
    """``same``: cosine distance within which two vectors show one character; ``reach``: that of the clusters' density. Shares and numbers of members
    that a label needs: ``share`` or ``count``; ``merge`` of pairs of two clusters, ``reference`` of a label's references, ``metadata`` of a cluster's known characters."""

    same: float
    reach: float
    min_samples: int = 5
    merge: float = 0.85
    share: float = 0.6
    count: int = 10
    reference: float = 0.01
    metadata: float = 0.6
    #: A reference counts for a single item only within this part of ``same``.
    one_reference: float = 0.5


def _changed(new: DataFrame, old: DataFrame, stage: str) -> DataFrame:
    """(item, label, came) of new labels: ``came`` is the stage in which the label became what it is."""
    was = old.select("item", F.col("label").alias("was"), "came")
    return new.join(was, "item").select("item", "label", F.when(F.col("label") == F.col("was"), F.col("came")).otherwise(F.lit(stage)).alias("came"))


def classify(
    vectors: DataFrame, at: Thresholds, known: DataFrame | None = None, refs: DataFrame | None = None, keep_unnamed: bool = True, accept_ties: bool = False,
    extract: bool = True, clean: bool = True, add: int = 0, seed: int = 0, folder: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(items, characters, additions) of ``vectors`` (item, vec), items being whole numbers.

    items: (item, label, character, came), label -1 and no character for noise, no character for unnamed clusters; characters: (label, character); additions: (item, label)
    of up to ``add`` items of each character to take into the references. ``known``: (item, character) by names; ``refs``: (ref, vec, character) by names.

    Clusters by density have labels above all known characters'. In turn: noise takes the label of references or clusters near it; clusters take a reference's label,
    then, if still unnamed, that of most of their known characters; unnamed clusters are merged, or dropped unless ``keep_unnamed``; noise is looked at once more
    without references; labels that too few members bear out go. Nothing speaks against known characters: an item takes a known character's label only if it is known
    to show it, where there is metadata. Without references and metadata unnamed clusters are kept. Known characters are numbered by name.
    Items with a null vector are noise. Each stage is a stored table; with ``folder`` a job that was cut off goes on after the last complete one.
    """
    spark = vectors.sparkSession
    v = Versions(spark, folder)
    rows = v.step("vectors", lambda: vectors.select("item", "vec"))
    # pairs are counted anew where they are needed: their list grows with the square of the rows
    same = Near(rows, 1 - at.same)

    # characters: those known, then references'
    names = "label long, character string"
    own = spark.createDataFrame([], names) if known is None else K.dense_ids(known.select("character"), "character", "character").select(F.col("id").cast("long").alias("label"), "character")
    n_meta = own.count()
    catalogue, linked = own, None
    if refs is not None:
        of_refs = K.dense_ids(refs.select("character"), "character", "character").select(F.col("id").cast("long").alias("label"), "character")
        catalogue = merge_references(own, of_refs)
        linked = v.step("references", lambda: refs.join(catalogue.select("label", "character").distinct(), "character").select("ref", "vec", F.col("label").alias("ref_label")))
    characters = v.step("characters", lambda: catalogue.select("label", "character").distinct())
    n_named = characters.count()
    shown = None
    if known is not None:
        present = known.join(own, "character").select("item", "label").distinct()
        shown = v.step("shown", lambda: inherit_presence(present, own, characters).select("item", F.col("label").alias("character")))

    def noise_labels(labels: DataFrame, with_refs: bool) -> DataFrame:
        named = rows.join(labels.select("item", F.col("label").alias("to")), "item")
        noise, members = named.where("to = -1").select("item", "vec"), named.where("to >= 0")
        groups = S.group_distances(noise, members, at.same)
        near = S.group_distances(noise, linked.select(F.col("ref").alias("item"), "vec", F.col("ref_label").alias("to")), at.same * at.one_reference) if with_refs else None
        return K.rescue_noise(labels, groups, shown, at.share, at.count, by_reference=near, n_known=None if shown is None else n_named)

    def clusters() -> DataFrame:
        found = K.density_clusters(rows.select("item"), Near(rows, 1 - at.reach), at.min_samples)
        return found.select("item", F.when(F.col("label") >= 0, F.col("label") + n_named).otherwise(-1).cast("long").alias("label"), F.lit("cluster").alias("came"))

    labels = v.step("clusters", clusters)
    if extract:
        before = labels
        labels = v.step("noise", lambda: _changed(noise_labels(before, linked is not None), before, "noise"))
    given = []
    if linked is not None:
        of_noise = labels

        def by_reference() -> DataFrame:
            members = rows.join(of_noise.where("label >= 0").select("item", F.col("label").alias("to")), "item")
            means = S.group_distances(linked.select(F.col("ref").alias("item"), "vec"), members, at.same)
            means = means.select(F.col("src").alias("ref"), F.col("to").alias("label"), F.col("d").alias("m"))
            return K.reference_votes(means, linked, at.same, at.reference).select("label", F.lit(0).alias("priority"), F.col("ref_label").alias("candidate"), (F.col("ref_label") >= n_named).alias("open"))

        votes = v.step("reference_votes", by_reference)
        labels = v.step("by_reference", lambda: _changed(K.assign_if_consistent(of_noise, votes, shown), of_noise, "reference"))
        given.append((0, of_noise, votes, labels))
    if shown is not None:
        of_refs_labels = labels

        def by_metadata() -> DataFrame:
            unnamed = of_refs_labels.where(F.col("label") >= n_named)
            sizes = unnamed.groupBy("label").agg(F.count("*").alias("size"))
            n = unnamed.join(shown.where(F.col("character") < n_meta), "item").groupBy("label", "character").agg(F.count("*").alias("n"))
            most = n.groupBy("label").agg(F.max("n").alias("most"))
            best = n.join(most, "label").where("n = most").join(sizes, "label").where(F.col("n") / F.col("size") >= at.metadata)
            ties = best.groupBy("label").agg(F.count("*").alias("ties"))
            best = best if accept_ties else best.join(ties.where("ties = 1"), "label")
            return best.select("label", F.col("character").alias("priority"), F.col("character").alias("candidate"), F.lit(False).alias("open"))

        votes = v.step("metadata_votes", by_metadata)
        labels = v.step("by_metadata", lambda: _changed(K.assign_if_consistent(of_refs_labels, votes, shown), of_refs_labels, "metadata"))
        given.append((1, of_refs_labels, votes, labels))
    voted = labels
    if keep_unnamed or (linked is None and shown is None):
        merged = lambda: K.merge_clusters(same, voted, at.merge, first=n_named, known=shown, n_known=n_named, least=1 if n_named else 0)
    else:
        merged = lambda: voted.select("item", F.when(F.col("label") < n_named, F.col("label")).otherwise(-1).cast("long").alias("label"))
    labels = v.step("merged", lambda: _changed(merged(), voted, "merged"))
    if extract:
        of_merged = labels
        labels = v.step("noise_again", lambda: _changed(noise_labels(of_merged, False), of_merged, "noise"))
    if clean:
        whole = labels
        labels = v.step("cleaned", lambda: _changed(K.filter_labels(whole, same, at.share, at.count), whole, "cleaned"))

    additions = spark.createDataFrame([], "item long, label long")
    if add > 0 and given:
        # one list for each cluster that gave items to a character, references' before metadata's
        lists = None
        for turn, old, votes, new in given:
            moved = old.select("item", F.col("label").alias("of")).join(votes.select(F.col("label").alias("of"), F.col("candidate").alias("label")), "of").join(new.select("item", "label"), ["item", "label"])
            part = moved.select("item", "label", F.concat(F.lit(f"{turn}:"), F.format_string("%019d", "of")).alias("list"))
            lists = part if lists is None else lists.unionByName(part)
        additions = v.step("additions", lambda: fair_share(lists, "label", "list", [F.xxhash64(F.lit(seed), "item"), F.col("item")], add).select("item", "label"))
    items = labels.join(F.broadcast(characters) if n_named <= 100_000 else characters, "label", "left").select("item", "label", "character", "came")
    return items, characters, additions

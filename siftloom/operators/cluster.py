"""Density clusters of vectors, their labels by references and metadata, and label clean-up.

Everything works on long tables: edges (src, dst, cos), labels (item, label; -1 is noise), known (item, character).
In place of edges there may be a ``Near``, which counts them where vectors are compared, so that no list of them is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftloom.operators.graph import connected_components
from siftloom.operators.near import Near
from siftloom.operators.ranks import number_rows
from siftloom.session import Scratch, materialize


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def group_counts(edges: DataFrame | Near, groups: DataFrame, group: str) -> DataFrame:
    """(a, b, n): edges between items of each two groups, of ``groups`` (item, group); either of two groups may be a."""
    if isinstance(edges, Near):
        return edges.counts(groups, group)
    ends = groups.select("item", group)
    return edges.join(ends.toDF("src", "a"), "src").join(ends.toDF("dst", "b"), "dst").groupBy("a", "b").agg(F.count("*").alias("n"))


def density_clusters(items: DataFrame, edges: DataFrame | Near, min_samples: int = 5, item: str = "item") -> DataFrame:
    """(item, label): clusters of core rows, those with ``min_samples`` rows in reach, themselves included, and rows in reach of one.

    A label is the smallest core row of its cluster; a border row takes the smallest label in reach;
    other rows are noise, -1. The reach is a fixed distance, not one for each cluster.
    """
    if isinstance(edges, Near):
        scratch = Scratch(items.sparkSession)
        found = scratch.store(edges.degrees(), "degrees").select("item", (F.col("n") >= min_samples - 1).alias("dense"))
        of_core = scratch.store(edges.components(found.where("dense"), scratch).select("item", F.col("component").alias("label")), "core")
        # rows without a pair are in reach of none
        reached = edges.least_of(found.where("not dense"), of_core).select("item", F.col("reach").alias("label"))
        rows = items.select(F.col(item).alias("item")).join(of_core.unionByName(reached), "item", "left")
        out = materialize(rows.select(F.col("item").alias(item), F.coalesce("label", F.lit(-1)).cast("long").alias("label")), "clusters")
        scratch.free()
        return out
    near = both_ways(edges)
    core = materialize(near.groupBy("src").agg(F.count("*").alias("n")).where(F.col("n") >= min_samples - 1).select(F.col("src").alias("core")), "core")
    inner = edges.join(core.withColumnRenamed("core", "src"), "src").join(core.withColumnRenamed("core", "dst"), "dst").select("src", "dst")
    parts = connected_components(inner)
    labelled = core.join(parts, core.core == parts.id, "left").select("core", F.coalesce("component", "core").alias("label"))
    border = near.join(labelled, near.dst == labelled.core).groupBy(F.col("src").alias("item")).agg(F.min("label").alias("reach"))
    rows = items.select(F.col(item).alias("item")).join(labelled, F.col("item") == labelled.core, "left").join(border, "item", "left")
    return rows.select(F.col("item").alias(item), F.coalesce("label", "reach", F.lit(-1)).cast("long").alias("label"))


def affinity(edges: DataFrame | Near, labels: DataFrame) -> DataFrame:
    """(x, y, n_same, size_x, size_y, score), x < y: share of pairs across two clusters that have an edge."""
    named = labels.where("label >= 0")
    sizes = named.groupBy("label").agg(F.count("*").alias("size"))
    cross = group_counts(edges, named, "label").where("a <> b").select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"), "n")
    n = cross.groupBy("x", "y").agg(F.sum("n").alias("n_same"))
    return (
        n.join(sizes.select(F.col("label").alias("x"), F.col("size").alias("size_x")), "x").join(sizes.select(F.col("label").alias("y"), F.col("size").alias("size_y")), "y")
        .withColumn("score", F.col("n_same") / (F.col("size_x") * F.col("size_y"))).select("x", "y", "n_same", "size_x", "size_y", "score")
    )


def merge_clusters(edges: DataFrame | Near, labels: DataFrame, threshold: float, first: int = 0, known: DataFrame | None = None, n_known: int = 0, least: int = 0) -> DataFrame:
    """(item, label) after greedy merging: in passes over x < y in order, y joins x if the share of their pairs with an edge reaches the threshold.

    x is at least ``least``, y at least ``first``. With ``known`` (item, character) and x under ``n_known``, only items of y that are known to
    show x move; the others keep their label, which takes no further part. Passes go on until one merges nothing.

    Items of one label and equal known characters always move together, so all runs on their sizes and the counts of edges between
    them, which add up. Clusters can only meet in a component of the graph of labels with a pair of such parts that reaches the threshold by itself,
    since a union's share is a mean of its parts'. Components take their next merge all at once, one in each round of joins; none
    meets in one task. Every item has one label; other rows of an item are as many items.
    """
    spark = labels.sparkSession
    scratch = Scratch(spark)
    named = labels.select("item", F.col("label").cast("long").alias("label"))
    if known is None:
        marked = named.withColumn("shows", F.array().cast("array<long>"))
    else:
        # names that are labels of clusters are all that merging asks for
        shown = known.select("item", F.col("character").cast("long").alias("character")).where(F.col("character") < n_known)
        shown = shown.join(named.select(F.col("label").alias("character")).distinct(), "character").groupBy("item").agg(F.sort_array(F.collect_set("character")).alias("shows"))
        marked = named.join(shown, "item", "left").withColumn("shows", F.coalesce("shows", F.array().cast("array<long>")))
    part = F.concat_ws(":", F.col("label").cast("string"), F.array_join(F.col("shows").cast("array<string>"), ","))
    items = scratch.store(marked.withColumn("part", part), "items")
    live = items.where("label >= 0")
    parts = scratch.store(live.groupBy("part", "label", "shows").agg(F.count("*").alias("size")), "parts")
    sized = parts.select("part", "label", "size")
    of_part = parts.select("part", "label")
    both = group_counts(edges, live.select("item", "part"), "part").join(of_part.toDF("a", "la"), "a").join(of_part.toDF("b", "lb"), "b").where("la <> lb")
    flipped = F.col("la") > F.col("lb")
    counts = both.groupBy(*(F.when(flipped, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in (("a", "b"), ("b", "a")))).agg(F.sum("n").alias("n"))
    counts = scratch.store(counts.join(sized.toDF("a", "la", "na"), "a").join(sized.toDF("b", "lb", "nb"), "b"), "counts")
    strong = connected_components(counts.where(F.col("n") / (F.col("na") * F.col("nb")) >= threshold), "la", "lb", scratch)
    of_label = scratch.store(strong.select(F.col("id").alias("label"), "component"), "components")
    counts = scratch.store(counts.join(of_label.toDF("la", "component"), "la").join(of_label.toDF("lb", "other"), "lb").where("component = other").select("component", "a", "b", "n"), "inner")
    state = scratch.store(parts.join(of_label, "label").select("component", "part", "label", "shows", "size", F.lit(True).alias("live")), "state")
    at = state.select("component", F.lit(-1).cast("long").alias("px"), F.lit(-1).cast("long").alias("py")).distinct()
    while True:
        alive = state.where("live").select("part", "label")
        pairs = counts.join(alive.toDF("a", "la"), "a").join(alive.toDF("b", "lb"), "b").where("la <> lb")
        pairs = pairs.groupBy("component", F.least("la", "lb").alias("x"), F.greatest("la", "lb").alias("y")).agg(F.sum("n").alias("n"))
        sizes = state.where("live").groupBy("label").agg(F.sum("size").alias("size"))
        pairs = pairs.join(sizes.toDF("x", "nx"), "x").join(sizes.toDF("y", "ny"), "y")
        ready = pairs.where((F.col("n") / (F.col("nx") * F.col("ny")) >= threshold) & (F.col("x") >= least) & (F.col("y") >= first)).join(at, "component")
        # the next pair of this pass, or the first of the next
        later = (F.col("x") > F.col("px")) | ((F.col("x") == F.col("px")) & (F.col("y") > F.col("py")))
        at = scratch.store(ready.groupBy("component").agg(F.min(F.struct((~later).alias("again"), "x", "y")).alias("e")).select("component", F.col("e.x").alias("px"), F.col("e.y").alias("py")), "next")
        if at.isEmpty():
            break
        moved = state.join(at, "component", "left")
        gone = F.coalesce(F.col("live") & (F.col("label") == F.col("py")), F.lit(False))
        moves = gone & (F.array_contains("shows", F.col("px")) | (F.col("px") >= n_known) if known is not None else F.lit(True))
        state = scratch.store(moved.select("component", "part", F.when(moves, F.col("px")).otherwise(F.col("label")).alias("label"), "shows", "size", (F.col("live") & (~gone | moves)).alias("live")), "state")
    ended = state.select("part", F.col("label").alias("target"))
    out = materialize(items.join(ended, "part", "left").select("item", F.coalesce("target", "label").alias("label")), "merged")
    scratch.free()
    return out


def cluster_to_reference(distances: DataFrame, labels: DataFrame, refs: DataFrame, same: float, least_share: float = 0.01) -> DataFrame:
    """(label, ref_label, dist, share): reference_votes() of a table (item, ref, dist) of all items and references."""
    mean = distances.join(labels.where("label >= 0"), "item").groupBy("label", "ref").agg(F.avg("dist").alias("m"))
    return reference_votes(mean, refs, same, least_share)


def reference_votes(means: DataFrame, refs: DataFrame, same: float, least_share: float = 0.01, mode: str = "min") -> DataFrame:
    """(label, ref_label, dist, share): the reference label of least distance for each cluster, if enough of its references are near.

    ``means``: (label, ref, m), the mean distance of a reference to a cluster's members, as of similar.group_distances(); ``refs``: (ref, ref_label).
    A label's distance is the least (``min``) or the mean (``avg``) over its references; ``share`` is that of the label's references within
    ``same``. Ties go to the lower label.
    """
    if mode not in ("min", "avg"):
        raise ValueError(f"no such mode: {mode}")
    by_label = means.join(refs.select("ref", "ref_label"), "ref").groupBy("label", "ref_label").agg(
        (F.min("m") if mode == "min" else F.avg("m")).alias("dist"), F.avg((F.col("m") <= same).cast("double")).alias("share")
    )
    best = by_label.groupBy("label").agg(F.min(F.struct("dist", "ref_label", "share")).alias("b"))
    return best.select("label", "b.ref_label", "b.dist", "b.share").where(F.col("share") >= least_share)


def cluster_to_metadata(labels: DataFrame, known: DataFrame, least_share: float = 0.6, accept_ties: bool = False) -> DataFrame:
    """(label, character, share): the character that most members are known to show, if their share of the cluster is enough; ties give none."""
    named = labels.where("label >= 0")
    sizes = named.groupBy("label").agg(F.count("*").alias("size"))
    votes = named.join(known, "item").groupBy("label", "character").agg(F.count("*").alias("n"))
    top = votes.groupBy("label").agg(F.max("n").alias("most"))
    best = votes.join(top, "label").where("n = most").groupBy("label").agg(F.min("character").alias("character"), F.count("*").alias("ties"), F.max("n").alias("n"))
    out = best.join(sizes, "label").withColumn("share", F.col("n") / F.col("size")).where(F.col("share") >= least_share)
    return (out if accept_ties else out.where("ties = 1")).select("label", "character", "share")


def assign_if_consistent(labels: DataFrame, candidates: DataFrame, known: DataFrame | None) -> DataFrame:
    """(item, label): the first candidate of an item's label (by priority) that the item is known to show; without one the label stays.

    ``candidates``: (label, priority, candidate, open): an open candidate is beyond the known characters and takes all.
    Without metadata every item takes the first candidate.
    """
    joined = labels.join(candidates, "label")
    if known is None:
        ok = joined
    else:
        shown = known.select("item", F.col("character").alias("candidate"), F.lit(True).alias("shown"))
        ok = joined.join(shown, ["item", "candidate"], "left").where(F.col("open") | F.col("shown").isNotNull())
    taken = ok.groupBy("item").agg(F.min_by("candidate", "priority").alias("taken"))
    return labels.join(taken, "item", "left").select("item", F.coalesce("taken", "label").alias("label"))


def rescue_noise(
    labels: DataFrame, by_label: DataFrame | None, known: DataFrame | None, least_share: float, least_count: int, by_reference: DataFrame | None = None, n_known: int | None = None
) -> DataFrame:
    """(item, label) in which noise rows, of label -1, may have got a label. All are judged against the labels given.

    A row takes the label of the nearest reference, by least distance, if that is under its mean distance to every cluster and
    one of the label's references is the same. If it doesn't, it takes the cluster of least mean distance if enough of its members, by share or number, are the
    same. Both only if ``known`` (item, character) doesn't speak against it: a label under ``n_known`` must be among the row's known characters. A row that takes
    none gets its only known character; else -1. Ties go to the lower label.

    ``by_label``: (src, to, d, count, share) of noise rows and clusters, of similar.group_distances(), ``by_reference``: (src, to, least, count) of noise
    rows and labels of references; either may be None. Without ``n_known`` no label is held against known characters.
    """
    rows = labels.select("item", "label")
    empty = rows.where("false").select(F.col("item").alias("src"))
    groups = empty.select("src", *(F.lit(None).cast(t).alias(c) for c, t in (("to", "long"), ("d", "double"), ("count", "double"), ("share", "double")))) if by_label is None else by_label
    nearest = groups.groupBy("src").agg(F.min(F.struct("d", "to", "count", "share")).alias("b")).select("src", F.struct(F.col("b.d").alias("d"), F.col("b.to").cast("long").alias("to"), "b.count", "b.share").alias("b"))
    best = nearest
    if by_reference is not None:
        of_ref = by_reference.groupBy("src").agg(F.min(F.struct("least", "to", "count")).alias("r")).select("src", F.struct("r.least", F.col("r.to").cast("long").alias("to"), "r.count").alias("r"))
        best = nearest.join(of_ref, "src", "full")
    else:
        best = nearest.withColumn("r", F.lit(None).cast("struct<least:double,to:long,count:double>"))
    if known is None or n_known is None:
        agreed = {"b": F.lit(True), "r": F.lit(True)}
    else:
        shown = known.select(F.col("item").alias("src"), F.col("character").cast("long").alias("character"))
        for side in ("b", "r"):
            hit = shown.withColumnRenamed("character", f"{side}_to").withColumn(f"{side}_shown", F.lit(True)).distinct()
            best = best.withColumn(f"{side}_to", F.col(side)["to"]).join(hit, ["src", f"{side}_to"], "left")
        shows = {side: F.coalesce(F.col(f"{side}_shown"), F.lit(False)) for side in ("b", "r")}
        agreed = {"b": shows["b"] | (F.col("b.to") >= n_known), "r": shows["r"]}
    by_ref = F.coalesce((F.col("r.least") < F.coalesce("b.d", F.lit(float("inf")))) & (F.col("r.count") > 0) & agreed["r"], F.lit(False))
    by_cluster = F.coalesce(((F.col("b.share") >= least_share) | (F.col("b.count") >= least_count)) & agreed["b"], F.lit(False))
    found = best.select(F.col("src").alias("item"), F.when(by_ref, F.col("r.to")).when(by_cluster, F.col("b.to")).alias("found")).where("found is not null")
    out = rows.join(found, "item", "left")
    if known is not None:
        only = known.groupBy("item").agg(F.min("character").alias("only"), F.count("*").alias("n")).where("n = 1").select("item", "only")
        out = out.join(only, "item", "left")
    else:
        out = out.withColumn("only", F.lit(None).cast("long"))
    return out.select("item", F.when(F.col("label") >= 0, F.col("label")).otherwise(F.coalesce("found", "only", F.lit(-1))).cast("long").alias("label"))


def filter_labels(labels: DataFrame, edges: DataFrame | Near, least_share: float, least_count: int) -> DataFrame:
    """(item, label): a label stays if enough of its members, the row itself included, have an edge to the row; else -1."""
    if isinstance(edges, Near):
        n = edges.degrees(labels).withColumnRenamed("item", "src")
    else:
        a = labels.select(F.col("item").alias("src"), F.col("label").alias("la"))
        b = labels.select(F.col("item").alias("dst"), F.col("label").alias("lb"))
        n = both_ways(edges).join(a, "src").join(b, "dst").where("la = lb").groupBy("src").agg(F.count("*").alias("n"))
    sizes = labels.groupBy("label").agg(F.count("*").alias("size"))
    rows = labels.join(n, labels["item"] == n["src"], "left").join(sizes, "label").withColumn("n", F.coalesce("n", F.lit(0)) + 1)
    ok = (F.col("label") >= 0) & ((F.col("n") / F.col("size") >= least_share) | (F.col("n") >= least_count))
    return rows.select("item", F.when(ok, F.col("label")).otherwise(-1).cast("long").alias("label"))


def label_counts(labels: DataFrame) -> DataFrame:
    return labels.groupBy("label").agg(F.count("*").alias("n"))


def dense_ids(rows: DataFrame, name: str, order: str) -> DataFrame:
    """(name, id): distinct names numbered from 0 by first appearance, ties by name."""
    firsts = rows.groupBy(name).agg(F.min(order).alias("_first"))
    return number_rows(firsts, ["_first", name], "id", first=0).select(name, F.col("id").cast("int").alias("id"))

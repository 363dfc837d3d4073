"""Similarity edges between vectors, and near-duplicate removal that keeps the first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftloom.operators.graph import connected_components
from siftloom.session import materialize

#: Vectors in a block of the comparison.
BLOCK = 1024
#: Rounds of removal after which what is still open is decided component by component.
ROUNDS = 12
#: Edges, at most, of a component that one task walks.
WALKED = 100_000


def _matrix(vectors) -> np.ndarray:
    m = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)


def similar_pairs(vectors: DataFrame, threshold: float, item: str = "item", vec: str = "vec", scope: str | None = None) -> DataFrame:
    """(src, dst, cos) with src < dst and cosine over ``threshold``, within equal ``scope``; a null scope is one of its own.

    All pairs of a scope are compared exactly, a block of vectors against a block: each pair of blocks is one task's
    matrix product, and only pairs over the threshold leave it. A scope of more than a block's rows has blocks of its own;
    smaller ones share blocks, and are told apart there. So rows of different scopes are never sent to each other's blocks.
    Rows with a null vector have no pairs; repeated items have a pair for each of their rows.
    """
    rows = vectors.where(F.col(vec).isNotNull()).select(F.col(item).alias("item"), F.col(vec).alias("vec"), (F.col(scope) if scope else F.lit(0)).alias("scope"))
    n = rows.count()
    if scope:
        sizes = rows.groupBy(F.col("scope").alias("of")).agg(F.count("*").alias("rows"))
        rows = rows.join(sizes, F.col("scope").eqNullSafe(F.col("of"))).drop("of")
    else:
        rows = rows.withColumn("rows", F.lit(n))
    large = F.col("rows") > BLOCK
    blocks = F.when(large, F.ceil(F.col("rows") / BLOCK)).otherwise(1).cast("long")
    shared = F.when(large, F.lit(-1)).otherwise(F.pmod(F.xxhash64("scope"), F.lit(max(1, -(-n // BLOCK)))))
    rows = rows.select("item", "vec", "scope", F.when(large, F.col("scope")).alias("own"), shared.alias("shared"), blocks.alias("blocks"), F.pmod(F.xxhash64("item"), blocks).alias("block"))
    # row block i meets column block j of its scope for i <= j: each row is sent to as many tasks as its scope has blocks
    same = ["item", "vec", "scope", "own", "shared"]
    left = rows.select(*same, F.col("block").alias("i"), F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("j"), F.lit(0).alias("side"))
    right = rows.select(*same, F.explode(F.sequence(F.lit(0).cast("long"), F.col("block"))).alias("i"), F.col("block").alias("j"), F.lit(1).alias("side"))
    kind = vectors.schema[item].dataType.simpleString()

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(scope=pd.factorize(pdf["scope"])[0])
        a, b = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        if not len(a) or not len(b):
            return pd.DataFrame({"src": [], "dst": [], "cos": []})
        cos = _matrix(a["vec"]) @ _matrix(b["vec"]).T
        x, y = np.nonzero(cos > threshold)
        src, dst = a["item"].to_numpy()[x], b["item"].to_numpy()[y]
        keep = a["scope"].to_numpy()[x] == b["scope"].to_numpy()[y]
        if a["i"].iloc[0] == a["j"].iloc[0]:
            keep = keep & (src < dst)
        low, high = np.minimum(src, dst), np.maximum(src, dst)
        return pd.DataFrame({"src": low[keep], "dst": high[keep], "cos": cos[x, y][keep]})

    return left.unionByName(right).groupBy("shared", "own", "i", "j").applyInPandas(compare, f"src {kind}, dst {kind}, cos double")


def distances_to_groups(vectors: DataFrame, labels: DataFrame, same: float, item: str = "item", vec: str = "vec", label: str = "label") -> DataFrame:
    """(src, to, d, least, count, share) of each item of label -1 and each other label; see group_distances(). Rows with a null vector are left out."""
    rows = vectors.join(labels.select(F.col(item), F.col(label).alias("to")), item)
    named = rows.select(F.col(item).alias("item"), F.col(vec).alias("vec"), "to")
    return group_distances(named.where("to = -1"), named.where("to <> -1"), same)


def _dealt(rows: DataFrame, key: str, blocks: int, others: int, side: int) -> DataFrame:
    """Rows in blocks of their own, each sent once to every block of the other side; i is the block of side 0, j that of side 1."""
    own, other = F.pmod(F.xxhash64(key), F.lit(blocks)), F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
    i, j = (own, other) if side == 0 else (other, own)
    return rows.withColumn("i", i).withColumn("j", j).withColumn("side", F.lit(side))


def group_distances(items: DataFrame, members: DataFrame, same: float) -> DataFrame:
    """(src, to, d, least, count, share) of each item (item, vec) and each group of members (item, vec, to): mean and least cosine
    distance to the group's members, number and share of those within ``same``.

    Blocks of items meet blocks of members exactly; a task adds up distances by item and group before they leave it, so neither
    side has a bound. Rows with a null vector are left out; a group is a whole number.
    """
    left, right = items.where("vec is not null").select("item", "vec"), members.where("vec is not null").select("item", "vec", F.col("to").cast("long").alias("to"))
    n_left, n_right = (max(1, -(-x.count() // BLOCK)) for x in (left, right))
    kind, other = items.schema["item"].dataType.simpleString(), members.schema["item"].dataType.simpleString()
    sent = _dealt(left.withColumn("to", F.lit(None).cast("long")).withColumn("other", F.lit(None).cast(other)), "item", n_left, n_right, 0)
    sent = sent.unionByName(_dealt(right.select(F.lit(None).cast(kind).alias("item"), "vec", "to", F.col("item").alias("other")), "other", n_right, n_left, 1))

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1].sort_values("to", kind="stable")
        if not len(a) or not len(b):
            return pd.DataFrame({"src": [], "to": [], "n": [], "total": [], "near": [], "least": []})
        dist = 1 - _matrix(a["vec"]) @ _matrix(b["vec"]).T
        names, starts, n = np.unique(b["to"].to_numpy().astype(np.int64), return_index=True, return_counts=True)
        out = {
            "n": np.broadcast_to(n.astype(float), (len(a), len(names))), "total": np.add.reduceat(dist, starts, axis=1),
            "near": np.add.reduceat((dist <= same).astype(float), starts, axis=1), "least": np.minimum.reduceat(dist, starts, axis=1),
        }
        return pd.DataFrame({"src": np.repeat(a["item"].to_numpy(), len(names)), "to": np.tile(names, len(a)), **{k: v.ravel() for k, v in out.items()}})

    sums = sent.groupBy("i", "j").applyInPandas(add, f"src {kind}, to long, n double, total double, near double, least double").groupBy("src", "to").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("near").alias("count"), F.min("least").alias("least")
    )
    return sums.select("src", "to", (F.col("total") / F.col("n")).alias("d"), "least", "count", (F.col("count") / F.col("n")).alias("share"))


#: References, at most, that are sent to every task, where they are compared with what is there; of more, blocks of both sides meet.
SENT_REFERENCES = BLOCK * 64


def reference_distances(items: DataFrame, refs: DataFrame, item: str = "item", ref: str = "ref", vec: str = "vec") -> DataFrame:
    """(item, ref, dist) of every item and reference, dist = 1 - cosine: by its meaning as many rows as both have, multiplied.

    A catalogue of up to ``SENT_REFERENCES`` rows goes to all tasks; a larger one is dealt in blocks, each of which meets each block of items.
    What group_distances() can add up needs no such table.
    """
    kinds = items.schema[item].dataType.simpleString(), refs.schema[ref].dataType.simpleString()
    schema = f"item {kinds[0]}, ref {kinds[1]}, dist double"
    n = refs.count()

    def crossed(a: pd.DataFrame, names, matrix: np.ndarray) -> pd.DataFrame:
        d = 1 - _matrix(a["vec"]) @ matrix.T
        return pd.DataFrame({"item": np.repeat(a["item"].to_numpy(), len(names)), "ref": np.tile(np.array(names), len(a)), "dist": d.ravel()})

    named = items.select(F.col(item).alias("item"), F.col(vec).alias("vec"))
    if n > SENT_REFERENCES:
        n_left, n_right = max(1, -(-named.count() // BLOCK)), -(-n // BLOCK)
        right = refs.select(F.lit(None).cast(kinds[0]).alias("item"), F.col(vec).alias("vec"), F.col(ref).alias("ref"))
        sent = _dealt(named.withColumn("ref", F.lit(None).cast(kinds[1])), "item", n_left, n_right, 0).unionByName(_dealt(right, "ref", n_right, n_left, 1))

        def meet(pdf: pd.DataFrame) -> pd.DataFrame:
            a, b = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
            return crossed(a, b["ref"].to_numpy(), _matrix(b["vec"])) if len(a) and len(b) else pd.DataFrame({"item": [], "ref": [], "dist": []})

        return sent.groupBy("i", "j").applyInPandas(meet, schema)
    rows = refs.select(ref, vec).collect()
    sent = items.sparkSession.sparkContext.broadcast(([r[0] for r in rows], _matrix([r[1] for r in rows]) if rows else np.zeros((0, 1))))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, matrix = sent.value
        for pdf in batches:
            if len(names) and len(pdf):
                yield crossed(pdf, names, matrix)

    return named.mapInPandas(measure, schema)


def keep_first(items: DataFrame, edges: DataFrame, item: str = "item", rounds: int = ROUNDS) -> DataFrame:
    """``item`` of rows that stay if, in order, each row still there removes all later rows that it has an edge to.

    A row stays once all its smaller neighbours are gone, and goes once a smaller one stays. Rounds of
    both decide most rows. Of what is then open, components of up to ``WALKED`` edges are walked in order, each by itself;
    larger ones go on in rounds until all is decided, so that no task has a component of any size.
    """
    edges = materialize(edges.select("src", "dst"), "edges")
    kind = items.schema[item].dataType.simpleString()
    state = items.select(F.col(item).alias("item"), F.lit(0).alias("state"))  # 0 open, 1 stays, 2 goes

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        smaller: dict = {}
        for s, d in zip(pdf["src"], pdf["dst"], strict=True):
            smaller.setdefault(d, []).append(s)
        kept: set = set()
        every = sorted(set(pdf["src"]) | set(pdf["dst"]))
        for x in every:
            if not any(s in kept for s in smaller.get(x, ())):
                kept.add(x)
        return pd.DataFrame({"item": every, "found": [1 if x in kept else 2 for x in every]})

    while True:
        for _ in range(rounds):
            seen = edges.join(state.select(F.col("item").alias("src"), F.col("state").alias("s")), "src").groupBy("dst").agg(
                F.max((F.col("s") == 1).cast("int")).alias("lost"), F.max((F.col("s") == 0).cast("int")).alias("waits")
            )
            new = F.when(F.col("state") != 0, F.col("state")).when(F.col("lost") == 1, 2).when(F.coalesce("waits", F.lit(0)) == 1, 0).otherwise(1)
            state = materialize(state.join(seen, state["item"] == seen["dst"], "left").select("item", new.alias("state")), "state")
            if state.where("state = 0").isEmpty():
                return state.where("state = 1").select(F.col("item").alias(item))
        rounds = max(rounds, 1)
        lost = edges.join(state.where("state = 1").select(F.col("item").alias("src")), "src").select(F.col("dst").alias("item")).distinct()
        open_rows = materialize(state.where("state = 0").select("item").join(lost, "item", "left_anti"), "open")
        inner = materialize(edges.join(open_rows.withColumnRenamed("item", "src"), "src").join(open_rows.withColumnRenamed("item", "dst"), "dst").select("src", "dst"), "inner")
        parts = connected_components(inner)
        named = inner.join(parts, inner.src == parts.id).select("component", "src", "dst")
        small = named.groupBy("component").count().where(F.col("count") <= WALKED).select("component")
        walked = named.join(small, "component").groupBy("component").applyInPandas(walk, f"item {kind}, found int")
        alone = open_rows.join(parts.select(F.col("id").alias("item")), "item", "left_anti").select("item", F.lit(1).alias("found"))
        found = walked.unionByName(alone).unionByName(lost.select("item", F.lit(2).alias("found"))).groupBy("item").agg(F.max("found").alias("found"))
        state = materialize(state.join(found, "item", "left").select("item", F.when(F.col("state") == 0, F.coalesce("found", F.lit(0))).otherwise(F.col("state")).alias("state")), "state")
        # between open rows only; what they have lost is decided
        edges = inner
        if state.where("state = 0").isEmpty():
            return state.where("state = 1").select(F.col("item").alias(item))

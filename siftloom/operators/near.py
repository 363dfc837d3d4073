"""What is asked of the pairs of similar vectors, added up where they are compared: a table's pairs grow with its square and are never listed."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftloom.operators.graph import connected_components
from siftloom.operators.similar import _matrix
from siftloom.session import Scratch, materialize

#: Vectors, about, in a chunk, which goes to a task as one row.
CHUNK = 4096
#: Vectors of a chunk that are compared with another chunk at once.
STRIPE = 512
#: Partitions of chunks, at least, if there are as many chunks; each two of them are one task.
PARTS = 16
#: Rows, at most, among which one task picks those that stay, in order.
TURN = 16384


class _Side:
    """The rows of a chunk: columns by name, and unit vectors in double and single precision."""

    def __init__(self, rows: pa.StructArray) -> None:
        self.columns = {f.name: rows.field(f.name) for f in rows.type if f.name != "vec"}
        vec = rows.field("vec")
        m = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vec), -1)
        self.unit = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
        self.single = self.unit.astype(np.float32)

    def __len__(self) -> int:
        return len(self.unit)

    def numpy(self, name: str) -> np.ndarray:
        return self.columns[name].to_numpy(zero_copy_only=False)


def _hits(a: _Side, b: _Side, over: float, own: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (x, y) in a and b of the pairs with a cosine over ``over``; within one chunk each pair once, the smaller item first.

    Products are of single precision; where its error could decide, the pair's cosine is computed in double precision.
    """
    slack = (a.unit.shape[1] + 8) * 2.0**-23
    items = a.numpy("item") if own else None
    for start in range(0, len(a), STRIPE):
        cos = (a.single[start : start + STRIPE] @ b.single.T).ravel()
        k = np.flatnonzero(cos > over - slack)
        x, y = np.divmod(k, len(b))
        x += start
        unsure = np.flatnonzero(cos[k] <= over + slack)
        keep = np.ones(len(k), bool)
        keep[unsure] = np.einsum("ij,ij->i", a.unit[x[unsure]], b.unit[y[unsure]]) > over
        if own:
            keep &= items[x] < items[y]
        yield x[keep], y[keep]


Hits = Iterator[tuple[np.ndarray, np.ndarray]]


def _packed(rows: DataFrame) -> tuple[DataFrame, int]:
    """(chunk, rows) and the number of chunks: rows with a vector dealt by a hash of their item, those of one item together."""
    filled = rows.where("vec is not null")
    chunks = max(1, -(-filled.count() // CHUNK))
    packed = filled.groupBy(F.pmod(F.xxhash64("item"), F.lit(chunks)).alias("chunk")).agg(F.collect_list(F.struct(*rows.columns)).alias("rows"))
    # by number alone: the partitions are read once for each other one, and none is written twice
    return packed.repartition(min(chunks, max(PARTS, -(-chunks // PARTS)))), chunks


def _met(pairs: DataFrame, over: float, add: Callable[[_Side, _Side, Hits], pa.RecordBatch], schema: str, own: bool) -> DataFrame:
    """What ``add`` makes of each pair of chunks (i, a, j, b). ``own``: both sides are of one table, in which a chunk of equal number is the same."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i, j, left, right = (batch.column(c) for c in ("i", "j", "a", "b"))
            for k in range(batch.num_rows):
                a, b = _Side(left[k].values), _Side(right[k].values)
                out = add(a, b, _hits(a, b, over, own and i[k].as_py() == j[k].as_py()))
                if out.num_rows:
                    yield out

    return pairs.mapInArrow(meet, schema)


def _within(rows: DataFrame, over: float, add: Callable, schema: str) -> DataFrame:
    """``add`` of each chunk and itself."""
    packed, _ = _packed(rows)
    return _met(packed.select(F.col("chunk").alias("i"), F.col("rows").alias("a"), F.col("chunk").alias("j"), F.col("rows").alias("b")), over, add, schema, True)


def _among(rows: DataFrame, over: float, add: Callable, schema: str, within: bool = True) -> DataFrame:
    """``add`` of each two chunks of ``rows`` (item, vec, more), and of each and itself unless ``within`` is false. Every pair of rows is seen once."""
    packed, _ = _packed(rows)
    ahead = F.col("i") <= F.col("j") if within else F.col("i") < F.col("j")
    pairs = packed.toDF("i", "a").hint("shuffle_replicate_nl").join(packed.toDF("j", "b"), ahead)
    return _met(pairs.select("i", "a", "j", "b"), over, add, schema, True)


def _between(rows: DataFrame, others: DataFrame, over: float, add: Callable, schema: str) -> DataFrame:
    """``add`` of each chunk of ``rows`` and each of ``others``."""
    pairs = _packed(rows)[0].toDF("i", "a").hint("shuffle_replicate_nl").crossJoin(_packed(others)[0].toDF("j", "b"))
    return _met(pairs.select("i", "a", "j", "b"), over, add, schema, False)


def _rooted(lab: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``lab``, which names the least node of each one's component, with edges between x and y put in."""
    while True:
        a, b = lab[x], lab[y]
        apart = a != b
        if not apart.any():
            return lab
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        np.minimum.at(lab, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := lab[lab], lab):
            lab = up


class Near:
    """The pairs of ``vectors`` (item, vec) with a cosine over ``over``, as a thing to be counted; see similar.similar_pairs() for their list.

    All pairs are compared exactly, a chunk of vectors against a chunk. Chunks are shuffled once: a task reads a partition of them and another one, so neither vectors
    nor pairs are written for each two chunks. What leaves a task is bounded by the rows of its chunks. Rows with a null vector have no pairs.
    """

    def __init__(self, vectors: DataFrame, over: float) -> None:
        self.rows, self.over = vectors.select("item", "vec"), over
        self.kind = vectors.schema["item"].dataType.simpleString()

    def degrees(self, groups: DataFrame | None = None, group: str = "label") -> DataFrame:
        """(item, n): pairs of each item that has any; with ``groups`` (item, group) those within equal groups."""
        grouped = groups is not None
        rows = self.rows.join(groups.select("item", F.col(group).alias("of")).where("of is not null"), "item") if grouped else self.rows

        def add(a: _Side, b: _Side, hits: Hits) -> pa.RecordBatch:
            n, m = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
            own, other = (a.numpy("of"), b.numpy("of")) if grouped else (None, None)
            for x, y in hits:
                if grouped:
                    same = own[x] == other[y]
                    x, y = x[same], y[same]
                n += np.bincount(x, minlength=len(n))
                m += np.bincount(y, minlength=len(m))
            item, n = pa.concat_arrays([a.columns["item"], b.columns["item"]]), np.concatenate([n, m])
            some = np.flatnonzero(n)
            return pa.RecordBatch.from_arrays([item.take(pa.array(some)), pa.array(n[some])], ["item", "n"])

        return _among(rows, self.over, add, f"item {self.kind}, n long").groupBy("item").agg(F.sum("n").alias("n"))

    def counts(self, groups: DataFrame, group: str = "label") -> DataFrame:
        """(a, b, n): pairs of items of two groups, a group with itself among them; either of two groups may be a, but not both."""
        rows = self.rows.join(groups.select("item", F.col(group).alias("of")).where("of is not null"), "item")
        kind = groups.schema[group].dataType.simpleString()

        def add(a: _Side, b: _Side, hits: Hits) -> pa.RecordBatch:
            both = pa.concat_arrays([a.columns["of"], b.columns["of"]])
            code, names = pd.factorize(both.to_numpy(zero_copy_only=False), sort=True)
            own, other = code[: len(a)].astype(np.int64), code[len(a) :].astype(np.int64)
            found, n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for x, y in hits:
                p, q = own[x], other[y]
                pair, count = np.unique(np.minimum(p, q) * len(names) + np.maximum(p, q), return_counts=True)
                found.append(pair)
                n.append(count)
            pair, at = np.unique(np.concatenate(found), return_inverse=True)
            total = np.zeros(len(pair), np.int64)
            np.add.at(total, at, np.concatenate(n))
            low, high = np.divmod(pair, max(1, len(names)))
            return pa.RecordBatch.from_arrays([pa.array(names[low], both.type), pa.array(names[high], both.type), pa.array(total)], ["a", "b", "n"])

        return _among(rows, self.over, add, f"a {kind}, b {kind}, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))

    def components(self, among: DataFrame, scratch: Scratch) -> DataFrame:
        """(item, component) of the items in ``among`` (item), whole numbers: the smallest item that pairs between such items lead to.

        Each chunk's own components first, in its task; from then on they are the nodes, and two chunks tell which of their nodes hang together by as many
        rows as there are nodes, at most.
        """
        rows = self.rows.join(among.select("item"), "item", "left_semi")

        def own(a: _Side, b: _Side, hits: Hits) -> pa.RecordBatch:
            names, at = np.unique(a.numpy("item"), return_inverse=True)
            lab = np.arange(len(names))
            for x, y in hits:
                lab = _rooted(lab, at[x], at[y])
            return pa.RecordBatch.from_arrays([pa.array(names), pa.array(names[lab])], ["item", "part"])

        def across(a: _Side, b: _Side, hits: Hits) -> pa.RecordBatch:
            names, at = np.unique(np.concatenate([a.numpy("part"), b.numpy("part")]), return_inverse=True)
            left, right, lab = at[: len(a)], at[len(a) :], np.arange(len(names))
            for x, y in hits:
                lab = _rooted(lab, left[x], right[y])
            led = np.flatnonzero(lab != np.arange(len(names)))
            return pa.RecordBatch.from_arrays([pa.array(names[led]), pa.array(names[lab[led]])], ["src", "dst"])

        schema = "item long, part long"
        parts = scratch.store(_within(rows.select(F.col("item").cast("long").alias("item"), "vec"), self.over, own, schema), "parts")
        named = rows.join(parts, "item").select("item", "vec", "part")
        links = scratch.store(_among(named, self.over, across, "src long, dst long", within=False).distinct(), "links")
        joined = connected_components(links, scratch=scratch)
        return parts.join(joined, parts.part == joined.id, "left").select("item", F.coalesce("component", "part").alias("component"))

    def least_of(self, items: DataFrame, named: DataFrame) -> DataFrame:
        """(item, reach): of each of ``items`` (item) the least label among the rows of ``named`` (item, label) that it has a pair with. No item is on both sides."""
        own = self.rows.join(items.select("item"), "item", "left_semi")
        other = self.rows.join(named.select("item", F.col("label").cast("long").alias("label")), "item")

        def add(a: _Side, b: _Side, hits: Hits) -> pa.RecordBatch:
            none = np.iinfo(np.int64).max
            best, label = np.full(len(a), none), b.numpy("label")
            for x, y in hits:
                np.minimum.at(best, x, label[y])
            some = np.flatnonzero(best < none)
            return pa.RecordBatch.from_arrays([a.columns["item"].take(pa.array(some)), pa.array(best[some])], ["item", "reach"])

        return _between(own, other, self.over, add, f"item {self.kind}, reach long").groupBy("item").agg(F.min("reach").alias("reach"))

    def met(self, items: DataFrame, others: DataFrame) -> DataFrame:
        """``item`` of those rows of ``items`` (item, vec) that have a pair with any of ``others`` (item, vec), once or more."""

        def add(a: _Side, b: _Side, hits: Hits) -> pa.RecordBatch:
            hit = np.zeros(len(a), bool)
            for x, _ in hits:
                hit[x] = True
            return pa.RecordBatch.from_arrays([a.columns["item"].filter(pa.array(hit))], ["item"])

        return _between(items, others, self.over, add, f"item {self.kind}")

    def keep_first(self, items: DataFrame, turn: int = TURN) -> DataFrame:
        """``item`` of rows that stay if, in order, each row still there removes all later rows that it has a pair with; see similar.keep_first().

        The first ``turn`` rows that are still there are walked in order in one task, and those of them that stay remove later rows everywhere, and so on. Work is the pairs of rows that
        stay with rows not yet removed. Rows without a vector stay.
        """
        over, scratch, before = self.over, Scratch(items.sparkSession), Scratch(items.sparkSession)

        def walk(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("item", kind="stable")
            m, item = _matrix(pdf["vec"]), pdf["item"].to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
            ends = np.append(starts[1:], len(item))
            kept, stays, at = np.zeros((0, m.shape[1])), np.zeros(len(item), bool), 0
            while at < len(starts):
                # whole items, of STRIPE rows together or a little more
                until = int(np.searchsorted(ends, starts[at] + STRIPE)) + 1
                low, high = starts[at], ends[min(until, len(ends)) - 1]
                own = m[low:high]
                gone, inner = (own @ kept.T > over).any(axis=1), own @ own.T > over
                for s, e in zip(starts[at:until] - low, ends[at:until] - low, strict=True):
                    if not gone[s:e].any():
                        stays[low + s : low + e] = True
                        gone |= inner[s:e].any(axis=0)
                kept, at = np.concatenate([kept, own[stays[low:high]]]), until
            return pdf[stays][["item", "vec"]]

        rest = before.store(self.rows.where("vec is not null"), "rest")
        schema, lost = rest.schema, None
        while True:
            cut = rest.select("item").orderBy("item").limit(turn).agg(F.max("item")).first()[0]
            if cut is None:
                break
            head = rest.where(F.col("item") <= F.lit(cut))
            stay = scratch.store(head.groupBy(F.lit(0).alias("one")).applyInPandas(walk, schema), "stay")
            later = rest.where(F.col("item") > F.lit(cut))
            removed = scratch.store(head.select("item").join(stay.select("item"), "item", "left_anti").unionByName(self.met(later, stay).select("item")).distinct(), "removed")
            lost = removed if lost is None else lost.unionByName(removed)
            now = Scratch(items.sparkSession)
            rest = now.store(later.join(removed, "item", "left_anti").select(schema.names), "rest")
            before.free()
            before = now
        before.free()
        out = items.select("item") if lost is None else items.select("item").join(lost, "item", "left_anti")
        out = materialize(out, "kept")
        scratch.free()
        return out

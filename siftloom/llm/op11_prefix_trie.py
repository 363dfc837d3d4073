"""Prefix trie of conversations by union-find over the prefixes that sorted neighbours share.

A conversation is the row of its turns' digests. Equal rows are one record with their number, so a
conversation that a third of all rows copy is one. Sorted records with a common prefix are neighbours;
the turns that neighbour i shares with i + 1 are an edge of that depth. Within a range of the order, edges
are taken in descending depth: each union of two components makes a branching node at the edge's
depth, or a further child of the one there. A prefix that a range shares with the one before or after
is open: of those nodes the range gives its part alone, all of it sums, and parts of one prefix add up.
So whole subtrees are contracted where they lie, and only prefixes that cross a boundary are merged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftloom.session import materialize, table

#: Bytes of a turn's digest; conversations that are numbered together and start alike; numbers of starting turns that may be shared.
DIGEST, FAMILY, STARTS = 16, 5, 9
#: Bits of a conversation's number within a piece of a record's list of numbers: at most 4096 are joined to one string at once.
PIECE_BITS = 12
NO_ENDS = hashlib.sha256(b"").hexdigest()

_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, prefix string, parent_prefix string, open boolean"


def rebuild(turns: DataFrame) -> DataFrame:
    """(conv_id, key, sizes) of each conversation of (conv_id, turn, role, text): digests of its rebuilt turns in a row and the bytes of their texts.

    Turns go by number, null first, those of equal number by digest; a null role or text is empty. Conversation c takes
    the first crc32(c) % 9 turns from conversation c - c % 5, all if it has fewer and none if there is none, and goes on with
    its own after as many. Rows without a conversation's number are of none and left out; of an empty table nothing
    comes. Texts are hashed before they are shuffled: a turn is 24 bytes from there on, and a conversation's turns meet in one record.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.where("conv_id is not null").select(
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), "conv_id", "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("size")
    )
    own = rows.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "size"))).alias("own"))
    head = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("own", 1, STARTS - 1))).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % STARTS).cast("int")
    none = F.array().cast(own.schema["own"].dataType)
    whole = own.withColumn("head", F.coalesce(head, none)).withColumn("h", h)
    whole = whole.select("conv_id", F.concat(F.slice("head", F.lit(1), F.col("h")), F.slice("own", F.col("h") + 1, F.greatest(F.size("own"), F.lit(1)))).alias("turns"))
    return whole.select("conv_id", F.unhex(F.array_join("turns.digest", "")).alias("key"), F.col("turns.size").alias("sizes"))


def _streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, sha256) of (key, piece, ids), sorted: pieces of one key go through one hash, one after the other."""
    key, state = None, None
    for batch in batches:
        done = []
        for k, ids in zip(batch["key"], batch["ids"], strict=True):
            k = bytes(k)
            if k != key:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pd.DataFrame(done, columns=["key", "ends"])
    if state is not None:
        yield pd.DataFrame([(key, state.hexdigest())], columns=["key", "ends"])


def records(conversations: DataFrame) -> DataFrame:
    """(key, sizes, n, low, ends) of each distinct row of turns: how many conversations it is, the smallest, and the hash of all their numbers.

    Numbers are joined in pieces of at most 4096. A hash takes them in order, so the pieces of a record that has
    several stream through one, a piece at a time; all other hashes are Spark's.
    """
    pieces = conversations.groupBy("key", F.shiftright("conv_id", PIECE_BITS).alias("piece")).agg(
        F.first("sizes").alias("sizes"), F.count("*").alias("n"), F.min("conv_id").alias("low"),
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"),
    )
    pieces = materialize(pieces, "pieces")
    sums = pieces.groupBy("key").agg(
        F.first("sizes").alias("sizes"), F.sum("n").alias("n"), F.min("low").alias("low"), F.count("*").alias("n_pieces"), F.first("ids").alias("ids")
    )
    sums = materialize(sums.withColumn("ends", F.when(F.col("n_pieces") == 1, F.sha2("ids", 256))).drop("ids"), "sums")
    many = sums.where("n_pieces > 1")
    ordered = pieces.join(many.select("key"), "key", "left_semi").select("key", "piece", "ids").repartition("key").sortWithinPartitions("key", "piece")
    hashed = ordered.select("key", "ids").mapInPandas(_streamed, "key binary, ends string")
    return sums.where("n_pieces = 1").drop("n_pieces").unionByName(many.drop("n_pieces", "ends").join(hashed, "key"))


def shared(a: bytes | None, b: bytes | None) -> int:
    """How many turns two rows have in common from their start; -1 if there is no second."""
    if a is None or b is None:
        return -1
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[(low * DIGEST) : (mid * DIGEST)] == b[(low * DIGEST) : (mid * DIGEST)] else (low, mid - 1)
    return low


class Forest:
    """The nodes of a range of sorted records, by unions along its edges in descending depth."""

    def __init__(self, keys: list[bytes], n: np.ndarray, low: np.ndarray, before: bytes | None, after: bytes | None) -> None:
        m = len(keys)
        self.left, self.right = shared(before, keys[0]), shared(keys[-1], after)
        edge = [shared(a, b) for a, b in zip(keys, keys[1:], strict=False)]
        on = [*edge, self.right]
        #: Of each node (the first m are the records themselves): depth, first and last record, sums, children.
        self.depth = [len(k) // DIGEST for k in keys]
        self.first, self.last = list(range(m)), list(range(m))
        self.n, self.low = n.tolist(), low.tolist()
        # a record that the next one goes on from is no leaf
        self.leaves = [int(on[i] < self.depth[i]) for i in range(m)]
        self.children: list[list[int]] = [[] for _ in range(m)]
        top, to = list(range(m)), list(range(m))

        def find(i: int) -> int:
            while to[i] != i:
                to[i] = to[to[i]]
                i = to[i]
            return i

        for i in sorted(range(m - 1), key=lambda i: (-edge[i], i)):
            a, b = find(i), find(i + 1)
            x, y = top[a], top[b]
            if self.depth[x] > edge[i]:  # a new branching node; else the left part ends there already
                self.depth.append(edge[i])
                self.first.append(self.first[x])
                self.last.append(self.last[x])
                self.n.append(self.n[x])
                self.low.append(self.low[x])
                self.leaves.append(self.leaves[x])
                self.children.append([x])
                x = len(self.depth) - 1
            self.children[x].append(y)
            self.last[x] = self.last[y]
            self.n[x] += self.n[y]
            self.low[x] = min(self.low[x], self.low[y])
            self.leaves[x] += self.leaves[y]
            to[b] = a
            top[a] = x
        self.root, self.size = top[find(0)], m

    def starts_before(self, x: int, depth: int) -> bool:
        return self.first[x] == 0 and depth <= self.left

    def is_open(self, x: int, depth: int) -> bool:
        return self.starts_before(x, depth) or (self.last[x] == self.size - 1 and depth <= self.right)

    def order(self) -> list[int]:
        """Every node after its children."""
        out, rest = [], [self.root]
        while rest:
            x = rest.pop()
            out.append(x)
            rest.extend(self.children[x])
        return out[::-1]


def range_nodes(rows: pd.DataFrame, before: bytes | None, after: bytes | None) -> pd.DataFrame:
    """Nodes of a range of records between two neighbours. Of an open node, sums over this range alone.

    A node's own part of what is saved is the bytes of its last text times its members here, once less in the range where it begins.
    """
    rows = rows.sort_values("key", kind="stable", ignore_index=True)
    keys = [bytes(k) for k in rows["key"]]
    sizes, ends = rows["sizes"].tolist(), rows["ends"].tolist()
    f = Forest(keys, rows["n"].to_numpy(np.int64), rows["low"].to_numpy(np.int64), before, after)
    parent = {y: x for x, ys in enumerate(f.children) for y in ys}
    saved, out = {}, []

    def prefix(x: int, depth: int) -> str | None:
        return hashlib.md5(keys[f.first[x]][: depth * DIGEST]).hexdigest() if f.is_open(x, depth) else None

    for x in f.order():
        t, up = f.depth[x], parent.get(x)
        total = sum(saved[y] for y in f.children[x])
        n_children = sum(not f.starts_before(y, t + 1) for y in f.children[x])
        own = sizes[f.first[x]]
        # down the chain of single children that ends in this node
        for d in range(t, (f.depth[up] if up is not None else -1), -1):
            old = f.starts_before(x, d)
            total += (f.n[x] - (not old)) * (int(own[d - 1]) if d else 0)
            above = up if up is not None and d - 1 == f.depth[up] else x
            of_parent = prefix(above, d - 1) if d else None
            sha = ends[f.first[x]] if d == t and len(keys[f.first[x]]) == t * DIGEST else None
            out.append((f.low[x], d, f.low[above] if d and of_parent is None else None, f.n[x], n_children, f.leaves[x], total, sha, prefix(x, d), of_parent, f.is_open(x, d)))
            n_children = int(not old)
        saved[x] = total
    return pd.DataFrame(out, columns=[c.split()[0] for c in _NODE.split(", ")]).astype({"parent_conv_id": "Int64"})


def _range_of(pair_left: pa.Table, pair_right: pa.Table) -> pa.Table:
    bound = pair_right.to_pylist()
    nodes = range_nodes(pair_left.select(["key", "sizes", "n", "low", "ends"]).to_pandas(), bound[0]["before"], bound[0]["after"])
    types = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    schema = pa.schema([(c.split()[0], types[c.split()[1]]) for c in _NODE.split(", ")])
    return pa.Table.from_pandas(nodes, schema=schema, preserve_index=False)


def trie(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """All nodes of the trie of ``rows`` (key, sizes, n, low, ends), which are distinct; ``parts`` ranges, by default as many as Spark makes.

    A row without turns is the root alone. Of an empty table nothing comes. A range's two neighbours are one row for
    each range; a node whose parent crosses a boundary finds it by a join.
    """
    dealt = rows.repartitionByRange(parts, "key") if parts else rows.repartitionByRange("key")
    ranged = materialize(dealt.withColumn("part", F.spark_partition_id()), "ranged")
    ends = ranged.groupBy("part").agg(F.min("key").alias("low_key"), F.max("key").alias("high_key"))
    order = Window.orderBy("part")
    bounds = ends.select("part", F.lag("high_key").over(order).alias("before"), F.lead("low_key").over(order).alias("after"))
    nodes = materialize(ranged.groupBy("part").cogroup(bounds.groupBy("part")).applyInArrow(_range_of, _NODE), "nodes")
    merged = nodes.where("open").groupBy("prefix", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent_prefix").alias("parent_prefix"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.max("ends_sha256").alias("ends_sha256"),
    )
    merged = materialize(merged, "merged")
    known = merged.select(F.col("prefix").alias("parent_prefix"), F.col("conv_id").alias("of_parent"))
    closed = nodes.where("not open")
    rest = closed.where("parent_prefix is not null").unionByName(merged, allowMissingColumns=True).drop("parent_conv_id")
    linked = rest.join(known, "parent_prefix", "left").withColumnRenamed("of_parent", "parent_conv_id")
    columns: list[Column] = [F.col(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    columns.append(F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
    return closed.where("parent_prefix is null").select(*columns).unionByName(linked.select(*columns))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of the rebuilt conversations."""
    conversations = materialize(rebuild(table(spark, sf_dir, "conversations")), "rebuilt")
    return trie(materialize(records(conversations), "records"))


SQL: dict[str, str] = {}
QUERIES = {"op11_prefix_trie": op11_prefix_trie}

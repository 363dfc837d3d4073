"""Near-duplicates by ProbMinHash over word shingles, banding and exact verification.

A shingle of weight w arrives at the times of a Poisson process of rate w, each time at a random register.
A register keeps the shingle that arrives first, so two texts agree in a register with the probability
Jaccard similarity of their weights. A shingle is dropped once its next arrival is later than the last
register's. Texts that agree in a band of registers are candidates; their shingle sets decide. A link is
the Jaccard similarity of sets, so every shingle has weight 1, however often a text repeats it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftloom.operators.graph import connected_components
from siftloom.session import Scratch, materialize, table

#: Words in a shingle, least Jaccard similarity of a link.
WORDS, SIMILAR = 5, 0.8
#: Bands of registers and registers in a band. At similarity 0.8 a pair shares no band once in 300,000.
BANDS, ROWS = 24, 4
#: Bytes of a shingle's hash that are stored and compared: of a thousand million pairs of different shingles none is expected to look equal.
STORED = 5
#: Numbers of rows, at most, that are sent to all executors (8 bytes each); of more, both sides are shuffled.
SENT_ROWS = 1_000_000
#: Shingles that are sketched at once.
SOME = 200_000

_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Shingle hashes of texts; one per Python worker."""

    def __init__(self) -> None:
        self.word = np.array([chr(c).isalnum() for c in range(0x10000)], dtype=bool)
        self.powers = self.inverses = np.zeros(0, dtype=np.uint64)

    def reach(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 2 * len(self.powers), 4096)
            steps = np.full(n, _BASE, dtype=np.uint64)
            back = np.full(n, _INVERSE, dtype=np.uint64)
            steps[0] = back[0] = 1
            self.powers, self.inverses = np.multiply.accumulate(steps), np.multiply.accumulate(back)

    def words(self, text: str) -> np.ndarray:
        """A hash of each word: each run of letters and digits of the lower-cased text."""
        c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        if not len(c):
            return np.zeros(0, dtype=np.uint64)
        inside = self.word[np.minimum(c, 0xFFFF)] | (c > 0xFFFF)
        edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.reach(len(c))
        upto = np.zeros(len(c) + 1, dtype=np.uint64)
        np.cumsum(_mix(c.astype(np.uint64) * _STEP) * self.powers[: len(c)], out=upto[1:])
        return _mix((upto[end] - upto[start]) * self.inverses[start])

    def shingles(self, text: str) -> np.ndarray:
        """Distinct shingle hashes, ascending. A text of fewer words is one shingle; one without words has none."""
        w = self.words(text)
        if not len(w):
            return np.zeros(0, dtype=np.uint64)
        k = min(WORDS, len(w))
        total = np.zeros(len(w) - k + 1, dtype=np.uint64)
        for j in range(k):
            total = total * _STEP + w[j : len(w) - k + 1 + j]
        return np.unique(_mix(total))


def sketch(hashes: np.ndarray, weights: np.ndarray, owners: np.ndarray, n: int, registers: int) -> np.ndarray:
    """ProbMinHash registers (n, registers) of many sets at once: the shingle that first arrives in each."""
    first = np.full(n * registers, np.inf)
    held = np.zeros(n * registers, dtype=np.uint64)
    last = np.full(n, np.inf)
    x, slow, owner, at = hashes, 1.0 / weights, owners, np.zeros(len(hashes))
    turn = 0
    while len(x):
        turn += 1
        r = _mix(x + np.uint64(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        at = at - np.log(((r >> np.uint64(11)).astype(np.float64) + 1) * (1 / 9007199254740993.0)) * slow
        live = at < last[owner]
        x, slow, owner, at, r = x[live], slow[live], owner[live], at[live], r[live]
        place = owner * registers + (_mix(r) % np.uint64(registers)).astype(np.int64)
        better = np.flatnonzero(at < first[place])
        better = better[np.argsort(-at[better], kind="stable")]  # the earliest is written last and stays
        first[place[better]] = at[better]
        held[place[better]] = x[better]
        last = first.reshape(n, registers).max(axis=1)
        live = at < last[owner]
        x, slow, owner, at = x[live], slow[live], owner[live], at[live]
    return held.reshape(n, registers)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One number for each band (n, BANDS)."""
    key = np.zeros((len(registers), BANDS), dtype=np.uint64)
    parts = registers.reshape(len(registers), BANDS, ROWS)
    for j in range(ROWS):
        key = _mix(key * _STEP + parts[:, :, j] + np.uint64(j + 1))
    return _mix(key + np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP)


_kept: list[Shingler] = []


def _shingler() -> Shingler:
    if not _kept:
        _kept.append(Shingler())
    return _kept[0]


def pack_hashes(hashes: np.ndarray) -> bytes:
    """The distinct first STORED bytes of hashes, ascending, in so many bytes each."""
    short = np.unique(hashes >> np.uint64(64 - 8 * STORED)).astype("<u8")
    return short.view(np.uint8).reshape(-1, 8)[:, :STORED].tobytes()


def unpack_hashes(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // STORED, 8), dtype=np.uint8)
    out[:, :STORED] = np.frombuffer(data, dtype=np.uint8).reshape(-1, STORED)
    return out.view("<u8").ravel()


def sketch_texts(texts: list[str]) -> tuple[list[bytes], list[bytes]]:
    """Of each text: its distinct shingles (pack_hashes), and its band keys as int64. Weights are 1: bands are those of the sets."""
    sets, keys, at = [], [], 0
    while at < len(texts):
        some, size = [], 0
        while at < len(texts) and (not some or size < SOME):
            some.append(_shingler().shingles(texts[at]))
            size += len(some[-1])
            at += 1
        hashes = np.concatenate(some)
        owners = np.repeat(np.arange(len(some)), [len(h) for h in some])
        bands = band_keys(sketch(hashes, np.ones(len(hashes)), owners, len(some), BANDS * ROWS)).view(np.int64)
        for h, b in zip(some, bands, strict=True):
            sets.append(pack_hashes(h))
            keys.append(b.astype("<i8").tobytes() if len(h) else b"")
    return sets, keys


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose shingle sets have a Jaccard similarity of SIMILAR or more."""

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ok = np.zeros(len(pdf), dtype=bool)
            for i, (x, y) in enumerate(zip(pdf["xs"], pdf["ys"], strict=True)):
                x, y = unpack_hashes(x), unpack_hashes(y)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                ok[i] = shared >= SIMILAR * (len(x) + len(y) - shared) - 1e-9
            yield pdf.loc[ok, ["a", "b"]]

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("xs"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("ys"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "xs", "ys").mapInPandas(verify, "a long, b long")


@F.pandas_udf(T.ArrayType(T.LongType()))
def _numbers(shingles: pd.Series) -> pd.Series:
    return pd.Series([unpack_hashes(x).view(np.int64) for x in shingles])


def _shared(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """``nodes`` (node, shingles) with n, the number of shingles, and shared, of those that another of the nodes has too.

    Shingles of one node alone are counted, so that no list of a shingle's nodes is ever made.
    """
    each = nodes.select("node", F.explode(_numbers("shingles")).alias("shingle"))
    alone = each.groupBy("shingle").agg(F.min("node").alias("node"), F.count("*").alias("k")).where("k = 1").groupBy("node").agg(F.count("*").alias("alone"))
    alone = scratch.store(alone, "alone")
    n = (F.length("shingles") / STORED).cast("bigint")
    return nodes.join(alone, "node", "left").select("node", "shingles", n.alias("n"), (n - F.coalesce("alone", F.lit(0))).alias("shared"))


def _least_common(n: Column, m: Column) -> Column:
    """Shingles that two sets of these sizes have in common if their similarity is SIMILAR or more."""
    return F.ceil(F.lit(SIMILAR / (1 + SIMILAR)) * (n + m) - 1e-9)


def _pairs_by_rare_shingles(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b), a < b: every two ``nodes`` (node, shingles, part) of different parts that can be similar; exact.

    Shingles are ordered by the number of nodes that have them. Two similar sets share one of their first shingles,
    so early in both that the rest of either still holds what must be in common. Of a shingle's rows those of the part
    that has most of them aren't paired with each other, so a large part costs a pair for each outsider alone.
    """
    each = scratch.store(nodes.select("node", F.explode(_numbers("shingles")).alias("shingle")), "shingles")
    counts = each.groupBy("shingle").agg(F.count("*").alias("times")).where("times > 1")
    lists = each.join(counts, "shingle").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("times", "shingle"))).alias("rare"))
    sized = nodes.select("node", "part", (F.length("shingles") / STORED).cast("bigint").alias("n"))
    # the shingles of one node alone come first in its order
    before = F.col("n") - F.size("rare")
    first = F.greatest(F.lit(0), F.col("n") - F.ceil(F.lit(SIMILAR) * F.col("n") - 1e-9) + 1 - before).cast("int")
    heads = lists.join(sized, "node").select("node", "part", "n", before.alias("before"), F.slice("rare", F.lit(1), first).alias("rare"))
    rows = heads.select("node", "part", "n", "before", F.posexplode("rare").alias("at", "s")).select(
        F.col("s.shingle").alias("shingle"), "node", "part", "n", (F.col("n") - F.col("before") - F.col("at")).alias("rest")
    )
    rows = scratch.store(rows, "rare")
    by_part = rows.groupBy("shingle", "part").agg(F.count("*").alias("k"))
    main = by_part.groupBy("shingle").agg(F.max_by("part", "k").alias("main"), F.count("*").alias("parts")).where("parts > 1").drop("parts")
    mixed = scratch.store(rows.join(main, "shingle"), "mixed")
    left = mixed.where("part <> main").select("shingle", *(F.col(c).alias(f"x_{c}") for c in ("node", "part", "n", "rest")))
    right = mixed.select("shingle", *(F.col(c).alias(f"y_{c}") for c in ("node", "part", "n", "rest")))
    able = (F.col("x_part") != F.col("y_part")) & (F.least("x_rest", "y_rest") >= _least_common(F.col("x_n"), F.col("y_n")))
    return left.join(right, "shingle").where(able).select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()


def linked_nodes(stored: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, part) of the rows of ``stored`` (node, shingles, bands), each of another text, that links join; part is the smallest node of those.

    Nodes of one bucket (a band and its value) are candidates. A node that has fewer than SIMILAR of its shingles
    in common with all other candidates together has no link and is left out. In each bucket the node that
    meets most others is compared with all others. Nodes of buckets that this doesn't join to one part are then
    compared wherever rare shingles don't rule out a link, whether they share a bucket or not. So a group of copies costs a pair for each member, not
    for each two, and no candidate pair is lost.
    """

    @F.pandas_udf("array<long>")
    def numbers(bands: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(b, dtype="<i8") for b in bands])

    exploded = scratch.store(stored.select("node", F.explode(numbers("bands")).alias("bucket")), "buckets")

    def together(rows: DataFrame) -> DataFrame:
        sizes = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
        return rows.join(sizes, "bucket")

    met = scratch.store(together(exploded).select("bucket", "node"), "met")
    candidates = scratch.store(stored.select("node", "shingles").join(met.select("node").distinct(), "node"), "candidates")
    sets = scratch.store(_shared(candidates, scratch).where(F.col("shared") >= F.lit(SIMILAR) * F.col("n") - 1e-9), "sets")
    rows = scratch.store(together(met.join(sets.select("node", "n", "shared"), "node")), "rows")
    # the node that meets most others is the pivot: of a group of copies that is the text they were made from
    rank = rows.groupBy("node").agg(F.sum("size").alias("met"))
    members = scratch.store(rows.drop("size").join(rank, "node"), "members")
    pivots = members.groupBy("bucket").agg(F.max(F.struct("met", -F.col("node"), "node", "n", "shared")).alias("p"))
    pivots = pivots.select("bucket", F.col("p.node").alias("a"), F.col("p.n").alias("na"), F.col("p.shared").alias("sa"))
    enough = F.least("shared", "sa") >= _least_common(F.col("n"), F.col("na"))
    pairs = members.join(pivots, "bucket").where((F.col("node") != F.col("a")) & enough)
    pairs = scratch.store(pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct(), "pairs")
    sets = sets.select("node", "shingles")
    links = scratch.store(_links(pairs, sets), "links")
    labels = scratch.store(connected_components(links, "a", "b", scratch), "components")

    named = members.join(labels, members.node == labels.id, "left").select("bucket", "node", F.coalesce("component", "node").alias("part"))
    mixed = named.groupBy("bucket").agg(F.min("part").alias("least"), F.max("part").alias("most")).where("least < most").select("bucket")
    open_nodes = named.join(mixed, "bucket").select("node", "part").distinct()
    open_nodes = scratch.store(sets.join(open_nodes, "node"), "open")
    more = scratch.store(_pairs_by_rare_shingles(open_nodes, scratch).join(pairs, ["a", "b"], "left_anti"), "pairs")
    links = links.union(scratch.store(_links(more, sets), "links"))
    labels = scratch.store(connected_components(links, "a", "b", scratch), "components")
    return labels.select(F.col("id").alias("node"), F.col("component").alias("part"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, name, class_id, class_size, kept) for each row of ``docs``; name is the md5 of the text.

    A class holds rows with equal texts and all that links of similarity SIMILAR or more join; class_id is its
    smallest key (null first), and one row, of that key, is kept; of rows of one key that which comes first in the
    table. Null texts count as empty; empty texts, and texts without words, are linked only to equal ones. Repeated
    rows are copies. Texts are taken whole, however long. Other columns are left out, whatever their
    names. An empty table gives an empty one. The result is stored.

    Equal texts are one node throughout; see linked_nodes() for the links.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumn("name", F.md5("text"))

    @F.pandas_udf("shingles binary, bands binary")
    def sketched(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            sets, keys = sketch_texts(list(texts))
            yield pd.DataFrame({"shingles": sets, "bands": keys})

    stored = scratch.store(rows.select("row", "key", "name", sketched("text").alias("s")).select("row", "key", "name", "s.shingles", "s.bands"), "sketches")
    # the first row of a text stands for its copies
    nodes = scratch.store(stored.groupBy("name").agg(F.min("row").alias("node")), "nodes")
    sets = stored.select(F.col("row").alias("node"), "shingles", "bands")
    copies = scratch.store(stored.select("row", "name").join(nodes, "name").where("row <> node").select(F.col("row").alias("node")), "copies")
    labels = linked_nodes(sets.join(F.broadcast(copies) if copies.count() <= SENT_ROWS else copies, "node", "left_anti"), scratch)
    joined = nodes.join(labels, "node", "left").select("name", F.coalesce("part", "node").alias("part"))
    named = scratch.store(stored.select("key", "row", "name").join(joined, "name").select("key", "name", "row", "part"), "named")
    classes = named.groupBy("part").agg(F.min(F.struct("key", "row")).alias("first"), F.count("*").alias("class_size"))
    result = named.join(classes, "part").select(
        F.col("key").alias(key), "name", F.col("first.key").alias("class_id"), "class_size", (F.col("row") == F.col("first.row")).alias("kept")
    )
    result = materialize(result, "classes")
    scratch.free()
    return result


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


QUERIES = {"op3_near_duplicates": op3_near_duplicates}
SQL: dict[str, str] = {}

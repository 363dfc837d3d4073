"""Token-id files under a canonical, length-limited Huffman code.

A file set is a folder with two Parquet tables. ``codebook`` holds the code length of every id that
occurs, from counts over the whole corpus; canonical codes follow from the lengths. ``blocks`` holds
runs of whole documents in ascending order of id: a bit string, in which every document starts at a byte,
and the bit offset of every ``LANE``-th id of a document. A block is decoded by itself, all its lanes
in step, by one table that maps the next ``LIMIT`` bits to an id and its length.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftloom.llm.words import fast_tokenizer
from siftloom.session import materialize, scratch_root, table

VOCABULARY, END_ID = "byte_bpe_50k.json", 0
#: Longest code in bits; ids between two checkpoints; ids after which a block ends.
LIMIT, LANE, BLOCK = 16, 256, 1 << 16
#: Words that a worker remembers. Texts, and characters of them, after which those read so far are encoded: the more, the fewer words are looked up.
REMEMBERED, TEXTS, CHARACTERS = 500_000, 2048, 1 << 23
#: Stands for a null key, before all others. Parts of the order of keys for each shuffle partition.
NULL_KEY, PARTS = -(1 << 63), 4


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for symbols of these positive counts, by package-merge."""
    n = len(counts)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need over {limit} bits")
    lengths = np.zeros(n, dtype=np.uint8)
    if n <= 1:
        return lengths + 1
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    levels, items = [], leaves
    levels.append(np.ones(n, dtype=bool))
    for _ in range(limit - 1):
        packages = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, packages])
        place = np.argsort(both, kind="stable")
        levels.append(place < n)
        items = both[place]
    take = 2 * n - 2
    for is_leaf in reversed(levels):
        used = int(is_leaf[:take].sum())
        lengths[order[:used]] += 1
        take = 2 * (take - used)
    return lengths


class Code:
    """Canonical code of the given ids and lengths: shorter codes first, ids ascending within a length."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, limit: int = LIMIT) -> None:
        order = np.lexsort((ids, lengths))
        ids, lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        # each code fills the next 2^(limit - length) places of the table
        span = np.left_shift(1, limit - lengths)
        first = np.concatenate([[0], np.cumsum(span)[:-1]])
        size = int(ids.max(initial=0)) + 1
        self.limit = limit
        self.code_of, self.length_of = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.int64)
        self.code_of[ids], self.length_of[ids] = (first >> (limit - lengths)).astype(np.uint64), lengths
        self.id_at, self.length_at = np.zeros(1 << limit, dtype=np.uint32), np.ones(1 << limit, dtype=np.uint8)
        end = int(span.sum())
        self.id_at[:end], self.length_at[:end] = np.repeat(ids, span), np.repeat(lengths, span)

    def encode(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Bits of documents of these sizes, each from a new byte on: bytes, first byte of each document (and the end), bit of each id."""
        length = self.length_of[ids]
        ends = np.cumsum(length)
        last = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
        in_bytes = -(-np.diff(last) // 8)
        first_byte = np.concatenate([[0], np.cumsum(in_bytes)])
        at = ends - length + np.repeat(first_byte[:-1] * 8 - last[:-1], sizes)
        word, offset = at >> 5, (at & 31).astype(np.uint64)
        part = self.code_of[ids] << (np.uint64(64) - offset - length.astype(np.uint64))
        out = np.zeros(int(first_byte[-1]) // 4 + 3, dtype=np.uint32)
        if len(ids):
            new = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sums = np.add.reduceat(part, new)
            out[word[new]] |= (sums >> np.uint64(32)).astype(np.uint32)
            out[word[new] + 1] |= (sums & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return out.astype(">u4").tobytes()[: int(first_byte[-1])], first_byte, at

    def decode(self, data: bytes, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of lanes that start at these bits and hold so many ids, one lane after the other."""
        raw = np.frombuffer(data + b"\0" * 8, dtype=np.uint8).astype(np.uint32)
        window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        out = np.zeros(int(counts.sum()), dtype=np.uint32)
        order = np.argsort(-counts, kind="stable")
        at, to = starts[order].astype(np.int64), (np.cumsum(counts) - counts)[order]
        live = np.searchsorted(-counts[order], -np.arange(1, int(counts.max(initial=0)) + 1), side="right")
        for step, n in enumerate(live):
            bits = at[:n]
            seen = (window[bits >> 3] << (bits & 7).astype(np.uint32)) >> np.uint32(32 - self.limit)
            out[to[:n] + step] = self.id_at[seen]
            bits += self.length_at[seen]
        return out


def token_ids(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """(key, n_tokens, ids): the ids of each text and an end id as little-endian uint16; null texts are empty, a null key is NULL_KEY."""
    import public_tokenizers

    path, end = public_tokenizers.path(vocabulary), int(end_id).to_bytes(2, "little")

    def encoded(texts: list[str]) -> pd.Series:
        return pd.Series([x + end for x in fast_tokenizer(path, "<u2", REMEMBERED).encode(texts)], dtype=object)

    @F.pandas_udf("binary")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        some: list[str] = []
        for texts in batches:
            some += [t or "" for t in texts.where(texts.notna(), "")]
            if len(some) >= TEXTS or sum(map(len, some)) >= CHARACTERS:
                yield encoded(some)
                some = []
        yield encoded(some)

    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NULL_KEY)).alias(key), ids(F.col(text)).alias("ids")).select(key, (F.length("ids") / 2).cast("long").alias("n_tokens"), "ids")


def count_ids(ids: DataFrame) -> DataFrame:
    """(id, n) over the whole corpus; each task sends one row for each id at most."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << 16, dtype=np.int64)
        for pdf in batches:
            total += np.bincount(np.frombuffer(b"".join(pdf["ids"]), dtype="<u2"), minlength=1 << 16)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"id": seen, "n": total[seen]})

    return ids.select("ids").mapInPandas(add, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_files(ids: DataFrame, path: str, key: str = "doc_id") -> None:
    """Writes the codebook and the blocks of a stored table of token_ids() to the folder ``path``.

    The codebook has a row for each id of the vocabulary that occurs; it alone passes the driver.
    """
    spark = ids.sparkSession
    rows = count_ids(ids).orderBy("id").collect()
    seen, counts = np.array([r.id for r in rows], dtype=np.int64), np.array([r.n for r in rows], dtype=np.int64)
    lengths = code_lengths(counts)
    spark.createDataFrame([(int(a), int(b)) for a, b in zip(seen, lengths, strict=True)], "id long, length int").coalesce(1).write.parquet(f"{path}/codebook")
    code = Code(seen, lengths)
    # parts of the order of keys, by a pass over the keys alone; any bounds give the same result
    parts = PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = np.unique(np.array(ids.approxQuantile(key, [i / parts for i in range(1, parts)], 0.001), dtype=np.float64)).astype(np.int64)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for begin in range(0, len(pdf), 128):
                part = pdf.iloc[begin : begin + 128]
                sizes = part["n_tokens"].to_numpy()
                flat = np.frombuffer(b"".join(part["ids"]), dtype="<u2")
                data, first, at = code.encode(flat, sizes)
                low = np.cumsum(sizes) - sizes
                keys = part[key].to_numpy()
                yield pd.DataFrame({
                    "part": np.searchsorted(bounds, keys), key: keys, "n_tokens": sizes,
                    "bits": [data[a:b] for a, b in zip(first[:-1], first[1:], strict=True)],
                    "marks": [(at[i : i + n : LANE] - 8 * f).astype("<u4").tobytes() for i, n, f in zip(low, sizes, first[:-1], strict=True)],
                })

    def assemble(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        file_no, block_no = -1, 0
        keys: list = []
        sizes: list[int] = []
        bits: list[bytes] = []
        marks: list[np.ndarray] = []
        length = total = 0

        def block() -> pd.DataFrame:
            return pd.DataFrame({
                "file_no": [file_no], "block_no": [block_no], "n_tokens": [total], "keys": [np.array(keys, dtype="<i8").tobytes()],
                "sizes": [np.array(sizes, dtype="<u8").tobytes()], "marks": [np.concatenate(marks).astype("<u8").tobytes()], "bits": [b"".join(bits)],
            })

        for pdf in batches:
            for p, k, n, b, m in zip(pdf["part"], pdf[key], pdf["n_tokens"], pdf["bits"], pdf["marks"], strict=True):
                if p != file_no:
                    if keys:
                        yield block()
                        keys, sizes, bits, marks, length, total = [], [], [], [], 0, 0
                    file_no, block_no = p, 0
                keys.append(k)
                sizes.append(n)
                bits.append(b)
                marks.append(np.frombuffer(m, dtype="<u4").astype(np.uint64) + np.uint64(8 * length))
                length, total = length + len(b), total + n
                if total >= BLOCK:
                    yield block()
                    keys, sizes, bits, marks, length, total, block_no = [], [], [], [], 0, 0, block_no + 1
        if keys:
            yield block()

    coded = ids.mapInPandas(encode, f"part int, {key} long, n_tokens long, bits binary, marks binary")
    ordered = coded.repartition(max(1, parts // PARTS), "part").sortWithinPartitions("part", key, F.md5("bits"))
    ordered.mapInPandas(assemble, "file_no int, block_no int, n_tokens long, keys binary, sizes binary, marks binary, bits binary").write.option(
        "compression", "uncompressed"
    ).parquet(f"{path}/blocks")


def read_files(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document of a folder, from its files alone.

    start is the number of ids of all documents before it. It comes from blocks' sizes, added up within
    each file and then over files.
    """
    book = spark.read.parquet(f"{path}/codebook").collect()
    code = Code(np.array([r.id for r in book], dtype=np.int64), np.array([r.length for r in book], dtype=np.int64))
    blocks = spark.read.parquet(f"{path}/blocks")

    def lanes(sizes: np.ndarray) -> np.ndarray:
        per = -(-sizes // LANE)
        counts = np.full(int(per.sum()), LANE, dtype=np.int64)
        counts[np.cumsum(per) - 1] = sizes - (per - 1) * LANE
        return counts

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for begin in range(0, len(pdf), 8):
                part = pdf.iloc[begin : begin + 8]
                each = [np.frombuffer(x, dtype="<u8").astype(np.int64) for x in part["sizes"]]
                shift = np.cumsum([0, *(len(b) for b in part["bits"])])[:-1] * 8
                starts = np.concatenate([np.frombuffer(m, dtype="<u8").astype(np.int64) + s for m, s in zip(part["marks"], shift, strict=True)])
                sizes = np.concatenate(each)
                ids = code.decode(b"".join(part["bits"]), starts, lanes(sizes)).astype("<u4").tobytes()
                end = np.cumsum(sizes)
                yield pd.DataFrame({
                    "file_no": np.repeat(part["file_no"].to_numpy(), [len(x) for x in each]),
                    "block_no": np.repeat(part["block_no"].to_numpy(), [len(x) for x in each]),
                    "in_block": np.concatenate([np.cumsum(x) - x for x in each]),
                    key: np.frombuffer(b"".join(part["keys"]), dtype="<i8"), "n_tokens": sizes,
                    "ids_crc32": [zlib.crc32(ids[4 * (b - n) : 4 * b]) for b, n in zip(end, sizes, strict=True)],
                })

    docs = blocks.drop("n_tokens").mapInPandas(decode, f"file_no int, block_no int, in_block long, {key} long, n_tokens long, ids_crc32 long")
    sizes = blocks.select("file_no", "block_no", "n_tokens")
    # one row for each file in this window
    files = sizes.groupBy("file_no").agg(F.sum("n_tokens").alias("n")).select(
        "file_no", (F.sum("n").over(Window.orderBy("file_no")) - F.col("n")).alias("file_start")
    )
    in_file = F.sum("n_tokens").over(Window.partitionBy("file_no").orderBy("block_no")) - F.col("n_tokens")
    starts = sizes.select("file_no", "block_no", in_file.alias("block_start")).join(files, "file_no")
    return docs.join(starts, ["file_no", "block_no"]).select(
        F.when(F.col(key) != NULL_KEY, F.col(key)).alias(key), (F.col("file_start") + F.col("block_start") + F.col("in_block")).alias("start"), "n_tokens", "ids_crc32"
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/token-files-{uuid.uuid4().hex}"
    write_files(materialize(token_ids(docs, VOCABULARY), "ids"), path)
    return read_files(spark, path)


QUERIES = {"op9_token_files": op9_token_files}
SQL: dict[str, str] = {}

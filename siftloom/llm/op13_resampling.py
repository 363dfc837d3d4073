"""Importance resampling of documents toward a target corpus, on hashed word n-grams, in Arrow kernels.

A document's features are its runs of one to three words, hashed into buckets. A bucket's gain is the
logarithm of its share in the target over its share in the corpus; a document's weight is the sum of its
features' gains. Gumbel noise from the key makes the highest scores a draw without replacement.

A batch of texts is lower-cased, split and dictionary-encoded by Arrow. Shifted dictionary indices form
the codes of pairs, pairs and a third index those of triples, and of each only the distinct ones are hashed:
a CRC of two strings in a row comes from theirs by a table for the second's length. Gains are taken by
bucket and summed over each text's segment. Texts are read twice, once to count and once to weigh; what
is shuffled is one row for each bucket and task, and four numbers for each document.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftloom.session import materialize, private, table

#: What parts words: every ASCII character but digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Longest run of words, buckets, fewest words of a document that may be drawn, documents drawn of each hundred, seed.
RUN, BUCKETS, LEAST_WORDS, PERCENT, SEED = 3, 10_000, 20, 5, 42
#: Bytes of text that are encoded at once.
BLOCK_BYTES = 16_000_000
#: Bytes of a word, at most, whose CRC is taken with other words'.
LONG_WORD = 32


def _byte_table() -> np.ndarray:
    """What each low byte of a CRC register adds as it is shifted out."""
    return np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], dtype=np.uint32)


def word_crcs(words: pa.Array, table: np.ndarray) -> np.ndarray:
    """CRC of each word's bytes: byte by byte for all words at once, long words by themselves."""
    starts = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)
    lengths = np.diff(starts)
    crc = np.full(len(words), 0xFFFFFFFF, dtype=np.uint32)
    for j in range(min(LONG_WORD, int(lengths.max(initial=0)))):
        on = np.flatnonzero((lengths > j) & (lengths <= LONG_WORD))
        crc[on] = table[(crc[on] ^ data[starts[on] + j]) & np.uint32(0xFF)] ^ (crc[on] >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(lengths > LONG_WORD):
        crc[i] = zlib.crc32(data[starts[i] : starts[i + 1]])
    return crc


class _Shifts:
    """CRC registers moved on by numbers of bytes: a table of the four bytes' images for each number that has been asked for."""

    def __init__(self) -> None:
        self.of: dict[int, int] = {}
        self.images = np.zeros((0, 4, 256), dtype=np.uint32)
        base = self.table = _byte_table()
        #: Images of the 32 bits after 1, 2, 4, ... bytes.
        bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
        self.doubled = [base[bits & 0xFF] ^ (bits >> np.uint32(8))]

    def _times(self, images: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), dtype=np.uint32)
        for k in range(32):
            out ^= np.where(x >> np.uint32(k) & np.uint32(1), images[k], np.uint32(0))
        return out

    def rows(self, lengths: np.ndarray) -> np.ndarray:
        """The place in ``images`` of each length."""
        distinct, which = np.unique(lengths, return_inverse=True)
        new = [int(n) for n in distinct if int(n) not in self.of]
        tables = []
        for n in new:
            bits, k = np.uint32(1) << np.arange(32, dtype=np.uint32), 0
            while n >> k:
                if len(self.doubled) == k:
                    self.doubled.append(self._times(self.doubled[-1], self.doubled[-1]))
                if n >> k & 1:
                    bits = self._times(self.doubled[k], bits)
                k += 1
            every = np.arange(256, dtype=np.uint32)
            tables.append(np.stack([self._times(bits, every << np.uint32(8 * b)) for b in range(4)]))
            self.of[n] = len(self.of)
        if tables:
            self.images = np.concatenate([self.images, np.stack(tables)])
        return np.array([self.of[int(n)] for n in distinct], dtype=np.int64)[which]

    def join(self, first: np.ndarray, row: np.ndarray, second: np.ndarray) -> np.ndarray:
        """CRC of two strings in a row, from theirs and the row of the second's length."""
        out = second.copy()
        for b in range(4):
            out ^= self.images[row, b, first >> np.uint32(8 * b) & np.uint32(0xFF)]
        return out


class Runs(NamedTuple):
    """Features of a block of texts: words of each text; for each length of run, the buckets of distinct runs and which of them stand in the texts, in order."""

    words: np.ndarray
    buckets: list[np.ndarray]
    which: list[np.ndarray]


_shifts: list[_Shifts] = []


def runs(texts: pa.Array, n_buckets: int = BUCKETS) -> Runs:
    """The features of a block of texts; a null text has none."""
    if not _shifts:
        _shifts.append(_Shifts())
    shifts = _shifts[0]
    parts = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), SEPARATORS)
    flat, owner = pc.list_flatten(parts), pc.list_parent_indices(parts)
    full = pc.not_equal(flat, "")  # a separator at an end leaves an empty part
    coded, owner = flat.filter(full).dictionary_encode(), owner.filter(full).to_numpy()
    spelled = coded.dictionary.cast(pa.string())
    words, n = coded.indices.to_numpy().astype(np.int64), max(1, len(spelled))
    crc = word_crcs(spelled, shifts.table)
    lengths = pc.binary_length(spelled).to_numpy(zero_copy_only=False).astype(np.int64)
    after = shifts.join(np.full(len(crc), zlib.crc32(b" "), dtype=np.uint32), shifts.rows(lengths), crc)  # of a space and the word
    row = shifts.rows(lengths + 1)
    out = Runs(np.bincount(owner, minlength=len(texts)).astype(np.int64), [(crc % np.uint32(n_buckets)).astype(np.int64)], [words])
    run, run_crc = words, crc
    for k in range(1, RUN):
        # a run of k words and the word k places on, where both are of one text
        inside = owner[k:] == owner[:-k]
        start, last = run[: len(words) - k], words[k:]
        distinct, which = np.unique((start * n + last)[inside], return_inverse=True)
        first, word = np.divmod(distinct, n)
        run_crc = shifts.join(run_crc[first], row[word], after[word])
        out.buckets.append((run_crc % np.uint32(n_buckets)).astype(np.int64))
        out.which.append(which)
        run = np.full(len(start), -1, dtype=np.int64)
        run[inside] = which
    return out


def _blocks(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in blocks of about ``BLOCK_BYTES``; a longer text is a block of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK_BYTES, side="right")))
        yield texts.slice(at, to - at)
        at = to


def bucket_counts(docs: DataFrame, text: str = "text", n_buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; one row for each bucket reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, dtype=np.int64)
        for batch in batches:
            for block in _blocks(batch.column(0)):
                r = runs(block, n_buckets)
                for buckets, which in zip(r.buckets, r.which, strict=True):
                    total += np.bincount(buckets[which], minlength=n_buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["bucket", "n"])

    out = np.zeros(n_buckets, dtype=np.int64)
    for r in docs.select(text).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share in the target over that in the source, one added to each count; floors."""
    s_all, t_all, n = float(source.sum()), float(target.sum()), float(len(source))
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_features, weight) of each row of ``docs``, in its partitions; other columns are left out.

    A null or empty text has no features and the weight 0. Repeated rows and null keys each have their row;
    texts of any length are taken whole; of an empty table nothing comes.
    """
    n_buckets = len(gains)
    names = ["key", "n_words", "n_features", "weight"]

    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, weight = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
            for block in _blocks(batch.column(1)):
                r = runs(block, n_buckets)
                total = np.zeros(len(block), dtype=np.int64)
                for k, (buckets, which) in enumerate(zip(r.buckets, r.which, strict=True)):
                    ends = np.cumsum(np.maximum(r.words - k, 0))
                    sums = np.concatenate([[0], np.cumsum(gains[buckets].take(which))])
                    total += np.diff(sums[np.concatenate([[0], ends])])
                n_words.append(r.words)
                weight.append(total)
            n = np.concatenate(n_words)
            features = sum(np.maximum(n - k, 0) for k in range(RUN))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(features), pa.array(np.concatenate(weight))], names)

    of_key = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(weights, f"key {of_key}, n_words long, n_features long, weight long").withColumnRenamed("key", key)


def draw(rows: DataFrame, key: str = "doc_id", percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """Adds ``score`` and ``rank`` to (``key``, n_words, n_features, weight, ...).

    Of the n rows of at least ``least_words`` words the n * percent // 100 of the highest scores have the ranks 1, 2, 3, ...;
    ties go to the smaller key, a null key before all. Other rows have none. Ranks are counted within ranges of
    the order and added up over the ranges before, so no task sees more than a range. Repeated rows
    have ranks of their own.
    """
    part, start, n, place = private(rows.withColumns({"score": F.lit(0), "rank": F.lit(0)}), "_part", "_start", "_n", "_place")
    hashed = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((hashed + 0.5) / 4294967296.0)))
    rows = rows.withColumn("score", (F.col("weight") + noise).cast("long"))
    order = [F.desc("score"), F.asc_nulls_first(key), F.asc("n_features")]
    rows = materialize(rows.repartitionByRange(F.col("n_words") < least_words, *order).withColumn(part, F.spark_partition_id()), "scored")
    may = rows.where(F.col("n_words") >= least_words)
    sizes = may.groupBy(part).agg(F.count("*").alias(n))
    drawn = (may.agg(F.count("*")).first()[0] or 0) * percent // 100
    # one row for each range
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(start))
    near = may.join(starts.where(F.col(start) < drawn), part).withColumn(place, F.row_number().over(Window.partitionBy(part).orderBy(*order)) + F.col(start))
    near = near.withColumn("rank", F.when(F.col(place) <= drawn, F.col(place)).cast("long"))
    far = may.join(starts.where(F.col(start) >= drawn), part).withColumn("rank", F.lit(None).cast("long"))
    rest = rows.where((F.col("n_words") < least_words) | F.col("n_words").isNull()).withColumn("rank", F.lit(None).cast("long"))
    columns = [c for c in rows.columns if c != part] + ["rank"]
    return near.select(*columns).unionByName(far.select(*columns)).unionByName(rest.select(*columns))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The draw from documents toward the texts of benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gains = bucket_gains(bucket_counts(docs), bucket_counts(table(spark, sf_dir, "benchmark")))
    return draw(materialize(weigh(docs, gains), "weights")).select("doc_id", "n_features", "weight", "score", "rank", "n_words")


SQL: dict[str, str] = {}
QUERIES = {"op13_importance_resampling": op13_importance_resampling}

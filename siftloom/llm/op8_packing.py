"""Best-fit packing of token sequences, planned on the histogram of lengths.

The plan sees only how many pieces have each length (at most ``capacity`` numbers) and places whole runs
of equal pieces into whole runs of equal sequences. Pieces then take planned slots by their rank among
pieces of the same length.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from siftloom.llm.words import fast_tokenizer
from siftloom.session import materialize, private, table

CAPACITY, END_ID = 2048, 0
VOCABULARY = "word_bpe_49k.json"
#: Pieces that are ranked together, about.
RANK_GROUP = 5000

PLAN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("length", "rank_from", "rank_to", "first_sequence", "offset")])


def plan_best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(length, rank_from, rank_to, first_sequence, offset): ranks from rank_from up to rank_to, exclusive, go to
    first_sequence and the following sequences, one each, at that offset.

    Longest first; each piece goes to the open sequence with the least room that still takes it, else to a
    new one. Pieces of one length and sequences of one fill are handled as runs, so the plan's size depends
    on the number of lengths, not of pieces.
    """
    runs: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, number) of runs with that fill
    rooms: list[int] = []  # sorted rooms that have runs
    plan, opened = [], 0
    import bisect

    def keep(room: int, first: int, n: int) -> None:
        if room <= 0:
            return
        if room not in runs:
            bisect.insort(rooms, room)
            runs[room] = []
        heapq.heappush(runs[room], (first, n))

    for length in sorted((k for k, n in histogram.items() if n > 0), reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens doesn't fit {capacity}")
        rank, count = 0, histogram[length]
        while rank < count:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                # a new sequence takes as many of this length as fit, layer by layer
                left, each = count - rank, capacity // length
                full, rest = divmod(left, each)
                for layer in range(each):
                    n = full + (1 if layer < rest else 0)
                    if n:
                        # the sequence that is not full stands last
                        plan.append((length, rank, rank + n, opened, layer * length))
                        rank += n
                keep(capacity - each * length, opened, full) if full else None
                if rest:
                    keep(capacity - rest * length, opened + full, 1)
                opened += full + (1 if rest else 0)
                continue
            room = rooms[at]
            first, n = heapq.heappop(runs[room])
            if not runs[room]:
                del runs[room]
                rooms.pop(at)
            take = min(n, count - rank)
            plan.append((length, rank, rank + take, first, capacity - room))
            rank += take
            if take < n:
                keep(room, first + take, n - take)
            keep(room - length, first, take)
    return plan


def token_pieces(docs: DataFrame, vocabulary: str, text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Adds piece, start, length and ids_crc32: each text's ids and an end id, cut at every ``capacity`` ids.

    A null or empty text is the end id alone; texts are encoded whole, as the tokenizers library does it. Columns of those
    names are replaced, others kept and repeated for each piece; repeated rows are separate documents. An empty table gives an empty one.
    """
    import public_tokenizers

    path, end = public_tokenizers.path(vocabulary), int(end_id).to_bytes(4, "little")

    @F.pandas_udf("array<struct<piece: int, start: long, length: long, ids_crc32: long>>")
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for ids in fast_tokenizer(path, "<u4").encode([t or "" for t in texts.where(texts.notna(), "")]):
                ids += end
                out.append([
                    {"piece": k, "start": at // 4, "length": len(part := ids[at : at + 4 * capacity]) // 4, "ids_crc32": zlib.crc32(part)}
                    for k, at in enumerate(range(0, len(ids), 4 * capacity))
                ])
            yield pd.Series(out)

    keep = [c for c in docs.columns if c not in ("piece", "start", "length", "ids_crc32")]
    (own,) = private(docs, "_piece")
    return docs.select(*keep, F.explode(pieces(F.col(text))).alias(own)).select(*keep, f"{own}.*")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to a stored table of pieces with doc_id, piece and length.

    Ranks within a length come from salted groups: rows meet only with those of their length and salt,
    and the salts' sizes, added up, give where each starts. So a length that very many pieces share is
    ranked in many tasks; the salt is a row's number in the table, so that rows of one id are dealt out too. Repeated rows
    are separate pieces, null ids and ties in any order. Columns of the two names are replaced, others kept, whatever their
    names. An empty table gives an empty table.
    """
    spark = pieces.sparkSession
    cols = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    row, salt, before, size, rank, from_, to, first, offset, length = private(pieces, "_row", "_salt", "_before", "_size", "_rank", "_from", "_to", "_first", "_offset", "_length")
    rows = pieces.select(*cols)
    counts = rows.groupBy("length").count().collect()  # one row for each length, at most ``capacity`` of them
    histogram = {r[0]: r[1] for r in counts}
    plan = spark.createDataFrame(plan_best_fit(histogram, capacity), PLAN).toDF(length, from_, to, first, offset)
    salts = max([1, *(-(-n // RANK_GROUP) for n in histogram.values())])
    salted = rows.withColumn(row, F.monotonically_increasing_id()).withColumn(salt, F.pmod(F.xxhash64(row), F.lit(salts)))
    earlier = Window.partitionBy("length").orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
    starts = salted.groupBy("length", salt).agg(F.count("*").alias(size)).select("length", salt, F.coalesce(F.sum(size).over(earlier), F.lit(0)).alias(before))
    within = Window.partitionBy("length", salt).orderBy(row)
    ranked = salted.withColumn(rank, F.row_number().over(within) - 1).join(starts, ["length", salt]).withColumn(rank, F.col(before) + F.col(rank))
    # the plan has a bounded number of rows: runs of equal lengths in runs of equal fills
    slot = (F.col("length") == F.col(length)) & (F.col(rank) >= F.col(from_)) & (F.col(rank) < F.col(to))
    return ranked.join(F.broadcast(plan), slot).select(*cols, (F.col(first) + F.col(rank) - F.col(from_)).alias("sequence_id"), F.col(offset).alias("offset"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stored = materialize(token_pieces(docs, VOCABULARY).drop("text"), "pieces")
    return pack(stored).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES = {"op8_best_fit_packing": op8_best_fit_packing}
SQL: dict[str, str] = {}

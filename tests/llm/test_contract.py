"""Clashing column names, the packing query row by row, and pipeline stages against plain Python."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftloom.llm import op1_language, op4_mixing, op5_toxicity, op6_line_join, op8_packing, op10_media

SF = "/root/testdata/sf0.001"
CLASHING = ("_j", "_p", "_s", "_f", "_name", "_key", "_n", "_row", "_rows", "_salt", "_rank", "_before", "_length", "rank_from", "_judged", "_piece", "_stored", "_features", "_removed", "_left", "_copies", "_copy", "key", "name")
TEXTS = ["one two three four five", "one two three four five\nsix seven eight", "", None, "one two three four five\nsix seven eight"]


@pytest.fixture(scope="module")
def clashing(spark):
    docs = spark.createDataFrame([(i, t, "en", "src1", 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string, source string, n_chars long")
    return docs.select("*", *(F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")).alias(c) for c in CLASHING))


def kept(rows):
    return all(r[c] == f"{c}:{r.doc_id}" for r in rows for c in CLASHING)


def test_clashing_names(spark, clashing):
    rows = op1_language.predict(clashing, op1_language.fit_profiles(clashing)).collect()
    assert len(rows) == 5 and kept(rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(5)], "doc_id long, toxic int")
    rows = op5_toxicity.score_texts(clashing, op5_toxicity.fit_index(clashing, labels)).collect()
    assert len(rows) == 5 and kept(rows)
    rows = op6_line_join.remove_lines(clashing).collect()
    assert sorted((r.doc_id, r.text) for r in rows) == [(0, TEXTS[0]), (1, "six seven eight"), (2, ""), (3, None)] and kept(rows)
    pieces = op8_packing.token_pieces(clashing, op8_packing.VOCABULARY)
    rows = op8_packing.pack(pieces).collect()
    assert len(rows) == 5 and kept(rows) and pieces.columns == [*clashing.columns, "piece", "start", "length", "ids_crc32"]
    rows = op10_media.media_features(op10_media.store_texts(clashing)).collect()
    assert len(rows) == 5 and kept(rows)
    levels = op4_mixing.with_levels(clashing.withColumn("tokens", F.lit("x")).withColumn("domain", F.lit("y")))
    assert kept(levels.collect()) and op4_mixing.mix(levels.drop("key"), op4_mixing.LEVELS, {}, 500).count() == 5


def test_pipeline_with_clashing_names(spark, clashing):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, clashing, SF)
        assert got.columns == clashing.columns and kept(got.collect()), name


def test_packing_contract(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path(op8_packing.VOCABULARY))
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = np.array([*plain.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want[r.doc_id, k] = (at, len(part), zlib.crc32(part.tobytes()))
    got = op8_packing.op8_best_fit_packing(spark, SF).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want
    fills = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fills.get(r.sequence_id, 0)
        fills[r.sequence_id] = r.offset + r.length
    # best fit one piece at a time, longest first
    rooms = []
    for n in sorted((x[1] for x in want.values()), reverse=True):
        at = min((i for i, room in enumerate(rooms) if room >= n), key=lambda i: rooms[i], default=None)
        if at is None:
            rooms.append(2048 - n)
        else:
            rooms[at] -= n
    assert max(fills.values()) <= 2048 and len(fills) == len(rooms)


def test_pipeline_removes_lines_and_copies(spark):
    import corpus_pipeline

    words = [f"w{i}" for i in range(60)]
    long = " ".join(words)
    rows = [
        (1, long), (2, " ".join([*words[:58], "x", "y"])), (3, "a b c d e f g\n" + long), (4, "a b c d e f g"), (5, "a b c d e f h\nown line of five"),
        (5, "a b c d e f h\nown line of five"), (6, "own LINE of five"), (7, None), (8, "other words stand here alone"), (9, " ".join([*words[:50], *"klmnopqrst"])),
    ]
    docs = spark.createDataFrame([(i, t, "en", "src1", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {(r.doc_id, r.text) for r in corpus_pipeline.line_dedup(spark, docs, SF).collect()}
    # lines in order, each against all earlier ones; a document that loses all its words goes
    seen, want = [], set()
    for i, t in rows:
        left = []
        for line in (t or "").split("\n"):
            s = set(line.lower().split())
            if not s or not any(len(s & u) >= 0.8 * len(s | u) for u in seen):
                left.append(line)
            if s:
                seen.append(s)
        if "".join(left) or not t:
            want.add((i, "\n".join(left) if t else t))
    assert got == want
    # of shingles of five words, rows are joined to a class by similarity to any of its rows, and the first of a class stays
    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    classes = []
    for i, t in rows:
        own = shingles(t)
        near = [c for c in classes if any(t == u or (own and len(own & shingles(u)) >= 0.8 * len(own | shingles(u))) for _, u in c)]
        classes = [c for c in classes if c not in near] + [[*(x for c in near for x in c), (i, t)]]
    got = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SF).collect())
    assert got == sorted(min(i for i, _ in c) for c in classes) == [1, 4, 5, 6, 7, 8, 9]

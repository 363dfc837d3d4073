"""The text operators against brute force, round trips and held-out labels, on small and awkward inputs."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftloom.llm import op1_language, op2_secrets, op3_probminhash, op4_mixing, op5_toxicity, op6_line_join, op7_fingerprints, op8_packing, op9_token_files, op10_media
from siftloom.llm.words import FastTokenizer

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, score double"
LONG = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen. " * 400
ODD = [
    (1, None, None, None, 0, "a", 1.0), (2, "", "en", "s1", 0, "a", 1.0), (3, "!!! 123", "en", None, 7, "b", None), (4, LONG, "en", "s1", 1, None, 2.0),
    (4, LONG, "en", "s1", 1, None, 2.0), (5, "ein zwei\n\n  drei\tvier", None, "s2", 1, "c", 0.0), (6, "日本語 \U0001f600 é\x00b", "xx", "s2", 1, "c", 0.0), (None, "no id here at all", "en", "s3", 1, "d", 0.1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_language_held_out(spark):
    got = op1_language.op1_language_id(spark, SF).where("held_out").join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert got.where("lang = lang_pred").count() >= 0.95 * got.count() > 0


def test_language_odd(spark, odd, empty):
    profiles = op1_language.fit_profiles(odd)
    rows = op1_language.predict(odd, profiles).collect()
    assert len(rows) == len(ODD) and [r.lang_pred for r in rows[:3]] == ["und"] * 3 and all(0 <= r.score <= 1 for r in rows)
    assert op1_language.predict(empty, op1_language.fit_profiles(empty)).count() == 0


def test_secrets_positions(spark, empty):
    texts = ['é password = "abcdefghijkl" and deadbeefdeadbeef0', "token: short secret=" + "k" * 12, "AKIA" + "Z" * 14 + " AKIA12", "token: secret: abcdefghijklmnop", None]
    docs = spark.createDataFrame([(i, t, f"o{i}", "r") for i, t in enumerate(texts)], "doc_id long, text string, owner string, repo string")
    got = {r.doc_id: r.secrets for r in op2_secrets.scan_secrets(docs).collect()}
    kinds = {"assign": r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}
    least = {"assign": 12, "access": 18, "hex": 16}
    for i, t in enumerate(texts):
        want = {(k, *m.span()) for k, p in kinds.items() for m in re.finditer(p, t or "", re.ASCII) if len(m[2] if k == "assign" else m[0]) >= least[k]}
        assert {(s.kind, s.start, s.end) for s in got[i] if s.kind != "bare"} == want
    assert op2_secrets.scan_secrets(empty.withColumn("owner", F.col("source")).withColumn("repo", F.col("source"))).count() == 0


def test_secrets_ownership(spark):
    copied, own = "secret=abcdefgh12345678", "secret=zyxwvuts98765432"
    docs = spark.createDataFrame([(i, copied if i < 4 else own, f"o{i}", "r") for i in range(5)], "doc_id long, text string, owner string, repo string")
    got = {r.doc_id: r.secrets[0].verdict for r in op2_secrets.scan_secrets(docs).collect()}
    assert got == {0: "example", 1: "example", 2: "example", 3: "example", 4: "live"}


def shingles(text):
    w = re.findall(r"[^\W_]+", text.lower())
    k = min(5, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def test_near_duplicates(spark, odd, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    to = {k: k for k, _ in rows}

    def root(x):
        while to[x] != x:
            x = to[x]
        return x

    sets = {k: shingles(t) for k, t in rows}
    for i, (a, t) in enumerate(rows):
        for b, u in rows[:i]:
            both = len(sets[a] & sets[b])
            if t == u or (both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both)):
                x, y = sorted((root(a), root(b)))
                to[y] = x
    got = op3_probminhash.near_duplicates(docs).collect()
    assert {r.doc_id: r.class_id for r in got} == {k: root(k) for k, _ in rows}
    assert sum(r.kept for r in got) == len({root(k) for k, _ in rows})
    rows = op3_probminhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD) and sorted(r.class_size for r in rows) == [1, 1, 1, 1, 2, 2, 2, 2]
    assert op3_probminhash.near_duplicates(empty).count() == 0


def test_probminhash_estimates_similarity():
    rng = np.random.default_rng(1)
    a, b, both = (rng.integers(1, 1 << 63, n).astype(np.uint64) for n in (100, 100, 400))
    sets = [np.concatenate([a, both]), np.concatenate([b, both])]
    owners = np.repeat([0, 1], [len(x) for x in sets])
    regs = op3_probminhash.sketch(np.concatenate(sets), np.ones(len(owners)), owners, 2, 2048)
    assert abs((regs[0] == regs[1]).mean() - 400 / 600) < 0.05


def test_near_duplicates_with_a_repeated_passage(spark):
    rng = np.random.default_rng(3)
    texts = []
    for i in range(60):
        w = [f"w{i}x{n}" for n in rng.permutation(1000)[:400]]
        once, passage = " ".join(w), " ".join(w[:80])
        texts += [once, once + (" " + passage) * 200]
        assert len(shingles(texts[-2]) & shingles(texts[-1])) >= 0.8 * len(shingles(texts[-2]) | shingles(texts[-1]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in op3_probminhash.near_duplicates(docs).collect()}
    assert got == {i: i - i % 2 for i in range(len(texts))}


def test_mixture_takes_quota(spark, odd, empty):
    docs = op4_mixing.with_levels(spark.read.parquet(f"{SF}/documents.parquet")).select("doc_id", *op4_mixing.LEVELS, "tokens")
    got = op4_mixing.mix(docs, op4_mixing.LEVELS, op4_mixing.WEIGHTS, 600)
    total = docs.agg(F.sum("tokens")).first()[0]
    assert got.count() == docs.count() and got.agg(F.sum("taken")).first()[0] == total * 600 // 1000
    assert got.where("taken > copies * tokens or copies > 2").count() == 0
    assert op4_mixing.mix(op4_mixing.with_levels(odd).drop("key"), op4_mixing.LEVELS, {}, 500).count() == len(ODD)
    assert op4_mixing.mix(op4_mixing.with_levels(empty).drop("key"), op4_mixing.LEVELS, {}, 500).count() == 0


def test_block_max_search_is_exact(spark):
    rng = np.random.default_rng(2)
    n, terms = 300, 40
    rows = np.zeros((320, terms), dtype=np.float32)
    rows[:n] = rng.random((n, terms)) * (rng.random((n, terms)) < 0.1)
    rows[:n] /= np.maximum(np.linalg.norm(rows[:n], axis=1, keepdims=True), 1e-9)
    index = op5_toxicity.Index([str(i) for i in range(terms)], np.ones(terms), np.zeros(n, int), np.arange(n), rows, rows.reshape(5, 64, terms).max(axis=1))
    for _ in range(20):
        places = np.sort(rng.choice(terms, 5, replace=False))
        w = rng.random(5) / 2
        cos = rows[:n][:, places] @ w
        want = [i for i in np.lexsort((np.arange(n), -np.round(cos, 12)))[:15] if cos[i] > 0]
        assert index.nearest(places, w, 15)[0].tolist() == want


def test_toxicity_odd(spark, odd, empty):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(6)], "doc_id long, quality int, toxic int")
    index = op5_toxicity.fit_index(odd, labels)
    assert all(0 <= r.score <= 1 for r in op5_toxicity.score_texts(odd, index).collect())
    assert op5_toxicity.score_texts(empty, op5_toxicity.fit_index(empty, labels.limit(0))).count() == 0


def test_toxicity_counts_every_term(spark):
    # no word tells the classes apart in 20 examples, and every text has words of its own
    texts = [f"shared words common to all own{i} other{i} third{i}" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    index = op5_toxicity.fit_index(docs, labels)
    terms = [op5_toxicity.text_terms(t) for t in texts]
    df = {t: sum(t in x for x in terms) for x in terms for t in x}
    full = [{t: (1 + np.log(n)) * (np.log(41 / (1 + df[t])) + 1) for t, n in x.items()} for x in terms]
    norm = [np.sqrt(sum(w * w for w in x.values())) for x in full]
    places = {t: i for i, t in enumerate(index.terms)}
    known = op5_toxicity.Vocabulary(places)
    for i in index.names.tolist():
        assert all(t in places for t in terms[i])
        found, cosines = index.nearest(*index.vector(known.counts(texts[i])), 50)
        want = {j: sum(w * full[j].get(t, 0) for t, w in full[i].items()) / norm[i] / norm[j] for j in index.names.tolist()}
        assert dict(zip(index.names[found].tolist(), cosines.tolist(), strict=True)) == pytest.approx(want, abs=1e-6)
        assert index.names[found[0]] == i


def test_calibration_leaves_out_copies(spark, monkeypatch):
    # 30 copies of one text: each is judged by the others' votes only
    texts = ["copied text of many words"] * 30 + [f"copied text with number{i}" for i in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 30)) for i in range(60)], "doc_id long, toxic int")
    seen = []
    vote = op5_toxicity.Index.vote
    monkeypatch.setattr(op5_toxicity.Index, "vote", lambda self, found, cosines: seen.append(self.names[found].tolist()) or vote(self, found, cosines))
    index = op5_toxicity.fit_index(docs, labels)
    # no vote on a copy has another copy, and 15 others are found for each
    assert sum(all(n >= 30 for n in x) and len(x) == 15 for x in seen) >= (index.names < 30).sum() + (index.names >= 30).sum() // 2


def words(line):
    return frozenset(w for w in line.lower().replace("\t", " ").split(" ") if w)


def test_line_join(spark, odd, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lines = [(r.doc_id, i, words(x)) for r in docs.orderBy("doc_id").collect() for i, x in enumerate(r.text.split("\n"))]
    lines = [x for x in lines if len(x[2]) >= 1]
    want = {}
    for j, (d, i, s) in enumerate(lines):
        for _, _, t in lines[:j]:
            both = len(s & t)
            if both >= 0.8 * (len(s) + len(t) - both) - 1e-9:
                want.setdefault(d, []).append(i)
                break
    got = {r.doc_id: r.removed for r in op6_line_join.matched_lines(docs).collect()}
    assert {k: v for k, v in got.items() if v} == want
    assert op6_line_join.matched_lines(odd).count() == len(ODD)
    assert op6_line_join.remove_lines(odd).columns == odd.columns
    assert op6_line_join.matched_lines(empty).count() == 0


def test_lines_of_words_with_equal_hash_beginnings(spark, monkeypatch):
    """Words that the candidates' hashes mix up, and words that nearly all lines have, change no result."""
    monkeypatch.setattr(op6_line_join, "WORD_BITS", 3)
    monkeypatch.setattr(op6_line_join, "HOT", 5)
    pick = np.random.default_rng(3)
    base = [[f"w{x}" for x in pick.choice(30, 9, replace=False)] for _ in range(12)]
    lines = [" ".join(b[:k] + [f"x{j}"] + b[k + 1 :]) for j, b in enumerate(base * 4) for k in (j % 9,)]
    want = {i for i, x in enumerate(lines) if any(len(words(x) & words(y)) >= 0.8 * len(words(x) | words(y)) - 1e-9 for y in lines[:i])}
    got = op6_line_join.matched_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()
    assert 0 < len(want) < len(lines)
    assert {r.doc_id for r in got if r.removed} == want


def test_short_lines_are_removed(spark):
    rows = [(1, "Les.\nand ornd.\n\nLes."), (2, "les.\nornd. And\n\nmore"), (3, "\n \t"), (4, "les. more\nmore\n")]
    got = op6_line_join.matched_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.removed for r in got} == {1: [3], 2: [0, 1], 3: [], 4: [1]}
    assert {r.doc_id: r.class_id for r in got} == {1: 1, 2: 1, 3: 3, 4: 2}


def test_line_removal_keeps_one_of_repeated_rows(spark, odd):
    got = [(r.doc_id, r.text) for r in op6_line_join.remove_lines(odd).collect()]
    assert [t for k, t in got if k == 4] == [LONG]
    assert sorted(map(str, got)) == sorted(str((k, t)) for k, t in {(r[0], r[1]) for r in ODD})
    text = "first line of it\nsecond line with words\n\n\t"
    rows = [(None, text), (None, text), (7, "first line of it\na third one is here"), (7, "first line of it\na third one is here"), (8, "first line of it\n\t")]
    got = op6_line_join.remove_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, text), (7, "a third one is here")]


def test_fingerprints(spark, odd, empty):
    rows = sorted(((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()), reverse=True)
    got = {r.doc_id: r for r in op7_fingerprints.op7_fingerprints(spark, SF).collect()}
    for (k, t), (_, u) in zip(rows, rows[1:] + rows[:1], strict=True):
        edited = op7_fingerprints.edited_text(t, u)
        a, b = (set(op7_fingerprints.digests(x).tolist()) for x in (t, edited))
        assert got[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[k].n_chars == len(t)
        assert got[k].near_edited == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
    assert op7_fingerprints.fingerprint_neighbours(odd).count() == len(ODD)
    assert op7_fingerprints.fingerprint_neighbours(empty).count() == 0


def test_plan_fills_sequences():
    rng = np.random.default_rng(4)
    histogram = {int(k): int(n) for k, n in zip(rng.integers(1, 65, 30), rng.integers(1, 50, 30), strict=True)}
    used, spans = {}, {}
    for length, low, high, first, offset in op8_packing.plan_best_fit(histogram, 64):
        used.setdefault(length, []).extend(range(low, high))
        for s in range(first, first + high - low):
            spans.setdefault(s, []).append((offset, length))
    assert {k: sorted(v) for k, v in used.items()} == {k: list(range(n)) for k, n in histogram.items()}
    for places in spans.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(spans) <= 1.1 * -(-sum(k * n for k, n in histogram.items()) // 64) + 1


def test_packing_odd(spark, odd, empty):
    got = op8_packing.pack(op8_packing.token_pieces(odd, op8_packing.VOCABULARY)).collect()
    assert {(r.sequence_id, r.offset) for r in got} and len({(r.sequence_id, r.offset) for r in got}) == len(got)
    assert op8_packing.pack(op8_packing.token_pieces(empty, op8_packing.VOCABULARY)).count() == 0


@pytest.mark.parametrize(("name", "width"), [("word_bpe_49k.json", "<u4"), ("byte_bpe_50k.json", "<u2")])
def test_fast_tokenizer(name, width):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path(name))
    texts = ["a  b", "x\n\ny", " lead", "trail ", "tab\there", "\n", "a\n b", "don't  I'll go", "é <|endoftext|> q", "", "a\x1cb c", "ΣΑΣ σ d \r\n x", "'s\n't 're", "12 345\n6", "日本語\n次", "it's, don't. x'' A_b_ _. É. é.", "a\x00b c\x00", "...\n..", "éa. É", "İx ıy ß ẞ", "x».y «a»,", "<|startoftext|>", "word<|endoftext|>,", "a\u00a0b", "a\u0085b c", "_x_ (y) [z]. A's B't", "e\u0301 ªb ŉc", LONG]
    assert FastTokenizer(public_tokenizers.path(name), width).encode(texts) == [np.array(plain.encode(t, add_special_tokens=False).ids, dtype=width).tobytes() for t in texts]


def test_code_round_trip():
    rng = np.random.default_rng(6)
    counts = np.maximum(1, (1e6 / np.arange(1, 3001) ** 1.5)).astype(int)
    lengths = op9_token_files.code_lengths(counts, 16)
    assert lengths.max() <= 16 and sum(2.0 ** -lengths.astype(float)) <= 1
    code = op9_token_files.Code(np.arange(3000), lengths)
    sizes = np.array([0, 1, 700, 256])
    ids = rng.integers(0, 3000, sizes.sum())
    data, first, at = code.encode(ids, sizes)
    ends = np.cumsum(sizes)
    starts = np.concatenate([at[e - n : e : 256] for e, n in zip(ends, sizes, strict=True)])
    lanes = np.concatenate([np.diff(np.append(np.arange(0, n, 256), n)) for n in sizes if n])
    assert code.decode(data, starts, lanes).tolist() == ids.tolist()


def test_token_files(spark, odd, empty, tmp_path):
    op9_token_files.write_files(op9_token_files.token_ids(odd, op9_token_files.VOCABULARY), f"file://{tmp_path}/a")
    got = op9_token_files.read_files(spark, f"file://{tmp_path}/a").orderBy("start").collect()
    ids = sorted((r.doc_id, bytes(r.ids)) for r in op9_token_files.token_ids(odd, op9_token_files.VOCABULARY).collect())
    at = 0
    for r, (k, x) in zip(got, ids, strict=True):
        k = None if k == op9_token_files.NULL_KEY else k
        n = np.frombuffer(x, dtype="<u2").astype("<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (k, at, len(n), zlib.crc32(n.tobytes()))
        at += len(n)
    op9_token_files.write_files(op9_token_files.token_ids(empty, op9_token_files.VOCABULARY), f"file://{tmp_path}/b")
    assert op9_token_files.read_files(spark, f"file://{tmp_path}/b").count() == 0


def test_images(spark, odd, empty):
    rng = np.random.default_rng(8)
    for shape in ((5, 7), (64, 64), (1, 3)):
        image = rng.integers(0, 256, shape).astype(np.uint8)
        assert (op10_media.decode(op10_media.encode_pgm(image)) == image).all() and (op10_media.decode(op10_media.encode_bmp(image)) == image).all()
    image = rng.integers(0, 256, (12, 18)).astype(np.uint8)
    assert np.allclose(op10_media.area_resize(image, 4, 6), image.reshape(4, 3, 6, 3).mean(axis=(1, 3)))
    got = op10_media.media_features(op10_media.store_texts(odd)).collect()
    for r in got:
        raw = (r.text or "").encode()
        padded = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        assert r.payload_sha256 == hashlib.sha256(padded).hexdigest() and r.tail_crc32 == zlib.crc32(padded[-64:])
    assert op10_media.media_features(op10_media.store_texts(empty)).count() == 0


def test_pipeline_stages(spark, odd, empty):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (odd.select("doc_id", "text", "lang", "source", "n_chars"), empty.select("doc_id", "text", "lang", "source", "n_chars")):
            assert stage(spark, docs, SF).columns == docs.columns, name
            stage(spark, docs, SF).collect()
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_words_with_odd_white_space():
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    r, kinds = random.Random(11), ["a", "b", "Wort", "é", "日本", "1", "!", "'s", " ", "  ", "\n", "\n\n", "\t", "\xa0", " \n", "\r", "　", "\x1c", "\x0b", "\x85", "﻿", "<|"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        fast, plain = FastTokenizer(public_tokenizers.path(name)), Tokenizer.from_file(public_tokenizers.path(name))
        texts = ["a  b\tc", *("".join(r.choice(kinds) for _ in range(r.randrange(14))) for _ in range(3000))]
        for text, ids in zip(texts, fast.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_token_file_query(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array([*plain.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want[r.doc_id] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op9_token_files.op9_token_files(spark, SF).collect()} == want

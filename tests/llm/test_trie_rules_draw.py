"""The prefix trie, the divergence rules and the importance draw against plain Python, on small and awkward inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftloom.llm import op11_prefix_trie as trie
from siftloom.llm import op12_divergence as rules
from siftloom.llm import op13_resampling as draw

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, extra string, part int"


def plain_trie(rows):
    conv = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            conv[c].append((t is not None, t or 0, role or "", text or ""))
    conv = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in conv.items()}
    members = defaultdict(list)
    whole = {}
    for c, own in conv.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = conv.get(c - c % 5, [])[:h] + own[h:]
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    children, leaves, saved, out = Counter(), Counter(), Counter(), set()
    for p in sorted(members, key=len, reverse=True):
        if not children[p]:
            leaves[p] = 1
        saved[p] += (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        if p:
            children[p[:-1]] += 1
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(p))
        above = min(members[p[:-1]]) if p else None
        out.add((min(m), len(p), above, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def nodes(df, parts=None):
    rows = trie.trie(trie.records(trie.rebuild(df)), parts).collect()
    assert len(set(rows)) == len(rows)
    return set(map(tuple, rows))


@pytest.mark.parametrize(("seed", "parts"), [(1, None), (2, 1), (3, 5), (4, 60)])
def test_trie(spark, seed, parts):
    r = random.Random(seed)
    rows = []
    for c in [*range(40), *range(5000, 5020)]:  # turns of one number would go by their texts
        for t in range(r.choice([1, 1, 2, 3, 6, 12])):
            rows.append((c, None if t == 0 and r.random() < 0.5 else t, r.choice(["u", "a", None]), r.choice(["x", "yé", None, "", "日本"])))
    rows += [(None, 1, "u", "q"), (77, 3, "u", "long " * 20000), (78, None, None, None)]
    df = spark.createDataFrame([(*x, "e", 1) for x in rows], TURNS)
    assert nodes(df, parts) == plain_trie(rows)


def test_trie_of_many_copies(spark):
    # one conversation under numbers far apart: its list of numbers is in several pieces
    rows = [(c, t, "u", f"same {t}") for c in range(0, 60000, 1505) for t in range(3)] + [(c, 0, "u", "same 0") for c in range(5, 50, 5)]
    df = spark.createDataFrame([(*x, "e", 1) for x in rows], TURNS)
    assert nodes(df, 3) == plain_trie(rows)


def test_trie_of_repeated_rows_and_none(spark):
    rows = [(5, 0, "u", "a"), (5, 0, "u", "a"), (6, 0, "u", "a"), (9, 1, None, None)]
    assert nodes(spark.createDataFrame([(*x, "e", 1) for x in rows], TURNS)) == plain_trie(rows)
    assert nodes(spark.createDataFrame([], TURNS)) == set()


def test_trie_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert set(map(tuple, trie.op11_prefix_trie(spark, SF).collect())) == plain_trie(rows)


def base_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    hit = {i + k for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if windows[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit), failed)


ODD = [None, "", " \t\n\x0b\x0c\r ", "a b c a b c a b c", "x\n\nx\n x\ny\ny", "é日本\U0001f600 \xa0 # ## *$ <|>", "tick " * 3000, " ".join(f"w{i}" for i in range(20000)), "a b\x1cc d"]


def test_base_rules(spark):
    texts = [*ODD, *ODD[3:6], *(r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect())]
    df = spark.createDataFrame([(i, t, None if i % 5 == 0 else "en", "k") for i, t in enumerate(texts)], "doc_id long, text string, lang string, words string")
    rows = rules.judge(df).select("doc_id", *rules.COLUMNS).collect()
    assert {r.doc_id: tuple(r)[1:7] for r in rows} == {i: base_rules(t) for i, t in enumerate(texts)} and len(rows) == len(texts)
    assert not any(r.kept and r.base_failed for r in rows)
    assert rules.judge(df.limit(0)).count() == 0


def test_divergence_follows_quality(spark):
    sf = "/root/testdata/sf0.01"
    got = rules.op12_quality_divergence(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed")
    n = {(r.quality, r.kept): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert n[1, True] > 200 and n.get((1, False), 0) <= 0.01 * n[1, True] and n[0, False] > 20 and n.get((0, True), 0) <= 0.05 * n[0, False]


def test_divergence_formula(spark):
    counts, shares = [3, 0, 5, 2], [0.25, 0.25, 0.0, 0.5]
    df = spark.createDataFrame([(counts, 10, shares)], "c array<int>, n int, q array<double>")
    got = df.select(rules.divergence(F.col("c"), F.col("n"), F.col("q"))).first()[0]
    p, q = np.array(counts) / 10, np.array(shares)
    m = (p + q) / 2
    want = sum(x * math.log2(x / y) for x, y in zip(p, m, strict=True) if x) / 2 + sum(x * math.log2(x / y) for x, y in zip(q, m, strict=True) if x) / 2
    assert got == pytest.approx(want)


def test_small_languages_do_not_judge(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, text, "xx"), (2, "# " * 60, None)], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.kept, r.words_far) for r in rules.judge(df).collect()}
    assert got[1] == (True, None) and not got[2][0]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def plain_draw(docs, target):
    s, t = Counter(), Counter()
    found = [(d, *features(x)) for d, x in docs]
    for _, _, f in found:
        s.update(f)
    for x in target:
        t.update(features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (s_all + 10000.0) / ((s[b] + 1.0) * (t_all + 10000.0)))) for b in range(10000)]
    rows = []
    for d, n, f in found:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    may = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0], r[1]))
    ranks = {id(r): k for k, r in enumerate(may[: 5 * len(may) // 100], 1)}
    return Counter((*r[:4], ranks.get(id(r))) for r in rows)


def test_draw(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs += [(1000 + i, t) for i, t in enumerate(ODD)] + [(2000, "AÉb ÀB " * 30), (2000, "AÉb ÀB " * 30), (None, "no id " * 15), (2001, "x" * 5000 + " y z"), (2002, "a-b_c.d" * 9)]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()] + [None]
    df = spark.createDataFrame([(*x, "k") for x in docs], "doc_id long, text string, key string").repartition(3)
    gains = draw.bucket_gains(draw.bucket_counts(df), draw.bucket_counts(spark.createDataFrame([(t,) for t in target], "text string")))
    got = draw.draw(draw.weigh(df, gains)).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert Counter(map(tuple, got)) == plain_draw(docs, target)
    none = df.limit(0)
    assert draw.bucket_counts(none).sum() == 0 and draw.draw(draw.weigh(none, gains)).count() == 0


def test_draw_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = draw.op13_importance_resampling(spark, SF).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert Counter(map(tuple, got)) == plain_draw(docs, target)


def test_ties_go_to_the_smaller_key(spark):
    # one noise for all keys: scores are weights
    rows = spark.createDataFrame([(k, 30, 5, k % 3) for k in range(100)], "doc_id long, n_words long, n_features long, weight long")
    noise = {r.doc_id: r.score - r.weight for r in draw.draw(rows, percent=50).collect()}
    flat = spark.createDataFrame([(k, 30, 5, -noise[k]) for k in range(100)], rows.schema)
    got = {r.doc_id: r["rank"] for r in draw.draw(flat, percent=50).collect()}
    assert got == {k: k + 1 if k < 50 else None for k in range(100)}


def test_checksums_of_strings_in_a_row():
    r = random.Random(5)
    words = ["".join(r.choice("abé日z0") for _ in range(r.choice([0, 1, 3, 9, 40, 300]))) for _ in range(200)]
    shifts = draw._Shifts()
    crc = draw.word_crcs(pa.array(words), shifts.table)
    assert crc.tolist() == [zlib.crc32(w.encode()) for w in words]
    rows = shifts.rows(np.array([len(w.encode()) for w in words]))
    both = shifts.join(crc[:-1], rows[1:], crc[1:])
    assert both.tolist() == [zlib.crc32((a + b).encode()) for a, b in zip(words, words[1:], strict=False)]

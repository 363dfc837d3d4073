"""Operators against plain re-statements and worked examples on small inputs."""

import random

import pytest
from pyspark.sql import functions as F

from siftloom.functions import names as N
from siftloom.operators import balance as W
from siftloom.operators import cluster as K
from siftloom.operators import select as S
from siftloom.operators import similar as M
from siftloom.operators.graph import connected_components


def test_components(spark):
    random.seed(3)
    edges = [(random.randrange(60), random.randrange(60)) for _ in range(50)] + [(i, i + 1) for i in range(100, 140)]
    want = {}
    for a, b in edges:
        for x in (a, b):
            want.setdefault(x, x)
    for _ in range(100):
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
    got = connected_components(spark.createDataFrame([e for e in edges if e[0] != e[1]], "src long, dst long"))
    assert {r.id: r.component for r in got.collect()} == {k: v for k, v in want.items() if any(k in e and e[0] != e[1] for e in edges)}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


@pytest.mark.parametrize(
    ("sizes", "n", "want"),
    [([3, 3, 3], 6, [2, 2, 2]), ([2, 4, 1], 5, [2, 2, 1]), ([1, 1], 9, [1, 1]), ([0, 0], 3, [0, 0]), ([], 3, []), ([4], 0, [0]), ([5, 5, 5], 2, [1, 1, 0])],
)
def test_fair_share(sizes, n, want):
    assert list(S.fair_share_quotas(dict(enumerate(sizes)), n).values()) == want


@pytest.mark.parametrize(("rounds", "walked"), [(1, 100), (2, 0), (0, 12), (12, 100)])
def test_keep_first(spark, monkeypatch, rounds, walked):
    """Whatever is open after the rounds is walked in small components, or goes on in rounds in those too large for that."""
    monkeypatch.setattr(M, "WALKED", walked)
    random.seed(5)
    edges = sorted({tuple(sorted(random.sample(range(40), 2))) for _ in range(60)})
    kept = []
    for x in range(40):
        if not any((k, x) in edges for k in kept):
            kept.append(x)
    got = M.keep_first(spark.range(40).withColumnRenamed("id", "item"), spark.createDataFrame(edges, "src long, dst long"), rounds=rounds)
    assert sorted(r.item for r in got.collect()) == kept


def test_quota_is_sequential(spark):
    random.seed(7)
    rows = [(i, [random.choice("abcd") for _ in range(random.randrange(3))]) for i in range(80)]
    count, want = {}, []
    for i, keys in rows:
        if not keys or any(count.get(k, 0) < 5 for k in keys):
            want.append(i)
            for k in keys:
                count[k] = count.get(k, 0) + 1
    got = S.key_quota(spark.createDataFrame(rows, "id long, keys array<string>"), "id", "keys", ["id"], 5)
    assert sorted(r.id for r in got.collect()) == want


def test_balance_example(spark):
    folders = spark.createDataFrame([("1_character/class1", 1), ("1_character/class2", 1), ("others/class1", 1), ("others/class3", 1)], "path string, n long")
    rules = spark.createDataFrame([(0, "1_character", 3.0), (1, "class1", 4.0), (2, "*class2", 6.0)], "ord int, pattern string, weight double")
    got = {r.path: round(r.prob, 6) for r in W.balance(folders, rules).collect()}
    assert got == {"1_character/class1": 0.3, "1_character/class2": 0.45, "others/class1": 0.2, "others/class3": 0.05}


def test_merge_adds_up(spark):
    edges = spark.createDataFrame([(0, 2), (0, 3), (1, 2), (1, 3), (2, 4), (3, 4)], "src long, dst long")
    labels = spark.createDataFrame([(0, 1), (1, 1), (2, 2), (3, 2), (4, 3), (5, 4)], "item long, label long")
    got = {r["item"]: r.label for r in K.merge_clusters(edges, labels, 0.5).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 1, 4: 1, 5: 4}


def test_titles(spark):
    files = ["[Group] Some Title - Another Part - 07 (1080p) [ABCD].mkv", "[Group] Only Title.mkv", "[G] Only Title - No Number.mkv"]
    got = spark.createDataFrame([(f,) for f in files], "f string").select(N.parse_title(F.col("f")).alias("t")).collect()
    assert [(r.t.name, r.t.episode) for r in got] == [("Some Title - Another Part", 7), ("Only Title", None), ("Only Title", None)]


def test_caption_separators(spark):
    from siftloom.functions import captions as C

    rows = [("1person", "a and b", None, "x, y"), (None, "a", "", "x"), ("2people", None, "t", ""), (None, None, None, None)]
    df = spark.createDataFrame(rows, "n string, c string, t string, g string")
    parts = {k: F.col(k) for k in ("n", "c", "t", "g")}
    plain, kept = C.caption(parts, F.lit(1)), C.caption(parts, F.lit(1), keep_before="g", keep_sep=" ||| ")
    got = df.select(plain.alias("p"), kept.alias("k")).collect()
    assert [r.p for r in got] == ["1person, a and b, x, y", "a, x", "2people, t", ""]
    assert [r.k for r in got] == ["1person, a and b ||| x, y", "a ||| x", "2people, t", ""]
    assert df.select(C.caption(parts, F.lit(1), probs={"c": 0.0}).alias("p")).first().p == "1person, x, y"


def test_names_and_tags(spark):
    from siftloom.functions.tags import has_prefix, has_suffix

    got = spark.createDataFrame([("3_cat",), ("-1_noise",), ("12-_x_1",), ("cat",)], "f string").select(N.strip_number(F.col("f")).alias("f")).collect()
    assert [r.f for r in got] == ["cat", "noise", "x_1", "cat"]
    tags = spark.createDataFrame([("long hair ",), ("_long_hair",), ("hairy",)], "t string")
    got = tags.select(has_suffix(F.col("t"), "hair").alias("s"), has_prefix(F.col("t"), "long").alias("p")).collect()
    assert [(r.s, r.p) for r in got] == [(True, True), (True, True), (False, False)]


def test_page_edges(spark):
    from siftloom.operators.tree import page_edges

    html = "<h2>A</h2><ul><li>plain</li></ul><h2>B</h2><ul><li>see <b>the</b> <a href='x'>x</a></li><li><a>y</a><ul><li><a>z</a></li></ul></li></ul><h3>C</h3><li><a>w</a></li><h2>See also</h2><li><a>no</a></li>"
    got = {(r.parent, r.child, r.is_tag) for r in page_edges(spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")).collect()}
    assert got == {("", "A", False), ("", "B", False), ("B", "x", True), ("B", "y", True), ("y", "z", True), ("B", "C", False), ("C", "w", True)}


def test_noise_distances(spark):
    random.seed(9)
    rows = [(i, [random.random() - 0.5 for _ in range(4)]) for i in range(30)] + [(30, None)]
    labels = {i: random.choice([-1, 0, 1]) for i in range(31)}
    v = spark.createDataFrame(rows, "item long, vec array<double>")
    got = {(r.src, r.to): (r.d, r["count"]) for r in M.distances_to_groups(v, spark.createDataFrame(list(labels.items()), "item long, label long"), 0.9).collect()}

    def dist(a, b):
        return 1 - sum(x * y for x, y in zip(a, b, strict=True)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5

    want = {}
    for i, a in rows[:30]:
        for to in (0, 1):
            if labels[i] == -1:
                d = [dist(a, b) for j, b in rows[:30] if labels[j] == to]
                want[i, to] = (pytest.approx(sum(d) / len(d)), sum(x <= 0.9 for x in d))
    assert got == want
    assert M.similar_pairs(v, 2.0).count() == 0


def test_pairs_within_scope(spark, monkeypatch):
    """Large scopes have blocks of their own, small ones and null share blocks; no pair is lost and none crosses scopes."""
    monkeypatch.setattr(M, "BLOCK", 8)
    random.seed(11)
    scopes = ["big"] * 30 + [None] * 12 + ["a"] * 5 + ["b"] * 3 + [f"s{i}" for i in range(10)]
    rows = [(i, [random.random() - 0.5 for _ in range(3)], s) for i, s in enumerate(scopes)] + [(99, None, "big")]
    v = spark.createDataFrame(rows, "item long, vec array<double>, scope string")

    def cos(a, b):
        return sum(x * y for x, y in zip(a, b, strict=True)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5

    pairs = [(a, b) for a in rows[:-1] for b in rows[:-1] if a[0] < b[0] and cos(a[1], b[1]) > 0.5]
    got = sorted((r.src, r.dst) for r in M.similar_pairs(v, 0.5, scope="scope").collect())
    assert got == sorted((a[0], b[0]) for a, b in pairs if a[2] == b[2])
    assert sorted((r.src, r.dst) for r in M.similar_pairs(v, 0.5).collect()) == sorted((a[0], b[0]) for a, b in pairs)
    assert M.similar_pairs(v.where("false"), 0.5, scope="scope").count() == 0

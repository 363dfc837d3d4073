"""Row numbers by range, old captions, votes, places, head crops, vocabularies, names, and quotas on a stream with a restart."""

import random

import pytest
from pyspark.sql import functions as F

from siftloom.functions import boxes as B
from siftloom.functions import captions as C
from siftloom.functions import names as N
from siftloom.functions import tags as G
from siftloom.operators import labels as L
from siftloom.operators import select as Q
from siftloom.operators.ranks import number_rows
from siftloom.streaming import feed


@pytest.mark.parametrize("parts", [None, 1, 9])
def test_row_numbers(spark, parts):
    r = random.Random(3)
    rows = [(i, r.choice(["hot"] * 6 + ["a", None]), r.randrange(30), "x") for i in range(300)]
    df = spark.createDataFrame(rows, "i int, k string, v int, _part string").repartition(5)
    got = number_rows(df, [F.desc("v"), "i"], "row", ["k"], first=0, parts=parts)
    assert got.columns == ["i", "k", "v", "_part", "row"] and {x._part for x in got.collect()} == {"x"}
    want = {}
    for k in ("hot", "a", None):
        want |= {x[0]: n for n, x in enumerate(sorted((x for x in rows if x[1] == k), key=lambda x: (-x[2], x[0])))}
    assert {x.i: x.row for x in got.collect()} == want
    assert sorted((x.row, x.v) for x in number_rows(df, ["v", "i"], parts=parts).collect()) == list(enumerate(sorted(x[2] for x in rows), 1))
    assert number_rows(df.limit(0), ["v"]).count() == 0


def test_old_captions(spark):
    schema = "id string, n_people string, characters array<string>, copyright array<string>, general string, artist array<string>, rating string, tags array<string>, places string"
    rows = [
        ("a", "1", ["ann_x, blue dress", "unknown"], ["c", "unknown"], "a view", ["anonymous"], "explicit", ["solo", "sky"], "at left"),
        ("b", "many", ["ann, stage clothes"], None, None, ["me", "you"], "safe", ["tracen_school_uniform", "x_y"], ""),
        ("c", None, None, None, None, None, None, None, None), ("d", "2", ["ann, tracen swimsuit", "bob"], [], "", [], None, ["tracen_school_uniform"], None),
    ]
    df = spark.createDataFrame(rows, schema)
    fields = {c: F.col(c) for c in ("n_people", "characters", "copyright", "general", "artist", "rating")}

    def said(**more):
        return {r.id: r.c for r in df.select("id", C.v1_caption(F.col("id"), fields, F.col("tags"), F.col("places"), **more).alias("c")).collect()}

    assert said() == {
        "a": "1person, ann x, blue dress, from c, a view, explicit, at left, solo, sky", "b": "manypeople, ann, tracen school uniform, by me you, x y", "c": "",
        "d": "2people, ann, tracen swimsuit, bob, tracen school uniform",
    }
    assert said(sep=";", embeddings=True)["a"].startswith("1person; ann x, ann x-blue-dress; from c") and said(embeddings=True)["d"].startswith("2people, ann, tracen swimsuit, bob")
    assert said(probs={"characters": 0.0})["b"] == "manypeople, by me you, tracen school uniform, x y"
    drawn = [said(probs={"general": 0.5}, seed=s)["a"] for s in range(12)]
    assert {("a view" in x) for x in drawn} == {True, False} and said(probs={"general": 0.5}, seed=4) == said(probs={"general": 0.5}, seed=4)
    assert df.where("id = 'a'").select(C.v1_embeddings(F.col("characters"))).first()[0] == ["ann_x-blue-dress"]


def test_votes(spark):
    one = spark.createDataFrame([("i", "a", 0.6), ("i", "b", 0.6), ("j", "ood", 0.9), ("k", "a", 0.1), ("l", "a,hat", 0.8)], "item string, class string, p double")
    two = spark.createDataFrame([("i", "c", 0.6), ("j", "a", 0.2), ("k", "b", 0.2), ("l", "z", 0.1)], "item string, class string, p double")
    worn = spark.createDataFrame([("i", "cap", 0.7), ("l", "cap", 0.7), ("j", "cap", 0.7), ("k", "others", 0.9)], "item string, class string, p double")
    got = lambda *x: {r["item"]: r.character for r in L.model_vote(*x).collect()}
    assert got(one, 0.5) == {"i": "a", "j": "unknown", "k": "unknown", "l": "a,hat"}
    assert got(one, 0.5, two) == {"i": "c", "j": "unknown", "k": "unknown", "l": "a,hat"}
    assert got(one, 0.5, two, worn) == {"i": "c, cap", "j": "unknown", "k": "unknown", "l": "a,hat"}


def test_places_and_head_crops(spark):
    df = spark.createDataFrame([(["v 10 20 h 30 40", "v 0 0 h 90 100"], 0)], "old array<string>, x int")
    faces = B.legacy_places(F.col("old"))
    got = df.select(faces.alias("f"), B.face_places(faces).alias("three"), B.face_places(faces, codes=True).alias("codes")).first()
    assert got.f == [[0.3, 0.1, 0.4, 0.2], [0.9, 0.0, 1.0, 0.0]] and got.three == "at left at right" and got.codes == "fhml fvtp fhri fvtp"
    boxes = spark.createDataFrame([(10, 10, 30, 40, 200, 100), (190, 90, 200, 100, 200, 100), (0, 0, 150, 10, 200, 100), (0, 0, 60, 250, 100, 301)], "l int, t int, r int, b int, w int, h int")
    got = [tuple(r.c) for r in boxes.select(B.head_crop(F.struct("l", "t", "r", "b"), F.col("w"), F.col("h")).alias("c")).collect()]
    assert got == [(0, 0, 45, 45), (185, 85, 200, 100), (0, -50, 200, 150), (-100, 0, 201, 301)]


def test_tokens_there_and_back(spark):
    tokens = spark.createDataFrame([("b", 0), ("a", 1), ("b", 2), ("c", 3)], "token string, ord long")
    words = L.vocabulary(tokens, 1)
    assert {r.token: r.id for r in words.collect()} == {"b": 5, "a": 6, "c": 7}
    rows = spark.createDataFrame([(1, [2, 5, 7, 99, None, 3, 0]), (2, []), (3, None)], "k int, ids array<long>")
    got = {r.k: r.words for r in L.decode_tokens(rows, "ids", words, "k").collect()}
    assert got == {1: ["[CLS]", "b", "c", "[UNK]", "[UNK]", "[SEP]", "[PAD]"], 2: [], 3: []}


def test_names(spark):
    c = spark.createDataFrame([("a:b|x?y|_hat+c<d|none|_o",), ("a|_e f|none",), ("a",), ("",), (None,)], "t string").select("t", N.parse_character(F.col("t")).alias("c"))
    got = [(r.c.name, r.c.appearance, r.c.outfit, r.e, r.s) for r in c.select("c", N.extra_embeddings(F.col("c")).alias("e"), N.caption_character(F.col("c")).alias("s")).collect()]
    assert got[:3] == [("a_b", "x_y", ["_hat", "c_d"], ["_hat", "_o"], "a_b x_y, _hat c_d, _o"), ("a", "_e f", [], [], "a_e_f"), ("a", None, [], [], "a")] and len(got) == 5
    paths = ["a10", "a9", "a09", "a" + "9" * 30, "a1" + "0" * 30, "b", "a", "a2b10", "a2b9"]
    order = [r.p for r in spark.createDataFrame([(p,) for p in paths], "p string").orderBy(N.natural_key(F.col("p")), "p").collect()]
    assert order == ["a", "a2b9", "a2b10", "a09", "a9", "a10", "a" + "9" * 30, "a1" + "0" * 30, "b"]


def test_samples_and_shuffles(spark):
    rows = spark.createDataFrame([(f"i{k}",) for k in range(50)], "item_id string")
    draw = lambda seed: {r.item_id for r in Q.sample_rows(rows, "item_id", 10, seed).collect()}
    assert len(draw(1)) == 10 and draw(1) == draw(1) != draw(2) and Q.sample_rows(rows, "item_id", 99).count() == 50
    tags = rows.limit(3).withColumn("tags", F.transform(F.array(*(F.lit(f"t{k}") for k in range(8)), F.lit("solo"), F.lit("2girls")), lambda t: F.struct(t.alias("tag"), F.lit(0.5).alias("score"))))
    shuffled = lambda seed: [[t.tag for t in r.s] for r in tags.select(G.sort_tags(F.col("tags"), "shuffle", F.col("item_id"), seed).alias("s")).collect()]
    assert shuffled(1) == shuffled(1) != shuffled(2) and all(x[:2] == ["solo", "2girls"] and sorted(x[2:]) == [f"t{k}" for k in range(8)] for x in shuffled(1))


def test_quota_on_a_stream_with_a_restart(spark, tmp_path):
    schema, passed = "id long, keys array<string>", []

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        marks = feed.quota_marks(stream, "id", "keys", "id", 2)
        query = feed.quota_sink(marks, lambda rows, n: passed.extend(r.row for r in rows.collect()), f"{tmp_path}/check")
        query.processAllAvailable()
        query.stop()

    def put(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        put([(1, ["a"]), (2, ["a", "b"]), (3, ["a"]), (4, []), (5, None)])
        run()
        assert sorted(passed) == [1, 2, 4, 5]
        # counts go on after a restart: a is full, b has one left
        put([(6, ["a"]), (7, ["a", "b"]), (8, ["b"]), (9, ["c"]), (10, None)])
        run()
        assert sorted(passed) == [1, 2, 4, 5, 7, 9, 10]
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_globs(spark):
    import fnmatch

    from siftloom.operators.balance import folder_weights, glob_to_regex

    r = random.Random(6)
    globs = ["*", "?a", "[ab]*", "[!ab]?", "[]x]", "[a-c]/*", "a.b", "x+(y)", "[", "a[", "[^a]", "[a^]", "[&&a]", "a\\\\b", "*.[jp]*", "{a}", "^a$"]
    names = ["".join(r.choice("abcx]^&[/.+(){}$j\\\\") for _ in range(r.randrange(1, 5))) for _ in range(150)] + ["a.b", "x+(y)", "[", "a[", "{a}", "^a$", "ab"]
    df = spark.createDataFrame([(g, n) for g in globs for n in names], "g string, n string")
    for x in df.withColumn("r", glob_to_regex(F.col("g"))).select("g", "n", F.expr("n rlike r").alias("hit")).collect():
        assert x.hit == fnmatch.fnmatchcase(x.n, x.g), (x.g, x.n)
    nodes = spark.createDataFrame([("p/a",), ("p/b",), ("q",)], "path string")
    rules = spark.createDataFrame([(0, "p/*", 2.0), (1, "a", 3.0), (2, "q", 4.0)], "ord int, pattern string, weight double")
    assert {x.path: x.weight for x in folder_weights(nodes, rules).collect()} == {"p/a": 3.0, "p/b": 2.0, "q": 4.0}
    assert {x.weight for x in folder_weights(nodes, rules.limit(0)).collect()} == {1.0}


def test_faces_and_output(spark):
    from siftloom.operators import filters as R
    from siftloom.sources.posts import output_metadata

    d = spark.createDataFrame([(1, 0, 10, 20, 30, 40, 0.9), (1, 1, 0, 0, 10, 90, 0.9), (2, 0, 0, 0, 5, 5, 0.1)], "item int, det int, l int, t int, r int, b int, score double")
    items = spark.createDataFrame([(1,), (2,), (3,)], "item int")
    got = {r["item"]: (r.n_faces, r.facepos) for r in R.face_summary(d, items, 0.5, 2.0, F.lit(100), F.lit(200)).collect()}
    assert got == {1: (1, [[0.05, 0.2, 0.15, 0.4]]), 2: (0, []), 3: (0, [])}
    assert {r["item"]: r.det for r in R.first_face(d, 0.5, 2.0, items).collect()} == {1: 0, 2: None, 3: None} and R.first_face(d, 0.5, 2.0).count() == 1
    rows = spark.createDataFrame([("/src/a.jpg", "a.jpg")], "path string, filename string")
    out = output_metadata(rows, "t", "webp", F.lit("/dst"), F.struct(F.lit(1).alias("w"), F.lit(2).alias("h"))).first()
    assert (out.path, out.filename, out.current_path, out.type, out.image_size.h) == ("/src/a.jpg", "a.webp", "/dst/a.webp", "t", 2)

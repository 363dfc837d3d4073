"""Scans, rule files and the feed."""

from pyspark.sql import functions as F

from siftloom.sources import scan
from siftloom.streaming import feed


def test_manifest(spark, tmp_path):
    folder = tmp_path / "a - b"
    folder.mkdir()
    for name in ("x.PNG", "y.jpg", "z.txt"):
        (folder / name).write_bytes(b"1")
    got = {r.filename: (r.group_id, r["rank"]) for r in scan.manifest(spark, f"file://{tmp_path}").collect()}
    assert got == {"x.PNG": ("a_b", 1), "y.jpg": ("a_b", 2)}


def test_comma_sidecars(spark, tmp_path):
    (tmp_path / "x.tags").write_text("one, two,, three ")
    got = scan.comma_sidecars(spark, f"file://{tmp_path}", "tags").collect()
    assert [r["values"] for r in got] == [["one", "two", "three"]] and got[0].base.endswith("/x")


def test_key_value_lines(spark):
    lines = [("p", 0, "character: a b, unknown, "), ("p", 1, "general: x"), ("p", 2, "general: y, z z"), ("p", 3, "score: 12"), ("p", 4, "other: q")]
    got = {r.field: r["values"] for r in scan.key_value_lines(spark.createDataFrame(lines, "path string, line_no int, line string")).collect()}
    assert got == {"characters": ["a_b"], "tags": ["y", "z_z"], "score": ["12"]}


def test_class_map(spark):
    rows = spark.createDataFrame([(0, "a", "b"), (1, "a", "c"), (2, "d", None)], "ord int, old string, new string")
    assert {r.old: r.new for r in scan.class_map(rows).collect()} == {"a": "c", "d": "d"}


def test_wildcard_lines(spark):
    core = spark.createDataFrame([("n", ["k"], ["e"], ["d"]), ("m", [], [], [])], "character string, kept array<string>, emb_init array<string>, dropped array<string>")
    got = sorted((r.character, r.line) for r in scan.wildcard_lines(core).collect())
    assert got == [("m", "m"), ("n", "n"), ("n", "n, k"), ("n", "n, k, e, d")]


def test_ingest(spark, tmp_path):
    spark.range(20).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id long").parquet(f"{tmp_path}/in")
    query = feed.ingest(stream, [lambda d: d.where("id % 2 = 0"), lambda d: d.withColumn("twice", F.col("id") * 2)], f"{tmp_path}/out", f"{tmp_path}/check")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 10

"""Metadata, rule files, catalogues, feature tables and sinks."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from siftloom.operators import fields
from siftloom.sources import files, scan


def test_item_metadata(spark, tmp_path):
    for name in ("x.png", "y.png"):
        (tmp_path / name).write_bytes(b"1")
    (tmp_path / "x_meta.json").write_text(json.dumps({"path": "/old/x.png", "filename": "first.png", "type": "a"}))
    images = scan.manifest(spark, f"file://{tmp_path}").select("path", "filename", "group_id")
    stored = files.read_metadata(spark, f"file://{tmp_path}", "path string, current_path string, filename string, type string")
    # Spark names files by URI in both scans, with one slash or three
    same = lambda c: F.regexp_replace(c, "^file:/+", "/")
    images, stored = images.withColumn("path", same("path")), stored.withColumn("base", same("base"))
    got = {r.current_path.split("/")[-1]: r for r in files.item_metadata(images, stored).collect()}
    assert (got["x.png"].path, got["x.png"].filename, got["x.png"].type) == ("/old/x.png", "first.png", "a")
    assert got["y.png"].path.endswith("/y.png") and got["y.png"].filename == "y.png" and got["y.png"].type is None
    again = {r.path.split("/")[-1] for r in files.item_metadata(images, stored, overwrite_path=True).collect()}
    assert again == {"x.png", "y.png"} and not any(r.path.startswith("/old") for r in files.item_metadata(images, stored, True).collect())


def test_v1_tag_lines(spark):
    lines = [("p", 0, "character: a, unknown, ood"), ("p", 1, "general: x, y: z"), ("p", 2, "score: 5"), ("q", 0, "one, two,, three"), ("q", 1, "artist: me"), ("r", 0, None)]
    df = spark.createDataFrame(lines, "path string, line_no int, line string")
    got = {r.path: r for r in files.v1_tag_lines(df).collect()}
    assert got["p"].character == ["a"] and got["p"].tags == ["x", "y: z"] and got["p"].score == "5" and got["p"].artist is None
    assert got["q"].tags == ["one", "two", "three"] and got["q"].artist == ["me"] and got["r"].tags is None
    assert all(r.character is None for r in files.v1_tag_lines(df, keep_character=True).collect())


def test_rule_files(spark, tmp_path):
    (tmp_path / "w.csv").write_text("a*,2\nb,0.5\n\nbad\n")
    assert [(r.pattern, r.weight) for r in files.weight_rules(spark, f"file://{tmp_path}/w.csv").orderBy("ord").collect()] == [("a*", 2.0), ("b", 0.5)]
    (tmp_path / "b.txt").write_text("one\n two \n\n")
    assert {r.tag for r in files.blacklist(spark, f"file://{tmp_path}/b.txt").collect()} == {"one", "two"}
    (tmp_path / "o.json").write_text(json.dumps([{"query": "a", "has_overlap": ["b"]}, {"query": "c", "has_overlap": []}, {"query": "d"}]))
    assert [(r["query"], r.has_overlap) for r in files.overlap_rules(spark, f"file://{tmp_path}/o.json").collect()] == [("a", ["b"])]
    (tmp_path / "c.json").write_text(json.dumps({"whitelist": ["w"], "prefixes": [["p0"], ["p1"], ["p2"]], "suffixes": [["s0"]]}))
    rules = files.character_rules(spark, f"file://{tmp_path}/c.json", 0, 2)
    assert {(r.kind, r.word) for r in rules.collect()} == {("whitelist", "w"), ("prefix", "p0"), ("prefix", "p1"), ("suffix", "s0")}


def test_features(spark):
    images = spark.createDataFrame([("a",), ("b",)], "path string")
    cached = spark.createDataFrame([("a", 1.0), ("z", 9.0)], "path string, v double")

    def make():
        return lambda batch: pd.DataFrame({"path": batch["path"], "v": [2.0] * len(batch)})

    whole, new = files.with_features(images, cached, lambda d: files.score_batches(d, make, "path string, v double"))
    assert sorted(map(tuple, whole.collect())) == [("a", 1.0), ("b", 2.0)] and list(map(tuple, new.collect())) == [("b", 2.0)]


def test_sinks(spark, tmp_path):
    items = spark.createDataFrame([("f", "x.png", "/f/x.png", ["a", "b"], "c"), ("f", None, "/f/y.png", [], None)], "folder string, filename string, path string, tags array<string>, text string")
    files.metadata_sink(items, f"{tmp_path}/meta")
    names = {r.filename for r in spark.read.json(f"{tmp_path}/meta").collect()}
    assert "x.png" in names and len(names) == 2 and all(names)
    files.attribute_sink(items, "tags", f"{tmp_path}/tags")
    assert [(r.path, r.body) for r in spark.read.json(f"{tmp_path}/tags").collect()] == [("/f/x.tags", "a, b")]
    assert [r.body for r in files.attribute_lines(items, "text").collect()] == ["c"]
    with pytest.raises(ValueError):
        files.attribute_lines(items.withColumn("n", F.lit(1)), "n")
    files.repeat_sink(spark.createDataFrame([("a", 1), ("b", 3)], "path string, multiply int"), f"{tmp_path}/repeat")
    assert spark.read.option("header", True).csv(f"{tmp_path}/repeat").count() == 2


def test_class_dataset(spark):
    images = spark.createDataFrame([("/d/b/1.png", "RGB"), ("/d/a/2.png", "RGB"), ("/d/b/3.png", "L")], "path string, mode string")
    tags = spark.createDataFrame([("/d/b/1", ["t"])], "base string, values array<string>")
    rows, classes = files.class_dataset(images, tags, F.col("mode"))
    assert sorted((r.class_id, r.file, r.tags) for r in rows.collect()) == [(0, "a/2.png", []), (1, "b/1.png", ["t"])]
    assert sorted(map(tuple, classes.collect())) == [(0, "a"), (1, "b")]


def test_reference_labels(spark):
    paths = [("/r/ann/red/1.png",), ("/r/bob_2.png",), ("/r/cy.png",), ("/r/ann/red/3.png",)]
    got = {r.path: (r.name, r.label) for r in files.reference_labels(spark.createDataFrame(paths, "path string"), "/r/").collect()}
    assert got == {"/r/ann/red/1.png": ("ann|red", 0), "/r/ann/red/3.png": ("ann|red", 0), "/r/bob_2.png": ("bob", 1), "/r/cy.png": ("cy", 2)}


def test_merge_references(spark):
    known = spark.createDataFrame([(0, "ann"), (1, "bob"), (4, "ann|blue")], "label int, character string")
    refs = spark.createDataFrame([(7, "bob"), (8, "ann|red"), (9, "cy")], "label int, character string")
    merged = fields.merge_references(known, refs)
    assert {(r.label, r.character, r.ref_label) for r in merged.collect()} == {(0, "ann", None), (1, "bob", 7), (4, "ann|blue", None), (5, "ann|red", 8), (6, "cy", 9)}
    present = spark.createDataFrame([("i", 0), ("j", 4), ("k", 1)], "item string, label long")
    got = {(r.item, r.label) for r in fields.inherit_presence(present, known, merged).collect()}
    assert got == {("i", 0), ("i", 5), ("j", 4), ("j", 5), ("k", 1)}
    empty = fields.merge_references(known.limit(0), refs).collect()
    assert {(r.label, r.character) for r in empty} == {(0, "bob"), (1, "ann|red"), (2, "cy")}


def test_refine_and_prune(spark):
    row = spark.createDataFrame([(["a", "b,x", "c"], ["a,1", "a,2", "b,9"], None)], "old array<string>, new array<string>, none array<string>")
    got = row.select(fields.refine_characters(F.col("old"), F.col("new")).alias("x"), fields.refine_characters(F.col("none"), F.col("new")).alias("y")).first()
    assert got.x == ["a,2", "b,x", "c"] and got.y == ["a,1", "a,2", "b,9"]
    tags = spark.createDataFrame([(1, ["n"], ["red hair", "sky", "bad"]), (2, [], ["red hair", "sky"])], "id int, who array<string>, names array<string>")
    tags = tags.withColumn("tags", F.transform("names", lambda t: F.struct(t.alias("tag"), F.lit(0.5).alias("score"))))
    listed, partners = F.array(F.lit("bad")), F.create_map(F.lit("q"), F.array(F.lit("r")))

    def pruned(mode):
        p = fields.prune_tags(F.col("tags"), F.col("who"), mode, listed, partners, lambda t: t.endswith("hair"))
        rows = tags.select("id", p.alias("p")).collect()
        return {r.id: ([t.tag for t in r.p.kept], None if r.p.dropped is None else [t.tag for t in r.p.dropped]) for r in rows}

    assert pruned("none")[1] == (["red hair", "sky", "bad"], None)
    assert pruned("minimal")[1] == (["red hair", "sky"], None)
    assert pruned("character") == {1: (["sky"], ["red hair"]), 2: (["red hair", "sky"], None)}
    with pytest.raises(ValueError):
        pruned("other")

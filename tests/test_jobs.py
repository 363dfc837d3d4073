"""Jobs, folder formats, renames, tag files, face crops, trees and merging against plain Python and awkward inputs."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftloom.functions import tags as G
from siftloom.functions.boxes import face_crops
from siftloom.operators import cluster as K
from siftloom.operators import fields as O
from siftloom.operators import jobs as J
from siftloom.operators import similar as S
from siftloom.operators import tree as T
from siftloom.operators.coretags import merge_emb_init
from siftloom.sources import files, scan

TAG = "array<struct<tag:string,score:double>>"


def test_proper_parts(spark):
    r = random.Random(2)
    rows = [["".join(r.choice("ab_é") for _ in range(r.choice([0, 1, 2, 3, 5, 9, 70]))) for _ in range(r.randrange(25))] for _ in range(60)] + [[], ["a", "a"], ["x" * 60, "x" * 59, "x"]]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x array<string>").select("i", G.proper_parts(F.col("x")).alias("p")).collect()
    for g in got:
        # an empty name is no part of a name here
        assert sorted(g.p) == sorted({t for t in set(rows[g.i]) if any(t in u and t != u for u in rows[g.i]) and (t or any(len(u) > G.LISTED for u in rows[g.i]))})


def test_caption_job_on_odd_items(spark):
    tag = lambda *names: [(n, 0.5) for n in names]
    items = [
        ("a", ["ann"], tag("red_hair", "sky", "bad"), None, "t", "e"), ("b", ["ann"], tag("red_hair", "hat"), None, "t", "s"), ("c", ["ann", "bob"], tag("red_hair", "sky"), tag("sky"), "t", "s"),
        ("d", None, tag("red_hair", "sea", "sea_side"), None, None, None), ("e", [], None, None, "t", None), ("f", ["unknown"], tag("x"), tag(), "t", None),
    ]
    df = spark.createDataFrame(items, f"item_id string, characters array<string>, tags {TAG}, processed_tags {TAG}, type string, rating string")
    rules = J.TagRules(blacklist=("bad",), suffixes=("hair",), init_suffixes=("hair",))

    def run(mode, **more):
        out, core = J.tag_and_caption(df, rules, mode, frequency=0.6, **more)
        return {r.item_id: r for r in out.collect()}, core

    clash = df.select("*", *(F.lit(c).alias(c) for c in ("_pruned", "_shown", "_drop", "_core", "_of", "_new")))
    out = J.tag_and_caption(clash, rules, "character_core", predicted=df.select("item_id", "tags"))[0].collect()
    assert len(out) == len(items) and all(r[c] == c for r in out for c in ("_pruned", "_shown", "_drop", "_core", "_of", "_new"))
    got, core = run("character")
    assert core is None and {k: r.caption for k, r in got.items()} == {
        "a": "ann, t, explicit, sky", "b": "ann, t, hat", "c": "ann and bob, t, sky", "d": "red hair, sea side", "e": "t", "f": "t",
    }
    assert [t.tag for t in got["a"].dropped_character_tags] == ["red hair"] and got["d"].dropped_character_tags is None and got["e"].processed_tags is None
    got, core = run("character_core")
    assert {(r.character, r.tag, r.kept, r.dropped, r.emb_init) for r in core.collect()} == {("ann", "red hair", False, True, True)}
    # bob and unknown have no core tags, so captions don't name them
    assert got["c"].caption == "ann, t, sky" and got["f"].caption == "t" and got["b"].caption == "ann, t, hat" and got["d"].caption == "red hair, sea side"
    got, _ = run("minimal", append_dropped=True, most=1)
    assert got["b"].caption == "ann, t, red hair" and run("none")[0]["a"].caption == "ann, t, explicit, red hair, sky, bad"
    predicted = spark.createDataFrame([("a", tag("new")), ("e", tag("new")), ("z", tag("new"))], f"item_id string, tags {TAG}")
    assert run("none", predicted=predicted)[0]["e"].caption == "t, new" and run("none", predicted=predicted, overwrite=True)[0]["a"].caption == "ann, t, explicit, new"
    assert J.tag_and_caption(df.limit(0), rules, "character_core")[0].count() == 0
    with pytest.raises(ValueError):
        run("other")


def test_selection_job(spark):
    crops = [
        ("p/a_1.png", "p/a.png", 1, "1_ann", 90, 90), ("p/a_2.png", "p/a.png", 2, "2_bob", 20, 20), ("p/b_1.png", "p/b.png", 1, "0_noise", 50, 50), ("p/b_2.png", "p/b.png", 2, "3_ann", 30, 30),
        ("p/x_1.png", "p/gone.png", 1, "1_ann", 30, 30),
    ]
    originals = [("p/a.png", ["old"], 100, 120), ("p/b.png", ["ann", "old"], 300, 200), ("p/c.png", None, 10, 10), ("p/d.png", ["cy"], 10, 10)]
    c = spark.createDataFrame(crops, "item_id string, parent_id string, ord int, class string, w int, h int")
    o = spark.createDataFrame(originals, "item_id string, characters array<string>, w int, h int")

    def run(**more):
        return {r.item_id: (r.folder, r.characters) for r in J.select_images(c, o, "set", **more).collect()}

    base = {"p/a.png": ("classified", ["ann", "bob"]), "p/a_2.png": ("classified", ["bob"]), "p/b_2.png": ("classified", ["ann"]), "p/x_1.png": ("classified", ["ann"]), "p/b.png": ("raw", ["ann"])}
    assert run() == base
    assert run(plain=10) == base | {"p/b_1.png": ("no_characters", []), "p/c.png": ("no_characters", []), "p/d.png": ("no_characters", [])}
    assert run(plain=1) == run(plain=1) and len(run(plain=1)) == 6
    assert run(overwrite=False)["p/d.png"] == ("raw", ["cy"]) and run(overwrite=False)["p/b.png"] == ("raw", ["ann", "old"])
    assert run(overwrite=False, known_only=True)["p/b.png"] == ("raw", ["ann"]) and "p/d.png" not in run(overwrite=False, known_only=True)
    assert set(run(with_crops=False)) == {"p/a.png", "p/b.png"} and "p/b.png" not in run(with_originals=False)
    # a_2 and b_2 look alike, and so does b, which is in another folder
    v = spark.createDataFrame([("p/a_2.png", [1.0, 0.0]), ("p/b_2.png", [1.0, 0.01]), ("p/b.png", [1.0, 0.0]), ("p/x_1.png", [0.0, 1.0])], "item string, vec array<double>")
    assert set(run(vectors=v)) == set(base) - {"p/b_2.png"}
    sized = {r.item_id: (r.w, r.h, r.filename, r.type) for r in J.select_images(c, o, "set", largest=100, ending="webp").collect()}
    assert sized["p/b.png"] == (150, 100, "b.webp", "set") and sized["p/a.png"] == (100, 120, "a.webp", "set")
    assert J.select_images(c.limit(0), o.limit(0), "set", plain=3).count() == 0


def test_import_job(spark, tmp_path):
    d = tmp_path / "im g+%"
    d.mkdir()
    for n in ("a b.png", "c.png", "e.jpg"):
        (d / n).write_bytes(b"1")
    (d / ".a b_meta.json").write_text(json.dumps({"path": "/old", "characters": ["ann", "bob"], "rating": "s"}))
    (d / "a b_meta.json").write_text(json.dumps({"characters": ["second"]}))
    (d / "c.json").write_text("{broken")
    (d / "a b.artist").write_text("me, , you")
    (d / "c.grab").write_text("character: cy dee, unknown\nscore: 7\ngeneral: x, y\ngeneral: z")
    images = scan.manifest(spark, str(d)).select("path", "filename", "group_id").withColumn("_base", F.lit("own"))
    stored = files.read_metadata(spark, f"file://{d}", "path string, characters array<string>, rating string, n int", broken="broken")
    assert {r.base.split("/")[-1]: r.broken for r in stored.collect()} == {"a b": False, "c": True}
    lines = spark.createDataFrame([(str(i), i, x) for i, x in enumerate((d / "c.grab").read_text().split("\n"))], "path string, line_no int, line string").withColumn("path", F.lit("p"))
    base = f"file:{d}/c"
    grabbed = scan.key_value_lines(lines).select(F.lit(base).alias("base"), "field", "values")
    mapping = spark.createDataFrame([("bob", "bobby"), ("ann", ""), ("zed", "z")], "old string, new string")
    rows = J.import_metadata(images.drop("_base"), stored, {"artist": scan.comma_sidecars(spark, f"file://{d}", "artist")}, grabbed, mapping).collect()
    got = {r.filename: r for r in rows}
    assert len(rows) == 3 and got["a b.png"].characters == ["ann", "bobby"] and got["a b.png"].path == "/old" and got["a b.png"].artist == ["me", "you"] and got["a b.png"].rating == "s"
    assert got["c.png"].characters == ["cy_dee"] and got["c.png"].score == "7" and [t.tag for t in got["c.png"].tags] == ["z"] and got["c.png"].broken
    assert got["e.jpg"].characters is None and got["e.jpg"].broken is None and got["e.jpg"].path.endswith("/e.jpg")
    assert J.import_metadata(images, stored.limit(0)).where("_base = 'own'").count() == 3


def test_sidecars_without_files(spark, tmp_path):
    assert files.read_metadata(spark, str(tmp_path), "type string").count() == 0
    deep = tmp_path / "1" / "2" / "3" / "4"
    deep.mkdir(parents=True)
    for n in (".x_meta.json", "_meta.json", ".json", ".y.json", "z_META.json", "k.JSON", "n.txt"):
        (deep / n).write_text('{"type": "t"}')
    got = {r.base.split("/")[-1] for r in files.read_metadata(spark, str(tmp_path), "type string").collect()}
    assert got == {"x", "_meta", "z_META", "k"}


def test_folder_fields(spark):
    paths = ["/d/b+a+unknown/3people/x/1.png", "/d/others/1person/x/1.png", "/d/ood/manypeople/x/1.png", "/d/a+zz/02people/x/1.png", "1.png", None]
    df = spark.createDataFrame([(p, s, t) for p, s, t in zip(paths, [["a", "b", "ood"], ["k"], ["k"], None, None, None], [None, None, None, " q ; r ", None, None], strict=True)], "path string, stored array<string>, subjects string")
    told = O.folder_fields(F.col("path"), "character/n_people/*", F.col("stored"), F.array(F.lit("a"), F.lit("b")), F.col("subjects"))
    got = [tuple(r) for r in df.select(told["characters"], told["n_people"], told["invalid"]).collect()]
    assert got[:4] == [(["a", "b", "ood"], "3", None), (["k"], "1", None), ([], "many", None), (["q", "r"], "2", ["zz"])]
    assert got[4] == ([""], "", [""]) and len(got) == 6
    assert O.folder_fields(F.col("path"), "n_faces")["n_faces"] is not None
    with pytest.raises(ValueError):
        O.folder_fields(F.col("path"), "other")


def test_renames(spark):
    rules = spark.createDataFrame([(0, "ab", "x"), (1, "x", "yy"), (2, "b", "Q"), (3, "ab", "x2"), (4, None, "n"), (5, "", "e")], "ord int, old string, new string")
    rows = spark.createDataFrame([("d/ab+k", "character: ab, k", "ab b x", 1), ("ab+yy", "general: ab", "", 2), (None, None, None, 3)], "f string, line string, text string, rules int")
    out = O.apply_renames(rows, O.rename_rules(rules), f="folder", line="tag_line", text="caption").orderBy("rules").collect()
    # the caption goes through ab -> x2, x -> yy, b -> Q one after the other
    assert [tuple(r) for r in out] == [("d/x2+k", "character: x2, k", "yy2 Q yy", 1), ("x2+yy", "general: ab", "", 2), (None, None, None, 3)]
    known = O.apply_renames(rows, O.rename_rules(rules), f="known_folder").orderBy("rules").collect()
    assert [r.f for r in known] == [None, "x2+yy", None]
    assert O.apply_renames(rows, O.rename_rules(rules.limit(0)), f="folder").orderBy("rules").first().f == "d/ab+k"


def test_tag_toml(spark):
    good = 'character = "ann, unknown,  bob "\ntags = "a,,b"\nrating = "s"\nscore = 5\n[more]\nx = 1'
    rows = [("g", good), ("bad", "= ="), ("list", 'tags = ["a"]'), ("none", None), ("empty", "")]
    got = {r.path: r for r in files.tag_toml(spark.createDataFrame(rows, "path string, body string")).collect()}
    assert got["g"].character == ["ann", "bob"] and got["g"].tags == ["a", "", "b"] and got["g"].artist is None and got["g"].more == {"rating": "s", "score": "5", "more": '{"x": 1}'} and got["g"].error is None
    assert got["bad"].error.startswith("no TOML") and got["bad"].tags is None and got["list"].error == "not a text: tags" and got["none"].error is None and got["empty"].more == {}
    assert all(r.character is None for r in files.tag_toml(spark.createDataFrame(rows, "path string, body string"), keep_character=True).collect())


def plain_crops(w, h, faces, scale):
    out, boxes = [], [[f[0] * w, f[1] * h, f[2] * w, f[3] * h] for f in faces]
    for i, b in enumerate(boxes):
        if max(b[2] - b[0], b[3] - b[1]) >= min(w, h):
            continue
        left, top, right, bottom = map(int, b)
        edge = min(h, w) if scale is None else min(h, w, int(max(bottom - top, right - left) * scale))
        x = min(max(int((left + right) / 2) - edge // 2, 0), w - edge)
        y = min(max(top - (bottom - top) // 2, 0), h - edge)
        held, ratio = [], 0
        for o in boxes:
            le, to, ri, bo = map(int, o)
            cx, cy, rw, rh = (le + ri) / 2, (to + bo) / 2, (ri - le) * 0.1, (bo - to) * 0.1
            if cx - rw >= x and cx + rw <= x + edge and cy - rh >= y and cy + rh <= y + edge:
                held.append([(le - x) / edge, (to - y) / edge, (ri - x) / edge, (bo - y) / edge])
                if (bo - to) / edge > ratio:
                    ratio = (bo - to) / h
        out.append((i + 1, (x, y, x + edge, y + edge), len(held), held, ratio))
    return out


@pytest.mark.parametrize("scale", [None, 2.5])
def test_face_crops(spark, scale):
    r = random.Random(4)
    rows = []
    for i in range(40):
        boxes = []
        for _ in range(r.randrange(5)):
            x, y = r.random() * 0.8, r.random() * 0.8
            boxes.append([x, y, min(1.0, x + 0.02 + r.random() * 0.5), min(1.0, y + 0.02 + r.random() * 0.5)])
        rows.append((i, r.choice([300, 500]), r.choice([200, 640]), boxes))
    df = spark.createDataFrame([*rows, (99, 10, 10, None)], "i int, w int, h int, faces array<array<double>>")
    got = {x.i: x.c for x in df.select("i", face_crops(F.col("w"), F.col("h"), F.col("faces"), scale).alias("c")).collect()}
    assert got.pop(99) is None
    for i, w, h, faces in rows:
        want = plain_crops(w, h, faces, scale)
        assert [(c.face, tuple(c.box), c.n_faces) for c in got[i]] == [x[:3] for x in want]
        assert all(np.allclose(c.facepos, x[3]) if x[3] else c.facepos == [] for c, x in zip(got[i], want, strict=True)) and np.allclose([c.fh_ratio for c in got[i]], [x[4] for x in want])


def test_nested_lists(spark):
    pages = [
        "<h3>A</h3><ul><ul><li><a>lost</a></li></ul><li><a>x</a></li><ul><li><a>y</a></li><li>no</li><ul><li><a>z</a></li></ul></ul><li><a>w</a></li></ul><ul><ul><li><a>v</a></li></ul></ul>",
        "<ul><li><a>m</a><ul><li><a>n</a></li></ul></li></ul></ul><h4>B</h4><h3>C</h3><h5>D</h5><ul><li><a>d</a></li></ul><h4> </h4><h3>See <b>also</b></h3><ul><li><a>gone</a></li></ul>", None, "",
    ]
    got = {(r.page, r.parent, r.child, r.is_tag) for r in T.page_edges(spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")).collect()}
    assert got == {
        (0, "", "A", False), (0, "A", "lost", True), (0, "A", "x", True), (0, "x", "y", True), (0, "y", "z", True), (0, "A", "w", True), (0, "A", "v", True),
        (1, "", "m", True), (1, "m", "n", True), (1, "", "B", False), (1, "", "C", False), (1, "C", "D", False), (1, "D", "d", True),
    }


def test_tree_lookup(spark):
    edges = [("top", "a", False), ("top", "b", True), ("a", "t", True), ("b", "t", True), ("t", "u", False), ("u", "a", False), (None, "top", True), (None, "lone", True), ("c1", "c2", True), ("c2", "c1", True), (None, None, True)]
    places = T.tree_paths(spark.createDataFrame(edges, "parent string, child string, is_tag boolean"))
    assert {(".".join(r.path), r.is_tag) for r in places.collect()} == {
        ("top", True), ("lone", True), ("top.a", False), ("top.b", True), ("top.a.t", True), ("top.b.t", True), ("top.a.t.u", False), ("top.b.t.u", False), ("top.b.t.u.a", False),
    }
    queries = spark.createDataFrame([(["top"],), (["t"],), (["b", "t"],), (["b", "u"],), (["a"],), (["q"],), ([],), (None,), (["lone"],), (["lone"],)], "query array<string>")
    found = T.resolve(places, queries)
    got = {tuple(r["query"]) if r["query"] is not None else None: (r.outcome, r.path) for r in found.collect()}
    assert got == {
        ("top",): ("found", ["top"]), ("t",): ("ambiguous", None), ("b", "t"): ("found", ["top", "b", "t"]), ("b", "u"): ("missing", None), ("a",): ("ambiguous", None),
        ("q",): ("missing", None), (): ("missing", None), None: ("missing", None), ("lone",): ("found", ["lone"]),
    }
    below = sorted((".".join(r["query"]), r.tag) for r in T.tags_below(places, found).collect())
    assert below == [("b.t", "t"), ("lone", "lone"), ("top", "b"), ("top", "t"), ("top", "t"), ("top", "top")]
    assert sorted((".".join(r["query"]), r.group, r.up) for r in T.groups_above(found).where(F.size("query") == 2).collect()) == [("b.t", "b", 1), ("b.t", "t", 0), ("b.t", "top", 2)]


def plain_merge(n, edges, labels, threshold, first, known, n_known, least):
    same = np.zeros((n, n), bool)
    for a, b in edges:
        same[a, b] = same[b, a] = True
    lab = np.array(labels)
    alive = set(lab[lab >= 0].tolist())
    while True:
        merged = False
        for x in range(least, max(labels) + 1):
            for y in range(max(x + 1, first), max(labels) + 1):
                if x in alive and y in alive and same[lab == x][:, lab == y].mean() >= threshold:
                    for i in np.where(lab == y)[0]:
                        if known is None or x >= n_known or x in known.get(i, ()):
                            lab[i] = x
                    alive.remove(y)
                    merged = True
        if not merged:
            return lab.tolist()


@pytest.mark.parametrize(("seed", "n_known", "first", "least", "with_known"), [(3, 0, 0, 0, False), (7, 3, 0, 1, True), (6, 12, 0, 0, True), (9, 4, 3, 1, True)])
def test_merge_with_known_characters(spark, seed, n_known, first, least, with_known):
    r = random.Random(seed)
    labels = [r.randrange(-1, 9) for _ in range(40)]
    edges = [(a, b) for a in range(40) for b in range(a + 1, 40) if r.random() < 0.6]
    known = {i: {r.randrange(9) for _ in range(2)} for i in range(40) if r.random() < 0.9} if with_known else None
    k = spark.createDataFrame([(i, c) for i, s in known.items() for c in s], "item long, character long") if with_known else None
    got = K.merge_clusters(spark.createDataFrame(edges, "src long, dst long"), spark.createDataFrame(list(enumerate(labels)), "item long, label long"), 0.55, first, k, n_known, least)
    want = plain_merge(40, edges, labels, 0.55, first, known, n_known, least)
    assert {x["item"]: x.label for x in got.collect()} == dict(enumerate(want)) and want != labels


def test_group_distances_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 7)
    monkeypatch.setattr(S, "SENT_REFERENCES", 5)
    r = np.random.default_rng(1)
    a, b = r.normal(size=(30, 4)), r.normal(size=(20, 4))
    to = r.integers(-2, 3, 20)
    left = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(a)] + [(99, None)], "item long, vec array<double>")
    right = spark.createDataFrame([(f"r{i}", x.tolist(), int(to[i])) for i, x in enumerate(b)] + [("n", None, 1)], "item string, vec array<double>, to long")
    dist = 1 - (a / np.linalg.norm(a, axis=1, keepdims=True)) @ (b / np.linalg.norm(b, axis=1, keepdims=True)).T
    got = {(x.src, x.to): (x.d, x.least, x["count"], x.share) for x in S.group_distances(left, right, 0.8).collect()}
    want = {}
    for i in range(30):
        for k in set(to.tolist()):
            d = dist[i][to == k]
            want[i, k] = (pytest.approx(d.mean()), pytest.approx(d.min()), (d <= 0.8).sum(), pytest.approx((d <= 0.8).mean()))
    assert got == want
    assert S.group_distances(left.limit(0), right, 0.8).count() == 0
    full = S.reference_distances(left.where("vec is not null"), right.where("vec is not null").withColumnRenamed("item", "ref")).collect()
    assert {(x["item"], x.ref): pytest.approx(x.dist) for x in full} == {(i, f"r{j}"): dist[i, j] for i in range(30) for j in range(20)}


def test_every_reference_is_kept(spark):
    known = spark.createDataFrame([(0, "a"), (2, "z")], "label long, character string")
    refs = spark.createDataFrame([(5, "n"), (6, "n"), (7, "a"), (8, "a")], "label long, character string")
    assert sorted(tuple(r) for r in O.merge_references(known, refs).select("label", "character", F.coalesce("ref_label", F.lit(-1))).collect()) == [(0, "a", 7), (0, "a", 8), (2, "z", -1), (3, "n", 5), (3, "n", 6)]
    no_folder = spark.createDataFrame([("x.png", None)], "path string, general string").select(O.description(F.col("general"), F.col("path"), "c", True)).first()[0]
    assert no_folder == "c "


def test_embedding_starts(spark):
    old = spark.createDataFrame([("a", ["x"]), ("booru", ["own"])], "name string, init array<string>")
    names = spark.createDataFrame([("a",), ("b",), ("screenshots",)], "name string")
    found = spark.createDataFrame([("a", ["x", "y"]), ("c", ["z", "z"])], "name string, init array<string>")
    got = lambda *x, **k: {r.name: r.init for r in merge_emb_init(*x, **k).collect()}
    assert got(old, names, ["booru", "screenshots", "k"], found) == {"a": ["x", "y"], "b": [], "screenshots": [], "booru": ["own"], "k": [""], "c": ["z", "z"]}
    assert got(old, names, ["booru"], overwrite=True) == {"a": [], "b": [], "screenshots": [], "booru": ["masterpiece"]}

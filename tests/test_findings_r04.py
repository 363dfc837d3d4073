"""What round 4's findings were about."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from siftloom.operators import cluster as K
from siftloom.operators import near as N
from siftloom.operators import similar as S
from siftloom.operators.near import Near
from siftloom.plans import registry
from siftloom.session import materialize

SF = "/root/testdata/sf0.001"


def test_first_face_ties(spark, tmp_path):
    """of lines of equal number the table's first one counts, which is what the SQL gives on one thread over one file. Spark reads the larger file first."""
    folder = tmp_path / "t" / "lineitem.parquet"
    folder.mkdir(parents=True)
    con = duckdb.connect()
    con.execute("set threads = 1")
    con.execute(f"create view raw as select * replace (l_orderkey % 50 as l_orderkey) from '{SF}/lineitem.parquet' where l_linenumber = 1")
    con.execute(f"copy (select * from raw order by l_partkey desc limit 300) to '{folder}/a.parquet'")
    con.execute(f"copy raw to '{folder}/b.parquet'")
    con.execute(f"create table lineitem as select * from read_parquet('{folder}/*.parquet', filename = true, file_row_number = true) order by filename, file_row_number")
    want = con.execute(registry.oracle_sql()["first_face"]).fetchall()
    got = registry.queries()["first_face"](spark, str(tmp_path / "t")).collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 40


@pytest.fixture
def small_chunks(monkeypatch):
    monkeypatch.setattr(N, "CHUNK", 40)
    monkeypatch.setattr(N, "PARTS", 3)


def vectors(spark, seed=1, n=700):
    """Vectors about 60 middles, some of them repeated, zero or null, and a few rows of the same item."""
    r = np.random.default_rng(seed)
    v = r.normal(size=(60, 12))[r.integers(0, 60, n)] + 0.5 * r.normal(size=(n, 12))
    v[40:60] = v[20:40]
    v[80] = 0
    rows = [(int(3 * i + 1), None if i % 97 == 5 else [float(np.float32(x)) for x in v[i]]) for i in r.permutation(n)]
    rows += [(item, [float(x) for x in r.normal(size=12)]) for item, _ in rows[:5]]
    return spark.createDataFrame(rows, "item long, vec array<float>")


def plain(df):
    return sorted(map(tuple, df.collect()))


def test_pairs_are_counted_not_listed(spark, small_chunks):
    """F2 to F11: what is asked of the pairs is the same as by their list, over many chunks."""
    v = materialize(vectors(spark), "v")
    items = v.select("item").distinct()
    label = F.when(F.col("item") % 11 == 0, -1).otherwise(F.col("item") % 6).cast("long")
    labels = materialize(items.select("item", label.alias("label")), "labels")
    known = items.where("item % 3 = 1").select("item", (F.col("item") % 5).alias("character"))
    for over in (0.8, 0.45):
        edges, near = materialize(S.similar_pairs(v, over), "edges"), Near(v, over)
        assert edges.count() > 100 and N._packed(v)[1] == 18
        assert plain(near.degrees()) == plain(K.both_ways(edges).groupBy("src").count())
        clusters = plain(K.density_clusters(items, near, 4))
        assert clusters == plain(K.density_clusters(items, edges, 4)) and len({x for _, x in clusters}) > 1
        assert plain(K.affinity(near, labels)) == plain(K.affinity(edges, labels))
        assert plain(K.filter_labels(labels, near, 0.05, 4)) == plain(K.filter_labels(labels, edges, 0.05, 4))
        kept = plain(S.keep_first(items, edges).join(v.select("item"), "item"))
        for turn in (150, 10_000):
            assert plain(near.keep_first(v, turn)) == kept
    more = {"known": known, "n_known": 4, "least": 1}
    for options in ({}, more):
        got = plain(K.merge_clusters(Near(v, 0.3), labels, 0.09, **options))
        assert got == plain(K.merge_clusters(materialize(S.similar_pairs(v, 0.3), "edges"), labels, 0.09, **options)) and got != plain(labels)


@pytest.mark.parametrize("name", ["label_counts", "cluster_to_meta", "eps_clusters", "noise_rescue", "classification_job", "label_filter", "cluster_affinity", "near_dup_keep", "merge_clusters", "merge_known_clusters"])
def test_no_list_of_pairs(spark, monkeypatch, small_chunks, name):
    """F2 to F11: these queries stored or shuffled a row for each pair."""
    for module in (S, N):
        monkeypatch.setattr(module, "similar_pairs", lambda *a, **k: pytest.fail("pairs are listed"), raising=False)
    assert registry.queries()[name](spark, SF).count() > 0


def test_no_pairs_at_all(spark, small_chunks):
    v = vectors(spark, n=90)
    for rows in (v, v.limit(0)):
        near = Near(rows, 2.0)
        items = rows.select("item").distinct()
        assert near.degrees().count() == 0 and near.counts(items.select("item", F.lit(1).alias("label"))).count() == 0
        assert {x for _, x in plain(K.density_clusters(items, near, 3))} <= {-1} and plain(near.keep_first(rows, 30)) == plain(rows.select("item"))

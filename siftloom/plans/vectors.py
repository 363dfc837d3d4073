"""Similarity and cluster queries over the embeddings table."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftloom.operators import cluster as K
from siftloom.operators import similar as S
from siftloom.operators.near import Near
from siftloom.session import materialize, table

QUERIES, SQL = {}, {}
NEAR, REACH, LEAST = 0.40, 0.30, 5


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("item"), F.col("embedding").alias("vec"), "label")


def refs(spark, sf_dir):
    """The first row of each label is its reference, and one more for each sign of the first number."""
    v = table(spark, sf_dir, "embeddings").groupBy("label", (F.get("embedding", F.lit(0)) > 0).alias("side")).agg(F.min_by("embedding", "vec_id").alias("vec"), F.min("vec_id").alias("ref"))
    return v.select("ref", F.col("label").cast("long").alias("ref_label"), "vec")


def known(spark, sf_dir):
    """Rows whose first number is positive are known to show their label."""
    return table(spark, sf_dir, "embeddings").where(F.get("embedding", F.lit(0)) > 0).select(F.col("vec_id").alias("item"), F.col("label").cast("long").alias("character"))


_V = """
vec as (select vec_id as item, embedding::double[] as v, label from embeddings),
u as (select item, label, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) as v from vec),
c as (select a.item as src, b.item as dst, list_dot_product(a.v, b.v) as cos from u a join u b on a.item < b.item)"""
_E = f"{_V},\nedge as (select src, dst from c where cos > {REACH}),\nways as (select src, dst from edge union all select dst, src from edge)"
_L = f"""{_E},
core as (select src as core from ways group by src having count(*) >= {LEAST - 1}),
ce as (select src, dst from ways where src in (from core) and dst in (from core)),
walk as (select core as id, core as r from core union select ce.dst, walk.r from walk join ce on ce.src = walk.id),
cl as (select id, min(r) as label from walk group by id),
bd as (select ways.src as item, min(label) as reach from ways join cl on ways.dst = cl.id group by 1),
lab as (select item, coalesce(cl.label, bd.reach, -1)::bigint as label from vec left join cl on cl.id = item left join bd using (item))"""
_R = """ref as (select min(vec_id) as ref, label::bigint as ref_label, arg_min(embedding, vec_id)::double[] as rv from embeddings group by label, embedding[1] > 0),
rd as (select item, ref, ref_label, 1 - list_dot_product(u.v, list_transform(rv, lambda x: x / sqrt(list_dot_product(rv, rv)))) as dist from u, ref)"""


@query("near_dup_edges", f"with {_V} select src, dst, round(cos, 6) as cos from c where cos > {NEAR}")
def near_dup_edges(spark, sf_dir):
    return S.similar_pairs(vectors(spark, sf_dir), NEAR).select("src", "dst", F.round("cos", 6).alias("cos"))


@query("near_dup_keep", f"""with recursive {_E}, nb as (select dst as item, list(src) as before from edge group by dst),
o as materialized (select item, before, row_number() over (order by item) as k from vec left join nb using (item)),
w as (select 0::bigint as k, []::bigint[] as kept union all
    select o.k, case when list_has_any(coalesce(before, []), kept) then kept else list_append(kept, o.item) end from w join o on o.k = w.k + 1)
select unnest(kept) as item from w where k = (select count(*) from vec)""")
def near_dup_keep(spark, sf_dir):
    return _edges(spark, sf_dir).keep_first(vectors(spark, sf_dir).select("item"))


def _edges(spark, sf_dir):
    """Never listed: their number grows with the square of the rows'."""
    return Near(vectors(spark, sf_dir), REACH)


def _labels(spark, sf_dir, edges):
    return materialize(K.density_clusters(vectors(spark, sf_dir).select("item"), edges, LEAST), "labels")


def _split(spark, sf_dir):
    """Clusters cut by the given label, so that there are several."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("item"), F.col("label").cast("long").alias("label"))


@query("eps_clusters", f"with recursive {_L} select item, label from lab")
def eps_clusters(spark, sf_dir):
    return _labels(spark, sf_dir, _edges(spark, sf_dir))


@query("label_counts", f"with recursive {_L} select label, count(*) as n from lab group by label")
def label_counts(spark, sf_dir):
    return K.label_counts(eps_clusters(spark, sf_dir))


@query("cluster_affinity", f"""with {_E}, s as (select label, count(*) as size from vec group by label),
x as (select least(a.label, b.label)::bigint as x, greatest(a.label, b.label)::bigint as y, count(*) as n_same from edge join vec a on a.item = src join vec b on b.item = dst where a.label <> b.label group by 1, 2)
select x, y, n_same, sx.size as size_x, sy.size as size_y, round(n_same / (sx.size * sy.size), 9) as score from x join s sx on sx.label = x join s sy on sy.label = y""")
def cluster_affinity(spark, sf_dir):
    return K.affinity(_edges(spark, sf_dir), _split(spark, sf_dir)).withColumn("score", F.round("score", 9))


@query("merge_clusters")
def merge_clusters(spark, sf_dir):
    return K.merge_clusters(_edges(spark, sf_dir), _split(spark, sf_dir), 0.0085)


@query("item_ref_distance", f"with {_V}, {_R} select item, ref, round(dist, 6) + 0.0::double as dist from rd")
def item_ref_distance(spark, sf_dir):
    return S.reference_distances(vectors(spark, sf_dir), refs(spark, sf_dir)).select("item", "ref", (F.round("dist", 6) + 0.0).alias("dist"))


@query("cluster_to_ref", f"""with {_V}, {_R}, m as (select vec.label::bigint as label, ref, ref_label, avg(dist) as m from rd join vec using (item) group by all),
b as (select label, ref_label, min(m) as dist, avg((m <= 0.97)::int) as share from m group by all),
r as (select *, row_number() over (partition by label order by dist, ref_label) as k from b)
select label, ref_label, round(dist, 6) as dist, round(share, 6) as share from r where k = 1 and share >= 0.01""")
def cluster_to_ref(spark, sf_dir):
    r = refs(spark, sf_dir)
    members = vectors(spark, sf_dir).select("item", "vec", F.col("label").alias("to"))
    means = S.group_distances(r.select(F.col("ref").alias("item"), "vec"), members, 0.97).select(F.col("src").alias("ref"), F.col("to").alias("label"), F.col("d").alias("m"))
    return K.reference_votes(means, r, 0.97).select("label", "ref_label", F.round("dist", 6).alias("dist"), F.round("share", 6).alias("share"))


@query("cluster_to_ref_avg", f"""with {_V}, {_R}, m as (select vec.label::bigint as label, ref, ref_label, avg(dist) as m from rd join vec using (item) group by all),
b as (select label, ref_label, avg(m) as dist, avg((m <= 0.99)::int) as share from m group by all),
r as (select *, row_number() over (partition by label order by dist, ref_label) as k from b)
select label, ref_label, round(dist, 6) as dist, round(share, 6) as share from r where k = 1 and share >= 0.01""")
def cluster_to_ref_avg(spark, sf_dir):
    """The same vote by the mean over a label's references."""
    r = refs(spark, sf_dir)
    members = vectors(spark, sf_dir).select("item", "vec", F.col("label").alias("to"))
    means = S.group_distances(r.select(F.col("ref").alias("item"), "vec"), members, 0.99).select(F.col("src").alias("ref"), F.col("to").alias("label"), F.col("d").alias("m"))
    return K.reference_votes(means, r, 0.99, mode="avg").select("label", "ref_label", F.round("dist", 6).alias("dist"), F.round("share", 6).alias("share"))


@query("cluster_to_meta", f"""with recursive {_L}, k as (select vec_id as item, label::bigint as character from embeddings where embedding[1] > 0),
s as (select label, count(*) as size from lab where label >= 0 group by label), v as (select label, character, count(*) as n from lab join k using (item) where label >= 0 group by all),
t as (select *, rank() over (partition by label order by n desc) as r from v), b as (select label, min(character) as character, count(*) as ties, max(n) as n from t where r = 1 group by label)
select label, character, round(n / size, 9) as share from b join s using (label) where n / size >= 0.05 and ties = 1""")
def cluster_to_meta(spark, sf_dir):
    return K.cluster_to_metadata(eps_clusters(spark, sf_dir), known(spark, sf_dir), 0.05).withColumn("share", F.round("share", 9))


@query("constrained_assign", """with k as (select vec_id as item, label::bigint as character from embeddings where embedding[1] > 0),
l as (select vec_id as item, label::bigint as label from embeddings),
o as (select l.item, min(case when j.p is not null then j.p end) as p from l left join (select l.item, 0 as p from l join k on k.item = l.item and k.character = (l.label + 1) % 10
  union all select l.item, 1 from l join k on k.item = l.item and k.character = l.label % 10) j on j.item = l.item group by l.item)
select l.item, case p when 0 then (label + 1) % 10 when 1 then label % 10 else label end as label from l join o using (item)""")
def constrained_assign(spark, sf_dir):
    labels = _split(spark, sf_dir)
    each = labels.select("label").distinct()
    candidates = each.select("label", F.lit(0).alias("priority"), ((F.col("label") + 1) % 10).alias("candidate"), F.lit(False).alias("open")).union(
        each.select("label", F.lit(1), F.col("label") % 10, F.lit(False))
    )
    return K.assign_if_consistent(labels, candidates, known(spark, sf_dir))


@query("noise_rescue", f"""with recursive {_L}, k as (select vec_id as item, label::bigint as character from embeddings where embedding[1] > 0),
n as (select item as src from lab where label = -1), m as (select item as dst, label as target from lab where label >= 0),
d as (select src, dst, 1 - cos as dist from c union all select dst, src, 1 - cos from c),
b as (select src, target, avg(dist) as d, count(*) filter (where dist <= 0.75) as cnt, count(*) filter (where dist <= 0.75) / count(*) as share from d join n using (src) join m using (dst) group by all),
r as (select *, row_number() over (partition by src order by d, target) as q from b), f as (select src as item, target from r where q = 1 and (share >= 0.02 or cnt >= 3)),
y as (select item, min(character) as one from k group by item having count(*) = 1)
select lab.item, case when label >= 0 then label else coalesce(target, one, -1) end::bigint as label from lab left join f using (item) left join y using (item)""")
def noise_rescue(spark, sf_dir):
    v, edges = vectors(spark, sf_dir), _edges(spark, sf_dir)
    labels = _labels(spark, sf_dir, edges)
    return K.rescue_noise(labels, S.distances_to_groups(v, labels, 0.75), known(spark, sf_dir), 0.02, 3)


_LR = """
xl as (select vec_id as item, case when vec_id % 4 = 0 then -1 else label end::bigint as label from embeddings),
xn as (select item as src from xl where label = -1),
xu as (select vec_id as item, list_transform(embedding::double[], lambda x: x / sqrt(list_dot_product(embedding::double[], embedding::double[]))) as v from embeddings),
xr as (select min(vec_id) as ref, label::bigint as to_, arg_min(embedding, vec_id)::double[] as rv from embeddings group by label, embedding[1] > 0),
xq as (select u.item as src, to_, 1 - list_dot_product(u.v, list_transform(rv, lambda x: x / sqrt(list_dot_product(rv, rv)))) as dist from xu u join xn on u.item = xn.src, xr),
xp as (select src, to_, min(dist) as least, count(*) filter (where dist <= 0.8) as cnt from xq group by all),
xb as (select src, to_, least, cnt from (select *, row_number() over (partition by src order by least, to_) as k from xp) where k = 1),
yq as (select a.item as src, xl.label as to_, 1 - list_dot_product(a.v, b.v) as dist from xu a join xn on a.item = xn.src join xl on xl.label >= 0 join xu b on b.item = xl.item),
yp as (select src, to_, avg(dist) as d, count(*) filter (where dist <= 0.75) as cnt, count(*) filter (where dist <= 0.75) / count(*) as share from yq group by all),
yb as (select src, to_, d, cnt, share from (select *, row_number() over (partition by src order by d, to_) as k from yp) where k = 1)"""
_K4 = "k as (select vec_id as item, label::bigint as character from embeddings where vec_id % 3 <> 1 union select vec_id, ((label + vec_id) % 5)::bigint from embeddings where vec_id % 7 = 0)"
_ONLY = "o as (select item, min(character) as one from k group by item having count(*) = 1)"


def _rescue_inputs(spark, sf_dir):
    """A quarter of the rows is noise; two rows of three are known to show their label and a few another one beside it."""
    e = table(spark, sf_dir, "embeddings")
    item, label = F.col("vec_id").alias("item"), F.col("label").cast("long")
    labels = e.select(item, F.when(F.col("vec_id") % 4 == 0, -1).otherwise(label).cast("long").alias("label"))
    shown = e.where("vec_id % 3 <> 1").select(item, label.alias("character")).union(e.where("vec_id % 7 = 0").select(item, ((F.col("label") + F.col("vec_id")) % 5).cast("long"))).distinct()
    v = vectors(spark, sf_dir).select("item", "vec").join(labels, "item")
    return materialize(labels, "labels"), shown, materialize(v, "rows"), refs(spark, sf_dir)


@query("noise_rescue_refs", f"""with {_LR}
select xl.item, case when xl.label >= 0 then xl.label when xb.cnt > 0 then xb.to_ else -1 end::bigint as label from xl left join xb on xb.src = xl.item""")
def noise_rescue_refs(spark, sf_dir):
    """References alone: the label of the nearest one, if one of the label's is the same."""
    labels, _, v, r = _rescue_inputs(spark, sf_dir)
    near = S.group_distances(v.where("label = -1"), r.select(F.col("ref").alias("item"), "vec", F.col("ref_label").alias("to")), 0.8)
    return K.rescue_noise(labels, None, None, 0.02, 3, by_reference=near)


@query("noise_rescue_all", f"""with {_LR}, {_K4}, {_ONLY},
j as (select xn.src, xb.to_ as rt, xb.least, xb.cnt as rc, yb.to_ as ct, d, yb.cnt as cc, share,
 exists (select 1 from k where k.item = xn.src and k.character = xb.to_) as rs, exists (select 1 from k where k.item = xn.src and k.character = yb.to_) as cs
 from xn left join xb using (src) left join yb using (src)),
f as (select src, case when least < d and rc > 0 and rs then rt when (share >= 0.05 or cc >= 3) and (cs or ct >= 8) then ct end as found from j)
select xl.item, case when xl.label >= 0 then xl.label else coalesce(found, one, -1) end::bigint as label from xl left join f on f.src = xl.item left join o on o.item = xl.item""")
def noise_rescue_all(spark, sf_dir):
    """References, clusters and known characters, which speak against labels under 8."""
    labels, shown, v, r = _rescue_inputs(spark, sf_dir)
    noise = v.where("label = -1")
    near = S.group_distances(noise, r.select(F.col("ref").alias("item"), "vec", F.col("ref_label").alias("to")), 0.8)
    groups = S.group_distances(noise, v.where("label >= 0").select("item", "vec", F.col("label").alias("to")), 0.75)
    return K.rescue_noise(labels, groups, shown, 0.05, 3, by_reference=near, n_known=8)


@query("merge_known_clusters")
def merge_known_clusters(spark, sf_dir):
    """Merging in which only rows known to show the other label move, for labels under 6."""
    _, shown, _, _ = _rescue_inputs(spark, sf_dir)
    return K.merge_clusters(_edges(spark, sf_dir), _split(spark, sf_dir), 0.0085, known=shown, n_known=6, least=1)

@query("label_filter", f"""with {_E}, s as (select label, count(*) as size from vec group by label),
n as (select src as item, count(*) as n from ways join vec a on a.item = src join vec b on b.item = dst where a.label = b.label group by 1)
select vec.item, case when (coalesce(n, 0) + 1) / size >= 0.03 or coalesce(n, 0) + 1 >= 4 then label else -1 end::bigint as label from vec left join n using (item) join s using (label)""")
def label_filter(spark, sf_dir):
    return K.filter_labels(_split(spark, sf_dir), _edges(spark, sf_dir), 0.03, 4)


@query("topk_accuracy", """with x as (select vec_id, label, generate_subscripts(embedding, 1) - 1 as class, unnest(embedding) as p from embeddings),
r as (select *, row_number() over (partition by vec_id order by p desc, class) as k from x where class < 10)
select count(*) filter (where k <= 1 and class = label) as top1, count(*) filter (where k <= 5 and class = label) as top5, count(distinct vec_id) as n from r""")
def topk_accuracy(spark, sf_dir):
    from siftloom.operators.labels import top_k_hits

    probs = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("item"), F.col("label").alias("target"), F.slice("embedding", 1, 10).alias("probs"))
    return top_k_hits(probs, (1, 5))


@query("two_model_vote", """with x as (select vec_id, generate_subscripts(embedding, 1) - 1 as i, unnest(embedding)::double as p from embeddings),
a as (select vec_id, arg_max(i, p) as c, max(p) as p from x where i < 10 group by 1), b as (select vec_id, arg_max(i - 10, p) as c, max(p) as p from x where i >= 10 and i < 20 group by 1)
select vec_id as item, case when greatest(a.p, b.p) <= 0.2 then 'unknown' when a.p > b.p then 'c' || a.c else 'c' || b.c end as character from a join b using (vec_id)""")
def two_model_vote(spark, sf_dir):
    from siftloom.operators.labels import two_model_vote as vote

    e = table(spark, sf_dir, "embeddings")
    parts = [e.select(F.col("vec_id").alias("item"), F.posexplode(F.slice("embedding", s, 10)).alias("class", "p")) for s in (1, 11)]
    named = [p.select("item", F.concat(F.lit("c"), "class").alias("class"), F.col("p").cast("double").alias("p")) for p in parts]
    return vote(*named, 0.2)

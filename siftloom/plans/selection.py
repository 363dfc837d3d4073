"""Selection, balance, label and folder queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftloom.functions import boxes as B
from siftloom.operators import balance as W
from siftloom.operators import cluster as K
from siftloom.operators import filters as R
from siftloom.operators import labels as L
from siftloom.operators import select as S
from siftloom.operators import tree as T
from siftloom.plans import views as V
from siftloom.session import table

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


LIMIT = 40
_K = f"with {V.POSTS}, k as (select event_id, ts, unnest(keys) as key from post), r as (select event_id, count(*) over (partition by key order by ts, event_id rows between unbounded preceding and 1 preceding) as before from k)"


@query("key_quota", f"{_K} select distinct event_id from r where before < {LIMIT}")
def key_quota(spark, sf_dir):
    return S.key_quota(V.posts(spark, sf_dir), "event_id", "keys", ["ts", "event_id"], LIMIT).select("event_id")


@query("total_limit", f"{_K}, p as (select distinct event_id from r where before < {LIMIT}) select event_id from post join p using (event_id) order by ts, event_id limit 100")
def total_limit(spark, sf_dir):
    return S.key_quota(V.posts(spark, sf_dir), "event_id", "keys", ["ts", "event_id"], LIMIT).orderBy("ts", "event_id").limit(100).select("event_id")


@query("follow_up_keys", f"with {V.POSTS}, wanted as (select distinct 'u' || (c_custkey % 60) as key from customer) select key from wanted where key not in (select unnest(keys) from post)")
def follow_up_keys(spark, sf_dir):
    wanted = table(spark, sf_dir, "customer").select(F.concat(F.lit("u"), F.col("c_custkey") % 60).alias("key")).distinct()
    return S.follow_up_keys(wanted, V.posts(spark, sf_dir), "keys")


@query("site_flatten", "select event_id, json_extract_string(props, '$.k')::bigint as k, 'site' as site, event_type || ';' || user_id as tags from events")
def site_flatten(spark, sf_dir):
    from siftloom.sources.posts import flatten_site

    raw = table(spark, sf_dir, "events").select(
        "event_id", F.concat_ws(" ", "event_type", F.col("user_id").cast("string")).alias("tag_string_general"), F.from_json("props", "k bigint")["k"].alias("score")
    )
    return flatten_site(raw, "site").select("event_id", F.col("score").alias("k"), "site", F.array_join("tags", ";").alias("tags"))


@query("fair_share")
def fair_share(spark, sf_dir):
    """Ten orders of each customer, by fair shares of the lists of each priority."""
    return S.fair_share(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), "o_custkey", "o_orderpriority", ["o_orderkey"], 10)


@query("crop_label_propagation", """with c as (select o_custkey as parent_id, o_orderkey, o_orderpriority as ch from orders where o_orderstatus <> 'F'),
d as (select parent_id, ch, min(o_orderkey) as k from c group by all), n as (select parent_id, string_agg(ch, ';' order by k) as new from d group by 1)
select c_custkey as item_id, coalesce(new, c_mktsegment) as characters from customer left join n on parent_id = c_custkey""")
def crop_label_propagation(spark, sf_dir):
    """Orders as crops of their customers; finished orders are noise."""
    crops = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("o"), "o_orderkey").alias("item_id"), F.concat(F.lit("c"), "o_custkey").alias("parent_id"), F.col("o_orderkey").alias("ord"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("character"),
    )
    parents = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("item_id"), F.array("c_mktsegment").alias("characters"))
    out = S.propagate_labels(crops, parents, overwrite=True)
    return out.select(F.substring("item_id", 2, 30).cast("long").alias("item_id"), F.array_join("characters", ";").alias("characters"))


@query("crop_labels_kept", """with c as (select o_custkey as pid, o_orderkey as k, o_orderpriority || '|' || o_orderstatus as ch from orders),
u as (select pid, arg_max(ch, k) as f from c where ch like '1-URGENT|%' group by pid) select c_custkey as item_id, coalesce(f, '1-URGENT') || ';' || c_mktsegment as characters from customer left join u on pid = c_custkey""")
def crop_labels_kept(spark, sf_dir):
    """Parents keep their own names; a crop's form of the same name, the last one, takes its place."""
    crops = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("o"), "o_orderkey").alias("item_id"), F.concat(F.lit("c"), "o_custkey").alias("parent_id"), F.col("o_orderkey").alias("ord"),
        F.concat_ws("|", "o_orderpriority", "o_orderstatus").alias("character"),
    )
    parents = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("item_id"), F.array(F.lit("1-URGENT"), F.col("c_mktsegment")).alias("characters"))
    out = S.propagate_labels(crops, parents, overwrite=False)
    return out.select(F.substring("item_id", 2, 30).cast("long").alias("item_id"), F.array_join("characters", ";").alias("characters"))


@query("sample_rest")
def sample_rest(spark, sf_dir):
    """A hundred documents of those without characters, by a seeded hash."""
    return S.sample_rows(V.items(spark, sf_dir).where(F.size("characters") == 0).select("item_id"), "item_id", 100, 7)


@query("shuffled_tags")
def shuffled_tags(spark, sf_dir):
    """Tags that count people first, the rest in an order drawn by a seeded hash, thirty of them."""
    from siftloom.functions import tags as G

    shuffled = G.append_and_truncate(G.sort_tags(F.col("tags"), "shuffle", F.col("item_id"), 3), None, 30)
    return V.items(spark, sf_dir).select("item_id", F.array_join(F.transform(shuffled, lambda t: t["tag"]), " ").alias("tags"))


@query("large_crop_selection", f"""with {V.BOXES}, c as (select case when (r - l) * (b - t) > 0.5 * 40000 then 'p' || item else 'd' || item || '_' || det end as item_id from box),
o as (select 'p' || o_orderkey as item_id from orders) select item_id, case when item_id in (select item_id from c) then 'classified' else 'raw' end as came_from from (select item_id from c union select item_id from o)""")
def large_crop_selection(spark, sf_dir):
    b = V.boxes(spark, sf_dir)
    crops = b.select(F.concat(F.lit("d"), "item", F.lit("_"), "det").alias("item_id"), F.concat(F.lit("p"), "item").alias("parent_id"), ((F.col("r") - F.col("l")) * (F.col("b") - F.col("t"))).alias("area"), F.lit(40000).alias("parent_area"))
    return S.large_crop_selection(crops, table(spark, sf_dir, "orders").select(F.concat(F.lit("p"), "o_orderkey").alias("item_id")))


@query("top_score", "select doc_id, n_chars from documents order by n_chars desc, doc_id desc limit 50")
def top_score(spark, sf_dir):
    return S.top_by_score(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars", "doc_id", 50)


RULES = [(0, "ASIA", 3.0), (1, "*/BUILDING", 0.5), (2, "E*/*/MACHINERY", 2.5), (3, "FRANCE", 4.0), (4, "*NATION_1?", 1.5)]
_RULES = ", ".join(f"({o}, '{p}', {w}::double)" for o, p, w in RULES)
_WEIGHT = f"""{V.FOLDERS}, rule(ord, pattern, w) as (values {_RULES}), part as (select path, n, string_split(path, '/') as a from folder),
node as (select distinct array_to_string(a[:d], '/') as path, array_to_string(a[:d - 1], '/') as parent from part, (select unnest([1, 2, 3]) as d)),
fit as (select path, arg_min(w, (case when string_split(path, '/')[-1] = pattern then 0 else 100 end) + ord) as weight from node join rule on string_split(path, '/')[-1] = pattern or path similar to replace(replace(pattern, '*', '.*'), '?', '.') group by path),
wn as (select node.path, parent, coalesce(weight, 1.0) as weight from node left join fit using (path)),
sh as (select path, weight / sum(weight) over (partition by parent) as s from wn),
pr as (select part.path, n, s1.s * s2.s * s3.s as prob from part join sh s1 on s1.path = a[1] join sh s2 on s2.path = a[1] || '/' || a[2] join sh s3 on s3.path = part.path),
bal as (select path, n, prob, prob / n / min(prob / n) over () as raw from pr)"""


def _balanced(spark, sf_dir):
    rules = spark.createDataFrame(RULES, "ord int, pattern string, weight double")
    return W.balance(V.folders(spark, sf_dir), rules)


@query("balance_multiply", f"with {_WEIGHT} select path, n, round(prob, 9) as prob, round(raw, 6) as raw, round(least(round_even(round(raw * 100, 6), 0) / 100, 100), 6) as multiply from bal")
def balance_multiply(spark, sf_dir):
    return _balanced(spark, sf_dir).select("path", "n", F.round("prob", 9).alias("prob"), F.round("raw", 6).alias("raw"), F.round("multiply", 6).alias("multiply"))


@query("glob_weights", f"with {_WEIGHT} select path, weight from wn")
def glob_weights(spark, sf_dir):
    f = V.folders(spark, sf_dir).withColumn("parts", F.split("path", "/"))
    nodes = f.select(F.explode(F.transform(F.sequence(F.lit(1), F.lit(3)), lambda d: F.array_join(F.slice("parts", F.lit(1), d), "/"))).alias("path")).distinct()
    return W.folder_weights(nodes, spark.createDataFrame(RULES, "ord int, pattern string, weight double"))


@query("repeat_totals", f"with {_WEIGHT} select sum(n)::bigint as n, round(sum(n * least(round_even(round(raw * 100, 6), 0) / 100, 100)), 3) as virtual from bal")
def repeat_totals(spark, sf_dir):
    return W.repeat_totals(_balanced(spark, sf_dir)).select("n", F.round("virtual", 3).alias("virtual"))


@query("stratified_split", """with r as (select p_partkey, p_type, row_number() over (partition by p_type order by p_partkey) as k, count(*) over (partition by p_type) as n from part)
select p_partkey, p_type, case when k <= floor(n * 0.8) then 'train' else 'test' end as part from r""")
def stratified_split(spark, sf_dir):
    return L.stratified_split(table(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_type", ["p_partkey"], 0.8)


@query("dense_classes", "with f as (select p_brand, min(p_partkey) as first from part group by 1) select p_brand, (row_number() over (order by first, p_brand) - 1)::int as id from f")
def dense_classes(spark, sf_dir):
    return K.dense_ids(table(spark, sf_dir, "part"), "p_brand", "p_partkey")


_VOCAB = """t as (select unnest(string_split(p_name, ' ')) as token, p_partkey * 10 + generate_subscripts(string_split(p_name, ' '), 1) - 1 as ord from part),
v as (select token, count(*) as n, (row_number() over (order by min(ord)) + 4)::int as id from t group by token having count(*) >= 20)"""


def _vocab(spark, sf_dir):
    tokens = table(spark, sf_dir, "part").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("pos", "token")).select("token", (F.col("p_partkey") * 10 + F.col("pos")).alias("ord"))
    return L.vocabulary(tokens, 20)


@query("vocab", f"with {_VOCAB} select * from v")
def vocab(spark, sf_dir):
    return _vocab(spark, sf_dir)


@query("encode_tags", f"""with {_VOCAB}, e as (select p_partkey, coalesce(a.id, 1) as a, coalesce(b.id, 1) as b from part left join v a on a.token = split_part(p_name, ' ', 1) left join v b on b.token = split_part(p_name, ' ', 2))
select p_partkey, '2,' || a || ',' || b || ',3,0,0' as ids from e""")
def encode_tags(spark, sf_dir):
    words = table(spark, sf_dir, "part").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("pos", "token"))
    ids = words.join(_vocab(spark, sf_dir), "token", "left").groupBy("p_partkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]).alias("ids"))
    return ids.select("p_partkey", F.array_join(L.encode_tokens(F.col("ids"), 6).cast("array<string>"), ",").alias("ids"))


@query("list_stats", f"with {V.ITEMS}, n as (select item.item_id, count(tag.tag) as n from item left join tag using (doc_id) group by 1) select quantile_cont(n, 0.5) as median, round(avg(n), 6) as mean, round(stddev_samp(n), 6) as stdev from n")
def list_stats(spark, sf_dir):
    n = V.items(spark, sf_dir).select(F.size("names").alias("n"))
    return n.agg(F.percentile("n", F.lit(0.5)).alias("median"), F.round(F.avg("n"), 6).alias("mean"), F.round(F.stddev_samp("n"), 6).alias("stdev"))


@query("face_summary", f"""with {V.BOXES}, g as (select item, count(*) as n_faces, max((b - t) / 800) as fh_ratio from box where score >= 0.3 and r - l <= 2.0 * (b - t) and b - t <= 2.0 * (r - l) group by item)
select o_orderkey as item, coalesce(n_faces, 0) as n_faces, coalesce(fh_ratio, 0) as fh_ratio from orders left join g on item = o_orderkey""")
def face_summary(spark, sf_dir):
    items = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("item"))
    return R.face_summary(V.boxes(spark, sf_dir), items, 0.3, 2.0, F.lit(800))


@query("min_detections", f"with {V.BOXES} select item, count(*) as n from box where score >= 0.5 group by item having count(*) >= 3")
def min_detections(spark, sf_dir):
    return R.min_detections(V.boxes(spark, sf_dir), 3, 0.5)


@query("face_range", f"with {V.BOXES}, n as (select item, count(*) as n from box group by item) select item, n from n where n between 2 and 4")
def face_range(spark, sf_dir):
    n = V.boxes(spark, sf_dir).groupBy("item").agg(F.count("*").alias("n"))
    return R.count_between(n, F.col("n"), 2, 4)


@query("min_size", f"with {V.BOXES} select item, det from box where least(r - l, b - t) >= 90")
def min_size(spark, sf_dir):
    return R.min_size(V.boxes(spark, sf_dir), F.col("r") - F.col("l"), F.col("b") - F.col("t"), 90).select("item", "det")


@query("first_face", f"with {V.BOXES}, g as (select *, row_number() over (partition by item order by det) as k from box where score > 0.2 and greatest(r - l, b - t) <= 2.0 * least(r - l, b - t)) select item, det, l, t, r, b from g where k = 1")
def first_face(spark, sf_dir):
    """Orders repeat line numbers: of lines of equal number the first one of the table counts."""
    place = ["file_path", "row_index"]
    return R.first_face(V.boxes(spark, sf_dir, *(f"_metadata.{c}" for c in place)), 0.2, 2.0, ties=place).select("item", "det", "l", "t", "r", "b")


_DIMS = "(floor(l_extendedprice)::int % 900 + 100)", "(l_partkey::int % 700 + 100)"


@query("resize_dims", f"""with d as (select l_orderkey, l_linenumber, {_DIMS[0]} as w, {_DIMS[1]} as h from lineitem), e as (select *, least(w, h) as s from d)
select l_orderkey, l_linenumber, case when s <= 256 then w when w = s then 256 else floor(w * 256 / s) end::int as w, case when s <= 256 then h when h = s then 256 else floor(h * 256 / s) end::int as h from e""")
def resize_dims(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.floor("l_extendedprice").cast("int") % 900 + 100).alias("w"), (F.col("l_partkey").cast("int") % 700 + 100).alias("h"))
    return d.select("l_orderkey", "l_linenumber", B.resize_dims(F.col("w"), F.col("h"), 256).alias("d")).select("l_orderkey", "l_linenumber", "d.w", "d.h")


@query("head_boxes", f"""with {V.BOXES} select item, det, floor(greatest((l + r) / 2 - (r - l) * 0.75, 0))::int as l, floor(greatest((t + b) / 2 - (b - t) * 0.75, 0))::int as t,
 floor(least((l + r) / 2 + (r - l) * 0.75, 1000))::int as r, floor(least((t + b) / 2 + (b - t) * 0.75, 800))::int as b from box""")
def head_boxes(spark, sf_dir):
    face = F.struct("l", "t", "r", "b")
    return V.boxes(spark, sf_dir).select("item", "det", B.head_box(face, F.lit(1000), F.lit(800)).alias("h")).select("item", "det", "h.*")


@query("square_crops", f"""with {V.BOXES} select item, det, least(greatest(floor((l + r) / 2 - 400), 0), 200)::int as l, 0 as t, least(greatest(floor((l + r) / 2 - 400), 0), 200)::int + 800 as r, 800 as b from box""")
def square_crops(spark, sf_dir):
    face = F.struct("l", "t", "r", "b")
    return V.boxes(spark, sf_dir).select("item", "det", B.square_crop(face, F.lit(1000), F.lit(800)).alias("h")).select("item", "det", "h.*")


@query("face_words", f"with {V.BOXES} select item, det, case when (l + r) / 2 / 1000 < 1.0::double / 3 then 'left' when (l + r) / 2 / 1000 < 2.0::double / 3 then 'middle' else 'right' end as place from box")
def face_words(spark, sf_dir):
    return V.boxes(spark, sf_dir).select("item", "det", B.face_word(F.struct("l", "t", "r", "b"), F.lit(1000)).alias("place"))


@query("v1_folders", f"with {V.BOXES} select item, det, 'face_height_ratio_' || (floor(least((b - t) / 800 * 100, 99.999) / 25) * 25)::int || '-' || ((floor(least((b - t) / 800 * 100, 99.999) / 25) * 25)::int + 25) as folder from box")
def v1_folders(spark, sf_dir):
    return V.boxes(spark, sf_dir).select("item", "det", B.ratio_bucket((F.col("b") - F.col("t")) / 800, 25).alias("folder"))


@query("crop_manifest", f"""with {V.BOXES} select 'i' || item || '_' || det || '.png' as child, 'i' || item || '.png' as parent, kind, r - l as w, b - t as h from box where score >= 0.3 and least(r - l, b - t) >= 40""")
def crop_manifest(spark, sf_dir):
    b = V.boxes(spark, sf_dir).where("score >= 0.3")
    kept = R.min_size(b, F.col("r") - F.col("l"), F.col("b") - F.col("t"), 40)
    return kept.select(
        F.concat(F.lit("i"), "item", F.lit("_"), "det", F.lit(".png")).alias("child"), F.concat(F.lit("i"), "item", F.lit(".png")).alias("parent"), "kind",
        (F.col("r") - F.col("l")).alias("w"), (F.col("b") - F.col("t")).alias("h"),
    )


@query("episode_first_submitter", """with r as (select p_name as title, p_partkey, p_size as ep, right(p_brand, 1)::int as submitter from part), k as (select * from r where ep between 5 and 40)
select title, p_partkey from k join (select title, min(submitter) as s from k group by 1) using (title) where submitter = s""")
def episode_first_submitter(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_name").alias("title"), "p_partkey", F.col("p_size").alias("ep"), F.substring("p_brand", -1, 1).cast("int").alias("s"))
    return R.first_submitter(rows, "title", F.col("s"), F.col("ep"), 5, 40).select("title", "p_partkey")


@query("portion_filter", "with m as (select l_shipdate::date as folder, l_orderkey as n, l_linenumber as k from lineitem), t as (select folder, max(n) // 3 as third from m group by 1) select folder::varchar as folder, n, k from m join t using (folder) where n <= third")
def portion_filter(spark, sf_dir):
    frames = table(spark, sf_dir, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("folder"), F.col("l_orderkey").alias("n"), F.col("l_linenumber").alias("k"))
    return R.portion(frames, "folder", "n", "first").select("folder", "n", "k")


@query("episode_numbers", "select p_partkey, (row_number() over (partition by p_brand order by p_name, p_partkey) - 1 + 10)::int as episode, p_brand || '_EP' || (row_number() over (partition by p_brand order by p_name, p_partkey) - 1 + 10) || '_' as prefix from part")
def episode_numbers(spark, sf_dir):
    from siftloom.sources.posts import number_episodes

    return number_episodes(table(spark, sf_dir, "part"), "p_brand", ["p_name", "p_partkey"], first=10).select("p_partkey", "episode", F.concat("p_brand", "prefix").alias("prefix"))


@query("fallback_names", "select doc_id, case when doc_id % 5 <> 0 then 'f' || doc_id || '.png' else 'untitled_' || source || '_' || (row_number() over (partition by source, doc_id % 5 <> 0 order by doc_id) - 1) || '.png' end as filename from documents")
def fallback_names(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("f"), "doc_id", F.lit(".png"))).alias("filename"))
    place = F.row_number().over(Window.partitionBy("source", F.col("filename").isNull()).orderBy("doc_id")) - 1
    return d.select("doc_id", F.coalesce("filename", F.concat(F.lit("untitled_"), "source", F.lit("_"), place, F.lit(".png"))).alias("filename"))


@query("sidecar_duplicates", "select c_name as name, count(*) as n from (select substr(c_name, 1, 15) as c_name from customer) group by 1 having count(*) > 1")
def sidecar_duplicates(spark, sf_dir):
    from siftloom.sources.posts import duplicate_names

    return duplicate_names(table(spark, sf_dir, "customer").select(F.substring("c_name", 1, 15).alias("name")), "name")


@query("relink_crops", f"with {V.BOXES} select item || '_' || det as crop, o_orderkey as source from box left join (select o_orderkey from orders where o_orderstatus <> 'P') on o_orderkey = item")
def relink_crops(spark, sf_dir):
    from siftloom.sources.posts import relink

    crops = V.boxes(spark, sf_dir).select(F.concat_ws("_", "item", "det").alias("crop"))
    sources = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").cast("string").alias("base"), F.col("o_orderkey").alias("source"))
    return relink(crops, sources)


@query("filename_semijoin", "select distinct c_custkey from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'P')")
def filename_semijoin(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return c.join(table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")


@query("aux_groups", "select l_orderkey || '' as base, string_agg(l_linenumber || '.' || l_linestatus, ';' order by l_linenumber, l_linestatus) as files from lineitem group by l_orderkey")
def aux_groups(spark, sf_dir):
    from siftloom.sources.posts import group_by_base

    files = table(spark, sf_dir, "lineitem").select(F.concat(F.col("l_orderkey"), F.lit("/"), "l_linenumber", F.lit("."), "l_linestatus").alias("path"))
    return group_by_base(files, F.substring_index("path", "/", 1), F.substring_index("path", "/", -1)).select("base", F.array_join("files", ";").alias("files"))


_NAMED = "regexp_replace({}, '<[^>]*>', '', 'g')"
_PAGE_LINKS = f"""x as (select page_id as page, unnest(regexp_extract_all(html, '<h1[^>]*>.*?</h1>|<li><a [^>]*>.*?</a>')) as t,
 unnest(range(len(regexp_extract_all(html, '<h1[^>]*>.*?</h1>|<li><a [^>]*>.*?</a>')))) as pos from pages),
l as (select page, pos, trim({_NAMED.format('t')}) as name, t like '<h1%' as h, regexp_matches(t, '^<li><a href="/[aeiou]') as deep from x),
r as (select *, last_value(case when h then name end ignore nulls) over (partition by page order by pos rows between unbounded preceding and 1 preceding) as under,
 max(h::int) over (partition by page order by pos rows between unbounded preceding and current row) as second,
 last_value(case when not h and not deep then name end ignore nulls) over (partition by page order by pos rows between unbounded preceding and 1 preceding) as prev from l)"""


@query("page_hierarchy", f"with {_PAGE_LINKS} select distinct page, case when h then '' else coalesce(under, '') end as parent, name as child, not h as is_tag from r where name <> ''")
def page_hierarchy(spark, sf_dir):
    return T.page_edges(table(spark, sf_dir, "pages"))


@query("page_nested_lists", f"""with {_PAGE_LINKS} select distinct page, case when h then '' when deep and second = 0 then coalesce(prev, '') else coalesce(under, '') end as parent, name as child, not h as is_tag from r where name <> ''""")
def page_nested_lists(spark, sf_dir):
    """Items whose address begins with a vowel as lists of their own within the list."""
    nested = F.regexp_replace("html", '(?s)<li>(<a href="/[aeiou][^>]*>.*?</a>)</li>', "<ul><li>$1</li></ul>")
    return T.page_edges(table(spark, sf_dir, "pages").select("page_id", nested.alias("html")))


_TREE = """e as (select distinct r_name as parent, n_name as child, n_nationkey % 3 = 0 as is_tag from nation join region on n_regionkey = r_regionkey
 union select distinct n_name, c_mktsegment, true from nation join customer on c_nationkey = n_nationkey
 union select distinct c_mktsegment, case when c_custkey % 2 = 0 then 'EVEN' else 'ODD' end, true from customer),
place(path, name, is_tag) as (select [r_name], r_name, false from region where r_name in (select parent from e)
 union all select list_append(p.path, e.child), e.child, e.is_tag from place p join e on e.parent = p.name),
q as (select distinct [n_name] as query from nation union select [n_name, 'BUILDING'] from nation union select [n_name, 'BUILDING', 'ODD'] from nation union select ['ODD'] union select ['NOWHERE'] union select distinct [r_name, 'CHINA'] from region),
n as (select name, count(*) as places, min(path) as start from place group by name),
w as (select query, places, list_concat(start, query[2:]) as wanted from q left join n on n.name = query[1]),
f as (select query, case when places > 1 then 'ambiguous' when wanted in (select path from place) then 'found' else 'missing' end as outcome, wanted from w)"""


def _places(spark, sf_dir):
    """Regions, nations, segments and parities as a tree in which most names stand in many places, and questions to it."""
    n, r, c = (table(spark, sf_dir, t) for t in ("nation", "region", "customer"))
    edges = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("r_name").alias("parent"), F.col("n_name").alias("child"), (F.col("n_nationkey") % 3 == 0).alias("is_tag"))
    edges = edges.union(c.join(n, c.c_nationkey == n.n_nationkey).select("n_name", "c_mktsegment", F.lit(True)))
    edges = edges.union(c.select("c_mktsegment", F.when(F.col("c_custkey") % 2 == 0, "EVEN").otherwise("ODD"), F.lit(True))).distinct()
    asked = [F.array("n_name"), F.array("n_name", F.lit("BUILDING")), F.array("n_name", F.lit("BUILDING"), F.lit("ODD")), F.array(F.lit("ODD")), F.array(F.lit("NOWHERE"))]
    queries = n.select(F.explode(F.array(*asked)).alias("query")).union(r.select(F.array("r_name", F.lit("CHINA")))).distinct()
    places = T.tree_paths(edges)
    return places, T.resolve(places, queries)


@query("tree_lookup", f"with recursive {_TREE} select array_to_string(query, '/') as query, outcome, case when outcome = 'found' then array_to_string(wanted, '/') end as path from f")
def tree_lookup(spark, sf_dir):
    found = _places(spark, sf_dir)[1]
    return found.select(F.array_join("query", "/").alias("query"), "outcome", F.array_join("path", "/").alias("path"))


@query("tree_tags", f"""with recursive {_TREE} select array_to_string(query, '/') as query, name as tag, count(*) as n from f join place on outcome = 'found' and path[:len(wanted)] = wanted where is_tag group by all""")
def tree_tags(spark, sf_dir):
    places, found = _places(spark, sf_dir)
    return T.tags_below(places, found).groupBy(F.array_join("query", "/").alias("query"), "tag").agg(F.count("*").alias("n"))


@query("tree_groups", f"""with recursive {_TREE} select array_to_string(query, '/') as query, unnest(list_reverse(wanted)) as group, unnest(range(len(wanted)))::int as up from f where outcome = 'found'""")
def tree_groups(spark, sf_dir):
    return T.groups_above(_places(spark, sf_dir)[1]).select(F.array_join("query", "/").alias("query"), "group", "up")


def _geography(spark, sf_dir):
    """Regions, nations and segments as a tag tree."""
    f = V.folders(spark, sf_dir).select(F.split("path", "/").alias("p"))
    a = f.select(F.get("p", F.lit(0)).alias("parent"), F.get("p", F.lit(1)).alias("child"), F.lit(False).alias("is_tag"))
    return a.union(f.select(F.get("p", F.lit(1)), F.get("p", F.lit(2)), F.lit(True))).distinct()


@query("tree_descendants", "select n_name as child, 1 as depth from nation join region on n_regionkey = r_regionkey where r_name = 'ASIA' and n_nationkey in (select c_nationkey from customer) union select distinct c_mktsegment, 2 from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey where r_name = 'ASIA'")
def tree_descendants(spark, sf_dir):
    return T.descendants(_geography(spark, sf_dir), "ASIA")


@query("tree_ancestors", "select distinct n_name as parent, 1 as depth from customer join nation on c_nationkey = n_nationkey where c_mktsegment = 'BUILDING' union select distinct r_name, 2 from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey where c_mktsegment = 'BUILDING'")
def tree_ancestors(spark, sf_dir):
    return T.ancestors(_geography(spark, sf_dir), "BUILDING")


@query("nested_json_edges", "select null as parent, r_name as child, false as is_tag from region union select r_name, n_name, true from nation join region on n_regionkey = r_regionkey union select null, r_name, true from region")
def nested_json_edges(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = r.join(n, n.n_regionkey == r.r_regionkey)
    per = joined.groupBy("r_name").agg(F.map_from_entries(F.collect_list(F.struct("n_name", "n_name"))).alias("m"))
    docs = per.select(F.to_json(F.create_map("r_name", F.map_concat("m", F.create_map(F.lit("self"), F.col("r_name"))))).alias("doc"))
    edges = T.json_edges(docs)
    own = edges.select(F.when(F.col("parent").isNull(), F.lit(None)).otherwise(F.col("parent")).cast("string").alias("parent"), "child", "is_tag")
    return own


@query("output_meta", f"with {V.ITEMS} select item_id, regexp_replace(item_id || '.webp', '\\.[^.]*$', '.png') as filename, 'train' as type from item")
def output_meta(spark, sf_dir):
    from siftloom.sources.posts import output_metadata

    return output_metadata(V.items(spark, sf_dir).select("item_id", F.concat("item_id", F.lit(".webp")).alias("filename")), "train", "png")

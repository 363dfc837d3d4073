"""Queries of whole jobs: tags and captions in every mode, selection of a data set, classification, import of metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftloom.operators import jobs as J
from siftloom.operators.classify import Thresholds, classify
from siftloom.plans import views as V
from siftloom.plans.items import BLACKLIST, PARTNERS
from siftloom.plans.vectors import refs, vectors
from siftloom.session import table

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


RULES = J.TagRules(tuple(BLACKLIST), PARTNERS, ("es",), ("ing", "es", "tion"), ("th",), ("tion", "les"), ())
FREQUENCY, MOST = 0.3, 40
_B = "[" + ", ".join(f"'{t}'" for t in BLACKLIST) + "]"
_P = ", ".join(f"('{k}', '{v}')" for k, vs in PARTNERS.items() for v in vs)
_DROPS = "(tag <> 'es' and (tag in ('ing', 'ings', 'e', 'eses', 'tion', 'tions', 'th')))"
_STARTS = "tag in ('tion', 'tions', 'les', 'le', 'leses')"
# words hold neither spaces nor underscores; a third of the items begins at processed tags, the first half of its words
_START = f"""{V.ITEMS}, pair(q, o) as (values {_P}),
src as (select t.doc_id, t.tag, t.pos from tag t join (select doc_id, count(*) as n from tag group by doc_id) using (doc_id) where doc_id % 3 <> 2 or pos < (n + 1) // 2),
b as (select * from src where not list_contains({_B}, tag) and not list_contains({_B}, replace(tag, '_', ' '))),
gone as (select distinct a.doc_id, a.tag from b a join pair on replace(a.tag, ' ', '_') = q join b c on a.doc_id = c.doc_id and replace(c.tag, ' ', '_') = o),
part as (select distinct a.doc_id, a.tag from b a join b c on a.doc_id = c.doc_id and a.tag <> c.tag and contains(c.tag, a.tag)),
low as (select b.* from b left join gone using (doc_id, tag) left join part using (doc_id, tag) where gone.doc_id is null and part.doc_id is null)"""
_OUT = """sorted as (select doc_id, tag, case when core then 1 else 0 end as late, row_number() over (partition by doc_id order by core,
 case when tag = 'solo' then 0 when contains(tag, 'girls') or contains(tag, 'boys') or tag in ('1girl', '1boy') then 1 else 2 end, pos) as k from marked),
named as (select item.doc_id, item_id, type, rating, {shown} as shown from item {join})
select item_id, concat_ws(', ', nullif(array_to_string(shown, ' and '), ''), type, case when rating = 'e' then 'explicit' end, nullif(coalesce(tags, ''), '')) as caption, coalesce(dropped, 0) as n_dropped
 from named left join (select doc_id, string_agg(tag, ', ' order by k) filter (where k <= 40) as tags, count(*) filter (where late = 1) as dropped from sorted group by doc_id) using (doc_id)"""


def _captioned(spark, sf_dir, mode):
    names = F.filter("tags", lambda t, i: i < F.floor((F.size("tags") + 1) / 2))
    items = V.items(spark, sf_dir).withColumn("processed_tags", F.when(F.col("doc_id") % 3 == 2, names))
    out, core = J.tag_and_caption(items, RULES, mode, append_dropped=True, most=MOST, frequency=FREQUENCY)
    return out.select("item_id", "caption", F.coalesce(F.size("dropped_character_tags"), F.lit(0)).cast("long").alias("n_dropped")), core


@query("caption_job_none", f"with {_START}, marked as (select *, false as core from src), {_OUT.format(shown='characters', join='')}")
def caption_job_none(spark, sf_dir):
    return _captioned(spark, sf_dir, "none")[0].withColumn("n_dropped", F.greatest("n_dropped", F.lit(0)).cast("long"))


@query("caption_job_minimal", f"with {_START}, marked as (select *, false as core from low), {_OUT.format(shown='characters', join='')}")
def caption_job_minimal(spark, sf_dir):
    return _captioned(spark, sf_dir, "minimal")[0].withColumn("n_dropped", F.greatest("n_dropped", F.lit(0)).cast("long"))


@query("caption_job_character", f"with {_START}, marked as (select low.*, len(characters) > 0 and {_DROPS} as core from low join item using (doc_id)), {_OUT.format(shown='characters', join='')}")
def caption_job_character(spark, sf_dir):
    return _captioned(spark, sf_dir, "character")[0].withColumn("n_dropped", F.greatest("n_dropped", F.lit(0)).cast("long"))


_STOP_SQL = "not list_has_any(string_split_regex(tag, '[\\W_]+'), {})"


def _core_sql() -> str:
    from siftloom.plans.items import _stop

    return f"""{_START}, single as (select characters[1] as character, doc_id from item where len(characters) = 1 and doc_id in (select doc_id from src)),
total as (select character, count(*) as n_items from single group by character),
core as (select character, tag, count(*) as n from single join low using (doc_id) join total using (character) group by character, tag
 having count(*) >= {FREQUENCY} * any_value(n_items) and {_STOP_SQL.format(_stop)}),
flag as (select character, tag, split_part(character, '|', 1) as e, {_DROPS} as dropped, {_STARTS} as init from core),
form as (select e, count(distinct character) as forms from flag group by e),
shared as (select e, tag from flag join form using (e) where init group by e, tag having count(distinct character) = any_value(forms)),
cat as (select character, f.tag, not dropped and s.tag is null as kept, dropped, init and s.tag is not null as emb_init from flag f left join shared s on f.e = s.e and f.tag = s.tag),
mine as (select distinct doc_id, tag from (select doc_id, unnest(characters) as character from item) join cat using (character) where dropped or emb_init),
marked as (select low.*, mine.tag is not null as core from low left join mine using (doc_id, tag))"""


@query("caption_job_core", f"with {_core_sql()}, {_OUT.format(shown='list_filter(characters, lambda x: list_contains(have, x))', join='cross join (select coalesce(list(distinct character), []) as have from core)')}")
def caption_job_core(spark, sf_dir):
    return _captioned(spark, sf_dir, "character_core")[0].withColumn("n_dropped", F.greatest("n_dropped", F.lit(0)).cast("long"))


@query("caption_job_core_tags", f"with {_core_sql()} select * from cat")
def caption_job_core_tags(spark, sf_dir):
    return _captioned(spark, sf_dir, "character_core")[1]


_SELECT = """c as (select 'o' || l_orderkey || '/c' || l_linenumber || '_' || l_partkey || '.png' as id, 'o' || l_orderkey || '.png' as parent, l_linenumber as ord,
 case l_partkey % 5 when 0 then null when 1 then 'ann' when 2 then 'bob' else 'cy|' || (l_partkey % 2) end as ch, 20 + l_quantity::int * 12 as w, 30 + l_suppkey::int % 400 as h from lineitem),
o as (select 'o' || o_orderkey || '.png' as id, case when o_custkey % 3 = 0 then ['cy', 'dee'] else [] end as chs, 400 + o_custkey % 300 as w, 300 + o_custkey % 200 as h from orders),
n as (select parent, list(ch order by ord, ch) as new from c where ch is not null group by parent),
p as (select o.id, w, h, case when new is null then [] else list_distinct_ordered end as chs from o left join (select parent, new,
 list_transform(list_filter(list_zip(new, range(len(new))), lambda x: list_position(new, x[1]) = x[2] + 1), lambda x: x[1]) as list_distinct_ordered from n) m on m.parent = o.id),
s as (select c.*, coalesce(c.w * c.h > 0.5 * p.w * p.h, false) as large from c left join p on p.id = c.parent),
e as (select case when large then parent else id end as id, 0 as rank from s where ch is not null union all select id, 2 from s where ch is null union all select id, case when len(chs) > 0 then 1 else 2 end from p),
u as (select id, min(rank) as rank from e group by id),
a as (select id, case when ch is null then [] else [ch] end as chs, w, h from c where id not in (select id from p) union all select id, chs, w, h from p)
select u.id as item_id, ['classified', 'raw'][rank + 1] as folder, replace(regexp_extract(u.id, '[^/]*$'), '.png', '.webp') as filename, 'set' as type, array_to_string(chs, ';') as characters,
 (case when least(w, h) <= 256 then w when w <= h then 256 else floor(w * 256 / h) end)::int as w, (case when least(w, h) <= 256 then h when h < w then 256 when w = h then 256 else floor(h * 256 / w) end)::int as h
from u join a using (id) where rank < 2"""


@query("selection_job", f"with {_SELECT}")
def selection_job(spark, sf_dir):
    """Lines of orders as crops of their order's image; images without characters are left out."""
    line, order = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    part = F.col("l_partkey") % 5
    name = F.when(part == 0, "0_noise").when(part == 1, "1_ann").when(part == 2, "2_bob").otherwise(F.concat(F.lit("3_cy|"), F.col("l_partkey") % 2))
    parent = F.concat(F.lit("o"), "l_orderkey", F.lit(".png"))
    item = F.concat(F.lit("o"), "l_orderkey", F.lit("/c"), "l_linenumber", F.lit("_"), "l_partkey", F.lit(".png"))
    crops = line.select(item.alias("item_id"), parent.alias("parent_id"), F.col("l_linenumber").alias("ord"), name.alias("class"), (20 + F.col("l_quantity").cast("int") * 12).alias("w"), (30 + F.col("l_suppkey").cast("int") % 400).alias("h"))
    own = F.when(F.col("o_custkey") % 3 == 0, F.array(F.lit("cy"), F.lit("dee"))).otherwise(F.array().cast("array<string>"))
    originals = order.select(F.concat(F.lit("o"), "o_orderkey", F.lit(".png")).alias("item_id"), own.alias("characters"), (400 + F.col("o_custkey") % 300).alias("w"), (300 + F.col("o_custkey") % 200).alias("h"))
    out = J.select_images(crops, originals, "set", largest=256, ending="webp")
    return out.withColumn("characters", F.array_join("characters", ";"))


@query("classification_job")
def classification_job(spark, sf_dir):
    """The whole classification of embeddings with references and partly known labels."""
    e = table(spark, sf_dir, "embeddings")
    known = e.where("vec_id % 3 = 0").select(F.col("vec_id").alias("item"), F.concat(F.lit("c"), "label").alias("character"))
    r = refs(spark, sf_dir).select("ref", "vec", F.concat(F.lit("c"), F.col("ref_label"), F.when(F.col("ref_label") % 4 == 0, "|x").otherwise("")).alias("character"))
    items, _, _ = classify(vectors(spark, sf_dir), Thresholds(same=0.72, reach=0.7, merge=0.2, share=0.1, count=4), known, r, keep_unnamed=True)
    return items

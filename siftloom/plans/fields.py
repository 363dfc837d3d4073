"""Queries over fields of items, merged characters, pruned tags and reports."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from siftloom.functions import tags as G
from siftloom.operators import fields as O
from siftloom.plans import views as V
from siftloom.plans.items import BLACKLIST, PARTNERS
from siftloom.session import table
from siftloom.sources import files

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


_B = "[" + ", ".join(f"'{t}'" for t in BLACKLIST) + "]"
_P = ", ".join(f"('{k}', '{v}')" for k, vs in PARTNERS.items() for v in vs)


@query("prune_character", f"""with {V.ITEMS}, pair(q, o) as (values {_P}),
t as (select * from tag where not list_contains({_B}, tag) and not list_contains({_B}, replace(tag, ' ', '_')) and not list_contains({_B}, replace(tag, '_', ' '))),
gone as (select distinct a.doc_id, a.tag from t a join pair on a.tag = q join t b on a.doc_id = b.doc_id and b.tag = o),
part as (select distinct a.doc_id, a.tag from t a join t b on a.doc_id = b.doc_id and a.tag <> b.tag and contains(b.tag, a.tag)),
x as (select t.*, t.tag in ('ing', 'ings', 'es', 'e', 'eses') as core from t left join gone using (doc_id, tag) left join part using (doc_id, tag) where gone.doc_id is null and part.doc_id is null)
select item.item_id, coalesce(string_agg(tag, ' ' order by pos) filter (where not core or len(characters) = 0), '') as kept,
 case when any_value(len(characters)) > 0 then coalesce(string_agg(tag, ' ' order by pos) filter (where core), '') end as dropped from item left join x using (doc_id) group by item.item_id""")
def prune_character(spark, sf_dir):
    partners = F.create_map(*[x for k, vs in PARTNERS.items() for x in (F.lit(k), F.array(*map(F.lit, vs)))])
    listed = F.array(*map(F.lit, BLACKLIST))
    pruned = O.prune_tags(F.col("tags"), F.col("characters"), "character", listed, partners, lambda t: G.is_character_tag(t, [], ["ing", "es"], []))
    names = lambda c: F.array_join(F.transform(c, lambda t: t["tag"]), " ")
    return V.items(spark, sf_dir).select("item_id", pruned.alias("p")).select("item_id", names("p.kept").alias("kept"), names("p.dropped").alias("dropped"))


@query("v1_tag_filter", rf"""with {V.ITEMS}, n as (select doc_id, item_id, pos, tag || ['_hair', ' eyes', 'girls', '', ''][length(tag) % 5 + 1] as tag from tag),
k as (select *, regexp_matches(tag, 'boy|girl|solo') as people from n),
x as (select * from k where people or case when regexp_matches(tag, 'hair|ponytail|twintail|braid|bun|bangs|ahoge') then false when contains(tag, 'eyes') then true when tag in ('es', 'ing') then false else tag <> 'parody' end)
select item.item_id, coalesce(string_agg(tag, ' ' order by people desc, pos), '') as tags from item left join x using (doc_id) group by item.item_id""")
def v1_tag_filter(spark, sf_dir):
    """Words given the endings of tag families by their length, then filtered."""
    ends = F.array(*map(F.lit, ("_hair", " eyes", "girls", "", "")))
    tags = F.transform("names", lambda w: F.concat(w, F.element_at(ends, (F.length(w) % 5 + 1).cast("int"))))
    kept = O.filter_v1(tags, F.array(F.lit("es"), F.lit("ing")), F.lit(True), drop_hair=True, drop_outfit=True)
    return V.items(spark, sf_dir).select("item_id", F.array_join(kept, " ").alias("tags"))


def _old_items(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    image = F.concat(F.lit("/old/"), F.coalesce("source", F.lit("none")), F.lit("_x/"), F.col("doc_id"), F.lit(".png"))
    return docs.select("doc_id", F.array("source", "lang").alias("character"), F.col("lang").alias("general"), image.alias("image"))


@query("legacy_fields", """select doc_id, concat_ws('+', source, lang) as characters, lang as type, '/old/' || coalesce(source, 'none') || '_x/' || doc_id || '.png' as path,
 '/old/' || coalesce(source, 'none') || '_x/' || doc_id || '.png' as current_path, doc_id || '.png' as filename from documents""")
def legacy_fields(spark, sf_dir):
    return O.legacy_fields(_old_items(spark, sf_dir)).withColumn("characters", F.array_join("characters", "+"))


@query("descriptions", "select doc_id, coalesce(lang, '') || ' ' || replace(coalesce(source, 'none') || '_x', '_', ' ') as general from documents")
def descriptions(spark, sf_dir):
    return _old_items(spark, sf_dir).select("doc_id", O.description(F.col("general"), F.col("image"), from_folder=True).alias("general"))


@query("refined_outfits", """select doc_id, coalesce(source, 'none') || ',' || coalesce(lang, 'plain') || ';' || coalesce(lang, 'plain') as characters from documents""")
def refined_outfits(spark, sf_dir):
    source, lang = F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("plain"))
    new = F.array(F.concat(source, F.lit(",first")), F.concat(source, F.lit(","), lang))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(O.refine_characters(F.array(source, lang), new), ";").alias("characters"))


def _catalogues(spark, sf_dir):
    """Regions and nations with a supplier are known characters, all nations the references."""
    nation, region, supplier = (table(spark, sf_dir, t) for t in ("nation", "region", "supplier"))
    forms = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", F.concat_ws("|", "r_name", "n_name").alias("character"))
    first = supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg((F.min("s_suppkey") + 5).cast("long").alias("label"))
    known = region.select(F.col("r_regionkey").cast("long").alias("label"), F.col("r_name").alias("character")).unionByName(forms.join(first, "n_nationkey").select("label", "character"))
    return known, forms.select(F.col("n_nationkey").cast("long").alias("label"), "character")


_MERGED = """form as (select n_nationkey::bigint as ref_label, r_name || '|' || n_name as character from nation join region on n_regionkey = r_regionkey),
known as (select r_regionkey::bigint as label, r_name as character from region union all
 select min(s_suppkey)::bigint + 5, character from supplier join form on s_nationkey = ref_label group by character),
fresh as (select (select max(label) from known) + row_number() over (order by ref_label) as label, character, ref_label from form where character not in (select character from known)),
merged as (select label, character, ref_label from known left join form using (character) union all select label, character, ref_label from fresh)"""


@query("merged_references", f"with {_MERGED} select label, character, ref_label from merged")
def merged_references(spark, sf_dir):
    return O.merge_references(*_catalogues(spark, sf_dir))


@query("inherited_presence", f"""with {_MERGED}, present as (select c_custkey as item, n_regionkey::bigint as label from customer join nation on c_nationkey = n_nationkey)
select item, label from present union
select item, fresh.label from present join known using (label) join fresh on split_part(fresh.character, '|', 1) = split_part(known.character, '|', 1)""")
def inherited_presence(spark, sf_dir):
    known, references = _catalogues(spark, sf_dir)
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    present = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(F.col("c_custkey").alias("item"), F.col("n_regionkey").cast("long").alias("label"))
    return O.inherit_presence(present, known, O.merge_references(known, references))


@query("tag_report", f"with {V.ITEMS} select tag || ': ' || count(*) as line from tag group by tag")
def tag_report(spark, sf_dir):
    tags = V.items(spark, sf_dir).select(F.explode("names").alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))
    return files.tag_report(tags)


@query("reference_labels", """with f as (select case when c_acctbal < 0 then '/refs/' || c_mktsegment || '_' || c_custkey || '.png'
  else '/refs/' || r_name || '/' || n_name || '/' || c_custkey || '.png' end as path, case when c_acctbal < 0 then c_mktsegment else r_name || '|' || n_name end as name
 from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
l as (select name, row_number() over (order by min(path)) - 1 as label from f group by name) select path, name, label from f join l using (name)""")
def reference_labels(spark, sf_dir):
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    joined = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    file = F.concat(F.col("c_custkey"), F.lit(".png"))
    path = F.when(F.col("c_acctbal") < 0, F.concat(F.lit("/refs/"), "c_mktsegment", F.lit("_"), file)).otherwise(F.concat_ws("/", F.lit("/refs"), "r_name", "n_name", file))
    return files.reference_labels(joined.select(path.alias("path")), "/refs").withColumn("label", F.col("label").cast("long"))


@query("init_texts", "select p_partkey, case when p_size > 1 then p_name || ' ' else '' end || '*[0.017, 10]' as init from part")
def init_texts(spark, sf_dir):
    words = F.when(F.col("p_size") > 1, F.split("p_name", " ")).otherwise(F.array().cast("array<string>"))
    return table(spark, sf_dir, "part").select("p_partkey", O.init_text(words).alias("init"))


@query("scored_batches", "select vec_id, round(list_sum(list_transform(embedding[1:8], lambda x: x::double)), 4) as score from embeddings")
def scored_batches(spark, sf_dir):
    """A scoring function loaded once in each task and fed whole batches; here a sum of the first eight numbers."""

    def make():
        def model(batch: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"vec_id": batch["vec_id"], "score": [float(v[:8].astype("float64").sum()) for v in batch["embedding"]]})

        return model

    rows = files.score_batches(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), make, "vec_id long, score double")
    return rows.select("vec_id", F.round("score", 4).alias("score"))

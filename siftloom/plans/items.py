"""Tag, caption and core-tag queries over documents seen as items."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftloom.functions import captions as C
from siftloom.functions import tags as G
from siftloom.operators import coretags as K
from siftloom.plans import views as V
from siftloom.plans.names import names_sql

QUERIES, SQL = {}, {}

BLACKLIST = ["the", "of", "der", "la_de", "und", "que", "a", "et"]
PARTNERS = {"and": ["the", "is"], "en": ["de"], "der": ["die", "und"], "on": ["in"], "la": ["le", "les"]}
SUFFIXES, PREFIXES, WHITELIST = ["tion", "heit", "de"], ["th", "le"], ["de", "le"]


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@query("tag_frequency", f"with {V.ITEMS} select tag, count(*) as n from tag group by tag")
def tag_frequency(spark, sf_dir):
    return K.tag_frequency(V.items(spark, sf_dir), F.col("names"))


_stop = "[" + ", ".join(f"'{w}'" for w in G.CORE_STOP_WORDS) + "]"
CORE = f"""{V.ITEMS},
single as (select characters[1] as character, doc_id from item where len(characters) = 1),
total as (select character, count(*) as n_items from single group by character),
core as (select character, tag, count(*) as n, any_value(n_items) as n_items from single join tag using (doc_id) join total using (character)
    group by character, tag having count(*) >= 0.3 * any_value(n_items) and not list_has_any(string_split_regex(tag, '[\\W_]+'), {_stop}))"""


@query("core_tags", f"with {CORE} select * from core")
def core_tags(spark, sf_dir):
    return K.core_tags(V.items(spark, sf_dir).select("item_id", "characters", F.col("names").alias("tags")), 0.3)


_CATEGORIES = f"""{CORE},
flag as (select character, tag, substr(character, 1, 4) as e, length(tag) <= 2 as dropped, length(tag) <= 3 as init from core),
form as (select e, count(distinct character) as forms from flag group by e),
shared as (select e, tag from flag join form using (e) where init group by e, tag having count(distinct character) = any_value(forms)),
cat as (select character, f.tag, not dropped and s.tag is null as kept, dropped, init and s.tag is not null as emb_init from flag f left join shared s on f.e = s.e and f.tag = s.tag)"""


def _categories(spark, sf_dir):
    core = core_tags(spark, sf_dir)
    return K.categories(core, F.length("tag") <= 2, F.length("tag") <= 3, F.substring("character", 1, 4))


@query("core_tag_categories", f"with {_CATEGORIES} select * from cat")
def core_tag_categories(spark, sf_dir):
    return _categories(spark, sf_dir)


@query("drop_core_tags", f"""with {_CATEGORIES}, drops as (select character, tag from cat where dropped or emb_init),
mine as (select distinct doc_id, tag from (select doc_id, unnest(characters) as character from item) join drops using (character))
select item.item_id, coalesce(count(tag.tag) filter (where mine.tag is null), 0) as n_left, coalesce(string_agg(tag.tag, ' ' order by pos) filter (where mine.tag is null), '') as tags
from item left join tag using (doc_id) left join mine on mine.doc_id = item.doc_id and mine.tag = tag.tag group by item.item_id""")
def drop_core_tags(spark, sf_dir):
    items = V.items(spark, sf_dir).select("item_id", "characters", F.col("names").alias("tags"))
    drops = _categories(spark, sf_dir).where("dropped or emb_init").select("character", "tag")
    return K.drop_core_tags(items, drops).select("item_id", F.size("tags").cast("long").alias("n_left"), F.array_join("tags", " ").alias("tags"))


@query("unknown_characters", f"with {CORE} select distinct character from (select unnest(characters) as character from item) where character not in (select character from core)")
def unknown_characters(spark, sf_dir):
    return K.unknown_characters(V.items(spark, sf_dir), core_tags(spark, sf_dir))


def _joined(tags):
    return F.array_join(F.transform(tags, lambda t: t["tag"]), " ")


_B = "[" + ", ".join(f"'{x}'" for x in BLACKLIST) + "]"


@query("blacklist_prune", f"""with {V.ITEMS} select item.item_id, coalesce(string_agg(tag, ' ' order by pos), '') as tags from item
left join (select * from tag where not list_contains({_B}, tag) and not list_contains({_B}, replace(tag, ' ', '_')) and not list_contains({_B}, replace(tag, '_', ' '))) x using (doc_id) group by item.item_id""")
def blacklist_prune(spark, sf_dir):
    listed = F.array(*map(F.lit, BLACKLIST))
    return V.items(spark, sf_dir).select("item_id", _joined(G.drop_blacklisted(F.col("tags"), listed)).alias("tags"))


_P = ", ".join(f"('{k}', '{v}')" for k, vs in PARTNERS.items() for v in vs)


@query("overlap_prune", f"""with {V.ITEMS}, pair(q, o) as (values {_P}),
gone as (select distinct a.doc_id, a.tag from tag a join pair on a.tag = q join tag b on a.doc_id = b.doc_id and b.tag = o),
part as (select distinct a.doc_id, a.tag from tag a join tag b on a.doc_id = b.doc_id and a.tag <> b.tag and contains(b.tag, a.tag))
select item.item_id, coalesce(string_agg(x.tag, ' ' order by pos), '') as tags from item left join
 (select tag.* from tag left join gone using (doc_id, tag) left join part using (doc_id, tag) where gone.doc_id is null and part.doc_id is null) x using (doc_id) group by item.item_id""")
def overlap_prune(spark, sf_dir):
    partners = F.create_map(*[x for k, vs in PARTNERS.items() for x in (F.lit(k), F.array(*map(F.lit, vs)))])
    return V.items(spark, sf_dir).select("item_id", _joined(G.drop_overlap(F.col("tags"), partners)).alias("tags"))


@query("sort_truncate_tags", f"""with {V.ITEMS}, s as (select *, row_number() over (partition by doc_id order by
 case when tag = 'solo' then 0 when contains(tag, 'girls') or contains(tag, 'boys') or tag in ('1girl', '1boy') then 1 else 2 end, pos) as k from tag)
select item.item_id, coalesce(string_agg(tag, ' ' order by k) filter (where k <= 25), '') as tags from item left join s using (doc_id) group by item.item_id""")
def sort_truncate_tags(spark, sf_dir):
    return V.items(spark, sf_dir).select("item_id", _joined(G.append_and_truncate(G.sort_tags(F.col("tags"), "score"), None, 25)).alias("tags"))


@query("reverse_score_tags", f"""with {V.ITEMS} select item.item_id, coalesce(string_agg(tag, ' ' order by pos desc), '') as tags from item left join tag using (doc_id) group by item.item_id""")
def reverse_score_tags(spark, sf_dir):
    """Scores that rise along the list turn it round."""
    turned = F.transform("tags", lambda t: F.struct(t["tag"].alias("tag"), (-t["score"]).alias("score")))
    return V.items(spark, sf_dir).select("item_id", _joined(G.sort_tags(turned, "score")).alias("tags"))


@query("captions", f"""with {V.ITEMS}, t as (select doc_id, string_agg(tag, ', ' order by pos) as tags from tag where tag not in ({", ".join(f"'{x}'" for x in BLACKLIST)}) group by doc_id)
select item_id, concat_ws(', ', case when len(characters) = 1 then '1person' else len(characters) || 'people' end, nullif(array_to_string(characters, ' and '), ''),
 type, case when rating = 'e' then 'explicit' end, case when doc_id % 4 <> 0 then 'part cropped' end, nullif(tags, '')) as caption from item left join t using (doc_id)""")
def captions(spark, sf_dir):
    """Captions of all items after pruning."""
    items = V.items(spark, sf_dir)
    pruned = G.sort_tags(G.drop_blacklisted(G.remove_underscore(F.col("tags")), F.array(*map(F.lit, BLACKLIST))), "score")
    parts = {
        "npeople": C.part_npeople(F.size("characters")), "characters": C.part_characters(F.col("characters"), " and "), "type": F.col("type"),
        "rating": C.part_rating(F.col("rating")), "crop": C.part_crop(F.lit("part"), F.col("doc_id") % 4 != 0), "tags": C.part_tags(pruned, ", "),
    }
    return items.select("item_id", C.caption(parts, F.col("item_id")).alias("caption"))


@query("rating_filter", f"with {V.ITEMS} select item_id, rating, case when rating in ('s', 'g') then 'safe' else 'r18' end as mapped from item where rating in ('s', 'g') or rating = 'q'")
def rating_filter(spark, sf_dir):
    from siftloom.operators.filters import rating_filter as allow

    return allow(V.items(spark, sf_dir), ["safe", "q"]).select("item_id", "rating", "mapped")


@query("class_filter", f"with {V.ITEMS} select item_id, type from item where type in ('en', 'fr')")
def class_filter(spark, sf_dir):
    return V.items(spark, sf_dir).where(F.col("type").isin("en", "fr")).select("item_id", "type")


@query("rename_map", f"""with {V.ITEMS} select item_id, array_to_string(list_transform(characters, lambda x: case x when 'src0' then 'first' when 'en|src0' then 'first en' else x end), ';') as characters from item""")
def rename_map(spark, sf_dir):
    mapping = F.create_map(*map(F.lit, ("src0", "first", "en|src0", "first en", "src1", "")))
    return V.items(spark, sf_dir).select("item_id", F.array_join(G.rename_values(F.col("characters"), mapping), ";").alias("characters"))


@query("character_tags", f"""with {V.ITEMS} select tag, count(*) as n from tag where tag not in ('de', 'le')
 and (regexp_extract(tag, '[^_]*$') in ('tion', 'tions', 'heit', 'heits', 'de', 'des') or string_split(tag, '_')[1] in ('th', 'le')) group by tag""")
def character_tags(spark, sf_dir):
    found = K.tag_frequency(V.items(spark, sf_dir), F.col("names"))
    return found.where(G.is_character_tag(F.col("tag"), WHITELIST, SUFFIXES, PREFIXES))


@query("n_people", f"""with {V.ITEMS}, p as (select item_id, (doc_id % 8)::int as g, (doc_id % 3)::int as b from item)
select item_id, case when g + b >= 6 then 'many' else (g + b)::varchar end as n_people from p""")
def n_people(spark, sf_dir):
    girls, boys = F.col("doc_id") % 8, F.col("doc_id") % 3
    names = F.concat(F.col("names"), F.array(F.concat(girls, F.lit("girls")), F.lit("0girl"), F.concat(boys, F.when(boys == 1, "boy").otherwise("boys"))))
    return V.items(spark, sf_dir).select("item_id", G.n_people(names).alias("n_people"))


@query("v1_tags", f"""with {V.ITEMS}, f as (select doc_id, min(pos) as pos from tag where tag in ('the', 'der', 'de') group by doc_id)
select item.item_id, coalesce(string_agg(tag, ' ' order by tag.pos) filter (where tag.pos >= coalesce(f.pos, 0)), '') as tags from item left join tag using (doc_id) left join f using (doc_id) group by item.item_id""")
def v1_tags(spark, sf_dir):
    return V.items(spark, sf_dir).select("item_id", F.array_join(G.drop_before(F.col("names"), ["the", "der", "de"]), " ").alias("tags"))


@query("tag_source", f"""with {V.ITEMS} select item_id, case when doc_id % 2 = 0 then 'processed' else 'original' end as source from item""")
def tag_source(spark, sf_dir):
    processed = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("processed")))
    return V.items(spark, sf_dir).select("item_id", F.get(G.tag_source(F.array(F.lit("original")), processed, False, False), F.lit(0)).alias("source"))


@query("arrange_paths", f"""with {V.ITEMS}, b as (select item_id, type, list_sort(list_distinct(list_transform(characters, lambda c: string_split(c, '|')[1]))) as names from item),
f as (select *, case when len(names) = 0 then 'character_others' else array_to_string(names, '+') end as folder from b),
g as (select *, case when count(*) over (partition by folder) < 12 then 'character_others' else folder end as folded from f)
select item_id, type || '/' || case when len(names) >= 2 then '2+_characters' else len(names) || case when len(names) = 1 then '_character' else '_characters' end end || '/' || folded || '/' || item_id || '.png' as path from g""")
def arrange_paths(spark, sf_dir):
    from siftloom.operators.arrange import arrange

    return arrange(V.items(spark, sf_dir), ("image_type", "n_characters", "character"), most_characters=2, least_combination=12).select("item_id", "path")


@query("character_parse", names_sql("character"))
def character_parse(spark, sf_dir):
    from siftloom.plans.names import parsed_characters

    return parsed_characters(V.items(spark, sf_dir))

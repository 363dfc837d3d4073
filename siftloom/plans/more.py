"""Further name, tag and folder queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftloom.functions import names as N
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


@query("score_tags", """with x as (select vec_id, generate_subscripts(embedding, 1) - 1 as i, unnest(embedding)::double as p from embeddings)
select vec_id as item, coalesce(string_agg('t' || (i - 4), ' ' order by i) filter (where i >= 4 and p >= 0.1), '') as tags from x group by vec_id""")
def score_tags(spark, sf_dir):
    """Scores of a tagger: the first four outputs are no tags; tags over the threshold stay in the vocabulary's order."""
    scored = F.transform(F.slice("embedding", 5, 1000), lambda p, i: F.struct(p.cast("double").alias("p"), F.concat(F.lit("t"), i).alias("tag")))
    tags = F.transform(F.filter(scored, lambda s: s["p"] >= 0.1), lambda s: s["tag"])
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("item"), F.array_join(tags, " ").alias("tags"))


@query("folder_fields", """with f as (select c_custkey, r_name || '+' || n_name || '+' || r_name as names, c_mktsegment from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
select c_custkey, array_to_string(list_sort(list_distinct(string_split(names, '+'))), ';') as characters, c_mktsegment as kind from f""")
def folder_fields(spark, sf_dir):
    """Folder names, from the right, as fields: a kind, and sorted distinct characters."""
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    path = F.concat_ws("/", F.concat_ws("+", "r_name", "n_name", "r_name"), "c_mktsegment")
    level = lambda k: F.element_at(F.split("path", "/"), -k)
    names = F.filter(F.array_sort(F.array_distinct(F.split(level(2), r"\+"))), lambda x: ~x.isin("unknown", "ood"))
    joined = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select("c_custkey", path.alias("path"))
    return joined.select("c_custkey", F.array_join(names, ";").alias("characters"), level(1).alias("kind"))


@query("folder_rename", f"with {V.FOLDERS} select path, replace(path, 'ASIA/', 'EAST/') as renamed from folder where not contains(path, 'FRANCE')")
def folder_rename(spark, sf_dir):
    """Renames a part of folder names; folders with a part that is to go are dropped."""
    parts = F.split("path", "/")
    renamed = F.transform(parts, lambda x: F.when(x == "ASIA", "EAST").otherwise(x))
    return V.folders(spark, sf_dir).where(~F.exists(parts, lambda x: x == "FRANCE")).select("path", F.array_join(renamed, "/").alias("renamed"))


@query("emb_name_check", "select distinct p_name as name from part where lower(split_part(p_name, ' ', 1)) in (select lower(split_part(p_name, ' ', 1)) from part where p_size <= 1)")
def emb_name_check(spark, sf_dir):
    """Names whose first word is in a vocabulary."""
    words = table(spark, sf_dir, "part").where("p_size <= 1").select(F.lower(F.substring_index("p_name", " ", 1)).alias("word")).distinct()
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("name")).distinct()
    return names.join(words, F.lower(F.substring_index("name", " ", 1)) == F.col("word"), "left_semi")


@query("known_names", "select distinct source as name, case when doc_id % 2 = 0 then source || '_' || lang else source end as embedding from documents where source <> 'src0'")
def known_names(spark, sf_dir):
    """Names and embedding names in classified folders; noise folders give none."""
    folder = F.concat_ws("|", F.concat(F.lit("12_"), "source"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("_"), "lang")).otherwise("none"))
    c = N.parse_character(N.strip_number(folder))
    rows = table(spark, sf_dir, "documents").where("source <> 'src0'").select(c.alias("c"))
    return rows.select(F.col("c.name").alias("name"), N.embedding_name(F.col("c")).alias("embedding")).distinct()


@query("tag_set_algebra", f"""with {V.ITEMS}, b as (select distinct unnest(string_split(lower(text), ' ')) as w from benchmark where text is not null)
select item.item_id, count(*) filter (where tag.tag in (select w from b)) as shared, count(tag.tag) filter (where tag.tag not in (select w from b)) as own from item left join tag using (doc_id) group by item.item_id""")
def tag_set_algebra(spark, sf_dir):
    """Sizes of the intersection and difference of an item's tags with a list."""
    words = table(spark, sf_dir, "benchmark").where("text is not null").select(F.explode(F.split(F.lower("text"), " ")).alias("w")).distinct()
    tags = V.items(spark, sf_dir).select("item_id", F.explode_outer("names").alias("tag")).join(words, F.col("tag") == F.col("w"), "left")
    return tags.groupBy("item_id").agg(F.count("w").alias("shared"), F.count(F.when(F.col("w").isNull(), F.col("tag"))).alias("own"))


@query("label_folders", "select vec_id as item, case when label = 0 then '0_noise' when label < 5 then 'name' || label else 'class_' || substr(md5('3:' || label), 1, 6) end as folder from embeddings")
def label_folders(spark, sf_dir):
    """Folder of each label: its character, noise, or a name drawn by a seeded hash."""
    name = F.when(F.col("label") < 5, F.concat(F.lit("name"), "label"))
    drawn = F.concat(F.lit("class_"), F.substring(F.md5(F.concat(F.lit("3:"), F.col("label"))), 1, 6))
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("item"), F.when(F.col("label") == 0, "0_noise").otherwise(F.coalesce(name, drawn)).alias("folder"))


@query("char_dictionary", "with n as (select distinct source as character from documents union select distinct lang || '|' || source from documents) select character, (row_number() over (order by character) - 1)::int as id, split_part(character, '|', 1) as base from n")
def char_dictionary(spark, sf_dir):
    """Characters of items and of a second list with dense ids by name, and their base names."""
    from siftloom.operators.ranks import number_rows

    d = table(spark, sf_dir, "documents")
    names = d.select(F.col("source").alias("character")).union(d.select(F.concat("lang", F.lit("|"), "source"))).distinct()
    return number_rows(names, ["character"], "id", first=0).select("character", F.col("id").cast("int").alias("id"), N.base_name(F.col("character")).alias("base"))


@query("emb_init_merge", """with o as (select distinct source as name, lang as init from documents where doc_id % 2 = 0), a as (select name, string_agg(init, ' ' order by init) as init from o group by name),
n as (select distinct source as name from documents), f as (select distinct source as name, 'tag' || (doc_id % 3) as tag from documents where doc_id % 3 <> 0),
g as (select name, string_agg(tag, ' ' order by tag) as more from f group by name),
m as (select name, coalesce(a.init, '') as init, coalesce(more, '') as more from n full join a using (name) full join g using (name))
select name, trim(init || ' ' || more) as init from m union all select 'booru', 'masterpiece' union all select 'screenshots', 'anime screencap' union all select 'other', ''""")
def emb_init_merge(spark, sf_dir):
    """Embedding starts: those known, names without one, image types with their default words, and starts found in addition."""
    from siftloom.operators.coretags import merge_emb_init

    d = table(spark, sf_dir, "documents")
    old = d.where("doc_id % 2 = 0").groupBy(F.col("source").alias("name")).agg(F.array_sort(F.collect_set("lang")).alias("init"))
    found = d.where("doc_id % 3 <> 0").groupBy(F.col("source").alias("name")).agg(F.array_sort(F.collect_set(F.concat(F.lit("tag"), F.col("doc_id") % 3))).alias("init"))
    merged = merge_emb_init(old, d.select(F.col("source").alias("name")).distinct(), ["booru", "screenshots", "other"], found)
    return merged.select("name", F.trim(F.array_join("init", " ")).alias("init"))


_WALK = """w as (select c_custkey, r_name || '+' || n_name || '+unknown' as names, c_nationkey % 4 as k, r_name, n_name, c_mktsegment as seg,
 case c_custkey % 3 when 0 then [n_name, r_name, 'ood'] when 1 then ['old'] end as stored from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""


@query("folder_walk", f"""with {_WALK} select c_custkey, case when c_custkey % 7 = 0 then array_to_string(stored, ';') when c_custkey % 3 = 0 then array_to_string(stored, ';')
 else array_to_string(list_sort([r_name, n_name]), ';') end as characters, case k when 0 then 'many' else k::varchar end as n_people, case when c_custkey % 7 <> 0 and c_custkey % 3 <> 0 and n_name = 'FRANCE' then 'FRANCE' end as invalid from w""")
def folder_walk(spark, sf_dir):
    """Characters, numbers of people and invalid names told by folders, against stored characters."""
    from siftloom.operators.fields import folder_fields as walk

    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    rows = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    k = F.col("c_nationkey") % 4
    people = F.when(k == 0, "manypeople").when(k == 1, "1person").otherwise(F.concat(k.cast("string"), F.lit("people")))
    names = F.when(F.col("c_custkey") % 7 == 0, "others").otherwise(F.concat_ws("+", "r_name", "n_name", F.lit("unknown")))
    path = F.concat_ws("/", F.lit("/data"), names, people, "c_mktsegment", F.concat(F.col("c_custkey").cast("string"), F.lit(".png")))
    stored = F.when(F.col("c_custkey") % 3 == 0, F.array("n_name", "r_name", F.lit("ood"))).when(F.col("c_custkey") % 3 == 1, F.array(F.lit("old")))
    allowed = F.array_except(F.array(*(F.lit(x[0]) for x in r.select("r_name").collect() + n.select("n_name").collect())), F.array(F.lit("FRANCE")))
    told = walk(F.col("path"), "character/n_people/*", F.col("stored"), allowed)
    out = rows.select("c_custkey", path.alias("path"), stored.alias("stored")).select("c_custkey", *(x.alias(f) for f, x in told.items()))
    return out.select("c_custkey", F.array_join("characters", ";").alias("characters"), "n_people", F.array_join("invalid", ";").alias("invalid"))


_RULES = "rule as (select n_nationkey::int as ord, n_name as old, case when n_nationkey % 2 = 0 then lower(n_name) else n_comment_ end as new from (select *, n_name || ' ' || n_regionkey as n_comment_ from nation) where n_nationkey % 3 <> 2)"


def _rename_rows(spark, sf_dir):
    """Rules from nations, and rows whose folder, tag line and caption hold their names."""
    n, c = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    new = F.when(F.col("n_nationkey") % 2 == 0, F.lower("n_name")).otherwise(F.concat_ws(" ", "n_name", "n_regionkey"))
    rules = n.where("n_nationkey % 3 <> 2").select(F.col("n_nationkey").alias("ord"), F.col("n_name").alias("old"), new.alias("new"))
    rules = rules.unionByName(spark.createDataFrame([(100, "a 1", "b"), (101, "INDIA", "IRAQ"), (102, "", "no")], rules.schema))
    rows = c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey", F.concat(F.lit("d/"), F.concat_ws("+", "n_name", F.when(F.col("c_custkey") % 2 == 0, "c_mktsegment"))).alias("folder"),
        F.concat(F.lit("character: "), F.concat_ws(", ", "n_name", "c_mktsegment")).alias("line"), F.concat_ws(" and ", "n_name", F.lit("INDIA"), "c_mktsegment").alias("caption"),
    )
    return rows, rules


@query("ordered_rename", """with recursive rule as (select n_nationkey::int as ord, n_name as old, case when n_name = 'INDIA' then 'IRAQ' when n_nationkey % 2 = 0 then lower(n_name) else n_name || ' ' || n_regionkey end as new from nation where n_nationkey % 3 <> 2
 union all select 100, 'a 1', 'b' union all select 101, 'INDIA', 'IRAQ' where 'INDIA' not in (select n_name from nation where n_nationkey % 3 <> 2)),
step as (select *, row_number() over (order by ord) as k from rule),
x as (select c_custkey, n_name, case when c_custkey % 2 = 0 then c_mktsegment end as seg, c_mktsegment from customer join nation on c_nationkey = n_nationkey),
fold as (select c_custkey, n_name || ' and INDIA and ' || c_mktsegment as t, 0::bigint as k from x union all
 select c_custkey, replace(t, old, new), step.k from fold join step on step.k = fold.k + 1)
select x.c_custkey, case when seg is null and (x.n_name in (select old from rule) or x.n_name in (select new from rule)) then 'd/' || coalesce(rule.new, x.n_name) end as folder, 'character: ' || coalesce(rule.new, x.n_name) || ', ' || c_mktsegment as line, t as caption
from x left join rule on rule.old = x.n_name join fold on fold.c_custkey = x.c_custkey and fold.k = (select count(*) from step)""")
def ordered_rename(spark, sf_dir):
    """Folders with a part that no rule knows are null; captions go through all rules in order."""
    from siftloom.operators.fields import apply_renames, rename_rules

    rows, rules = _rename_rows(spark, sf_dir)
    return apply_renames(rows, rename_rules(rules), folder="known_folder", line="tag_line", caption="caption")


@query("face_crops", f"""with {V.BOXES}, f as (select item, row_number() over (partition by item order by det, l, t, r, b) as i, l, t, r, b from box where score >= 0.3),
m as (select *, least(800, trunc(greatest(r - l, b - t) * 3.0))::int as edge, greatest(trunc((l + r) / 2)::int - least(800, trunc(greatest(r - l, b - t) * 3.0))::int // 2, 0) as x, greatest(t - (b - t) // 2, 0) as y from f where greatest(r - l, b - t) < 800),
c as (select item, i, edge, least(x, 1000 - edge) as cl, least(y, 800 - edge) as ct from m),
h as (select c.*, f.i as j, f.l, f.t, f.r, f.b from c left join f on f.item = c.item and (f.l + f.r) / 2 - (f.r - f.l) * 0.1 >= cl and (f.l + f.r) / 2 + (f.r - f.l) * 0.1 <= cl + edge
 and (f.t + f.b) / 2 - (f.b - f.t) * 0.1 >= ct and (f.t + f.b) / 2 + (f.b - f.t) * 0.1 <= ct + edge),
g as (select item, i, any_value(cl) as cl, any_value(ct) as ct, any_value(edge) as edge, count(j)::int as n_faces, list([(b - t) / edge, (b - t) / 800] order by j) filter (where j is not null) as hs,
 coalesce(sum((l - cl) / edge), 0) as left_sum from h group by item, i)
select item, i::int as face, cl as l, ct as t, edge::int as edge, n_faces, round(left_sum, 6) + 0.0::double as left_sum, round(coalesce(list_reduce(list_concat([[0.0::double, 0.0::double]], hs), lambda a, x: case when x[1] > a[2] then x else a end)[2], 0), 9) as fh_ratio from g""")
def face_crops(spark, sf_dir):
    """Square crops three times as large as each face, with the faces that they hold."""
    from siftloom.functions.boxes import face_crops as crops

    boxes = V.boxes(spark, sf_dir).where("score >= 0.3")
    rows = boxes.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("det", "l", "t", "r", "b"))).alias("d"))
    faces = F.transform("d", lambda d: F.array(d["l"] / 1000, d["t"] / 800, d["r"] / 1000, d["b"] / 800))
    # parts of the image give whole pixels back but for rounding
    exact = F.transform(faces, lambda f: F.transform(f, lambda x: x + 1e-9))
    c = rows.select("item", F.explode(crops(F.lit(1000), F.lit(800), exact, 3.0)).alias("c"))
    left = F.aggregate("c.facepos", F.lit(0.0), lambda a, f: a + f[0])
    return c.select("item", "c.face", "c.box.l", "c.box.t", (F.col("c.box.r") - F.col("c.box.l")).alias("edge"), "c.n_faces", (F.round(left, 6) + 0.0).alias("left_sum"), F.round("c.fh_ratio", 9).alias("fh_ratio"))


_V1 = f"""{V.ITEMS}, n as (select doc_id, pos, tag || ['_hair', ' eyes', 'girls', '', ''][length(tag) % 5 + 1] as tag from tag),
k as (select *, regexp_matches(tag, 'boy|girl|solo') as people from n),
x as (select * from k where people or case when regexp_matches(tag, 'hair|ponytail|twintail|braid|bun|bangs|ahoge') then false when contains(tag, 'eyes') then true else tag <> 'parody' end),
o as (select *, row_number() over (partition by doc_id order by people desc, pos) as p from x),
t as (select doc_id, string_agg(tag, ', ' order by p) as tags from o where p <= 20 group by doc_id),
w as (select item.*, doc_id % 2 = 0 and len(characters) = 1 as worn, case when doc_id % 5 = 0 then 'at left' when doc_id % 5 = 1 then 'in the middle at right' end as places,
 list_transform(characters, lambda c: case when contains(c, '|') then replace(c, '|', ', ') else c end) as named from item)"""
_V1_REST = """case when doc_id % 7 = 0 then 'from x y' end, type, case when doc_id % 6 <> 0 then 'by me' end, case when rating = 'e' then 'explicit' end, places, nullif(coalesce(tags, ''), '')"""


def _v1_rows(spark, sf_dir, embeddings, sep):
    from siftloom.functions import boxes as B
    from siftloom.functions import captions as C
    from siftloom.operators.fields import filter_v1

    ends = F.array(*map(F.lit, ("_hair", " eyes", "girls", "", "")))
    words = F.transform("names", lambda w: F.concat(w, F.element_at(ends, (F.length(w) % 5 + 1).cast("int"))))
    kept = filter_v1(words, F.array().cast("array<string>"), F.lit(False), drop_hair=True, most=20)
    k = F.col("doc_id") % 5
    face = lambda x: F.array(*map(F.lit, (x, 0.1, x + 0.1, 0.2)))
    faces = F.when(k == 0, F.array(face(0.2))).when(k == 1, F.array(face(0.5), face(0.7)))
    uniform = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit(C.TRACEN))).otherwise(F.array().cast("array<string>"))
    rows = V.items(spark, sf_dir).withColumn("named", F.transform("characters", lambda c: F.replace(c, F.lit("|"), F.lit(", ")))).withColumn("kept", F.concat(kept, uniform))
    fields = {
        "n_people": F.when(F.col("doc_id") % 3 == 0, (F.col("doc_id") % 4).cast("string")), "characters": F.concat("named", F.array(F.lit("ood"))),
        "copyright": F.when(F.col("doc_id") % 7 == 0, F.array(F.lit("x"), F.lit("unknown"), F.lit("y"))), "general": F.col("type"),
        "artist": F.when(F.col("doc_id") % 6 == 0, F.array(F.lit("anonymous"))).otherwise(F.array(F.lit("me"))), "rating": F.when(F.col("rating") == "e", "explicit").otherwise(F.col("rating")),
    }
    caption = C.v1_caption(F.col("item_id"), fields, F.col("kept"), B.face_places(faces), sep, embeddings)
    return rows.select("item_id", caption.alias("caption"), F.array_join(C.v1_embeddings(F.col("named")), ";").alias("embeddings"))


_V1_TAGS = "nullif(coalesce(tags, '') || case when doc_id % 2 = 0 and len(characters) <> 1 then case when coalesce(tags, '') = '' then '' else ', ' end || 'tracen school uniform' else '' end, '')"


def _v1_sql(sep: str, outfits: bool) -> str:
    form = "list_transform(named, lambda c: case when contains(c, ',') then split_part(c, ',', 1) || ', ' || replace(replace(c, ',', ''), ' ', '-') else c end)" if outfits else "named"
    people = "case when doc_id % 3 = 0 then (doc_id % 4) || case when doc_id % 4 = 1 then 'person' else 'people' end end"
    who = f"nullif(case when worn then split_part(({form})[1], ',', 1) || ', tracen school uniform' else array_to_string({form}, '{sep} ') end, '')"
    rest = _V1_REST.replace("nullif(coalesce(tags, ''), '')", _V1_TAGS)
    made = "array_to_string(list_distinct_(named), ';')".replace("list_distinct_(named)", "list_transform(list_filter(named, lambda c: contains(c, ',')), lambda c: replace(replace(c, ',', ''), ' ', '-'))")
    return f"with {_V1} select item_id, replace(concat_ws('{sep} ', {people}, {who}, {rest}), '_', ' ') as caption, {made} as embeddings from w left join t using (doc_id)"


@query("v1_captions", _v1_sql(",", False))
def v1_captions(spark, sf_dir):
    """Old captions between commas, over words given the endings of tag families; every second item has the school uniform."""
    return _v1_rows(spark, sf_dir, False, ",")


@query("v1_captions_embeddings", _v1_sql(";", True))
def v1_captions_embeddings(spark, sf_dir):
    """Old captions between semicolons, outfits as names of embeddings."""
    return _v1_rows(spark, sf_dir, True, ";")


@query("head_crops", f"""with {V.BOXES}, m as (select item, det, l, t, r, b, least(800, trunc(greatest(r - l, b - t) * 4.5))::int as e from box)
select item, det, least(greatest(trunc((l + r) / 2)::int - e // 2, 0), 1000 - e)::int as l, least(greatest(t - (b - t) // 2, 0), 800 - e)::int as t, e as edge from m""")
def head_crops(spark, sf_dir):
    from siftloom.functions import boxes as B

    rows = V.boxes(spark, sf_dir).select("item", "det", B.head_crop(F.struct("l", "t", "r", "b"), F.lit(1000), F.lit(800), 4.5).alias("c"))
    return rows.select("item", "det", "c.l", "c.t", (F.col("c.r") - F.col("c.l")).alias("edge"))


@query("face_codes", f"""with {V.BOXES}, p as (select item, det, l, t, r, b, score, kind, ((l + r) / 2) / 1000 as x, ((t + b) / 2) / 800 as y from box),
w as (select *, case when x < 0.2 then 'fhll' when x < 0.4 then 'fhml' when x < 0.6 then 'fhmd' when x < 0.8 then 'fhmr' else 'fhri' end || ' ' ||
 case when y < 0.2 then 'fvtp' when y < 0.4 then 'fvmt' when y < 0.6 then 'fvmd' when y < 0.8 then 'fvmb' else 'fvbt' end as code from p)
select item, string_agg(code, ' ' order by det, l, t, r, b) as codes from w group by item""")
def face_codes(spark, sf_dir):
    """Codes of the places of each image's faces, in order."""
    from siftloom.functions import boxes as B

    faces = F.array_sort(F.collect_list(F.struct("det", "l", "t", "r", "b")))
    rows = V.boxes(spark, sf_dir).groupBy("item").agg(faces.alias("f"))
    # middles first, as whole numbers, so that both engines divide alike
    places = F.transform("f", lambda f: F.array((f["l"] + f["r"]) / 2 / 1000, (f["t"] + f["b"]) / 2 / 800, (f["l"] + f["r"]) / 2 / 1000, (f["t"] + f["b"]) / 2 / 800))
    return rows.select("item", B.face_places(places, codes=True).alias("codes"))


@query("dressed_vote", """with x as (select vec_id, generate_subscripts(embedding, 1) - 1 as i, unnest(embedding)::double as p from embeddings),
a as (select vec_id, i % 10 as c, p, i // 10 as m from x where i < 30), r as (select *, row_number() over (partition by vec_id, m order by p desc, 'c' || c) as k from a),
b as (select vec_id, max(p) filter (where m = 0) as p0, max(c) filter (where m = 0) as c0, max(p) filter (where m = 1) as p1, max(c) filter (where m = 1) as c1, max(p) filter (where m = 2) as p2, max(c) filter (where m = 2) as c2 from r where k = 1 group by vec_id),
v as (select *, case when greatest(p0, p1) <= 0.15 then 'unknown' when (case when p1 >= p0 then c1 else c0 end) = 9 then 'unknown' else 'c' || (case when p1 >= p0 then c1 else c0 end) end as ch from b)
select vec_id as item, case when p2 > 0.15 and c2 <> 3 and ch <> 'unknown' then ch || ', c' || c2 else ch end as character from v""")
def dressed_vote(spark, sf_dir):
    """Two models' vote, and a third one's outfit."""
    from siftloom.operators.labels import model_vote

    e = table(spark, sf_dir, "embeddings")

    def scores(start, odd):
        p = e.select(F.col("vec_id").alias("item"), F.posexplode(F.slice("embedding", start, 10)).alias("k", "p"))
        name = F.when(F.col("k") == odd[0], odd[1]).otherwise(F.concat(F.lit("c"), F.col("k").cast("string")))
        return p.select("item", name.alias("class"), F.col("p").cast("double").alias("p"))

    return model_vote(scores(1, (9, "ood")), 0.15, scores(11, (9, "ood")), scores(21, (3, "others")))


@query("decoded_ids", """with w as (select p_partkey, string_split(p_name, ' ') as ws from part), t as (select p_partkey, unnest(ws) as token, unnest(range(len(ws))) as i from w),
v as (select token, count(*) as n from t group by token having count(*) >= 20) select p_partkey, string_agg(case when v.token is null then '[UNK]' else t.token end, ' ' order by i) || ' [SEP]' as words from t left join v using (token) group by p_partkey""")
def decoded_ids(spark, sf_dir):
    """Part names as ids of a vocabulary and back; rare words are lost."""
    from siftloom.operators import labels as L

    words = table(spark, sf_dir, "part").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("at", "token"))
    known = L.vocabulary(words.select("token", (F.col("p_partkey") * 10 + F.col("at")).alias("ord")), 20)
    ids = words.join(known, "token", "left").groupBy("p_partkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "id"))), lambda x: x["id"]).alias("ids"))
    ids = ids.select("p_partkey", F.concat("ids", F.array(F.lit(L.SEP).cast("long"))).alias("ids"))
    return L.decode_tokens(ids, "ids", known, "p_partkey").select("p_partkey", F.array_join("words", " ").alias("words"))


@query("extra_embeddings", """select doc_id, case when doc_id % 3 = 0 then '_' || lang || ';_cap' else '_cap' end as embeddings, source || case when doc_id % 2 = 0 then ' x_y' else '_' || lang end || case when doc_id % 3 = 0 then ', _' || lang else '' end || ', hat _cap' as caption from documents""")
def extra_embeddings(spark, sf_dir):
    """Embeddings among a character's outfits and accessories, and the character in a caption."""
    part = F.when(F.col("doc_id") % 2 == 0, "x/y").otherwise(F.concat(F.lit("_"), "lang"))
    worn = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("_"), "lang")).otherwise("none")
    c = N.parse_character(F.concat_ws("|", "source", part, worn, F.lit("hat+_cap")))
    rows = table(spark, sf_dir, "documents").select("doc_id", c.alias("c"))
    return rows.select("doc_id", F.array_join(N.extra_embeddings(F.col("c")), ";").alias("embeddings"), N.caption_character(F.col("c")).alias("caption"))


@query("face_positions", f"""with {V.BOXES}, g as (select item, det, l, t, r, b from box where score >= 0.3 and r - l <= 2.0 * (b - t) and b - t <= 2.0 * (r - l)),
p as (select item, string_agg((l * 1000 // 1000) || ':' || t || ':' || r || ':' || b, ' ' order by det, l, t, r, b) as places from g group by item)
select distinct box.item, coalesce(places, '') as places from box left join p using (item)""")
def face_positions(spark, sf_dir):
    """Places of each image's good faces, as parts of it, told in pixels."""
    from siftloom.operators.filters import face_summary as summary

    boxes = V.boxes(spark, sf_dir)
    faces = summary(boxes, boxes.select("item").distinct(), 0.3, 2.0, F.lit(800), F.lit(1000))
    pixels = F.transform("facepos", lambda f: F.concat_ws(":", *(F.rint(f[i] * (800 if i % 2 else 1000)).cast("int").cast("string") for i in range(4))))
    return faces.select("item", F.array_join(pixels, " ").alias("places"))


@query("balance_globs", """with f as (select distinct r_name as node from region union select r_name || '/' || n_name from nation join region on n_regionkey = r_regionkey)
select node as path, case when node = 'ASIA' then 9 when node like '%/CHINA' then 5 when regexp_matches(node, '^A[^/]*/[A-C][^/]*$') then 2 when regexp_matches(node, '^[^E].*/.[^AEIOU][^/]*$') then 3 else 1 end::double as weight from f""")
def balance_globs(spark, sf_dir):
    """Weights of region and nation folders by name and by globs with brackets."""
    from siftloom.operators.balance import folder_weights

    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    nodes = r.select(F.col("r_name").alias("path")).union(n.join(r, n.n_regionkey == r.r_regionkey).select(F.concat_ws("/", "r_name", "n_name")))
    rules = spark.createDataFrame([(0, "A*/[A-C]*", 2.0), (1, "[!E]*/?[!AEIOU]*", 3.0), (2, "CHINA", 5.0), (3, "ASIA", 9.0), (4, "[bad", 7.0)], "ord int, pattern string, weight double")
    return folder_weights(nodes.distinct(), rules)

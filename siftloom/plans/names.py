"""Name queries: characters and titles made of the given tables' columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftloom.functions import names as N
from siftloom.session import table

QUERIES, SQL = {}, {}


def names_sql(what: str) -> str:
    return {
        "character": """select 'i' || doc_id as item_id, source as name, case doc_id % 2 when 0 then '_' || lang end as appearance, lang as outfit,
 case doc_id % 2 when 0 then source || '_' || lang else source end as embedding,
 source || '|' || case doc_id % 2 when 0 then '_' || lang else 'none' end || '|' || lang || case doc_id % 3 when 0 then '' else '|a+b' end as again from documents""",
    }[what]


def parsed_characters(items: DataFrame) -> DataFrame:
    text = F.concat_ws(
        "|", F.col("source"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("_"), "type")).otherwise("none"), F.col("type"),
        F.when(F.col("doc_id") % 3 == 0, "none").otherwise("a+b"), F.lit("none"),
    )
    c = N.parse_character(text)
    parsed = items.select("item_id", c.alias("c"))
    return parsed.select(
        "item_id", "c.name", "c.appearance", F.array_join("c.outfit", ";").alias("outfit"), N.embedding_name(F.col("c")).alias("embedding"), N.format_character(F.col("c")).alias("again")
    )


def title_parse(spark, sf_dir):
    """Part names as titles of video files."""
    part = table(spark, sf_dir, "part")
    name = F.concat(F.lit("[Group] "), "p_name", F.lit(" - "), F.col("p_size"), F.lit(" (1080p) [AB12].mkv"))
    return part.select("p_partkey", name.alias("file")).select("p_partkey", N.parse_title(F.col("file")).alias("t")).select("p_partkey", "t.name", "t.episode")


QUERIES["title_parse"] = title_parse
SQL["title_parse"] = "select p_partkey, p_name as name, p_size as episode from part"


def sanitize_paths(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", N.sanitize(F.concat_ws("/", F.replace("p_name", F.lit(" "), F.lit("?")), F.concat("p_brand", F.lit("<|>")))).alias("path"))


QUERIES["sanitize_paths"] = sanitize_paths
SQL["sanitize_paths"] = "select p_partkey, replace(p_name, ' ', '_') || '/' || p_brand || '___' as path from part"


def natural_order(spark, sf_dir):
    """Customer names in natural order, ranked within their segment."""
    from pyspark.sql.window import Window

    key = N.natural_key(F.concat(F.lit("c"), F.col("c_custkey"), F.lit("_x")))
    w = Window.partitionBy("c_mktsegment", "c_nationkey").orderBy(key)
    return table(spark, sf_dir, "customer").select("c_custkey", F.row_number().over(w).alias("place"))


QUERIES["natural_order"] = natural_order
SQL["natural_order"] = "select c_custkey, row_number() over (partition by c_mktsegment, c_nationkey order by c_custkey)::int as place from customer"


def flatten_paths(spark, sf_dir):
    from siftloom.plans import views as V

    flat = N.flatten_path(F.col("path"), F.col("n") / 7)
    return V.folders(spark, sf_dir).select("path", flat.alias("flat"), N.revert_path(flat).alias("back"))


QUERIES["flatten_paths"] = flatten_paths


def _flat_sql() -> str:
    from siftloom.plans import views as V

    return f"with {V.FOLDERS} select path, round_even(n / 7, 0)::int || '_' || replace(path, '/', '~') as flat, path as back from folder"


SQL["flatten_paths"] = _flat_sql()


def md5_names(spark, sf_dir):
    """Pages by the digest of their content, one for each digest."""
    p = table(spark, sf_dir, "pages")
    return p.groupBy(F.concat(F.md5(F.coalesce("html", F.lit(""))), F.lit(".html")).alias("name")).agg(F.min("page_id").alias("page_id"), F.count("*").alias("n"))


QUERIES["md5_names"] = md5_names
SQL["md5_names"] = "select md5(coalesce(html, '')) || '.html' as name, min(page_id) as page_id, count(*) as n from pages group by 1"

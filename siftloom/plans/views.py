"""The given tables seen as this library's inputs, once as DataFrames and once as SQL with the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftloom.session import table


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as items: tags are the distinct lower-case words of the whole text, in order, with a score of 1 / (1 + place)."""
    words = F.array_distinct(F.array_remove(F.split(F.replace(F.lower(F.coalesce("text", F.lit(""))), F.lit("\n"), F.lit(" ")), " ", -1), ""))
    pair = F.concat("lang", F.lit("|"), "source")
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("i"), F.col("doc_id")).alias("item_id"), "doc_id",
        F.when(F.col("doc_id") % 3 == 0, F.array().cast("array<string>")).when(F.col("doc_id") % 3 == 1, F.array("source")).otherwise(F.array("source", pair)).alias("characters"),
        F.transform(words, lambda w, i: F.struct(w.alias("tag"), (F.lit(1.0) / (i + 1)).alias("score"))).alias("tags"), words.alias("names"),
        F.concat(F.lit("i"), F.col("doc_id") - F.col("doc_id") % 4).alias("parent_id"),
        F.element_at(F.array(*map(F.lit, ("s", "g", "q", "e"))), (F.col("doc_id") % 4 + 1).cast("int")).alias("rating"),
        F.col("lang").alias("type"), "source", "n_chars",
    )


ITEMS = """
w0 as (select doc_id, unnest(string_split(replace(lower(coalesce(text, '')), chr(10), ' '), ' ')) as w,
    generate_subscripts(string_split(replace(lower(coalesce(text, '')), chr(10), ' '), ' '), 1) as p from documents),
w1 as (select doc_id, w, min(p) as p from w0 where w <> '' group by doc_id, w),
tag as (select doc_id, 'i' || doc_id as item_id, w as tag, row_number() over (partition by doc_id order by p) - 1 as pos from w1),
item as (select 'i' || doc_id as item_id, doc_id, case doc_id % 3 when 0 then [] when 1 then [source] else [source, lang || '|' || source] end as characters,
    'i' || (doc_id - doc_id % 4) as parent_id, ['s', 'g', 'q', 'e'][(doc_id % 4 + 1)::int] as rating, lang as type, n_chars from documents)"""


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as posts of a feed, in order of time and id."""
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", F.array(F.concat(F.lit("u"), F.col("user_id") % 20), F.concat(F.lit("v"), F.col("user_id") % 7)).alias("keys"),
        F.col("event_type").alias("kind"), "value", "props", "user_id",
    )


POSTS = """
post as (select event_id, ts, ['u' || (user_id % 20), 'v' || (user_id % 7)] as keys, event_type as kind, value, props, user_id from events)"""


def folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as images in folders region/nation/segment: (path, n)."""
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    joined = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return joined.groupBy(F.concat_ws("/", "r_name", "n_name", "c_mktsegment").alias("path")).agg(F.count("*").alias("n"))


FOLDERS = """
folder as (select r_name || '/' || n_name || '/' || c_mktsegment as path, count(*) as n from customer
    join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1)"""


def boxes(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Lines of orders as detections in images of 1000 x 800: item, det (place), edges, score, kind, and ``more`` columns of the table."""
    left, top = F.floor(F.col("l_extendedprice")).cast("int") % 700, F.col("l_partkey").cast("int") % 500
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("item"), F.col("l_linenumber").alias("det"), left.alias("l"), top.alias("t"),
        (left + F.col("l_quantity").cast("int") * 4 + 10).alias("r"), (top + F.col("l_suppkey").cast("int") % 200 + 20).alias("b"),
        (F.rint(F.col("l_discount") * 100) / 10).alias("score"), F.col("l_linestatus").alias("kind"), *more,
    )


BOXES = """
box as (select l_orderkey as item, l_linenumber as det, floor(l_extendedprice)::int % 700 as l, l_partkey::int % 500 as t,
    floor(l_extendedprice)::int % 700 + l_quantity::int * 4 + 10 as r, l_partkey::int % 500 + l_suppkey::int % 200 + 20 as b,
    round_even(l_discount * 100, 0) / 10 as score, l_linestatus as kind from lineitem)"""

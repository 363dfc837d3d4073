"""Tag trees: edges from pages and from nested JSON, and what stands below or above a node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftloom.session import materialize


#: Pieces of a page that shape its hierarchy: headings, ends of lists, list items with a link (before any other item, list or heading).
_TOKEN = r"(?is)<h([1-6])\b[^>]*>(.*?)</h[1-6]>|<(/?ul)\b[^>]*>|<li\b[^>]*>[^<]*+(?:<(?!/?li\b|/?ul\b|h[1-6]\b|a\b)[^<]*+)*+<a\b[^>]*>(.*?)</a>"


def page_edges(pages: DataFrame, page: str = "page_id", html: str = "html") -> DataFrame:
    """(page, parent, child, is_tag) of headings and list links of each page.

    A heading h1 to h6 is a group below the last heading of a lower number; the first link of a list item is a tag below the
    last heading before it. A list within a list belongs to the last link before it in the list around: that link is a group then, and still the
    tag that it is; without such a link, to the heading. An item without a link gives nothing. What follows a heading "See also" is left out;
    a null or empty page has no edges.

    Parents are running maxima, of places of headings by number and of lists and links by depth, so a page costs as much as it is long.
    """
    names = ("all", "level", "title", "list", "link")
    found = pages.select(
        F.col(page).alias("page"),
        F.posexplode(F.arrays_zip(*(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(_TOKEN), F.lit(i)).alias(n) for i, n in enumerate(names)))).alias("pos", "x"),
    ).select("page", "pos", *(F.col(f"x.{n}").alias(n) for n in names[1:]))
    kind = F.when(F.col("level") != "", "heading").when(F.lower("list") == "ul", "open").when(F.col("list") != "", "close").otherwise("link")
    name = F.trim(F.regexp_replace(F.when(F.col("level") != "", F.col("title")).otherwise(F.col("link")), "<[^>]*>", ""))
    rows = found.select("page", "pos", kind.alias("kind"), F.col("level").try_cast("int").alias("level"), name.alias("name"))
    running = Window.partitionBy("page").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("page").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    heading = F.col("kind") == "heading"
    rows = rows.withColumn("ended", F.max(heading & (F.lower("name") == "see also")).over(running)).where("not ended")
    rows = rows.where(~(heading & (F.col("name") == "")))
    place = F.struct("pos", "name")
    last = [F.max(F.when(F.col("level") == n, place)).over(before) for n in range(1, 7)]
    step = F.when(F.col("kind") == "open", 1).when(F.col("kind") == "close", -1).otherwise(0)
    rows = rows.select("*", *(c.alias(f"h{n}") for n, c in enumerate(last, 1)), F.sum(heading.cast("int")).over(running).alias("section"))
    depth = F.sum(step).over(Window.partitionBy("page", "section").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    under = F.greatest(*(F.when(F.coalesce(F.col("level"), F.lit(7)) > n, F.col(f"h{n}")) for n in range(1, 7)))
    rows = rows.select("page", "pos", "kind", "name", "section", under["name"].alias("under"), depth.alias("depth"))

    # a list within a list asks the depth around it for the last link since that list began
    asks = F.when(F.col("kind") == "open", F.array(F.struct(F.col("depth").alias("at"), F.lit("open").alias("as")), F.struct((F.col("depth") - 1).alias("at"), F.lit("ask").alias("as"))))
    asks = F.when(F.col("kind") == "link", F.array(F.struct(F.col("depth").alias("at"), F.lit("link").alias("as")))).otherwise(asks)
    turns = rows.where("kind in ('open', 'link')").select("page", "section", "pos", "name", F.explode(asks).alias("a")).select("page", "section", "pos", "name", "a.*")
    here = Window.partitionBy("page", "section", "at").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    opened, linked = F.max(F.when(F.col("as") == "open", F.col("pos"))).over(here), F.max(F.when(F.col("as") == "link", F.struct("pos", "name"))).over(here)
    turns = turns.withColumn("opened", opened).withColumn("linked", linked)
    groups = turns.where("as = 'ask' and at >= 1").select("page", F.col("pos").alias("opened"), F.when(F.col("linked.pos") > F.col("opened"), F.col("linked.name")).alias("group"))
    of_list = turns.where("as = 'link'").select("page", "pos", "opened").join(groups, ["page", "opened"]).select("page", "pos", "group")
    out = rows.where("kind in ('heading', 'link') and name <> ''").join(of_list, ["page", "pos"], "left")
    return out.select("page", F.coalesce("group", "under", F.lit("")).alias("parent"), F.col("name").alias("child"), (F.col("kind") == "link").alias("is_tag")).distinct()


def json_edges(docs: DataFrame, column: str = "doc") -> DataFrame:
    """(parent, child, is_tag) of nested JSON groups: an object is a group, a text a tag of that name, ``self`` a text that makes the group itself a tag; null is left out.

    One pass over variants for each level of nesting.
    """
    level = docs.select(F.lit(None).cast("string").alias("parent"), F.parse_json(column).alias("v"))
    out = None
    while True:
        pairs = level.select("parent", "v").createOrReplaceTempView("_tree_level") or level.sparkSession.sql(
            "select l.parent, e.key, e.value as v, schema_of_variant(e.value) as kind from _tree_level l, lateral variant_explode(l.v) e where e.key is not null"
        )
        pairs = materialize(pairs.select("parent", "key", F.col("v").cast("string").alias("text"), "kind", F.to_json("v").alias("json")), "level")
        leaves = pairs.where("kind = 'STRING'").select(
            F.when(F.col("key") == "self", F.lit(None)).otherwise(F.col("parent")).alias("parent"), F.when(F.col("key") == "self", F.col("parent")).otherwise(F.col("text")).alias("child"), F.lit(True).alias("is_tag")
        )
        groups = pairs.where("kind like 'OBJECT%'")
        edges = leaves.union(groups.select("parent", F.col("key").alias("child"), F.lit(False)))
        out = edges if out is None else out.union(edges)
        if groups.isEmpty():
            return out.distinct()
        level = groups.select(F.col("key").alias("parent"), F.parse_json("json").alias("v"))


def descendants(edges: DataFrame, group: str) -> DataFrame:
    """(child, depth) of all that stands below a group, with its least depth. Works round by round, so that loops end."""
    frontier = edges.where(F.col("parent") == group).select("child").distinct().withColumn("depth", F.lit(1))
    seen = materialize(frontier, "below")
    last, depth = seen, 1
    while not last.isEmpty():
        depth += 1
        step = edges.join(last.select(F.col("child").alias("parent")), "parent").select("child").distinct()
        last = materialize(step.join(seen.select("child"), "child", "left_anti").withColumn("depth", F.lit(depth)), "below")
        seen = seen.union(last)
    return seen


def ancestors(edges: DataFrame, tag: str) -> DataFrame:
    """(parent, depth) of all groups above a node."""
    turned = edges.select(F.col("child").alias("parent"), F.col("parent").alias("child")).where("child is not null and child <> ''")
    return descendants(turned, tag).select(F.col("child").alias("parent"), "depth")


def tree_paths(edges: DataFrame, most: int = 64) -> DataFrame:
    """(path, name, is_tag) of every place in a tree of (parent, child, is_tag): ``path`` is the names from the top down to the place.

    Tops are groups that nothing stands above. A name below several groups has as many places; a place is a tag if an edge to it says so.
    A name that comes again on its own path ends it, so loops end; what can't be reached from a top has no place. Deeper than ``most`` is an error of Spark's.
    """
    spark = edges.sparkSession
    every = edges.where("child is not null and child <> ''")
    known = every.where("parent is not null and parent <> ''").groupBy("parent", "child").agg(F.max("is_tag").alias("is_tag"))
    loose = every.where("parent is null or parent = ''").groupBy(F.col("child").alias("name")).agg(F.max("is_tag").alias("is_tag"))
    above = known.select(F.col("parent").alias("name"), F.lit(False).alias("is_tag")).distinct()
    tops = above.join(known.select(F.col("child").alias("name")).distinct(), "name", "left_anti").unionByName(loose).groupBy("name").agg(F.max("is_tag").alias("is_tag"))
    # a group that is a tag by a loose edge keeps its places below others and is no further top
    placed = known.select(F.col("child").alias("name")).distinct()
    marks = loose.where("is_tag").select(F.col("name").alias("child"), F.lit(True).alias("marked"))
    tops = tops.join(placed, "name", "left_anti")
    known = known.join(marks, "child", "left").select("parent", "child", (F.col("is_tag") | F.coalesce("marked", F.lit(False))).alias("is_tag"))
    edge_table, top_table = materialize(known, "tree_edges"), materialize(tops, "tree_tops")
    query = f"""with recursive place(path, name, is_tag) max recursion level {most} as (
        select array(name), name, is_tag from {{tops}}
        union all
        select array_append(p.path, e.child), e.child, e.is_tag from place p join {{edges}} e on e.parent = p.name where not array_contains(p.path, e.child))
        select path, name, is_tag from place"""
    return spark.sql(query, tops=top_table, edges=edge_table)


def resolve(paths: DataFrame, queries: DataFrame) -> DataFrame:
    """(query, outcome, path) of queries (query: array of names) over places of tree_paths(): the first name must stand in one place of the tree alone, and each
    further one right below the one before. ``outcome`` is found, missing or ambiguous; ``path`` is null but for the first.
    """
    first = F.get("query", F.lit(0))
    distinct = queries.select("query").distinct()
    n = paths.groupBy("name").agg(F.count("*").alias("places"), F.min("path").alias("start"))
    asked = distinct.join(n, first == F.col("name"), "left").withColumn("wanted", F.concat("start", F.slice("query", 2, 1000000)))
    there = asked.join(paths.select(F.col("path").alias("wanted"), F.lit(True).alias("hit")), "wanted", "left")
    outcome = F.when(F.col("places") > 1, "ambiguous").when(F.coalesce("hit", F.lit(False)), "found").otherwise("missing")
    return there.select("query", outcome.alias("outcome"), F.when(outcome == "found", F.col("wanted")).alias("path"))


def tags_below(paths: DataFrame, found: DataFrame) -> DataFrame:
    """(query, tag) of the tags at and below the places that resolve() found, each as often as it stands there."""
    # every place asks for itself and all places above it, by name of the path
    at = paths.where("is_tag").select("name", F.explode(F.transform(F.sequence(F.lit(1), F.size("path")), lambda k: F.slice("path", F.lit(1), k))).alias("path"))
    return at.join(found.where("outcome = 'found'").select("query", "path"), "path").select("query", F.col("name").alias("tag"))


def groups_above(found: DataFrame) -> DataFrame:
    """(query, group, up) of the names from each place found up to its top, the place's own with 0."""
    up = F.posexplode(F.reverse("path")).alias("up", "group")
    return found.where("outcome = 'found'").select("query", up).select("query", "group", "up")

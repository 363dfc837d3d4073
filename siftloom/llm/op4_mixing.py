"""Mixing sources to target weights by hierarchical budgeting, in DataFrame functions alone.

A token budget flows down a tree of domains, languages and sources. Each node splits its budget among its
children by weight; a child takes no more than the tokens below it, times the number of epochs, can give,
and what it leaves goes to its siblings. So a shortage leaves a subtree only once the subtree is full.
Each leaf then takes whole epochs of its documents and, of one more epoch, a prefix in that epoch's seeded order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftloom.session import materialize, table

LEVELS = ("domain", "language", "origin")
#: Budget as thousandths of the corpus's tokens; most epochs of a leaf; seed of the orders.
BUDGET_PER_MILLE, MAX_EPOCHS, SEED = 600, 2, 17
#: Weights of paths, in whole numbers; other paths weigh 1. Fixed values of this recipe.
WEIGHTS = {
    "d0": 4, "d1": 3, "d2": 2, "d3": 1,
    "d0/en": 5, "d0/de": 2, "d1/en": 3, "d2/en": 3, "d3/en": 3, "d3/fr": 2,
    "d0/en/src0": 2, "d1/en/src1": 3, "d2/de/src2": 2,
}
#: Hex digits of a document's place that name its group when prefixes are added up: 4096 groups in a leaf.
GROUP_DIGITS = 3


def water_fill(nodes: DataFrame, parent: str, budget: str) -> DataFrame:
    """Adds ``given``: the share of ``budget``, the same in all rows of a ``parent``, of each row, by ``weight``, up to ``capacity``.

    Rows in order of capacity over weight: a row is full if its capacity is within its share of what the
    rows before it, all full, have left. The rest share by weight; rounding follows running sums of weights,
    so shares add up to the budget, or to all capacities if those are less. Whole numbers throughout.
    A weight is at least 1.
    """
    order = [F.col("capacity") / F.col("weight"), F.col("path")]
    before = Window.partitionBy(parent).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    on = Window.partitionBy(parent).orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    upto = Window.partitionBy(parent).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy(parent)
    wide = "decimal(38,0)"
    steps = nodes.withColumn("_left", F.col(budget) - F.coalesce(F.sum("capacity").over(before), F.lit(0))).withColumn("_w", F.sum("weight").over(on))
    steps = steps.withColumn("_full", F.col("capacity").cast(wide) * F.col("_w") <= F.col("weight").cast(wide) * F.col("_left"))
    open_weight = F.when(F.col("_full"), 0).otherwise(F.col("weight"))
    steps = steps.withColumn("_rest", F.col(budget) - F.sum(F.when(F.col("_full"), F.col("capacity")).otherwise(0)).over(every))
    steps = steps.withColumn("_open", F.sum(open_weight).over(every)).withColumn("_to", F.sum(open_weight).over(upto))

    def part(w: Column) -> Column:
        return F.call_function("div", F.col("_rest").cast(wide) * w, F.col("_open").cast(wide))

    share = (part(F.col("_to")) - part(F.col("_to") - F.col("weight"))).cast("bigint")
    return steps.withColumn("given", F.when(F.col("_full"), F.col("capacity")).otherwise(share)).drop("_left", "_w", "_full", "_rest", "_open", "_to")


def plan_leaves(leaves: DataFrame, levels: tuple[str, ...], weights: dict[str, int], budget: DataFrame | Column | int, max_epochs: int) -> DataFrame:
    """(path, tokens, quota, epochs, rest) of a table (levels..., tokens) with one row for each leaf.

    ``budget`` is a number of tokens. Each level is one pass over the nodes of that level; a window holds
    the children of one node. Weights join as a literal map of paths.
    """
    spark = leaves.sparkSession
    weight_table = F.broadcast(spark.createDataFrame([(k, int(v)) for k, v in weights.items()] or [("", 1)], "path string, weight bigint"))
    depth = len(levels)
    paths = [F.concat_ws("/", *levels[: k + 1]) for k in range(depth)]
    base = leaves.select(*(p.alias(f"path{k}") for k, p in enumerate(paths)), (F.col("tokens") * max_epochs).cast("bigint").alias("capacity"), F.col("tokens").cast("bigint").alias("tokens"))
    given = None
    for k in range(depth):
        parent = [f"path{k - 1}"] if k else []
        nodes = base.groupBy(F.col(f"path{k}").alias("path"), *(F.col(p).alias("parent") for p in parent)).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.join(weight_table, "path", "left").withColumn("weight", F.coalesce("weight", F.lit(1)))
        if given is None:
            nodes = nodes.withColumn("parent", F.lit("")).withColumn("budget", F.lit(budget).cast("bigint"))
        else:
            nodes = nodes.join(given.select(F.col("path").alias("parent"), F.col("given").alias("budget")), "parent")
        given = water_fill(nodes, "parent", "budget")
    return base.select(F.col(f"path{depth - 1}").alias("path"), "tokens").join(given.select("path", F.col("given").alias("quota")), "path").select(
        "path", "tokens", "quota",
        F.when(F.col("tokens") > 0, F.expr("quota div tokens")).otherwise(F.lit(0)).cast("int").alias("epochs"),
        F.when(F.col("tokens") > 0, F.col("quota") % F.col("tokens")).otherwise(F.lit(0)).cast("bigint").alias("rest"),
    )


def mix(docs: DataFrame, levels: tuple[str, ...], weights: dict[str, int], budget_per_mille: int, max_epochs: int = MAX_EPOCHS, seed: int = SEED, key: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """(key, path, tokens, copies, taken) of each row of ``docs``, a stored table with the level columns and a token count.

    ``copies`` is how often the document is selected: once for each whole epoch of its leaf, and once more
    if it starts within the prefix of the next. ``taken`` is the number of its tokens within the quota: the
    prefix ends inside its last document. A null level is "?", null or negative tokens count as 0; repeated
    rows count each; ties in the order go by key. An empty table gives an empty table.

    Prefixes are found in two steps: tokens by leaf and group of places (partial sums), then, only within
    the one group in which a leaf's quota ends, document by document. No task sees a whole leaf.
    """
    named = docs.select(
        F.col(key).alias("key"), F.concat_ws("/", *(F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in levels)).alias("path"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("?")).alias(f"level{i}") for i, c in enumerate(levels)),
        F.greatest(F.coalesce(F.col(tokens), F.lit(0)), F.lit(0)).cast("bigint").alias("tokens"),
    )
    leaves = materialize(named.groupBy("path", *(f"level{i}" for i in range(len(levels)))).agg(F.sum("tokens").alias("tokens")), "leaves")
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    plan = materialize(plan_leaves(leaves, tuple(f"level{i}" for i in range(len(levels))), weights, total * budget_per_mille // 1000, max_epochs), "plan")
    # the epoch that is cut short has the leaf's number of whole epochs
    placed = named.select("key", "path", "tokens").join(plan.select("path", "epochs", "rest"), "path").withColumn(
        "place", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.col("key").cast("string")))
    ).withColumn("group", F.substring("place", 1, GROUP_DIGITS))
    before = Window.partitionBy("path").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = placed.groupBy("path", "group").agg(F.sum("tokens").alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    placed = placed.join(groups, ["path", "group"])
    inside = (F.col("start") < F.col("rest")) & (F.col("start") + F.col("n") > F.col("rest"))
    within = Window.partitionBy("path", "group").orderBy("place", "key").rowsBetween(Window.unboundedPreceding, -1)
    cut = placed.where(inside).withColumn("at", F.col("start") + F.coalesce(F.sum("tokens").over(within), F.lit(0)))
    whole = placed.where(~inside).withColumn("at", F.col("start"))

    def chosen(rows: DataFrame, part: Column) -> DataFrame:
        return rows.select(
            F.col("key").alias(key), "path", "tokens",
            (F.col("epochs") + F.when(F.col("at") < F.col("rest"), 1).otherwise(0)).cast("int").alias("copies"),
            (F.col("epochs") * F.col("tokens") + part).cast("bigint").alias("taken"),
        )

    return chosen(whole, F.when(F.col("at") < F.col("rest"), F.col("tokens")).otherwise(0)).unionByName(
        chosen(cut, F.greatest(F.lit(0), F.least("tokens", F.col("rest") - F.col("at"))))
    )


def with_levels(docs: DataFrame) -> DataFrame:
    """documents with the tree's levels: a source's number modulo 4 is its domain. Tokens are words between spaces.

    Columns of the levels' names and ``tokens`` are replaced, others kept. A source without a number, or null, has the domain "?";
    a null or empty text has no tokens.
    """
    made = {*LEVELS, "tokens"}
    number = F.regexp_extract(F.coalesce("source", F.lit("")), r"(\d{1,9})$", 1)
    return docs.select(
        *(c for c in docs.columns if c not in made),
        F.when(number == "", "?").otherwise(F.concat(F.lit("d"), number.cast("int") % 4)).alias("domain"),
        F.col("lang").alias("language"), F.col("source").alias("origin"),
        F.when(F.coalesce("text", F.lit("")) == "", 0).otherwise(F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1).cast("bigint").alias("tokens"),
    )


def op4_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_levels(table(spark, sf_dir, "documents")).select("doc_id", *LEVELS, "tokens")
    return mix(materialize(docs, "levels"), LEVELS, WEIGHTS, BUDGET_PER_MILLE)


def _fill_sql(name: str, nodes: str) -> str:
    """The same water-filling over a node table (path, parent, capacity, weight, budget)."""
    o = "partition by parent order by capacity / weight, path"
    return f"""
{name}a as (select *, budget - coalesce(sum(capacity) over ({o} rows between unbounded preceding and 1 preceding), 0) as l,
    sum(weight) over ({o} rows between current row and unbounded following) as w from {nodes}),
{name}b as (select *, capacity::hugeint * w <= weight::hugeint * l as f from {name}a),
{name}c as (select *, budget - sum(case when f then capacity else 0 end) over (partition by parent) as r,
    sum(case when f then 0 else weight end) over (partition by parent) as ow,
    sum(case when f then 0 else weight end) over ({o} rows between unbounded preceding and current row) as upto from {name}b),
{name} as (select path, (case when f then capacity else (r::hugeint * upto) // ow - (r::hugeint * (upto - weight)) // ow end)::bigint as given from {name}c)"""


_WEIGHT_ROWS = ", ".join(f"('{k}', {v})" for k, v in WEIGHTS.items())
SQL = {
    "op4_mixture": f"""
with t as (select doc_id, case when regexp_extract(coalesce(source, ''), '(\\d{{1,9}})$', 1) = '' then '?'
        else 'd' || (regexp_extract(source, '(\\d{{1,9}})$', 1)::int % 4) end as p0, coalesce(lang, '?') as p1, coalesce(source, '?') as p2,
        (case when coalesce(text, '') = '' then 0 else length(text) - length(replace(text, ' ', '')) + 1 end)::bigint as tokens from documents),
d as (select doc_id, p0, p0 || '/' || p1 as p1, p0 || '/' || p1 || '/' || p2 as p2, tokens from t),
wt(path, weight) as (values {_WEIGHT_ROWS}),
b as (select (sum(tokens) * {BUDGET_PER_MILLE} // 1000)::bigint as budget from d),
n0 as (select x.path, '' as parent, x.capacity, coalesce(weight, 1) as weight, budget from
    (select p0 as path, sum(tokens) * {MAX_EPOCHS} as capacity from d group by all) x left join wt using (path), b),
{_fill_sql("g0", "n0")},
n1 as (select x.path, x.parent, x.capacity, coalesce(weight, 1) as weight, given as budget from
    (select p1 as path, p0 as parent, sum(tokens) * {MAX_EPOCHS} as capacity from d group by all) x left join wt using (path) join g0 on g0.path = x.parent),
{_fill_sql("g1", "n1")},
n2 as (select x.path, x.parent, x.capacity, coalesce(weight, 1) as weight, given as budget from
    (select p2 as path, p1 as parent, sum(tokens) * {MAX_EPOCHS} as capacity from d group by all) x left join wt using (path) join g1 on g1.path = x.parent),
{_fill_sql("g2", "n2")},
leaf as (select path, sum(tokens)::bigint as have, any_value(given) as quota from d join g2 on path = p2 group by path),
pl as (select path, case when have > 0 then quota // have else 0 end as epochs, case when have > 0 then quota % have else 0 end as rest from leaf),
o as (select doc_id, path, tokens, epochs, rest, coalesce(sum(tokens) over (partition by path
    order by md5('{SEED}:' || epochs || ':' || doc_id), doc_id rows between unbounded preceding and 1 preceding), 0) as pos from d join pl on path = p2)
select doc_id, path, tokens, (epochs + (pos < rest)::int)::int as copies,
    (epochs * tokens + greatest(0, least(tokens, rest - pos)))::bigint as taken from o"""
}
QUERIES = {"op4_mixture": op4_mixture}

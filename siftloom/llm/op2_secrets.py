"""Secret scan with corpus-wide ownership frequency, in DataFrame functions alone.

Candidates are found in each text by patterns. Their hashes are counted over the corpus by distinct
owners and repositories: a value that many owners hold is a copied example; one that a single owner
holds and that has enough different characters looks live. Bare tokens, which no pattern of a known
kind covers, become spans only by that verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftloom.session import materialize, table

#: Kinds in the order in which spans that start together are listed: pattern, shortest value, group of the value.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
BARE = r"[A-Za-z0-9_-]{20,}"
KINDS = (("assign", ASSIGN, 12, 2), ("access", ACCESS, 18, 0), ("hex", HEX, 16, 0), ("bare", BARE, 20, 0))
BASE = ("assign", "access", "hex")
#: A value of so many owners or more is an example; one of this many or fewer may be live.
EXAMPLE_OWNERS, LIVE_OWNERS = 3, 1
#: Different characters that a live-looking value has at least.
LIVE_CHARACTERS = 8

_SPAN = "struct<kind:string,rank:int,start:int,end:int,value:string>"


def _spans(text: Column, kind: str, rank: int, pattern: str, shortest: int, group: int) -> Column:
    """Spans of a pattern's matches, in code points, with their values.

    The text between matches and the matches take turns, so their lengths, added up, are the places.
    """
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("found"))

    def add(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["gap"])
        end = start + F.length(part["hit"])
        span = F.struct(F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), start.alias("start"), end.alias("end"), part["value"].alias("value"))
        found = F.when(F.length(part["value"]) >= shortest, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct(F.coalesce(end, state["at"]).alias("at"), found.alias("found"))

    spans = F.aggregate(F.filter(parts, lambda p: p["hit"].isNotNull()), nothing, add)["found"]
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(f"array<{_SPAN}>"))


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``found``: the spans of all kinds, by start, then kind. Bare tokens need a letter and a digit, and none of them
    overlaps a span of a known kind. A null text has no spans."""
    whole = F.coalesce(F.col(text), F.lit(""))
    made = docs.select("*", *(_spans(whole, k, i, p, n, g).alias(f"_{k}") for i, (k, p, n, g) in enumerate(KINDS)))
    known = F.concat(*(F.col(f"_{k}") for k in BASE))
    apart = F.filter(
        "_bare",
        lambda b: b["value"].rlike("[0-9]") & b["value"].rlike("[A-Za-z]") & ~F.exists(known, lambda s: (s["start"] < b["end"]) & (b["start"] < s["end"])),
    )

    def order(a: Column, b: Column) -> Column:
        return F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["rank"] - b["rank"])

    return made.withColumn("found", F.array_sort(F.concat(known, apart), order)).drop(*(f"_{k}" for k, *_ in KINDS))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repos, n_seen) of (hash, owner, repo) rows.

    Each level is a partial aggregate over the one below, so a value that a third of all rows hold is
    one row for each task before it is shuffled.
    """
    return (
        found.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n"))
        .groupBy("hash", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"))
        .groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"), F.sum("n").alias("n_seen"))
    )


def scan_secrets(docs: DataFrame, text: str = "text", owner: str = "owner", repo: str = "repo", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row for each row of ``docs``: the columns ``keep`` and ``secrets``, an array by place of
    struct<kind, rank, start, end, verdict, n_owners, n_repos, n_seen>; ``verdict`` is example, live or shared.

    Bare tokens are there only if they look live. Repeated rows and ids stay apart; null owners and
    repositories count as one of each; null and empty texts have an empty array; of an empty table
    nothing comes. Other columns are left out, whatever their names.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), *(F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)),
        F.coalesce(F.col(owner).cast("string"), F.lit("?")).alias("_owner"), F.coalesce(F.col(repo).cast("string"), F.lit("?")).alias("_repo"),
        F.col(text).alias("_text"),
    )
    hashed = F.transform(
        "found",
        lambda s: F.struct(
            s["kind"].alias("kind"), s["rank"].alias("rank"), s["start"].alias("start"), s["end"].alias("end"), F.sha2(s["value"], 256).alias("hash"),
            (F.size(F.array_distinct(F.split(s["value"], ""))) >= LIVE_CHARACTERS).alias("varied"),
        ),
    )
    stored = materialize(candidates(rows, "_text").select("_row", "_owner", "_repo", *(f"_k{i}" for i in range(len(keep))), hashed.alias("found")), "candidates")
    spans = stored.select("_row", F.col("_owner").alias("owner"), F.col("_repo").alias("repo"), F.explode("found").alias("s")).select("_row", "owner", "repo", "s.*")
    verdict = (
        F.when(F.col("n_owners") >= EXAMPLE_OWNERS, "example")
        .when((F.col("n_owners") <= LIVE_OWNERS) & F.col("varied"), "live").otherwise("shared")
    )
    judged = spans.drop("owner", "repo").join(ownership(spans.select("hash", "owner", "repo")), "hash").withColumn("verdict", verdict)
    fields = ("start", "rank", "end", "kind", "verdict", "n_owners", "n_repos", "n_seen")
    of_row = judged.where("kind <> 'bare' or verdict = 'live'").groupBy("_row").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("secrets"))
    empty = F.array().cast(of_row.schema["secrets"].dataType)
    return stored.drop("found").join(of_row, "_row", "left").select(
        *(F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)), F.coalesce("secrets", empty).alias("secrets")
    )


def op2_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The owner of a document is its source, its repository the source's part in one language."""
    source, lang = F.coalesce("source", F.lit("?")), F.coalesce("lang", F.lit("?"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", source.alias("owner"), F.concat_ws("/", source, lang).alias("repo"))

    def n(field: str, value: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s[field] == value)).cast("long")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    known = F.filter("secrets", lambda s: s["kind"] != "bare")
    return scan_secrets(docs).select(
        "doc_id", *(n("kind", k).alias(f"n_{k}") for k in BASE),
        F.sha2(joined(known), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"),
        n("verdict", "live").alias("n_live"), n("verdict", "example").alias("n_example"),
    )


def _sql_kind(kind: str, rank: int, pattern: str, shortest: int, group: int) -> str:
    p = pattern.replace("'", "''")
    return f"""select rid, '{kind}' as kind, {rank} as rank, unnest(regexp_extract_all(t, '{p}')) as m,
        unnest(regexp_extract_all(t, '{p}', {group})) as v, unnest(string_split_regex(t, '{p}')[:-2]) as g,
        unnest(range(len(regexp_extract_all(t, '{p}')))) as i, {shortest} as shortest from d where regexp_matches(t, '{p}')"""


SQL = {
    "op2_secret_ownership": f"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t, coalesce(source, '?') as owner,
        coalesce(source, '?') || '/' || coalesce(lang, '?') as repo from documents),
m as ({" union all ".join(_sql_kind(k, i, p, n, g) for i, (k, p, n, g) in enumerate(KINDS))}),
e as (select *, sum(length(g) + length(m)) over (partition by rid, kind order by i) as e from m),
s as (select rid, kind, rank, (e - length(m))::bigint as b, e::bigint as e, v, d.owner, d.repo from e join d using (rid) where length(v) >= shortest),
c as (select * from s where kind <> 'bare' union all
      select * from s where kind = 'bare' and regexp_matches(v, '[0-9]') and regexp_matches(v, '[A-Za-z]')
        and not exists (select 1 from s as x where x.rid = s.rid and x.kind <> 'bare' and x.b < s.e and s.b < x.e)),
o as (select v, count(distinct owner) as n_owners from c group by v),
j as (select c.*, case when n_owners >= {EXAMPLE_OWNERS} then 'example'
        when n_owners <= {LIVE_OWNERS} and len(list_distinct(string_split(v, ''))) >= {LIVE_CHARACTERS} then 'live' else 'shared' end as verdict
      from c join o using (v)),
r as (select rid, kind, rank, b, e, verdict, kind || ':' || b || ':' || e as said from j where kind <> 'bare' or verdict = 'live'),
a as (select rid, count(*) filter (where kind = 'assign') as n_assign, count(*) filter (where kind = 'access') as n_access,
        count(*) filter (where kind = 'hex') as n_hex, string_agg(said, ',' order by b, rank) filter (where kind <> 'bare') as base,
        string_agg(said, ',' order by b, rank) as spans, count(*) filter (where verdict = 'live') as n_live,
        count(*) filter (where verdict = 'example') as n_example from r group by rid)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
    sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live, coalesce(n_example, 0) as n_example
from d left join a using (rid)"""
}
QUERIES = {"op2_secret_ownership": op2_secret_ownership}

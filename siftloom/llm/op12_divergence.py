"""Quality rules by divergence from a language's habits, in DataFrame functions alone.

Base rules count words, symbols, repeated lines and repeated runs of words. A document that passes them is
compared with its language: two histograms, of classes of characters and of the language's commonest words,
by their Jensen-Shannon distance from the language's own. A short text strays by chance, by about the number of its
bins over its length, so what is allowed falls with the length; documents and languages below a least length aren't judged.

A language's histograms are medians over sixteen parts of its documents, dealt by a hash of the text: copies
of one text, however many, sway one part. Words are never shuffled but once, as counts, to find the common ones;
everything about a document is counted in its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftloom.session import materialize, table

#: Characters between words, and symbols of the base rules.
BLANK, SYMBOL = r"\x20\x09-\x0D", r"#*$%&|<>"
#: Classes of characters; what is in none is the last bin. Fixed values of this rule.
CLASSES = (
    ("lower", "a-z"), ("space", r"\x20"), ("break", r"\x09-\x0D"), ("upper", "A-Z"), ("digit", "0-9"), ("mark", ".,;:!?'\"()\\-"),
    ("symbol", SYMBOL), ("beyond", r"^\x00-\x7F"),
)
#: Base rules: fewest words, most words in repeated windows of each hundred, words in a window.
LEAST_WORDS, MOST_REPEATED, WINDOW = 50, 50, 3
#: Common words of a language; fewest words of a language that judges.
COMMON, LEAST_REFERENCE = 64, 2000
#: Most squared distance of a long text, and what is added over the number of words, for characters and for words.
CHARS_FAR, CHARS_CHANCE, WORDS_FAR, WORDS_CHANCE = 0.04, 5.0, 0.06, 10.0


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{BLANK}]+", -1), "")


def common_words(docs: DataFrame, text: str = "text", lang: str = "lang", n: int = COMMON) -> DataFrame:
    """(lang, common): the ``n`` commonest words of each language's documents of at least ``LEAST_WORDS`` words, ties by the word.

    Counts are partial sums before they are shuffled, and each task ranks its own ``n`` before a language's meet.
    """
    words = _words(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.coalesce(F.col(lang), F.lit("?")).alias("lang"), words.alias("words")).where(F.size("words") >= LEAST_WORDS)
    counts = rows.select("lang", F.explode("words").alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = counts.withColumn("at", rank).where(F.col("at") <= n)
    return top.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]).alias("common"))


def measure(docs: DataFrame, common: DataFrame, text: str = "text", lang: str = "lang", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(``keep``..., lang, part, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_chars, classes, hits) of each row.

    ``classes`` has the characters of each class and of none, ``hits`` the language's common words and all others; null where the
    language has no common words. Null and empty texts have no words; texts of any length are taken whole, in their own row.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)), F.coalesce(F.col(lang), F.lit("?")).alias("lang"), whole.alias("t"))
    rows = rows.join(common, "lang", "left").select(
        "*", F.conv(F.substring(F.md5("t"), 1, 1), 16, 10).cast("int").alias("part"), _words(F.col("t")).alias("words"),
        F.filter(F.split("t", "\n", -1), lambda x: x.rlike(f"[^{BLANK}]")).alias("lines"),
    )
    # classes are counted in what the ones before have left, so most texts are gone through twice
    left, classes = "t", []
    for i, (name, chars) in enumerate(CLASSES):
        rows = rows.withColumn(f"_t{i}", F.regexp_replace(left, f"[{chars}]+", "")).withColumn(f"_c{i}", F.length(left) - F.length(f"_t{i}"))
        left = f"_t{i}"
        classes.append(f"_c{i}")
    symbols = classes[[name for name, _ in CLASSES].index("symbol")]
    n = F.size("words")
    rows = rows.select(
        *(c for c in rows.columns if not c.startswith("_t") and c not in ("t", "lines")),
        F.array(*classes, F.length(left)).alias("classes"), F.length("t").alias("n_chars"), (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.transform(F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))), lambda i: F.xxhash64(*(F.get("words", i + k) for k in range(WINDOW)))).alias("hashes"),
        F.array_intersect("common", "words").alias("there"),
    )
    # windows are sorted, by their hashes first, only where two hashes are equal; elsewhere no window is repeated
    windows = F.arrays_zip(
        "hashes", *(F.slice("words", k + 1, F.greatest(n - (WINDOW - 1), F.lit(0))).alias(f"w{k}") for k in range(WINDOW)), F.sequence(F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(1))).alias("at")
    )
    rows = rows.withColumn("windows", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), F.sort_array(windows))).drop("hashes")

    def same(i: Column) -> Column:
        """Whether the sorted window i equals the one before."""
        a, b = F.get("windows", i), F.get("windows", i - 1)
        equal = a["w0"] == b["w0"]
        for k in range(1, WINDOW):
            equal = equal & (a[f"w{k}"] == b[f"w{k}"])
        return F.coalesce(equal, F.lit(False))

    rows = rows.withColumn("again", F.filter(F.sequence(F.lit(0), F.size("windows") - 1), same))
    # windows that equal a neighbour, by place; each adds the words that the one before doesn't reach
    at = lambda i: F.get("windows", i)["at"]
    places = F.sort_array(F.array_distinct(F.concat(F.transform("again", at), F.transform("again", lambda i: at(i - 1)))))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    reach = WINDOW - 1
    repeated = F.aggregate(places, start, lambda s, p: F.struct((p + reach).alias("end"), (s["n"] + p + reach - F.greatest(s["end"], p - 1)).alias("n")))["n"]
    hits = F.transform("common", lambda c: F.when(F.array_contains("there", c), n - F.size(F.array_remove("words", c))).otherwise(0))
    rows = rows.select(
        *(F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)), "lang", "part", n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"), F.col(symbols).cast("long").alias("n_symbols"), F.col("n_dup_lines").cast("long").alias("n_dup_lines"),
        F.coalesce(repeated, F.lit(0)).cast("long").alias("n_repeat_words"), F.col("n_chars").cast("long").alias("n_chars"), "classes",
        F.when(F.col("common").isNotNull(), hits).alias("hits"),
    )
    others = F.col("n_words").cast("int") - F.aggregate("hits", F.lit(0), lambda a, b: a + b)
    rows = rows.withColumn("hits", F.concat("hits", F.array(others)))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def references(measured: DataFrame) -> DataFrame:
    """(lang, class_share, hit_share) of each language with enough words in documents that pass the base rules.

    A share is the median of its parts' shares, and all shares of a histogram are scaled to 1.
    """
    good = measured.where("not base_failed and hits is not null")
    totals = good.groupBy("lang", "part").agg(F.sum("n_words").alias("words"), F.sum("n_chars").alias("chars"))
    enough = totals.groupBy("lang").agg(F.sum("words").alias("all")).where(F.col("all") >= LEAST_REFERENCE).select("lang")
    bins = good.select("lang", "part", F.posexplode(F.concat("classes", "hits")).alias("bin", "n")).groupBy("lang", "part", "bin").agg(F.sum("n").alias("n"))
    of_class = F.col("bin") <= len(CLASSES)
    shares = bins.join(totals, ["lang", "part"]).join(enough, "lang").select("lang", "bin", (F.col("n") / F.when(of_class, F.col("chars")).otherwise(F.col("words"))).alias("share"))
    medians = shares.groupBy("lang", "bin").agg(F.median("share").alias("share"))
    lists = medians.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("bin", "share"))).alias("all"))

    def scaled(these: Column) -> Column:
        values = F.transform(these, lambda x: x["share"])
        return F.transform(values, lambda x: x / F.aggregate(values, F.lit(0.0), lambda a, b: a + b))

    classes = F.filter("all", lambda x: x["bin"] <= len(CLASSES))
    return lists.select("lang", scaled(classes).alias("class_share"), scaled(F.filter("all", lambda x: x["bin"] > len(CLASSES))).alias("hit_share"))


def divergence(counts: Column, total: Column, shares: Column) -> Column:
    """Squared Jensen-Shannon distance, in bits, of a histogram of counts from one of shares; null where there are no shares."""

    def term(n: Column, q: Column) -> Column:
        p = n / total
        m = (p + q) / 2
        return (F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)) / 2

    return F.when(shares.isNotNull(), F.greatest(F.lit(0.0), F.aggregate(F.zip_with(counts, shares, term), F.lit(0.0), lambda a, b: a + b)))


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts of ``measure``, the two squared distances and ``kept`` of each row of ``docs``, with the columns ``keep``.

    A null language is one of its own; a language without enough words has no distances, and its documents are kept if they pass
    the base rules. Repeated rows each have their row; other columns are left out, whatever their names; of an empty table nothing comes.
    """
    measured = materialize(measure(docs, materialize(common_words(docs, text, lang), "common"), text, lang, keep), "measured")
    rows = measured.join(materialize(references(measured), "references"), "lang", "left")
    rows = rows.withColumns({
        "chars_far": F.when(~F.col("base_failed"), divergence(F.col("classes"), F.col("n_chars"), F.col("class_share"))),
        "words_far": F.when(~F.col("base_failed"), divergence(F.col("hits"), F.col("n_words"), F.col("hit_share"))),
    })
    near = (F.col("chars_far") <= CHARS_FAR + CHARS_CHANCE / F.col("n_words")) & (F.col("words_far") <= WORDS_FAR + WORDS_CHANCE / F.col("n_words"))
    return rows.withColumn("kept", ~F.col("base_failed") & F.coalesce(near, F.lit(True)))


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op12_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; distances in thousandths, squared ones rooted."""
    rows = judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    milli = lambda c: F.floor(F.sqrt(c) * 1000).cast("long")
    return rows.select("doc_id", *COLUMNS, milli(F.col("chars_far")).alias("chars_distance"), milli(F.col("words_far")).alias("words_distance"))


def _sql() -> str:
    """The same rules in SQL: every word and line is a row there."""
    left, steps = "t", []
    for i, (_, chars) in enumerate(CLASSES):
        c = chars.replace("'", "''")
        steps.append(f"k{i} as (select *, regexp_replace({left}, '[{c}]+', '', 'g') as t{i} from {'d' if not i else f'k{i - 1}'})")
        left = f"t{i}"
    bins = [f"length({'t' if not i else f't{i - 1}'}) - length(t{i})" for i in range(len(CLASSES))] + [f"length({left})"]
    symbol = bins[[name for name, _ in CLASSES].index("symbol")]
    term = "(case when p > 0 then p * log2(p / ((p + q) / 2)) else 0 end + case when q > 0 then q * log2(q / ((p + q) / 2)) else 0 end) / 2"
    return f"""
with d as (select row_number() over () as rid, doc_id, coalesce(lang, '?') as lang, coalesce(text, '') as t, ('0x' || md5(coalesce(text, ''))[1])::int as part from documents),
{", ".join(steps)},
c0 as (select rid, lang, part, length(t) as chars, [{", ".join(bins)}] as ns, {symbol} as n_symbols from k{len(CLASSES) - 1}),
w0 as (select rid, lang, part, list_filter(regexp_split_to_array(t, '[{BLANK}]+'), lambda x: x <> '') as ws from d),
w as (select rid, lang, part, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as ps from w0),
nw as (select rid, lang, part, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars from w0),
li as (select rid, count(*) - count(distinct line) as n_dup_lines from (select rid, unnest(string_split(t, chr(10))) as line from d)
    where regexp_matches(line, '[^{BLANK}]') group by rid),
win as (select rid, ps, word as a, lead(word) over (partition by rid order by ps) as b, lead(word, 2) over (partition by rid order by ps) as c from w),
tw as (select rid, ps from (select rid, ps, count(*) over (partition by rid, a, b, c) as n from win where c is not null) where n > 1),
rp as (select rid, count(distinct ps) as n_repeat_words from (select rid, ps + o as ps from tw, (values (0), (1), (2)) as os(o)) group by rid),
b as (select d.rid, d.doc_id, d.lang, d.part, n_words, word_chars, n_symbols, chars, coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
    n_words < {LEAST_WORDS} or 100 * coalesce(n_repeat_words, 0) > {MOST_REPEATED} * n_words as base_failed
    from d join nw using (rid) join c0 using (rid) left join li using (rid) left join rp using (rid)),
top as (select lang, word, ps from (select w.lang, word, row_number() over (partition by w.lang order by count(*) desc, word) as ps
    from w join nw using (rid) where n_words >= {LEAST_WORDS} group by w.lang, word) where ps <= {COMMON}),
found as (select rid, top.ps, count(*) as n from w join top using (lang, word) group by rid, top.ps),
h as (select b.rid, b.lang, b.part, top.ps + {len(CLASSES)} as bin, coalesce(found.n, 0) as n from b join top using (lang) left join found on found.rid = b.rid and found.ps = top.ps),
o as (select b.rid, b.lang, b.part, m.m + {len(CLASSES) + 1} as bin, n_words - coalesce(k, 0) as n from b join (select lang, max(ps) as m from top group by lang) m using (lang)
    left join (select rid, sum(n) as k from found group by rid) using (rid)),
g as (select rid, lang, part, unnest(range({len(CLASSES) + 1})) as bin, unnest(ns) as n from c0 where lang in (select lang from top)),
bins as (select * from h union all select * from o union all select * from g),
tot as (select lang, part, sum(n_words) as words, sum(chars) as chars from b where not base_failed and lang in (select lang from top) group by lang, part),
enough as (select lang from tot group by lang having sum(words) >= {LEAST_REFERENCE}),
share as (select lang, part, bin, sum(n) / (case when bin <= {len(CLASSES)} then any_value(tot.chars) else any_value(tot.words) end) as s
    from bins join tot using (lang, part) join b using (rid, lang, part) join enough using (lang) where not base_failed group by lang, part, bin),
med as (select lang, bin, median(s) as s from share group by lang, bin),
ref as (select lang, bin, s / sum(s) over (partition by lang, bin <= {len(CLASSES)}) as q from med),
pq as (select rid, bin <= {len(CLASSES)} as cls, n / (case when bin <= {len(CLASSES)} then b.chars else n_words end) as p, q
    from bins join ref using (lang, bin) join b using (rid) where not base_failed),
js as (select rid, greatest(0, sum({term}) filter (where cls)) as cf, greatest(0, sum({term}) filter (where not cls)) as wf from pq group by rid)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines,
    n_repeat_words::bigint as n_repeat_words, base_failed,
    not base_failed and coalesce(cf <= {CHARS_FAR} + {CHARS_CHANCE} / n_words and wf <= {WORDS_FAR} + {WORDS_CHANCE} / n_words, true) as kept,
    floor(sqrt(cf) * 1000)::bigint as chars_distance, floor(sqrt(wf) * 1000)::bigint as words_distance
from b left join js using (rid)"""


SQL = {"op12_quality_divergence": _sql()}
QUERIES = {"op12_quality_divergence": op12_quality_divergence}

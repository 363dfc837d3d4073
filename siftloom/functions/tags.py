"""Columns over tag lists: arrays of struct<tag, score>, in order; scores may be null."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of tags that never describe a character's core.
CORE_STOP_WORDS = [
    "solo", "1girl", "1boy", "2girls", "2boys", "3girls", "3boys", "girls", "boys", "body", "background", "quality", "chibi",
    "monochrome", "comic", "looking", "text", "signature", "peeking", "focus", "smile", "mouth", "anime", "screenshot", "sky",
    "wall", "tree", "cloud", "day", "night", "indoors", "outdoors", "close-up", "window", "curtains", "forest", "sitting",
    "standing", "portrait",
]
#: Fixed value: the one tag whose underscore is part of it.
KEEPS_UNDERSCORE = "^_^"


def is_people(tag: Column) -> Column:
    """Whether a tag counts people."""
    return tag.contains("girls") | tag.contains("boys") | tag.isin("1girl", "1boy")


def remove_underscore(tags: Column) -> Column:
    return F.transform(
        tags, lambda t: F.struct(F.when(t["tag"] == KEEPS_UNDERSCORE, t["tag"]).otherwise(F.replace(t["tag"], F.lit("_"), F.lit(" "))).alias("tag"), t["score"].alias("score"))
    )


def drop_blacklisted(tags: Column, blacklist: Column) -> Column:
    """Drops tags that are listed as they are, with underscores or with spaces."""
    return F.filter(
        tags,
        lambda t: ~(
            F.array_contains(blacklist, t["tag"]) | F.array_contains(blacklist, F.replace(t["tag"], F.lit(" "), F.lit("_")))
            | F.array_contains(blacklist, F.replace(t["tag"], F.lit("_"), F.lit(" ")))
        ),
    )


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it stands there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


#: Longest name whose parts are listed; a longer one is searched for each name instead.
LISTED = 48


def proper_parts(names: Column) -> Column:
    """Those of an array's distinct names that are a proper part of another one.

    All parts of the names are listed, about half the square of a name's length for each, and met with the names by hash: the work
    grows with the number of names, not with its square. Only names over ``LISTED`` characters are compared with each other name.
    """
    none = F.array().cast("array<string>")

    def parts(u: Column) -> Column:
        n = F.length(u)
        of_length = lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda at: F.substring(u, at, k))
        return F.when((n > 1) & (n <= LISTED), F.flatten(F.transform(F.sequence(F.lit(1), n - 1), of_length))).otherwise(none)

    def found(all_names: Column) -> Column:
        short = F.array_intersect(all_names, F.flatten(F.transform(all_names, parts)))
        of_long = lambda long: F.when(F.size(long) > 0, F.filter(all_names, lambda t: F.exists(long, lambda u: u.contains(t) & (u != t)))).otherwise(none)
        return F.array_union(short, once(F.filter(all_names, lambda u: F.length(u) > LISTED), of_long))

    return once(F.array_distinct(F.filter(names, lambda t: t.isNotNull())), found)


def drop_overlap(tags: Column, partners: Column) -> Column:
    """Drops a tag if a partner of it is there, or if it is a proper part of another tag. Both look at all tags given.

    ``partners``: map<tag with underscores, array of tags with underscores>.
    """

    def kept(ts: Column, seen: Column) -> Column:
        def stays(t: Column) -> Column:
            others = F.element_at(partners, F.replace(t["tag"], F.lit(" "), F.lit("_")))
            paired = F.coalesce(F.arrays_overlap(others, seen["lined"]), F.lit(False))
            return ~paired & ~F.coalesce(F.array_contains(seen["parts"], t["tag"]), F.lit(False))

        return F.filter(ts, stays)

    def looked(ts: Column) -> Column:
        names = F.transform(ts, lambda t: t["tag"])
        lined = F.array_distinct(F.transform(ts, lambda t: F.replace(t["tag"], F.lit(" "), F.lit("_"))))
        return once(F.struct(lined.alias("lined"), proper_parts(names).alias("parts")), lambda seen: kept(ts, seen))

    return once(tags, looked)


def sort_tags(tags: Column, mode: str = "score", row: Column | None = None, seed: int = 0) -> Column:
    """``solo``, tags that count people, then the rest: as given (original), by score, stable (score), or by a seeded hash of row and tag (shuffle)."""
    keyed = F.transform(
        tags,
        lambda t, i: F.struct(
            F.when(t["tag"] == "solo", 0).when(is_people(t["tag"]), 1).otherwise(2).alias("part"),
            _rank(t, mode, row, seed).alias("rank"), i.alias("at"), t["tag"].alias("tag"), t["score"].alias("score"),
        ),
    )
    return F.transform(F.array_sort(keyed), lambda t: F.struct(t["tag"].alias("tag"), t["score"].alias("score")))


def _rank(tag: Column, mode: str, row: Column | None, seed: int) -> Column:
    people = (tag["tag"] == "solo") | is_people(tag["tag"])
    if mode == "original":
        return F.lit(0.0)
    if mode == "score":
        return F.when(people, 0.0).otherwise(-F.coalesce(tag["score"], F.lit(0.0)))
    if mode == "shuffle":
        return F.when(people, 0.0).otherwise(uniform(row, tag["tag"], seed))
    raise ValueError(f"no such order of tags: {mode}")


def uniform(row: Column, name: Column, seed: int) -> Column:
    """A number from 0 to 1 that depends on a row, a name and a seed alone."""
    return F.shiftrightunsigned(F.xxhash64(row, name, F.lit(seed)), 11) / F.lit(float(1 << 53))


def append_and_truncate(tags: Column, dropped: Column | None, most: int | None) -> Column:
    """Dropped tags after the others, then one limit; none if it is null or 0."""
    both = tags if dropped is None else F.concat(tags, F.coalesce(dropped, F.array().cast("array<struct<tag:string,score:double>>")))
    return F.slice(both, F.lit(1), F.lit(most)) if most else both


def tag_source(tags: Column, processed: Column, from_original: bool, overwrite: bool) -> Column:
    """The list to work on: the original one if asked for, else the processed one, else the original; null if there is neither."""
    return tags if from_original or overwrite else F.coalesce(processed, tags)


def overwrite_tags(old: Column, new: Column, force: bool) -> Column:
    return new if force else F.coalesce(old, new)


def _folded(tag: Column) -> Column:
    """The words of a tag, without empty ones."""
    return F.filter(F.split(F.lower(tag), r"[\s_]+", -1), lambda x: x != "")


def has_suffix(tag: Column, suffix: str) -> Column:
    """Whether the tag's last words are those of ``suffix``."""
    words = _folded(F.lit(suffix))
    return F.slice(_folded(tag), -F.least(F.size(words), F.size(_folded(tag))), F.size(words)) == words


def has_prefix(tag: Column, prefix: str) -> Column:
    words = _folded(F.lit(prefix))
    return F.slice(_folded(tag), F.lit(1), F.size(words)) == words


def word_forms(words: list[str]) -> list[str]:
    """The words with their regular plurals and singulars, by the ending of the last letter; a small rule table expanded once."""
    out: list[str] = []
    for w in words:
        plural = w + "es" if w.endswith(("s", "x", "z", "ch", "sh")) else w[:-1] + "ies" if w.endswith("y") and w[-2:-1] not in "aeiou" else w + "s"
        single = w[:-3] + "y" if w.endswith("ies") else w[:-2] if w.endswith(("ses", "xes", "zes", "ches", "shes")) else w[:-1] if w.endswith("s") and not w.endswith("ss") else w
        out += [x for x in (w, single, plural) if x not in out]
    return out


def is_character_tag(tag: Column, whitelist: list[str], suffixes: list[str], prefixes: list[str], force: bool = False) -> Column:
    """Whether a tag describes a character: with a listed ending (or its plural or singular) or beginning of whole words, and not listed as exempt.
    With ``force`` every tag does."""
    if force:
        return F.lit(True)
    found = F.lit(False)
    for s in word_forms(suffixes):
        found = found | has_suffix(tag, s)
    for p in prefixes:
        found = found | has_prefix(tag, p)
    return found & ~tag.isin(*whitelist) if whitelist else found


def rename_values(values: Column, mapping: Column) -> Column:
    """Values through a map; those it lacks, or maps to an empty text, stay."""

    def new(x: Column) -> Column:
        to = F.element_at(mapping, x)
        return F.when(to.isNull() | (to == ""), x).otherwise(to)

    return F.transform(values, new)


def n_people(tags: Column) -> Column:
    """Largest number before girls plus largest before boys, ``many`` from six on, as text; ``tags`` are names."""

    def most(kind: str) -> Column:
        named = F.filter(tags, lambda t: t.contains(kind))
        found = F.transform(named, lambda t: F.coalesce(F.regexp_extract(t, rf"^(\d+)\+?{kind}s?$", 1).try_cast("int"), F.lit(0)))
        return F.coalesce(F.array_max(found), F.lit(0))

    total = most("girl") + most("boy")
    return F.when(total >= 6, "many").otherwise(total.cast("string"))


def drop_before(tags: Column, marks: list[str]) -> Column:
    """Names from the first one on that is in ``marks``; all of them if none is."""
    first = F.array_min(F.filter(F.transform(F.array(*map(F.lit, marks)), lambda m: F.array_position(tags, m)), lambda p: p > 0))
    return F.when(first.isNull(), tags).otherwise(F.slice(tags, F.coalesce(first, F.lit(1)).cast("int"), F.greatest(F.size(tags), F.lit(1))))

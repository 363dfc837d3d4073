"""Caption parts and captions, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftloom.functions.tags import uniform

ORDER = ("npeople", "characters", "copyright", "type", "artist", "rating", "crop", "tags")
#: Names that stand for no name.
NO_NAMES = ["anonymous", "unknown"]


def _known(names: Column) -> Column:
    return F.filter(names, lambda x: ~x.isin(*NO_NAMES))


def part_npeople(n: Column) -> Column:
    return F.concat(n.cast("string"), F.when(n == 1, "person").otherwise("people"))


def part_characters(names: Column, sep: str, allowed: Column | None = None) -> Column:
    """Names joined; only the allowed ones, if there is a list, else all but unknown."""
    kept = F.filter(names, lambda x: x != "unknown") if allowed is None else F.filter(names, lambda x: F.array_contains(allowed, x))
    return F.array_join(kept, sep)


def part_named(word: str, names: Column, sep: str) -> Column:
    """``word`` and the known names; null, so no part, if there are none."""
    return F.when(F.size(_known(names)) > 0, F.concat(F.lit(word + " "), F.array_join(_known(names), sep)))


def part_rating(rating: Column) -> Column:
    return F.when(rating.isin("explicit", "e"), "explicit")


def part_crop(kind: Column, cropped: Column) -> Column:
    return F.when(cropped, F.when(kind.isNotNull(), F.concat(kind, F.lit(" cropped"))).otherwise("cropped"))


def part_tags(tags: Column, sep: str) -> Column:
    return F.array_join(F.filter(F.transform(tags, lambda t: t["tag"]), lambda t: t != "unknown"), sep)


#: Fixed values of the old captions: the tag of one school uniform, the outfits that keep their name, and the one whose words are joined.
TRACEN, COMMON_OUTFITS, JOINED_OUTFIT = "tracen_school_uniform", ("tracen school uniform", "tracen swimsuit", "tracen race uniform", "tracen gym uniform", "stage clothes"), "stage clothes"


def v1_characters(names: Column, embeddings: bool = False) -> Column:
    """Old characters without unknown and ood; with ``embeddings`` ``name, outfit`` becomes ``name, name-outfit`` unless the outfit is a common one."""
    known = F.filter(names, lambda x: ~x.isin("unknown", "ood"))

    def form(x: Column) -> Column:
        name, outfit = F.substring_index(x, ",", 1), F.get(F.split(x, ",", -1), F.lit(1))
        worn = F.when(F.trim(outfit) == JOINED_OUTFIT, F.lit("stage-clothes")).when(F.trim(outfit).isin(*COMMON_OUTFITS), F.lit(None)).otherwise(F.replace(F.concat(name, outfit), F.lit(" "), F.lit("-")))
        return F.when(x.contains(",") & worn.isNotNull(), F.concat(name, F.lit(", "), worn)).otherwise(x)

    return F.transform(known, form) if embeddings else known


def v1_embeddings(names: Column) -> Column:
    """Names of embeddings that v1_characters() makes of outfits, distinct, in order."""
    own = F.filter(F.filter(names, lambda x: ~x.isin("unknown", "ood")), lambda x: x.contains(",") & ~F.trim(F.get(F.split(x, ",", -1), F.lit(1))).isin(*COMMON_OUTFITS))
    return F.array_distinct(F.transform(own, lambda x: F.replace(F.concat(F.substring_index(x, ",", 1), F.get(F.split(x, ",", -1), F.lit(1))), F.lit(" "), F.lit("-"))))


def v1_caption(row: Column, fields: dict[str, Column], tags: Column, places: Column, sep: str = ",", embeddings: bool = False, probs: dict[str, float] | None = None, seed: int = 0) -> Column:
    """The old caption: people, characters, copyright, general, artist, rating, places of faces and tags, between ``sep`` and a space; underscores become spaces.

    ``fields``: n_people, characters, copyright, general, artist, rating; ``tags`` are names as filtered, ``places`` words. Where the one character of an item has the school
    uniform among its tags, the uniform stands as its outfit and not among the tags. Each part has its probability, 1 unless given.
    """
    probs, between = probs or {}, sep + " "

    def drawn(name: str, part: Column) -> Column:
        p = probs.get(name, 1.0)
        return part if p >= 1 else F.lit(None).cast("string") if p <= 0 else F.when(uniform(row, F.lit(name), seed) < p, part)

    names = v1_characters(fields["characters"], embeddings)
    worn = F.coalesce(F.array_contains(tags, TRACEN) & (F.size(names) == 1), F.lit(False)) & drawn("characters", F.lit("x")).isNotNull() & drawn("tags", F.lit("x")).isNotNull()
    dressed = F.concat(F.substring_index(F.get(names, F.lit(0)), ",", 1), F.lit(", tracen school uniform"))
    several = lambda c, gone: F.filter(c, lambda x: x != gone)
    listed = lambda word, c, gone: F.when(F.size(several(c, gone)) > 0, F.concat(F.lit(word + " "), F.array_join(several(c, gone), " ")))
    parts = {
        "n_people": F.concat(fields["n_people"], F.when(fields["n_people"] == "1", "person").otherwise("people")),
        "characters": F.when(worn, dressed).otherwise(F.array_join(names, between)), "copyright": listed("from", fields["copyright"], "unknown"), "general": fields["general"],
        "artist": listed("by", fields["artist"], "anonymous"), "rating": F.when(fields["rating"] == "explicit", "explicit"), "places": places,
        "tags": F.array_join(F.when(worn, F.filter(tags, lambda t: t != TRACEN)).otherwise(tags), ", "),
    }
    shown = F.filter(F.array(*(drawn(n, p.cast("string")) for n, p in parts.items())), lambda x: x != "")
    return F.replace(F.array_join(shown, between), F.lit("_"), F.lit(" "))


def caption(parts: dict[str, Column], row: Column, probs: dict[str, float] | None = None, sep: str = ", ", keep_before: str | None = None, keep_sep: str | None = None, seed: int = 0) -> Column:
    """Parts in order, each with its probability (1 unless given), drawn by a hash of the row; null and empty parts are left out.

    ``keep_before``: the part before which ``keep_sep`` stands, if there is something on both sides.
    """
    probs = probs or {}

    def drawn(name: str, part: Column) -> Column:
        p = probs.get(name, 1.0)
        return part if p >= 1 else F.lit(None).cast("string") if p <= 0 else F.when(uniform(row, F.lit(name), seed) < p, part)

    def joined(columns: list[Column], between: str) -> Column:
        return F.array_join(F.filter(F.array(*columns), lambda x: x != ""), between) if columns else F.lit("")

    names = list(parts)
    shown = [drawn(name, part.cast("string")) for name, part in parts.items()]
    if keep_before not in names or keep_sep is None:
        return joined(shown, sep)
    at = names.index(keep_before)
    sides = [joined(shown[:at], sep), joined(shown[at:], sep)]
    return F.when(F.coalesce(shown[at], F.lit("")) != "", joined(sides, keep_sep)).otherwise(joined(sides, sep))

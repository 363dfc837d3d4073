"""Fields of items: old names, descriptions, refined and merged characters, pruned tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftloom.functions import tags as G
from siftloom.functions.names import base_name
from siftloom.operators.ranks import number_rows
from siftloom.session import private

#: Parts of tags that tell of hair, and the tag that is never kept.
HAIR = ("hair", "ponytail", "twintail", "braid", "bun", "bangs", "ahoge")
NEVER = ("parody",)


def legacy_fields(items: DataFrame) -> DataFrame:
    """Old metadata under today's names: character as characters, general as type; an old field replaces a field of the new name.
    ``path``, ``current_path`` and ``filename`` come from ``image``, where the image is now."""
    new = {"character": "characters", "general": "type"}
    kept = items.drop(*[n for o, n in new.items() if o in items.columns]).withColumnsRenamed(new)
    return kept.withColumns({"path": F.col("image"), "current_path": F.col("image"), "filename": F.substring_index("image", "/", -1)}).drop("image")


def description(general: Column, path: Column, constant: str | None = None, from_folder: bool = False) -> Column:
    """The item's description, or ``constant`` if given; the folder's name, with spaces for underscores, is put after it if asked for; a path without a folder has an empty one."""
    text = general if constant is None else F.lit(constant)
    if not from_folder:
        return text
    return F.concat(F.coalesce(text, F.lit("")), F.lit(" "), F.replace(F.coalesce(F.try_element_at(F.split(path, "/"), F.lit(-2)), F.lit("")), F.lit("_"), F.lit(" ")))


def refine_characters(old: Column, new: Column, overwrite: bool = False, part: str = ",") -> Column:
    """Old names without an outfit take it from a new name of equal base, the last of several; without old names, or with ``overwrite``, the new ones stand."""
    outfits = F.filter(new, lambda x: x.contains(part))

    def refined(x: Column) -> Column:
        fits = F.filter(outfits, lambda o: F.substring_index(o, part, 1) == x)
        return F.when(~x.contains(part) & (F.size(fits) > 0), F.try_element_at(fits, F.lit(-1))).otherwise(x)

    return new if overwrite else F.when(old.isNull(), new).otherwise(F.transform(old, refined))


def merge_references(known: DataFrame, references: DataFrame) -> DataFrame:
    """(label, character, ref_label) of known characters (label, character) and references (label, character): every reference has its row.

    A reference equal to a known character shares its label, the lowest of several; others get labels after the known ones, in order of
    the lowest of their own, equal ones the same. A known character without a reference has one row, without ``ref_label``.
    """
    have = known.groupBy("character").agg(F.min("label").alias("shared"))
    refs = references.select(F.col("label").alias("ref_label"), "character").join(have, "character", "left")
    first = known.agg(F.coalesce(F.max("label") + 1, F.lit(0)).alias("first"))
    fresh = refs.where("shared is null").groupBy("character").agg(F.min("ref_label").alias("lowest"))
    fresh = number_rows(fresh, ["lowest", "character"], "place", first=0).join(F.broadcast(first))  # one row
    fresh = fresh.select((F.col("first") + F.col("place")).cast("long").alias("label"), "character").join(refs.where("shared is null").select("character", "ref_label"), "character")
    shared = refs.where("shared is not null").select(F.col("shared").alias("label"), "character", "ref_label")
    return known.select(F.col("label").cast("long").alias("label"), "character").join(shared, ["label", "character"], "left").unionByName(fresh)


def inherit_presence(present: DataFrame, known: DataFrame, merged: DataFrame) -> DataFrame:
    """Presence (item, label) of known characters, and of new forms wherever a known character of the same base name is."""
    new = merged.join(known.select("label"), "label", "left_anti").select(F.col("label").alias("form"), base_name(F.col("character")).alias("base")).distinct()
    old = known.select("label", base_name(F.col("character")).alias("base"))
    forms = old.join(new, "base").select("label", "form").distinct()
    return present.select("item", "label").unionByName(present.join(forms, "label").select("item", F.col("form").alias("label"))).distinct()


def prune_tags(tags: Column, characters: Column, mode: str, blacklist: Column, partners: Column, is_character=None) -> Column:
    """struct<kept, dropped> of tag lists. ``none``: all are kept; ``minimal``: without blacklisted and overlapping tags; ``character``: on items
    with characters also without tags that describe them (``is_character`` tells of a name), which are the dropped ones; elsewhere dropped is null."""
    none = F.lit(None).cast("array<struct<tag:string,score:double>>")
    if mode not in ("none", "minimal", "character"):
        raise ValueError(f"no such mode: {mode}")
    if mode == "none":
        return F.struct(tags.alias("kept"), none.alias("dropped"))
    kept = G.drop_overlap(G.drop_blacklisted(tags, blacklist), partners)
    if mode == "minimal":
        return F.struct(kept.alias("kept"), none.alias("dropped"))
    has = F.coalesce(F.size(characters) > 0, F.lit(False))

    def parted(x: Column) -> Column:
        marked = F.transform(x, lambda t: F.struct(t.alias("t"), F.coalesce(is_character(t["tag"]), F.lit(False)).alias("of")))
        of = lambda flag: G.once(marked, lambda m: F.transform(F.filter(m, lambda t: t["of"] == flag), lambda t: t["t"]))
        return F.struct(F.when(has, of(False)).otherwise(x).alias("kept"), F.when(has, of(True)).alias("dropped"))

    return G.once(kept, parted)


def filter_v1(tags: Column, attire: Column, has_outfit: Column, drop_hair: bool = False, drop_eyes: bool = False, drop_outfit: bool = False, most: int | None = None) -> Column:
    """Names of tags that count people first, then the rest without the families that are to go."""
    people = lambda t: t.contains("boy") | t.contains("girl") | t.contains("solo")

    def stays(t: Column) -> Column:
        hair = F.lit(False)
        for part in HAIR:
            hair = hair | t.contains(part)
        worn = has_outfit & F.array_contains(attire, F.replace(t, F.lit("_"), F.lit(" ")))
        return F.when(hair, F.lit(not drop_hair)).when(t.contains("eyes"), F.lit(not drop_eyes)).when(worn, F.lit(not drop_outfit)).otherwise(~t.isin(*NEVER))

    both = F.concat(F.filter(tags, people), F.filter(tags, lambda t: ~people(t) & stays(t)))
    return F.slice(both, 1, most) if most else both


def init_text(words: Column, n: int = 10, std: float = 0.017) -> Column:
    """Words that a new embedding starts from, and how its further tokens are drawn."""
    return F.concat_ws(" ", F.nullif(F.array_join(words, " "), F.lit("")), F.lit(f"*[{std}, {n}]"))


#: Folders that name no character, and names that stand for none.
OTHERS, NOBODY = ("character_others", "others"), ("unknown", "ood")


def _counted(name: Column, one: str, ending: str) -> Column:
    """The number before ``ending`` as text, what stands there if it is none, 1 for ``one``."""
    bare = F.regexp_replace(name, f"[{ending}]+$", "")
    return F.when(name == one, "1").when(bare.rlike("^[0-9]+$"), F.regexp_replace(bare, "^0+(?=[0-9])", "")).otherwise(bare)


def _named(names: Column) -> Column:
    return F.filter(F.array_sort(F.array_distinct(names)), lambda x: ~x.isin(*NOBODY))


def folder_fields(path: Column, form: str, characters: Column | None = None, allowed: Column | None = None, subjects: Column | None = None) -> dict[str, Column]:
    """Fields that the folders of a file's path tell, from the right, by a format such as ``n_people/character/*``: n_faces and n_people as text, characters, invalid.

    ``*`` skips a folder. A character folder holds names between plus signs; they are sorted and distinct, without unknown and ood. Folders
    for others leave ``characters`` as they are stored, as do names that are the stored ones in any order. ``invalid`` are names of folders that are not among
    the ``allowed`` ones, null where all are. ``subjects``, the text of a file with names between semicolons, overrules folders where there is one.
    A folder that the path doesn't have counts as one without a name. Other words in a format are errors.
    """
    out: dict[str, Column] = {}
    stored = F.lit(None).cast("array<string>") if characters is None else characters
    invalid = F.array().cast("array<string>")
    folders = F.split(path, "/")
    for k, kind in enumerate(reversed(form.split("/"))):
        name = F.coalesce(F.try_element_at(folders, F.lit(-2 - k)), F.lit(""))
        if kind == "n_faces":
            out["n_faces"] = _counted(name, "1face", "faces")
        elif kind == "n_people":
            out["n_people"] = _counted(name, "1person", "people")
        elif kind == "character":
            told = F.when(name == "ood", F.array().cast("array<string>")).otherwise(_named(F.split(name, r"\+", -1)))
            stays = name.isin(*OTHERS) | F.coalesce(_named(stored) == told, F.lit(False))
            if allowed is not None:
                invalid = F.concat(invalid, F.when(stays, F.array().cast("array<string>")).otherwise(F.array_except(told, allowed)))
            stored = F.when(stays, stored).otherwise(told)
        elif kind != "*":
            raise ValueError(f"no such kind of folder: {kind}")
    if subjects is not None:
        listed = F.transform(F.split(F.trim(subjects), ";", -1), lambda x: F.trim(x))
        stored = F.when(subjects.isNull(), stored).when(F.trim(subjects) == "", F.array().cast("array<string>")).otherwise(listed)
    out["characters"] = stored
    out["invalid"] = F.when(F.size(invalid) > 0, F.array_distinct(invalid))
    return out


def rename_rules(rows: DataFrame) -> DataFrame:
    """One row with ``rules``, array<struct<old, new>>, of a mapping (ord, old, new): in order of each old name's first row, with the new name of its last."""
    last = rows.where("old is not null").groupBy("old").agg(F.min("ord").alias("ord"), F.max_by("new", "ord").alias("new"))
    return last.agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "old", "new"))), lambda x: F.struct(x["old"].alias("old"), x["new"].alias("new"))).alias("rules"))


def renamed(name: Column, rules: Column) -> Column:
    """A name by the rules; the name itself without one."""
    return F.coalesce(F.get(F.filter(rules, lambda r: r["old"] == name), F.lit(0))["new"], name)


def rename_folder(path: Column, rules: Column, drop_unknown: bool = False) -> Column:
    """A folder's path with the parts of its last name, between plus signs, renamed; with ``drop_unknown`` null if a part is neither an old nor a new name."""
    at = F.length(path) - F.length(F.substring_index(path, "/", -1))
    parts = F.split(F.substring_index(path, "/", -1), r"\+", -1)
    new = F.concat(F.substr(path, F.lit(1), at), F.array_join(F.transform(parts, lambda x: renamed(x, rules)), "+"))
    unknown = F.exists(parts, lambda x: ~F.exists(rules, lambda r: (r["old"] == x) | (r["new"] == x)))
    return F.when(~unknown, new) if drop_unknown else new


def rename_tag_line(line: Column, rules: Column) -> Column:
    """A tag file's line; names in a character line are renamed, other lines stay."""
    names = F.split(F.regexp_replace(line, "^[charte:]+", ""), ",", -1)
    new = F.array_join(F.transform(names, lambda x: renamed(F.trim(x), rules)), ", ")
    return F.when(line.startswith("character:"), F.concat(F.lit("character: "), new)).otherwise(line)


def rename_caption(text: Column, rules: Column) -> Column:
    """A caption in which every old name, wherever it stands, is replaced by its new one, rule after rule: a rule sees what those before it made."""
    return F.aggregate(rules, text, lambda t, r: F.replace(t, r["old"], F.coalesce(r["new"], F.lit(""))))


def apply_renames(rows: DataFrame, rules: DataFrame, **columns: str) -> DataFrame:
    """``rows`` with columns renamed in place: column name to kind, one of folder, known_folder, tag_line and caption. ``rules`` is the one row of rename_rules()."""
    kinds = {"folder": rename_folder, "known_folder": lambda c, r: rename_folder(c, r, True), "tag_line": rename_tag_line, "caption": rename_caption}
    (name,) = private(rows, "rules")
    one = F.broadcast(rules.select(F.col("rules").alias(name)))  # a rule file, and one row
    return rows.join(one).withColumns({c: kinds[k](F.col(c), F.col(name)) for c, k in columns.items()}).drop(name)

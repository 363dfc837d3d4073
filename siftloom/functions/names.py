"""Columns over file, folder, title and character names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_title(filename: Column) -> Column:
    """struct<name, episode> of a video's file name: bracketed parts and the extension go; what follows the last dash is the episode, if it begins with a number."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(filename, r"\[[^\]]*\]", ""), r"\.[^.\s]*$", ""))
    dash = F.length(bare) - F.length(F.substring_index(bare, "-", -1))
    tail = F.substring_index(bare, "-", -1)
    number = F.regexp_extract(tail, r"^\W*(\d+)", 1)
    cut = (dash > 0) & (number != "")
    name = F.when(dash > 0, F.trim(F.substr(bare, F.lit(1), dash - 1))).otherwise(bare)
    return F.struct(name.alias("name"), F.when(cut, number.try_cast("int")).alias("episode"))


#: Fixed value: characters of a part of a name that file systems refuse.
REFUSED = r'[<>:"/\\?*]'


def _listed(part: Column, inner: str) -> Column:
    items = F.transform(F.split(part, rf"\Q{inner}\E", -1), lambda x: F.regexp_replace(F.trim(x), REFUSED, "_"))
    return F.when(part.isNull() | (part == "") | (F.lower(part) == "none"), F.array().cast("array<string>")).otherwise(F.filter(items, lambda x: x != ""))


def parse_character(text: Column, inner: str = "+", outer: str = "|") -> Column:
    """struct<name, appearance, outfit, accessories, objects, extra_features> of ``name|appearance|outfit+…|…``; ``none`` and missing parts are empty.
    Characters that file systems refuse become underscores."""
    parts = F.transform(F.split(text, rf"\Q{outer}\E", -1), lambda x: F.trim(x))
    part = lambda i: F.get(parts, F.lit(i))
    safe = lambda x: F.regexp_replace(x, REFUSED, "_")
    look = F.when(part(1).isNull() | (part(1) == "") | (F.lower(part(1)) == "none"), F.lit(None)).otherwise(safe(part(1)))
    names = ("outfit", "accessories", "objects", "extra_features")
    return F.struct(safe(part(0)).alias("name"), look.cast("string").alias("appearance"), *(_listed(part(i + 2), inner).alias(n) for i, n in enumerate(names)))


def extra_embeddings(c: Column) -> Column:
    """Items of a parsed character that are embeddings of their own: those that begin with an underscore, in order."""
    return F.filter(F.concat(*(c[n] for n in ("outfit", "accessories", "objects", "extra_features"))), lambda x: x.startswith("_"))


def caption_character(c: Column, inner: str = " ", outer: str = ", ") -> Column:
    """A parsed character in a caption: its name, or embedding name where the appearance is one, with any other appearance after it, then the parts that have a value."""
    look = c["appearance"]
    name = F.when(look.isNull() | (look == ""), c["name"]).when(look.startswith("_"), embedding_name(c)).otherwise(F.concat_ws(inner, c["name"], look))
    lists = [F.when(F.size(c[n]) > 0, F.array_join(c[n], inner)) for n in ("outfit", "accessories", "objects", "extra_features")]
    return F.concat_ws(outer, name, *lists)


def format_character(c: Column, inner: str = "+", outer: str = "|") -> Column:
    """The text of a parsed character; trailing parts without a value are left out."""
    lists = [F.when(F.size(c[n]) > 0, F.array_join(c[n], inner)).otherwise("none") for n in ("outfit", "accessories", "objects", "extra_features")]
    whole = F.concat_ws(outer, c["name"], F.coalesce(c["appearance"], F.lit("none")), *lists)
    return F.regexp_replace(whole, rf"(\Q{outer}\Enone)+$", "")


def embedding_name(c: Column) -> Column:
    """Name and appearance that a trained embedding has: the appearance, if it begins with an underscore, else the name; white space becomes an underscore."""
    base = F.when(F.coalesce(c["appearance"].startswith("_"), F.lit(False)), F.concat(c["name"], c["appearance"])).otherwise(c["name"])
    return F.regexp_replace(base, r"\s+", "_")


def sanitize(path: Column) -> Column:
    """Characters that file systems refuse become underscores, in each component."""
    return F.array_join(F.transform(F.split(path, "/", -1), lambda x: F.regexp_replace(x, r'[<>:"\\|?*]', "_")), "/")


def strip_number(folder: Column) -> Column:
    """A class folder's name without its number, dashes around it included."""
    return F.regexp_replace(folder, r"^-*\d+-*_", "")


def natural_key(path: Column) -> Column:
    """A text whose order is that of the path with numbers compared as numbers, up to as many digits as there are: of two numbers the shorter one, without zeros before it, comes first."""
    runs = F.regexp_extract_all(path, F.lit(r"\d+|\D+"), F.lit(0))
    bare = lambda x: F.regexp_replace(x, r"^0+(?=\d)", "")
    # the number of digits stands before them; 10 digits hold any length of a text
    return F.array_join(F.transform(runs, lambda x: F.when(x.rlike(r"^\d"), F.concat(F.lpad(F.length(bare(x)).cast("string"), 10, "0"), bare(x))).otherwise(x)), "")


def flatten_path(path: Column, repeat: Column) -> Column:
    """``{repeat}_{a~b}`` of a path a/b."""
    return F.concat(F.rint(repeat).cast("int").cast("string"), F.lit("_"), F.replace(path, F.lit("/"), F.lit("~")))


def revert_path(flat: Column) -> Column:
    return F.replace(F.regexp_replace(flat, r"^\d+_", ""), F.lit("~"), F.lit("/"))


def folder_characters(names: Column, inner: str = "+") -> Column:
    """Sorted distinct names joined; others if there are none or the name is too long."""
    joined = F.array_join(F.array_sort(F.array_distinct(names)), inner)
    return F.when((F.size(names) == 0) | (F.length(joined) >= 100), "character_others").otherwise(F.replace(joined, F.lit("."), F.lit("")))


def folder_n_characters(names: Column, most: int) -> Column:
    n = F.size(F.array_distinct(names))
    return F.when(n >= most, f"{most}+_characters").otherwise(F.concat(n.cast("string"), F.when(n == 1, "_character").otherwise("_characters")))


def base_name(character: Column) -> Column:
    return F.substring_index(character, "|", 1)

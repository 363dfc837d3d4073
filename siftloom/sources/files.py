"""Metadata beside images, rule files, catalogues of references, and the tables that jobs leave behind.

Rule files are small and read whole; everything else is a table of any size.
"""

from __future__ import annotations

import json
import tomllib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftloom.operators.ranks import number_rows
from siftloom.session import private
from siftloom.sources.scan import base_key, manifest
from siftloom.sources.sidecars import read_sidecars

#: Fields of a tag file's lines, in the original's spelling, and the fields that they fill.
V1_FIELDS = {"character": "character", "copyright": "copyright", "artist": "artist", "general": "tags", "rating": "rating", "score": "score"}
#: Names of characters that a tag file doesn't pass on.
V1_NOBODY = ("unknown", "ood")


def read_metadata(spark: SparkSession, folder: str, schema: str, broken: str | None = None) -> DataFrame:
    """(base, fields of ``schema``) of the files ``.{name}_meta.json``, ``{name}_meta.json`` or ``{name}.json`` below a folder, the
    first form there is of each image; base is the image's path without ending. ``broken`` names a column that tells of files that couldn't be read."""
    rows = read_sidecars(spark, folder, schema, broken or "_broken")
    return rows if broken else rows.drop("_broken")


def item_metadata(images: DataFrame, stored: DataFrame, overwrite_path: bool = False) -> DataFrame:
    """Images (path, filename, group_id, more) with their stored metadata (base, fields); what is missing gets the image's own values.

    ``path`` stays as stored unless it is to be overwritten; ``current_path`` is always where the image is now. An image
    without metadata has null in the other fields; columns may have any other names.
    """
    both = images.withColumn("base", F.lit(0)) if "base" not in images.columns else images
    names = private(both.join(stored.limit(0).drop("base"), F.lit(False)), *(f"own_{i}" for i in range(len(images.columns))), "key")
    own, key = dict(zip(images.columns, names, strict=False)), names[-1]
    here = images.withColumnsRenamed(own).withColumn(key, base_key(F.col(own["path"])))
    both = here.join(stored, F.col(key) == stored["base"], "left")
    fields = [c for c in stored.columns if c != "base" and c not in ("path", "current_path")]

    def value(c: str) -> Column:
        return F.coalesce(stored[c], F.col(own[c])) if c in own and c in fields else F.col(own[c]) if c in own else stored[c]

    path = F.col(own["path"]) if overwrite_path or "path" not in stored.columns else F.coalesce(stored["path"], F.col(own["path"]))
    others = [c for c in dict.fromkeys([*images.columns, *fields]) if c not in ("path", "current_path")]
    return both.select(path.alias("path"), F.col(own["path"]).alias("current_path"), *(value(c).alias(c) for c in others))


def v1_tag_lines(lines: DataFrame, keep_character: bool = False) -> DataFrame:
    """(path, character, copyright, artist, tags, rating, score) of lines (path, line_no, line) of tag files.

    A line without a known field is a list of tags. The last line of a field wins; names in lists are trimmed and blank ones dropped.
    """
    known = F.regexp_extract("line", f"^({'|'.join(V1_FIELDS)}): ", 1)
    field = F.element_at(F.create_map(*[F.lit(x) for kv in {**V1_FIELDS, "": "tags"}.items() for x in kv]), known)
    text = F.trim(F.when(known == "", F.col("line")).otherwise(F.expr("substring_index(line, ': ', -size(split(line, ': ')) + 1)")))
    read = lines.select("path", "line_no", field.alias("field"), text.alias("text"))
    last = {f: F.max_by("text", F.when(F.col("field") == f, F.col("line_no"))).alias(f) for f in dict.fromkeys(V1_FIELDS.values())}
    rows = read.groupBy("path").agg(*last.values())
    items = {f: F.filter(F.transform(F.split(f, ","), lambda x: F.trim(x)), lambda x: x != "") for f in ("character", "copyright", "artist", "tags")}
    items["character"] = F.lit(None).cast("array<string>") if keep_character else F.filter(items["character"], lambda x: ~x.isin(*V1_NOBODY))
    return rows.select("path", *(c.alias(f) for f, c in items.items()), "rating", "score")


#: What tag_toml() makes of a file.
TOML = "character array<string>, copyright array<string>, artist array<string>, tags array<string>, more map<string,string>, error string"


def _toml_fields(text: str | None) -> tuple:
    lists: dict = dict.fromkeys(("character", "copyright", "artist", "tags"))
    try:
        found = tomllib.loads(text or "")
    except tomllib.TOMLDecodeError as e:
        return (*lists.values(), None, f"no TOML: {e}")
    odd = [k for k in lists if k in found and not isinstance(found[k], str)]
    if odd:
        return (*lists.values(), None, f"not a text: {', '.join(odd)}")
    for k in lists:
        if k in found:
            lists[k] = [x.strip() for x in found.pop(k).split(",")]
    if lists["character"] is not None:
        lists["character"] = [x for x in lists["character"] if x not in V1_NOBODY]
    return (*lists.values(), {k: v if isinstance(v, str) else json.dumps(v, default=str) for k, v in found.items()}, None)


def tag_toml(bodies: DataFrame, keep_character: bool = False, path: str = "path", body: str = "body") -> DataFrame:
    """(path, character, copyright, artist, tags, more, error) of tag files in TOML (path, body).

    Lists are texts with commas; unknown and ood are no characters; with ``keep_character`` characters are null, so that stored ones stay. Other keys are in
    ``more``, values that aren't text as JSON. A file that is no TOML, or in which a list isn't a text, has null fields and says why in ``error``; a null or empty one has no fields.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split(" ")[0] for x in TOML.split(", ")]
        kinds = [*[pa.list_(pa.string())] * 4, pa.map_(pa.string(), pa.string()), pa.string()]
        for batch in batches:
            rows = [_toml_fields(t) for t in batch.column(1).to_pylist()]
            columns = [pa.array([r[i] if kinds[i] != kinds[4] or r[i] is None else list(r[i].items()) for r in rows], kinds[i]) for i in range(len(kinds))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["path", *names])

    rows = bodies.select(F.col(path).cast("string"), F.col(body).cast("string")).mapInArrow(parse, f"path string, {TOML}")
    return rows.withColumn("character", F.lit(None).cast("array<string>")) if keep_character else rows


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """(ord, line) of one small rule file."""
    return spark.read.option("wholetext", True).text(path).select(F.posexplode(F.split("value", r"\r?\n", -1)).alias("ord", "line"))


def weight_rules(spark: SparkSession, path: str) -> DataFrame:
    """(ord, pattern, weight) of a file of ``pattern,weight`` lines; the order of lines counts. Lines without a number are left out."""
    row = F.from_csv("line", F.lit("pattern string, weight double"))
    return _numbered(spark, path).select("ord", F.trim(row["pattern"]).alias("pattern"), row["weight"].alias("weight")).where("weight is not null")


def blacklist(spark: SparkSession, path: str) -> DataFrame:
    """(tag) of a file with one tag in a line."""
    return spark.read.text(path).select(F.trim("value").alias("tag")).where("tag <> ''").distinct()


def overlap_rules(spark: SparkSession, path: str) -> DataFrame:
    """(query, has_overlap) of a JSON file; tags without partners are left out."""
    rows = spark.read.schema("query string, has_overlap array<string>").option("multiLine", True).json(path)
    return rows.where(F.size("has_overlap") > 0)


def character_rules(spark: SparkSession, path: str, least: int = 0, below: int = 2) -> DataFrame:
    """(kind, word) of a JSON file with a ``whitelist`` and, by difficulty, ``prefixes`` and ``suffixes``; difficulties from ``least`` to under ``below``."""
    lists = spark.read.schema("whitelist array<string>, prefixes array<array<string>>, suffixes array<array<string>>").option("multiLine", True).json(path)
    part = lambda c: F.flatten(F.slice(c, least + 1, max(0, below - least)))
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), v.alias("words")) for k, v in (("whitelist", F.col("whitelist")), ("prefix", part("prefixes")), ("suffix", part("suffixes")))))
    return lists.select(F.explode(kinds).alias("k")).select("k.kind", F.explode("k.words").alias("word"))


def reference_labels(images: DataFrame, root: str) -> DataFrame:
    """(path, name, label) of images (path) of references: the folder below ``root`` names a character, its levels parted by ``|``;
    a file in ``root`` itself is named by what stands before its first underscore. Labels are dense, by first path."""
    below = F.substr("path", F.lit(len(root.rstrip("/")) + 2))
    folder = F.regexp_replace(below, "/?[^/]*$", "")
    file = F.regexp_replace(below, r"\.[^./]*$", "")
    name = F.when(folder == "", F.substring_index(file, "_", 1)).otherwise(F.replace(folder, F.lit("/"), F.lit("|")))
    named = images.select("path", name.alias("name"))
    labels = number_rows(named.groupBy("name").agg(F.min("path").alias("first")), ["first", "name"], "label", first=0).select("name", F.col("label").cast("int").alias("label"))
    return named.join(labels, "name").select("path", "name", "label")


def reference_catalogue(spark: SparkSession, root: str) -> DataFrame:
    """reference_labels() of the images below a folder, which Spark lists as a URI."""
    return reference_labels(manifest(spark, root), root)


def score_batches(rows: DataFrame, make: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str) -> DataFrame:
    """Rows through a model in batches: ``make`` loads it once in each task and returns a function from one batch to rows of ``schema``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for batch in batches:
            model = model or make()
            yield model(batch)

    return rows.mapInPandas(run, schema)


def with_features(images: DataFrame, cached: DataFrame, compute: Callable[[DataFrame], DataFrame], key: str = "path") -> tuple[DataFrame, DataFrame]:
    """(features of all images, those computed now): features of keys in ``cached`` are taken from there, others computed by ``compute``
    from the images. The second table is what to append to the cache, stored before it is used twice."""
    new = compute(images.join(cached.select(key), key, "left_anti"))
    kept = cached.join(images.select(key).distinct(), key, "left_semi")
    return kept.unionByName(new), new


def metadata_sink(items: DataFrame, path: str, untitled: str = "untitled") -> None:
    """Writes items (folder, filename, more) as JSON lines by folder; items without a file name get one with a number."""
    name = F.coalesce("filename", F.concat(F.lit(f"{untitled}_"), F.monotonically_increasing_id(), F.lit(".png")))
    items.withColumn("filename", name).write.mode("overwrite").partitionBy("folder").json(path)


def attribute_lines(items: DataFrame, attribute: str) -> DataFrame:
    """(path, body) of the side files of an attribute: keys of a map, values of a list or the text; items without any have none."""
    kind = items.schema[attribute].dataType.typeName()
    value = {"map": lambda: F.array_join(F.map_keys(attribute), ", "), "array": lambda: F.array_join(attribute, ", "), "string": lambda: F.col(attribute)}
    if kind not in value:
        raise ValueError(f"{attribute} is a {kind}: only maps, lists and texts have side files")
    body = value[kind]()
    return items.select(F.concat(base_key(F.col("path")), F.lit(f".{attribute}")).alias("path"), body.alias("body")).where(F.coalesce(body, F.lit("")) != "")


def attribute_sink(items: DataFrame, attribute: str, path: str) -> None:
    attribute_lines(items, attribute).write.mode("overwrite").json(path)


def repeat_sink(folders: DataFrame, path: str) -> None:
    """Writes the repeats of folders (path, multiply, more), the most repeated first in each file."""
    folders.repartitionByRange(F.desc("multiply"), "path").sortWithinPartitions(F.desc("multiply"), "path").write.mode("overwrite").option("header", True).csv(path)


def class_dataset(images: DataFrame, tags: DataFrame, mode: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """((class_id, file, tags), (class_id, class_name)) of images (path) and their tags (base, values): a class is the folder's name, its
    number dense by first path. Images for which ``mode`` isn't RGB are left out."""
    seen = images if mode is None else images.where(mode == "RGB")
    parts = F.split("path", "/")
    named = seen.select(base_key(F.col("path")).alias("base"), "path", F.coalesce(F.try_element_at(parts, F.lit(-2)), F.lit("")).alias("class_name"), F.array_join(F.slice(parts, -2, 2), "/").alias("file"))
    classes = number_rows(named.groupBy("class_name").agg(F.min("path").alias("first")), ["first", "class_name"], "class_id", first=0).select(F.col("class_id").cast("int").alias("class_id"), "class_name")
    rows = named.join(classes, "class_name").join(tags, "base", "left")
    return rows.select("class_id", "file", F.coalesce("values", F.array().cast("array<string>")).alias("tags")), classes


def tag_report(counts: DataFrame) -> DataFrame:
    """(line) ``tag: n`` of counts (tag, n), the most frequent first; ties by tag."""
    return counts.orderBy(F.desc("n"), "tag").select(F.concat_ws(": ", "tag", F.col("n").cast("string")).alias("line"))

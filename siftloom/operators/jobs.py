"""Whole jobs over items: import of metadata, tags and captions, selection of a data set."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftloom.functions import boxes as B
from siftloom.functions import captions as C
from siftloom.functions import names as N
from siftloom.functions import tags as G
from siftloom.operators import coretags as K
from siftloom.operators import similar as S
from siftloom.operators.fields import prune_tags
from siftloom.operators.select import propagate_labels, sample_rows
from siftloom.session import materialize, private

_TAGS = "array<struct<tag:string,score:double>>"
MODES = ("none", "minimal", "character", "character_core")


@dataclass(frozen=True)
class TagRules:
    """What goes from tags: listed ones, ones with a partner, and ones that describe characters, by endings and beginnings; other such lists tell what an embedding starts from."""

    blacklist: tuple[str, ...] = ()
    partners: dict = field(default_factory=dict)
    whitelist: tuple[str, ...] = ()
    suffixes: tuple[str, ...] = ()
    prefixes: tuple[str, ...] = ()
    init_suffixes: tuple[str, ...] = ()
    init_prefixes: tuple[str, ...] = ()
    drop_all: bool = False
    init_all: bool = False

    def listed(self) -> Column:
        return F.array(*map(F.lit, self.blacklist)).cast("array<string>")

    def overlaps(self) -> Column:
        if not self.partners:
            return F.create_map().cast("map<string,array<string>>")
        return F.create_map(*[x for k, vs in self.partners.items() for x in (F.lit(k), F.array(*map(F.lit, vs)))])

    def drops(self, tag: Column) -> Column:
        return G.is_character_tag(tag, list(self.whitelist), list(self.suffixes), list(self.prefixes), self.drop_all)

    def starts(self, tag: Column) -> Column:
        return G.is_character_tag(tag, list(self.whitelist), list(self.init_suffixes), list(self.init_prefixes), self.init_all)


def default_parts(row: dict[str, Column]) -> dict[str, Column]:
    """Caption parts of an item's columns: characters, type, rating and tags."""
    return {"characters": F.array_join(row["shown"], " and "), "type": row["type"], "rating": C.part_rating(row["rating"]), "tags": C.part_tags(row["tags"], ", ")}


def tag_and_caption(
    items: DataFrame, rules: TagRules, mode: str = "character", parts: Callable[[dict[str, Column]], dict[str, Column]] = default_parts, order: str = "score", append_dropped: bool = False,
    most: int | None = None, frequency: float = 0.4, from_original: bool = False, predicted: DataFrame | None = None, overwrite: bool = False, caption: dict | None = None, seed: int = 0,
) -> tuple[DataFrame, DataFrame | None]:
    """(items, core): ``items`` (item_id, characters, tags, processed_tags, type, rating, more) with tags, processed_tags, dropped_character_tags and caption as this run leaves them.

    ``predicted`` (item_id, tags) gives tags to items without any, or to all with ``overwrite``. Work begins at the processed tags, if there are any, or at the
    original ones if asked for; an item with neither stays as it is and has a caption without tags. Underscores go, then by ``mode`` nothing (``none``), listed and overlapping tags
    (``minimal``), and tags that describe characters from items with characters (``character``). ``character_core`` prunes like minimal, stores that, counts over it the core tags of
    each character's own items, and drops from an item those of its characters that the rules drop or start embeddings from; captions then name characters with core tags alone.
    Tags are put in ``order``, dropped ones after them if asked for, and cut to ``most``. ``core`` is (character, tag, kept, dropped, emb_init) in that mode, else None.
    Items' ids are unique; a null list of characters is an empty one. ``caption`` goes to captions.caption().
    """
    if mode not in MODES:
        raise ValueError(f"no such mode: {mode}")
    rows = items
    pruned_to, shown, drop_of, core_of, of, new_of = private(items, "_pruned", "_shown", "_drop", "_core", "_of", "_new")
    if predicted is not None:
        new = predicted.select(F.col("item_id").alias(of), F.col("tags").alias(new_of))
        rows = rows.join(new, F.col("item_id") == F.col(of), "left").withColumn("tags", F.coalesce(new_of, "tags") if overwrite else F.coalesce("tags", new_of)).drop(of, new_of)
    source = G.tag_source(F.col("tags"), F.col("processed_tags"), from_original, overwrite)
    first = "minimal" if mode == "character_core" else mode
    pruned = prune_tags(G.remove_underscore(source), F.col("characters"), first, rules.listed(), rules.overlaps(), rules.drops)
    rows = rows.withColumn(pruned_to, pruned).withColumns({"processed_tags": F.col(pruned_to)["kept"], "dropped_character_tags": F.col(pruned_to)["dropped"].cast(_TAGS)}).drop(pruned_to)
    # unknown names nobody
    rows = rows.withColumn(shown, F.filter(F.coalesce("characters", F.array().cast("array<string>")), lambda x: x != "unknown"))
    core = None
    if mode == "character_core":
        rows = materialize(rows, "pruned")
        names = rows.select("item_id", "characters", F.transform("processed_tags", lambda t: t["tag"]).alias("tags"))
        counted = K.core_tags(names, frequency)
        embedding = N.embedding_name(N.parse_character(F.col("character")))
        core = materialize(K.categories(counted, rules.drops(F.col("tag")), rules.starts(F.col("tag")), embedding), "core")
        lists = core.groupBy("character").agg(F.collect_set(F.when(F.col("dropped") | F.col("emb_init"), F.col("tag"))).alias("drop"))
        mine = rows.select(F.col("item_id").alias(of), F.posexplode(shown).alias("at", "character")).join(lists, "character").groupBy(of).agg(
            F.array_distinct(F.flatten(F.collect_list("drop"))).alias(drop_of), F.transform(F.array_sort(F.collect_list(F.struct("at", "character"))), lambda x: x["character"]).alias(core_of)
        )
        rows = rows.join(mine, F.col("item_id") == F.col(of), "left").drop(of)
        goes = lambda t: F.coalesce(F.array_contains(drop_of, t["tag"]), F.lit(False))
        has = F.size(F.coalesce("characters", F.array().cast("array<string>"))) > 0
        rows = rows.withColumns({
            "dropped_character_tags": F.when(has, F.filter("processed_tags", goes)), "processed_tags": F.filter("processed_tags", lambda t: ~goes(t)),
            shown: F.coalesce(core_of, F.array().cast("array<string>")),
        }).drop(drop_of, core_of)
    put = lambda c: G.sort_tags(c, order, F.col("item_id"), seed)
    last = put(F.col("dropped_character_tags")) if append_dropped else None
    rows = rows.withColumn("processed_tags", G.append_and_truncate(put(F.col("processed_tags")), last, most))
    named = {c: F.col(c) for c in items.columns} | {"tags": F.col("processed_tags"), "shown": F.col(shown)}
    return rows.withColumn("caption", C.caption(parts(named), F.col("item_id"), seed=seed, **(caption or {}))).drop(shown), core


def select_images(
    crops: DataFrame, originals: DataFrame, image_type: str, overwrite: bool = True, known_only: bool = False, with_crops: bool = True, with_originals: bool = True, plain: int = 0,
    largest: int | None = None, ending: str | None = None, vectors: DataFrame | None = None, near: float = 0.96, seed: int = 0,
) -> DataFrame:
    """(item_id, folder, filename, type, characters, w, h) of a data set's images.

    ``crops``: (item_id, parent_id, ord, class, w, h), class being the folder's name, of which noise folders name nobody; ``originals``: (item_id, characters, w, h). Originals get
    their crops' characters, see select.propagate_labels(); with ``known_only`` they keep of their own only names that a class has. Crops with characters come first, the original in
    place of a crop over half its area, then originals with characters, each image once; folder tells which: classified or raw. Of all others ``plain`` are drawn by a seeded
    hash, into no_characters. ``largest`` shrinks the shorter edge; ``ending`` replaces the file's. With ``vectors`` (item, vec) images with a cosine over ``near`` to one kept before in their folder go, in order of ids.
    Ids are unique and crops of unknown originals stay crops; a null list of characters is an empty one.
    """
    name = N.strip_number(F.col("class"))
    named = crops.withColumn("character", F.when(F.lower(name).startswith("noise") | (name == ""), F.lit(None)).otherwise(name))
    none = F.array().cast("array<string>")
    own = originals.withColumn("characters", F.coalesce("characters", none))
    if known_only and not overwrite:
        kept = own.select("item_id", F.posexplode("characters").alias("at", "x")).join(named.select(F.col("character").alias("x")).where("x is not null").distinct(), "x", "left_semi")
        kept = kept.groupBy("item_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("kept"))
        own = own.join(kept, "item_id", "left").withColumn("characters", F.coalesce("kept", none)).drop("kept")
    # with overwrite an original without classified crops has no characters left
    base = own.withColumn("characters", none) if overwrite else own
    whole = materialize(propagate_labels(named, base.select("item_id", "characters"), overwrite).join(own.drop("characters"), "item_id").withColumn("characters", F.coalesce("characters", none)), "originals")
    area = whole.select(F.col("item_id").alias("parent_id"), (F.col("w") * F.col("h")).alias("parent_area"))
    seen = named.join(area, "parent_id", "left").withColumn("large", F.coalesce((F.col("parent_id") != F.col("item_id")) & (F.col("w") * F.col("h") > 0.5 * F.col("parent_area")), F.lit(False)))
    has = F.col("character").isNotNull()
    parts = []
    if with_crops:
        parts.append(seen.where(has).select(F.when(F.col("large"), F.col("parent_id")).otherwise(F.col("item_id")).alias("item_id"), F.lit(0).alias("rank")))
        parts.append(seen.where(~has).select("item_id", F.lit(2).alias("rank")))
    if with_originals:
        parts.append(whole.select("item_id", F.when(F.size("characters") > 0, 1).otherwise(2).alias("rank")))
    every = parts[0] if parts else crops.select("item_id", F.lit(0).alias("rank")).limit(0)
    for p in parts[1:]:
        every = every.unionByName(p)
    once = every.groupBy("item_id").agg(F.min("rank").alias("rank"))
    chosen = once.where("rank < 2").unionByName(sample_rows(once.where("rank = 2"), "item_id", plain, seed))
    about = named.select("item_id", F.when(has, F.array("character")).otherwise(none).alias("characters"), "w", "h").join(whole.select("item_id"), "item_id", "left_anti").unionByName(whole.select("item_id", "characters", "w", "h"))
    dims = F.struct("w", "h") if largest is None else B.resize_dims(F.col("w"), F.col("h"), largest)
    file = F.substring_index("item_id", "/", -1)
    folder = F.element_at(F.array(*map(F.lit, ("classified", "raw", "no_characters"))), F.col("rank") + 1)
    out = chosen.join(about, "item_id").withColumn("d", dims).select(
        "item_id", folder.alias("folder"), (file if ending is None else F.concat(F.regexp_replace(file, r"\.[^.]*$", ""), F.lit(f".{ending}"))).alias("filename"),
        F.lit(image_type).alias("type"), "characters", F.col("d.w").cast("int").alias("w"), F.col("d.h").cast("int").alias("h"),
    )
    if vectors is None:
        return out
    out = materialize(out, "selected")
    rows = vectors.join(out.select(F.col("item_id").alias("item"), "folder"), "item")
    kept = S.keep_first(out.select(F.col("item_id").alias("item")), S.similar_pairs(rows, near, scope="folder"))
    return out.join(kept.select(F.col("item").alias("item_id")), "item_id", "left_semi")


def import_metadata(images: DataFrame, stored: DataFrame, sidecars: dict[str, DataFrame] | None = None, grabbed: DataFrame | None = None, mapping: DataFrame | None = None, overwrite_path: bool = False) -> DataFrame:
    """Images (path, filename, group_id, more) with all that is known beside them.

    In turn: stored metadata (base, fields); for each attribute its side files (base, values), which replace it; the fields of ``grabbed`` (base, field, values), which replace
    both, lists for characters, copyright, artist and tags, single texts for others; then characters by ``mapping`` (old, new), where a name without a new one stays. A base is a
    path without its ending; of two rows for one base and field the smaller stays. Tags from side files have no scores.
    """
    from siftloom.sources.files import item_metadata
    from siftloom.sources.scan import base_key

    rows = item_metadata(images, stored, overwrite_path)
    own, of, found, renamed, at = private(rows, "_base", "_of", "_values", "_named", "_at")
    rows = rows.withColumn(own, base_key(F.col("current_path")))
    scored = lambda v: F.transform(v, lambda t: F.struct(t.alias("tag"), F.lit(None).cast("double").alias("score")))

    def put(rows: DataFrame, name: str, values: DataFrame, shape: Callable[[Column], Column]) -> DataFrame:
        one = values.groupBy(F.col("base").alias(of)).agg(F.min("values").alias(found))
        joined = rows.join(one, F.col(own) == F.col(of), "left")
        new = shape(F.col(found))
        return joined.withColumn(name, F.coalesce(new, F.col(name)) if name in rows.columns else new).drop(of, found)

    lists = {"characters": lambda v: v, "copyright": lambda v: v, "artist": lambda v: v, "tags": scored}
    for name, values in (sidecars or {}).items():
        rows = put(rows, name, values, lists.get(name, lambda v: v))
    if grabbed is not None:
        for name, shape in {**lists, **{c: (lambda v: F.get(v, F.lit(0))) for c in ("rating", "score", "fav_count")}}.items():
            rows = put(rows, name, grabbed.where(F.col("field") == name), shape)
    if mapping is not None and "characters" in rows.columns:
        pairs = mapping.where("new is not null and new <> ''").groupBy("old").agg(F.min("new").alias("new"))
        named = rows.select(F.col(own).alias(of), F.posexplode("characters").alias(at, "old")).join(pairs, "old", "left").groupBy(of).agg(
            F.transform(F.array_sort(F.collect_list(F.struct(at, F.coalesce("new", "old").alias("x")))), lambda s: s["x"]).alias(renamed)
        )
        rows = rows.join(named, F.col(own) == F.col(of), "left").withColumn("characters", F.coalesce(renamed, "characters")).drop(of, renamed)
    return rows.drop(own)

"""Metadata files beside images, hidden ones among them, as a data source of Spark's.

Spark's own file readers leave out names that begin with a dot. This source lists folders in the tasks:
planning goes down as many levels as are asked for and makes one partition for each folder found there; a task lists
what is below its folder and reads the metadata files one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: Forms of a metadata file's name for an image ``x.png``, the one that counts first.
HIDDEN, MARKED, PLAIN = ".x_meta.json", "x_meta.json", "x.json"
#: Levels of folders below the given one that become partitions of their own.
LEVELS = 2


def plain_path(uri: Column) -> Column:
    """A file's URI as Spark's binary file reader spells it: nothing percent-encoded, one slash after ``file:``."""
    # url_decode takes a plus for a space
    return F.regexp_replace(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def image_base(folder: str, name: str) -> tuple[str, int] | None:
    """The path without ending of the image that a file belongs to, and the rank of the name's form; None if the name has no such form."""
    if not name.lower().endswith(".json"):
        return None
    stem = name[:-5]
    if not stem:
        return None
    if stem.startswith("."):
        return (f"{folder}/{stem[1:-5]}", 0) if stem.endswith("_meta") and len(stem) > 6 else None
    return (f"{folder}/{stem[:-5]}", 1) if stem.endswith("_meta") and len(stem) > 5 else (f"{folder}/{stem}", 2)


class _Folder(InputPartition):
    def __init__(self, path: str, deep: bool) -> None:
        super().__init__(path)
        self.path, self.deep = path, deep


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.root, self.levels = options["path"], int(options.get("levels", LEVELS))

    def _store(self) -> tuple:
        """The file system of the root, the root's path in it, and what stands before paths outside it."""
        from pyarrow import fs

        root = self.root.rstrip("/") or "/"
        if "://" not in root and not root.startswith("file:"):
            return fs.LocalFileSystem(), root, "file:"
        if root.startswith("file:"):
            return fs.LocalFileSystem(), "/" + root[5:].lstrip("/"), "file:"
        store, path = fs.FileSystem.from_uri(quote(unquote(root), safe=":/@?=&"))
        return store, path, root[: len(root) - len(path)] if root.endswith(path) else root.split("://")[0] + "://"

    def partitions(self) -> list[_Folder]:
        from pyarrow import fs

        store, root, _ = self._store()
        out, level = [], [root]
        for depth in range(self.levels + 1):
            out += [_Folder(d, depth == self.levels) for d in level]
            if depth < self.levels:
                level = sorted(x.path for d in level for x in store.get_file_info(fs.FileSelector(d)) if x.type == fs.FileType.Directory)
        return out

    def read(self, partition: _Folder) -> Iterator[tuple]:
        from pyarrow import fs

        store, _, before = self._store()
        for info in store.get_file_info(fs.FileSelector(partition.path, recursive=partition.deep)):
            if info.type != fs.FileType.File:
                continue
            folder, _, name = info.path.rpartition("/")
            found = image_base(folder, name)
            if found:
                with store.open_input_stream(info.path) as f:
                    body = f.read()
                yield before + info.path, before + found[0], found[1], body.decode("utf-8", "replace")


class SidecarSource(DataSource):
    """``spark.read.format("sidecars").load(folder)``: (path, base, rank, body) of the metadata files below a folder.

    ``folder`` is a local path or a URI of a store that Arrow opens. The option ``levels`` says how far down folders are
    partitions of their own.
    """

    @classmethod
    def name(cls) -> str:
        return "sidecars"

    def schema(self) -> str:
        return "path string, base string, rank int, body string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)


def read_sidecars(spark: SparkSession, folder: str, schema: str, broken: str = "broken", levels: int = LEVELS) -> DataFrame:
    """(base, fields of ``schema``, ``broken``) of the metadata files below a folder, one row for each image they belong to.

    Of several files of one image the hidden one counts, then the one marked as metadata. A file that isn't JSON, or in which a
    field has another type, gives a row with null for what can't be read, and ``broken`` true. An empty folder gives no rows.
    """
    spark.dataSource.register(SidecarSource)
    files = spark.read.format("sidecars").option("levels", levels).load(folder)
    best = files.groupBy("base").agg(F.min(F.struct("rank", "path", "body")).alias("f"))
    text = "_unread"
    parsed = F.from_json(F.col("f.body"), f"{schema}, {text} string", {"columnNameOfCorruptRecord": text, "mode": "PERMISSIVE"})
    rows = best.select("base", parsed.alias("m"))
    fields = [c for c in rows.schema["m"].dataType.names if c != text]
    return rows.select("base", *(F.col("m")[c].alias(c) for c in fields), (F.col("m").isNull() | F.col("m")[text].isNotNull()).alias(broken))

"""Session helpers: shared scratch tables that cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_own_root: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``. Where that is unset a temporary folder serves, on a local master alone."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_root:
        _own_root[app] = "file://" + tempfile.mkdtemp(prefix="siftloom-")
    return _own_root[app]


def _folder(spark: SparkSession, path: str) -> tuple:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go with the query that made them: what is written is read from its table from then on.

    It is a setting of the session: a query that another thread of the session starts meanwhile may have it too, and then frees its shuffle files at its end.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialize(df: DataFrame, name: str = "table", among: Scratch | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared scratch folder and return a reader of it.

    The table replaces the lineage: whatever is lost later is read again, not computed again.
    It is deleted when the application ends, or with the tables of ``among``.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    with _shuffles_freed(spark):
        df.write.options(compression="zstd", **(among.options if among is not None else {})).parquet(path)
    files, where = _folder(spark, path)
    files.deleteOnExit(where)
    if among is not None:
        among.paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Scratch tables of one job, deleted together once the job's result is stored apart from them. ``options`` are those of Spark's Parquet writer."""

    def __init__(self, spark: SparkSession, options: dict[str, str] | None = None) -> None:
        self.spark, self.options = spark, options or {}
        self.paths: list[str] = []

    def store(self, df: DataFrame, name: str = "table") -> DataFrame:
        return materialize(df, name, self)

    def free(self) -> None:
        for path in self.paths:
            files, where = _folder(self.spark, path)
            files.delete(where, True)
        self.paths.clear()


def private(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have, whatever its own are: each of ``names``, with underscores before it as needed."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


#: Rows that cross to Python at once: whole texts are long, so few.
ARROW_ROWS = "512"


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, and Python workers on this machine import the package from where the driver did."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parent.parent)
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

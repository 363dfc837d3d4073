"""From documents to packed training sequences: five stages, each a table written and read again.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame. All but the last give the columns of documents; of an empty
table they give an empty one. Null texts are empty, texts are taken whole, and columns besides those of documents stay, whatever
their names. What each operator does with nulls, ties and repeated rows stands in its own description.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftloom.llm.op1_language import UNKNOWN, fit_profiles, predict
from siftloom.llm.op3_probminhash import near_duplicates
from siftloom.llm.op4_mixing import BUDGET_PER_MILLE, LEVELS, MAX_EPOCHS, WEIGHTS, mix, with_levels
from siftloom.llm.op6_line_join import remove_lines
from siftloom.llm.op8_packing import VOCABULARY, pack, token_pieces
from siftloom.session import materialize, prepare, private, table

#: Texts of a lower cosine with every language are rejected. Texts of one or two words lie above it.
LEAST_COSINE = 0.05


def _named(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that names a document beside its id, in case ids repeat, and that column's name."""
    (name,) = private(docs, "_name")
    return docs.withColumn(name, F.md5(F.coalesce("text", F.lit("")))), name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters and those like no language; a missing language is filled in."""
    prepare(spark)
    judged = predict(docs, fit_profiles(docs))
    kept = judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_COSINE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that match an earlier line, and documents of which nothing is left."""
    prepare(spark)
    return remove_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates, that of the smallest id. Of repeated rows one stays."""
    prepare(spark)
    named, name = _named(docs)
    of_key, of_name = private(named, "_of_key", "_of_name")
    kept = near_duplicates(docs).where("kept").select(F.col("doc_id").alias(of_key), F.col("name").alias(of_name))
    rows = named.join(kept, F.col("doc_id").eqNullSafe(F.col(of_key)) & (F.col(name) == F.col(of_name)), "left_semi")
    return rows.dropDuplicates(["doc_id", name]).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Selects documents to the sources' target weights; a document of two epochs comes twice. Documents stay whole.

    Rows of equal id and text are selected alike. A null language or source is one of its own.
    """
    prepare(spark)
    named, name = _named(docs)
    keyed = named.withColumn(name, F.concat_ws(":", F.col("doc_id").cast("string"), name))
    levels = with_levels(keyed.select(F.col(name).alias("name"), "text", "lang", "source")).select("name", *LEVELS, "tokens")
    chosen = mix(materialize(levels, "levels"), LEVELS, WEIGHTS, BUDGET_PER_MILLE, MAX_EPOCHS, key="name").groupBy("name").agg(F.max("copies").alias("copies"))
    of_name, copies, copy = private(keyed, "_of_name", "_copies", "_copy")
    chosen = chosen.where("copies > 0").toDF(of_name, copies)
    rows = keyed.join(chosen, F.col(name) == F.col(of_name))
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences with their places in packed sequences."""
    prepare(spark)
    pieces = materialize(token_pieces(docs.select("doc_id", "text"), VOCABULARY).drop("text"), "pieces")
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixture", mixture), ("packing", packing),
]
#: Language vectors, ProbMinHash and tokenizers are beyond SQL; line removal, near-duplicates and packing are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each to the stored result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

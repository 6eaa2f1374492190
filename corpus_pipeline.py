"""A training corpus from raw documents: language, quality, repeated lines, near duplicates, packed windows.

STAGES are applied in order; each gets what the one before kept, as written
Parquet. All but the last return the columns of ``documents``. A stage learns, if it
does, from the documents it is given and the ``labels`` of the corpus.

ORACLE_SQL is None: SQL expresses neither the trained models nor the tokeniser.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hiremill.llm.common import fold, table
from hiremill.llm.jaccard import jaccard_components
from hiremill.llm.language import UNKNOWN, language_column, train_language_model
from hiremill.llm.line_dedup import dedup_lines
from hiremill.llm.packing import pack_documents
from hiremill.llm.quality import THRESHOLD, quality_column, train_quality_model
from hiremill.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Below this, neither the family nor the language was told from the others by any margin.
LEAST_LANGUAGE_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; texts that are NULL, without letters or undecided go."""
    model = train_language_model(docs.filter(fold("doc_id", 4) != 2))
    found = docs.select(*COLUMNS, language_column(model)("text").alias("found"))
    return found.filter((F.col("found.lang_pred") != UNKNOWN) & (F.col("found.score") >= LEAST_LANGUAGE_SCORE)).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = train_quality_model(docs, table(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0))
    return docs.select(*COLUMNS, quality_column(model)("text").alias("score")).filter(F.col("score") >= THRESHOLD).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that stand in an earlier place; documents left without any go."""
    left = dedup_lines(docs.select(*COLUMNS)).filter(F.trim("text", F.lit(" \t\r\n")) != "")
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates one row: that with the smallest id, NULL as the largest, then by its text's hash.

    A row is known by its id and text, so only rows equal in both or of one class are
    reduced: neither missing nor repeated ids lose a class. Rows without a word are each their own class.
    """
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.md5("text").alias("text_key"))
    first = jaccard_components(docs.select(key.alias("row"), "text"), id_col="row").filter(F.col("doc_id") == F.col("component_id"))
    first = first.select(F.col("doc_id.doc_id").alias("first_id"), F.col("doc_id.text_key").alias("first_key")).distinct()
    kept = docs.select(*COLUMNS, F.md5("text").alias("text_key")).join(
        first, F.col("doc_id").eqNullSafe(F.col("first_id")) & F.col("text_key").eqNullSafe(F.col("first_key")), "left_semi"
    )
    once = Window.partitionBy("doc_id", "text_key").orderBy("lang", "source", "n_chars")
    return kept.withColumn("copy", F.row_number().over(once)).filter("copy = 1").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the windows of 2048 tokens."""
    return pack_documents(docs).drop("ids")


STAGES = [
    ("language_id", language_id),
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Quality labels, quarantine and the profile report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hiremill.functions.labels import quality_label
from hiremill.functions.text import blank
from hiremill.schemas import JOBS, conform


def label_jobs(jobs: DataFrame) -> DataFrame:
    return conform(jobs, JOBS).withColumn("quality", quality_label())


def high_quality(labelled: DataFrame) -> DataFrame:
    """What stays in ``jobs``."""
    return labelled.filter(F.col("quality") == "HIGH")


def low_quality(labelled: DataFrame) -> DataFrame:
    """What moves to quarantine, replacing what was there."""
    return labelled.filter(F.col("quality") == "LOW")


def quality_counts(labelled: DataFrame) -> DataFrame:
    return labelled.agg(
        F.count_if(F.col("quality") == "HIGH").alias("high"), F.count_if(F.col("quality") == "LOW").alias("low")
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("count"))


def missing_counts(jobs: DataFrame) -> DataFrame:
    return jobs.agg(*[F.count_if(blank(c)).alias(f"null_{c}") for c in ("job_title", "company", "description")])


def mean_description_length(jobs: DataFrame) -> DataFrame:
    """Whole characters, rounded towards zero; 0 for an empty table."""
    return jobs.agg(_mean_length(F.lit(True)).alias("avg_description_length"))


def _mean_length(keep: Column) -> Column:
    return F.coalesce(F.avg(F.when(keep, F.length("description"))).cast("bigint"), F.lit(0))


def shortest_description(jobs: DataFrame) -> DataFrame:
    """Shortest description that is not NULL; the lower ``source_id`` wins a tie."""
    return _lengths(jobs).orderBy("desc_len", "source_id").limit(1)


def longest_description(jobs: DataFrame) -> DataFrame:
    return _lengths(jobs).orderBy(F.desc("desc_len"), "source_id").limit(1)


def _lengths(jobs: DataFrame) -> DataFrame:
    return jobs.filter(F.col("description").isNotNull()).select(
        F.length("description").cast("bigint").alias("desc_len"), "source_id", "job_title"
    )


def quality_report(labelled: DataFrame) -> DataFrame:
    """The profile of the kept rows and the number quarantined, in one pass over the labelled table."""
    high = F.col("quality") == "HIGH"
    size = F.length("description").cast("bigint")

    def extreme(rank: Column) -> Column:
        found = F.struct(size.alias("len"), "source_id", "job_title")
        return F.min_by(found, F.when(high & size.isNotNull(), F.struct(rank, "source_id")))

    one = labelled.agg(
        F.count_if(high).alias("total_records"),
        F.count_if(~high).alias("quarantined"),
        *[F.count_if(high & blank(c)).alias(f"null_{c}") for c in ("job_title", "company", "description")],
        _mean_length(high).alias("avg_description_length"),
        extreme(size).alias("short"),
        extreme(-size).alias("long"),
    )
    named = []
    for column, word in (("short", "shortest"), ("long", "longest")):
        named += [
            F.coalesce(f"{column}.len", F.lit(0)).alias(f"{word}_length"),
            # No row at all reads N/A; the title of a row may itself be NULL.
            F.when(F.col(column).isNull(), "N/A").otherwise(F.col(f"{column}.source_id")).alias(f"{word}_source_id"),
            F.when(F.col(column).isNull(), "N/A").otherwise(F.col(f"{column}.job_title")).alias(f"{word}_job_title"),
        ]
    return one.select(*[c for c in one.columns if c not in ("short", "long")], *named)

"""Comparison of two analysis runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _change(a: str, b: str) -> Column:
    """Saving of ``b`` against ``a`` in percent, NULL when ``a`` is 0."""
    return F.when(F.col(a) != 0, (F.col(a) - F.col(b)) * 100.0 / F.col(a))


def compare_runs(first: DataFrame, second: DataFrame, key: str = "resume_id") -> DataFrame:
    """Per key: are the gap lists identical, and how much did tokens and time fall in percent."""
    columns = ("gaps", "total_tokens", "time_ms")
    a = first.select(key, *[F.col(c).alias(f"a_{c}") for c in columns])
    b = second.select(key, *[F.col(c).alias(f"b_{c}") for c in columns])
    return a.join(b, key, "full_outer").select(
        key,
        F.col("a_gaps").eqNullSafe(F.col("b_gaps")).alias("gaps_identical"),
        _change("a_total_tokens", "b_total_tokens").alias("token_saving_pct"),
        _change("a_time_ms", "b_time_ms").alias("time_saving_pct"),
    )


def differing_rows(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows in only one of two results, with the side that has them; repeated rows count."""
    only_first = first.exceptAll(second.select(*first.columns)).withColumn("side", F.lit("first"))
    only_second = second.select(*first.columns).exceptAll(first).withColumn("side", F.lit("second"))
    return only_first.unionByName(only_second)

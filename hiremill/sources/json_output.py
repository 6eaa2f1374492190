"""JSON sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hiremill.operators.gaps import demand_map
from hiremill.schemas import LISTING_FIELDS


def write_records(silver: DataFrame, path: str) -> None:
    """Valid listings as JSON objects, replacing what an earlier run wrote."""
    silver.select(*LISTING_FIELDS).write.mode("overwrite").json(path)


def write_results(reports: DataFrame, path: str) -> None:
    """One JSON object per resume: gaps, demand per skill, tokens, time."""
    reports.withColumn("demand_statistics", demand_map("demand_statistics")).write.mode("overwrite").json(path)

"""Validation of extracted listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiremill.functions.labels import first_bad_field
from hiremill.functions.text import strip
from hiremill.schemas import LISTING_FIELDS


def check_listings(listings: DataFrame) -> DataFrame:
    """Stripped fields plus ``bad_field``: the first blank one, NULL for a valid record."""
    stripped = [strip(f).alias(f) for f in LISTING_FIELDS]
    return listings.select("doc_key", *stripped, first_bad_field().alias("bad_field"))


def valid_listings(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("bad_field").isNull()).drop("bad_field")


def rejected_listings(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("bad_field").isNotNull()).select("doc_key", "bad_field")


def silver_summary(checked: DataFrame) -> DataFrame:
    """Totals, and the number of rejects per first bad field."""
    bad = F.col("bad_field")
    return checked.agg(
        F.count("*").alias("total"),
        F.count_if(bad.isNull()).alias("processed"),
        F.count_if(bad.isNotNull()).alias("skipped"),
        *[F.count_if(bad == f).alias(f"missing_{f}") for f in LISTING_FIELDS],
    )

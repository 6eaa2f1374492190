"""Table schemas and additive schema evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


CONTENT_FIELDS = ["job_title", "company", "description"]
LISTING_FIELDS = ["source_id", *CONTENT_FIELDS]

BRONZE = _strings("doc_key", "html", "error_kind", "error")
SILVER = _strings("doc_key", *LISTING_FIELDS)
REJECTS = _strings("doc_key", "bad_field")
JOBS = _strings(*LISTING_FIELDS, "tech_stack", "content_hash", "quality")
CHANGES = _strings("doc_key", "source_id", "content_hash", "action")
RATE_LIMITS = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("rpm", T.LongType()),
        T.StructField("tpm", T.LongType()),
        T.StructField("rpd", T.LongType()),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``; absent ones become NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )

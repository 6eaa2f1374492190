"""Counts, sums and extremes of the jobs kept by the changes of each load, without a scan of the jobs.

A load takes the old rows of its keys away (sign -1) and adds the new ones (+1). Summed by
name, these are the deltas of every count and sum. The shortest description is kept for each
bucket of the table: a load re-reads the buckets it touches anyway, and takes the extreme over buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiremill.functions.skills import parse_skills

MEASURES = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("name", T.StringType()), T.StructField("n", T.LongType()), T.StructField("total", T.LongType())]
)


def signed_rows(before: DataFrame, after: DataFrame, changed: DataFrame) -> DataFrame:
    """Rows of ``changed`` keys as they were (-1) and as they are (+1); rows without a key only ever come."""
    keys = changed.select("source_id").distinct()
    old = before.join(keys, "source_id", "left_semi").withColumn("sign", F.lit(-1))
    new = after.join(keys, "source_id", "left_semi").withColumn("sign", F.lit(1))
    alone = [side.filter(F.col("source_id").isNull()).withColumn("sign", F.lit(sign)) for side, sign in ((before, -1), (after, 1))]
    return old.unionByName(new).unionByName(alone[0]).unionByName(alone[1])


def measures(signed: DataFrame) -> DataFrame:
    """``(kind, name, n, total)`` of signed rows: jobs with their characters, companies, skills, quality labels."""
    sign, zero = F.col("sign").cast("long"), F.lit(0).cast("long")
    length = F.coalesce(F.length("description"), F.lit(0)) * F.col("sign")
    named = F.col("company").isNotNull() & (F.col("company") != "")
    entry = lambda kind, name, n, total: F.struct(F.lit(kind).alias("kind"), name.alias("name"), n.alias("n"), total.cast("long").alias("total"))
    of_row = F.array_compact(
        F.array(
            entry("jobs", F.lit(""), sign, length),
            F.when(named, entry("company", F.col("company"), sign, zero)),
            F.when(F.col("quality").isNotNull(), entry("quality", F.col("quality"), sign, zero)),
        )
    )
    skills = F.transform(parse_skills("tech_stack"), lambda s: entry("skill", s, sign, zero))
    every = F.concat(of_row, F.when(F.col("tech_stack").isNotNull(), skills).otherwise(F.slice(of_row, 1, 0)))
    return total(signed.select(F.explode(every).alias("m")).select("m.*"))


def total(rows: DataFrame) -> DataFrame:
    return rows.groupBy("kind", "name").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def shortest_by_bucket(before: DataFrame, after: DataFrame) -> DataFrame:
    """The change of each bucket's shortest description: the old one out, the new one in. Both sides have ``bucket``."""

    def one(rows: DataFrame, sign: int) -> DataFrame:
        least = rows.filter(F.col("description").isNotNull()).groupBy("bucket").agg(F.min(F.length("description")).cast("long").alias("least"))
        return least.select(F.lit("shortest").alias("kind"), F.col("bucket").cast("string").alias("name"), F.lit(sign).cast("long").alias("n"), (F.col("least") * sign).alias("total"))

    return total(one(before, -1).unionByName(one(after, 1)))


def merged(kept: DataFrame, deltas: DataFrame) -> DataFrame:
    """Kept measures after the deltas; names that count nothing any more go."""
    return total(kept.select("kind", "name", "n", "total").unionByName(deltas)).filter("n <> 0 or total <> 0")


def counts_of(kept: DataFrame, kind: str, name: str, value: str) -> DataFrame:
    """``(name, value)`` of one kind."""
    return kept.filter(F.col("kind") == kind).select(F.col("name").alias(name), F.col("n").alias(value))


def top_of(kept: DataFrame, kind: str, n: int) -> DataFrame:
    """The ``n`` largest of one kind, ties by name, with their place from 1."""
    best = kept.filter(F.col("kind") == kind).orderBy(F.desc("n"), "name").limit(n)
    return best.select(F.row_number().over(Window.orderBy(F.desc("n"), "name")).alias("place"), "name", "n")


def overview(kept: DataFrame) -> DataFrame:
    """One row: ``jobs``, ``mean_chars`` and ``shortest`` over all."""
    of = lambda kind, c: F.when(F.col("kind") == kind, F.col(c))
    return kept.agg(
        F.coalesce(F.sum(of("jobs", "n")), F.lit(0)).alias("jobs"),
        (F.sum(of("jobs", "total")) / F.sum(of("jobs", "n"))).alias("mean_chars"),
        F.min(of("shortest", "total")).alias("shortest"),
    )

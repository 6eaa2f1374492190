"""Keyword search over an index of trigrams: a search reads the jobs that can match, not all.

Three tables under one folder: ``rows``, the jobs sorted by key with Bloom filters;
``postings``, one row for each job and trigram of its title, company or description, in
folders by a hash of the trigram and sorted by it; and ``trigrams``, how many postings each has. Letters A-Z
are folded, as the search itself does.

A search takes the trigrams of its pattern's literal runs. If one has no posting, nothing matches. Else
the rarest few are intersected, and what is left is looked up by key. These are candidates: the
search is then made on them as on the whole table, so its rows are the same. A pattern without a run of three
characters (short, blank, or mostly wildcards) and a search for the small companies read all jobs.

Jobs without a key are always candidates. Of a key that stands more than once all rows are. An empty table
gives an empty index.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hiremill.functions.text import UPPER, or_empty
from hiremill.operators.dashboard import asks_for_others, cleaned
from hiremill.sources.buckets import bucket_of
from hiremill.sources.keyed import lookup, write_keyed

SEARCHED = ("job_title", "company", "description")
KEY = "source_id"
BUCKETS = 256
#: The rarest trigrams of a pattern that are intersected; the search itself checks the rest.
RAREST = 4


def folded(c: Column | str) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def _joined(a: Column, b: Column) -> Column:
    return F.concat(a, b)


def trigrams(c: Column | str) -> Column:
    """Array of the distinct trigrams of a text, A-Z folded; none for NULL and texts under three characters."""
    letters = F.split(folded(or_empty(c)), "")
    rest = F.greatest(F.size(letters), F.lit(1))
    pairs = F.zip_with(letters, F.slice(letters, F.lit(2), rest), _joined)
    triples = F.zip_with(pairs, F.slice(letters, F.lit(3), rest), _joined)
    # Past the end there is nothing to join: NULL.
    return F.array_distinct(F.filter(triples, lambda t: t.isNotNull()))


def pattern_trigrams(query: str) -> list[str]:
    """The trigrams every match of a search holds: those of the runs between its wildcards."""
    runs = re.split("[%_]", cleaned(query).translate(str.maketrans(UPPER, UPPER.lower())))
    return sorted({run[i : i + 3] for run in runs for i in range(len(run) - 2)})


def write_index(jobs: DataFrame, path: str, buckets: int = BUCKETS, files: int | None = None) -> None:
    """Build the index of ``jobs`` (and a copy of them in key order) under a new folder."""
    spark = jobs.sparkSession
    write_keyed(jobs, f"{path}/rows", KEY, files)
    held = F.array_distinct(F.flatten(F.array(*map(trigrams, SEARCHED))))
    postings = jobs.filter(F.col(KEY).isNotNull()).select(KEY, F.explode(held).alias("trigram"))
    placed = postings.withColumn("bucket", bucket_of(buckets, "trigram"))
    # A frequent trigram makes a large folder, not a large task: Spark splits what it rebalances.
    laid_out = placed.hint("rebalance", "bucket").sortWithinPartitions("bucket", "trigram")
    laid_out.write.partitionBy("bucket").parquet(f"{path}/postings")
    counts = _postings(spark, path).groupBy("bucket", "trigram").agg(F.count("*").alias("postings"))
    write_keyed(counts, f"{path}/trigrams", "trigram", files)


def _postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{KEY} string, trigram string, bucket int").parquet(f"{path}/postings")


def rarest_postings(spark: SparkSession, path: str, wanted: list[str]) -> tuple[DataFrame, int] | None:
    """The postings of the rarest of the wanted trigrams and their number; None if one of the wanted has none."""
    counts = spark.read.parquet(f"{path}/trigrams").filter(F.col("trigram").isin(wanted))
    # At most one row for each trigram of a pattern comes to the driver.
    found = counts.orderBy("postings", "trigram").collect()
    if len(found) < len(wanted):
        return None
    rarest = found[:RAREST]
    buckets, names = sorted({r["bucket"] for r in rarest}), [r["trigram"] for r in rarest]
    return _postings(spark, path).filter(F.col("bucket").isin(buckets) & F.col("trigram").isin(names)), len(names)


def candidates(spark: SparkSession, path: str, query: str) -> DataFrame:
    """Jobs of an index among which all matches of ``query`` are; the operators of ``dashboard`` search them."""
    rows = spark.read.parquet(f"{path}/rows")
    wanted = pattern_trigrams(query)
    if asks_for_others(query) or not wanted:
        return rows
    keyless = rows.filter(F.col(KEY).isNull())
    found = rarest_postings(spark, path, wanted)
    if found is None:
        return keyless
    postings, n = found
    keys = postings.groupBy(KEY).agg(F.count_distinct("trigram").alias("held")).filter(F.col("held") == n)
    return lookup(spark, f"{path}/rows", keys.select(KEY), KEY).unionByName(keyless)

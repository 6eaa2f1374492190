"""Load of arriving records into the jobs table by content hash.

A record inserts when its key is new, updates when its content hash differs
from the state the previous record of that key left, and is skipped otherwise.
The state is always the hash of the previous record (a skip means both are
equal), so the sequential load is a ``lag`` over the records of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hiremill.functions.text import content_hash
from hiremill.operators.ordering import SAMPLES_PER_CHUNK, chunk_of, cut_table
from hiremill.schemas import CONTENT_FIELDS, JOBS, conform

# Keys with more records than this are sorted in several tasks.
HOT_ROWS = 1_000_000
MAX_CHUNKS = 512

# SQLite lets a text primary key be NULL any number of times: such records
# never meet, so each stands under a key of its own. The first letter says which kind it is.
_NO_KEY, _KEY = "0", "1"


def _record_key() -> Column:
    return F.coalesce(F.concat(F.lit(_KEY), F.col("source_id")), F.concat(F.lit(_NO_KEY), F.col("doc_key")))


def stage(records: DataFrame) -> DataFrame:
    """Parsed records that can be loaded, with their content hash."""
    if "load_error" in records.columns:
        records = records.filter(F.col("load_error").isNull()).drop("load_error")
    return records.withColumn("content_hash", content_hash(*CONTENT_FIELDS))


def _hot_key_cuts(staged: DataFrame, hot_rows: int) -> DataFrame:
    """``(_key, cuts)``: table of ``doc_key`` cut points of every key with over ``hot_rows`` records.

    Chunks hold ``hot_rows`` records or more, so all cuts together number at
    most ``rows / hot_rows``. Reads the two key columns only.
    """
    keys = staged.select(_record_key().alias("_key"), "doc_key")
    counts = keys.groupBy("_key").agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows)
    per_chunk = F.greatest(F.lit(hot_rows), F.ceil(F.col("_n") / MAX_CHUNKS))
    spacing = F.greatest(F.lit(1), F.floor(per_chunk / SAMPLES_PER_CHUNK))
    sampled = keys.join(F.broadcast(counts), "_key").filter(F.pmod(F.xxhash64("doc_key"), spacing) == 0)
    return sampled.groupBy("_key").agg(cut_table(F.collect_list("doc_key")).alias("cuts"))


def upsert_actions(staged: DataFrame, prior: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(doc_key, source_id, content_hash, action)`` for each staged record, in ``doc_key`` order per key.

    ``staged`` needs unique ``doc_key``s; ``prior`` has unique ``source_id``s.
    Only keys and hashes are shuffled, once, by key and chunk: a hot key is cut
    into chunks by ``doc_key``, and the first record of a chunk takes the last
    hash of the chunk before it.
    """
    arriving = staged.select(_record_key().alias("_key"), F.lit(1).alias("_turn"), "doc_key", "content_hash")
    # Of the table only the keys that arrive matter; a small load broadcasts its keys, so nothing else is shuffled.
    met = prior.join(staged.select("source_id").distinct(), "source_id", "left_semi")
    standing = met.select(
        F.concat(F.lit(_KEY), F.col("source_id")).alias("_key"), F.lit(0).alias("_turn"), F.lit("").alias("doc_key"), "content_hash"
    )
    # The cuts are bounded by rows / hot_rows strings in all (see _hot_key_cuts).
    # Keys are never NULL; saying so keeps both uses of the shuffle below alike, so it runs once.
    records = (
        standing.unionByName(arriving)
        .filter(F.col("_key").isNotNull())
        .join(F.broadcast(_hot_key_cuts(staged, hot_rows)), "_key", "left")
        .withColumn("_hot", F.col("cuts").isNotNull())
        .withColumn(
            "_chunk",
            F.when(~F.col("_hot") | (F.col("_turn") == 0), 0).otherwise(chunk_of(F.col("doc_key"), F.col("cuts"))),
        )
        .drop("cuts")
    )
    in_chunk = Window.partitionBy("_key", "_chunk").orderBy("_turn", "doc_key")
    compared = (
        records.withColumn("_before", F.lag("content_hash").over(in_chunk))
        .withColumn("_first", F.row_number().over(in_chunk) == 1)
        .withColumn("_last", F.lead(F.lit(True)).over(in_chunk).isNull())
    )
    # One row per chunk of a hot key.
    chunk_ends = compared.filter(F.col("_hot") & F.col("_last")).select("_key", "_chunk", "content_hash")
    by_chunk = Window.partitionBy("_key").orderBy("_chunk")
    carried = chunk_ends.select(
        "_key",
        "_chunk",
        F.lag("content_hash").over(by_chunk).alias("_carried"),
        (F.row_number().over(by_chunk) > 1).alias("_has_carried"),
    )
    joined = compared.join(carried, ["_key", "_chunk"], "left")
    crosses = F.col("_hot") & F.col("_first") & F.coalesce("_has_carried", F.lit(False))
    known = ~F.col("_first") | crosses
    before = F.when(crosses, F.col("_carried")).otherwise(F.col("_before"))
    action = (
        F.when(~known, "insert").when(~before.eqNullSafe(F.col("content_hash")), "update").otherwise("skip")
    )
    source_id = F.when(F.col("_key").startswith(_KEY), F.expr("substring(_key, 2)"))
    return joined.filter(F.col("_turn") == 1).select(
        "doc_key", source_id.alias("source_id"), "content_hash", action.alias("action")
    )


def apply_changes(prior: DataFrame, staged: DataFrame, actions: DataFrame) -> DataFrame:
    """The jobs table after the load.

    Each changed key takes the text of its last record that was not skipped;
    its tags are cleared because they describe other content, its quality label
    stays until the next profile. Everything else is kept as it was.
    """
    winners = (
        actions.filter(F.col("action") != "skip")
        .groupBy(_record_key().alias("_key"))
        .agg(F.max("doc_key").alias("doc_key"))
    )
    # doc_key is part of the join key, so a hot source_id spreads over all tasks.
    texts = staged.withColumn("_key", _record_key()).join(winners, ["_key", "doc_key"]).drop("_key", "doc_key")
    before = conform(prior, JOBS)
    # Unchanged rows pass an anti join on the key alone: a small load leaves the big table unshuffled.
    changed_keys = actions.filter((F.col("action") != "skip") & F.col("source_id").isNotNull()).select("source_id")
    kept = before.join(changed_keys.distinct(), "source_id", "left_anti").select(*JOBS.fieldNames())
    labels = before.select("source_id", "quality").filter(F.col("source_id").isNotNull())
    return kept.unionByName(conform(texts.join(labels, "source_id", "left"), JOBS))


def load_summary(records: DataFrame, actions: DataFrame) -> DataFrame:
    """One row: total, inserted, updated, skipped; records that could not be read count as skipped."""
    done = actions.groupBy().agg(
        F.count_if(F.col("action") == "insert").alias("inserted"),
        F.count_if(F.col("action") == "update").alias("updated"),
        F.count_if(F.col("action") == "skip").alias("skipped"),
    )
    failed = F.lit(0).cast("bigint")
    if "load_error" in records.columns:
        failed = records.agg(F.count_if(F.col("load_error").isNotNull())).scalar()
    return done.withColumn("skipped", F.col("skipped") + failed).select(
        (F.col("inserted") + F.col("updated") + F.col("skipped")).alias("total"), "inserted", "updated", "skipped"
    )


def stored_hashes(jobs: DataFrame, keys: DataFrame) -> DataFrame:
    """The stored content hash of each asked key."""
    return jobs.select("source_id", "content_hash").join(keys.select("source_id").distinct(), "source_id", "left_semi")


def new_keys(staged: DataFrame, prior: DataFrame) -> DataFrame:
    """Staged keys the table does not hold yet."""
    return staged.select("source_id").distinct().join(prior.select("source_id"), "source_id", "left_anti")

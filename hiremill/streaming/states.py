"""Upsert actions of a stream: the last content hash of each key stays in Spark's state store."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from hiremill.operators import upsert
from hiremill.schemas import CHANGES

LAST_HASH = T.StructType([T.StructField("content_hash", T.StringType())])


def _key_actions(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The actions of one key's new records, in ``doc_key`` order."""
    rows = pd.concat(list(frames)).sort_values("doc_key", kind="stable")
    first = rows.iloc[0]
    known, last = (True, state.get[0]) if state.exists else (bool(first["stood"]), first["standing_hash"])
    actions = []
    for value in rows["content_hash"]:
        actions.append("insert" if not known else "skip" if value == last else "update")
        known, last = True, value
    state.update((last,))
    yield pd.DataFrame({"doc_key": rows["doc_key"], "source_id": key[0], "content_hash": rows["content_hash"], "action": actions})


def upsert_actions_stream(records: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """``(doc_key, source_id, content_hash, action)`` of streamed records, to be written in append mode.

    The same as ``upsert.upsert_actions`` over all records that ever came: a key that the state does not hold
    yet starts from ``prior``, the table at the start of the stream, which must not change while it
    runs. Records of a key must come in ``doc_key`` order across micro-batches; inside
    one they are ordered here. Only two short columns of a key's records are gathered, of one micro-batch: bound it with
    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``. Records without a key never meet and need no state.

    The state holds one hash for each key; with many keys, set
    ``spark.sql.streaming.stateStore.providerClass`` to Spark's RocksDB provider.
    """
    staged = upsert.stage(records).select("doc_key", "source_id", "content_hash")
    alone = staged.filter(F.col("source_id").isNull()).withColumn("action", F.lit("insert"))
    keyed = staged.filter(F.col("source_id").isNotNull())
    if prior is None:
        met = keyed.withColumns({"stood": F.lit(False), "standing_hash": F.lit(None).cast("string")})
    else:
        standing = prior.filter(F.col("source_id").isNotNull()).select(
            F.col("source_id").alias("standing_id"), F.lit(True).alias("known"), F.col("content_hash").alias("standing_hash")
        )
        met = keyed.join(standing, F.col("source_id") == F.col("standing_id"), "left").select(
            "doc_key", "source_id", "content_hash", F.coalesce("known", F.lit(False)).alias("stood"), "standing_hash"
        )
    found = met.groupBy("source_id").applyInPandasWithState(_key_actions, CHANGES, LAST_HASH, "append", GroupStateTimeout.NoTimeout)
    return found.unionByName(alone)


def write_actions(actions: DataFrame, path: str, checkpoint: str):
    """Append the actions of all that has arrived to a folder, each micro-batch once; goes on from the checkpoint."""
    return actions.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()

"""Sharding by longest-processing-time scheduling over groups of equal texts.

Groups that must stay together are sorted by size and each goes to the least
loaded shard, which a heap hands out. The heap sees a list of bounded length at
any corpus size:

* a *heavy* group, over 1 / (64 x shards) of all bytes, is an item of its own;
  there are fewer than 64 x shards of them;
* the many light groups are dealt by hash into bundles of geometrically falling
  expected size (half of them at level 0, a quarter at level 1, ...), at most
  25 x 64 items. The large bundles set the loads, the tiny ones level them out.

A group is wholly in one item, so it is never split. NULL and empty texts are
one group of size 1 a row; a table without rows gives no rows; repeated rows
each get a slot of their own. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hiremill.llm.common import whole
from hiremill.session import materialize

HEAVY = 64
LEVELS, SUBS = 25, 64
SLOT_ROWS = 50_000


def lpt(items: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """(load, key) to shard: largest first, each to the shard with the least load, ties by name and number."""
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for load, key in sorted(items, key=lambda x: (-x[0], x[1])):
        least, shard = heapq.heappop(heap)
        placed[key] = shard
        heapq.heappush(heap, (least + load, shard))
    return placed


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot, gapless from 0 in each shard."""
    spark = docs.sparkSession
    text = whole(text_col)
    rows = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.md5(text)).alias("text_md5"),
        ),
        "shard-rows",
    )
    groups = materialize(rows.groupBy("text_md5").agg(F.sum("size").alias("load"), F.count("*").alias("n")), "shard-groups")
    total, n_rows = groups.agg(F.sum("load"), F.sum("n")).first()
    is_heavy = F.col("load") * shards * HEAVY > F.lit(total or 0)
    h = F.pmod(F.xxhash64("text_md5"), F.lit(1 << 40))
    level = F.least(F.bit_count(h.bitwiseXOR(h - 1)) - 1, F.lit(LEVELS - 1))
    bundle = F.concat_ws("/", level, F.pmod(F.xxhash64("text_md5", F.lit(1)), F.lit(SUBS)))

    heavy = groups.filter(is_heavy).select("load", F.hex("text_md5").alias("item")).collect()
    light = groups.filter(~is_heavy).groupBy(bundle.alias("item")).agg(F.sum("load").alias("load")).collect()
    placed = lpt([(r["load"], r["item"]) for r in [*heavy, *light]], shards)

    # Both tables have a proven bound: 64 x shards heavy groups, 1,600 bundles.
    heavy_items = {r["item"] for r in heavy}
    by_group = spark.createDataFrame(
        [(bytearray.fromhex(k), s) for k, s in placed.items() if k in heavy_items], "text_md5 binary, heavy_shard int"
    )
    by_bundle = spark.createDataFrame([(k, s) for k, s in placed.items() if k not in heavy_items], "item string, light_shard int")
    chunks = max(1, -(-(n_rows or 0) // SLOT_ROWS))
    put = (
        rows.join(F.broadcast(by_group), "text_md5", "left")
        .withColumn("item", bundle)
        .join(F.broadcast(by_bundle), "item", "left")
        .select(
            "doc_id", "size", "text_crc32", "text_md5",
            F.coalesce("heavy_shard", "light_shard").alias("shard"),
            F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).alias("chunk"),
        )
    )
    # Slots: rows are numbered within (shard, chunk), after the counts of the chunks before.
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        put.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
        .select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    order = Window.partitionBy("shard", "chunk").orderBy("doc_id", "size", "text_crc32", "text_md5")
    return (
        put.withColumn("at", F.row_number().over(order) - 1)
        .join(starts, ["shard", "chunk"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("at")).cast("long").alias("slot"))
    )


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents into eight shards of nearly equal bytes."""
    from hiremill.llm.common import table

    return shard_documents(table(spark, sf_dir, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )

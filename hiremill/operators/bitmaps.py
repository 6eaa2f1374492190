"""Skills held and lacked as bitmaps over demand ranks.

A rank is a bit of the bitmap of its bucket (32,768 ranks, 4 KB). Bitmaps of held skills add up by
group (``bitmap_or_agg``); a gap is the complement within the market, counted from bits, and written
out as rows for those who ask only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: bits of one of Spark's bitmaps.
BITS = 32_768
# Keys that one copy of the market meets when gaps are written out.
COPY_KEYS = 5_000


def held_bitmaps(ranked: DataFrame, held: DataFrame, *keys: str) -> DataFrame:
    """``(keys, bucket, held)`` from ``(keys, skill)``: the market skills of each key, by bucket."""
    ranks = held.join(ranked.select("skill", "rank"), "skill").withColumn("bucket", F.floor(F.col("rank") / BITS))
    return ranks.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg((F.col("rank") % BITS)).alias("held"))


def joined_bitmaps(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """Bitmaps of groups of keys: a skill counts if any of them has it."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("held").alias("held"))


def gap_counts(all_keys: DataFrame, bitmaps: DataFrame, market: Column, *keys: str) -> DataFrame:
    """``(keys, gap_count)``: the market's size less the bits set. ``all_keys`` names those without any skill too."""
    counted = bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("held")).alias("bits"))
    return all_keys.select(*keys).distinct().join(counted, list(keys), "left").select(*keys, (market - F.coalesce("bits", F.lit(0))).alias("gap_count"))


def has_bit(bitmap: Column | str, position: Column) -> Column:
    """Is a bit set? NULL bitmaps have none."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, position % 8) == 1, F.lit(False))


def written_gaps(ranked: DataFrame, asked: DataFrame, bitmaps: DataFrame, key: str) -> DataFrame:
    """``(key, rank, skill, demand)``: what each of ``asked`` lacks.

    Nothing is written out for others. The market is copied to a join key for every
    ``COPY_KEYS`` who ask, so many who ask spread over many tasks.
    """
    asked = asked.select(key).distinct()
    copies = F.greatest(F.lit(1), F.ceil(asked.agg(F.count("*")).scalar() / COPY_KEYS)).cast("int")
    market = ranked.withColumn("bucket", F.floor(F.col("rank") / BITS)).withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    buckets = F.ceil(ranked.agg(F.coalesce(F.max("rank") + 1, F.lit(0))).scalar() / BITS)
    wanted = asked.select(key, F.pmod(F.xxhash64(key), copies).cast("int").alias("copy"), F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(buckets, F.lit(1)) - 1)).alias("bucket"))
    own = bitmaps.join(asked, key, "left_semi").select(key, "bucket", "held")
    met = wanted.join(own, [key, "bucket"], "left").join(market, ["copy", "bucket"])
    return met.filter(~has_bit("held", F.col("rank") % BITS)).select(key, "rank", "skill", "demand")

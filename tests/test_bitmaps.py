"""Bitmaps of held skills against plain sets, over more than one bucket."""

import random

from pyspark.sql import functions as F

from hiremill.operators import bitmaps


def test_counts_unions_and_written_gaps(spark, monkeypatch):
    monkeypatch.setattr(bitmaps, "COPY_KEYS", 2)
    rng, market = random.Random(1), 70_000
    ranked = spark.range(market).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("skill"), (F.lit(market) - F.col("id")).alias("demand"), F.col("id").alias("rank"))
    held = {f"r{i}": {rng.choice([0, 7, 8, 32_767, 32_768, 65_535, 65_536, 69_999, rng.randrange(market)]) for _ in range(9)} for i in range(6)}
    held["none"] = set()
    keys = spark.createDataFrame([(k,) for k in held], "k string")
    rows = spark.createDataFrame([(k, f"s{r}") for k, rs in held.items() for r in rs] + [("r0", "not asked for")], "k string, skill string")
    maps = bitmaps.held_bitmaps(ranked, rows, "k")
    assert {r.k: r.gap_count for r in bitmaps.gap_counts(keys, maps, F.lit(market), "k").collect()} == {k: market - len(rs) for k, rs in held.items()}
    team = F.when(F.col("k").isin("r0", "r1", "r2"), "one").otherwise("two").alias("team")
    joined = bitmaps.joined_bitmaps(maps.select(team, "bucket", "held"), "team")
    want = {"one": market - len(held["r0"] | held["r1"] | held["r2"]), "two": market - len(held["r3"] | held["r4"] | held["r5"])}
    assert {r.team: r.gap_count for r in bitmaps.gap_counts(keys.select(team), joined, F.lit(market), "team").collect()} == want
    asked = spark.createDataFrame([("r0",), ("none",), ("r5",), ("r5",)], "k string")
    gaps = bitmaps.written_gaps(ranked, asked, maps, "k").groupBy("k").agg(F.count("*").alias("n"), F.sum("rank").alias("ranks")).collect()
    total = market * (market - 1) // 2
    assert {r.k: (r.n, r.ranks) for r in gaps} == {k: (market - len(held[k]), total - sum(held[k])) for k in ("r0", "none", "r5")}


def test_an_empty_market(spark):
    ranked = spark.createDataFrame([], "skill string, demand long, rank long")
    held = spark.createDataFrame([("r", "x")], "k string, skill string")
    maps = bitmaps.held_bitmaps(ranked, held, "k")
    assert maps.count() == 0 and bitmaps.written_gaps(ranked, held.select("k"), maps, "k").count() == 0
    assert [tuple(r) for r in bitmaps.gap_counts(held, maps, F.lit(0), "k").collect()] == [("r", 0)]

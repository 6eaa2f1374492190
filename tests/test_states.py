"""Streamed upsert actions: keyed state over micro-batches, restarts, rows without a key."""

import random

from pyspark.sql import functions as F

from hiremill.operators import upsert
from hiremill.schemas import JOBS, SILVER
from hiremill.streaming import arrivals, states

TITLES = ["a", "b", None]


def history(n, seed=1):
    rng = random.Random(seed)
    return [(f"{i:012d}", rng.choice(["k1", "k2", "k3", "hot", "hot", "hot", None, "p1", "p2"]), rng.choice(TITLES), "c", "d") for i in range(n)]


def prior(spark):
    rows = spark.createDataFrame([("p1", "a", "c", "d", "go", None, None), ("hot", "b", "c", "d", "go", None, None), ("p2", "a", "c", "d", None, None, None), (None, "x", "c", "d", None, "h", None)], JOBS)
    hashed = upsert.stage(rows.filter("source_id in ('p1', 'hot')"))
    return hashed.select(*JOBS.fieldNames()).unionByName(rows.filter("source_id = 'p2' or source_id is null"))


def run(spark, root, table, **options):
    stream = arrivals.read_silver_stream(spark, f"{root}/arrived", **options)
    query = states.write_actions(states.upsert_actions_stream(stream, table), f"{root}/actions", f"{root}/checkpoint")
    query.awaitTermination()
    return query


def test_actions_over_several_batches_and_starts_equal_the_batch_upsert(spark, tmp_path):
    root, rows, table = str(tmp_path), history(120), prior(spark)
    for low in range(0, 120, 20):
        spark.createDataFrame(rows[low : low + 20], SILVER).coalesce(1).write.mode("append").parquet(f"{root}/arrived")
        if low % 40:  # two files wait for one start: two micro-batches of it
            query = run(spark, root, table, files_per_batch=1)
            assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == 2
    run(spark, root, table)  # nothing new
    want = upsert.upsert_actions(upsert.stage(spark.createDataFrame(rows, SILVER)), table)
    assert sorted(map(tuple, spark.read.parquet(f"{root}/actions").collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_without_a_prior_table_and_unordered_inside_a_batch(spark, tmp_path):
    root, rows = str(tmp_path), history(60, 2)
    spark.createDataFrame(random.Random(3).sample(rows, 60), SILVER).repartition(4).write.parquet(f"{root}/arrived")
    run(spark, root, None)
    want = upsert.upsert_actions(upsert.stage(spark.createDataFrame(rows, SILVER)), spark.createDataFrame([], JOBS))
    got = spark.read.parquet(f"{root}/actions")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert got.filter(F.col("source_id").isNull() & (F.col("action") != "insert")).count() == 0

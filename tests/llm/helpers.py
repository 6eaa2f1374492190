"""Small corpora and what the operators share in their tests."""

from __future__ import annotations

import random

SF = "/root/testdata/sf0.001"
#: NULL, empty, blank, without letters, very short, one very long line, repeated rows.
EDGES = [(900, None), (901, ""), (902, " \n\t "), (903, "12 34 !!"), (904, "a"), (905, "word " * 30_000), (906, "twice the row"), (906, "twice the row")]


def words(n: int, size: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(n)}" for _ in range(size))


def documents(spark, rows, extra: bool = False):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if not extra:
        return df
    # Columns with names that the operators use inside.
    names = ["shard", "size", "item", "chunk", "score", "found", "set_id", "members", "line", "n", "first", "queue", "start", "task", "kept_id", "n_lines", "label"]
    return df.selectExpr("doc_id", "text", *[f"cast(doc_id as string) as `{x}`" for x in names])

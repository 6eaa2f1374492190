"""Exact top-k search by distributed histogram selection.

Vectors become integers, floor(scale * x), and a score is an integer inner
product. Queries and candidates are cut into blocks; each pair of blocks is a
matrix product in a task of its own (a stated query set against all rows).

All scores are computed once a round and only counted: a task keeps, for each
query, the histogram bins from its own k-th best upward (bins below cannot hold
the global k-th value). Summed over the tasks, the counts locate the bin of
each query's k-th value; the next round splits that bin alone, until it is one
value wide. Then the scores above the value leave, with as many of the equal
ones as k allows, smaller ids first.

Vectors that are NULL, empty, of another length than the first, or hold NULL or
non-finite components take no part. Fewer than k candidates: all are returned.
Repeated ids are rows of their own; a query never meets rows of its own id.
Without vectors there are no rows. Vectors so large that a score could pass 64
bits are an error. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hiremill.llm.common import table
from hiremill.session import materialize

K = 20
BINS = 256
CANDIDATE_BLOCK, QUERY_BLOCK = 8192, 512


def usable(vector: str = "embedding") -> Column:
    """Not NULL or empty, all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad


def same_length(rows: DataFrame, vector: str) -> DataFrame:
    """The rows with the most common length of ``vector`` (the smaller one, if two are)."""
    top = rows.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").head(1)
    return rows.filter(F.size(vector) == (top[0]["d"] if top else 0))


def _pack(rows: DataFrame, block: Column, columns: dict[str, str]) -> DataFrame:
    """One row for each block: the vectors and further long columns as binary."""
    schema = "block long, vectors binary, " + ", ".join(f"{c} binary" for c in columns)

    def run(pdf):
        if not len(pdf):
            return pd.DataFrame(columns=["block", "vectors", *columns])
        out = {"block": [pdf["block"].iat[0]], "vectors": [np.stack(list(pdf["v"])).astype(np.int64).tobytes()]}
        return pd.DataFrame(out | {c: [pdf[src].to_numpy(np.int64).tobytes()] for c, src in columns.items()})

    return rows.withColumn("block", block.cast("long")).groupBy("block").applyInPandas(run, schema)


def _scores(row, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, candidate ids and the score matrix; the query's own id is set to the least value."""
    q_ids, c_ids = np.frombuffer(row.query_ids, dtype=np.int64), np.frombuffer(row.candidate_ids, dtype=np.int64)
    q, c = (np.frombuffer(v, dtype=np.int64).reshape(-1, dims) for v in (row.query_vectors, row.candidate_vectors))
    bound = int(np.abs(q).max()) * int(np.abs(c).max()) * dims
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64  # exact in all cases
    s = (q.astype(kind) @ c.astype(kind).T).astype(np.int64)
    s[q_ids[:, None] == c_ids[None, :]] = np.iinfo(np.int64).min
    return q_ids, c_ids, s


def top_k_search(vectors: DataFrame, is_query: Column, k: int = K, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank from 1, vec_id and score: the k highest of each query, ties to smaller ids."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), is_query.alias("is_query"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = same_length(rows.filter(F.col("id").isNotNull() & usable("v")), "v")
    rows = materialize(rows.withColumn("v", F.transform("v", lambda x: F.floor(x * scale))), "topk-vectors")
    n, n_queries, dims = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("is_query").cast("int")), F.lit(0)), F.max(F.size("v"))).first()
    blocks, query_blocks = max(1, -(-n // CANDIDATE_BLOCK)), max(1, -(-n_queries // QUERY_BLOCK))
    salt = F.pmod(F.xxhash64("id"), F.lit(blocks))
    candidates = materialize(_pack(rows, salt, {"ids": "id"}), "topk-blocks").select(
        F.col("block").alias("candidate_block"), F.col("vectors").alias("candidate_vectors"), F.col("ids").alias("candidate_ids")
    )
    # Every score is at most the product of the two norms in size.
    norms = rows.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)))).first()[0] or 0.0
    if norms * norms >= 2.0**61:
        raise ValueError("scores of these vectors need more than 64 bits")
    low = -int(norms * norms) - 2
    width = max(1, -(-2 * -low // BINS))
    queries = rows.filter("is_query").select("id", "v", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(query_blocks)).alias("query_block"))
    state = queries.select("id").distinct().select("id", F.lit(low).cast("long").alias("low"), F.lit(k).cast("long").alias("need"))

    def cells(state: DataFrame) -> DataFrame:
        """Each query block beside each candidate block, with where its queries' k-th values are sought."""
        known = queries.dropDuplicates(["id", "v"]).join(state, "id")
        packed = _pack(known, F.col("query_block"), {"query_ids": "id", "lows": "low", "needs": "need"})
        packed = packed.withColumnRenamed("vectors", "query_vectors").withColumnRenamed("block", "query_block")
        left = packed.withColumn("candidate_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))
        right = candidates.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)).cast("array<long>")))
        return left.join(right, ["candidate_block", "query_block"])

    def counted(width: int, span: int):
        def run(batches):
            for pdf in batches:
                for row in pdf.itertuples(index=False):
                    q_ids, _, s = _scores(row, dims)
                    lows, needs = (np.frombuffer(v, dtype=np.int64) for v in (row.lows, row.needs))
                    # Scores above the searched span are counted already.
                    bins = (s - lows[:, None]) // width
                    bins[(s < lows[:, None]) | (s >= lows[:, None] + span)] = -1
                    out = []
                    for q, b, need in zip(q_ids.tolist(), bins, needs.tolist()):
                        if need < len(b):
                            b = b[b >= np.partition(b, len(b) - need)[len(b) - need]]
                        b, times = np.unique(b[b >= 0], return_counts=True)
                        out.append((np.full(len(b), q), b, times))
                    yield pd.DataFrame(dict(zip(("id", "bin", "n"), map(np.concatenate, zip(*out)))))

        return run

    span = width * BINS
    while True:
        sums = cells(state).mapInPandas(counted(width, span), "id long, bin long, n long").groupBy("id", "bin").agg(F.sum("n").alias("n"))
        above = Window.partitionBy("id").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
        found = (
            sums.withColumn("above", F.coalesce(F.sum("n").over(above), F.lit(0)))
            .join(state, "id").filter(F.col("above") < F.col("need"))
            # The last such bin holds the k-th value, or is the lowest if there are fewer.
            .groupBy("id").agg(F.min_by("low", "bin").alias("low"), F.min("bin").alias("bin"), F.min_by("above", "bin").alias("above"), F.min("need").alias("need"))
        )
        state = materialize(found.select("id", (F.col("low") + F.col("bin") * width).alias("low"), (F.col("need") - F.col("above")).alias("need")), "topk-state")
        if width == 1:
            break
        # A bin of the old width is cut into BINS of the new one.
        span, width = width, -(-width // BINS)

    def chosen(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                q_ids, c_ids, s = _scores(row, dims)
                out = []
                for q, line, low, need in zip(q_ids.tolist(), s, np.frombuffer(row.lows, dtype=np.int64).tolist(), np.frombuffer(row.needs, dtype=np.int64).tolist()):
                    over, equal = np.flatnonzero(line > low), np.flatnonzero(line == low)
                    if len(equal) > need:
                        equal = equal[np.argsort(c_ids[equal], kind="stable")[:need]]
                    at = np.concatenate([over, equal])
                    out.append((np.full(len(at), q), c_ids[at], line[at]))
                yield pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*out)))))

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        cells(state).mapInPandas(chosen, "query_id long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty highest integer inner products of every twentieth vector."""
    return top_k_search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""

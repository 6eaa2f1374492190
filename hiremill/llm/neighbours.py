"""Approximate nearest neighbours over balanced posting lists.

Nearness is the largest inner product. With one more component, the length a
vector lacks to the longest one, it becomes the smallest Euclidean distance.

* **Fit**, on a bounded sample: k-means whose assignment charges a list for being
  over its share, so that lists come out balanced; and a graph that ties each
  centroid to its nearest ones.
* **Index**: every vector goes to its nearest lists, boundary vectors to several:
  all whose distance is within ``1 + replica_slack`` times the least, at most ``replicas``.
* **Search**: best-first search of the in-memory centroid graph gives a query's
  lists, nearest first; distance-ratio pruning stops once a centroid is farther than
  ``ratio`` times the nearest. The ratio is set on the sample: the one at which
  ``target`` of true neighbours lie in a chosen list. Lists are read on until they
  hold ten times the wanted number. Scores are exact inner products of the vectors.

Lists are gathered into cells of bounded size (a large list is dealt over several
by hash of the id), queries into blocks; a task scores one block in one cell, by
matrix products list by list. The centroids and what belongs to a list (at most
``most_lists``) are all that is broadcast.

Vectors that are NULL, empty, zero, of an unusual length, or hold NULL or
non-finite components take no part. Ties go to the smaller id. Rows with the same
id are one candidate, and never found by that id. No vectors, no rows. Extra
columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hiremill.llm.common import sample_by_hash, table
from hiremill.llm.topk import same_length, usable
from hiremill.session import materialize

K = 20
SAMPLE = 20_000
LIST_ROWS = 800
MOST_LISTS = 4096
CELL_ROWS = 16_384
QUERY_BLOCK = 4096
DEGREE = 16


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """With the component that makes all lengths equal."""
    return np.hstack([x, np.sqrt(np.maximum(longest**2 - (x * x).sum(axis=1, keepdims=True), 0.0))])


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1, keepdims=True) + (centres * centres).sum(axis=1) - 2.0 * x @ centres.T, 0.0)


def balanced_centres(x: np.ndarray, lists: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Centroids, and what each charges for being over its share of the sample."""
    pick = np.random.default_rng(11).permutation(len(x))[:lists]
    centres, charge = x[pick].copy(), np.zeros(len(pick))
    for _ in range(rounds):
        d = distances(x, centres)
        near = np.argmin(d + charge, axis=1)
        size = np.bincount(near, minlength=len(centres))
        charge += 0.1 * float(d.min(axis=1).mean()) * np.clip(size * len(centres) / len(x) - 1.0, -1.0, 1.0)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres[size > 0] = sums[size > 0] / size[size > 0, None]
    return centres, charge - charge.min()


def centroid_graph(centres: np.ndarray) -> list[np.ndarray]:
    """For each centroid its nearest ones, both ways, and a ring so that all can be reached."""
    n = len(centres)
    d = distances(centres, centres)
    np.fill_diagonal(d, np.inf)
    tied = [set(np.argsort(row, kind="stable")[: min(DEGREE, n - 1)].tolist()) | {(i + 1) % n} - {i} for i, row in enumerate(d)]
    for i in range(n):
        for j in list(tied[i]):
            tied[j].add(i)
    return [np.array(sorted(t - {i}), dtype=np.int64) for i, t in enumerate(tied)]


def assigned(x: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """(row, list) of every vector and each list it goes to."""
    d = distances(x, model["centres"]) + model["charge"]
    few = min(model["replicas"], d.shape[1])
    near = np.argpartition(d, few - 1, axis=1)[:, :few]
    got = np.take_along_axis(d, near, axis=1)
    row, at = np.nonzero(got <= got.min(axis=1, keepdims=True) * (1.0 + model["replica_slack"]) ** 2)
    return row, near[row, at]


def chosen_lists(q: np.ndarray, model: dict, sizes: np.ndarray, enough: int) -> list[int]:
    """The lists of one lifted query: best-first over the graph, pruned by the distance ratio."""
    centres, graph = model["centres"], model["graph"]
    seen = np.zeros(len(centres), dtype=bool)

    def away(at):
        diff = centres[at] - q
        return np.sqrt((diff * diff).sum(axis=1))

    start = model["entry"]
    seen[start] = True
    heap = [(float(away(np.array([start]))[0]), start)]
    out: list[tuple[float, int]] = []
    least, rows = np.inf, 0
    while heap:
        d, i = heapq.heappop(heap)
        if d > model["ratio"] * least and rows >= enough:
            break
        least = min(least, d)
        out.append((d, i))
        rows += int(sizes[i])
        fresh = graph[i][~seen[graph[i]]]
        seen[fresh] = True
        for pair in zip(away(fresh).tolist(), fresh.tolist()):
            heapq.heappush(heap, pair)
    # What was passed on the way to the nearest list and is too far is left out again.
    out.sort()
    keep, rows = [], 0
    for d, i in out:
        if d > model["ratio"] * least and rows >= enough:
            break
        keep.append(i)
        rows += int(sizes[i])
    return keep


def fit(x: np.ndarray, total: int, k: int = K, target: float = 0.97, replicas: int = 4, replica_slack: float = 0.02, most_lists: int = MOST_LISTS) -> dict:
    """Centroids, graph and pruning ratio from a sample of the ``total`` vectors."""
    longest = float(np.sqrt((x * x).sum(axis=1).max()))
    up = lifted(x, longest)
    lists = int(np.clip(-(-total // LIST_ROWS), 1, min(most_lists, max(1, len(x) // 8))))
    centres, charge = balanced_centres(up, lists)
    model = {"centres": centres, "charge": charge, "graph": centroid_graph(centres), "longest": longest, "replicas": replicas, "replica_slack": replica_slack}
    model["entry"] = int(np.argmin(distances(centres.mean(axis=0, keepdims=True), centres)))
    # The ratio each true neighbour of some sample queries needs, over its best list.
    queries = np.arange(0, len(x), max(1, len(x) // 256))
    score = x[queries] @ x.T
    score[np.arange(len(queries)), queries] = -np.inf
    few = min(k, max(len(x) - 1, 1))
    near = np.argpartition(-score, few - 1, axis=1)[:, :few]
    row, at = assigned(up, model)
    holds = np.zeros((len(x), len(centres)), dtype=bool)
    holds[row, at] = True
    d = np.sqrt(distances(np.hstack([x[queries], np.zeros((len(queries), 1))]), centres))
    needed = np.stack([np.where(holds[n], line, np.inf).min(axis=1) / max(line.min(), 1e-12) for n, line in zip(near, d)])
    model["ratio"] = float(np.quantile(needed, target)) + 1e-9
    return model


def nearest(vectors: DataFrame, is_query: Column, k: int = K, sample: int = SAMPLE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank from 1, vec_id, score of the ``k`` nearest found."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), is_query.alias("is_query"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & usable("v") & F.exists("v", lambda x: x != 0))
    rows = materialize(same_length(rows, "v"), "ann-vectors")
    total, longest = rows.agg(F.count("*"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))).first()
    empty = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], empty)
    picked = sample_by_hash(rows.select("id", "v"), "id", sample).collect()
    model = fit(np.array([r["v"] for r in sorted(picked)]), total, k)
    model["longest"] = longest
    dims = model["centres"].shape[1] - 1

    def index(batches):
        for pdf in batches:
            if len(pdf):
                x = np.stack(list(pdf["v"]))
                row, at = assigned(lifted(x, longest), model)
                yield pd.DataFrame({"list": at.astype(np.int32), "id": pdf["id"].to_numpy()[row], "v": [x[r].tobytes() for r in row]})

    postings = materialize(rows.select("id", "v").mapInPandas(index, "list int, id long, v binary"), "ann-postings")
    n_lists = len(model["centres"])
    sizes = np.zeros(n_lists, dtype=np.int64)
    for r in postings.groupBy("list").count().collect():  # at most MOST_LISTS rows
        sizes[r["list"]] = r["count"]
    # Lists to groups, largest first to the emptiest; a group's rows are dealt over as many cells as they need.
    groups = max(1, min(n_lists, -(-int(sizes.sum()) // CELL_ROWS)))
    heap, group_of = [(0, g) for g in range(groups)], np.zeros(n_lists, dtype=np.int64)
    for i in np.argsort(-sizes, kind="stable"):
        load, g = heapq.heappop(heap)
        group_of[i] = g
        heapq.heappush(heap, (load + int(sizes[i]), g))
    deals = np.maximum(1, -(-np.bincount(group_of, weights=sizes, minlength=groups).astype(np.int64) // (2 * CELL_ROWS)))
    of_list = F.array(*[F.lit(int(g)) for g in group_of])[F.col("list")]
    deals_of = lambda g: F.array(*[F.lit(int(n)) for n in deals])[g]

    def pack_postings(pdf):
        order = np.lexsort((pdf["id"].to_numpy(), pdf["list"].to_numpy()))
        pdf = pdf.iloc[order]
        return pd.DataFrame(
            {
                "cell_group": [pdf["cell_group"].iat[0]], "deal": [pdf["deal"].iat[0]], "lists": [pdf["list"].to_numpy(np.int32).tobytes()],
                "ids": [pdf["id"].to_numpy(np.int64).tobytes()], "vectors": [b"".join(pdf["v"])],
            }
        )

    cells = (
        postings.withColumn("cell_group", of_list)
        .withColumn("deal", F.pmod(F.xxhash64("id"), deals_of(F.col("cell_group"))).cast("int"))
        .groupBy("cell_group", "deal").applyInPandas(pack_postings, "cell_group int, deal int, lists binary, ids binary, vectors binary")
    )
    cells = materialize(cells, "ann-cells")

    queries = rows.filter("is_query").dropDuplicates(["id", "v"])
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))

    def route(batches):
        for pdf in batches:
            out = []
            for i, v in zip(pdf["id"], pdf["v"]):
                lists = np.array(chosen_lists(np.append(v, 0.0), model, sizes, 10 * k), dtype=np.int32)
                for g in np.unique(group_of[lists]).tolist():
                    out.append((i, v.tobytes(), g, lists[group_of[lists] == g].tobytes()))
            yield pd.DataFrame(out, columns=["id", "v", "cell_group", "probe"])

    def pack_queries(pdf):
        head = {c: [pdf[c].iat[0]] for c in ("cell_group", "deal", "block")}
        probes = [np.frombuffer(p, dtype=np.int32) for p in pdf["probe"]]
        return pd.DataFrame(
            head | {
                "query_ids": [pdf["id"].to_numpy(np.int64).tobytes()], "query_vectors": [b"".join(pdf["v"])],
                "probe_of": [np.repeat(np.arange(len(pdf), dtype=np.int32), [len(p) for p in probes]).tobytes()], "probe_list": [np.concatenate(probes).tobytes()],
            }
        )

    routed = (
        queries.select("id", "v").repartition("id").mapInPandas(route, "id long, v binary, cell_group int, probe binary")
        .withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(blocks)).cast("int"))
        .withColumn("deal", F.explode(F.sequence(F.lit(0), deals_of(F.col("cell_group")) - 1)))
        .groupBy("cell_group", "deal", "block")
        .applyInPandas(pack_queries, "cell_group int, deal int, block int, query_ids binary, query_vectors binary, probe_of binary, probe_list binary")
    )
    work = cells.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(routed, ["cell_group", "deal", "block"])

    def search(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                yield _search_cell(row, dims, k)

    found = work.mapInPandas(search, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def _search_cell(row, dims: int, k: int) -> pd.DataFrame:
    """The best of one query block in one cell."""
    ids, lists = np.frombuffer(row.ids, dtype=np.int64), np.frombuffer(row.lists, dtype=np.int32)
    q_ids, of, probe = np.frombuffer(row.query_ids, dtype=np.int64), np.frombuffer(row.probe_of, dtype=np.int32), np.frombuffer(row.probe_list, dtype=np.int32)
    x, q = (np.frombuffer(v, dtype=np.float64).reshape(-1, dims) for v in (row.vectors, row.query_vectors))
    order = np.argsort(probe, kind="stable")
    of, probe = of[order], probe[order]
    out = []
    for number in np.unique(lists):
        a, b = np.searchsorted(lists, [number, number + 1])
        c, d = np.searchsorted(probe, [number, number + 1])
        for low in range(c, d, 256):
            who = of[low : min(low + 256, d)]
            s = q[who] @ x[a:b].T
            s[q_ids[who][:, None] == ids[a:b][None, :]] = -np.inf
            if b - a > k:  # all down to the k-th score, its ties included, then cut below
                keep = s >= np.partition(s, b - a - k, axis=1)[:, b - a - k, None]
            else:
                keep = np.ones(s.shape, dtype=bool)
            keep &= s > -np.inf
            r, at = np.nonzero(keep)
            out.append((who[r], ids[a:b][at], s[r, at]))
    who, got, score = map(np.concatenate, zip(*out)) if out else (np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0))
    order = np.lexsort((got, -score, who))
    who, got, score = who[order], got[order], score[order]
    # A replica may come from two lists of the cell, its score perhaps a rounding apart.
    pair = np.lexsort((-score, got, who))
    first = np.append(True, (who[pair][1:] != who[pair][:-1]) | (got[pair][1:] != got[pair][:-1]))[: len(pair)]
    keep = np.sort(pair[first])
    who, got, score = who[keep], got[keep], score[keep]
    start = np.flatnonzero(np.append(True, who[1:] != who[:-1]))[: len(who)]
    rank = np.arange(len(who)) - np.repeat(start, np.diff(np.append(start, len(who)))) if len(who) else np.zeros(0, int)
    top = rank < k
    return pd.DataFrame({"query_id": q_ids[who[top]], "vec_id": got[top], "score": score[top]})


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest found of every twentieth vector."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)

"""Approximate nearest neighbours by learned partitions.

A neighbour graph over a bounded sample is cut into balanced parts, along its edges as far as balance allows. A small
classifier learns the part of a vector, puts every row of the index into its likeliest part, and sends each query to
as many of its likeliest parts as the sample's own neighbours need. There the rows are compared in blocks, exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.session import materialize

MAX_SAMPLE = 8_192  # rows that the partitions and the classifier are fitted on
PART_OF_SAMPLE = 128  # sampled rows in a part
NEIGHBOURS = 12  # edges of a row in the graph
BLOCK = 8_192  # rows and queries that are compared at a time
TARGET = 0.98  # share of the sample's neighbours that the probed parts must hold


@dataclass(frozen=True)
class Router:
    """Linear classifier over parts; ``probes`` is how many parts a query visits."""

    weight: np.ndarray
    bias: np.ndarray
    probes: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _unit(x) @ self.weight + self.bias


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def _nearest(x: np.ndarray, k: int) -> np.ndarray:
    """Places of the k rows with the largest inner product with each row, itself left out."""
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 512):
        s = x[a : a + 512] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 42) -> np.ndarray:
    """Part of each row of a neighbour graph; parts are equally large, but for one row.

    Recursive bisection: a subset is ordered by the slowest vector of its random walk and cut in the middle; then pairs of
    rows that both have more edges across the cut are swapped.
    """
    n, rng = len(graph), np.random.default_rng(seed)
    part = np.zeros(n, np.int64)
    source, target = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    a, b = np.concatenate([source, target]), np.concatenate([target, source])
    for _ in range(max(0, parts.bit_length() - 1)):
        inner = part[a] == part[b]
        u, v = a[inner], b[inner]
        degree = np.bincount(u, minlength=n) + 1.0
        size = np.bincount(part)

        def centred(y: np.ndarray) -> np.ndarray:
            y = y - (np.bincount(part, y * degree) / np.bincount(part, degree))[part]
            return y / np.sqrt(np.bincount(part, y * y * degree) / size + 1e-300)[part]

        y = centred(rng.standard_normal(n))
        for _ in range(60):
            y = centred(0.5 * y + 0.5 * (np.bincount(u, y[v], n) + y) / degree)
        order = np.lexsort((y, part))
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
        side = (rank >= (size[part] + 1) // 2).astype(np.int64)
        for _ in range(4):
            across = np.bincount(u, side[u] != side[v], n)
            gain = 2 * across - (degree - 1)
            for p in range(len(size)):
                here = np.flatnonzero(part == p)
                zero, one = here[side[here] == 0], here[side[here] == 1]
                zero, one = zero[np.argsort(-gain[zero], kind="stable")], one[np.argsort(-gain[one], kind="stable")]
                m = min(len(zero), len(one))
                good = (gain[zero[:m]] + gain[one[:m]] > 2).cumprod().sum() // 2  # half: neighbours move together
                side[zero[:good]], side[one[:good]] = 1, 0
        part = 2 * part + side
    return part


def learn_router(x: np.ndarray, k: int = 20, parts: int | None = None) -> Router:
    """Fit parts, classifier and number of probes on the sampled vectors (rows of ``x``)."""
    x = np.ascontiguousarray(x, np.float64)
    parts = parts or max(1, len(x) // PART_OF_SAMPLE)
    parts = 1 << (parts.bit_length() - 1)
    if parts < 2:
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), 1)
    unit = _unit(x)
    label = balanced_parts(_nearest(unit, min(NEIGHBOURS, len(x) - 1)), parts)
    weight, bias = np.zeros((x.shape[1], parts)), np.zeros(parts)
    goal = np.zeros((len(x), parts))
    goal[np.arange(len(x)), label] = 1
    old, old_bias, rate = weight, bias, 4.0
    for step in range(200):
        m = step / (step + 3)
        w, c = weight + m * (weight - old), bias + m * (bias - old_bias)
        s = unit @ w + c
        s = np.exp(s - s.max(axis=1, keepdims=True))
        pull = (s / s.sum(axis=1, keepdims=True) - goal) / len(x)
        old, old_bias = weight, bias
        weight, bias = w - rate * (unit.T @ pull + 1e-6 * w), c - rate * pull.sum(axis=0)
    score = unit @ weight + bias
    home = score.argmax(axis=1)
    near = home[_nearest(x, min(k, len(x) - 1))]
    place = np.argsort(np.argsort(-score, axis=1), axis=1)  # how many parts are likelier
    needed = np.sort(np.take_along_axis(place, near, axis=1).ravel())
    return Router(weight, bias, int(needed[int(np.ceil(TARGET * len(needed))) - 1]) + 1)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows (key, vector) that take part: a key, and finite components that are not all zero, of the usual length."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("key"), v.alias("vector")).where("key is not null and size(vector) > 0")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = rows.where(F.forall("vector", finite) & F.exists("vector", lambda x: x != 0))
    length = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").limit(1)
    found = length.collect()
    return rows.where(F.size("vector") == (found[0]["length"] if found else 0))


def nearest(vectors: DataFrame, is_query: str, k: int = 20, key: str = "vec_id", vector: str = "embedding", parts: int | None = None) -> DataFrame:
    """The k nearest rows found for each query: (query_id, rank, key, score), by inner product in double precision.

    Queries are the rows for which ``is_query``, an SQL condition on the key column, holds; candidates are all rows but the
    query's own key. Ties go to the smaller key. Rows whose vector is null, zero, of unusual length, or has a null or
    non-finite component take no part, nor do those without a key. Equal vectors are compared once, with their k + 1
    smallest keys, which is all that any result can hold; a vector that a third of all rows repeat is one row. A key
    that stands on several different vectors counts as several candidates. Fewer candidates than k are all returned.
    """
    rows = materialize(usable(vectors, key, vector), "vectors")
    by_vector = Window.partitionBy("vector").orderBy("key")
    index = rows.distinct().withColumn("place", F.row_number().over(by_vector)).where(F.col("place") <= k + 1)
    index = materialize(index.groupBy("vector").agg(F.sort_array(F.collect_list("key")).alias("keys")), "index")
    asked = rows.where(F.expr(is_query.replace(key, "key"))).distinct()
    queries = materialize(asked.groupBy("vector").agg(F.min("key").alias("q")), "queries")
    total = index.count()
    every = max(1, -(-2 * total // MAX_SAMPLE))
    sample = index.select("vector").where(F.pmod(F.xxhash64("vector"), F.lit(every)) == 0).limit(MAX_SAMPLE)
    sampled = np.array([r[0] for r in sample.collect()])  # at most MAX_SAMPLE vectors
    names = f"query_id long, rank int, `{key}` long, score double"
    if not len(sampled):
        return vectors.sparkSession.createDataFrame([], names)
    router = learn_router(sampled[np.lexsort(sampled.T[::-1])], k, parts)

    def route(probes: int):
        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column("vector"))
                s = router.scores(x) if len(x) else np.zeros((0, 1))
                likely = np.argsort(-s, axis=1, kind="stable")[:, :probes]
                homes = pa.array(likely.tolist(), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("vector"), batch.column(1), homes], ["vector", batch.schema.names[1], "parts"])

        return assign

    homes = index.mapInArrow(route(1), "vector array<double>, keys array<long>, parts array<int>")
    homes = materialize(homes.select("vector", "keys", F.col("parts")[0].alias("part")), "index-parts")
    visits = queries.mapInArrow(route(router.probes), "vector array<double>, q long, parts array<int>")
    visits = materialize(visits.select("vector", "q", F.explode("parts").alias("part")), "query-parts")
    # blocks of bounded size on both sides; a large part has many
    sizes = homes.groupBy("part").count().withColumnRenamed("count", "n").join(
        visits.groupBy("part").count().withColumnRenamed("count", "m"), "part")
    sizes = sizes.select("part", F.ceil(F.col("n") / BLOCK).cast("int").alias("nb"), F.ceil(F.col("m") / BLOCK).cast("int").alias("mb"))
    sizes = F.broadcast(sizes)  # one row for each part, MAX_SAMPLE / PART_OF_SAMPLE of them at most
    left = homes.join(sizes, "part").select(
        "part", F.pmod(F.xxhash64("vector"), "nb").cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("mb") - 1)).alias("turn"), "vector", "keys")
    right = visits.join(sizes, "part").select(
        "part", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("block"),
        F.pmod(F.xxhash64("q"), "mb").cast("int").alias("turn"), "vector", "q")

    def compare(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"q": [], "key": [], "score": []}
        if len(rows) and len(asked):
            x, y, q = _matrix(rows.column("vector")), _matrix(asked.column("vector")), asked.column("q").to_numpy()
            keys = rows.column("keys").to_pylist()
            top = min(k + 1, len(x))
            for a in range(0, len(y), 256):
                s = y[a : a + 256] @ x.T
                least = np.partition(s, -top, axis=1)[:, -top]
                slack = 1e-9 * np.maximum(1.0, np.abs(s).max(axis=1))
                i, j = np.nonzero(s >= (least - slack)[:, None])
                exact = (y[a + i] * x[j]).sum(axis=1)
                for one in range(len(s)):
                    mine = np.flatnonzero(i == one)
                    pairs = sorted((-e, c) for e, r in zip(exact[mine].tolist(), j[mine].tolist()) for c in keys[r])[: k + 1]
                    out["q"] += [int(q[a + one])] * len(pairs)
                    out["key"] += [c for _, c in pairs]
                    out["score"] += [-e for e, _ in pairs]
        return pa.table(out, schema=pa.schema([("q", pa.int64()), ("key", pa.int64()), ("score", pa.float64())]))

    cell = ["part", "block", "turn"]
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(compare, "q long, key long, score double")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "key")
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    owners = asked.join(queries, "vector").select("q", F.col("key").alias("query_id"))
    pairs = owners.join(found, "q").where("key <> query_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "key")
    ranked = pairs.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("key").alias(key), "score")


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(values.reshape(len(column), -1), np.float64) if len(column) else np.zeros((0, 1))

"""Whitening of embeddings: leading principal components of all distinct vectors, to double precision.

Vectors become whole numbers, so sums over the corpus are exact and do not depend on their order. The covariance comes from
partial products of each task, added up by matrix row; one task then solves the matrix, whose size is that of a vector, whatever the
number of vectors. It takes eigenvectors in single precision and refines them by matrix multiplications in extended
precision (Ogita and Aishima): each round about doubles the correct digits. Directions whose eigenvalues lie too close
together for that are turned within their span by a small eigenproblem of their own, shifted to their common value.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.arrays import give_back
from contrail.session import materialize

STEPS = 256  # whole numbers for each unit of an entry
COMPONENTS = 4
ROUNDS = 12  # of refinement at most; four or five are usual
SMALL = 1 << 20  # entries up to here are multiplied as doubles without rounding
ROWS = 4096  # multiplied at a time
MODEL_ENTRIES = 4_000_000  # of all models that go to tasks at once: 32 MB
WIDE = np.longdouble


# vectors of whole numbers


def to_whole(values: np.ndarray) -> np.ndarray:
    """floor(256 c) of finite doubles; beyond 64 bits the nearest that fits."""
    x = np.floor(STEPS * values)
    inside = np.abs(x) < 2.0**63
    out = np.where(inside, x, 0).astype(np.int64)
    return np.where(inside, out, np.where(x > 0, np.iinfo(np.int64).max, np.iinfo(np.int64).min))


def to_code(x: np.ndarray) -> bytes:
    """The one shortest form of a vector: bytes of an entry, then the entries."""
    low, high = (int(x.min()), int(x.max())) if len(x) else (0, 0)
    width = next(w for w in (1, 2, 4, 8) if -(1 << (8 * w - 1)) <= low and high < 1 << (8 * w - 1))
    return bytes([width]) + x.astype(f"<i{width}").tobytes()


def from_codes(codes: Iterable[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(c, f"<i{c[0]}", offset=1).astype(np.int64) for c in codes])


def numbers(x: Iterable[int]) -> str:
    return ",".join(map(str, x))


def by_length(batch: pa.RecordBatch, wanted: set[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places in the batch, vectors) for a batch with columns dims and code, some thousand rows at a time."""
    dims, codes = batch.column("dims").to_numpy(), batch.column("code")
    for d in np.unique(dims).tolist():
        at = np.flatnonzero(dims == d)
        for a in range(0, len(at) if d in wanted else 0, ROWS):
            yield d, at[a : a + ROWS], from_codes(codes[i].as_py() for i in at[a : a + ROWS].tolist())


# the eigenproblem


def exact_ratio(a: int, b: int) -> np.longdouble:
    """a / b, rounded once or nearly so in extended precision."""
    high = a / b
    p, q = high.as_integer_ratio()
    return WIDE(high) + WIDE((a * q - p * b) / (b * q))


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix in extended precision."""
    n = len(a)
    size = np.abs(a).max() if n else WIDE(0)
    if not size:
        return np.zeros(n, WIDE), np.eye(n, dtype=WIDE)
    unit = WIDE(2.0) ** math.frexp(float(size))[1]
    a = a / unit
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(WIDE)
    one, norm = np.eye(n, dtype=WIDE), np.sqrt((a * a).sum())
    noise = 64 * n * np.finfo(WIDE).eps  # eigenvalues this close, of the norm, count as equal: any basis of their space will do
    for turn in range(ROUNDS):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2  # else their rounding, over small gaps, would spoil orthogonality
        value = np.diag(s) / (1 - np.diag(r))
        rest = s - np.diag(value)
        close = 2 * (np.sqrt((rest * rest).sum()) + norm * np.sqrt((r * r).sum()))
        gap = value[None, :] - value[:, None]
        if turn and max(np.abs(r).max(), np.abs(rest).max() / norm) < noise:
            break
        close = max(close, noise * norm)
        apart = np.abs(gap) > close
        step = np.where(apart, (s + value[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ step
        order = np.argsort(-value, kind="stable")
        x, value = x[:, order], value[order]
        # runs of neighbours that are too close to be told apart are solved within their span
        for run in np.split(np.arange(n), np.flatnonzero(-np.diff(value) > close) + 1):
            if len(run) == 1 or turn > 2 and value[run[0]] - value[run[-1]] <= noise * norm:
                continue
            part = x[:, run]
            centre = value[run].mean()
            small = part.T @ (a @ part - centre * part)
            small = (small + small.T) / 2
            scale = np.abs(small).max()
            if scale > 0:
                x[:, run] = part @ np.linalg.eigh((small / scale).astype(float))[1][:, ::-1].astype(WIDE)
    x = x + x @ (one - x.T @ x) / 2
    value = ((x * (a @ x)).sum(axis=0)) / (x * x).sum(axis=0)
    order = np.argsort(-value, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    sign = np.where(x[np.abs(x).argmax(axis=0), np.arange(n)] < 0, -1, 1)
    return value[order] * unit, x * sign


@dataclass(frozen=True)
class Model:
    """What rows of one length need: the number of distinct vectors, their sums, components (rows), eigenvalues and shares."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    shares: np.ndarray

    def off_mean(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly: 64-bit numbers where they suffice, Python's otherwise."""
        most = max(map(abs, self.sums), default=0) + self.n * (1 + int(np.abs(x.astype(float)).max()) if x.size else 0)
        if most < 2**62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def project(self, away: np.ndarray) -> np.ndarray:
        """Whitened coordinates; NaN for components without variance."""
        root = np.sqrt(self.values)
        y = (away / self.n).astype(float) @ self.vectors.T
        return np.divide(y, root, out=np.full(y.shape, np.nan), where=root > 0)


def deviations(away: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exactly; None beyond 64 bits."""
    if away.dtype != object and (not away.size or away.shape[1] * float(np.abs(away).max()) ** 2 < 2.0**62):
        return (away * away).sum(axis=1).tolist()
    found = [int(v) for v in (away.astype(object) ** 2).sum(axis=1)]
    return [v if v < 2**63 else None for v in found]


# the jobs


def to_codes(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows (key, dims, code) of the vectors that take part."""
    values = rows.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(1)
            x, edges = to_whole(v.flatten().to_numpy()), np.append(0, np.cumsum(np.diff(v.offsets.to_numpy())))
            dims = np.diff(edges)
            codes = [to_code(x[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dims.astype(np.int32)), pa.array(codes, pa.binary())], ["key", "dims", "code"])
        give_back()

    return values.where(F.col("v").isNotNull() & finite).mapInArrow(code, "key long, dims int, code binary")


def summed(parts: DataFrame, *keys: str) -> DataFrame:
    """Adds up columns n and sums (numbers of any size, as text) by ``keys``."""
    types = dict(parts.dtypes)

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total, n = None, 0
        for i in range(len(table)):
            mine = np.array(list(map(int, table.column("sums")[i].as_py().split(","))), object)
            total, n = mine if total is None else total + mine, n + table.column("n")[i].as_py()
        return pa.table({**{k: pa.array([v.as_py()], pa.int32()) for k, v in zip(keys, key)}, "n": pa.array([n], pa.int64()), "sums": pa.array([numbers(total)])})

    return parts.groupBy(*keys).applyInArrow(add, ", ".join([*(f"{k} {types[k]}" for k in keys), "n long, sums string"]))


def means(distinct: DataFrame, lengths: set[int]) -> dict[int, tuple[int, list[int]]]:
    """Number and sums of the distinct vectors of each length."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = {}, {}
        for batch in batches:
            for d, at, x in by_length(batch, lengths):
                n[d] = n.get(d, 0) + len(at)
                small = np.abs(x.astype(float)).max() < 2.0**50
                sums = (x if small else x.astype(object)).sum(axis=0).astype(object)
                total[d] = total[d] + sums if d in total else sums
        for d in n:
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([n[d]], pa.int64()), pa.array([numbers(total[d])])], ["dims", "n", "sums"])

    parts = distinct.mapInArrow(add, "dims int, n long, sums string")
    return {r["dims"]: (r["n"], list(map(int, r["sums"].split(",")))) for r in summed(parts, "dims").toLocalIterator()}


def models(distinct: DataFrame, mean: dict[int, tuple[int, list[int]]], components: int) -> dict[int, Model]:
    """Solve the covariance of each length."""
    near = {d: np.array([max(-SMALL // 2, min(SMALL // 2, round(s / n))) for s in sums], np.int64) for d, (n, sums) in mean.items()}

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fast, exact, spent = {}, {}, {}

        def flush(d: int) -> None:
            mine = fast.pop(d).astype(object)
            exact[d] = exact[d] + mine if d in exact else mine
            spent[d] = 0

        for batch in batches:
            for d, _, x in by_length(batch, set(near)):
                small = (np.abs(x.astype(float) - near[d]) < SMALL).all(axis=1)
                u = np.column_stack([x[small] - near[d], np.ones(small.sum(), np.int64)]).astype(float)
                got = (u.T @ u).astype(np.int64)  # below 2 ** 53 at each step
                fast[d] = fast[d] + got if d in fast else got
                spent[d] = spent.get(d, 0) + len(u) * SMALL**2
                if spent[d] > 1 << 61:
                    flush(d)
                for row in x[~small]:
                    u = np.append(row.astype(object) - near[d], 1)
                    exact[d] = (exact[d] if d in exact else 0) + np.outer(u, u)
        for d in list(fast):
            flush(d)
        for d, g in exact.items():
            for i, row in enumerate(g):
                yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([i], pa.int32()), pa.array([0], pa.int64()), pa.array([numbers(row)])], ["dims", "i", "n", "sums"])
        give_back()

    def solve(key: tuple, table: pa.Table) -> pa.Table:
        rows = dict(zip(table.column("i").to_pylist(), table.column("sums").to_pylist()))
        d = len(rows) - 1
        g = [list(map(int, rows[i].split(","))) for i in range(d + 1)]
        n = g[d][d]
        a = np.zeros((d, d), WIDE)
        for i in range(d):
            for j in range(i + 1):
                a[i, j] = a[j, i] = exact_ratio(n * g[i][j] - g[i][d] * g[j][d], n * n)
        value, x = eigen(a)
        trace, k = np.trace(a), min(components, d)
        noise = np.finfo(WIDE).eps * 16 * d * (value[0] if d else 0)
        value = np.where(value > noise, value, 0)
        share = (value / trace if trace else value)[:k].astype(float)
        flat = [[float(v) for v in x[:, c]] for c in range(k)]
        return pa.table({"dims": pa.array([key[0].as_py()], pa.int32()), "vectors": pa.array([flat], pa.list_(pa.list_(pa.float64()))), "values": pa.array([value[:k].astype(float).tolist()]), "shares": pa.array([share.tolist()])})

    parts = distinct.mapInArrow(multiply, "dims int, i int, n long, sums string")
    solved = summed(parts, "dims", "i").groupBy("dims").applyInArrow(solve, "dims int, vectors array<array<double>>, values array<double>, shares array<double>")
    return {
        r["dims"]: Model(*mean[r["dims"]], np.array(r["vectors"], float).reshape(-1, r["dims"]), np.array(r["values"]), np.array(r["shares"]))
        for r in solved.toLocalIterator()
    }


def identity_errors(distinct: DataFrame, model, lengths: set[int]) -> dict[int, float]:
    """Of each length: how far the covariance of the whitened distinct vectors is from the identity, at its worst entry.

    Components without variance are left out; None if there is no other.
    """

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for batch in batches:
            for d, _, x in by_length(batch, lengths):
                m = model.value[d]
                y = m.project(m.off_mean(x))[:, m.values > 0]
                y = np.column_stack([y, np.ones(len(y))])
                total[d] = total.get(d, 0) + y.T @ y
        for d, g in total.items():
            i, j = np.indices(g.shape).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(g.ravel())], ["dims", "i", "j", "s"])

    sums = distinct.mapInArrow(products, "dims int, i int, j int, s double").groupBy("dims", "i", "j").agg(F.sum("s").alias("s"))
    g = {(r["dims"], r["i"], r["j"]): r["s"] for r in sums.toLocalIterator()}  # 25 numbers for each length
    out = {}
    for d in lengths:
        k = int((model.value[d].values > 0).sum())
        mean = [g[d, i, k] / g[d, k, k] for i in range(k)]
        out[d] = max((abs(g[d, i, j] / g[d, k, k] - mean[i] * mean[j] - (i == j)) for i in range(k) for j in range(k)), default=None)
    return out


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Rows (key, component, n, deviation, whitened, explained, identity_error) for each row of ``rows`` and component.

    Rows whose vector is null or holds null, NaN or infinite entries are left out. An entry c counts as floor(256 c), cut to 64 bits. Vectors
    of different lengths lie in different spaces and are whitened apart, so ``n``, the number of distinct vectors, is that of the row's
    length; a length has as many components as dimensions, ``components`` at most, and an empty vector has none. A component without
    variance (of one distinct vector, or beyond the rank) has a null ``whitened`` and explains 0; ``deviation`` is null beyond
    64 bits. Repeated rows and null keys come out as they came in; they count once among the distinct. Other columns are left
    aside; an empty table gives an empty table. Of equal eigenvalues the components are any basis of their space.
    """
    spark = rows.sparkSession
    codes = materialize(to_codes(rows, key, vector), "vector-codes")
    distinct = materialize(codes.select("dims", "code").where("dims > 0").distinct(), "distinct-vectors")
    lengths = sorted(r["dims"] for r in distinct.select("dims").distinct().toLocalIterator())
    groups, room = [[]], 0
    for d in lengths:  # one group unless there are thousands of lengths
        room += d * (components + 2)
        if groups[-1] and room > MODEL_ENTRIES:
            groups, room = [*groups, []], d * (components + 2)
        groups[-1].append(d)
    shape = "key long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    schema = pa.schema([("key", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])
    out = None
    for group in groups:
        some = set(group)
        part = distinct if len(groups) == 1 else distinct.where(F.col("dims").isin(group))
        model = spark.sparkContext.broadcast(models(part, means(part, some), components) if group else {})
        errors = identity_errors(part, model, some) if group else {}

        def apply(batches: Iterator[pa.RecordBatch], model=model, errors=errors, some=some) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for d, at, x in by_length(batch, some):
                    m = model.value[d]
                    away, k = m.off_mean(x), len(m.values)
                    y = m.project(away)
                    columns = [
                        batch.column("key").take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                        pa.array(np.full(len(at) * k, m.n)), pa.array([v for v in deviations(away) for _ in range(k)], pa.int64()),
                        pa.array(y.ravel(), from_pandas=True), pa.array(np.tile(m.shares, len(at))), pa.array([errors[d]] * (len(at) * k), pa.float64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)
            give_back()

        found = codes.mapInArrow(apply, shape)
        out = found if out is None else out.unionByName(found)
    return out.withColumnRenamed("key", key)

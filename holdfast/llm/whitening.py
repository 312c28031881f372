"""Whitening of embeddings by eigenvectors of mixed precision.

Entries become whole numbers, so that counts, sums and products are exact and add up to the same in any order of
tasks. A first pass sums every dimension, a second one sums the products of the entries about their mean. The mean
there is the nearest whole number; the remainder, half a unit at most, is put right exactly at the end. What is
added up is one matrix per task and vector length, whatever the number of rows.

The eigenvectors are computed in float32 first. Ogita's and Aishima's iteration then corrects them by matrix
products in extended precision: what the products with the covariance and with each other leave off a diagonal
and an orthonormal matrix gives the next correction, whose error is about the square of the last one's. It divides by
differences of eigenvalues. Eigenvalues nearer to each other than the present error form a cluster, which is
turned by the eigenvectors of the covariance restricted to it, until it falls apart or is a multiple eigenvalue
as far as the arithmetic can tell.

Vectors of each length are a table of their own. Nulls and edges: vectors that are null, empty or hold a null or
non-finite entry are left out, as are entries of `LARGEST` or more, whose products no decimal holds; a null
identifier is carried through; repeated rows count each; directions without any variance are no components, so a
table of equal vectors, or of one, has no rows, and vectors shorter than `COMPONENTS` have fewer components; a
component's sign makes its largest entry positive; extra columns are not read; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import read_table, staged

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
LARGEST = float(1 << 32)
# Float products are exact up to here.
EXACT = 1 << 53
WIDE = np.longdouble
ROUNDS = 40
# Fitted values that a task is handed at once, in bytes; beyond that the lengths are taken in several passes.
HANDED_BYTES = 64 << 20
DECIMAL = pa.decimal128(38, 0)


def usable(vector: Column) -> Column:
    within = lambda c: c.isNotNull() & (F.abs(c.cast("double")) < LARGEST)
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, within), F.lit(False))


def vectors_of(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    vector = F.col(f"`{vector_col}`")
    rows = df.where(usable(vector))
    return rows.select(F.col(f"`{id_col}`").alias("id"), vector.cast("array<double>").alias("vector"))


def by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, entries as whole numbers) of the vectors of each length in a batch."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    starts = column.offsets.to_numpy()[:-1]
    entries = np.floor(SCALE * column.values.to_numpy(zero_copy_only=False)).astype(np.int64) + OFFSET
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield int(size), rows, entries[starts[rows][:, None] + np.arange(size)]


def exactly(value: np.ndarray) -> list[Decimal]:
    return [Decimal(int(v)) for v in value]


def sums(vectors: DataFrame) -> DataFrame:
    """(size, i, n, total): the number of vectors of each length and the sum of each of their dimensions."""
    schema = pa.schema([("size", pa.int32()), ("i", pa.int32()), ("n", pa.int64()), ("total", DECIMAL)])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for size, rows, entries in by_length(batch.column(0)):
                have = held.setdefault(size, [0, np.zeros(size, dtype=object)])
                have[0] += len(rows)
                have[1] = have[1] + entries.sum(axis=0).astype(object)
        for size, (n, total) in held.items():
            columns = [[size] * size, range(size), [n] * size, exactly(total)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    found = vectors.select("vector").mapInArrow(added, "size int, i int, n long, total decimal(38,0)")
    return found.groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"))


def products_of(entries: np.ndarray) -> np.ndarray:
    """The sum of the outer products of the rows, exactly."""
    most = int(np.abs(entries).max(initial=0))
    if len(entries) * most * most < EXACT:
        floats = entries.astype(np.float64)
        return (floats.T @ floats).astype(np.int64).astype(object)
    if len(entries) > 1 and most < 1 << 20:
        half = len(entries) // 2
        return products_of(entries[:half]) + products_of(entries[half:])
    wide = entries.astype(object)
    return wide.T @ wide


def products(vectors: DataFrame, middles: dict[int, np.ndarray]) -> DataFrame:
    """(size, i, j, total): sums of products of dimensions i and j >= i of the vectors about their middle."""
    schema = pa.schema([("size", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("total", DECIMAL)])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, _, entries in by_length(batch.column(0)):
                if size in middles:
                    part = products_of(entries - middles[size])
                    held[size] = held[size] + part if size in held else part
        for size, total in held.items():
            for i in range(size):
                columns = [[size] * (size - i), [i] * (size - i), range(i, size), exactly(total[i, i:])]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    found = vectors.select("vector").mapInArrow(added, "size int, i int, j int, total decimal(38,0)")
    return found.groupBy("size", "i", "j").agg(F.sum("total").cast("decimal(38,0)").alias("total"))


def extended(numerator: int, denominator: int) -> np.longdouble:
    """The quotient in extended precision: the nearest double, and what it leaves."""
    near = numerator / denominator
    p, q = near.as_integer_ratio()
    return WIDE(near) + WIDE((numerator * q - p * denominator) / (denominator * q))


def covariance(n: int, rest: list[int], total: dict[tuple[int, int], int]) -> np.ndarray:
    """From sums of products about a middle, and the sums `rest` of what lies beside that middle."""
    size = len(rest)
    matrix = np.zeros((size, size), dtype=WIDE)
    for (i, j), value in total.items():
        matrix[i, j] = matrix[j, i] = extended(n * value - rest[i] * rest[j], n * n)
    return matrix


def clusters(values: np.ndarray, apart: float) -> list[np.ndarray]:
    """Places of eigenvalues nearer to a neighbour than `apart`, neighbours together."""
    order = np.argsort(values, kind="stable")
    breaks = np.flatnonzero(np.diff(values[order]) > apart) + 1
    return [part for part in np.split(order, breaks) if len(part) > 1]


def eigenvectors(matrix: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors, in the columns, of a symmetric matrix of extended precision."""
    scale = np.abs(matrix).max(initial=0)
    size = len(matrix)
    if not scale > 0:
        return np.zeros(size, dtype=WIDE), np.eye(size, dtype=WIDE)
    a = matrix / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(WIDE)
    one, floor = np.eye(size, dtype=WIDE), 16 * float(np.finfo(WIDE).eps) * size * norm(a)
    best, least, idle = x, float("inf"), 0
    for _ in range(rounds):
        values, r, s = quotients(a, x, one)
        error = off_by(a, values, r, s)
        idle = 0 if error < least else idle + 1
        if error < least:
            best, least = x, error
        if least <= floor or idle == 3:
            break
        turned = sub_solved(x, values, r, s, error)
        if turned is not None:
            x = turned
            values, r, s = quotients(a, x, one)
            error = off_by(a, values, r, s)
        gaps = values[None, :] - values[:, None]
        far = np.abs(gaps) > error
        x = x + x @ np.where(far, (s + values[None, :] * r) / np.where(far, gaps, 1), r / 2)
    x = best + best @ (one - best.T @ best) / 2  # what noise between the smallest eigenvalues leaves askew
    values = quotients(a, x, one)[0]
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    signs = np.where(x[np.abs(x).argmax(axis=0), np.arange(size)] < 0, -1, 1)
    return values[order] * scale, x * signs


def quotients(a: np.ndarray, x: np.ndarray, one: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The columns' eigenvalues, how far the columns are from orthonormal, and the matrix in their terms."""
    r = one - x.T @ x
    s = x.T @ (a @ x)
    s = (s + s.T) / 2
    return np.diag(s) / (1 - np.diag(r)), r, s


def off_by(a: np.ndarray, values: np.ndarray, r: np.ndarray, s: np.ndarray) -> float:
    """A bound, up to a small factor, on the error of the eigenvalues."""
    return 2 * (norm(s - np.diag(values)) + norm(a) * norm(r))


def sub_solved(x: np.ndarray, values: np.ndarray, r: np.ndarray, s: np.ndarray, error: float) -> np.ndarray | None:
    """The columns of each cluster turned by the eigenvectors of the matrix restricted to them, less the cluster's
    middle, so that its small differences fill the digits; none if there are no clusters."""
    parts = clusters(values, error)
    if not parts:
        return None
    x = x.copy()
    for part in parts:
        middle, here = values[part].mean(), np.ix_(part, part)
        inner = s[here] + middle * r[here] - middle * np.eye(len(part))
        largest = np.abs(inner).max()
        if largest > 0:
            turn = np.linalg.eigh((inner / largest).astype(np.float64))[1]
            x[:, part] = x[:, part] @ turn.astype(WIDE)
    return x


def norm(matrix: np.ndarray) -> float:
    return float(np.linalg.norm(matrix.astype(np.float64), 2))


@dataclass(frozen=True)
class Fit:
    """What whitening the vectors of one length needs."""

    n: int
    middle: np.ndarray  # whole numbers next to the mean
    rest: np.ndarray  # sums of what lies beside them: n * mean - n * middle
    project: np.ndarray  # a column per component: eigenvector over the root of its eigenvalue

    def whitened(self, entries: np.ndarray) -> np.ndarray:
        beside = (self.rest / self.n).astype(np.float64)
        return (entries - self.middle - beside) @ self.project

    def deviations(self, entries: np.ndarray) -> list[Decimal]:
        """Sums over the dimensions of the squares of n * x - S."""
        near = entries - self.middle
        most = self.n * int(np.abs(near).max(initial=0)) + self.n
        if most * most * len(self.middle) < 1 << 63:
            apart = self.n * near - self.rest.astype(np.int64)
            return exactly((apart * apart).sum(axis=1))
        apart = self.n * near.astype(object) - self.rest
        return exactly((apart * apart).sum(axis=1))


def solved(moments: DataFrame, components: int) -> DataFrame:
    """(size, n, values, vectors, explained): the eigenvalues and, one after the other, the eigenvectors of each
    vector length, a task per length; as many rows as the square of the length come together there."""

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        size, n = int(rows["size"].iloc[0]), int(rows["n"].max())
        rest = [0] * size
        total = {}
        for i, j, value in zip(rows["i"], rows["j"], rows["total"], strict=True):
            if j < 0:
                rest[i] = int(value)
            else:
                total[i, j] = int(value)
        matrix = covariance(n, rest, total)
        values, vectors = eigenvectors(matrix)
        trace = np.trace(matrix)
        kept = [k for k in range(min(components, size)) if values[k] > size * np.finfo(np.float64).eps * values[0]]
        project = [(vectors[:, k] / np.sqrt(values[k])).astype(np.float64) for k in kept]
        return pd.DataFrame(
            {
                "size": [size],
                "n": [n],
                "project": [np.concatenate(project).tolist() if kept else []],
                "eigenvalues": [[float(values[k]) for k in kept]],
                "explained": [[float(values[k] / trace) for k in kept]],
            }
        )

    schema = "size int, n long, project array<double>, eigenvalues array<double>, explained array<double>"
    return moments.groupBy("size").applyInPandas(solve, schema)


def batches_of(lengths: list[int], bytes_each) -> list[list[int]]:
    """The lengths in groups whose fitted values stay below what a task may be handed."""
    groups: list[list[int]] = [[]]
    used = 0
    for size in lengths:
        if groups[-1] and used + bytes_each(size) > HANDED_BYTES:
            groups.append([])
            used = 0
        groups[-1].append(size)
        used += bytes_each(size)
    return groups


def united(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole


def whiten(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> tuple[DataFrame, DataFrame]:
    """Whitened vectors (id, size, deviation, whitened), and per length a row (size, n, project, eigenvalues,
    explained, identity_error)."""
    vectors = vectors_of(df, id_col, vector_col)
    summed = staged(sums(vectors))
    lengths = [r["size"] for r in summed.select("size").distinct().orderBy("size").collect()]
    groups = batches_of(lengths, lambda size: 8 * size)
    middle = F.round(F.col("total") / F.col("n")).cast("long")
    summed = summed.withColumn("middle", middle)

    def per_length(rows: DataFrame, group: list[int], *names: str) -> dict[int, list[np.ndarray]]:
        """Columns of one row per dimension, as arrays by vector length."""
        held: dict[int, list[list]] = {size: [[None] * size for _ in names] for size in group}
        for row in rows.where(F.col("size").isin(group)).collect():
            for name, into in zip(names, held[row["size"]], strict=True):
                into[row["i"]] = int(row[name])
        return {size: [np.array(c, dtype=object) for c in columns] for size, columns in held.items()}

    parts = []
    for group in groups:
        middles = {size: m[0].astype(np.int64) for size, m in per_length(summed, group, "middle").items()}
        parts.append(products(vectors, middles))
    pairs = united(parts).select("size", "i", "j", "total", F.lit(0).cast("long").alias("n"))
    beside = (F.col("total") - F.col("n").cast("decimal(38,0)") * F.col("middle")).cast("decimal(38,0)")
    edge = summed.select("size", "i", F.lit(-1).alias("j"), beside.alias("total"), "n")
    fitted = staged(solved(pairs.union(edge), components))

    parts = []
    rests = summed.withColumn("rest", beside)
    for group in batches_of(lengths, lambda size: 8 * size * (components + 2)):
        dimensions = per_length(rests, group, "middle", "rest")
        fits = {}
        for row in fitted.where(F.col("size").isin(group)).collect():
            size = row["size"]
            project = np.array(row["project"], dtype=np.float64).reshape(-1, size).T
            fits[size] = Fit(row["n"], dimensions[size][0].astype(np.int64), dimensions[size][1], project)
        parts.append(applied(vectors, fits))
    whitened = staged(united(parts))
    return whitened, fitted.join(identity_errors(whitened, components), "size")


def applied(vectors: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    id_type = vectors.schema["id"].dataType.simpleString()

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, rows, entries in by_length(batch.column(1)):
                if size not in fits:
                    continue
                fit = fits[size]
                arrays = [
                    batch.column(0).take(pa.array(rows)),
                    pa.array([size] * len(rows), pa.int32()),
                    pa.array(fit.deviations(entries), DECIMAL),
                    pa.array(fit.whitened(entries).tolist(), pa.list_(pa.float64())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "size", "deviation", "whitened"])

    columns = f"id {id_type}, size int, deviation decimal(38,0), whitened array<double>"
    return vectors.mapInArrow(whitened, columns)


def identity_errors(whitened: DataFrame, components: int) -> DataFrame:
    """(size, identity_error): how far the whitened vectors' covariance is from the identity, by its worst entry."""
    entry = lambda k: F.get("whitened", F.lit(k))
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    found = whitened.groupBy("size").agg(*[F.covar_pop(entry(i), entry(j)).alias(f"c{i}_{j}") for i, j in pairs])
    errors = F.array(*[F.abs(F.col(f"c{i}_{j}") - float(i == j)) for i, j in pairs])
    return found.select("size", F.array_max(errors).alias("identity_error"))


def by_component(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error,
    eigenvalue, size. A deviation that is no long is null; `whiten` has it as a decimal."""
    whitened, fitted = whiten(df, id_col, vector_col, components)
    rows = whitened.select("id", "size", F.col("deviation").try_cast("long").alias("deviation"),
                           F.posexplode("whitened").alias("k", "value"))
    per_length = staged(fitted.select("size", "n", "eigenvalues", "explained", "identity_error"))
    return rows.join(per_length, "size").select(
        F.col("id").alias("vec_id"),
        (F.col("k") + 1).alias("component"),
        "n",
        "deviation",
        F.col("value").alias("whitened"),
        F.get("explained", F.col("k")).alias("explained"),
        "identity_error",
        F.get("eigenvalues", F.col("k")).alias("eigenvalue"),
        "size",
    )


def query(spark, sf_dir: str) -> DataFrame:
    return by_component(read_table(spark, sf_dir, "embeddings"))

"""Approximate nearest neighbours by learned partitions.

A bounded sample of vectors is made into a neighbour graph, and the graph is cut into equal parts by halving
again and again, each time along the graph's slowest-changing direction and then by exchanging vertices that
save cut edges. A small network learns, from each sampled vector, over which parts its neighbours spread.
It files every vector of the table under its most probable part, and sends each query to several probable
ones, where all vectors are compared exactly. How many parts that are is measured on sampled vectors kept
out of the training, for a given recall.

The sample is the only thing bounded (`SAMPLED`); every row is filed and can be found. Vectors filed under
one part are spread over blocks of about `ROWS_PER_BLOCK` and queries over chunks of about
`QUERIES_PER_CHUNK`, so no task grows with a part's size. Of identical vectors only as many as one query can
return are compared, those with the smallest identifiers: further ones come behind them in every answer.

Nulls and edges: vectors that are null, empty or zero or hold null or non-finite components take no part,
nor do rows without identifier; vectors of another length are a table of their own, with its own parts and
network, and every query is compared with those of its length; of a repeated query identifier the smallest
vector asks; rows with a query's identifier are its own; ties go to the smaller identifier; a query sees all
candidates if there are fewer than asked for; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import read_table, staged

SAMPLED = 8_192
KEPT_OUT = 0.125
PARTS = 16
NEIGHBOURS = 5
GRAPH_NEIGHBOURS = 10
HIDDEN = 128
PASSES, BATCH, STEP_SIZE = 40, 256, 2e-3
RECALL = 0.96
ROWS_PER_BLOCK = 20_000
QUERIES_PER_CHUNK = 4_096
COMPARED_AT_ONCE = 256
NEARLY = 1e-9
SEED = 3
FOUND = "query_id long, vec_id long, score double"


def nearest_rows(points: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k nearest `points` (unit vectors) for each query."""
    out = []
    for low in range(0, len(queries), 1024):
        scores = queries[low : low + 1024] @ points.T
        out.append(np.argsort(-scores, axis=1, kind="stable")[:, :k])
    return np.concatenate(out)


def halve(links: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Cut a graph (symmetric weights) into two halves of equal size; true for the second."""
    size = len(links)
    degree = links.sum(axis=1) + 1e-9
    scale = 1 / np.sqrt(degree)
    trivial = np.sqrt(degree) / np.linalg.norm(np.sqrt(degree))
    vector = rng.standard_normal(size)
    for _ in range(60):
        vector = (scale * (links @ (scale * vector)) + vector) / 2
        vector -= trivial * (trivial @ vector)
        vector /= np.linalg.norm(vector) + 1e-12
    second = np.zeros(size, dtype=bool)
    second[np.argsort(vector, kind="stable")[size // 2 :]] = True
    for _ in range(30):
        to_second = links @ second
        to_first = links.sum(axis=1) - to_second
        gain = np.where(second, to_first - to_second, to_second - to_first)
        ones = np.flatnonzero(~second)[np.argsort(-gain[~second], kind="stable")]
        twos = np.flatnonzero(second)[np.argsort(-gain[second], kind="stable")]
        pairs = min(len(ones), len(twos), max(1, size // 50))
        better = gain[ones[:pairs]] + gain[twos[:pairs]] - 2 * links[ones[:pairs], twos[:pairs]] > 1e-9
        if not better.any():
            break
        second[ones[:pairs][better]] = True
        second[twos[:pairs][better]] = False
    return second


def balanced_parts(near: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Part of each vertex of the graph that links every row with the rows in `near`; `parts` a power of 2."""
    size = len(near)
    links = np.zeros((size, size), dtype=np.float32)
    links[np.repeat(np.arange(size), near.shape[1]), near.ravel()] = 1
    links = np.maximum(links, links.T)
    part = np.zeros(size, dtype=np.int64)
    groups = [np.arange(size)]
    for _ in range(int(math.log2(parts))):
        halves = []
        for members in groups:
            second = halve(links[np.ix_(members, members)], rng)
            part[members] = 2 * part[members] + second
            halves += [members[~second], members[second]]
        groups = halves
    return part


@dataclass(frozen=True)
class Router:
    """A network with one hidden layer: from unit vectors to log-odds of the parts."""

    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: np.ndarray
    probes: int

    @property
    def parts(self) -> int:
        return len(self.second_bias)

    def odds(self, unit: np.ndarray) -> np.ndarray:
        return np.maximum(unit @ self.first + self.first_bias, 0) @ self.second + self.second_bias


def train_router(unit: np.ndarray, spread: np.ndarray, rng: np.random.Generator) -> list[np.ndarray]:
    """Fit the network to the distributions `spread` over parts, by Adam on batches."""
    width, parts = unit.shape[1], spread.shape[1]
    weights = [
        rng.standard_normal((width, HIDDEN)) * math.sqrt(2 / width), np.zeros(HIDDEN),
        rng.standard_normal((HIDDEN, parts)) * math.sqrt(1 / HIDDEN), np.zeros(parts),
    ]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(PASSES):
        order = rng.permutation(len(unit))
        for low in range(0, len(unit), BATCH):
            rows = order[low : low + BATCH]
            hidden = np.maximum(unit[rows] @ weights[0] + weights[1], 0)
            odds = hidden @ weights[2] + weights[3]
            share = np.exp(odds - odds.max(axis=1, keepdims=True))
            error = (share / share.sum(axis=1, keepdims=True) - spread[rows]) / len(rows)
            back = (error @ weights[2].T) * (hidden > 0)
            slopes = [unit[rows].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            step += 1
            for i, slope in enumerate(slopes):
                slope = slope + 1e-4 * weights[i]
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                move = (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
                weights[i] = weights[i] - STEP_SIZE * move
    return weights


def learn(vectors: np.ndarray, parts: int, recall: float, k: int) -> Router:
    """Parts, network and number of probes from a sample."""
    rng = np.random.default_rng(SEED)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    fit = max(2, int(len(unit) * (1 - KEPT_OUT)))
    trained, kept_out = unit[:fit], unit[fit:]
    parts = min(parts, 1 << max(0, (len(trained) // 32).bit_length() - 1))
    near = nearest_rows(trained, trained, min(GRAPH_NEIGHBOURS + 1, len(trained)))
    part = balanced_parts(near, parts, rng)
    spread = np.zeros((len(trained), parts))
    np.add.at(spread, (np.repeat(np.arange(len(trained)), near.shape[1]), part[near].ravel()), 1)
    weights = train_router(trained, spread / spread.sum(axis=1, keepdims=True), rng)
    router = Router(*weights, probes=parts)
    if not len(kept_out):
        return router
    filed = router.odds(trained).argmax(axis=1)
    place = np.argsort(np.argsort(-router.odds(kept_out), axis=1), axis=1)
    wanted = filed[nearest_rows(trained, kept_out, min(k, len(trained)))]
    places = np.take_along_axis(place, wanted, axis=1).ravel()
    reached = np.cumsum(np.bincount(places, minlength=parts)) / len(places)
    return Router(*weights, probes=int(np.argmax(reached >= recall)) + 1)


def _stacked(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def fit_router(vectors: DataFrame, parts: int, recall: float, k: int) -> Router | None:
    """Learn from `SAMPLED` vectors at most, chosen by hash of the identifier, in one task."""
    spread = F.xxhash64("vec_id", F.lit(SEED))
    sample = vectors.withColumn("spread", spread).orderBy("spread", "vec_id").limit(SAMPLED)
    names = ["first", "first_bias", "second", "second_bias"]

    def learnt(rows: pd.DataFrame) -> pd.DataFrame:
        router = learn(_stacked(rows.sort_values(["spread", "vec_id"])["vector"]), parts, recall, k)
        held = {n: [getattr(router, n).ravel().tolist()] for n in names}
        return pd.DataFrame(held | {"parts": [router.parts], "probes": [router.probes]})

    schema = ", ".join(f"{n} array<double>" for n in names) + ", parts int, probes int"
    found = sample.groupBy(F.lit(0).alias("all")).applyInPandas(learnt, schema).collect()
    if not found:
        return None
    row = found[0]
    return Router(
        np.reshape(row["first"], (-1, HIDDEN)), np.array(row["first_bias"]),
        np.reshape(row["second"], (HIDDEN, row["parts"])), np.array(row["second_bias"]), row["probes"],
    )


def usable_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector): rows that take part."""
    vector = F.col("vector")
    infinite = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    rows = df.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector")
    )
    return rows.where(F.col("vec_id").isNotNull() & finite & F.exists(vector, lambda x: x != 0))


def few_of_each(vectors: DataFrame, k: int) -> DataFrame:
    """Of identical vectors the k + 1 smallest identifiers, repeated rows once."""
    first = Window.partitionBy("vector").orderBy("vec_id")
    ranked = vectors.withColumn("rank", F.dense_rank().over(first)).where(F.col("rank") <= k + 1)
    return ranked.groupBy("vec_id", "vector").agg(F.first("rank").alias("rank")).drop("rank")


def part_of(vector: Column, router: Router) -> Column:
    @F.pandas_udf("int")
    def filed(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype="int32")
        rows = _stacked(vectors)
        return pd.Series(router.odds(rows / np.linalg.norm(rows, axis=1, keepdims=True)).argmax(axis=1).astype("int32"))

    return filed(vector)


def parts_asked(vector: Column, router: Router, held: list[int], least: int) -> Column:
    """The most probable parts, more of them while they hold fewer than `least` vectors."""

    @F.pandas_udf("array<int>")
    def asked(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        rows = _stacked(vectors)
        order = np.argsort(-router.odds(rows / np.linalg.norm(rows, axis=1, keepdims=True)), axis=1, kind="stable")
        enough = (np.cumsum(np.array(held)[order], axis=1) < least).sum(axis=1) + 1
        probes = np.clip(np.maximum(enough, router.probes), 1, router.parts)
        return pd.Series([o[:p].astype("int32") for o, p in zip(order, probes, strict=True)], dtype=object)

    return asked(vector)


def best_in_block(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> Iterator[tuple[int, int, float]]:
    """(query, row, cosine) of each query's k best rows of one block."""
    if not len(queries) or not len(rows):
        return
    ids = rows["vec_id"].to_numpy()
    points, asked = _stacked(rows["vector"]), _stacked(queries["vector"])
    point_norms = np.sqrt((points * points).sum(axis=1))
    asked_ids = queries["vec_id"].to_numpy()
    for low in range(0, len(asked), COMPARED_AT_ONCE):
        part = asked[low : low + COMPARED_AT_ONCE]
        scores = (part / np.linalg.norm(part, axis=1, keepdims=True)) @ (points / point_norms[:, None]).T
        own = asked_ids[low : low + COMPARED_AT_ONCE]
        scores[own[:, None] == ids[None, :]] = -np.inf
        for query, number, vector in zip(scores, own, part, strict=True):
            there = min(k, int((query > -np.inf).sum()))
            if not there:
                continue
            bound = np.partition(query, len(query) - there)[len(query) - there]
            close = np.flatnonzero((query >= bound - NEARLY) & (query > -np.inf))
            exact = (points[close] * vector).sum(axis=1) / (point_norms[close] * np.sqrt((vector * vector).sum()))
            for at in np.lexsort((ids[close], -exact))[:k]:
                yield int(number), int(ids[close[at]]), float(exact[at])


def nearest(vectors: DataFrame, asked: DataFrame, k: int, parts: int, recall: float) -> DataFrame:
    """(query_id, vec_id, score) of the best rows of each part asked, for vectors of one length."""
    router = fit_router(vectors, parts, recall, k)
    if router is None:
        return vectors.sparkSession.createDataFrame([], FOUND)
    filed = staged(few_of_each(vectors, k).withColumn("part", part_of(F.col("vector"), router)))
    counted = {r["part"]: r["count"] for r in filed.groupBy("part").count().collect()}  # a row per part
    held = [counted.get(p, 0) for p in range(router.parts)]
    asked = staged(asked.withColumn("parts", parts_asked(F.col("vector"), router, held, 2 * k + 2)))
    asked = asked.select("vec_id", "vector", F.explode("parts").alias("part"))
    asking = {r["part"]: r["count"] for r in asked.groupBy("part").count().collect()}  # a row per part
    blocks = [max(1, -(-n // ROWS_PER_BLOCK)) for n in held]
    chunks = [max(1, -(-asking.get(p, 0) // QUERIES_PER_CHUNK)) for p in range(router.parts)]

    def of_part(values: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("part") + 1)

    def number(of: Column, values: list[int]) -> Column:
        return F.pmod(of, of_part(values)).cast("int")

    def every(values: list[int]) -> Column:
        return F.explode(F.sequence(F.lit(0), of_part(values) - 1))

    hashed = F.xxhash64("vec_id")
    left = asked.withColumn("chunk", number(hashed, chunks)).withColumn("block", every(blocks))
    right = filed.withColumn("block", number(hashed, blocks)).withColumn("chunk", every(chunks))

    def compare(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        best = list(best_in_block(queries, rows, k))
        return pd.DataFrame(best, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    cell = ["part", "chunk", "block"]
    return left.groupBy(cell).cogroup(right.groupBy(cell)).applyInPandas(compare, FOUND)


def search(
    df: DataFrame,
    is_query: Column,
    k: int = NEIGHBOURS,
    parts: int = PARTS,
    recall: float = RECALL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The k nearest rows of each query: query_id, rank, vec_id, score. `is_query` reads column vec_id."""
    vectors = usable_vectors(df, id_col, vector_col)
    asked = vectors.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    size = F.size("vector")
    found = df.sparkSession.createDataFrame([], FOUND)
    for row in asked.select(size.alias("length")).distinct().orderBy("length").collect():  # a row per vector length
        here = size == row["length"]
        found = found.union(nearest(vectors.where(here), asked.where(here), k, parts, recall))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)

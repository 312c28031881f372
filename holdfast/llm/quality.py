"""Quality by hierarchical empirical Bayes.

A classifier reads each document and gives its probability of being good. These probabilities are summed
per host and per path of a host. A host's rate is drawn towards the global rate, a path's rate towards its
host's, each with a strength that comes from how much the groups differ: sparse sites end up near their
parent, large ones keep their own rate. A document's posterior joins the evidence of its text with the rate
of its path, from which its own share has been taken out.

The classifier is logistic, trained with numpy on a sample of `LABELLED` rows at most; counts, rates and
strengths cover every document.

Nulls and edges: a null text counts as empty; a null host or path is a site of its own, the same as the
empty string; rows with a null identifier are judged like others; repeated rows each count; with no usable
labels the evidence is even and every document is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import held_out, read_table, row_of, staged, unpacked

LABELLED = 20_000
SEED = 5
STEPS = 400
STEP_SIZE = 0.1
DECAY = 1e-4
KEEP_FROM = 0.5
# Bounds of the strength with which a group is drawn towards its parent, in documents.
WEAKEST, STRONGEST = 1.0, 1e6
EVEN = 1e-6

FEATURES = (
    "capital letters", "other symbols", "exclamation marks", "digits", "bars",
    "repeated neighbours", "distinct words", "repeated lines", "letters in a word", "words",
)
# Byte classes: 0 other, 1 capital letter, 2 symbol, 3 exclamation mark, 4 digit, 5 bar, 6 small letter.
BYTE_CLASS = np.zeros(256, dtype=np.uint8)
BYTE_CLASS[ord("A") : ord("Z") + 1] = 1
BYTE_CLASS[list(b"#$%&*~^<>{}[]\\/=+_@`")] = 2
BYTE_CLASS[ord("!")] = 3
BYTE_CLASS[ord("0") : ord("9") + 1] = 4
BYTE_CLASS[ord("|")] = 5
BYTE_CLASS[ord("a") : ord("z") + 1] = 6
BYTE_CLASS[0x80:] = 6
BYTES_AT_ONCE = 1 << 20


def text_features(text: str | None) -> np.ndarray:
    text = text or ""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    classes = np.zeros(7)
    for low in range(0, len(data), BYTES_AT_ONCE):
        classes += np.bincount(BYTE_CLASS[data[low : low + BYTES_AT_ONCE]], minlength=7)
    words = text.split()
    lines = text.split("\n")
    size, letters, count = max(len(data), 1), max(classes[1] + classes[6], 1), max(len(words), 1)
    repeated = sum(map(operator.eq, words, words[1:]))
    return np.array(
        [
            classes[1] / letters,
            classes[2] / size,
            classes[3] / size,
            classes[4] / size,
            classes[5] / size,
            repeated / count,
            len(set(words)) / count,
            1 - len(set(lines)) / len(lines),
            letters / count / 10,
            np.log1p(len(words)) / 10,
        ]
    )


@dataclass(frozen=True)
class Evidence:
    """A logistic classifier over standardised features; `base` is the share of good rows it was trained on."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float
    base: float

    def probability(self, text: Column) -> Column:
        centre, spread, weights, bias = self.centre, self.spread, self.weights, self.bias

        @F.pandas_udf("double")
        def compute(texts: pd.Series) -> pd.Series:
            rows = np.array([text_features(t) for t in texts]).reshape(-1, len(FEATURES))
            logits = ((rows - centre) / spread).clip(-20, 20) @ weights + bias
            return pd.Series(1 / (1 + np.exp(-np.clip(logits, -30, 30))))

        return compute(text)


def train_logistic(rows: np.ndarray, good: np.ndarray) -> Evidence:
    centre, spread = rows.mean(axis=0), rows.std(axis=0) + 1e-6
    scaled = ((rows - centre) / spread).clip(-20, 20)
    base = float(good.mean())
    weights, bias = np.zeros(rows.shape[1]), float(np.log(base / (1 - base)))
    first, second = np.zeros(rows.shape[1] + 1), np.zeros(rows.shape[1] + 1)
    for step in range(1, STEPS + 1):
        error = (1 / (1 + np.exp(-np.clip(scaled @ weights + bias, -30, 30))) - good) / len(good)
        slope = np.append(error @ scaled + DECAY * weights, error.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        move = STEP_SIZE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - float(move[-1])
    return Evidence(centre, spread, weights, bias, base)


def fit_evidence(docs: DataFrame, labels: DataFrame) -> Evidence:
    """Train on documents (doc_id, text) and labels (doc_id, quality), by hash of the id and never on the
    held-out fourth. Of several labels of a document the smallest counts."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    ids = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    ids = ids.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(LABELLED)

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([text_features(t).tolist() for t in texts])

    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # LABELLED identifiers at most
    described = texts.select("doc_id", "quality", features("text").alias("features"))
    each = described.groupBy("doc_id").agg(F.min(F.struct("features", "quality")).alias("one")).select("one.*")
    found = sorted(each.collect())  # LABELLED rows of a few numbers at most
    good = np.array([r["quality"] for r in found], dtype=float)
    width = len(FEATURES)
    if not 0 < good.sum() < len(good):
        return Evidence(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 0.5)
    return train_logistic(np.array([r["features"] for r in found]), good)


def _logit(p: Column) -> Column:
    held = F.least(F.greatest(p, F.lit(EVEN)), F.lit(1 - EVEN))
    return F.log(held / (1 - held))


def _strength(groups: DataFrame, parent: str) -> float:
    """By moments: how many documents of evidence the parent's rate is worth, from groups
    (documents, good, <parent>)."""
    rate = F.col("good") / F.col("documents")
    row = groups.agg(
        F.sum("documents").alias("n"),
        F.count(F.lit(1)).alias("groups"),
        F.sum(F.col("documents") * (rate - F.col(parent)) ** 2).alias("apart"),
        F.sum(F.col("documents") * F.col(parent) * (1 - F.col(parent))).alias("inside"),
    ).first()
    if not row["n"] or row["groups"] < 2:
        return WEAKEST
    inside = row["inside"] / row["n"]
    between = row["apart"] / row["n"] - inside * row["groups"] / row["n"]
    if between <= 0:
        return STRONGEST
    return min(max(inside / between - 1, WEAKEST), STRONGEST)


def site_rates(rows: DataFrame) -> tuple[DataFrame, float]:
    """From rows (host, path, p): a row per path with its host's posterior and its own sums, and the strength
    with which the host's posterior draws the path's."""
    paths = staged(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("documents"), F.sum("p").alias("good")))
    total = paths.agg(F.sum("good") / F.sum("documents")).first()[0]
    hosts = paths.groupBy("host").agg(F.sum("documents").alias("documents"), F.sum("good").alias("good"))
    hosts = hosts.withColumn("parent", F.lit(total if total is not None else 0.5))
    strength = _strength(hosts, "parent")
    posterior = (F.col("good") + strength * F.col("parent")) / (F.col("documents") + strength)
    rates = paths.join(hosts.select("host", posterior.alias("host_posterior")), "host")
    rates = staged(rates)
    return rates, _strength(rates, "host_posterior")


def posteriors(strength: float, base: float) -> tuple[Column, Column]:
    """A path's rate without the row's own share, and the document's posterior, over joined rows."""
    rate = (F.col("good") - F.col("p") + strength * F.col("host_posterior")) / (F.col("documents") - 1 + strength)
    logit = _logit(F.col("p")) - _logit(F.lit(base)) + _logit(rate)
    return rate, 1 / (1 + F.exp(-logit))


def _site(df: DataFrame, host_col: str, path_col: str) -> list[Column]:
    return [
        F.coalesce(F.col(f"`{host_col}`").cast("string"), F.lit("")).alias("host"),
        F.coalesce(F.col(f"`{path_col}`").cast("string"), F.lit("")).alias("path"),
    ]


def judge(docs: DataFrame, evidence: Evidence, host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """One row per document: doc_id, host, path, doc_score, host_posterior, path_posterior, posterior, keep."""
    p = evidence.probability(F.col("text")).alias("p")
    rows = staged(docs.select("doc_id", *_site(docs, host_col, path_col), p))
    rates, strength = site_rates(rows)
    rate, posterior = posteriors(strength, evidence.base)
    judged = rows.join(rates, ["host", "path"]).select(
        "doc_id",
        "host",
        "path",
        F.col("p").alias("doc_score"),
        "host_posterior",
        rate.alias("path_posterior"),
        posterior.alias("posterior"),
    )
    return judged.withColumn("keep", F.col("posterior") >= KEEP_FROM)


def drop_poor(docs: DataFrame, evidence: Evidence, host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """The rows of `docs` that are kept, with its columns."""
    p = evidence.probability(F.col("text")).alias("p")
    site = _site(docs, host_col, path_col)
    rates, strength = site_rates(docs.select(*site, p))
    _, posterior = posteriors(strength, evidence.base)
    rows = docs.select(row_of(docs).alias("row"), *site, p)
    return unpacked(rows.join(rates, ["host", "path"]).where(posterior >= KEEP_FROM))


def query(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return judge(docs, fit_evidence(docs, read_table(spark, sf_dir, "labels")))

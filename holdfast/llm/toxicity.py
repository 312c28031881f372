"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic examples are the only labelled class; all other text is unlabelled, a mixture that holds
toxic text in the share of the class prior. The risk of a classifier is
    prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)])
where the second part estimates the risk on clean text and is kept from going below zero. Several linear
classifiers are trained with numpy, each in a task of its own on the confirmed examples and its own share of the
unlabelled ones, and their logits averaged. Inputs are how often which byte n-grams occur, at every
position of the whole text, and nothing but the text.

`POSITIVES` and `UNLABELLED` bound the sample; the prior comes from all labels that may be learnt from and
is held against the sample.

Nulls and edges: a null or empty text has no n-grams and scores the classifiers' bias; rows with a null
identifier are scored, never learnt from, and not held out; repeated identifiers give one example and one
row each; without examples every score is the prior; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import held_out, read_table

BUCKET_BITS = 22
NGRAM_BYTES = (5, 6, 7, 8)
BYTES_AT_ONCE = 1 << 20
POSITIVES = 3_000
UNLABELLED = 9_000
CLASSIFIERS = 3
NGRAMS_KEPT = 2_048
# A kept n-gram is that many times as frequent in toxic text, with that log-likelihood ratio.
LIFT, EVIDENCE = 3.0, 12.0
# The prior is read off numbers of n-grams that at least this share of toxic text reaches.
TOLD_SHARE, PRIOR_TAKEN = 0.3, 0.9
# An n-gram's amount in a text: occurrences per so many words, short texts counted as longer.
PER_WORDS, SHORT_WORDS = 200, 50
# Where words are longer than so many bytes on average, a text's length is its bytes divided by that.
LONG_WORD = 12
# An n-gram across words has so many bytes at least that are no space.
LEAST_LETTERS = 3
STEPS = 300
STEP_SIZE = 0.05
DECAY = 1e-4
THRESHOLD = 0.3
SEED = 7
# Bytes that are ASCII signs.
SIGN = np.array([b < 128 and b != 32 and not chr(b).isalnum() for b in range(256)])
# An odd multiplier for each n-gram length; the upper bits of the product are the bucket.
MULTIPLIERS = {n: np.uint64(0x9E3779B97F4A7C15 + 2 * n) for n in NGRAM_BYTES}


def ngram_buckets(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of each length at every byte position of all words of the lower-cased text, with a space
    on both sides, piece by piece; words too short for one are read on into the next words. An n-gram with ASCII signs
    in it also counts as it is with spaces for these, so that a word behind a bracket is the word behind a space."""
    words = " ".join((text or "").lower().split())
    data = np.frombuffer(f" {words} ".encode("utf-8", "surrogatepass"), dtype=np.uint8)
    for low in range(0, len(data), BYTES_AT_ONCE):
        plain = data[low : low + BYTES_AT_ONCE + NGRAM_BYTES[-1] - 1]  # starts in the first BYTES_AT_ONCE
        spaced = np.where(SIGN[plain], np.uint8(32), plain)
        signs = np.concatenate([[0], np.cumsum(SIGN[plain])])
        for piece in (plain, spaced):
            space = piece == 32
            spaces = np.concatenate([[0], np.cumsum(space)])
            before_short = np.zeros(len(piece), dtype=bool)
            before_short[:-2] = space[:-2] & ~space[1:-1] & space[2:]
            before_short[:-3] |= space[:-3] & ~space[1:-2] & ~space[2:-1] & space[3:]
            wide = piece.astype(np.uint64)
            packed, held = np.zeros(len(piece), dtype=np.uint64), 0
            for n in NGRAM_BYTES:
                starts = min(len(piece) - n + 1, BYTES_AT_ONCE)
                if starts <= 0:
                    break
                packed = packed[: len(piece) - n + 1].copy()
                for i in range(held, n):
                    packed |= wide[i : i + len(packed)] << np.uint64(8 * i)
                held = n
                taken = spaces[n - 1 : n - 1 + starts] == spaces[1 : 1 + starts]  # no space within
                taken |= before_short[:starts] & (spaces[n : n + starts] - spaces[:starts] <= n - LEAST_LETTERS)
                if piece is spaced:
                    taken &= signs[n : n + starts] > signs[:starts]
                yield ((packed[:starts][taken] * MULTIPLIERS[n]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def length_of(text: str | None) -> int:
    """The length of a text in words; one without white space counts by its bytes."""
    text = text or ""
    return max(len(text.split()), len(text.encode("utf-8", "surrogatepass")) // LONG_WORD)


def values(buckets: list[np.ndarray], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Different buckets and how often they occur for the length of the text, on a logarithmic scale."""
    found, counts = np.unique(np.concatenate(buckets), return_counts=True)
    return found, np.log1p(counts * (PER_WORDS / (words + SHORT_WORDS))).astype(np.float32)


def different_buckets(text: str | None) -> np.ndarray:
    return np.unique(np.concatenate([np.empty(0, dtype=np.int32), *ngram_buckets(text)]))


def kept_values(text: str | None, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the buckets marked in `known`."""
    parts = [np.empty(0, dtype=np.int32), *(part[known[part]] for part in ngram_buckets(text))]
    return values(parts, length_of(text))


def train_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier with the logistic loss, by Adam on the whole sample."""
    weights = np.zeros(positive.shape[1] + 1)
    weights[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, STEPS + 1):
        at_p = positive @ weights[:-1].astype(np.float32) + weights[-1]
        at_u = unlabelled @ weights[:-1].astype(np.float32) + weights[-1]
        clean_risk = np.logaddexp(0, at_u).mean() - prior * np.logaddexp(0, at_p).mean()
        as_negative_p, as_negative_u = sigmoid(at_p) / len(at_p), sigmoid(at_u) / len(at_u)
        if clean_risk >= 0:
            on_p, on_u = -prior * sigmoid(-at_p) / len(at_p) - prior * as_negative_p, as_negative_u
        else:  # step back from where the estimated clean risk has been overfitted below zero
            on_p, on_u = prior * as_negative_p, -as_negative_u
        on_p, on_u = on_p.astype(np.float32), on_u.astype(np.float32)
        slope = np.append(on_p @ positive + on_u @ unlabelled, on_p.sum() + on_u.sum())
        slope[:-1] += DECAY * weights[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        weights -= STEP_SIZE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights[:-1], float(weights[-1])


def telling_ngrams(in_p: np.ndarray, in_u: np.ndarray, n_p: int, n_u: int, prior: float) -> np.ndarray:
    """Buckets with the most evidence for toxic text, by document counts corrected for the prior."""
    rate_p, rate_u = (in_p / (n_p + 1)).clip(0, 1), in_u / n_u
    rate_clean = (np.maximum(rate_u - prior * rate_p, 0) / (1 - prior) + 1 / n_u).clip(0, 1 - 1e-9)
    told = np.flatnonzero((in_p >= 2) & (rate_p > LIFT * rate_clean))
    p, clean = rate_p[told], rate_clean[told]
    evidence = n_p * (p * np.log(p / clean) + (1 - p) * np.log((1 - p) / (1 - clean)))
    best = np.argsort(-evidence, kind="stable")[:NGRAMS_KEPT]
    return np.sort(told[best[evidence[best] > EVIDENCE]])


def prior_in(held_p: np.ndarray, held_u: np.ndarray, prior: float) -> float:
    """The class prior of the unlabelled sample itself, from the kept n-grams per document.

    At every number of n-grams, the share of unlabelled documents with as many is at least the prior times
    that share of toxic ones. The smallest quotient bounds the prior from above, and a little less is taken:
    with a prior too high, the estimate of the clean risk turns negative and stops the training early.
    """
    bound = prior
    for least in range(1, int(held_p.max(initial=0)) + 1):
        share = (held_p >= least).mean()
        if share < TOLD_SHARE:
            break
        bound = min(bound, (held_u >= least).mean() / share)
    return max(PRIOR_TAKEN * bound, 1e-4)


def train_share(rows: pd.DataFrame, prior: float) -> pd.DataFrame:
    """One classifier from the rows (toxic, text) of its share."""
    texts = {role: rows.loc[rows["toxic"] == role, "text"] for role in (1, 0)}
    empty = pd.DataFrame({"bucket": [[]], "weight": [[]], "bias": [float(np.log(prior / (1 - prior)))]})
    if texts[1].empty or texts[0].empty:
        return empty
    counts = {role: np.zeros(1 << BUCKET_BITS, dtype=np.int32) for role in texts}
    for role, found in texts.items():
        for text in found:
            counts[role][different_buckets(text)] += 1
    kept = telling_ngrams(counts[1], counts[0], len(texts[1]), len(texts[0]), prior)
    known = np.zeros(1 << BUCKET_BITS, dtype=bool)
    known[kept] = True

    def matrix(texts: Iterable[str]) -> np.ndarray:
        # the n-grams are read again, as those of all texts would not fit
        read = [kept_values(text, known) for text in texts]
        held = np.zeros((len(read), len(kept)), dtype=np.float32)
        for row, (buckets, amounts) in zip(held, read, strict=True):
            row[np.searchsorted(kept, buckets)] = amounts
        return held

    as_is = [matrix(texts[role]) for role in (1, 0)]
    here = prior_in((as_is[0] > 0).sum(axis=1), (as_is[1] > 0).sum(axis=1), prior)
    # without white space as well, so that n-grams inside words get weight of their own
    joined = [matrix("".join(text.split()) for text in texts[role]) for role in (1, 0)]
    weights, bias = train_nnpu(*map(np.vstack, zip(as_is, joined, strict=True)), here)
    return pd.DataFrame({"bucket": [kept.tolist()], "weight": [weights.tolist()], "bias": [bias]})


@dataclass(frozen=True)
class Classifier:
    """The average of several linear classifiers over buckets."""

    weight_of: dict[int, float]
    bias: float

    def scores(self, text: Column) -> Column:
        buckets = np.fromiter(self.weight_of.keys(), dtype=np.int64)
        weights = np.fromiter(self.weight_of.values(), dtype=np.float64)
        bias = self.bias

        @F.pandas_udf("double")
        def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            table = np.zeros(1 << BUCKET_BITS)
            table[buckets] = weights
            known = np.zeros(1 << BUCKET_BITS, dtype=bool)
            known[buckets] = True

            def logit(text: str | None) -> float:
                buckets, amounts = kept_values(text, known)
                return bias + float(table[buckets] @ amounts)

            for texts in batches:
                logits = np.array([logit(t) for t in texts], dtype=np.float64)
                yield pd.Series(1 / (1 + np.exp(-np.clip(logits, -30, 30))))

        return compute(text)


def class_prior(labels: DataFrame) -> float:
    """The share of toxic documents among all labels that may be learnt from, kept inside (0, 1)."""
    share = labels.where(~held_out(F.col("doc_id"))).agg(F.avg("toxic")).first()[0]
    return min(max(share or 0.0, 1e-4), 1 - 1e-4)


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(share, toxic, text): bounded samples of confirmed toxic documents, in every share, and of unlabelled
    ones, each in one; by hash of the id."""

    def drawn(ids: DataFrame, toxic: int, bound: int) -> DataFrame:
        usable = ids.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
        spread = F.xxhash64("doc_id", F.lit(SEED + toxic))
        return usable.orderBy(spread, "doc_id").limit(bound).withColumn("toxic", F.lit(toxic))

    confirmed = labels.where("toxic = 1").select("doc_id")
    sample = drawn(confirmed, 1, POSITIVES).union(drawn(docs.select("doc_id"), 0, UNLABELLED))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # the sample holds POSITIVES + UNLABELLED identifiers at most
    joined = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    every = F.array(*[F.lit(i).cast("long") for i in range(CLASSIFIERS)])
    own = F.array(F.pmod(F.xxhash64("doc_id"), F.lit(CLASSIFIERS)))
    share = F.explode(F.when(F.col("toxic") == 1, every).otherwise(own)).alias("share")
    return joined.select(share, "toxic", "text")


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Train on documents (doc_id, text) and labels (doc_id, toxic)."""
    prior = class_prior(labels)
    trained = (
        training_sample(docs, labels)
        .groupBy("share")
        .applyInPandas(
            lambda rows: train_share(rows, prior), "bucket array<int>, weight array<double>, bias double"
        )
        .collect()  # CLASSIFIERS rows of NGRAMS_KEPT entries at most
    )
    weight_of: dict[int, float] = {}
    for row in trained:
        for bucket, weight in zip(row["bucket"], row["weight"], strict=True):
            weight_of[bucket] = weight_of.get(bucket, 0.0) + weight / len(trained)
    biases = [row["bias"] for row in trained] or [float(np.log(prior / (1 - prior)))]
    return Classifier(weight_of, sum(biases) / len(biases))


def score_documents(docs: DataFrame, model: Classifier) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.scores(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, model: Classifier) -> DataFrame:
    """The rows of `docs` that are not predicted toxic."""
    return docs.where(model.scores(F.col("text")) < THRESHOLD)


def query(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score_documents(docs, fit(docs, read_table(spark, sf_dir, "labels")))

"""Supervised subword embeddings: hashed word and character n-gram vectors, averaged, under a softmax.

A document is the average of learned vectors, one for each of its words and character n-grams (hashed to a
fixed number of rows), plus one for a word that repeats its neighbour. A linear layer and a softmax over the
averages give the probability of label 1. Vectors and layer are trained together by stochastic gradient
descent in numpy on a bounded sample of labelled documents (``MAX_PER_LABEL`` ids of each label, the least
by a hash of the id). Whole texts are learned from, and every document is scored over its whole text.

Tasks turn the sample's texts into features, and one task learns from these; the driver gets the trained weights, 4 bytes a row. A document
has at most ``BUCKETS`` distinct features of 6 bytes each, so the sample is bounded whatever the length of its texts.

After training, only the difference of the two outputs matters, so each row's vector is multiplied out once
and scoring adds up one number per feature.

Cases: a null or empty text has no features and gets the trained bias alone; with labels of one kind only
every score is that label, and without labels 0.5; contradictory labels of one id count as their
least; of rows that share an id one is learned from, the least by a hash of its text; repeated rows give repeated rows; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtrail.llm.common import SPACES, small_batches

BUCKETS = 1 << 16
DIMENSION = 8
CHARACTER_N = (3, 4)
MAX_PER_LABEL = 3000
#: Score of every text where there is no label to learn from.
UNKNOWN = 0.5
UPDATES = 20_000
MIN_EPOCHS = 4
RATE = 3.0
SEED = 17
#: Code points turned into features in one step; a longer text is cut at white space (or here, if a word is longer).
STEP = 1 << 18

_BASE = 0x100000001B3  # fixed odd base of the word hash
_NEIGHBOUR = np.array([1], np.uint64)  # stands for "same word as before"


def _powers(base: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for every place of a step."""
    out = np.ones(1, np.uint64)
    with np.errstate(over="ignore"):
        while len(out) <= STEP:
            out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out


class Features:
    """Turns texts into row numbers of the embedding table."""

    def __init__(self, buckets: int = BUCKETS):
        self.shift = np.uint64(64 - (buckets.bit_length() - 1))
        self.powers, self.inverses = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))
        self.spaces = np.array([ord(c) for c in SPACES], np.uint32)

    def _rows(self, hashes: np.ndarray, kind: int) -> np.ndarray:
        mixed = (hashes + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        return (mixed * np.uint64(0xBF58476D1CE4E5B9)) >> self.shift

    def parts(self, points: np.ndarray) -> Iterator[np.ndarray]:
        start = 0
        while start < len(points):
            stop = start + STEP
            if stop < len(points):
                gaps = np.flatnonzero(np.isin(points[start:stop], self.spaces))
                stop = start + int(gaps[-1]) + 1 if len(gaps) else stop
            yield points[start:stop]
            start = stop

    def rows(self, text: str) -> Iterator[np.ndarray]:
        """Row numbers of all features of a whole text, with repeats, a step at a time."""
        for part in self.parts(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)):
            wide = part.astype(np.uint64)
            space = (part == 32) | ((part >= 9) & (part <= 13))
            edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
            starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
            if not len(starts):
                continue
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((wide + np.uint64(1)) * self.powers[:len(wide)], dtype=np.uint64)])
            words = (sums[ends] - sums[starts]) * self.inverses[starts]
            yield self._rows(words, 0)
            same = int((words[1:] == words[:-1]).sum())
            yield np.repeat(self._rows(_NEIGHBOUR, 1), same)
            for n in CHARACTER_N:
                size = len(wide) - n + 1
                if size > 0:
                    grams = wide[:size].copy()
                    for k in range(1, n):
                        grams = (grams << np.uint64(16)) + wide[k:size + k]
                    yield self._rows(grams, n)


def counted(text: str, features: Features) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of a text and the share of each among its features."""
    found = list(features.rows(text))
    rows, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    return rows.astype(np.int64), (counts / max(1, counts.sum())).astype(np.float32)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], buckets: int = BUCKETS, seed: int = SEED) -> tuple[np.ndarray, float] | float:
    """The weight of each row for label 1 against label 0, and the bias; where all labels are one, the score of every text (0.5 without labels).

    ``rows``: of each document, its distinct rows and their shares.
    """
    if len(set(labels)) < 2:
        return float(labels[0]) if labels else UNKNOWN
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / DIMENSION, 1 / DIMENSION, (buckets, DIMENSION)).astype(np.float32)
    layer, bias = np.zeros((DIMENSION, 2), np.float32), np.zeros(2, np.float32)
    wanted = np.eye(2, dtype=np.float32)[labels]
    updates = max(UPDATES, MIN_EPOCHS * len(rows))
    done = 0
    while done < updates:
        for i in random.permutation(len(rows)):
            rate = np.float32(RATE * max(0.02, 1 - done / updates))
            index, share = rows[i]
            average = share @ vectors[index]
            logits = average @ layer + bias
            exponents = np.exp(logits - logits.max())
            error = exponents / exponents.sum() - wanted[i]
            back = layer @ error
            layer -= rate * np.outer(average, error)
            bias -= np.float32(0.01) * rate * error
            vectors[index] -= (rate * share)[:, None] * back
            done += 1
    outputs = vectors @ layer
    return (outputs[:, 1] - outputs[:, 0]).astype(np.float32), float(bias[1] - bias[0])


def score(text: str, model: tuple[np.ndarray, float] | float, features: Features) -> float:
    """Softmax probability of label 1 for a whole text."""
    if isinstance(model, float):
        return model
    total, n = 0.0, 0
    for rows in features.rows(text):
        total += float(model[0][rows].sum(dtype=np.float64))
        n += len(rows)
    return float(1 / (1 + np.exp(-np.clip(model[1] + (total / n if n else 0.0), -60, 60))))


def training_sample(documents: DataFrame, labels: DataFrame, usable: Column) -> DataFrame:
    """Whole texts and labels to learn from, one row an id: at most ``MAX_PER_LABEL`` ids of each label, chosen by a hash of the id."""
    known = labels.filter(usable & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [known.filter(F.col("quality") == label).orderBy(*order).limit(MAX_PER_LABEL) for label in (0, 1)]
    ids = chosen[0].unionByName(chosen[1])
    # The ids are few by construction, so they go to every task; of the documents only the sample moves, one text an id and task.
    found = documents.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64("text").alias("tie"), "text")).alias("least"))
    return found.select("doc_id", "least.text", "quality")


def sample_features(sample: DataFrame) -> DataFrame:
    """(doc_id, quality, rows, shares): the distinct rows of each text as unsigned 16-bit numbers and their shares as floats."""
    small_batches(sample.sparkSession)

    @F.pandas_udf("rows binary, shares binary")
    def featured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        features = Features()
        for texts in batches:
            found = [counted(text or "", features) for text in texts]
            yield pd.DataFrame([(rows.astype("<u2").tobytes(), shares.astype("<f4").tobytes()) for rows, shares in found], columns=["rows", "shares"])

    return sample.select("doc_id", "quality", featured("text").alias("found")).select("doc_id", "quality", "found.*")


def learned(sample: DataFrame):
    """``fit`` on the bounded sample, in one task; the driver gets the weights only."""

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = [row for batch in batches for row in zip(batch["quality"], batch["rows"], batch["shares"], strict=True)]
        model = fit([(np.frombuffer(rows, "<u2"), np.frombuffer(shares, "<f4")) for _, rows, shares in found], [int(quality) for quality, *_ in found])
        weights, bias = (None, model) if isinstance(model, float) else (model[0].astype("<f4").tobytes(), model[1])
        yield pd.DataFrame({"weights": [weights], "bias": [bias]})

    model = sample.repartition(1).sortWithinPartitions("doc_id").mapInPandas(fitted, "weights binary, bias double").first()
    if model is None:
        return fit([], [])
    return model["bias"] if model["weights"] is None else (np.frombuffer(model["weights"], "<f4"), model["bias"])


def train(documents: DataFrame, labels: DataFrame, usable: Column):
    """Fit on the bounded sample; the order of learning is by id, so reruns agree."""
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return learned(sample_features(training_sample(texts, labels, usable)))


def score_column(spark: SparkSession, text: Column, model) -> Column:
    """Score of each whole text; the model's size is fixed by ``BUCKETS``."""
    small_batches(spark)
    shipped = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features, known = Features(), shipped.value
        for texts in batches:
            yield pd.Series([score(t or "", known, features) for t in texts], index=texts.index, dtype=float)

    return scored(text)

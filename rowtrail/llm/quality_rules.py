"""Rules on whole texts: plain counts, then a hashed n-gram log-likelihood ratio against the raw corpus.

Two multinomials over hashed character n-grams are counted: one over trusted documents, one over every
document. A text's score is the mean log ratio of their probabilities over its n-grams, and every document is
decided by one fixed threshold: no random draw, so equal texts have equal verdicts.

Cases: a null text has no words and fails the base rules; a text too short for an n-gram scores 0; with no
trusted document at all the ratio is 0 everywhere; repeated rows count as often as they occur; other
columns play no part. Hot sources do not matter, as nothing is grouped by document or source: each
task adds up its own fixed table of counts before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtrail.llm.common import SPACES, small_batches

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
N = 3
BUCKETS = 1 << 15
#: Added to every bucket of both tables, so that no probability is 0.
PRIOR = 1.0
#: Mean log ratio below which a text is unlike the trusted ones.
THRESHOLD = -0.4
#: Code points looked at in one step, so that a very long text needs no more memory than this.
STEP = 1 << 20

_SPACE = np.zeros(128, bool)
_SPACE[[ord(c) for c in SPACES]] = True
#: Fixed odd multipliers of the n-gram hash.
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_buckets(text: str, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Hashed n-grams of a whole text, a step at a time; steps overlap so that none is lost or doubled."""
    points = code_points(text)
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    for start in range(0, len(points) - N + 1, STEP):
        part = points[start:start + STEP + N - 1]
        size = len(part) - N + 1
        mixed = part[:size] * _FACTORS[0]
        for k in range(1, N):
            mixed = (mixed ^ mixed >> np.uint32(15)) + part[k:size + k] * _FACTORS[k]
        mixed ^= mixed >> np.uint32(13)
        yield (mixed * np.uint32(0x27D4EB2F)) >> shift


def gram_counts(documents: DataFrame, trusted: Column, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Counts per bucket over the trusted documents and over all: whole texts, every document.

    A task gives one row per bucket at most, so shuffle and result are bounded by the number of buckets.
    """
    small_batches(documents.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, buckets), np.int64)
        for batch in batches:
            for text, is_trusted in zip(batch["text"], batch["trusted"], strict=True):
                for found in gram_buckets(text or "", buckets):
                    counted = np.bincount(found, minlength=buckets)
                    sums[1] += counted
                    if is_trusted:
                        sums[0] += counted
        filled = np.flatnonzero(sums[1])
        yield pd.DataFrame({"bucket": filled.astype("int32"), "target": sums[0, filled], "raw": sums[1, filled]})

    pairs = documents.select("text", F.coalesce(trusted, F.lit(False)).alias("trusted"))
    rows = (
        pairs.mapInPandas(count, "bucket int, target long, raw long")
        .groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).collect())
    target, raw = np.zeros(buckets), np.zeros(buckets)
    for row in rows:
        target[row["bucket"]], raw[row["bucket"]] = row["target"], row["raw"]
    return target, raw


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log of trusted against raw probability for each bucket; zeros where nothing is trusted."""
    if not target.sum():
        return np.zeros(len(raw), np.float32)
    a, b = target + PRIOR, raw + PRIOR
    return (np.log(a / a.sum()) - np.log(b / b.sum())).astype(np.float32)


def ratio_score(text: str, ratios: np.ndarray) -> float:
    total, n = 0.0, 0
    for found in gram_buckets(text, len(ratios)):
        total += float(ratios[found].sum(dtype=np.float64))
        n += len(found)
    return total / n if n else 0.0


def repeated_positions(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words occurring twice or more in the list.

    Windows are compared exactly: the numbers of two neighbouring windows name the window of double width.
    """
    n = len(words)
    if n <= window:
        return 0
    seen: dict[bytes, int] = {}
    names = np.fromiter((seen.setdefault(word, len(seen)) for word in words), np.int64, n)
    width = 1
    while width < window:
        names = np.unique(names[:-width] * (n + 1) + names[width:], return_inverse=True)[1]
        width *= 2
    twice = np.bincount(names)[names] > 1
    if not twice.any():
        return 0
    starts = np.flatnonzero(twice)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return int((np.cumsum(change[:n]) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at exactly the six separators of WORD
    characters = len(text) - sum(map(text.count, SPACES))
    earlier: set[str] = set()
    doubled = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            doubled += line in earlier
            earlier.add(line)
    return len(words), characters, sum(map(text.count, SYMBOLS)), doubled, repeated_positions(words)


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEATED_PERCENT * n_words


def judge(spark: SparkSession, documents: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """The counts, the score and the verdict of every document."""
    small_batches(spark)
    shipped = spark.sparkContext.broadcast(ratios)

    @F.pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double")
    def verdict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"]
        table = shipped.value
        for texts in batches:
            rows = []
            for text in texts:
                counts = base_counts(text or "")
                failed, score = base_failed(counts[0], counts[4]), ratio_score(text or "", table)
                rows.append((*counts, failed, not failed and score >= threshold, score))
            yield pd.DataFrame(rows, columns=names)

    return documents.select("doc_id", verdict("text").alias("found")).select("doc_id", "found.*")

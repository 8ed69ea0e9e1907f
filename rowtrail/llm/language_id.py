"""Language by compression: the language whose dictionary compresses a text best.

For each language a raw-content zstandard dictionary is cut from a bounded sample of its labelled texts
(``SLOTS`` texts, the one of least hash in each of that many hash slots, ``EXCERPT`` characters of each, the same
size for every language as far as its texts reach). A text is lower-cased, ASCII signs and digits become
spaces, and it is compressed whole, in blocks, once with each dictionary. Fewest bytes win. Blocks keep the
dictionary within reach of all parts of a long text. A text whose best two languages lie within
``MARGIN`` of each other is rejected: ``lang`` is then ``und``, while ``best`` still names the nearest.

Cases: a null text or one without a letter is ``und`` with score 0; with no labelled text at all everything is
``und``; equal sizes go to the language with more learned texts, then to the first by code point; repeated rows give repeated rows; other
columns play no part. The number of languages is that of the labels, and each adds one dictionary of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtrail.llm.common import small_batches

SLOTS = 64
EXCERPT = 400
BLOCK = 4096
#: Matches of four bytes and more, looked for along short chains; the window holds the dictionary and a block.
MATCHING = {"strategy": zstandard.STRATEGY_LAZY, "min_match": 4, "window_log": 17, "hash_log": 15, "chain_log": 15, "search_log": 3}
#: Relative difference of the two smallest sizes below which a text is rejected.
MARGIN = 0.01
#: How sharply the score answers to differences in size: weights fall by this power of the relative size.
SHARPNESS = 40.0
UNDECIDED = "und"

_BLANK = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def letters(text: str) -> bytes:
    """A whole text in lower case, ASCII signs and digits taken out, words parted by one space; empty if it has no letter."""
    content = b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_BLANK).split())
    return content if any(map(str.isalpha, text)) else b""


def training_sample(documents: DataFrame, usable: Column) -> DataFrame:
    """Of each language, at most ``SLOTS`` texts: (lang, text).

    Only hashes are grouped, and combined before the shuffle; the chosen few are then looked up by a broadcast of
    at most ``SLOTS`` rows a language.
    """
    known = documents.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0)).select("lang", "text", F.xxhash64("text").alias("hash"))
    chosen = known.groupBy("lang", F.pmod("hash", F.lit(SLOTS)).alias("slot")).agg(F.min("hash").alias("hash")).select("lang", "hash")
    spot = F.pmod("hash", F.greatest(F.lit(1), F.length("text") - EXCERPT + 1)).cast("int") + 1
    return known.join(F.broadcast(chosen), ["lang", "hash"]).select("lang", "hash", F.substring("text", spot, F.lit(EXCERPT)).alias("text")).distinct()


def dictionaries(documents: DataFrame, usable: Column) -> list[tuple[str, bytes]]:
    """Each language with its dictionary, the one with most usable texts first, then by code point."""
    pieces: dict[str, list[bytes]] = {}
    for row in sorted(training_sample(documents, usable).collect()):
        pieces.setdefault(row["lang"], []).append(letters(row["text"]))
    texts = {row["lang"]: row["count"] for row in documents.filter(usable).groupBy("lang").count().collect()}
    return [(lang, b" ".join(pieces[lang])) for lang in sorted(pieces, key=lambda lang: (-texts[lang], lang))]


class Identifier:
    """The compressors of one worker."""

    def __init__(self, known: list[tuple[str, bytes]], margin: float = MARGIN):
        self.languages = [lang for lang, _ in known]
        self.margin = margin
        self.compressors = []
        settings = zstandard.ZstdCompressionParameters(write_content_size=False, write_dict_id=False, **MATCHING)
        for _, content in known:
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(compression_params=settings)
            self.compressors.append(zstandard.ZstdCompressor(compression_params=settings, dict_data=dictionary).compress)

    def sizes(self, content: bytes) -> list[int]:
        blocks = [content[i:i + BLOCK] for i in range(0, len(content), BLOCK)]
        return [sum(len(compress(block)) for block in blocks) for compress in self.compressors]

    def identify(self, text: str | None) -> tuple[str, float, str, float]:
        """lang (``und`` if rejected), score, best, margin."""
        content = letters(text or "")
        if not content or not self.languages:
            return UNDECIDED, 0.0, UNDECIDED, 0.0
        sizes = np.array(self.sizes(content), float)
        first = int(sizes.argmin())
        rest = np.delete(sizes, first)
        margin = float((rest.min() - sizes[first]) / sizes[first]) if len(rest) else 1.0
        weights = np.exp(-SHARPNESS * (sizes / sizes[first] - 1))
        best = self.languages[first]
        return best if margin >= self.margin else UNDECIDED, float(1 / weights.sum()), best, margin


def identify_column(spark: SparkSession, text: Column, known: list[tuple[str, bytes]]) -> Column:
    """Struct of lang, score, best and margin for each whole text."""
    small_batches(spark)
    shipped = spark.sparkContext.broadcast(known)

    @F.pandas_udf("lang string, score double, best string, margin double")
    def identified(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        identifier = Identifier(shipped.value)
        for texts in batches:
            yield pd.DataFrame([identifier.identify(text) for text in texts], columns=["lang", "score", "best", "margin"])

    return identified(text)

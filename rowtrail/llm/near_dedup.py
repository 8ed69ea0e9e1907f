"""MinHash near-duplicates: universal hash minima, banding, verification, components by alternating stars.

1. Documents with the same words in the same order form a class, led by its least id. Only classes go on, so copies
   cost nothing, however many there are.
2. Each class gets the minima of ``BANDS * ROWS`` universal hash functions over its shingles, and one key per band. Two sets of
   similarity 0.8 miss each other in every band with a chance of (1 - 0.8^5)^40, about one in ten million.
3. In each bucket of classes with one key, all are compared with one member only, the one that meets most others in its
   buckets (copies lie nearer to what they were copied from than to each other): as many pairs as members. Pairs whose
   signatures agree far less than the threshold (five standard errors) go no further; the others are confirmed on full sets of
   shingles.
4. Components of these links. A bucket within one component is settled. In any other, members of different components
   may still be linked. Those outside the largest component are compared with the other members in blocks of
   ``BLOCK`` rows: a task gets two blocks with signatures and full sets, and gives only links. No list of pairs is made.
5. Components of all links by alternating large-star and small-star.

Skew: groupings combine before the shuffle; joins on bucket keys leave hot keys to the skew join of adaptive
execution; sets of shingles of hot leaders are laid out in as many copies as their pairs need and pairs are salted over them.
Nothing is collected but counts.

Cases: a null text or one without words has the empty set and is linked with nothing; with fewer words than a
shingle the whole sequence is one shingle; a row with a null id gets a null component and is kept; rows that share an id are one node;
extra columns pass through ``keep_first`` and play no part. There each distinct pair of id and text is a node of its own, null ids too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtrail.llm.common import free_name, held, small_batches, small_or_shuffled
from rowtrail.llm.line_dedup import document_key

BANDS, ROWS = 40, 5
#: Signatures that agree in less than this share differ from 0.8 by five standard errors of 200 minima.
SLACK = 0.14
#: Pairs that share one copy of a leader's shingles.
SALT_PAIRS = 500
#: Members in a block of step 4.
BLOCK = 256
MAX_ROUNDS = 60
SEED = 11
#: Shingles hashed in one step, so that a very long text needs no more memory than this.
STEP = 4096

_UPPER_TO_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def word_list(text: str) -> list[bytes]:
    """Words in order, A-Z in lower case; bytes split at exactly the separators of the contract."""
    return text.encode("utf-8", "surrogatepass").translate(_UPPER_TO_LOWER).split()


def shingles(words: list[bytes], width: int) -> np.ndarray:
    """Distinct 64-bit hashes of the runs of ``width`` words, or of the whole sequence if it is shorter; sorted."""
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = max(1, len(words) - width + 1)
    mixed = np.full(size, np.uint64(min(width, len(words))))
    for k in range(min(width, len(words))):
        mixed = (mixed ^ hashes[k:size + k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def universal(n: int = BANDS * ROWS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of the hash functions (a * x + b) mod 2^32."""
    random = np.random.default_rng(seed)
    return random.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), random.integers(0, 1 << 32, n, dtype=np.uint32)


def minima(found: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of each function over a set."""
    least = np.full(len(a), 0xFFFFFFFF, np.uint32)
    short = ((found ^ found >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(short), STEP // 8):
        np.minimum(least, (short[start:start + STEP // 8, None] * a + b).min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray, rows: int = ROWS) -> list[int]:
    """One 64-bit key for each band of ``rows`` minima; the band's number is part of it."""
    return [xxhash.xxh3_64_intdigest(band.tobytes(), number) - (1 << 63) for number, band in enumerate(least.reshape(-1, rows))]


def described(documents: DataFrame, width: int) -> DataFrame:
    """(doc_id, class_key, n_shingles, signature, bands) of every document; the key is null where there is no word.

    The signature keeps the low byte of each minimum: enough to tell likely pairs, at a quarter of the size.
    """
    small_batches(documents.sparkSession)

    @F.pandas_udf("class_key string, n_shingles long, signature binary, bands array<long>")
    def describe(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        a, b = universal()
        for texts in batches:
            rows = []
            for text in texts:
                words = word_list(text or "")
                if not words:
                    rows.append((None, 0, None, None))
                    continue
                found = shingles(words, width)
                least = minima(found, a, b)
                rows.append((xxhash.xxh3_128_hexdigest(b" ".join(words)), len(found), least.astype(np.uint8).tobytes(), band_keys(least)))
            yield pd.DataFrame(rows, columns=["class_key", "n_shingles", "signature", "bands"])

    return held(documents.select("doc_id", describe("text").alias("found")).select("doc_id", "found.*"), "minhash")


def likely(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose signatures agree nearly as often as those of sets at the threshold."""

    @F.pandas_udf("double")
    def agreement(one: pd.Series, other: pd.Series) -> pd.Series:
        return pd.Series([float(np.mean(np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8))) for a, b in zip(one, other, strict=True)], dtype=float)

    one = classes.select(F.col("doc_id").alias("a"), F.col("signature").alias("signature_a"))
    other = classes.select(F.col("doc_id").alias("b"), F.col("signature").alias("signature_b"))
    return pairs.join(other, "b").join(one, "a").filter(agreement("signature_a", "signature_b") >= threshold - SLACK).select("a", "b")


def full_sets(documents: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(doc_id, found): all shingles of the documents with the given ids."""
    small_batches(documents.sparkSession)

    @F.pandas_udf("binary")
    def full_set(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(word_list(text or ""), width).tobytes() for text in texts], index=texts.index, dtype=object)

    needed = held(ids.select("doc_id").distinct(), "needed")
    return held(documents.join(small_or_shuffled(needed), "doc_id").select("doc_id", full_set("text").alias("found")), "shingles")


def similar(one: bytes, other: bytes, percent: int) -> bool:
    x, y = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
    if percent * max(len(x), len(y)) > 100 * min(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def confirmed(pairs: DataFrame, documents: DataFrame, width: int, percent: int) -> DataFrame:
    """Of distinct pairs (a, b), those with 100 * intersection >= percent * union on full sets of shingles."""

    @F.pandas_udf("boolean")
    def linked(one: pd.Series, other: pd.Series) -> pd.Series:
        return pd.Series([similar(a, b, percent) for a, b in zip(one, other, strict=True)], dtype=bool)

    # Only texts that stand in a pair are turned into sets; hot leaders are laid out once for every so many pairs.
    fans = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / SALT_PAIRS).cast("int").alias("fan"))
    sets = full_sets(documents, pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))), width)
    salted = pairs.join(fans, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("fan")).cast("int")).select("a", "b", "salt")
    leaders = sets.select(F.col("doc_id").alias("a"), F.col("found").alias("found_a")).join(fans, "a").select("a", "found_a", F.explode(F.sequence(F.lit(0), F.col("fan") - 1)).alias("salt"))
    others = sets.select(F.col("doc_id").alias("b"), F.col("found").alias("found_b"))
    return salted.join(leaders, ["a", "salt"]).select("a", "b", "found_a").join(others, "b").filter(linked("found_a", "found_b")).select("a", "b").distinct()


def links_across(members: DataFrame, classes: DataFrame, documents: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between components of one group; members: (middle, doc_id, component), one row each.

    Members outside the group's largest component (``x``) meet all members of other components (``y``), block by block.
    """
    parts = members.groupBy("middle", "component").agg(F.count(F.lit(1)).alias("n"))
    groups = parts.groupBy("middle").agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("most")).filter("n > most.n").select(
        "middle", F.col("most.component").alias("largest"), F.ceil(F.col("n") / BLOCK).cast("int").alias("y_blocks"), F.ceil((F.col("n") - F.col("most.n")) / BLOCK).cast("int").alias("x_blocks"))
    grouped = held(members.join(groups, "middle"), "groups")
    sets = full_sets(documents, grouped.select("doc_id"), width).join(classes.select("doc_id", "signature"), "doc_id")
    place = F.xxhash64("doc_id")
    outside = F.col("component") != F.col("largest")
    x_side = grouped.filter(outside).withColumn("x_block", F.pmod(place, F.col("x_blocks"))).withColumn("y_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("y_blocks") - 1))).withColumn("is_x", F.lit(True))
    y_side = grouped.withColumn("y_block", F.pmod(place, F.col("y_blocks"))).withColumn("x_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("x_blocks") - 1))).withColumn("is_x", F.lit(False))
    dealt = x_side.unionByName(y_side).select("middle", "x_block", "y_block", "is_x", "doc_id", "component", outside.alias("outside"))
    least = percent / 100 - SLACK

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        x, y = rows[rows["is_x"]], rows[~rows["is_x"]]
        ids, parts, outer, sets_y = y["doc_id"].to_numpy(), y["component"].to_numpy(), y["outside"].to_numpy(), y["found"].to_numpy()
        signatures = np.frombuffer(b"".join(y["signature"]), np.uint8).reshape(len(y), -1)
        links = []
        for doc_id, component, found, signature in zip(x["doc_id"], x["component"], x["found"], x["signature"], strict=True):
            # Two outside members meet twice; the pair is judged once.
            open_ = np.flatnonzero((parts != component) & ~(outer & (ids < doc_id)))
            agreement = (signatures[open_] == np.frombuffer(signature, np.uint8)).mean(axis=1)
            links += [(min(doc_id, ids[k]), max(doc_id, ids[k])) for k in open_[agreement >= least] if similar(found, sets_y[k], percent)]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return dealt.join(sets, "doc_id").groupBy("middle", "x_block", "y_block").applyInPandas(compare, "a long, b long").distinct()


def are_stars(edges: DataFrame) -> bool:
    """Whether every node of distinct edges (u, v), v < u, either hangs on one node only, with nothing on it, or hangs on none: then v is the least node reachable."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("hangs")))
    nodes = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.count(F.lit(1)).alias("n"))
    return not nodes.agg(F.max((F.col("hangs") > 0) & (F.col("n") > 1))).first()[0]


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node of an edge (a, b), by large-star and small-star in turn.

    Each step groups by node to find the least neighbour, combined before the shuffle, and joins it back to the
    edges; both are written to the shared folder, so lineage stays short. No round is run on edges that are stars already.
    """
    edges = held(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        if are_stars(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("near")).select("u", F.least("u", "near").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = held(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        edges = held(small, "small-star")
    raise RuntimeError(f"components have not settled after {MAX_ROUNDS} rounds")


def class_components(classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, component) of the linked classes; classes: (doc_id, signature, bands)."""
    members = classes.select("doc_id", F.explode("bands").alias("bucket"))
    buckets = held(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets")
    shared = held(members.join(buckets, "bucket").select("bucket", "n", "doc_id"), "members")
    central = shared.groupBy("doc_id").agg(F.sum("n").alias("met"))
    ranked = held(shared.join(central, "doc_id").select("bucket", "doc_id", "met"), "ranked-members")
    # The greatest count, then the least id, whose complement is the greatest; combined before the shuffle, so a hot bucket sends one row a task.
    most = ranked.groupBy("bucket").agg(F.max(F.struct("met", F.bitwise_not("doc_id").alias("back"))).alias("most"))
    middles = held(most.select("bucket", F.bitwise_not("most.back").alias("middle")), "middles")
    stars = held(ranked.join(middles, "bucket").select("bucket", "middle", "doc_id"), "stars")
    pairs = stars.filter("doc_id <> middle").select(F.col("middle").alias("a"), F.col("doc_id").alias("b")).distinct()
    first = held(likely(pairs, classes, percent / 100), "first-pairs")
    settled = held(components(confirmed(first, texts, width, percent)), "first-components")

    grouped = stars.join(settled.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("bucket", "middle", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    mixed = grouped.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least < most").select("bucket")
    # Buckets around one middle are one group: a pair that meets in several is judged once.
    members = held(grouped.join(mixed, "bucket").select("middle", "doc_id", "component").distinct(), "open-members")
    if members.isEmpty():
        return settled
    second = held(links_across(members, classes, texts, width, percent), "second-links")
    if second.isEmpty():
        return settled
    # Stars of the first components stand for their links.
    return components(settled.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(second))


def near_duplicates(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    rows = described(documents, width)
    worded = rows.filter("class_key IS NOT NULL AND doc_id IS NOT NULL")
    leaders = held(worded.groupBy("class_key").agg(F.min("doc_id").alias("leader")), "classes")
    leading = leaders.withColumnRenamed("leader", "doc_id")
    classes = held(worded.join(leading, ["doc_id", "class_key"]).dropDuplicates(["doc_id", "class_key"]).select("doc_id", "signature", "bands"), "leaders")
    reached = class_components(classes, documents.select("doc_id", "text"), width, percent)
    repeated = held(rows.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated-ids")
    if not repeated.isEmpty():
        # An id on rows of several classes ties these classes together.
        ties = worded.join(repeated, "doc_id").join(leaders, "class_key").filter("doc_id <> leader").select(F.col("leader").alias("a"), F.col("doc_id").alias("b"))
        reached = components(reached.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(ties))
    led = leaders.join(reached.withColumnRenamed("node", "leader"), "leader", "left").select("class_key", F.coalesce("component", "leader").alias("component"))
    placed = rows.select("doc_id", "n_shingles", "class_key").join(led, "class_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def named_nodes(documents: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """The documents with a number for each id and text in column ``name``, and what stands under each: (node, count, least).

    The number is 64 bits of their hash. Of 10^10 documents a few pairs must be expected to share it; all of these but one get theirs from a second hash.
    """
    check = F.xxhash64(F.lit(SEED), "doc_id", "text")

    def counted(named: DataFrame) -> DataFrame:
        least = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id"))
        found = named.select(F.col(name).alias("node"), "doc_id", check.alias("check")).groupBy("node")
        return held(found.agg(F.count(F.lit(1)).alias("count"), least.alias("least"), F.min("check").alias("low"), F.max("check").alias("high")), "nodes")

    named = documents.withColumn(name, document_key())
    nodes = counted(named)
    shared = nodes.filter("low <> high").select(F.col("node").alias(name), "low")
    if not shared.isEmpty():
        shared = held(shared, "shared-nodes")
        low = free_name(named, "low")
        marked = named.join(small_or_shuffled(shared.withColumnRenamed("low", low)), name, "left")
        named = marked.withColumn(name, F.when(check > F.col(low), check).otherwise(F.col(name))).drop(low)
        nodes = counted(named)
    return named, nodes.drop("low", "high")


def keep_first(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, with the columns it came with: of the least id, null ids last; rows of one id and text are one node."""
    name = free_name(documents, "near")
    named, nodes = named_nodes(documents, name)
    found = near_duplicates(named.select(F.col(name).alias("doc_id"), "text"), width, percent)
    linked = held(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("node"), F.col("component_id").alias("component")).distinct(), "linked")
    every = linked.unionByName(linked.select(F.col("component").alias("node"), "component").distinct())
    grouped = held(nodes.join(every, "node").select("node", "least", "component"), "linked-nodes")
    first = grouped.groupBy("component").agg(F.min(F.struct("least", "node")).alias("first")).select("first.node")
    led = held(grouped.select("node").join(first, "node", "left_anti"), "led")
    kept = named.join(small_or_shuffled(led.withColumnRenamed("node", name)), name, "left_anti")
    repeated = nodes.filter("count > 1").select(F.col("node").alias(name))
    if not repeated.isEmpty():
        again = small_or_shuffled(held(repeated, "repeated-nodes"))
        kept = kept.join(again, name, "left_anti").unionByName(kept.join(again, name, "left_semi").dropDuplicates([name]))
    return kept.select(*[F.col(f"`{c}`") for c in documents.columns])

"""Near-duplicate classes by b-bit MinHash.

1. Sketch: the minima of 128 hash functions over a document's distinct word shingles.  Bands of four
   minima give candidate keys; only the two low bits of every minimum are kept and packed.
2. Copies with the same words collapse to one representative, the smallest id.
3. A band's members are compared with the band's smallest member, in a star.  The number of
   equal low bits, corrected for chance collisions, estimates the similarity; pairs clearly below
   the threshold go, and so do pairs whose shingle bitmaps differ in more bits than the threshold
   allows (a bit that differs is a shingle that only one has, so this drops no link).  The rest are
   confirmed on the full shingle sets of the whole texts.
4. Components of the confirmed links.  Where a band still has members in different components,
   every pair across them takes the same tests, block against block, so no link between candidates is
   lost.  Only pairs that pass the bit counts are emitted.

A pair at the threshold misses all 32 bands with probability 5e-6, and the estimate drops it with less
than 1e-7; nothing else is lost.  The links of a star are as many as its members, never their
square; its confirmation is dealt out in parts of ``STAR_PART`` members.

A document's set: distinct shingles of ``k`` words (A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``); of fewer
words the whole sequence; null and empty texts have an empty set and no links.  A null id is
linked with nothing and kept.  ``doc_id`` names one text; repeated rows give repeated result rows.
An empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from govframe.llm.common import Rolling, WordHashes, as_bytes, compact, cut_lineage, map_texts, mix, named_by
from govframe.llm.components import components

STAR_PART = 256
#: 64-bit words of a document's shingle bitmap.
BITMAP_WORDS = 32
#: Members of a band that are compared with each other in one group.
BLOCK = 512


@dataclass(frozen=True)
class NearPolicy:
    """Shingle words, threshold in percent, bands of ``rows`` minima, and the estimate's margin in standard errors."""

    k: int = 5
    percent: int = 75
    bands: int = 32
    rows: int = 4
    margin: float = 6.0

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    @property
    def least_equal(self) -> int:
        """Equal 2-bit values that a pair at the threshold has at least, but for ``margin`` standard errors."""
        j = self.percent / 100
        p = j + (1 - j) / 4  # two different minima agree in two bits by chance in one of four cases
        return int(self.hashes * p - self.margin * (self.hashes * p * (1 - p)) ** 0.5)


class Shingler:
    """Shingle hashes of whole texts."""

    def __init__(self, k: int):
        self.k, self.words = k, WordHashes()

    def split(self, text: bytes | None) -> list[bytes]:
        return text.lower().split() if text else []

    def distinct(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0, np.uint64)
        rolling = Rolling(self.words.of(words))
        if len(words) < self.k:
            return rolling.spans(np.array([0]), np.array([len(words)]))
        return np.unique(rolling.grams(self.k))


def minima(shingles: np.ndarray, factors: np.ndarray, step: int = 512) -> np.ndarray:
    """Minimum of each hash function (an odd factor modulo 2**64) over the shingles."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), step):
        np.minimum(low, (factors[:, None] * shingles[None, at : at + step]).min(axis=1), out=low)
    return low


def sketches(docs: DataFrame, policy: NearPolicy) -> DataFrame:
    """doc_id, n_shingles, seq (hash of the word sequence), bands, bits (shingle bitmap), and the packed low bits p0..p3."""
    if policy.hashes != 128:
        raise ValueError("the packed signature holds 128 minima")

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        shingler = Shingler(policy.k)
        factors = mix(np.arange(1, policy.hashes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        order = mix(np.arange(1, policy.bands + 1, dtype=np.uint64))
        for doc, text in rows:
            words = shingler.split(text)
            if not words:
                yield doc, 0, None, None, None, None, None, None, None
                continue
            shingles = shingler.distinct(words)
            low = mix(minima(shingles, factors))
            keys = order.copy()
            for part in low.reshape(policy.bands, policy.rows).T:
                keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + part)
            planes = [np.packbits((low >> np.uint64(b)) & np.uint64(1)).view(np.int64).tolist() for b in (0, 1)]
            bits = np.zeros(64 * BITMAP_WORDS, np.uint8)
            bits[shingles % np.uint64(len(bits))] = 1
            yield doc, len(shingles), xxhash.xxh3_128_digest(b" ".join(words)), keys.view(np.int64).tolist(), np.packbits(bits).view(np.int64).tolist(), *planes[0], *planes[1]

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes().alias("text"))
    fields = [("doc_id", "long", pa.int64()), ("n_shingles", "long", pa.int64()), ("seq", "binary", pa.binary()), ("bands", "array<long>", pa.list_(pa.int64())), ("bits", "array<long>", pa.list_(pa.int64()))]
    return map_texts(kept, run, [*fields, *((f"p{i}", "long", pa.int64()) for i in range(4))], "doc_id", "text")


SKETCH = ("n_shingles", "bits", "p0", "p1", "p2", "p3")


def _packed(prefix: str) -> list[Column]:
    return [F.col(c).alias(f"{prefix}{c}") for c in SKETCH]


def _promising(policy: NearPolicy) -> Column:
    """Whether the sizes, the estimate and the bitmaps of columns a_* and b_* allow the threshold."""
    differ = F.lit(0)
    for i in (0, 1):  # p0, p1: lowest bits of the 128 minima; p2, p3: the next ones
        low, high = F.col(f"a_p{i}").bitwiseXOR(F.col(f"b_p{i}")), F.col(f"a_p{i + 2}").bitwiseXOR(F.col(f"b_p{i + 2}"))
        differ = differ + F.bit_count(low.bitwiseOR(high))
    a, b = F.col("a_n_shingles"), F.col("b_n_shingles")
    alone = F.lit(0)  # at most as many as the shingles that only one of the two has
    for i in range(BITMAP_WORDS):
        alone = alone + F.bit_count(F.col("a_bits")[i].bitwiseXOR(F.col("b_bits")[i]))
    fits = (100 * F.least(a, b) >= policy.percent * F.greatest(a, b)) & (100 * (a + b - alone) >= policy.percent * (a + b + alone))
    return (policy.hashes - differ >= policy.least_equal) & fits


def confirm(spark: SparkSession, docs: DataFrame, pairs: DataFrame, policy: NearPolicy) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold.

    Each member's text travels to its centre ``a``; a centre with many members is dealt out in
    parts, and its text goes to each.
    """
    pairs = compact(cut_lineage(spark, pairs))
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR_PART).alias("parts"))
    dealt = compact(cut_lineage(spark, pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").alias("part"))))
    need = dealt.select(F.col("b").alias("id"), "a", "part", F.lit(1).alias("role")).union(dealt.select("a", "a", "part", F.lit(0)).distinct())
    texts = named_by(spark, docs.select(F.col("doc_id").cast("long").alias("id"), as_bytes().alias("text")), dealt.select("a").union(dealt.select("b")), "id")
    met = texts.join(need, "id").repartition("a", "part").sortWithinPartitions("a", "part", "role", "id")

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        shingler, centre, of = Shingler(policy.k), np.zeros(0, np.uint64), None
        for a, part, role, doc, text in rows:
            mine = shingler.distinct(shingler.split(text))
            if role == 0:
                centre, of = mine, (a, part)
            elif of == (a, part):
                both = len(np.intersect1d(centre, mine, assume_unique=True))
                if 100 * both >= policy.percent * (len(centre) + len(mine) - both):
                    yield a, doc

    return map_texts(met, run, [("a", "long", pa.int64()), ("b", "long", pa.int64())], "a", "part", "role", "id", "text").distinct()


def across_components(spark: SparkSession, mixed: DataFrame, policy: NearPolicy) -> DataFrame:
    """Pairs (a, b) of a band's members in different components that the bit counts let through.

    A band's members are dealt into blocks of about ``BLOCK`` rows; each pair of blocks is one small
    group, so a large band spreads over many tasks.  Only the pairs that could reach the threshold come out.
    """
    sizes = cut_lineage(spark, mixed.groupBy("band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("rep"), "blocks").cast("int")
    rows = mixed.join(sizes, "band").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("band", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "rep", "comp", *SKETCH)
    dealt = rows.repartition("band", "low", "high").sortWithinPartitions("band", "low", "high", "rep")

    def compare(group: list[tuple]) -> Iterator[tuple]:
        low, high = group[0][1], group[0][2]
        block, rep, comp, n = (np.array([r[i] for r in group], np.int64) for i in (3, 4, 5, 6))
        bits = np.array([r[7] for r in group], np.int64).view(np.uint64)
        planes = np.array([r[8:] for r in group], np.int64).view(np.uint64)
        for i in range(len(group)):
            later = np.arange(i + 1, len(group))
            later = later[(comp[later] != comp[i]) & ((block[later] != block[i]) if low != high else True)]
            later = later[100 * np.minimum(n[later], n[i]) >= policy.percent * np.maximum(n[later], n[i])]
            apart = planes[later] ^ planes[i]
            differ = np.bitwise_count(apart[:, :2] | apart[:, 2:]).sum(axis=1, dtype=np.int64)
            later = later[policy.hashes - differ >= policy.least_equal]
            alone = np.bitwise_count(bits[later] ^ bits[i]).sum(axis=1, dtype=np.int64)
            both = n[later] + n[i]
            for j in later[100 * (both - alone) >= policy.percent * (both + alone)].tolist():
                yield min(rep[i], rep[j]), max(rep[i], rep[j])

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for _, group in itertools.groupby(rows, key=lambda r: r[:3]):
            yield from ((int(a), int(b)) for a, b in compare(list(group)))

    names = ("band", "low", "high", "own", "rep", "comp", *SKETCH)
    return map_texts(dealt, run, [("a", "long", pa.int64()), ("b", "long", pa.int64())], *names).distinct()


def near_duplicates(spark: SparkSession, docs: DataFrame, policy: NearPolicy = NearPolicy()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest reachable id), kept."""
    sk = cut_lineage(spark, sketches(docs, policy))
    # sides of joins are written first where the other side may be skewed: Spark splits a join of two plain shuffles
    first = cut_lineage(spark, sk.filter(F.col("seq").isNotNull() & F.col("doc_id").isNotNull()).groupBy("seq").agg(F.min("doc_id").alias("rep")))
    whole = sk.filter(F.col("bands").isNotNull())
    reps = whole.join(first, (whole["seq"] == first["seq"]) & (F.col("doc_id") == F.col("rep")), "left_semi").drop("seq").withColumnRenamed("doc_id", "rep")
    reps = cut_lineage(spark, reps)
    sigs = reps.drop("bands")
    bands = reps.select("rep", F.explode("bands").alias("band"))
    centres = cut_lineage(spark, bands.groupBy("band").agg(F.min("rep").alias("centre"), F.max("rep").alias("top")).filter("centre < top").drop("top"))
    shared = cut_lineage(spark, bands.join(centres, "band"))  # members of bands with two or more

    def with_sigs(pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(sigs.select(F.col("rep").alias(side), *_packed(f"{side}_")), side)
        return pairs.filter(_promising(policy)).select("a", "b")

    stars = with_sigs(shared.filter("rep > centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct())
    links = cut_lineage(spark, confirm(spark, docs, stars, policy))
    comps = components(spark, links, rounds=2)  # enough to leave out most pairs that are connected already

    placed = shared.join(comps.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep")).filter("rep > centre")
    placed = cut_lineage(spark, placed)
    apart = cut_lineage(spark, placed.groupBy("band").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("band"))
    mixed = cut_lineage(spark, placed.join(apart, "band").join(sigs, "rep").select("band", "rep", "comp", *SKETCH))
    if not mixed.isEmpty():
        links = cut_lineage(spark, links.union(confirm(spark, docs, across_components(spark, mixed, policy), policy)))
    comps = components(spark, links)

    top = first.join(comps, first["rep"] == comps["node"], "left").select("seq", F.coalesce("comp", "rep").alias("comp"))
    out = sk.select("doc_id", "n_shingles", "seq").join(top, "seq", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(spark: SparkSession, docs: DataFrame, policy: NearPolicy = NearPolicy()) -> DataFrame:
    """``docs`` with one row of each near-duplicate class: that of the smallest id.  Rows that repeat an id and text count as one."""
    judged = cut_lineage(spark, near_duplicates(spark, docs, policy))
    gone = judged.filter(~F.col("kept")).select(F.col("doc_id").alias("id")).distinct()
    again = judged.filter(F.col("kept") & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).count().filter("count > 1").select("id")
    left = _not_among(spark, docs, gone)
    if again.isEmpty():
        return left
    return named_by(spark, left, again, "doc_id", named=False).union(named_by(spark, left, again, "doc_id").dropDuplicates(["doc_id", "text"]))


def _not_among(spark: SparkSession, docs: DataFrame, gone: DataFrame) -> DataFrame:
    maybe, stay = named_by(spark, docs, gone, "doc_id"), named_by(spark, docs, gone, "doc_id", named=False)
    return maybe.join(gone, maybe["doc_id"].cast("long") == gone["id"], "left_anti").union(stay)

"""SimHash near-duplicate classes by Golay-code fuzzy hashing.

1. Fingerprint: 64 bits; a bit is set if over half of the text's shingle hashes have it set.
2. A fingerprint is cut into three segments of 22, 21 and 21 bits, each taken as a word of the perfect
   binary Golay code (23 bits, any word within 3 bits of exactly one codeword).  A segment's indices are
   the number of its codeword and, if that is 3 bits away, of the five codewords at 4 bits.  Two words that differ
   in at most two bits share an index: a codeword at most 2 bits from one of them is at most 4 from the other, and
   two words 3 bits from different codewords are both 4 bits from a third one.
3. Pigeonhole: of at most four errors over three segments, some two segments have at most two together.
   So every pair of segments gives one key for each pair of their indices (at most 3 * 36), and
   fingerprints that link share a key.
4. Equal fingerprints are held once.  The members of a key are compared by bit counts of their differences.
   A key with more than ``BLOCK`` members is dealt out in pairs of blocks.  Each group yields
   a row for each member that is connected inside it, not its pairs; components of these rows are the classes.

Fingerprints come from ``words`` consecutive words ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased), repeats included, joined
by a space and hashed by XXH64 with a seed; texts with fewer words give one shingle; those without words, null ones
included, have the fingerprint zero and are linked like any other.  A null id belongs to its
fingerprint's class and never names it; a class without any id has a null ``component_id``.  Repeated rows
give repeated result rows.  Very long texts are hashed whole.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govframe.llm.common import arrow_map, as_bytes, cut_lineage, map_texts
from govframe.llm.components import components
from govframe.llm.grouped import starts_of, whole_groups

#: Generator polynomial of the binary Golay code (fixed by its definition).
GENERATOR = 0b110001110101
CODE_BITS, CHECK_BITS = 23, 11
#: (lowest bit, bits) of the segments of a fingerprint.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Members of a key that are compared in one group.
BLOCK = 4096


@dataclass(frozen=True)
class GolayPolicy:
    """Words of a shingle, seed of its hash, and the most bits in which linked fingerprints differ (4 at most)."""

    words: int = 4
    seed: int = 42
    most: int = 4

    def __post_init__(self):
        if not 0 <= self.most <= 4:
            raise ValueError("the keys meet all pairs of at most 4 errors")


def shingle_hashes(text: bytes | None, policy: GolayPolicy) -> np.ndarray:
    """XXH64 of each shingle, repeats included."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    joined, k = b" ".join(words), policy.words
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(joined, policy.seed)], np.uint64)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    first, last = [0, *stops[: len(words) - k].tolist()], (stops[k - 1 :] - 1).tolist()
    digest, seed = xxhash.xxh64_intdigest, policy.seed
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(first, last, strict=True)), np.uint64, len(last))


def majority(hashes: np.ndarray) -> int:
    """The number whose bits are set in over half of the hashes."""
    n = len(hashes)
    if not n:
        return 0
    total = np.zeros(64, np.int64)
    for at in range(0, n, 255):  # so many that a byte counts them
        total += np.add.reduce(np.unpackbits(hashes[at : at + 255].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def _remainders() -> np.ndarray:
    """Check bits of each 12-bit message: the remainder of its polynomial, shifted by the check bits."""
    out = np.zeros(1 << (CODE_BITS - CHECK_BITS), np.int64)
    for message in range(len(out)):
        rest = message << CHECK_BITS
        for bit in range(CODE_BITS - 1, CHECK_BITS - 1, -1):
            if rest >> bit & 1:
                rest ^= GENERATOR << (bit - CHECK_BITS)
        out[message] = rest
    return out


class GolayIndex:
    """Indices of nearby codewords, from tables by syndrome."""

    WIDE = 6

    def __init__(self):
        self.checks = _remainders()
        self.errors = np.zeros((1 << CHECK_BITS, self.WIDE), np.int64)
        self.count = np.zeros(1 << CHECK_BITS, np.int64)
        for weight in range(5):  # a syndrome has one pattern of up to 3 bits; if it has 3, five of 4 bits follow
            for places in combinations(range(CODE_BITS), weight):
                pattern = sum(1 << p for p in places)
                s = int(self.syndrome(np.array([pattern]))[0])
                if weight < 4 or self.count[s] and bin(self.errors[s, 0]).count("1") == 3:
                    self.errors[s, self.count[s]] = pattern
                    self.count[s] += 1

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        return self.checks[words >> CHECK_BITS] ^ (words & ((1 << CHECK_BITS) - 1))

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codeword numbers (rows of ``WIDE``) and which of them count."""
        s = self.syndrome(words)
        return (words[:, None] ^ self.errors[s]) >> CHECK_BITS, np.arange(self.WIDE) < self.count[s][:, None]

    def keys(self, fingerprints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(position of the fingerprint, key) for each pair of segments and of their indices."""
        parts = [self.of(((fingerprints >> np.uint64(low)) & np.uint64((1 << wide) - 1)).astype(np.int64)) for low, wide in SEGMENTS]
        for pair, ((x, in_x), (y, in_y)) in enumerate(combinations(parts, 2)):
            key = (pair << 24) | (x[:, :, None] << 12) | y[:, None, :]
            at, i, j = np.nonzero(in_x[:, :, None] & in_y[:, None, :])
            yield at, key[at, i, j]


def fingerprints(docs: DataFrame, policy: GolayPolicy = GolayPolicy()) -> DataFrame:
    """doc_id and the 64 bits of each row's fingerprint as a signed number ``fp``."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc, text in rows:
            fp = majority(shingle_hashes(text, policy))
            yield doc, fp - (fp >> 63 << 64)

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes().alias("text"))
    return map_texts(kept, run, [("doc_id", "long", pa.int64()), ("fp", "long", pa.int64())], "doc_id", "text")


def golay_keys(distinct: DataFrame) -> DataFrame:
    """(key, fp) rows of a column of fingerprints."""
    schema = pa.schema([("key", pa.int32()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = GolayIndex()
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for at, key in index.keys(fps.view(np.uint64)):
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32)), pa.array(fps[at])], schema=schema)

    return arrow_map(distinct.select("fp"), run, "key int, fp long")


def connected(fps: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(member, other member) for each member that is linked, over others or not, to an earlier one of the group."""
    left = np.arange(len(fps))
    while len(left) > 1:
        root, left, todo = left[0], left[1:], [left[0]]
        while todo and len(left):
            near = np.bitwise_count(fps[left] ^ fps[todo.pop()]) <= most
            if near.any():
                yield from ((int(root), int(x)) for x in left[near])
                todo += left[near].tolist()
                left = left[~near]


#: Groups of up to so many members are looked through all at once, and left if no two members are close.
SMALL = 12


def linked_members(keys: list[np.ndarray], fps: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """``connected`` over each group of equal keys; positions in ``fps``."""
    starts = starts_of(keys)
    stops = np.append(starts[1:], len(fps))
    group = np.repeat(np.arange(len(starts)), stops - starts)
    worth = stops - starts > SMALL
    for d in range(1, min(SMALL, int((stops - starts).max(initial=1)))):
        close = (group[d:] == group[:-d]) & (np.bitwise_count(fps[d:] ^ fps[:-d]) <= most)
        worth[group[:-d][close]] = True
    for g in np.flatnonzero(worth).tolist():
        a = int(starts[g])
        yield from ((a + x, a + y) for x, y in connected(fps[a : stops[g]], most))


def links(spark: SparkSession, distinct: DataFrame, policy: GolayPolicy) -> DataFrame:
    """(a, b): fingerprints that are connected within a key; their components are those of all links."""
    keys = golay_keys(distinct)
    large = cut_lineage(spark, keys.groupBy("key").count().filter(F.col("count") > BLOCK).select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")))
    if large.isEmpty():
        dealt = keys.select("key", F.lit(0).alias("low"), F.lit(0).alias("high"), "fp")
    else:
        own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        met = keys.join(large, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", own)
        met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        met = met.filter((F.col("blocks") == 1) | (F.col("own") != F.col("other")))
        dealt = met.select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *group, fp in whole_groups(batches, 3):
            pairs = np.array(list(linked_members(group, fp.view(np.uint64), policy.most)), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(fp[pairs[:, 0]]), pa.array(fp[pairs[:, 1]])], schema=schema)

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, a in whole_groups(batches, 1):
            starts = starts_of([b])
            least = np.repeat(a[starts], np.diff(np.append(starts, len(a))))
            other = a != least
            yield pa.RecordBatch.from_arrays([pa.array(np.append(a[starts], least[other])), pa.array(np.append(b[starts], a[other]))], schema=schema)

    sorted_rows = dealt.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "fp")
    found = arrow_map(sorted_rows, run, "a long, b long").distinct()
    # a member has a row for each of its keys, at most 108 and their blocks: it keeps the least, to which the others are tied instead
    return arrow_map(found.select("b", "a").repartition("b").sortWithinPartitions("b", "a"), contract, "a long, b long").distinct()


def simhash_classes(spark: SparkSession, docs: DataFrame, policy: GolayPolicy = GolayPolicy()) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (hex), component_id (smallest id that its links reach)."""
    rows = cut_lineage(spark, fingerprints(docs, policy))
    # one row for each fingerprint, written before it meets the rows again: a fingerprint may belong to a third of them
    distinct = cut_lineage(spark, rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    comps = components(spark, links(spark, distinct, policy))
    placed = distinct.join(comps, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("comp", "fp").alias("comp"), "least")
    placed = cut_lineage(spark, placed)
    named = cut_lineage(spark, placed.groupBy("comp").agg(F.min("least").alias("component_id")))
    top = cut_lineage(spark, placed.join(named, "comp").select("fp", "component_id"))
    return rows.join(top, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

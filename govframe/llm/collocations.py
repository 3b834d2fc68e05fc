"""Collocation mining over a weighted de Bruijn graph of words.

Texts are lower-cased (A-Z), cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words ``[^\\x20\\x09]+``.  Nodes are
runs of ``longest - 1`` words, an edge is a run of ``longest`` words and leads from its first words to its last ones.

1. A sketch of a fixed size counts words and pairs per language, a second one the longer runs whose pairs all may reach
   ``least``; a run whose counter stays below ``least`` is certainly rarer than that.
2. Each place of a text gives one row: the longest run from there, of at most ``longest`` words, that may
   reach ``least`` with all runs inside it.  Runs of ``longest`` words are edges.  Shorter ones are corrections: their node
   ends there, at the end of its piece or before a rare word.  Rows are counted in the task, then by Spark.
3. Unary paths are compacted: where a node has one edge in and one edge out of the same weight, the two
   become one path.  Paths are joined by a coin at each end, ``rounds`` times; what stays apart is only longer to store.
4. The count of a shorter run is the flow out of it, the sum of the runs it begins, and its
   corrections.  A run that reaches ``least`` is a prefix of the row of each of its places, so its count is whole; the counts of other
   runs are partial and stay below ``least``, so they go.
5. Each candidate looks up the counts of its parts; the lowest score of its cuts counts.  A run never occurs
   more often than a run inside it, so whether a longer candidate covers a candidate shows in those longer by one word.

Memory of a task is bounded by the sketch and by ``held`` words; the two bitmaps that are broadcast have ``counters`` bits each.
In a corpus so large that nearly all counters reach ``least``, the sketches spare little and each place gives a row of up to ``longest`` words.

Null texts are empty, null languages ``und``.  Repeated rows count each time; ids are not read.  Very long texts are
read whole.  Ties of score and count go by the phrase's bytes.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from govframe.llm.common import BASE, arrow_map, as_bytes, cut_lineage, mix, rows_of

#: Most counters of a sketch that travel in one row.
ROW = 1 << 12

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_CUT = bytes.maketrans(_BREAKS + b"\t", b"." * len(_BREAKS) + b" ")


@dataclass(frozen=True)
class PhrasePolicy:
    """Words of the longest phrase, its least count, the percentage at which a longer one covers it, and rows kept per language.

    ``rounds``, ``counters`` (of a sketch, a power of two) and ``held`` (words that a task holds before it counts them) change no result.
    """

    longest: int = 4
    least: int = 30
    cover: int = 80
    top: int = 2000
    scale: int = 2_000_000
    rounds: int = 3
    counters: int = 1 << 24
    held: int = 1_000_000

    def __post_init__(self):
        if self.counters < 8 or self.counters & (self.counters - 1):
            raise ValueError("a sketch has a power of two of counters, 8 or more")
        if not (2 <= self.longest <= 4 and 1 <= self.least <= 255 and self.top > 0):
            raise ValueError("phrases have 2 to 4 words and a least count of 1 to 255")


def tokens(text: bytes) -> list[bytes]:
    """Words, and b"." where a piece ends."""
    return (text.lower().translate(_CUT).replace(b".", b" . ") + b" .").split()


class Numbered(dict):
    """Word -> number from 1; 0 for breaks."""

    def __init__(self, lang: str):
        super().__init__()
        self.seed = xxhash.xxh3_64_intdigest(lang.encode())
        self[b"."] = 0
        self.words, self.hashes, self.held, self.size, self.total = [b""], [0], [], 0, 0

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.words)
        self.words.append(word)
        self.hashes.append(xxhash.xxh3_64_intdigest(word, self.seed))
        return n

    def add(self, text: bytes) -> None:
        found = tokens(text)
        self.held.append(np.fromiter(map(self.__getitem__, found), np.int64, len(found)))
        self.size += len(found)
        self.total += len(found) - found.count(b".")

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words held, breaks behind them, and the hash of each number."""
        return np.concatenate([*self.held, np.zeros(4, np.int64)]), np.array(self.hashes, np.uint64)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(BASE) + b)


def _place(hashes: np.ndarray, counters: int) -> np.ndarray:
    return (mix(hashes) & np.uint64(counters - 1)).astype(np.int64)


def _by_language(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[str, Numbered]]:
    """The counters of all languages whenever they hold ``most`` words together, and at the end."""
    made: dict[str, Numbered] = {}
    held = 0
    for lang, text in rows_of(batches, "lang", "text"):
        if lang not in made:
            made[lang] = Numbered(lang)
        counter, before = made[lang], made[lang].size
        counter.add(text or b"")
        held += counter.size - before
        if held >= most:
            yield from made.items()
            made.clear()
            held = 0
    yield from made.items()


def possible_runs(ids: np.ndarray, hashes: np.ndarray, longest: int, bitmaps: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For 1, 2, ... words: places whose shorter runs are possible, the hash of the run there, and which of these are possible.

    The first bitmap tells it of words and pairs, the second of longer runs; without one all are.
    """
    before, h = ids > 0, hashes[ids]
    for k in range(1, longest + 1):
        at = np.flatnonzero(before if k == 1 else before[:-1] & before[1:])
        if k > 1:
            run = np.zeros(len(ids), np.uint64)
            run[at] = _pair(h[at], hashes[ids[at + k - 1]])
            h = run
        found = np.ones(len(at), bool)
        if len(bitmaps) > (k > 2):
            bits = np.frombuffer(bitmaps[k > 2], np.uint8)
            place = _place(h[at], 8 * len(bits))
            found = (bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1).astype(bool)
        yield at, h[at], found
        before = np.zeros(len(ids), bool)
        before[at] = found


def frequent_places(spark: SparkSession, texts: DataFrame, policy: PhrasePolicy, known: list[bytes]) -> bytes:
    """Bitmap of the sketch's counters that reach ``least``: ``counters`` bits, however large the corpus is.

    The sketch counts words and pairs, or, with their bitmap ``known``, longer runs whose pairs are possible.
    """
    least, sizes = policy.least, (1, 2) if not known else range(3, policy.longest + 1)
    counters, row_size = policy.counters, min(ROW, policy.counters)
    part = pa.schema([("bucket", pa.int32()), ("places", pa.binary()), ("counts", pa.binary())])
    shared = spark.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(counters, np.uint32)
        for _, counter in _by_language(batches, policy.held):
            for k, (_, run, _) in enumerate(possible_runs(*counter.taken(), sizes[-1], shared.value), 1):
                if k in sizes:
                    np.add.at(sketch, _place(run, counters), np.uint32(1))
        np.minimum(sketch, least, out=sketch)
        for bucket, row in enumerate(sketch.reshape(-1, row_size)):
            at = np.flatnonzero(row)
            if len(at):
                cells = [pa.array([bucket], pa.int32()), pa.array([at.astype(np.uint16).tobytes()], pa.binary()), pa.array([row[at].astype(np.uint8).tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(cells, schema=part)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, sums = None, np.zeros(row_size, np.int64)
        whole = pa.schema([("bucket", pa.int32()), ("bits", pa.binary())])
        close = lambda: pa.RecordBatch.from_arrays([pa.array([of], pa.int32()), pa.array([np.packbits(sums >= least).tobytes()], pa.binary())], schema=whole)
        for bucket, places, counts in rows_of(batches, "bucket", "places", "counts"):
            if bucket != of:
                if of is not None:
                    yield close()
                of, sums = bucket, np.zeros(row_size, np.int64)
            sums[np.frombuffer(places, np.uint16)] += np.frombuffer(counts, np.uint8)
        if of is not None:
            yield close()

    parts = arrow_map(texts, count, "bucket int, places binary, counts binary")
    merged = arrow_map(parts.repartition("bucket").sortWithinPartitions("bucket"), total, "bucket int, bits binary")
    out, wide = bytearray(counters // 8), row_size // 8
    for row in merged.collect():  # a row for each ROW counters
        out[row.bucket * wide : (row.bucket + 1) * wide] = row.bits
    return bytes(out)


def _distinct(packed: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """First position of each different row of ``packed`` (columns of numbers), and how often it comes."""
    if wide < 1 << 16:  # four numbers in 64 bits
        key = packed[:, 0]
        for column in packed.T[1:]:
            key = key << 16 | column
        _, first, counts = np.unique(key.astype(np.uint64) if packed.shape[1] < 4 else key.view(np.uint64), return_index=True, return_counts=True)
        return first, counts
    halves = [np.unique(packed[:, j] << 32 | (packed[:, j + 1] if j + 1 < packed.shape[1] else 0), return_inverse=True)[1] for j in range(0, packed.shape[1], 2)]
    _, first, counts = np.unique(halves[0] << 32 | halves[-1], return_index=True, return_counts=True)
    return first, counts


def longest_runs(spark: SparkSession, texts: DataFrame, policy: PhrasePolicy) -> DataFrame:
    """(lang, phrase, k, c): how often each run is the row of a place; k = 0 counts all words of a language."""
    bitmaps = [frequent_places(spark, texts, policy, [])]
    if policy.longest > 2:
        bitmaps.append(frequent_places(spark, texts, policy, bitmaps))
    shared = spark.sparkContext.broadcast(bitmaps)
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("k", pa.int32()), ("c", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, counter in _by_language(batches, policy.held):
            ids, hashes = counter.taken()
            rows, number = np.zeros((len(ids), policy.longest), np.int64), np.zeros(len(hashes), np.int64)
            for k, (at, _, found) in enumerate(possible_runs(ids, hashes, policy.longest, shared.value)):
                at = at[found]
                if k == 0:  # the possible words are numbered anew, from 1
                    used = np.unique(ids[at])
                    number[used] = np.arange(1, len(used) + 1)
                rows[at, k] = number[ids[at + k]]
            rows = rows[rows[:, 0] > 0]
            first, counts = _distinct(rows, len(used) + 1)
            words, found = [b"", *(counter.words[i] for i in used.tolist())], rows[first]
            phrases = [b" ".join([words[i] for i in r if i]).decode() for r in found.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(phrases) + 1)), pa.array([*phrases, ""]), pa.array(np.append((found > 0).sum(axis=1), 0).astype(np.int32)), pa.array(np.append(counts, counter.total))], schema=schema)

    counted = arrow_map(texts, run, "lang string, phrase string, k int, c long")
    return counted.groupBy("lang", "phrase", "k").agg(F.sum("c").alias("c"))


def _words(column: str) -> Column:
    return F.split(column, " ")


def _run(words: Column, start: Column | int, size: int) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def compact_paths(spark: SparkSession, edges: DataFrame, policy: PhrasePolicy) -> DataFrame:
    """(lang, words, c): paths whose every run of ``longest`` words is an edge (lang, phrase, c) of that weight."""
    node, w = policy.longest - 1, _words("phrase")
    edges = edges.select("lang", w.alias("words"), "c", _run(w, 1, node).alias("tail"), _run(w, 2, node).alias("head"))
    ends = edges.select("lang", F.col("head").alias("node"), F.lit(1).alias("into"), "c").union(edges.select("lang", F.col("tail"), F.lit(0), "c"))
    unary = ends.groupBy("lang", "node").agg(F.sum("into").alias("ins"), F.count("*").alias("all"), F.min("c").alias("low"), F.max("c").alias("high"))
    unary = cut_lineage(spark, unary.filter("ins = 1 AND all = 2 AND low = high").select("lang", "node", F.lit(True).alias("is")))

    def marked(df: DataFrame, end: str) -> DataFrame:
        found = unary.select("lang", F.col("node").alias(end), F.col("is").alias(f"{end}_joins"))
        return df.join(found, ["lang", end], "left").withColumn(f"{end}_joins", F.coalesce(f"{end}_joins", F.lit(False)))

    paths = marked(marked(edges, "tail"), "head").select("lang", "words", "c", "tail", "head", "tail_joins", "head_joins")
    for turn in range(policy.rounds):
        coin = F.pmod(F.xxhash64("tail", "head", F.lit(turn)), F.lit(2)) == 0
        by_head = F.col("head_joins") & (coin | ~F.col("tail_joins"))
        offered = paths.withColumn("by_head", by_head).withColumn("node", F.when(by_head, F.col("head")).when(F.col("tail_joins"), F.col("tail")))
        row = F.struct("words", "c", "tail", "head", "tail_joins", "head_joins")
        # an unary node has one path on either side, so its group has at most two rows; the others stay as they are
        met = offered.filter("node IS NOT NULL").groupBy("lang", "node").agg(F.max(F.when(F.col("by_head"), row)).alias("x"), F.max(F.when(~F.col("by_head"), row)).alias("y"))
        both = F.struct(F.concat("x.words", F.slice("y.words", F.lit(node + 1), F.size("y.words"))).alias("words"), "x.c", "x.tail", "y.head", "x.tail_joins", "y.head_joins")
        joins = F.col("x").isNotNull() & F.col("y").isNotNull() & (F.col("x.tail") != F.col("y.head"))  # a cycle stays open
        apart = F.array_compact(F.array("x", "y"))
        met = met.select("lang", F.explode(F.when(joins, F.array(both)).otherwise(apart)).alias("p")).select("lang", "p.*")
        paths = cut_lineage(spark, met.unionByName(offered.filter("node IS NULL").drop("by_head", "node")))
    return paths.select("lang", "words", "c")


def run_counts(spark: SparkSession, runs: DataFrame, policy: PhrasePolicy) -> DataFrame:
    """(lang, phrase, k, f) of all runs of 1 to ``longest`` words that occur ``least`` times or more."""
    is_edge = (F.col("k") == policy.longest) & (F.col("c") >= policy.least)
    paths = compact_paths(spark, runs.filter(is_edge), policy)
    at = F.explode(F.sequence(F.lit(1), F.size("words") - policy.longest + 1)).alias("at")
    edges = paths.select("lang", "words", "c", at).select("lang", F.slice("words", F.col("at"), policy.longest).alias("words"), "c")
    ended = runs.filter(~is_edge & (F.col("k") > 0)).select("lang", _words("phrase").alias("words"), "c")
    flow = edges.union(ended).select("lang", "words", "c", F.explode(F.sequence(F.lit(1), F.size("words"))).alias("k"))
    out = flow.select("lang", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("phrase"), "k", "c")
    return out.groupBy("lang", "phrase", "k").agg(F.sum("c").alias("f")).filter(F.col("f") >= policy.least)


def collocations(spark: SparkSession, docs: DataFrame, policy: PhrasePolicy = PhrasePolicy()) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), as_bytes().alias("text"))
    runs = cut_lineage(spark, longest_runs(spark, texts, policy))
    # counts are written before candidates meet them: a word like "the" is a part of very many candidates
    counts = cut_lineage(spark, run_counts(spark, runs, policy))
    found = counts.filter("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"))

    w = _words("phrase")
    cuts = found.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "cut", _cut_part(w, F.lit(1), F.col("cut")).alias("first"), _cut_part(w, F.col("cut") + 1, F.col("k")).alias("rest"))
    for side, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    wide = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731  products may pass 64 bits
    cuts = cuts.withColumn("up", F.lit(policy.scale).cast("decimal(12,0)") * wide("a")).withColumn("down", wide("l") + wide("r"))
    scored = cuts.withColumn("score", F.expr("up div down")).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))

    longer = counts.filter("k > 2")
    inside = longer.select("lang", _cut_part(w, F.lit(1), F.col("k") - 1).alias("phrase"), "f").union(longer.select("lang", _cut_part(w, F.lit(2), F.col("k")), "f"))
    covered = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    left = scored.join(covered, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.lit(100) * wide("longer") < F.lit(policy.cover) * wide("a")))

    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = left.select("lang", "phrase", "a", "low.l", "low.r", "low.score").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= policy.top)
    words = runs.filter("k = 0").select("lang", F.col("c").alias("n"))
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _cut_part(words: Column, first: Column, last: Column) -> Column:
    return F.array_join(F.slice(words, first, last - first + 1), " ")

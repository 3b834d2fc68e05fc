"""Benchmark decontamination as a prefix-filtered set join with exact verification.

An item window is a run of ``size`` item words (a shorter item is one window).  As a set it holds
its word shingles; a document can contain the window only if it contains all of them, so the one
rarest shingle is the necessary prefix.  Rarity is the shingles' count over all documents.
Documents send only the places of prefix shingles to the join, with the words around them; a
candidate must fit between the document's ends (length and position bounds) and its words must
equal the window's, word by word.

What is broadcast are two bitmaps of fixed size (``BITMAP_BITS``), never the shingles or windows;
a larger benchmark lets more false candidates through to the join, and none is lost.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z.  Null and empty texts
have no words; items without words have no windows; repeated rows of either table are judged
alike, and an item counts once by its id.  With ``null_items``, as in the query and the pipeline, items without an id
hit like others: together they count as one item in ``n_items`` and have no place in ``item_ids``; otherwise they are left out.  An empty table on either side gives no hits.  A shingle
or window that a third of the documents share only makes its rows of the join many; Spark may
split them, as the other side has a row per window.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govframe.llm.anchored import text_hash, without
from govframe.llm.common import Rolling, WordHashes, as_bytes, bitmap, cut_lineage, map_texts, unpacked

WINDOW_WORDS = 13
SHINGLE_WORDS = 3
BITMAP_BITS = 1 << 23

#: ASCII bytes that are no word bytes become spaces, A-Z become a-z.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def item_windows(benchmark: DataFrame, size: int, shingle: int, null_items: bool = False) -> DataFrame:
    """One row per item and window: item_id, win (its words joined by a space), n (its words), grams (hashes of its shingles)."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        hashes = WordHashes()
        for item, text in rows:
            words = words_of(text)
            if not words or (item is None and not null_items):
                continue
            n = min(size, len(words))
            g = min(shingle, n)
            grams = Rolling(hashes.of(words)).grams(g).view(np.int64)
            for at in range(len(words) - n + 1):
                yield item, b" ".join(words[at : at + n]).decode(), n, grams[at : at + n - g + 1].tolist()

    kept = benchmark.select(F.col("item_id").cast("string").alias("item_id"), as_bytes().alias("text"))
    fields = [("item_id", "string", pa.string()), ("win", "string", pa.string()), ("n", "int", pa.int32()), ("grams", "array<long>", pa.list_(pa.int64()))]
    return map_texts(kept, run, fields, "item_id", "text").distinct()


class GramFinder:
    """Finds the shingles of a document whose hash is in a bitmap."""

    def __init__(self, bits: bytes, sizes: list[int]):
        self.member = unpacked(bits)
        self.sizes, self.hashes = sizes, WordHashes()

    def find(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions and hashes for each shingle size."""
        rolling = Rolling(self.hashes.of(words))
        for g in self.sizes:
            grams = rolling.grams(g)
            at = np.flatnonzero(self.member[(grams.view(np.int64) % len(self.member))])
            yield at, grams[at].view(np.int64)


def gram_counts(docs: DataFrame, bits, sizes: list[int], held: int = 200_000) -> DataFrame:
    """gram, docs_n: occurrences in the documents of the shingles in the bitmap, counted in each task first."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        finder, counts = GramFinder(bits.value, sizes), Counter()
        for (text,) in rows:
            for _, grams in finder.find(words_of(text)):
                counts.update(grams.tolist())
            if len(counts) > held:
                yield from counts.items()
                counts.clear()
        yield from counts.items()

    return map_texts(docs.select(as_bytes().alias("text")), run, [("gram", "long", pa.int64()), ("n", "long", pa.int64())], "text").groupBy("gram").agg(F.sum("n").alias("docs_n"))


def prefix_places(docs: DataFrame, bits, sizes: list[int], size: int) -> DataFrame:
    """One row per document: doc_id, th, n_words and the places of prefix shingles (gram, pos, first word of the context, context)."""
    place = pa.struct([("gram", pa.int64()), ("pos", pa.int32()), ("from", pa.int32()), ("context", pa.string())])

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        finder = GramFinder(bits.value, sizes) if bits else None
        for doc, text in rows:
            words, places = words_of(text), []
            for at, grams in finder.find(words) if finder else ():
                for pos, gram in zip(at.tolist(), grams.tolist(), strict=True):
                    first = max(0, pos - size + 1)
                    places.append({"gram": gram, "pos": pos, "from": first, "context": b" ".join(words[first : pos + size]).decode()})
            yield doc, text_hash(text or b""), len(words), places

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes().alias("text"))
    fields = [("doc_id", "long", pa.int64()), ("th", "int", pa.int32()), ("n_words", "long", pa.int64()), ("places", "array<struct<gram:long,pos:int,`from`:int,context:string>>", pa.list_(place))]
    return map_texts(kept, run, fields, "doc_id", "text")


def find_contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, shingle: int = SHINGLE_WORDS, bits: int = BITMAP_BITS, null_items: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, th (hash of the text), n_words, n_hit, spans (start and length of hit windows), item_ids (sorted as strings), n_items, contaminated."""
    windows = cut_lineage(spark, item_windows(benchmark, size, shingle, null_items))
    lengths = sorted(r.g for r in windows.select(F.least(F.lit(shingle), "n").alias("g")).distinct().toLocalIterator())  # at most `shingle` rows
    shared = None
    if lengths:
        unique = windows.select("win", "n", "grams").distinct()
        grams = unique.select("win", "n", F.posexplode("grams").alias("offset", "gram"))
        counts = gram_counts(docs, spark.sparkContext.broadcast(bitmap(grams, bits, "gram")), lengths)
        # a window with a shingle that no document has occurs nowhere
        counted = grams.join(counts, "gram", "left").withColumn("count", F.coalesce("docs_n", F.lit(0)))
        rarest = counted.groupBy("win", "n").agg(F.min(F.struct("count", "offset", "gram")).alias("p"))
        prefixes = cut_lineage(spark, rarest.filter(F.col("p.count") > 0).select("win", "n", "p.offset", "p.gram"))
        shared = spark.sparkContext.broadcast(bitmap(prefixes, bits, "gram"))
    scanned = cut_lineage(spark, prefix_places(docs, shared, lengths, size).withColumn("row", F.monotonically_increasing_id()))
    if shared is None:
        return _verdicts(scanned, None, None)
    places = scanned.select("row", "n_words", F.inline("places"))
    start = F.col("pos") - F.col("offset")
    fits = (start >= 0) & (start + F.col("n") <= F.col("n_words"))
    same = F.array_join(F.slice(F.split("context", " "), start - F.col("from") + 1, F.col("n")), " ") == F.col("win")
    found = places.join(prefixes, "gram").filter(fits).filter(same).select("row", start.alias("start"), "n", "win")
    found = cut_lineage(spark, found)
    spans = found.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "n"))).alias("spans"))
    items = found.select("row", "win").distinct().join(windows.select("item_id", "win"), "win").groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max(F.col("item_id").isNull().cast("int")).alias("unnamed"))
    return _verdicts(scanned, spans, items)


def _verdicts(scanned: DataFrame, spans: DataFrame | None, items: DataFrame | None) -> DataFrame:
    docs = scanned.select("row", "doc_id", "th", "n_words")
    out = reduce(lambda a, b: a.join(b, "row", "left"), [x for x in (spans, items) if x is not None], docs)
    none = {"spans": F.array().cast("array<struct<start:int,n:int>>"), "item_ids": F.array().cast("array<string>"), "unnamed": F.lit(0)}
    out = out.select("doc_id", "th", "n_words", *(F.coalesce(F.col(c) if c in out.columns else F.lit(None), v).alias(c) for c, v in none.items()))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("sum"))

    def add(acc, s):
        end = s["start"] + s["n"]
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["sum"] + F.greatest(F.lit(0), end - F.greatest(acc["end"], s["start"]))).cast("long").alias("sum"))

    out = out.withColumn("n_hit", F.aggregate("spans", zero, add, lambda acc: acc["sum"]))
    return out.select("doc_id", "th", "n_words", "n_hit", "spans", "item_ids", (F.size("item_ids") + F.col("unnamed")).cast("long").alias("n_items"), ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows."""
    found = cut_lineage(spark, find_contamination(spark, docs, benchmark, null_items=True).filter("contaminated").select(F.col("doc_id").alias("doc"), "th").distinct())
    return without(spark, docs, found)

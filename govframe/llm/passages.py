"""Passage dedup: matching statistics of every document against suffix automata of the earlier ones.

A word is removed if a window of 50 words that covers it starts also in a document with a smaller
id.  The reference of a document is every document before it, so the reference is cut into shards:
all windows that share an anchor gram.  A shard holds only regions around anchors that occur in
several documents; regions with the same words are held once, for the smallest id.  In a shard,
documents stream in order of their id through the automaton of those before them: where the
matching statistic (the longest suffix read so far that the automaton knows) reaches 50 words, the
words it covers go; then the region's words are added.

An automaton's size follows the corpus, so none is broadcast whole: the documents' regions are sent
to their shard.  A shard with more than ``HOT_REGIONS`` different regions is divided: a part takes the windows at
``cell`` neighbouring distances from the anchor, and its key is the longer string that they share.  Parts go through the
same steps as shards, copies first, then the automaton, and hot parts are divided again.  Where a part is one window
(``cell`` 1) all its regions are copies, so no shard grows without bound.

Words are runs of ``[^\\x20\\x09-\\x0D]``, unchanged.  Null and empty texts have no words.  A null id has no
order: such rows lose nothing and remove nothing.  Rows that repeat a ``doc_id`` do not count against each
other.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govframe.llm.anchored import Windows, anchor_rows, apply_spans, divided, merged, with_texts
from govframe.llm.common import WordHashes, cut_lineage, map_texts, sha256_hex

WINDOW_WORDS = 50
HOT_REGIONS = 512
#: Parts that a hot shard, or a hot part, is divided into, about.
PARTS = 4


class SuffixAutomaton:
    """Generalised suffix automaton over words, built one region at a time."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, words: list) -> None:
        step, link, length = self.next, self.link, self.length
        last = 0
        for w in words:
            known = step[last].get(w)
            if known is not None:
                if length[known] == length[last] + 1:
                    last = known
                    continue
                last = self._split(last, w, known)
                continue
            new = len(length)
            step.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and w not in step[p]:
                step[p][w] = new
                p = link[p]
            if p >= 0:
                q = step[p][w]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, w, q)
            last = new

    def _split(self, p: int, w, q: int) -> int:
        step, link, length = self.next, self.link, self.length
        clone = len(length)
        step.append(step[q].copy())
        link.append(link[q])
        length.append(length[p] + 1)
        while p >= 0 and step[p].get(w) == q:
            step[p][w] = clone
            p = link[p]
        link[q] = clone
        return clone

    def matches(self, words: list, least: int) -> Iterator[int]:
        """Each place (one past its last word) where the matching statistic is ``least`` or more."""
        step, link, length = self.next, self.link, self.length
        state = size = 0
        for at, w in enumerate(words, 1):
            while state and w not in step[state]:
                state = link[state]
                size = length[state]
            to = step[state].get(w)
            if to is not None:
                state, size = to, size + 1
            if size >= least:
                yield at


def word_symbols():
    hashes = WordHashes()
    return lambda text: hashes.of(text.split())


def shard_spans(regions: DataFrame, window: int) -> DataFrame:
    """Spans (doc, th, start, stop) that lie in an earlier document of the same shard (key).

    ``regions``: key, doc, th, first, words (joined by a space), sorted here by shard and document.
    """
    dealt = regions.repartition("key").sortWithinPartitions("key", "doc", "th", "first")

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        shard, automaton, held, of = None, SuffixAutomaton(), [], None
        for key, doc, th, first, text in rows:
            if key != shard:
                shard, automaton, held, of = key, SuffixAutomaton(), [], None
            if doc != of:  # what the document before this one has is reference now
                for words in held:
                    automaton.add(words)
                held, of = [], doc
            words = text.split(b" ")
            for stop in automaton.matches(words, window):
                yield doc, th, first + stop - window, first + stop
            held.append(words)

    fields = [("doc", "long", pa.int64()), ("th", "int", pa.int32()), ("start", "int", pa.int32()), ("stop", "int", pa.int32())]
    return map_texts(dealt, run, fields, "key", "doc", "th", "first", "words")


def region_words(texts: DataFrame, window: int) -> DataFrame:
    """key, doc, th, first, words of each listed region."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc, th, text, regions in rows:
            words = text.split()
            for r in regions:
                yield r["key"], doc, th, r["first"], b" ".join(words[r["first"] : r["first"] + r["more"] + window])

    fields = [("key", "long", pa.int64()), ("doc", "long", pa.int64()), ("th", "int", pa.int32()), ("first", "int", pa.int32()), ("words", "binary", pa.binary())]
    return map_texts(texts, run, fields, "doc", "th", "text", "list")


def repeated_passages(spark: SparkSession, docs: DataFrame, window: int = WINDOW_WORDS, hot: int = HOT_REGIONS) -> DataFrame:
    """Spans (doc, th, start, stop; in words) of each text that occur in a document with a smaller id."""
    shape = Windows(window, max(1, window // 2))
    found, cell, spans = anchor_rows(docs.filter(F.col("doc_id").isNotNull()), shape, word_symbols), shape.grams, None
    stop = F.col("first") + F.col("more") + F.lit(window)
    while True:
        # sides of joins are written first where the other side may be skewed: Spark splits a join of two plain shuffles
        shared = cut_lineage(spark, found.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low < high").drop("high"))
        rows = cut_lineage(spark, found.join(shared, "key"))
        firsts = cut_lineage(spark, rows.groupBy("key", "region").agg(F.min("doc").alias("holder")))
        held = cut_lineage(spark, rows.join(firsts, ["key", "region"]))
        whole = held.filter("doc > holder").select("doc", "th", F.col("first").alias("start"), stop.alias("stop"))

        # regions that no smaller document has as a whole, in shards where some smaller document has the anchor
        mine = held.filter("doc = holder")
        sizes = cut_lineage(spark, mine.groupBy("key").agg(F.count("*").alias("n"), F.max("holder").alias("last"), F.min("low").alias("low")).filter("low < last").select("key", "n"))
        open_ = cut_lineage(spark, mine.join(sizes, "key").select("key", "doc", "th", "first", "back", "more", "n"))
        few, many = open_.filter((F.col("n") <= hot) | F.lit(cell == 1)), open_.filter(F.col("n") > hot)
        here = whole.union(shard_spans(region_words(with_texts(spark, docs, few, "key", "first", "more"), window), window))
        spans = here if spans is None else spans.union(here)
        if cell == 1 or many.isEmpty():
            return cut_lineage(spark, spans)
        cell = max(1, cell // PARTS)
        found = cut_lineage(spark, divided(with_texts(spark, docs, many, "key", "first", "back", "more"), window, cell, word_symbols))


def remove_passages(spark: SparkSession, docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept (the kept words joined by a space), kept_sha256."""

    def judge():
        def of(text: bytes, spans: list[dict]) -> tuple:
            words = text.split()
            runs = merged(spans, len(words))
            for start, stop in reversed(runs):
                del words[start:stop]
            kept, gone = b" ".join(words), sum(b - a for a, b in runs)
            return len(words) + gone, gone, kept.decode(), sha256_hex(kept)

        return of

    fields = [("n_words", "long", pa.int64()), ("n_removed", "long", pa.int64()), ("kept", "string", pa.string()), ("kept_sha256", "string", pa.string())]
    return apply_spans(spark, docs, repeated_passages(spark, docs, window), judge, fields)

"""Where long repeats can be: content-chosen anchors, shared by the two substring operators.

A window is ``W`` consecutive symbols.  Of the grams of ``k`` symbols in a window, the one with the
smallest hash (the leftmost of equals) is the window's anchor, so equal windows have equal anchors
at the same place.  Neighbouring windows mostly share their anchor: each anchor stands for a run
of window starts, and every window belongs to exactly one anchor.  Only anchors whose gram occurs
elsewhere can lie in a repeat, and only their texts are read again.

A row is named by its ``doc_id`` and a hash of its text, so null or repeated ids do no harm.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from govframe.llm.common import SLICE_ROWS, Rolling, arrow_map, as_bytes, fresh, map_texts, mix, named_by, sliding_min

#: Window starts of one pass over a very long text; passes overlap by a window, so no result depends on it.
PASS = 1 << 22
_PLACE = np.uint64((1 << 23) - 1)


@dataclass(frozen=True)
class Windows:
    """Window length and gram length, in symbols."""

    window: int
    gram: int

    @property
    def grams(self) -> int:
        return self.window - self.gram + 1


def runs_of(grams: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last start of each run of windows with the same anchor, and the anchor's place."""
    firsts, lasts, places = [], [], []
    for base in range(0, len(grams) - w + 1, PASS):
        part = grams[base : base + PASS + w - 1]
        low = sliding_min((part & ~_PLACE) | np.arange(len(part), dtype=np.uint64), w)
        ends = np.concatenate((np.flatnonzero(low[1:] != low[:-1]), [len(low) - 1]))
        lasts.append(ends + base)
        firsts.append(np.concatenate(([0], ends[:-1] + 1)) + base)
        places.append((low[ends] & _PLACE).astype(np.int64) + base)
    if not firsts:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(firsts), np.concatenate(lasts), np.concatenate(places)


def text_hash(text: bytes) -> int:
    """What ``th`` is natively: CRC-32, moved to the range of a signed integer."""
    return zlib.crc32(text) - (1 << 31)


def native_text_hash(text: Column) -> Column:
    return (F.crc32(text) - F.lit(1 << 31)).cast("int")


def anchor_rows(docs: DataFrame, windows: Windows, symbols: Callable[[], Callable[[bytes], np.ndarray]]) -> DataFrame:
    """One row per anchor: key (hash of its gram), region (hash of all its windows cover and of its place there),
    doc, th, first (its first window's start), back (from there to the anchor), more (window starts after the first).

    ``symbols()`` makes, in each task, the function from a text's bytes to its 64-bit symbols.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = symbols()
        names = ["key", "region", "doc", "th", "first", "back", "more"]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                counts, out = [], [[] for _ in range(6)]
                for text in part.column(1).to_pylist():
                    found = 0
                    if text and len(s := of(text)) >= windows.window:
                        rolling = Rolling(s)
                        grams = rolling.grams(windows.gram)
                        first, last, place = runs_of(grams, windows.grams)
                        back = place - first
                        region = rolling.spans(first, last + windows.window) + back.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
                        found = len(first)
                        for held, new in zip(out, (grams[place].view(np.int64), region.view(np.int64), np.full(found, text_hash(text), np.int32), first, back, last - first), strict=True):
                            held.append(new)
                    counts.append(found)
                if sum(counts):
                    key, region, th, first, back, more = (np.concatenate(x) for x in out)
                    doc = part.column(0).take(pa.array(np.repeat(np.arange(len(counts)), counts)))
                    columns = [pa.array(key), pa.array(region), doc, pa.array(th), *(pa.array(x.astype(np.int32)) for x in (first, back, more))]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc"), as_bytes().alias("text")), run, "key long, region long, doc long, th int, first int, back int, more int")


def same_text(a: DataFrame, b: DataFrame) -> Column:
    return a["doc"].eqNullSafe(b["doc"]) & (a["th"] == b["th"])


def hashed_texts(docs: DataFrame) -> DataFrame:
    """doc, th, text (bytes; null counts as empty)."""
    text = F.coalesce(as_bytes(), F.lit(b""))
    return docs.select(F.col("doc_id").cast("long").alias("doc"), native_text_hash(text).alias("th"), text.alias("text"))


def with_texts(spark: SparkSession, docs: DataFrame, regions: DataFrame, *columns: str) -> DataFrame:
    """doc, th, text and ``list`` (structs of ``columns``) of each text that ``regions`` names."""
    wanted = regions.groupBy("doc", "th").agg(F.collect_list(F.struct(*columns)).alias("list"))
    named = hashed_texts(named_by(spark, docs.select("doc_id", "text"), regions.select("doc").distinct(), "doc_id"))
    return named.join(wanted, same_text(named, wanted)).select(named["doc"], named["th"], "list", "text")


def divided(texts: DataFrame, window: int, cell: int, symbols: Callable[[], Callable[[bytes], np.ndarray]]) -> DataFrame:
    """Rows as ``anchor_rows`` makes them, for the parts of each listed region: the windows at ``cell`` neighbouring distances from the anchor.

    A part's key is the hash of the key it had, of the distances and of the symbols that all windows at these distances share.
    """

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        of = symbols()
        for doc, th, text, regions in rows:
            rolling = Rolling(of(text))
            old, first, back, more = (np.array([r[c] for r in regions], np.int64) for c in ("key", "first", "back", "more"))
            lowest = (back - more) // cell
            n = back // cell - lowest + 1
            at = np.repeat(np.arange(len(n)), n)
            low = (lowest[at] + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)) * cell
            place = (first + back)[at]
            start, last = np.maximum(first[at], place - low - cell + 1), np.minimum((first + more)[at], place - low)
            shared = rolling.spans(place - low, place - low - cell + 1 + window)
            key = mix(shared + mix(old[at].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + low.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
            region = rolling.spans(start, last + window) + (place - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
            for part in zip(key.view(np.int64).tolist(), region.view(np.int64).tolist(), start.tolist(), (place - start).tolist(), (last - start).tolist(), strict=True):
                yield *part[:2], doc, th, *part[2:]

    ints = [(n, "int", pa.int32()) for n in ("th", "first", "back", "more")]
    return map_texts(texts, run, [*((n, "long", pa.int64()) for n in ("key", "region", "doc")), *ints], "doc", "th", "text", "list")


def apply_spans(spark: SparkSession, docs: DataFrame, spans: DataFrame, judge: Callable[[], Callable[[bytes, list[dict]], tuple]], fields: list[tuple[str, str, pa.DataType]]) -> DataFrame:
    """doc_id and what ``judge`` makes of each text and its spans (doc, th, start, stop).

    Documents that certainly have no span are judged where they are read; the others meet their
    spans, merged to one list per text, in a join.
    """
    wanted = spans.groupBy("doc", "th").agg(F.collect_list(F.struct("start", "stop")).alias("list"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ids = spans.select("doc").distinct()
    touched, clean = named_by(spark, rows, ids, "doc_id"), named_by(spark, rows, ids, "doc_id", named=False)

    def run(found: Iterator[tuple]) -> Iterator[tuple]:
        of = judge()
        for doc, text, more in found:
            yield doc, *of(text or b"", more or [])

    none = F.lit(None).cast("array<struct<start:int,stop:int>>").alias("list")
    named = hashed_texts(touched)
    met = named.join(wanted, same_text(named, wanted), "left").select(named["doc"], "text", "list")
    clean = clean.select(F.col("doc_id").alias("doc"), as_bytes().alias("text"), none)
    return map_texts(met.unionByName(clean), run, [("doc_id", "long", pa.int64()), *fields], "doc", "text", "list")


def merged(spans: list[dict], n: int) -> list[tuple[int, int]]:
    """The maximal runs that spans cover, within 0..n, in order."""
    out: list[list[int]] = []
    for start, stop in sorted((x["start"], min(n, x["stop"])) for x in spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def without(spark: SparkSession, docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id and text are not among ``gone`` (doc, th); rows that certainly stay are not shuffled."""
    ids = gone.select("doc").distinct()
    maybe, stay = named_by(spark, docs, ids, "doc_id"), named_by(spark, docs, ids, "doc_id", named=False)
    same = maybe["doc_id"].cast("long").eqNullSafe(gone["doc"]) & (native_text_hash(F.coalesce(maybe["text"].cast("binary"), F.lit(b""))) == gone["th"])
    return maybe.join(gone, same, "left_anti").union(stay)


def rewrite(spark: SparkSession, docs: DataFrame, spans: DataFrame, judge: Callable[[], Callable[[bytes, list[dict]], str]]) -> DataFrame:
    """``docs`` with the text of each row that has spans (doc, th, start, stop) as ``judge`` returns it, and its ``n_chars``."""
    listed = fresh("list", docs)
    wanted = spans.groupBy("doc", "th").agg(F.collect_list(F.struct("start", "stop")).alias(listed))
    ids = spans.select("doc").distinct()
    touched, clean = named_by(spark, docs, ids, "doc_id"), named_by(spark, docs, ids, "doc_id", named=False)
    same = touched["doc_id"].cast("long").eqNullSafe(wanted["doc"]) & (native_text_hash(F.coalesce(touched["text"].cast("binary"), F.lit(b""))) == wanted["th"])
    met = touched.join(wanted, same, "left").select(*(touched[c] for c in docs.columns), wanted[listed])
    names = docs.columns
    text_at, count_at = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = judge()
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                columns, lists = list(batch.columns[:-1]), batch.columns[-1].to_pylist()
                texts = [of((t or "").encode(), x) if x else t for t, x in zip(columns[text_at].to_pylist(), lists, strict=True)]
                if count_at is not None:
                    counts = [len(t) if x else n for t, x, n in zip(texts, lists, columns[count_at].to_pylist(), strict=True)]
                    columns[count_at] = pa.array(counts, columns[count_at].type)
                columns[text_at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return arrow_map(met, run, docs.schema).union(clean)

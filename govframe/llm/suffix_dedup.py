"""Suffix-array dedup by external induced sorting.

A byte goes if a 400-byte string that covers it starts anywhere else, in any document.  Only strings
around anchors that occur more than once can repeat (``anchored``); regions with equal bytes are held
once.  The others meet in shards of one anchor gram, where the suffixes that can start a
repeat are sorted with their common-prefix lengths:

* the sample suffixes, which start at the anchors, are sorted by Spark's external sort, and
  their common prefixes are read off neighbours;
* every other suffix is induced from the suffix one byte later: tuples (suffix, common prefix) leave a
  priority queue in suffix order, enter the queue of the byte before them, and take the smallest
  common prefix on their way plus one.  So the order at one offset gives the order at the next.
* a suffix whose common prefix cannot reach 400 any more leaves the sort.

Two neighbours with a common prefix of 400 bytes mark both places.  Small shards go through the
induction together, in memory; a shard of more than ``IN_MEMORY`` regions keeps its queues, bytes and
places in scratch files of the task (as Spark's own sort does) and holds a block at a time.
A shard of more than ``HOT_REGIONS`` different regions is divided by the distance from window start to anchor: a part's
key is the longer string that all its windows share.  Parts go through the same steps as shards, equal ones held once, and hot
parts are divided again, down to single windows, which are equal in a part; so no sort group has more regions than that.

Matches never cross documents.  Null and empty texts have no bytes.  Repeated rows, a repeated or null id included, are
copies like any other, so both lose their long strings.  An empty table gives no rows.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govframe.llm.anchored import Windows, anchor_rows, apply_spans, divided, merged, rewrite, with_texts
from govframe.llm.common import cut_lineage, map_texts, mix, sha256_hex

WINDOW_BYTES = 400
IN_MEMORY = 16_384
HOT_REGIONS = 4_096
#: Parts that a hot shard, or a hot part, is divided into, about.
PARTS = 8
_MOST = np.iinfo(np.int64).max


def byte_symbols():
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return lambda text: values[np.frombuffer(text, np.uint8)]


def range_min(a: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minimum of a[first..last] (both included) for each pair, from minima of runs of 1, 2, 4, ..."""
    out, span = a[last], last - first + 1
    level, width, most = a, 1, span.max(initial=1)
    while 2 * width <= most:
        level = np.minimum(level[:-width], level[width:])
        width *= 2
        at = np.flatnonzero((span >= width) & (span < 2 * width))
        out[at] = np.minimum(level[first[at]], level[last[at] - width + 1])
    return out


class Marks:
    """Turns marked places, offset by offset, into spans of bytes."""

    def __init__(self, doc, th, first, back, window: int):
        self.of, self.window = (doc, th, first, back), window
        self.since = np.full(len(first), -1, np.int32)

    def step(self, offset: int, marked: np.ndarray) -> Iterator[tuple]:
        """``marked``: of each region, whether its suffix at ``offset`` bytes before the sample is repeated."""
        doc, th, first, back = self.of
        for i in np.flatnonzero((self.since >= 0) & ~marked).tolist():
            place = int(first[i]) + int(back[i])
            yield doc[i], int(th[i]), place - offset + 1, place - int(self.since[i]) + self.window
        self.since = np.where(marked, np.where(self.since < 0, offset, self.since), -1)


def induce(group: np.ndarray, lcp: np.ndarray, back: np.ndarray, before: np.ndarray, window: int) -> Iterator[np.ndarray]:
    """Marked regions at offsets 0, 1, ... for many shards at once.

    Regions come sorted by shard and sample suffix; ``lcp``: common prefix with the region before (0 at
    a shard's first).  ``before[o, i]``: the byte ``o + 1`` places before region i's sample.
    """
    order, offset = np.arange(len(group)), 0
    while True:
        marked = np.zeros(len(group), bool)
        hit = np.flatnonzero(lcp >= window)
        marked[order[hit]] = marked[order[hit - 1]] = True
        yield marked
        left = back[order] - offset
        nearest = np.maximum(lcp, np.append(lcp[1:], 0))
        at = np.flatnonzero((left > 0) & (nearest + left >= window))
        if not len(at):
            return
        key = group[order[at]] * 256 + before[offset, order[at]]
        by = np.argsort(key, kind="stable")  # the queues of each shard and byte, each in suffix order
        key, at = key[by], at[by]
        same = np.flatnonzero(key[1:] == key[:-1]) + 1
        longer = np.zeros(len(at), lcp.dtype)
        longer[same] = range_min(lcp, at[same - 1] + 1, at[same]) + 1
        order, lcp, offset = order[at], longer, offset + 1


class DiskQueue:
    """Priority queue of (region, common prefix) tuples by their leading byte; tuples of one byte leave as they came.

    Each byte's queue is a file that grows at its end, kept in memory while it is small.
    """

    def __init__(self, small: int = 1 << 16):
        self.small, self.queues = small, {}

    def push(self, byte: int, regions: np.ndarray, lcp: np.ndarray) -> None:
        if byte not in self.queues:
            self.queues[byte] = tempfile.SpooledTemporaryFile(max_size=self.small)
        self.queues[byte].write(np.stack((regions, lcp)).T.astype(np.int64).tobytes())

    def pop(self, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All tuples in order, in blocks; the queue is empty afterwards."""
        for byte in sorted(self.queues):
            queue = self.queues.pop(byte)
            queue.seek(0)
            while data := queue.read(16 * block):
                pairs = np.frombuffer(data, np.int64).reshape(-1, 2)
                yield pairs[:, 0], pairs[:, 1]
            queue.close()


def induce_on_disk(lcp: np.ndarray, back: np.ndarray, before: np.ndarray, window: int, block: int) -> Iterator[np.ndarray]:
    """``induce`` for one shard larger than memory: the arrays are scratch files, and tuples pass block by block through queues."""
    queue, offset = DiskQueue(), 0
    for at in range(0, len(back), block):
        queue.push(0, np.arange(at, min(at + block, len(back))), lcp[at : at + block])
    while True:
        marked, onward = np.zeros(len(back), bool), DiskQueue()
        lowest = np.full(256, _MOST)  # of each byte: the smallest common prefix since its last tuple
        seen = np.zeros(256, bool)
        for regions, common, ahead in _with_next(queue.pop(block)):
            following = np.append(common[1:], ahead)
            marked[regions[(common >= window) | (following >= window)]] = True
            left = back[regions] - offset
            live = (left > 0) & (np.maximum(common, following) + left >= window)
            places, bytes_ = np.flatnonzero(live), before[offset, regions[live]] if live.any() else np.zeros(0, np.uint8)
            absent = np.ones(256, bool)
            for byte in np.unique(bytes_).tolist():
                at = places[bytes_ == byte]
                low = np.minimum.reduceat(np.append(common, _MOST), np.concatenate(([0], at + 1)))
                onto = low[:-1] + 1
                onto[0] = min(low[0], lowest[byte]) + 1 if seen[byte] else 0
                onward.push(byte, regions[at], onto)
                lowest[byte], seen[byte], absent[byte] = low[-1], True, False
            lowest[absent] = np.minimum(lowest[absent], common.min())
        yield marked
        if not seen.any():
            return
        queue, offset = onward, offset + 1


def _with_next(blocks: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Each block with the common prefix of the tuple that follows it."""
    held = None
    for regions, common in blocks:
        if held is not None:
            yield *held, int(common[0])
        held = regions, common
    if held is not None:
        yield *held, 0


def common_prefixes(samples: list[bytes], window: int) -> np.ndarray:
    """Common prefix of each sample suffix with the one before it, no longer than either."""
    sizes = np.fromiter(map(len, samples), np.int64, len(samples))
    rows = np.frombuffer(b"".join(s.ljust(window, b"\0") for s in samples), np.uint8).reshape(len(samples), window)
    differ = rows[1:] != rows[:-1]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), window)
    return np.concatenate(([0], np.minimum(first, np.minimum(sizes[1:], sizes[:-1]))))


def bytes_before(heads: list[bytes], width: int) -> np.ndarray:
    """Row o: the byte o + 1 places before each sample (0 where there is none)."""
    flat = np.frombuffer(b"".join(h.rjust(width, b"\0") for h in heads), np.uint8).reshape(len(heads), width)
    return np.ascontiguousarray(flat[:, ::-1].T)


class Sorter:
    """Spans of the repeated strings of shards, whose regions come sorted by shard and sample suffix."""

    def __init__(self, window: int, in_memory: int):
        self.window, self.in_memory = window, in_memory

    def spans(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        """``rows``: key, sample suffix, bytes before it, doc, th, first."""
        batch: list[tuple] = []
        shard: list[tuple] = []
        for row in rows:
            if shard and shard[0][0] != row[0]:
                batch += shard
                shard = []
                if len(batch) >= self.in_memory:
                    yield from self.together(batch)
                    batch = []
            shard.append(row)
            if len(shard) > self.in_memory:
                key = row[0]
                big = _Spilled(self.window, self.in_memory)
                big.take(shard)
                shard = []
                for row in rows:
                    if row[0] != key:
                        shard = [row]
                        break
                    big.add(row)
                yield from big.spans()
        batch += shard
        if batch:
            yield from self.together(batch)

    def together(self, batch: list[tuple]) -> Iterator[tuple]:
        keys, samples, heads, doc, th, first = map(list, zip(*batch, strict=True))
        key = np.array(keys)
        start = np.concatenate(([True], key[1:] != key[:-1]))
        lcp = np.where(start, 0, common_prefixes(samples, self.window))
        back = np.fromiter(map(len, heads), np.int64, len(heads))
        marks, offset = Marks(doc, th, first, back, self.window), 0
        for marked in induce(np.cumsum(start), lcp, back, bytes_before(heads, max(1, int(back.max()))), self.window):
            yield from marks.step(offset, marked)
            offset += 1
        yield from marks.step(offset, np.zeros(len(back), bool))


class _Spilled:
    """A shard whose bytes, places and queues lie in scratch files that vanish with the task."""

    def __init__(self, window: int, block: int):
        self.window, self.block = window, block
        self.folder = tempfile.TemporaryDirectory(prefix="suffix-sort-")
        self.files = {n: open(f"{self.folder.name}/{n}", "w+b") for n in ("lcp", "back", "before", "doc", "null", "th", "first")}
        self.pending: list[tuple] = []
        self.last: bytes | None = None
        self.n = 0

    def take(self, rows: list[tuple]) -> None:
        for row in rows:
            self.add(row)

    def add(self, row: tuple) -> None:
        self.pending.append(row)
        if len(self.pending) >= self.block:
            self._flush()

    def _flush(self) -> None:
        _, samples, heads, doc, th, first = zip(*self.pending, strict=True)
        chained = [self.last, *samples] if self.last is not None else list(samples)
        lcp = common_prefixes(chained, self.window)[-len(samples) :]
        values = {
            "lcp": lcp, "back": [len(h) for h in heads], "doc": [d or 0 for d in doc], "null": [d is None for d in doc], "th": th, "first": first,
        }
        for name, column in values.items():
            self.files[name].write(np.asarray(column, np.int64).tobytes())
        self.files["before"].write(b"".join(h[::-1].ljust(self.window, b"\0") for h in heads))
        self.last, self.n, self.pending = samples[-1], self.n + len(samples), []

    def spans(self) -> Iterator[tuple]:
        if self.pending:
            self._flush()
        at = {}
        for name, f in self.files.items():
            f.flush()
            shape = (self.n, self.window) if name == "before" else (self.n,)
            at[name] = np.memmap(f, np.uint8 if name == "before" else np.int64, "r", shape=shape)
        turned = np.memmap(f"{self.folder.name}/turned", np.uint8, "w+", shape=(self.window, self.n))
        for i in range(0, self.n, self.block):
            turned[:, i : i + self.block] = at["before"][i : i + self.block].T
        marks, offset = Marks(_Docs(at["doc"], at["null"]), at["th"], at["first"], at["back"], self.window), 0
        for marked in induce_on_disk(at["lcp"], at["back"], turned, self.window, self.block):
            yield from marks.step(offset, marked)
            offset += 1
        yield from marks.step(offset, np.zeros(self.n, bool))
        for f in self.files.values():
            f.close()
        self.folder.cleanup()


class _Docs:
    """Ids in a scratch file, null ones included."""

    def __init__(self, ids: np.ndarray, null: np.ndarray):
        self.ids, self.null = ids, null

    def __getitem__(self, i: int) -> int | None:
        return None if self.null[i] else int(self.ids[i])


def shard_rows(texts: DataFrame, window: int) -> DataFrame:
    """key, sample suffix, bytes before it, doc, th, first of each listed region."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc, th, text, regions in rows:
            for r in regions:
                key, first, place = r["key"], r["first"], r["first"] + r["back"]
                yield key, text[place : first + r["more"] + window], text[first:place], doc, th, first

    fields = [("key", "long", pa.int64()), ("sample", "binary", pa.binary()), ("head", "binary", pa.binary()), ("doc", "long", pa.int64()), ("th", "int", pa.int32()), ("first", "int", pa.int32())]
    return map_texts(texts, run, fields, "doc", "th", "text", "list")


def shard_spans(shards: DataFrame, window: int, in_memory: int = IN_MEMORY) -> DataFrame:
    """Spans (doc, th, start, stop) of the strings that occur twice in a shard."""
    dealt = shards.repartition("key").sortWithinPartitions("key", "sample")

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        yield from Sorter(window, in_memory).spans(rows)

    fields = [("doc", "long", pa.int64()), ("th", "int", pa.int32()), ("start", "int", pa.int32()), ("stop", "int", pa.int32())]
    return map_texts(dealt, run, fields, "key", "sample", "head", "doc", "th", "first")


def repeated_strings(spark: SparkSession, docs: DataFrame, window: int = WINDOW_BYTES, hot: int = HOT_REGIONS, in_memory: int = IN_MEMORY) -> DataFrame:
    """Spans (doc, th, start, stop; in bytes) covered by strings of ``window`` bytes that start more than once."""
    shape = Windows(window, max(1, window // 2))
    found, cell, spans = anchor_rows(docs, shape, byte_symbols), shape.grams, None
    place = F.struct("doc", "th", "first", "back", "more")
    while True:
        # sides of joins are written first where the other side may be skewed: Spark splits a join of two plain shuffles
        again = cut_lineage(spark, found.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").drop("c"))
        rows = cut_lineage(spark, found.join(again, "key"))
        kinds = cut_lineage(spark, rows.groupBy("key", "region").agg(F.count("*").alias("c"), F.min(place).alias("p")))
        whole = rows.join(kinds.filter("c > 1").select("key", "region"), ["key", "region"])
        marked = whole.select("doc", "th", F.col("first").alias("start"), (F.col("first") + F.col("more") + window).alias("stop"))

        several = cut_lineage(spark, kinds.groupBy("key").agg(F.count("*").alias("n"), F.min("c").alias("least")).filter("n > 1 AND least = 1").select("key", "n"))
        open_ = cut_lineage(spark, kinds.join(several, "key").select("key", "n", "p.*"))
        few, many = open_.filter((F.col("n") <= hot) | F.lit(cell == 1)), open_.filter(F.col("n") > hot)
        here = marked.union(shard_spans(shard_rows(with_texts(spark, docs, few, "key", "first", "back", "more"), window), window, in_memory))
        spans = here if spans is None else spans.union(here)
        if cell == 1 or many.isEmpty():
            return cut_lineage(spark, spans)
        cell = max(1, cell // PARTS)
        found = cut_lineage(spark, divided(with_texts(spark, docs, many, "key", "first", "back", "more"), window, cell, byte_symbols))


def cut(text: bytes, spans: list[dict]) -> tuple[bytes, int]:
    """The text without its spans, and the number of maximal runs that went."""
    runs, kept, at = merged(spans, len(text)), [], 0
    for start, stop in runs:
        kept.append(text[at:start])
        at = stop
    return b"".join([*kept, text[at:]]) if runs else text, len(runs)


def strip_documents(spark: SparkSession, docs: DataFrame, window: int = WINDOW_BYTES) -> DataFrame:
    """``docs`` with the repeated strings cut out of the texts; a character that is cut in two goes whole."""

    def judge():
        return lambda text, spans: cut(text, spans)[0].decode(errors="ignore")

    return rewrite(spark, docs, repeated_strings(spark, docs, window), judge)


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (bytes), kept_sha256."""

    def judge():
        def of(text: bytes, spans: list[dict]) -> tuple:
            left, runs = cut(text, spans)
            return len(text), len(text) - len(left), runs, left, sha256_hex(left)

        return of

    fields = [("n_bytes", "long", pa.int64()), ("n_removed", "long", pa.int64()), ("n_spans", "long", pa.int64()), ("kept", "binary", pa.binary()), ("kept_sha256", "string", pa.string())]
    return apply_spans(spark, docs, repeated_strings(spark, docs, window), judge, fields)

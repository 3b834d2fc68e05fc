"""Spelling variants from a dictionary of trie-node pairs.

Words are the maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` of the texts, A-Z lower-cased, of at least ``shortest`` code points
and with at least ``least`` occurrences.  Before counting, one run in ``every`` loses a code point, as the hash of its
document and itself says (a model of typing errors; ``every`` 0: none).

1. The words in code-point order give the forward trie, the reversed words in order the backward one.  A word adds
   as many nodes as it has code points beyond the prefix that it shares with the word before it, so nodes are numbered
   in one pass over each sorted partition; what reaches over a partition's start is a row per partition.
2. Each word gives a pair (prefix node, suffix node) for each split, and one for each position skipped.
   Equal pairs are equal words around the place, so they are exact, without a check afterwards:
   skipped and skipped: one code point replaced; skipped and split: one inserted or deleted.  If a run of
   equal code points can lose any of them, only its first position counts.
3. The rows of a pair are one word at most that is split there, and words that differ only at one position: no
   more than there are letters (90).  Each row gets the number of its neighbours in the pair and the best of them;
   no pairs are emitted.  A word's rows are then summed.
4. A word's form is its near word of largest n (ties: first in code-point order), if that has ``ratio`` times its n.
   Forms lead to ever larger n, so roots come from a few doublings of the form table.

A null text has no words; a null id hashes as an empty one.  Repeated rows count each time.  Very long texts are read
whole, and words of any length are numbered.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govframe.llm.common import arrow_map, as_bytes, batches_of, cut_lineage, map_texts, rows_of
from govframe.llm.grouped import starts_of, whole_groups

#: Different words that a task counts at once.
HELD = 400_000
SPLIT, SKIP, FIRST_SKIP = 0, 1, 2


@dataclass(frozen=True)
class SpellingPolicy:
    """Least code points and occurrences of a word, how much more frequent its form is, and one run in how many is garbled."""

    shortest: int = 7
    least: int = 2
    ratio: int = 10
    every: int = 31


def word_counts(docs: DataFrame, policy: SpellingPolicy) -> DataFrame:
    """(word, n) of the words of all texts."""
    letters = re.compile(f"[a-z\\u00C0-\\u00FF]{{{max(1, policy.shortest)},}}")  # shorter runs cannot give a word

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: Counter = Counter()
        for doc, text in rows:
            if not text:
                continue
            prefix = f"{'' if doc is None else doc}:"
            for word, n in Counter(letters.findall(text.lower().decode())).items():
                h = zlib.crc32((prefix + word).encode()) if policy.every else 1
                if policy.every and h % policy.every == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
                    if len(word) < policy.shortest or not word:
                        continue
                held[word] += n
            if len(held) >= HELD:
                yield from held.items()
                held.clear()
        yield from held.items()

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes().alias("text"))
    counted = map_texts(kept, run, [("word", "string", pa.string()), ("n", "long", pa.int64())], "doc_id", "text")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= policy.least)


def common_prefix(a: str, b: str) -> int:
    """Code points that both begin with."""
    for i, (x, y) in enumerate(zip(a, b, strict=False)):
        if x != y:
            return i
    return min(len(a), len(b))


class Trie:
    """Numbers of the nodes of words that come in order; the root is 0, and numbers from ``base`` are given out."""

    def __init__(self, base: int, word: str = "", path: list[int] | None = None):
        self.next, self.word, self.path = base, word, path or [0]

    def add(self, word: str) -> list[int]:
        """Node of each prefix of the word, the empty one first."""
        same = common_prefix(self.word, word)
        grown = len(word) - same
        self.path = self.path[: same + 1] + list(range(self.next, self.next + grown))
        self.next, self.word = self.next + grown, word
        return self.path


def trie_nodes(spark: SparkSession, words: DataFrame, column: str, also: list[str]) -> DataFrame:
    """``column`` and ``also``, the rank of each word among all (from 0), and the nodes of its prefixes by length."""
    ordered = cut_lineage(spark, words.select(column, *also).repartitionByRange(column).sortWithinPartitions(column))
    ends = [("part", "int", pa.int32()), ("rows", "long", pa.int64()), ("first", "string", pa.string()), ("last", "string", pa.string()), ("nodes", "long", pa.int64()), ("path", "array<long>", pa.list_(pa.int64()))]

    def survey(rows: Iterator[tuple]) -> Iterator[tuple]:
        trie, first, n = Trie(1), None, 0
        for (word,) in rows:
            first, n = first if n else word, n + 1
            trie.add(word)
        if n:
            yield TaskContext.get().partitionId(), n, first, trie.word, trie.next - 1, trie.path

    start: dict[int, tuple[int, Trie]] = {}
    rank, before = 0, Trie(1)
    for part in sorted(map_texts(ordered, survey, ends, column).collect()):  # a row per partition
        start[part.part] = (rank, before)
        same = common_prefix(before.word, part.first)
        # numbers as the partition gave them: the first word's nodes came first, and those that it shares have numbers already
        path = [0, *(before.path[x] if x <= same else before.next + x - same - 1 for x in part.path[1:])]
        rank, before = rank + part.rows, Trie(before.next + part.nodes - same, part.last, path)

    given = {p: (at, trie.next, trie.word, trie.path) for p, (at, trie) in start.items()}
    kinds = {f.name: f.dataType.simpleString() for f in ordered.schema.fields}
    out = pa.schema([(column, pa.string()), *((a, pa.int64()) for a in also), ("rank", pa.int64()), ("nodes", pa.list_(pa.int64()))])
    if any(kinds[a] != "bigint" for a in also):
        raise ValueError("columns that go along are numbers")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, *rest = given.get(TaskContext.get().partitionId(), (0, 1, "", [0]))
        trie = Trie(*rest)

        def rows() -> Iterator[tuple]:
            for i, (word, *others) in enumerate(rows_of(batches, column, *also)):
                yield (word, *others, at + i, trie.add(word))

        yield from batches_of(rows(), out)

    return arrow_map(ordered, number, ", ".join([f"`{column}` string", *(f"`{a}` long" for a in also), "rank long", "nodes array<long>"]))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the offsets of its rows."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy()[offsets[0] : offsets[-1]], offsets - offsets[0]


def node_pairs(words: DataFrame) -> DataFrame:
    """(p, s, n, id, role) of each split and each skipped position; ``words``: id, n, word, prefixes, suffixes (nodes by length)."""
    names = ("p", "s", "n", "id", "role")
    schema = pa.schema([(x, pa.int64()) for x in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n = (batch.column(i).to_numpy() for i in (0, 1))
            text = batch.column(2).to_pylist()
            (before, at), (after, _) = _flat(batch.column(3)), _flat(batch.column(4))
            points = np.frombuffer(" ".join([*text, ""]).encode("utf-32-le"), np.uint32)  # a space after each word: its rows line up with the nodes
            owner = np.repeat(np.arange(len(ids)), np.diff(at))
            depth = np.arange(len(before)) - at[owner]
            long = np.diff(at)[owner] - 1
            split = (before, after[at[owner] + long - depth])
            skips = np.flatnonzero(depth < long)
            skipped = (before[skips], after[(at[owner] + long - depth - 1)[skips]])
            same = np.zeros(len(points), bool)
            same[1:] = points[1:] == points[:-1]
            role = np.where((depth > 0) & same, SKIP, FIRST_SKIP)[skips]
            for (p, s), who, what in ((split, owner, np.zeros(len(owner), np.int64)), (skipped, owner[skips], role)):
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (p, s, n[who], ids[who], what)], schema=schema)

    return arrow_map(words, run, ", ".join(f"{x} long" for x in names))


def near_in_groups(p: np.ndarray, s: np.ndarray, n: np.ndarray, ids: np.ndarray, role: np.ndarray) -> tuple[np.ndarray, ...]:
    """(id, near words, their largest n, its first id) of the rows with near words; rows come by pair, falling n, and id."""
    starts = starts_of([p, s])
    sizes = np.diff(np.append(starts, len(p)))
    group = np.repeat(np.arange(len(starts)), sizes)
    skip, canonical = role != SPLIT, role == FIRST_SKIP

    def ordinal(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the mask per group, and the row index of the k-th masked row over all groups."""
        return np.add.reduceat(mask, starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64), np.append(np.flatnonzero(mask), [0, 0])

    skips, skip_rows = ordinal(skip)
    firsts, first_rows = ordinal(canonical)
    splits, split_rows = ordinal(~skip)
    first_skip = skip_rows[(np.cumsum(skips) - skips)[group]]
    second_skip = skip_rows[np.minimum((np.cumsum(skips) - skips)[group] + 1, len(skip_rows) - 1)]
    best_first = first_rows[(np.cumsum(firsts) - firsts)[group]]
    the_split = split_rows[(np.cumsum(splits) - splits)[group]]
    row = np.arange(len(p))

    replaced = np.where(skip, skips[group] - 1, 0)
    other = np.where(first_skip == row, second_skip, first_skip)
    shorter = np.where(canonical, splits[group], 0)
    longer = np.where(skip, 0, firsts[group])
    count = replaced + shorter + longer
    best_n, best_id = np.full(len(p), -1), np.full(len(p), -1)
    for has, at in ((replaced > 0, other), (shorter > 0, the_split), (longer > 0, best_first)):
        better = has & ((n[at] > best_n) | ((n[at] == best_n) & (ids[at] < best_id)))
        best_n, best_id = np.where(better, n[at], best_n), np.where(better, ids[at], best_id)
    kept = count > 0
    return ids[kept], count[kept], best_n[kept], best_id[kept]


def near_words(pairs: DataFrame) -> DataFrame:
    """(id, n_near, best_n, best): the near words of each word that has any."""
    schema = pa.schema([(x, pa.int64()) for x in ("id", "n_near", "best_n", "best")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in whole_groups(batches, 2):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in near_in_groups(*columns)], schema=schema)

    ordered = pairs.repartition("p", "s").sortWithinPartitions("p", "s", F.col("n").desc(), "id")
    found = arrow_map(ordered, run, "id long, n_near long, best_n long, best long")
    top = F.max(F.struct("best_n", (-F.col("best")).alias("minus")))
    return found.groupBy("id").agg(F.sum("n_near").alias("n_near"), top.alias("top")).select("id", "n_near", "top.best_n", (-F.col("top.minus")).alias("best"))


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """(id, root): the last word that the forms (id, form) lead to."""
    reach = cut_lineage(spark, forms.select("id", F.col("form").alias("root")))
    while True:  # n grows tenfold on each step, so five doublings are enough for any count
        on = reach.select(F.col("id").alias("root"), F.col("root").alias("next"))
        further = cut_lineage(spark, reach.join(on, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        reach = further.select("id", "root")
        if further.filter("moved").isEmpty():
            return reach


def spelling_variants(spark: SparkSession, docs: DataFrame, policy: SpellingPolicy = SpellingPolicy()) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    if policy.ratio < 2:
        raise ValueError("a form has at least twice the occurrences of its variant")
    counted = cut_lineage(spark, word_counts(docs, policy))
    # the rank in code-point order is the word's number
    words = cut_lineage(spark, trie_nodes(spark, counted, "word", ["n"]).select(F.col("rank").alias("id"), "n", "word", F.col("nodes").alias("prefixes")))
    backward = trie_nodes(spark, words.select(F.reverse("word").alias("back"), "id"), "back", ["id"]).select("id", F.col("nodes").alias("suffixes"))
    both = words.join(backward, "id").select("id", "n", "word", "prefixes", "suffixes")
    near = cut_lineage(spark, near_words(node_pairs(both)))

    words = words.select("id", "n", "word")
    judged = words.join(near, "id", "left").withColumn("form_id", F.when(F.col("best_n") >= policy.ratio * F.col("n"), F.col("best")))
    judged = cut_lineage(spark, judged.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_id"))
    last = roots(spark, judged.filter("form_id IS NOT NULL").select("id", F.col("form_id").alias("form")))
    # few words have a form: their rows meet the words once for the form and once for the root
    named = judged.filter("form_id IS NOT NULL").join(last, "id")
    for column, name, more in (("form_id", "form", [F.col("n").alias("form_n")]), ("root", "root_word", [])):
        named = named.join(words.select(F.col("id").alias(column), F.col("word").alias(name), *more), column)
    out = ("word", "form", "root", "n", "n_near", "form_n")
    named = named.drop("root").withColumnRenamed("root_word", "root").select(*out)
    alone = judged.filter("form_id IS NULL").select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", F.lit(None).cast("long").alias("form_n"))
    return alone.union(named)

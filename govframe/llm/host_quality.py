"""Host-level quality rules.

Each document is measured and judged by per-document rules.  The failures are then counted by host
(the ``source`` column); a host's failure rate, of each rule and of any rule, is shrunk towards the rate of all
hosts by a beta prior that is fitted to the hosts themselves, and a host with a shrunk rate from the limit on loses
all its documents.  Small hosts stay near the prior, so few documents cannot condemn a host.

Words are runs of ``[^\\x20\\x09-\\x0D]``.  Null and empty texts have no words and fail the base rule.
Rows with a null host form no host: they are judged alone.  Repeated rows count as often as they
occur.  Empty input gives no rows.  Counting by host is pre-aggregated before its shuffle, and the
join back has one row per host on one side, so a host with a third of all rows can be split.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from govframe.llm.common import arrow_map, as_bytes, cut_lineage, map_texts

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
#: Rules that are counted by host; each names a column of ``failures``.
RULES = ("short", "repetitive", "symbols", "dup_lines", "word_length", "any")


@dataclass(frozen=True)
class HostPolicy:
    """``limit``: shrunk failure rate from which a host is rejected.
    ``weakest``, ``strongest``: bounds of the prior's weight in documents."""

    limit: float = 0.9
    weakest: float = 2.0
    strongest: float = 1000.0


def measure(text: bytes | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.split()
    n = len(words)
    packed = text.translate(None, SPACES)
    chars = len(packed) if packed.isascii() else len(packed.decode())
    symbols = len(packed) - len(packed.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    repeats = 0
    if n >= 3:
        seen: dict[bytes, int] = {}
        ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
        pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)[1]
        _, inverse, counts = np.unique(pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)
        again = counts[inverse] > 1
        mask = np.zeros(n, bool)
        for i in range(3):
            mask[i : n - 2 + i] |= again
        repeats = int(mask.sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeats


def document_metrics(docs: DataFrame) -> DataFrame:
    """doc_id, host and the five measures of each row."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc, host, text in rows:
            yield doc, host, *measure(text)

    long = [(n, "long", pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("host"), as_bytes().alias("text"))
    return map_texts(kept, run, [("doc_id", "long", pa.int64()), ("host", "string", pa.string()), *long], "doc_id", "host", "text")


def failures() -> dict[str, Column]:
    """Condition of each rule, in whole numbers."""
    words = F.col("n_words")
    each = {
        "short": words < 50,
        "repetitive": 100 * F.col("n_repeat_words") > 50 * words,
        "symbols": 10 * F.col("n_symbols") > 3 * words,
        "dup_lines": 2 * F.col("n_dup_lines") > words,
        "word_length": (words > 0) & ((F.col("word_chars") < 2 * words) | (F.col("word_chars") > 25 * words)),
    }
    return {**each, "any": reduce(Column.__or__, each.values())}


def host_verdicts(judged: DataFrame, policy: HostPolicy) -> DataFrame:
    """One row per host: n_docs, the failures and shrunk rate of each rule, host_rejected."""
    hosts = judged.filter(F.col("host").isNotNull()).groupBy("host").agg(F.count("*").alias("n_docs"), *(F.sum(F.col(f"fail_{r}").cast("long")).alias(f"n_{r}") for r in RULES))
    sums = [F.count("*").alias("hosts"), F.sum("n_docs").alias("docs")]
    for r in RULES:
        rate = F.col(f"n_{r}") / F.col("n_docs")
        sums += [F.sum(f"n_{r}").alias(f"sum_{r}"), F.avg(rate).alias(f"mean_{r}"), F.coalesce(F.var_samp(rate), F.lit(0.0)).alias(f"var_{r}")]
    total = hosts.agg(*sums, F.avg(1 / F.col("n_docs")).alias("noise")).first()  # one row, whatever the number of hosts
    shrunk = {}
    for r in RULES:
        a, b = beta_prior(total, r, policy)
        shrunk[r] = (F.col(f"n_{r}") + F.lit(a)) / (F.col("n_docs") + F.lit(a + b))
    worst = F.greatest(*shrunk.values())
    return hosts.select("*", *(c.alias(f"rate_{r}") for r, c in shrunk.items()), (worst >= policy.limit).alias("host_rejected"))


def beta_prior(total, rule: str, policy: HostPolicy) -> tuple[float, float]:
    """Beta parameters by moments: the spread of host rates beyond what counting alone would give."""
    if not total["hosts"]:
        return 1.0, 1.0
    m = min(max(total[f"mean_{rule}"], 1e-6), 1 - 1e-6)
    spread = total[f"var_{rule}"] - m * (1 - m) * total["noise"]
    weight = m * (1 - m) / spread - 1 if spread > 0 else policy.strongest
    weight = min(max(weight, policy.weakest), policy.strongest)
    return m * weight, (1 - m) * weight


def judge(spark: SparkSession, docs: DataFrame, policy: HostPolicy = HostPolicy()) -> DataFrame:
    """One row per row of ``docs``: doc_id, host, the measures, base_failed, host_rejected, kept."""
    measured = document_metrics(docs)
    rules = failures()
    judged = cut_lineage(spark, measured.select("*", *(c.alias(f"fail_{r}") for r, c in rules.items())))
    # written first: beside its aggregate in one stage, Spark could not split a host with a third of the documents
    hosts = cut_lineage(spark, host_verdicts(judged, policy).select("host", "host_rejected"))
    base = F.col("fail_short") | F.col("fail_repetitive")
    out = judged.join(hosts, "host", "left").withColumn("host_rejected", F.coalesce("host_rejected", F.lit(False)))
    return out.select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "host_rejected", (~base & ~F.col("host_rejected")).alias("kept"))


#: Rejected hosts up to this number are broadcast to the documents; more meet them in a shuffled join.
BROADCAST_HOSTS = 100_000


def keep_documents(spark: SparkSession, docs: DataFrame, policy: HostPolicy = HostPolicy()) -> DataFrame:
    """``docs`` without the rows that fail the base rules and without those of rejected hosts."""
    judged = cut_lineage(spark, document_metrics(docs).select("host", *(c.alias(f"fail_{r}") for r, c in failures().items())))
    rejected = cut_lineage(spark, host_verdicts(judged, policy).filter("host_rejected").select(F.col("host").alias("_host")))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            passed = []
            for start in range(0, batch.num_rows, 256):
                for text in batch.column(at).slice(start, 256).cast(pa.binary()).to_pylist():
                    n_words, _, _, _, n_repeat_words = measure(text)
                    passed.append(n_words >= 50 and 100 * n_repeat_words <= 50 * n_words)
            yield batch.filter(pa.array(passed, pa.bool_()))

    good = arrow_map(docs, run, docs.schema)
    n = rejected.count()
    if not n:
        return good
    return good.join(F.broadcast(rejected) if n <= BROADCAST_HOSTS else rejected, good["source"].cast("string") == rejected["_host"], "left_anti")

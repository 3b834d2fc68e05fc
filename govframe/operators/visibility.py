"""Policies as bitmaps (J-9): which rows of a table each policy shows, kept so that any set of them combines by bits.

The rows are numbered in the order of their subject, once.  A subject's rows are then one range of
numbers, so the session policy needs no bitmap at all, and each attribute policy is a bitmap of one
bit per row, cut into buckets of 32,768 rows (4 KB).  All policies are evaluated in one pass.  To ask
what several policies show together, their bitmaps are ANDed per bucket, and the bits in each
subject's range are counted; the protected table is not read again and no join is made per policy.

* A policy shows a row only when its condition is TRUE (NULL hides, as in ``rls_flag``).
* Rows with a NULL subject belong to nobody's range.  A subject without rows counts 0.
* Repeated rows count as often as they occur.  An empty table gives no bitmaps and counts of 0.
* A subject with a third of all rows is one range over many buckets: its counting is spread by bucket.
* Size: an eighth of a byte per row and policy, and one row per subject.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from govframe.operators.numbering import global_row_number
from govframe.operators.security import usable_sessions

#: Rows of a bucket: fixed by Spark's bitmap functions.
BUCKET = 32_768


@dataclass(frozen=True)
class PolicyBitmaps:
    """Stored bitmaps: ``bits(policy, bucket, bits)`` and ``ranges(subject, first, last)``, numbers from 1."""

    path: str
    policies: tuple[str, ...]

    def bits(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/bits")

    def ranges(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/ranges")


def write_policy_bitmaps(df: DataFrame, subject_col: str, policies: Mapping[str, Column], path: str) -> PolicyBitmaps:
    """Evaluate ``policies`` (name -> row condition) over ``df`` once and store their bitmaps under ``path``."""
    names = tuple(policies)
    flags = [F.coalesce(c, F.lit(False)).alias(f"p{i}") for i, c in enumerate(policies.values())]
    narrow = df.select(F.col(subject_col).alias("subject"), *flags).filter(F.col("subject").isNotNull())
    # rows alike in subject and flags may come in any order: the numbering is checkpointed before it is read
    numbered = global_row_number(narrow, ["subject", *[f"p{i}" for i in range(len(names))]], out="id")
    numbered.groupBy("subject").agg(F.min("id").alias("first"), F.max("id").alias("last")).write.parquet(f"{path}/ranges")
    position = F.bitmap_bit_position("id")
    maps = numbered.groupBy(F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), *(F.bitmap_construct_agg(F.when(F.col(f"p{i}"), position)).alias(f"b{i}") for i in range(len(names))))
    entry = [F.struct(F.lit(n).alias("policy"), F.col(f"b{i}").alias("bits")) for i, n in enumerate(names)]
    if entry:
        maps = maps.select("bucket", F.explode(F.array(*entry)).alias("e")).select("e.policy", "bucket", "e.bits")
    else:
        maps = maps.select(F.lit("").alias("policy"), "bucket", F.lit(b"").alias("bits")).limit(0)
    maps.write.parquet(f"{path}/bits")
    return PolicyBitmaps(path, names)


def combined(bits: DataFrame, sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per bucket, one bitmap for each named set of policies: the rows that all policies of the set show."""
    wanted = sorted({p for ps in sets.values() for p in ps})
    return bits.filter(F.col("policy").isin(wanted)).groupBy("bucket").agg(
        *(F.bitmap_and_agg(F.when(F.col("policy").isin(list(ps)), F.col("bits"))).alias(name) for name, ps in sets.items() if ps))


def _ones_before(bits: str, end: str) -> Column:
    """Set bits among the first ``end`` of a bitmap: whole bytes, then the low bits of the next."""
    return F.expr(
        f"bitmap_count(substring({bits}, 1, {end} div 8)) + "
        f"coalesce(bit_count(cast(conv(hex(substring({bits}, {end} div 8 + 1, 1)), 16, 10) as int) & (shiftleft(1, {end} % 8) - 1)), 0)")


def visible_to_holders(spark: SparkSession, maps: PolicyBitmaps, sessions: DataFrame, as_of,
                       sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per holder of a usable session and per set of policies, the rows that the session policy and all policies of
    the set show: ``(usuario, subject, <one count per set>)``.  An empty set leaves the session policy alone."""
    unknown = {p for ps in sets.values() for p in ps} - set(maps.policies)
    if unknown:
        raise ValueError(f"no bitmap of {sorted(unknown)}")
    held = usable_sessions(sessions, as_of).select("usuario", "subject")
    mine = maps.ranges(spark).join(held.select("subject").distinct(), "subject", "left_semi")
    spans = mine.withColumn("bucket", F.explode(F.sequence(F.bitmap_bucket_number("first"), F.bitmap_bucket_number("last"))))
    start = (F.col("bucket") - 1) * BUCKET  # numbers before the bucket
    spans = spans.select("subject", "bucket", F.greatest(F.col("first") - 1 - start, F.lit(0)).cast("int").alias("lo"),
                         F.least(F.col("last") - start, F.lit(BUCKET)).cast("int").alias("hi"))
    pieces = spans
    if any(sets.values()):
        pieces = spans.join(combined(maps.bits(spark), {n: p for n, p in sets.items()}), "bucket")
    counts = [(_ones_before(f"`{n}`", "hi") - _ones_before(f"`{n}`", "lo") if p else (F.col("hi") - F.col("lo")).cast("long")).alias(n) for n, p in sets.items()]
    per_subject = pieces.select("subject", *counts).groupBy("subject").agg(*(F.sum(n).alias(n) for n in sets))
    out = held.join(per_subject, "subject", "left")
    return out.select("usuario", "subject", *(F.coalesce(F.col(n), F.lit(0).cast("long")).alias(n) for n in sets))

"""Join-shaped predicates: EXISTS flags, correlated counts, scalar lookups (B-14, B-17, B-18, C-5).

Skew: the probe side of these joins may hold a hot key (one customer with
a third of all orders).  ``flag_exists`` and ``add_child_count`` first
collapse the other side to one row per key with a partial hash aggregate,
so the join is many-to-one and AQE's skew-join split can cut the hot
partition of the big side; ``left_join_fanout`` rewrites an outer join
whose hot side could not be split otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _rename(df: DataFrame, src: Sequence[str], dst: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(s).alias(d) for s, d in zip(src, dst)])


def flag_exists(df: DataFrame, other: DataFrame, df_keys: Sequence[str], other_keys: Sequence[str], name: str) -> DataFrame:
    """``EXISTS (SELECT 1 FROM other WHERE other.k = df.k) AS name`` as a boolean column."""
    keys = _rename(other, other_keys, df_keys).distinct().withColumn(name, F.lit(True))
    out = df.join(keys, list(df_keys), "left")
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(False))).select(*df.columns, name)


def add_child_count(parent: DataFrame, child: DataFrame, parent_keys: Sequence[str], child_keys: Sequence[str], name: str) -> DataFrame:
    """``(SELECT COUNT(*) FROM child WHERE child.fk = parent.pk) AS name``; 0 when none."""
    counts = child.groupBy(*child_keys).agg(F.count(F.lit(1)).alias(name))
    counts = counts.select(*[F.col(c).alias(p) for c, p in zip(child_keys, parent_keys)], name)
    out = parent.join(counts, list(parent_keys), "left")
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("long"))).select(*parent.columns, name)


def lookup_one(df: DataFrame, cond: Column, col: str) -> Column:
    """Scalar subquery ``(SELECT col FROM df WHERE cond)``.

    NULL when no row matches; more than one matching row is an error at
    run time, as in SQL.  Stays lazy: Spark plans it as a subquery whose
    one value can be pushed into the outer Parquet scan.
    """
    return df.filter(cond).select(col).scalar()


def left_join_fanout(small: DataFrame, big: DataFrame, small_keys: Sequence[str], big_keys: Sequence[str]) -> DataFrame:
    """``small LEFT JOIN big`` where one small row may match a huge number of big rows.

    A plain left outer join keeps ``small`` as the streamed side, so a hot
    key of ``big`` cannot be split by AQE.  Written instead as
    ``big ⋈ small`` (inner: ``big`` streamed, skew-splittable) plus the
    small rows without any match (anti join against the distinct big
    keys).  Same rows as the outer join.  A column name on both sides keeps
    its name for ``small`` and gets the suffix ``_big`` for ``big``; only a
    key that both sides name alike appears once.
    """
    shared_keys = {b for s, b in zip(small_keys, big_keys) if s == b}
    out = {c: f"{c}_big" if c in small.columns else c for c in big.columns if c not in shared_keys}
    if set(out.values()) & set(small.columns) or len(set(out.values())) < len(out):
        raise ValueError("renaming the columns that both sides have would clash")
    s, b = small.alias("_s"), big.alias("_b")
    cond = [F.col(f"_b.`{bk}`") == F.col(f"_s.`{sk}`") for sk, bk in zip(small_keys, big_keys)]
    matched = b.join(s, cond, "inner").select(
        *[F.col(f"_s.`{c}`").alias(c) for c in small.columns], *[F.col(f"_b.`{c}`").alias(n) for c, n in out.items()])
    big_keys_df = big.select(*[F.col(bk).alias(sk) for sk, bk in zip(small_keys, big_keys)]).distinct()
    unmatched = small.join(big_keys_df, list(small_keys), "left_anti")
    nulls = [F.lit(None).cast(big.schema[c].dataType).alias(n) for c, n in out.items()]
    return matched.unionByName(unmatched.select(*small.columns, *nulls))

"""History and materialised aggregates (L-3 … L-5).

``scd2`` needs, for every version, the start time of the next version of
the same key -- a ``lead`` over the key's history.  A plain
``Window.partitionBy(key)`` puts all versions of one key in one task, so a
key holding a third of all rows would serialise a third of the job.
``lead_by_key`` splits hot keys instead:

1. range-partition on (key, order): a hot key's history is cut into
   contiguous, ordered chunks that land in consecutive partitions;
2. ``lead`` inside each (partition, key) chunk -- many small windows;
3. for the last row of a chunk, take the first row of the key's next
   chunk: the per-chunk first rows are one row per (partition, key), so
   their own ``lead`` is over at most #partitions rows per key;
4. one many-to-one join on (partition, key) fills those last rows.

The frame is checkpointed after step 1 to the shared folder so that the
partition ids read in steps 2-4 are stable under task retries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from govframe.functions.tsql import ts_literal
from govframe.session import ensure_checkpoint_dir

# Fixed value: the open end of a current version.
OPEN_END = "9999-12-31 00:00:00"


def lead_by_key(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str, out: str,
                num_partitions: int | None = None) -> DataFrame:
    """``lead(value) OVER (PARTITION BY key ORDER BY order)`` without a hot-key task.

    ``order`` must be unique within a key.  NULL when there is no next row.
    """
    key, order = list(key), list(order)
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *key, *order).checkpoint(eager=True)
    located = ranged.withColumn("_pid", F.spark_partition_id())

    w = Window.partitionBy("_pid", *key).orderBy(*order)
    nxt = F.lead(F.struct(F.col(value).alias("v")), 1).over(w)
    local = located.withColumn("_next", nxt)

    chunk_first = located.groupBy("_pid", *key).agg(
        F.min(F.struct(*[F.col(o) for o in order], F.col(value).alias("v"))).alias("_first")
    )
    wk = Window.partitionBy(*key).orderBy("_pid")
    chunk_next = chunk_first.select(
        "_pid", *key, F.lead(F.struct(F.col("_first.v").alias("v")), 1).over(wk).alias("_chunk_next")
    )
    # NULL keys form one group, as in a window's PARTITION BY: match them null-safely
    nxt_side = chunk_next.select(F.col("_pid").alias("_npid"), *[F.col(k).alias(f"_nk{i}") for i, k in enumerate(key)],
                                 "_chunk_next")
    cond = [F.col("_pid") == F.col("_npid")] + [F.col(k).eqNullSafe(F.col(f"_nk{i}")) for i, k in enumerate(key)]
    joined = local.join(nxt_side, cond, "left").drop("_npid", *[f"_nk{i}" for i in range(len(key))])
    filled = F.coalesce(F.col("_next"), F.col("_chunk_next"))
    return joined.withColumn(out, filled.getField("v")).drop("_pid", "_next", "_chunk_next")


def scd2(changes: DataFrame, key: Sequence[str], ts: str, tiebreak: Sequence[str], attrs: Sequence[str],
         valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """System-versioned history from a change stream.

    Each change opens a version ``[ts, next ts of the same key)``; the
    latest version is open until 9999-12-31 (half-open intervals, so
    versions of a key never overlap).
    """
    key, tiebreak = list(key), list(tiebreak)
    base = changes.select(*key, *tiebreak, *attrs, F.col(ts).alias(valid_from))
    led = lead_by_key(base, key, [valid_from, *tiebreak], valid_from, "_to")
    return led.withColumn(valid_to, F.coalesce(F.col("_to"), ts_literal(OPEN_END))).drop("_to")


def current_view(history: DataFrame, valid_to: str = "valid_to") -> DataFrame:
    """Current rows of a versioned table (the default projection hides the period)."""
    return history.filter(F.col(valid_to) == ts_literal(OPEN_END))


def scd2_apply(current: DataFrame, history: DataFrame, batch: DataFrame, key: Sequence[str], as_of,
               op_col: str = "op") -> tuple[DataFrame, DataFrame]:
    """Apply an update/delete batch to (current, history).

    ``current``: key, attributes, ``valid_from``.  ``history``: the same plus
    ``valid_to``.  ``batch``: key, ``op`` (``U`` upsert / ``D`` delete) and
    the new attributes, one row per key.  Changed or deleted keys close
    their current version at ``as_of`` into the history; upserts open a
    new current version from ``as_of``.  The current table only meets the
    batch keys (semi / anti join), which AQE broadcasts for a small batch.
    """
    key = list(key)
    t = as_of if isinstance(as_of, Column) else ts_literal(str(as_of))
    attrs = [c for c in current.columns if c not in key and c != "valid_from"]
    b = batch.select(*key, F.col(op_col).alias("_op"), *attrs)
    touched_keys = b.select(*key)
    # Untouched rows: an anti-join against the batch keys (broadcast when the
    # batch is small), so the current table is scanned, not shuffled.
    kept = current.join(touched_keys, key, "left_anti").select(*key, *attrs, "valid_from")
    closed = current.join(touched_keys, key, "left_semi").select(*key, *attrs, "valid_from", t.alias("valid_to"))
    opened = b.filter(F.col("_op") == "U").select(*key, *attrs, t.alias("valid_from"))
    new_current = kept.unionByName(opened)
    new_history = history.unionByName(closed.select(*history.columns))
    return new_current, new_history


def scd2_merge(current: DataFrame, history: DataFrame, changes: DataFrame, key: Sequence[str], ts: str, tiebreak: Sequence[str],
               op_col: str = "op") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Merge any number of changes per key into (current, history): ``(current, history, late)``.

    ``current``: key, attributes, ``valid_from``, one row per key.  ``history``: the same plus ``valid_to``.  ``changes``: key, ``ts``,
    ``tiebreak`` (unique within key and time, not NULL), ``op`` (``U`` upsert / ``D`` delete) and the attributes.

    The changes of a key are one run with its current version in front: each ``U`` opens a version that
    ends where the next change begins, each ``D`` only ends one.  The version that nothing ends is current, the others are
    history.  Of several changes at one time the last one counts; the versions before it would have no
    length and are dropped.  A change before its key's current version, or without a time, is ``late``: it is
    returned as it came and changes nothing.

    The current table meets the changes' keys only (semi and anti join); the fold is ``lead_by_key``, which cuts a key with very
    many changes into ranges of time.
    """
    key, tiebreak = list(key), list(tiebreak)
    attrs = [c for c in current.columns if c not in key and c != "valid_from"]
    touched = changes.select(*key).distinct()
    kept = current.join(touched, key, "left_anti").select(*key, *attrs, "valid_from")
    running = current.join(touched, key, "left_semi").select(*key, *attrs, "valid_from")

    since = running.select(*key, F.col("valid_from").alias("_since"))
    dated = changes.join(since, key, "left")
    is_late = F.col(ts).isNull() | F.coalesce(F.col(ts) < F.col("_since"), F.lit(False))
    late = dated.filter(is_late).select(*changes.columns)
    events = dated.filter(~is_late).select(*key, *attrs, F.col(ts).alias("valid_from"), F.col(op_col).alias("_op"), F.lit(1).alias("_turn"), *tiebreak)
    first = running.select(*key, *attrs, "valid_from", F.lit("U").alias("_op"), F.lit(0).alias("_turn"),
                           *[F.lit(None).cast(changes.schema[t].dataType).alias(t) for t in tiebreak])
    led = lead_by_key(first.unionByName(events), key, ["valid_from", "_turn", *tiebreak], "valid_from", "valid_to")
    versions = led.filter((F.col("_op") == "U") & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))))
    new_current = kept.unionByName(versions.filter(F.col("valid_to").isNull()).select(*key, *attrs, "valid_from"))
    closed = versions.filter(F.col("valid_to").isNotNull()).select(*key, *attrs, "valid_from", "valid_to")
    return new_current, history.unionByName(closed.select(*history.columns)), late


def refresh_counts(stored: DataFrame, inserted: DataFrame, deleted: DataFrame, key: Sequence[str],
                   total: str = "total") -> tuple[DataFrame, DataFrame]:
    """Incremental maintenance of ``COUNT(*) GROUP BY key``.

    Stored counts plus signed delta counts (inserted rows +1, deleted rows
    −1), summed per key; groups that reach zero disappear.  Deltas are
    pre-aggregated per key before the union, so a hot key is one row.
    Returns ``(refreshed, negative)``: keys whose count would go below
    zero (a delete of rows that were never counted) are reported, not
    stored.
    """
    key = list(key)
    plus_ = inserted.groupBy(*key).agg(F.count(F.lit(1)).alias(total))
    minus = deleted.groupBy(*key).agg((-F.count(F.lit(1))).alias(total))
    merged = stored.select(*key, F.col(total).cast("long").alias(total)).unionByName(plus_).unionByName(minus)
    summed = merged.groupBy(*key).agg(F.sum(total).cast("long").alias(total))
    return summed.filter(F.col(total) > 0), summed.filter(F.col(total) < 0)

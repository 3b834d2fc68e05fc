"""Writing governed tables: appends, idempotent seeds, versions, snapshots.

Tables are immutable Parquet versions: a change is a DataFrame transform
whose result is written to a new ``v=<n>`` folder, never over the folder
being read.  (No table-format jar is available; a lake-house table format
would replace the version folders one for one.)
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from govframe.operators.constraints import apply_defaults, keys_present
from govframe.schemas import ACADEMY

ColumnOrValue = Column | object


# ------------------------------------------------------------- appends ----

def append(target: DataFrame, new_rows: DataFrame, defaults: Mapping[str, ColumnOrValue] | None = None) -> DataFrame:
    """``INSERT … VALUES`` / ``INSERT … SELECT``: target plus new rows.

    Columns missing from ``new_rows`` take their DEFAULT (or NULL when
    none is declared); an explicit NULL in ``new_rows`` is kept.
    """
    filled = apply_defaults(new_rows, defaults or {}, target.schema)
    return target.unionByName(filled.select(*[F.col(f.name).cast(f.dataType) for f in target.schema]))


def insert_if_absent(target: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Idempotent seed: add candidate rows whose key is not in the target.

    Only target keys that occur among the candidates are looked at (a
    semi-join AQE can broadcast when the batch is small), then one anti-join.  Candidates that
    share a key with each other are all kept (a later PK check reports
    them), exactly like a multi-row insert would fail on them.
    """
    existing = keys_present(target, candidates, keys)
    fresh = candidates.join(existing, list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


# ------------------------------------------------------------ versions ----

def write_version(df: DataFrame, table_dir: str, version: int, partition_by: Sequence[str] = (),
                  sort_within: Sequence[str] = ()) -> str:
    """Write ``df`` as version ``version`` of a table and return the path.

    ``sort_within`` sorts each file by those columns (no shuffle): the
    index-like layout that makes Parquet min/max statistics selective, so
    range filters on them skip row groups.
    """
    path = f"{table_dir.rstrip('/')}/v={version}"
    if sort_within:
        df = df.sortWithinPartitions(*partition_by, *sort_within)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, base_path: str,
                   sort: bool = True) -> DataFrame:
    """Write ``df`` as a table bucketed (and sorted) on ``keys`` and return it.

    Two tables bucketed the same way on their join key join without a
    shuffle; against a bucketed table only the other side is shuffled.
    That co-locates the joins a governed model repeats, such as
    enrolments with orders, or a table with its snapshots.  Files live
    under ``base_path/name`` (shared storage); the table is registered in
    the session catalogue under ``name``.  A join without a shuffle has no
    stage for AQE's skew split, so bucket on keys without a dominant value.
    """
    writer = df.write.mode("errorifexists").bucketBy(buckets, *keys)
    if sort:
        writer = writer.sortBy(*keys)
    writer.option("path", f"{base_path.rstrip('/')}/{name}").saveAsTable(name)
    return df.sparkSession.table(name)


# ----------------------------------------------------------- snapshots ----

SNAPSHOT_LOG_SCHEMA = ACADEMY["snapshot_log"]


def _log_row(spark: SparkSession, kind: str, path: str, start: _dt.datetime, end: _dt.datetime,
             status: str, error: str | None) -> DataFrame:
    size = _size_mb(spark, path) if status == "SUCCESS" else None
    return spark.createDataFrame([(kind, path, start, end, size, status, error)], SNAPSHOT_LOG_SCHEMA)


def _size_mb(spark: SparkSession, path: str):
    """Bytes under ``path`` in MB (two decimals), from the Hadoop file system the path lives on."""
    from decimal import ROUND_HALF_UP, Decimal

    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        length = fs.getContentSummary(hpath).getLength()
    except Exception:  # noqa: BLE001 -- size is informative only
        return None
    return (Decimal(length) / Decimal(1024 * 1024)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.UTC).replace(tzinfo=None)


def snapshot_full(tables: Mapping[str, DataFrame], base_path: str, db: str, as_of: _dt.datetime,
                  parallelism: int = 4) -> tuple[dict[str, str], DataFrame]:
    """Full snapshot: every table written under one run folder, plus one run-log row.

    The folder name follows ``<db>_FULL_yyyymmdd_hhmmss``.  A failure logs
    a FAILED row with the message and is raised again; success logs
    SUCCESS.  Returns ``(table -> path, log row)``.
    """
    spark = next(iter(tables.values())).sparkSession
    run = f"{base_path.rstrip('/')}/{db}_FULL_{as_of:%Y%m%d_%H%M%S}"
    start = _now()
    paths = {name: f"{run}/{name}" for name in tables}

    def write(name: str) -> None:
        tables[name].write.mode("errorifexists").parquet(paths[name])

    try:
        # One distributed write job per table, submitted concurrently so that
        # small tables do not leave the cluster idle; no rows pass the driver.
        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(tables)))) as pool:
            for fut in [pool.submit(write, name) for name in tables]:
                fut.result()
    except Exception as exc:  # log, then re-raise
        log = _log_row(spark, "FULL", run, start, _now(), "FAILED", str(exc))
        raise SnapshotError(str(exc), log) from exc
    return paths, _log_row(spark, "FULL", run, start, _now(), "SUCCESS", None)


class SnapshotError(RuntimeError):
    def __init__(self, message: str, log: DataFrame):
        super().__init__(message)
        self.log = log


def row_fingerprint(cols: Sequence[str]) -> Column:
    """96-bit row fingerprint over the non-key columns (xxhash64 + murmur3).

    Spark's hash functions skip NULL inputs, so ``(NULL, 'x')`` and
    ``('x', NULL)`` would hash alike; each column's NULL flag is hashed too,
    which pins every value to its column.  A changed row then goes unnoticed
    only on a 96-bit collision (probability about 2^-96 per row).
    """
    parts = [*[F.col(c) for c in cols], *[F.col(c).isNull() for c in cols]]
    return F.struct(F.xxhash64(*parts).alias("h64"), F.hash(*parts).alias("h32"))


def snapshot_diff(current: DataFrame, base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Differential snapshot against the last full one.

    Rows of ``current`` that are new (``INSERT``) or whose non-key values
    changed (``UPDATE``), and keys present only in ``base`` (``DELETE``,
    other columns NULL).  Only keys and a fingerprint of ``base`` are
    shuffled; one full outer join on the key.
    """
    keys = list(keys)
    value_cols = [c for c in current.columns if c not in keys]
    cur = current.withColumn("_fp_cur", row_fingerprint(value_cols))
    old = base.select(*[F.col(k) for k in keys], row_fingerprint(value_cols).alias("_fp_old"), F.lit(True).alias("_in_old"))
    j = cur.withColumn("_in_cur", F.lit(True)).join(old, keys, "full_outer")
    kind = (
        F.when(F.col("_in_old").isNull(), F.lit("INSERT"))
        .when(F.col("_in_cur").isNull(), F.lit("DELETE"))
        .when(F.col("_fp_cur") != F.col("_fp_old"), F.lit("UPDATE"))
    )
    return (
        j.withColumn("change_kind", kind)
        .filter(F.col("change_kind").isNotNull())
        .select(*keys, *value_cols, "change_kind")
    )


def snapshot_diff_write(current: DataFrame, base: DataFrame, keys: Sequence[str], base_path: str,
                        db: str, as_of: _dt.datetime) -> tuple[str, DataFrame]:
    """Write the differential snapshot and return ``(path, log row)``."""
    spark = current.sparkSession
    path = f"{base_path.rstrip('/')}/{db}_DIFF_{as_of:%Y%m%d_%H%M%S}"
    start = _now()
    try:
        snapshot_diff(current, base, keys).write.mode("errorifexists").parquet(path)
    except Exception as exc:
        raise SnapshotError(str(exc), _log_row(spark, "DIFF", path, start, _now(), "FAILED", str(exc))) from exc
    return path, _log_row(spark, "DIFF", path, start, _now(), "SUCCESS", None)


def restore(full: DataFrame, diff: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rebuild the current table from a full snapshot plus its diff."""
    keys = list(keys)
    changed = diff.select(*keys)
    kept = full.join(changed, keys, "left_anti")
    upserts = diff.filter(F.col("change_kind") != "DELETE").drop("change_kind")
    return kept.unionByName(upserts.select(*full.columns))

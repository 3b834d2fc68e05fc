"""Audit-table appends (K-6): permission changes and failed logins.

The audit table has an IDENTITY key and DEFAULTs for the event time and
the two caller columns.  A batch of audit rows is completed with the
defaults for the columns it does not carry, numbered after the table's
current largest id (distributed numbering, no single partition) and
appended.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govframe.operators.constraints import apply_defaults
from govframe.operators.numbering import global_row_number
from govframe.operators.security import _as_of

# The two audit event types.
PERMISSION_CHANGE, LOGIN_FAILED = "PERMISSION_CHANGE", "LOGIN_FAILED"

AUDIT_SCHEMA = T.StructType([
    T.StructField("audit_id", T.LongType(), False),
    T.StructField("event_time", T.TimestampNTZType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("login_name", T.StringType(), False),
    T.StructField("database_user", T.StringType(), False),
    T.StructField("object_name", T.StringType(), True),
    T.StructField("permission_type", T.StringType(), True),
    T.StructField("success", T.BooleanType(), True),
    T.StructField("details", T.StringType(), True),
])


def permission_changes(changes: DataFrame) -> DataFrame:
    """Rows for permission changes: ``object_name, permission_type, granted[, details]``."""
    cols = [F.lit(PERMISSION_CHANGE).alias("event_type"), "object_name", "permission_type",
            F.col("granted").cast("boolean").alias("success")]
    cols += [c for c in changes.columns if c in ("details", "event_time", "_order")]
    return changes.select(*cols)


def failed_logins(attempts: DataFrame) -> DataFrame:
    """Rows for failed logins: ``login_name[, details]``; success is always false."""
    cols = [F.lit(LOGIN_FAILED).alias("event_type"), "login_name", F.lit(False).alias("success")]
    cols += [c for c in attempts.columns if c in ("details", "event_time", "_order")]
    return attempts.select(*cols)


def append_audit(audit: DataFrame | None, rows: DataFrame, caller: str | Column, as_of,
                 order: Sequence[str | Column] = ("event_time", "_order")) -> DataFrame:
    """Append audit rows: DEFAULTs for absent columns, ids after the current maximum.

    ``caller`` fills ``login_name`` / ``database_user`` when the rows do not
    carry them; ``as_of`` fills ``event_time``.  ``order`` fixes the id
    order (it must be unique; ``_order`` is a caller-supplied tie-breaker
    that is dropped afterwards).
    """
    who = caller if isinstance(caller, Column) else F.lit(caller)
    defaults = {"event_time": _as_of(as_of), "login_name": who, "database_user": who}
    filled = apply_defaults(rows, defaults)
    keep = [f.name for f in AUDIT_SCHEMA if f.name != "audit_id"]
    for name in keep:
        if name not in filled.columns:
            filled = filled.withColumn(name, F.lit(None).cast(AUDIT_SCHEMA[name].dataType))
    # IDENTITY continues after the current largest id (a scalar subquery, run once)
    top = F.lit(0) if audit is None else audit.agg(F.coalesce(F.max("audit_id"), F.lit(0))).scalar()
    start_col = top + F.lit(1)
    numbered = global_row_number(filled, list(order), out="_rn", start=0)
    new = numbered.select((start_col + F.col("_rn")).cast("long").alias("audit_id"),
                          *[F.col(n).cast(AUDIT_SCHEMA[n].dataType).alias(n) for n in keep])
    return new if audit is None else audit.select(*AUDIT_SCHEMA.fieldNames()).unionByName(new)

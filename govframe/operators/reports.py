"""Audit, permission, maintenance and quality reports (K, L-6 … L-8).

All reports are declarative DataFrame plans.  Top-k reads use
``orderBy().limit()`` (Spark plans a per-partition top-k and a merge of
k rows per partition); top-k per group uses ``row_number() <= k``, which
Spark turns into a partial ``WindowGroupLimit`` before the shuffle, so a
group holding a third of the rows ships at most k rows per map task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from govframe.functions.tsql import add_interval, datediff_boundary, like_tsql, plus
from govframe.operators.numbering import global_row_number
from govframe.operators.security import _as_of
from govframe.session import ensure_checkpoint_dir, shared_path

ColumnOrName = Column | str

# Requests whose answers one task holds: its hash tables then have the same size whatever the number of requests.
TASK_ROWS = 1_000_000

# The yes/no labels of the audit report and the success/failure labels of its top view.
YES, NO = "SÍ", "NO"
SUCCESS_LABEL, FAILURE_LABEL = "ÉXITO", "FALLO"


def _cols(xs: Sequence[ColumnOrName]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def active_sessions(sessions: DataFrame, people: DataFrame, people_key: str, first: str, last: str, as_of) -> DataFrame:
    """Active sessions with the holder's full name and minutes open at ``as_of``.

    Like the monitoring view this tests the active flag only, not expiry.
    """
    p = people.select(F.col(people_key).alias("subject"), plus(first, F.lit(" "), last).alias("full_name"))
    s = sessions.filter(F.col("active"))
    return s.join(p, "subject", "inner").select(
        "usuario", "subject", "full_name", "started_at",
        datediff_boundary("MINUTE", F.col("started_at"), _as_of(as_of)).alias("minutes_open"),
        "expires_at",
    )


def latest(log: DataFrame, order: Sequence[ColumnOrName], k: int) -> DataFrame:
    """``SELECT TOP k … ORDER BY order`` (the order must end in a unique key)."""
    return log.orderBy(*_cols(order)).limit(k)


def latest_accesses(log: DataFrame, k: int = 1000, time_col: str = "event_at", tiebreak: str = "seq") -> DataFrame:
    """The latest-accesses view: newest ``k`` log rows (time, then a unique tie-breaker)."""
    return latest(log, [F.desc(time_col), F.desc(tiebreak)], k)


def audit_top(report: DataFrame, k: int, detail: Column, success: Column, order: Sequence[ColumnOrName]) -> DataFrame:
    """Latest ``k`` rows of an audit report with a detail column chosen per row and a
    success/failure label (simple CASE: NULL -> failure)."""
    estado = F.when(success == F.lit(True), F.lit(SUCCESS_LABEL)).otherwise(F.lit(FAILURE_LABEL))
    return latest(report, order, k).withColumn("detalle", detail).withColumn("estado", estado)


def latest_filtered(log: DataFrame, order: Sequence[ColumnOrName], k: int, cond: Column, k2: int) -> DataFrame:
    """A filter over a top-k view, then a second top: the filter applies after the first limit."""
    return log.orderBy(*_cols(order)).limit(k).filter(cond).orderBy(*_cols(order)).limit(k2)


def audit_report(log: DataFrame, time_col: str, success: Column, as_of, hours: int = 24) -> DataFrame:
    """Rows of the last ``hours`` hours with a yes/no success label (simple CASE: NULL -> NO)."""
    since = add_interval(_as_of(as_of), -hours, "HOUR")
    label = F.when(success == F.lit(True), F.lit(YES)).otherwise(F.lit(NO))
    return log.filter(F.col(time_col) >= since).withColumn("exito", label)


def action_summary(log: DataFrame, keys: Sequence[str], time_col: str, user_prefix: str | None = None,
                   user_col: str = "usuario") -> DataFrame:
    """Per key: number of rows, first and last time (partial + final hash aggregate).

    ``user_prefix`` restricts the report to users whose name starts with it
    (``LIKE 'prefix%'``; a plain prefix filter that reaches the Parquet scan).
    """
    if user_prefix is not None:
        log = log.filter(F.col(user_col).startswith(user_prefix))
    return log.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.min(time_col).alias("first_at"),
        F.max(time_col).alias("last_at"),
    )


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[ColumnOrName], k: int, rank_col: str = "rank") -> DataFrame:
    """Top ``k`` rows per group (``row_number() <= k``, partial limit before the shuffle)."""
    w = Window.partitionBy(*group).orderBy(*_cols(order))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def snapshot_history(log: DataFrame, kind_col: str, start_col: str, end_col: str, order: Sequence[ColumnOrName],
                     k: int | None = None) -> DataFrame:
    """Run history with duration in seconds (boundary count); optionally top ``k`` per kind."""
    out = log.withColumn("duration_s", datediff_boundary("SECOND", F.col(start_col), F.col(end_col)))
    if k is not None:
        out = top_k_per_group(out, [kind_col], order, k).drop("rank")
    return out


def archive_split(log: DataFrame, time_col: str, as_of, days: int) -> tuple[DataFrame, DataFrame]:
    """Retention: ``(kept, archived)`` -- rows newer than ``days`` before ``as_of`` and the rest.

    The two filters are complementary for non-NULL times; NULL times are
    kept (never archived by a comparison that is not TRUE).
    """
    cut = add_interval(_as_of(as_of), -days, "DAY")
    old = F.coalesce(F.col(time_col) < cut, F.lit(False))
    return log.filter(~old), log.filter(old)


def write_archive(archived: DataFrame, path: str, time_col: str, run_id: str) -> None:
    """Date-partitioned archive write: later reads prune by day.

    Rows land in ``archive_day=<day>/run=<run_id>``; with dynamic partition
    overwrite a retried run replaces only its own partitions, so the write
    is idempotent while successive runs accumulate.  Rows are dealt by day
    and time first: a task writes few days, and a large day is written by
    several tasks.
    """
    (archived.withColumn("archive_day", F.to_date(time_col)).withColumn("run", F.lit(run_id))
     .repartitionByRange("archive_day", time_col)
     .sortWithinPartitions("archive_day", time_col)  # time-ordered files: selective min/max stats
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("archive_day", "run").parquet(path))


def label_format(df: DataFrame, col: str, pattern: str, name: str = "format", ok_label: str = "OK",
                 bad_label: str = "INVALID") -> DataFrame:
    """Per-row format label: ``CASE WHEN col LIKE pattern THEN ok ELSE bad END`` (NULL -> bad)."""
    ok = like_tsql(col, pattern, fixed_char=False)
    return df.withColumn(name, F.when(F.coalesce(ok, F.lit(False)), F.lit(ok_label)).otherwise(F.lit(bad_label)))


# --------------------------------------------------------- permissions ----

def permission_audit(principals: DataFrame, memberships: DataFrame, grants: DataFrame, objects: DataFrame,
                     excluded: Sequence[str], allowed_types: Sequence[str]) -> DataFrame:
    """User x role x object x permission listing, system principals excluded.

    Inputs are exported access-list tables: ``principals(principal_id, name, type, type_desc)``
    (users *and* roles), ``memberships(member_id, role_id)``,
    ``grants(grantee_id, object_id, permission, state)``, ``objects(object_id, object_name)``.
    The principal table is read twice, once as the user and once as the
    role.  Principals are few compared with grants, and one grantee may
    hold a huge share of them, so the principal -> grant left join is
    written as a skew-splittable inner join plus the grant-less principals.
    """
    from govframe.operators.joins import left_join_fanout

    p = principals.filter(F.col("type").isin(*allowed_types) & ~F.col("name").isin(*excluded))
    role_names = principals.select(F.col("principal_id").alias("role_id"), F.col("name").alias("role_name"))
    with_role = p.join(memberships, p["principal_id"] == memberships["member_id"], "left").join(
        role_names, "role_id", "left"
    ).select("principal_id", "name", "type_desc", "role_name")
    g = grants.select("grantee_id", "object_id", "permission", "state")
    listed = left_join_fanout(with_role, g, ["principal_id"], ["grantee_id"])
    out = listed.join(objects.select("object_id", "object_name"), "object_id", "left")
    return out.select(
        F.col("name").alias("usuario"), F.col("type_desc").alias("tipo_usuario"), F.col("role_name").alias("rol"),
        F.col("object_name").alias("objeto"), F.col("permission").alias("permiso"), F.col("state").alias("estado"),
    )


def role_permissions(role_name: str, principals: DataFrame, grants: DataFrame, objects: DataFrame) -> DataFrame:
    """Permissions granted to one role: role -> permission (inner) -> object (left; may be gone)."""
    r = principals.filter(F.col("name") == role_name)
    g = r.join(grants, r["principal_id"] == grants["grantee_id"], "inner")
    return g.join(objects, "object_id", "left").select(
        F.col("name").alias("rol"), F.col("class_desc").alias("clase"), F.col("schema_name").alias("esquema"),
        F.col("object_name").alias("objeto"), F.col("permission").alias("permiso"), F.col("state").alias("estado"),
    )


def role_ancestors(role_memberships: DataFrame) -> DataFrame:
    """(role_id, ancestor_id): every role that a role belongs to, over any number of memberships.

    ``role_memberships(role_id, parent_id)``: a role that is itself a member.  Semi-naive closure: each
    round extends only the pairs that the round before found, by one membership, and keeps those not known
    yet, so a cycle ends as soon as it closes.  There are as many rounds as the longest chain; each is a join and an anti-join of
    role pairs (users are not in them) and is cut off by a checkpoint.  A role is no ancestor of itself, in a cycle neither.
    """
    ensure_checkpoint_dir(role_memberships.sparkSession)
    pair = ["role_id", "ancestor_id"]
    edges = role_memberships.select("role_id", F.col("parent_id").alias("ancestor_id"))
    edges = edges.filter("role_id IS NOT NULL AND ancestor_id IS NOT NULL AND role_id != ancestor_id").distinct().checkpoint(eager=True)
    step = edges.select(F.col("role_id").alias("ancestor_id"), F.col("ancestor_id").alias("_next"))
    known = found = edges
    while not found.isEmpty():
        longer = found.join(step, "ancestor_id").select("role_id", F.col("_next").alias("ancestor_id")).filter("role_id != ancestor_id")
        found = longer.distinct().join(known, pair, "left_anti").checkpoint(eager=True)
        known = known.unionByName(found)
    return known


def nested_memberships(memberships: DataFrame, role_memberships: DataFrame) -> DataFrame:
    """``memberships(user_id, role_id)`` with the roles that the user's roles belong to, at any depth."""
    direct = memberships.select("user_id", "role_id")
    above = direct.join(role_ancestors(role_memberships), "role_id").select("user_id", F.col("ancestor_id").alias("role_id"))
    return direct.unionByName(above).distinct()


def effective_permissions(requests: DataFrame, memberships: DataFrame, objects: DataFrame, grants: DataFrame,
                          revokes: DataFrame | None = None, role_memberships: DataFrame | None = None) -> DataFrame:
    """Effective permission for each requested (user, object, permission).

    ``requests(user_id, object_id, permission)``; ``memberships(user_id, role_id)``;
    ``objects(object_id, scope)``; ``grants(grantee, level, securable, permission, state)``
    with ``level`` in {OBJECT, SCOPE}, ``grantee`` a user or a role id
    (``U:<id>`` / ``R:<id>``) and ``state`` in {GRANT, DENY}.
    ``revokes`` has the grant key columns and removes matching rows.
    ``role_memberships(role_id, parent_id)`` nests roles: a user has the grants and denials of
    every role that one of the user's roles belongs to, over any path, cycles included.
    DENY wins over GRANT; no row -> NONE.

    Each request expands only to its own lookup keys (user and each of
    its roles) -- bounded by the user's role count -- and each key is
    probed at object and at scope level, so no member x object pairs are
    ever produced.

    The distinct requests are written once to the shared folder and read from there by every branch.  The answers are
    dealt by request over as many tasks as ``TASK_ROWS`` asks for, and meet only there: without a hash table of
    requests before that shuffle, and with a number of tasks that AQE does not coalesce by their small shuffled size.
    """
    if role_memberships is not None:
        memberships = nested_memberships(memberships, role_memberships)
    g = grants
    key = ["grantee", "level", "securable", "permission"]
    if revokes is not None:
        g = g.join(revokes.select(*key), key, "left_anti")
    g = g.groupBy(*key).agg(
        F.max(F.when(F.col("state") == "DENY", 1).otherwise(0)).alias("_deny"),
        F.max(F.when(F.col("state") == "GRANT", 1).otherwise(0)).alias("_grant"),
    )
    asked = ["user_id", "object_id", "permission"]
    spark, path = requests.sparkSession, shared_path(requests.sparkSession, "requests")
    requests = requests.select(*asked).distinct()
    requests.write.parquet(path)
    requests = spark.read.schema(requests.schema).parquet(path)
    tasks = max(2, -(-requests.count() // TASK_ROWS))  # no table goes to one task
    # All lookups of all requests are stacked and meet the grants in one join;
    # the requests themselves join the final aggregate, so none is lost.
    # A NULL equals no key: such a request is looked up nowhere.
    req = requests.filter("user_id IS NOT NULL AND object_id IS NOT NULL AND permission IS NOT NULL").join(objects.select("object_id", "scope"), "object_id", "left")

    def lookups(df: DataFrame, prefix: str, holder: str) -> DataFrame:
        who = F.concat(F.lit(prefix), F.col(holder).cast("string")).alias("grantee")
        levels = F.array(F.struct(F.lit("OBJECT").alias("level"), F.col("object_id").cast("string").alias("securable")),
                         F.struct(F.lit("SCOPE").alias("level"), F.col("scope").alias("securable")))
        return df.select(*asked, who, F.inline(levels)).filter(F.col("securable").isNotNull())

    by_role = req.join(memberships.select("user_id", "role_id").distinct(), "user_id")
    hits = lookups(req, "U:", "user_id").unionByName(lookups(by_role, "R:", "role_id")).join(g, key)
    none = requests.select(*asked, F.lit(0).alias("_deny"), F.lit(0).alias("_grant"))
    dealt = hits.select(*asked, "_deny", "_grant").unionByName(none).repartition(tasks, *asked)
    agg = dealt.groupBy(*asked).agg(F.max("_deny").alias("d"), F.max("_grant").alias("g"))
    return agg.select(
        *asked,
        F.when(F.col("d") == 1, F.lit("DENY")).when(F.col("g") == 1, F.lit("GRANT")).otherwise(F.lit("NONE")).alias("effective"),
    )


# ------------------------------------------------------------ checklist ----

# The three checklist states, most severe first.
STATUS_FAIL, STATUS_WARN, STATUS_OK = "✗ FALLO", "⚠ ADVERTENCIA", "✓ OK"
SEVERITY = {STATUS_FAIL: 0, STATUS_WARN: 1, STATUS_OK: 2}


@dataclass(frozen=True)
class CheckRule:
    """One checklist line: a one-row frame, the count column to read from it
    (``n`` by default), a status and a detail text.  Rules over the same table
    can share one frame with several counts: the identical aggregate is
    planned once (reused exchange), so the table is scanned once."""

    item: str
    counted: DataFrame
    status: Callable[[Column], Column]
    detail: Callable[[Column], Column]
    col: str = "n"


def count_of(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def status_if(pred: Callable[[Column], Column], bad: str = STATUS_FAIL) -> Callable[[Column], Column]:
    return lambda n: F.when(pred(n), F.lit(STATUS_OK)).otherwise(F.lit(bad))


def quality_checklist(rules: Sequence[CheckRule]) -> DataFrame:
    """One aggregate per rule, unioned, numbered by severity then item.

    The union holds exactly one row per rule, so numbering it with a
    plain window is bounded by the rule count.
    """
    parts = [
        r.counted.select(F.lit(r.item).alias("item"), r.status(F.col(r.col)).alias("status"),
                         r.detail(F.col(r.col)).alias("detail"))
        for r in rules
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    sev = F.when(F.col("status") == STATUS_FAIL, SEVERITY[STATUS_FAIL]).when(
        F.col("status") == STATUS_WARN, SEVERITY[STATUS_WARN]).otherwise(SEVERITY[STATUS_OK])
    numbered = out.withColumn("num", F.row_number().over(Window.orderBy(sev, "item")).cast("long"))  # a row per rule
    return numbered.select("num", "item", "status", "detail")


# ------------------------------------------------------------ metadata ----

def object_inventory(objects: DataFrame, group: Sequence[str], weight: str | None = None) -> DataFrame:
    """Object count per group (e.g. schema, type), ordered.

    ``weight`` names a column of pre-aggregated counts to sum instead of
    counting rows (objects reduced per key before a join).
    """
    n = F.count(F.lit(1)) if weight is None else F.sum(weight).cast("long")
    return objects.groupBy(*group).agg(n.alias("n_objects")).orderBy(*group)


def impact(edges: DataFrame, referencing: str, referenced: str, target: object) -> DataFrame:
    """What refers to ``target`` (one hop over a dependency edge table): the distinct
    ``referencing`` ids of the edges whose ``referenced`` id is the target."""
    return edges.filter(F.col(referenced) == F.lit(target)).select(referencing).distinct()


def storage_stats(sizes: DataFrame, group: Sequence[str], units: str, rows: str, unit_bytes: int = 8, per: int = 1024) -> DataFrame:
    """Per group: row count and ``SUM(units) * unit_bytes DIV per`` (integer division)."""
    agg = sizes.groupBy(*group).agg(F.sum(rows).cast("long").alias("n_rows"), F.sum(units).cast("long").alias("_units"))
    return agg.withColumn("size_units", F.expr(f"(_units * {int(unit_bytes)}) div {int(per)}")).drop("_units")

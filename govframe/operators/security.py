"""Sessions and row-level security (J-1 … J-9).

A *principal* is the caller (user name + roles).  A *policy* is a
function ``(frame, context) -> frame`` bound to a table name in a
``PolicyRegistry``; ``load_table`` applies all policies of a table (AND)
on the scan, so every view built on top inherits them.

Scale notes
* The per-principal session lookup returns at most one row (sessions are
  unique per user), so the RLS predicate compares the subject with a scalar
  subquery; Spark pushes that comparison into the Parquet scan of the
  protected table, where min/max statistics skip the row groups of other
  subjects.
* Session state is rebuilt from an event batch with aggregates keyed by
  user (partial aggregation, no window over a user's history), so a user
  with a third of all events costs one row after the map side.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from govframe.functions.tsql import add_interval, ts_literal
from govframe.operators.constraints import keys_present

# The administrator identities that bypass the session predicate.
ADMIN_ROLE = "db_owner"
ADMIN_USER = "dbo"

# The audit action names and the table they are logged against.
LOGIN, LOGOUT = "LOGIN", "LOGOUT"
SESSION_TABLE = "SesionAlumno"


@dataclass(frozen=True)
class Principal:
    """The caller.  ``name`` may be a literal or a scalar Column (lazy lookup)."""

    name: str | Column
    roles: frozenset[str] = field(default_factory=frozenset)

    @property
    def is_admin(self) -> bool:
        return ADMIN_ROLE in self.roles or (isinstance(self.name, str) and self.name == ADMIN_USER)

    def name_col(self) -> Column:
        return self.name if isinstance(self.name, Column) else F.lit(self.name)


def _as_of(as_of: _dt.datetime | str | Column) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return ts_literal(as_of)


@dataclass(frozen=True)
class AccessContext:
    principal: Principal
    as_of: _dt.datetime | str
    sessions: DataFrame | None = None


# ------------------------------------------------------------ sessions ----

def usable_sessions(sessions: DataFrame, as_of) -> DataFrame:
    """Active sessions whose expiry is absent or still in the future."""
    t = _as_of(as_of)
    return sessions.filter(
        F.col("active") & (F.col("expires_at").isNull() | (F.col("expires_at") > t))
    )


def principal_subjects(sessions: DataFrame, principal: Principal, as_of) -> DataFrame:
    """Subjects the principal may see through its session (0 or 1 row)."""
    return usable_sessions(sessions, as_of).filter(F.col("usuario") == principal.name_col()).select("subject")


def rls_session(df: DataFrame, subject_col: str, sessions: DataFrame, principal: Principal, as_of) -> DataFrame:
    """Session predicate: admins see everything, everyone else the subject of
    their own active, unexpired session.  Decided on the driver for the
    admin case (no filter at all); otherwise a filter against a scalar
    subquery -- at most one row, because sessions are unique per user --
    which Spark pushes into the scan of ``df``.  No session: no rows.
    """
    if principal.is_admin:
        return df
    mine = principal_subjects(sessions, principal, as_of).scalar()
    return df.filter(F.col(subject_col) == mine)  # NULL (no session) keeps no row; pushable as EqualTo


def rls_flag(df: DataFrame, flag: str | Column) -> DataFrame:
    """Attribute predicate: only rows whose flag is TRUE; no admin exemption."""
    c = F.col(flag) if isinstance(flag, str) else flag
    return df.filter(F.coalesce(c, F.lit(False)))


Policy = Callable[[DataFrame, AccessContext], DataFrame]


def session_policy(subject_col: str) -> Policy:
    def policy(df: DataFrame, ctx: AccessContext) -> DataFrame:
        if ctx.sessions is None:
            raise ValueError("session policy needs sessions in the access context")
        return rls_session(df, subject_col, ctx.sessions, ctx.principal, ctx.as_of)

    def predicate(ctx: AccessContext) -> Column:
        # the row form: the principal's session has at most one subject (a scalar subquery)
        if ctx.principal.is_admin:
            return F.lit(True)
        if ctx.sessions is None:
            raise ValueError("session policy needs sessions in the access context")
        mine = principal_subjects(ctx.sessions, ctx.principal, ctx.as_of).select("subject").scalar()
        return F.coalesce(F.col(subject_col) == mine, F.lit(False))

    policy.predicate = predicate
    return policy


def flag_policy(flag: str | Column) -> Policy:
    def policy(df: DataFrame, ctx: AccessContext) -> DataFrame:
        return rls_flag(df, flag)

    c = F.col(flag) if isinstance(flag, str) else flag
    policy.predicate = lambda ctx: F.coalesce(c, F.lit(False))
    return policy


class PolicyRegistry:
    """Table name -> list of row policies; several policies combine with AND."""

    def __init__(self) -> None:
        self._policies: dict[str, list[Policy]] = {}

    def register(self, table: str, policy: Policy) -> PolicyRegistry:
        self._policies.setdefault(table, []).append(policy)
        return self

    def policies(self, table: str) -> list[Policy]:
        return list(self._policies.get(table, []))

    def apply(self, table: str, df: DataFrame, ctx: AccessContext) -> DataFrame:
        for policy in self._policies.get(table, []):
            df = policy(df, ctx)
        return df

    def predicate(self, table: str, ctx: AccessContext) -> Column | None:
        """The table's policies as one row predicate (AND), when every policy has a row form."""
        preds = [getattr(p, "predicate", None) for p in self._policies.get(table, [])]
        if any(p is None for p in preds):
            return None
        out = F.lit(True)
        for p in preds:
            out = out & p(ctx)
        return out


def visible_flag(df: DataFrame, key: Sequence[str], registry: PolicyRegistry, table: str, ctx: AccessContext,
                 name: str = "_visible") -> DataFrame:
    """``df`` with a boolean column: may the caller see this row under the table's policies?

    Built-in policies have a row form, so the flag is one expression over
    the scan.  Otherwise the policies are applied to ``df`` and their
    surviving keys joined back (one row per key).  Either way rows the
    caller cannot see stay in the frame, flagged false.
    """
    pred = registry.predicate(table, ctx)
    if pred is not None:  # built-in policies: a row predicate, no join at all
        return df.withColumn(name, pred)
    key = list(key)
    seen = registry.apply(table, df, ctx).select(*key).distinct().withColumn(name, F.lit(True))
    out = df.join(seen, key, "left")
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def update_visible(df: DataFrame, key: Sequence[str], registry: PolicyRegistry, table: str, ctx: AccessContext,
                   cond: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """``UPDATE … WHERE cond`` as the caller: rows hidden by a policy are left unchanged."""
    from govframe.operators.mutate import update_where

    flagged = visible_flag(df, key, registry, table, ctx)
    return update_where(flagged, cond & F.col("_visible"), assignments).drop("_visible").select(*df.columns)


def delete_visible(df: DataFrame, key: Sequence[str], registry: PolicyRegistry, table: str, ctx: AccessContext,
                   cond: Column) -> DataFrame:
    """``DELETE … WHERE cond`` as the caller: rows hidden by a policy are kept."""
    from govframe.operators.mutate import delete_where

    flagged = visible_flag(df, key, registry, table, ctx)
    return delete_where(flagged, cond & F.col("_visible")).drop("_visible").select(*df.columns)


def probe(ids: DataFrame, id_col: str, sessions: DataFrame, principal: Principal, as_of, name: str = "allowed") -> DataFrame:
    """Predicate probe: for each id, would the session policy let it through?"""
    if principal.is_admin:
        return ids.withColumn(name, F.lit(True))
    mine = principal_subjects(sessions, principal, as_of).scalar()  # at most one subject per user
    return ids.withColumn(name, F.coalesce(F.col(id_col) == mine, F.lit(False)))


def visibility_counts(df: DataFrame, subject_col: str, sessions: DataFrame, as_of) -> DataFrame:
    """Rows of ``df`` each session holder may see: ``(usuario, subject, n_visible)``.

    ``df`` is reduced to one count per subject before the join (partial
    aggregate), so a subject owning a third of the rows is one row in the
    shuffle; the join against sessions is then one-to-many and small.
    """
    per_subject = df.groupBy(subject_col).agg(F.count(F.lit(1)).alias("n_visible"))
    s = usable_sessions(sessions, as_of).select("usuario", "subject")
    j = s.join(per_subject, s["subject"] == per_subject[subject_col], "left")
    return j.select("usuario", "subject", F.coalesce(F.col("n_visible"), F.lit(0).cast("long")).alias("n_visible"))


visibility_matrix = visibility_counts


def policy_report(policies: DataFrame, predicates: DataFrame, objects: DataFrame) -> DataFrame:
    """Policy listing on exported catalogue tables: policy, enabled flag, and the table each
    predicate protects.  ``policies(policy_id, name, is_enabled)``,
    ``predicates(policy_id, target_object_id, predicate)``, ``objects(object_id, object_name)``."""
    j = policies.join(predicates, "policy_id").join(
        objects.withColumnRenamed("object_id", "target_object_id"), "target_object_id")
    return j.select(F.col("name").alias("policy"), "is_enabled", F.col("object_name").alias("target"), "predicate")


# -------------------------------------------------------- session events ---

EVENT_COLS = ("usuario", "kind", "subject", "event_at", "seq", "expires_at")


def apply_session_events(
    state: DataFrame | None,
    events: DataFrame,
    people: DataFrame,
    people_key: str,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Apply a batch of LOGIN / LOGOUT events to the session table.

    ``events``: ``usuario, kind, subject, event_at, seq, expires_at`` (``seq``
    breaks ties of ``event_at``; ``expires_at`` is the LOGIN's expiry or NULL).
    Rules (one session row per user):

    * a LOGIN whose subject is not in ``people`` is rejected (no change, no log);
    * a LOGIN replaces the user's previous session with an active one;
    * a LOGOUT closes the user's active session at the LOGOUT time; a
      LOGOUT with no active session changes nothing;
    * an event older than the stored session's start is late: it is logged
      and changes nothing;
    * every accepted event is logged (LOGOUT rows carry no subject).

    Returns ``(sessions, log, rejected)``.  All per-user steps are hash
    aggregates; the event stream only meets many-to-one joins (subject
    existence, the user's last login), which AQE can split when one user
    or subject is hot.
    """
    logins = events.filter(F.col("kind") == LOGIN)
    logouts = events.filter(F.col("kind") == LOGOUT)
    # Existence check: only the distinct subjects of this batch probe the
    # people table (a small batch's subjects are broadcast and the people
    # table is filtered while it is scanned, not shuffled).
    known = keys_present(people.select(F.col(people_key).alias("subject")), logins, ["subject"])
    valid_logins = logins.join(known, "subject", "left_semi")
    rejected = logins.join(known, "subject", "left_anti").withColumn("reason", F.lit("unknown subject"))

    last_login = valid_logins.groupBy("usuario").agg(
        F.max(F.struct("event_at", "seq", "subject", "expires_at")).alias("ll")
    )
    if state is None:
        # no earlier sessions: nothing to merge, so no join with an empty table
        old_type = "struct<subject:bigint,active:boolean,started_at:timestamp_ntz,expires_at:timestamp_ntz>"
        open_ = last_login.withColumn("old", F.lit(None).cast(old_type))
    else:
        st = state.select("usuario", F.struct("subject", "active", "started_at", "expires_at").alias("old"))
        late = F.col("ll.event_at") < F.col("old.started_at")
        open_ = st.join(last_login, "usuario", "full_outer").withColumn("ll", F.when(F.coalesce(~late, F.lit(True)), F.col("ll")))
    start = open_.select("usuario", F.coalesce("ll.event_at", "old.started_at").alias("s_at"), F.col("ll.seq").alias("s_seq"))
    after = logouts.select("usuario", "event_at", "seq").join(start, "usuario").filter(
        (F.col("event_at") > F.col("s_at"))
        | ((F.col("event_at") == F.col("s_at")) & (F.col("s_seq").isNull() | (F.col("seq") > F.col("s_seq"))))
    )
    first_logout = after.groupBy("usuario").agg(F.min(F.struct("event_at", "seq")).alias("fl"))
    j = open_.join(first_logout, "usuario", "left")

    has_login = F.col("ll").isNotNull()
    has_old = F.col("old").isNotNull()
    closes = F.col("fl").isNotNull()
    subject = F.when(has_login, F.col("ll.subject")).otherwise(F.col("old.subject"))
    started = F.when(has_login, F.col("ll.event_at")).otherwise(F.col("old.started_at"))
    active = F.when(has_login, ~closes).otherwise(F.col("old.active") & ~closes)
    expires = (
        F.when(has_login & closes, F.col("fl.event_at"))
        .when(has_login, F.col("ll.expires_at"))
        .when(F.col("old.active") & closes, F.col("fl.event_at"))
        .otherwise(F.col("old.expires_at"))
    )
    sessions = j.filter(has_login | has_old).select(
        "usuario", subject.alias("subject"), active.alias("active"), started.alias("started_at"), expires.alias("expires_at")
    )

    log = valid_logins.select("usuario", "kind", "subject", "event_at", "seq").unionByName(
        logouts.select("usuario", "kind", F.lit(None).cast("long").alias("subject"), "event_at", "seq")
    ).select(
        "usuario", F.col("kind").alias("action"), F.lit(SESSION_TABLE).alias("table_name"),
        "subject", "event_at", "seq",
    )
    return sessions, log, rejected


def purge_sessions(sessions: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Delete closed sessions whose expiry is more than ``days`` before ``as_of``."""
    limit = add_interval(_as_of(as_of), -days, "DAY")
    gone = (~F.col("active")) & (F.col("expires_at") < limit)
    return sessions.filter(~F.coalesce(gone, F.lit(False)))

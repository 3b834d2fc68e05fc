"""Stand-in inputs: the governed model's tables, derived from the driver's tables.

The academy tables do not exist in the test data, so each recipe runs the
same operators on a stand-in built from the given tables:

* student -> ``customer`` (``c_name`` as first name, ``c_mktsegment`` as last name);
* course -> ``part``; enrolment -> ``orders`` / ``lineitem``;
* access log and login events -> ``events``;
* principals -> ``supplier``, roles -> ``nation``, grants -> ``lineitem``,
  securables -> ``part`` (scope = ``p_brand``).

These functions only reshape rows into the schema the operators expect;
all the work (session state, policies, checks) is done by the operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from govframe.functions.tsql import ts_literal
from govframe.operators.security import LOGIN, LOGOUT, Principal, apply_session_events, usable_sessions
from govframe.session import shared_path
from govframe.sources.sinks import write_version
from govframe.sources.stored import stored_once
from govframe.sources.tables import load_table, table_path

# Fixed values of the recipes: the report clock and the session lifetime rule.
AS_OF = "2024-01-31 00:00:00"
LOGIN_EVENT, LOGOUT_EVENT = "signup", "purchase"
SHORT_SESSION_VALUE = 20  # a LOGIN whose value is below this expires after one day; others never


def as_of() -> Column:
    return ts_literal(AS_OF)


def session_events(events: DataFrame) -> DataFrame:
    """``events`` -> LOGIN / LOGOUT events (``usuario, kind, subject, event_at, seq, expires_at``)."""
    is_login = F.col("event_type") == LOGIN_EVENT
    return events.filter(F.col("event_type").isin(LOGIN_EVENT, LOGOUT_EVENT)).select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("usuario"),
        F.when(is_login, F.lit(LOGIN)).otherwise(F.lit(LOGOUT)).alias("kind"),
        F.when(is_login, F.col("user_id")).alias("subject"),
        F.col("ts").alias("event_at"),
        F.col("event_id").alias("seq"),
        F.when(is_login & (F.col("value") < SHORT_SESSION_VALUE), F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("expires_at"),
    )


def session_batch(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sessions, log, rejected) after applying every login event to an empty session table."""
    events = load_table(spark, d, "events")
    customer = load_table(spark, d, "customer")
    return apply_session_events(None, session_events(events), customer, "c_custkey")


def sessions(spark: SparkSession, d: str) -> DataFrame:
    return session_batch(spark, d)[0]


def store(spark: SparkSession, sessions_df: DataFrame) -> DataFrame:
    """The session table as a stored version, sorted by user: a read of one user skips the other row groups."""
    path = write_version(sessions_df, shared_path(spark, "sessions"), 1, sort_within=["usuario"])
    return spark.read.schema(sessions_df.schema).parquet(path)


def stored_sessions(spark: SparkSession, d: str) -> DataFrame:
    """The session table of the given events, written once and read by every query that needs it."""
    return stored_once(spark, "sessions", [table_path(d, "events"), table_path(d, "customer")], lambda: sessions(spark, d), sort_within=["usuario"])


def first_usable_principal(sessions_df: DataFrame) -> Principal:
    """The non-admin principal of the single-user RLS recipes: the holder of the
    usable session with the smallest subject, looked up lazily (scalar subquery)."""
    name = usable_sessions(sessions_df, AS_OF).agg(F.min_by("usuario", "subject")).scalar()
    return Principal(name=name)


def access_log(events: DataFrame) -> DataFrame:
    """``events`` as an access log: who did what, when, with a success flag."""
    return events.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("usuario"),
        F.col("event_type").alias("action"),
        F.lit("events").alias("table_name"),
        F.col("user_id").alias("subject"),
        F.col("ts").alias("event_at"),
        F.col("event_id").alias("seq"),
        (F.col("event_type") != F.lit("error")).alias("success"),
        F.col("props").alias("detail"),
    )


# The exported-catalogue principal types and the names treated as system principals.
PRINCIPAL_TYPES = ("S", "U", "R")
SYSTEM_PRINCIPALS = ("dbo", "guest", "INFORMATION_SCHEMA", "sys")


def principals(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Exported principal table: suppliers are users, nations are database roles
    (role ids are negative so the two kinds never collide)."""
    users = supplier.select(
        F.col("s_suppkey").alias("principal_id"), F.col("s_name").alias("name"),
        F.lit("S").alias("type"), F.lit("SQL_USER").alias("type_desc"),
    )
    roles = nation.select(
        (-1 - F.col("n_nationkey").cast("long")).alias("principal_id"), F.col("n_name").alias("name"),
        F.lit("R").alias("type"), F.lit("DATABASE_ROLE").alias("type_desc"),
    )
    return users.unionByName(roles)


def memberships(supplier: DataFrame) -> DataFrame:
    """Role membership: each supplier belongs to the role of its nation."""
    return supplier.select(F.col("s_suppkey").alias("member_id"),
                           (-1 - F.col("s_nationkey").cast("long")).alias("role_id"))


def grants(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """Exported permission table.  User grants: one row per line item (supplier -> part;
    a returned line is a DENY).  Role grants: a nation's role may SELECT every part
    its members ship (distinct pairs, aggregated before the union)."""
    user_grants = lineitem.select(
        F.col("l_suppkey").alias("grantee_id"), F.col("l_partkey").alias("object_id"),
        F.lit("OBJECT_OR_COLUMN").alias("class_desc"),
        F.when(F.col("l_linestatus") == "O", F.lit("SELECT")).otherwise(F.lit("UPDATE")).alias("permission"),
        F.when(F.col("l_returnflag") == "R", F.lit("DENY")).otherwise(F.lit("GRANT")).alias("state"),
    )
    shipped = lineitem.select("l_suppkey", "l_partkey").join(
        supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    role_grants = shipped.select(
        (-1 - F.col("s_nationkey").cast("long")).alias("grantee_id"), F.col("l_partkey").alias("object_id"),
    ).distinct().select(
        "grantee_id", "object_id", F.lit("OBJECT_OR_COLUMN").alias("class_desc"),
        F.lit("SELECT").alias("permission"), F.lit("GRANT").alias("state"),
    )
    return user_grants.unionByName(role_grants)


def objects(part: DataFrame) -> DataFrame:
    """Exported object table: parts are objects, their brand is the schema."""
    return part.select(F.col("p_partkey").alias("object_id"), F.col("p_name").alias("object_name"),
                       F.col("p_brand").alias("schema_name"))

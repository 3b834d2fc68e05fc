"""Explicit schemas.

Two families:

* ``DRIVER`` -- the parquet tables the test driver provides; read with an
  explicit schema so that no file is opened for inference and column
  pruning starts from a known ``ReadSchema``.
* ``ACADEMY`` -- the governed data model (students, careers, courses,
  enrolments, contacts, languages, networks, logs).  Used by the unit
  tests on the hand-derived fixtures and as documentation of the
  domain rules (lengths, ranges, keys) the constraint operators enforce.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, I, S, D, B = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.BooleanType()
TS = T.TimestampNTZType()


def _st(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


DRIVER: dict[str, T.StructType] = {
    "region": _st(("r_regionkey", I, True), ("r_name", S, True)),
    "nation": _st(("n_nationkey", I, True), ("n_name", S, True), ("n_regionkey", I, True)),
    "customer": _st(
        ("c_custkey", L, True), ("c_name", S, True), ("c_nationkey", I, True),
        ("c_acctbal", D, True), ("c_mktsegment", S, True),
    ),
    "supplier": _st(("s_suppkey", L, True), ("s_name", S, True), ("s_nationkey", I, True), ("s_acctbal", D, True)),
    "part": _st(
        ("p_partkey", L, True), ("p_name", S, True), ("p_brand", S, True), ("p_type", S, True),
        ("p_size", I, True), ("p_retailprice", D, True),
    ),
    "orders": _st(
        ("o_orderkey", L, True), ("o_custkey", L, True), ("o_orderstatus", S, True),
        ("o_totalprice", D, True), ("o_orderdate", TS, True), ("o_orderpriority", S, True),
    ),
    "lineitem": _st(
        ("l_orderkey", L, True), ("l_partkey", L, True), ("l_suppkey", L, True), ("l_linenumber", I, True),
        ("l_quantity", D, True), ("l_extendedprice", D, True), ("l_discount", D, True), ("l_tax", D, True),
        ("l_returnflag", S, True), ("l_linestatus", S, True), ("l_shipdate", TS, True),
    ),
    "events": _st(
        ("event_id", L, True), ("ts", TS, True), ("user_id", L, True), ("event_type", S, True),
        ("value", D, True), ("props", S, True),
    ),
}

SHORT = T.ShortType()

ACADEMY: dict[str, T.StructType] = {
    "students": _st(
        ("student_id", I, False), ("first_name", S, False), ("last_name", S, False), ("email", S, True),
        ("age", SHORT, False), ("active", B, False), ("career_id", I, True), ("contact_id", I, True),
    ),
    "careers": _st(("career_id", I, False), ("career_name", S, False)),
    "courses": _st(("course_id", I, False), ("course_name", S, False), ("credits", SHORT, False), ("course_code", I, True)),
    "enrolments": _st(("student_id", I, False), ("course_id", I, False), ("period", S, False)),
    "contacts": _st(("contact_id", I, False), ("email", S, True), ("phone", S, True)),
    "student_languages": _st(("student_id", I, False), ("language", S, False), ("level", S, False)),
    "student_networks": _st(("student_id", I, False), ("twitter", S, True), ("instagram", S, True)),
    "events_json": _st(("id", I, False), ("payload", S, False)),
    "sessions": _st(
        ("usuario", S, False), ("subject", L, False), ("active", B, False),
        ("started_at", TS, False), ("expires_at", TS, True),
    ),
    "access_log": _st(
        ("usuario", S, False), ("action", S, False), ("table_name", S, False), ("subject", L, True),
        ("at", TS, False), ("ip", S, True), ("application", S, True),
    ),
    "snapshot_log": _st(
        ("kind", S, False), ("path", S, False), ("started_at", TS, False), ("finished_at", TS, False),
        ("size_mb", T.DecimalType(10, 2), True), ("status", S, False), ("error", S, True),
    ),
}

# Fixed values of the governed model (from the data-model definition):
# column length limits, numeric ranges and the enrolment period pattern.
ACADEMY_DOMAINS = {
    "students": {
        "first_name": {"not_null": True, "max_len": 60},
        "last_name": {"not_null": True, "max_len": 60},
        "email": {"max_len": 120},
        "age": {"not_null": True, "min": 0, "max": 255},
    },
    "careers": {"career_name": {"not_null": True, "max_len": 80}},
    "courses": {"course_name": {"not_null": True, "max_len": 100}, "credits": {"not_null": True, "min": 0, "max": 255}},
    "enrolments": {"period": {"not_null": True, "max_len": 6}},
    "contacts": {"email": {"max_len": 120}, "phone": {"max_len": 20}},
    "student_languages": {"language": {"not_null": True, "max_len": 40}, "level": {"not_null": True, "max_len": 20}},
}
PERIOD_PATTERN = "[12][0-9][0-9][0-9][S][12]"
MIN_STUDENT_AGE = 16
CREDITS_RANGE = (1, 10)

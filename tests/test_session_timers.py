import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from govframe.operators.security import purge_sessions
from govframe.plans import standins as X
from govframe.schemas import DRIVER
from govframe.session import shared_path
from govframe.sources.tables import load_table
from govframe.streaming import current_timed_sessions, read_log_stream, start_timed_sessions
from tests.conftest import SF_SMALL

EVENTS = T.StructType([T.StructField(n, t) for n, t in (
    ("usuario", T.StringType()), ("kind", T.StringType()), ("subject", T.LongType()), ("event_at", T.TimestampNTZType()),
    ("seq", T.LongType()), ("expires_at", T.TimestampNTZType()))])
T0 = dt.datetime(2031, 1, 10, 9)


def _run(spark, events, people, key, days):
    changes = shared_path(spark, "test-timed-changes")
    query = start_timed_sessions(events, people, key, changes, shared_path(spark, "test-ckpt"), days=days, watermark="0 seconds")
    query.awaitTermination()
    return query, spark.read.parquet(changes)


def _watermark(query):
    return max(p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in p["eventTime"])[:23].replace("T", " ").rstrip("Z")


def _parts(spark, parts):
    src = shared_path(spark, "test-timed-src")
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(f"{src}/part={i}")
    return read_log_stream(spark, f"{src}/part=*", EVENTS, max_files_per_trigger=1)


def test_agrees_with_the_batch_purge_at_the_watermark(spark):
    ev, people = load_table(spark, SF_SMALL, "events"), load_table(spark, SF_SMALL, "customer")
    src = shared_path(spark, "test-timed-events")
    cuts = ["2024-01-01", "2024-01-11", "2024-01-21", "2024-03-01"]
    for i in range(3):
        part = ev.filter((F.col("ts") >= F.lit(cuts[i]).cast("timestamp_ntz")) & (F.col("ts") < F.lit(cuts[i + 1]).cast("timestamp_ntz")))
        part.coalesce(1).write.parquet(f"{src}/part={i}")
    stream = X.session_events(read_log_stream(spark, f"{src}/part=*", DRIVER["events"], max_files_per_trigger=1))
    query, changes = _run(spark, stream, people, "c_custkey", days=1)
    got, whole = current_timed_sessions(changes), X.sessions(spark, SF_SMALL)
    want = purge_sessions(whole, _watermark(query), days=1)
    assert want.count() < whole.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_state_falls_when_closed_sessions_are_purged(spark):
    at = lambda **k: T0 + dt.timedelta(**k)
    people = spark.createDataFrame([(i,) for i in range(20)], "k bigint")
    logins = [(f"u{i}", "LOGIN", i, at(minutes=i), i, None) for i in range(20)]
    logouts = [(f"u{i}", "LOGOUT", None, at(hours=1), 100 + i, None) for i in range(18)]
    short = [("u18", "LOGIN", 18, at(hours=2), 200, at(hours=5)), ("u17", "LOGIN", 17, at(days=29), 201, None)]
    wake = [("u19", "LOGOUT", None, at(days=40), 300, None)]
    query, changes = _run(spark, _parts(spark, [logins + logouts, short, wake]), people, "k", days=30)
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert sizes[-1] < max(sizes)
    kinds = {r.change: r.n for r in changes.groupBy("change").agg(F.count("*").alias("n")).collect()}
    assert kinds["PURGED"] == 17 and kinds["EXPIRED"] == 1  # u17 logged in again, so its first end is forgotten
    left = {r.usuario: (r.active, r.expires_at) for r in current_timed_sessions(changes).collect()}
    assert left == {"u17": (True, None), "u18": (True, at(hours=5)), "u19": (False, at(days=40))}


def test_an_empty_stream_and_unknown_subjects_make_no_state(spark):
    people = spark.createDataFrame([(1,)], "k bigint")
    query, changes = _run(spark, _parts(spark, [[("x", "LOGIN", 9, T0, 1, None), ("y", "LOGOUT", None, T0, 2, None), ("a", "LOGIN", 1, T0, 3, None)]]), people, "k", 30)
    assert [r.usuario for r in current_timed_sessions(changes).collect()] == ["a"]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").find("RocksDB") < 0

import uuid

from pyspark.sql import functions as F

from govframe.operators import reports as R
from govframe.plans import standins as X
from govframe.schemas import DRIVER
from govframe.session import shared_path
from govframe.sources.tables import load_table
from govframe.streaming import action_summary_stream, latest_sessions, read_log_stream, start_session_stream
from tests.conftest import SF_SMALL


def _split_events(spark):
    """Copy the small events table into two files (first and second half of the month)."""
    src = shared_path(spark, "test-stream-src")
    ev = load_table(spark, SF_SMALL, "events")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    ev.filter(F.col("ts") < cut).coalesce(1).write.parquet(f"{src}/part=1")
    ev.filter(F.col("ts") >= cut).coalesce(1).write.parquet(f"{src}/part=2")
    return src, ev


def test_windowed_summary_matches_batch(spark):
    src = f"{SF_SMALL}"
    stream = read_log_stream(spark, src, DRIVER["events"], glob="events.parquet")
    q = (action_summary_stream(stream, ["user_id", "event_type"], "ts").writeStream
         .format("memory").queryName("summary_" + uuid.uuid4().hex[:8]).outputMode("complete")
         .option("checkpointLocation", shared_path(spark, "test-ckpt")).start())
    q.processAllAvailable()
    name = q.name
    q.stop()
    got = spark.table(name).drop("window_start", "window_end")
    ev = load_table(spark, SF_SMALL, "events")
    want = R.action_summary(ev.withColumn("d", F.to_date("ts")), ["d", "user_id", "event_type"], "ts").drop("d")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_session_stream_equals_batch(spark):
    src, ev = _split_events(spark)
    people = load_table(spark, SF_SMALL, "customer")
    stream = read_log_stream(spark, f"{src}/part=*", DRIVER["events"], max_files_per_trigger=1)
    table_dir, log_dir = shared_path(spark, "test-sessions"), shared_path(spark, "test-session-log")
    q = start_session_stream(X.session_events(stream), people, "c_custkey", table_dir, log_dir,
                             shared_path(spark, "test-ckpt"))
    q.awaitTermination()
    streamed = latest_sessions(spark, table_dir)
    batch = X.sessions(spark, SF_SMALL)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    assert spark.read.parquet(table_dir).select("v").distinct().count() == 2


def test_stateful_session_stream_equals_batch(spark):
    from govframe.streaming import current_sessions, start_session_changes

    src, _ = _split_events(spark)
    people = load_table(spark, SF_SMALL, "customer")
    stream = read_log_stream(spark, f"{src}/part=*", DRIVER["events"], max_files_per_trigger=1)
    changes_dir = shared_path(spark, "test-session-changes")
    q = start_session_changes(X.session_events(stream), people, "c_custkey", changes_dir, shared_path(spark, "test-ckpt"))
    q.awaitTermination()
    changes = spark.read.parquet(changes_dir)
    streamed = current_sessions(changes)
    batch = X.sessions(spark, SF_SMALL)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    # the second batch only emits the users it touched
    per_batch = {r.batch: r.n for r in changes.groupBy("batch").agg(F.count("*").alias("n")).collect()}
    assert len(per_batch) == 2 and per_batch[1] <= batch.count()


def test_watermark_drops_late_rows_in_append_mode(spark):
    """Days 1-14, then days 20-30, then a copy of the month's first event: by the third
    micro-batch its window is final and evicted, so the copy is dropped as late data."""
    src = shared_path(spark, "test-late-src")
    ev = load_table(spark, SF_SMALL, "events")
    first = ev.filter(F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    second = ev.filter(F.col("ts") >= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    late = first.orderBy("ts", "event_id").limit(1)
    first.coalesce(1).write.parquet(f"{src}/part=1")
    second.coalesce(1).write.parquet(f"{src}/part=2")
    late.coalesce(1).write.parquet(f"{src}/part=3")
    stream = read_log_stream(spark, f"{src}/part=*", DRIVER["events"], max_files_per_trigger=1)
    out = shared_path(spark, "test-late-out")
    q = (action_summary_stream(stream, ["user_id", "event_type"], "ts", window="1 day", watermark="1 hour")
         .writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", shared_path(spark, "test-ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p["stateOperators"])
    assert dropped == 1
    got = spark.read.parquet(out)
    row = late.first()
    key = (F.col("user_id") == row.user_id) & (F.col("event_type") == row.event_type) & \
        (F.to_date("window_start") == F.to_date(F.lit(row.ts)))
    want = first.filter((F.col("user_id") == row.user_id) & (F.col("event_type") == row.event_type)
                        & (F.to_date("ts") == F.to_date(F.lit(row.ts)))).count()
    assert got.filter(key).first().n_events == want
    # append mode: each window once, and only final windows (the last day is still open)
    assert got.groupBy("window_start", "user_id", "event_type").count().filter("count > 1").count() == 0
    last_day = second.agg(F.max(F.to_date("ts"))).first()[0]
    assert got.filter(F.to_date("window_start") == F.lit(last_day)).count() == 0
    early = got.filter(F.col("window_start") < F.lit("2024-01-15").cast("timestamp"))
    assert early.agg(F.sum("n_events")).first()[0] == first.count()


def test_late_events_in_a_later_batch_agree_in_every_form(spark):
    import datetime as dt

    from pyspark.sql import types as T

    from govframe.operators.security import apply_session_events
    from govframe.streaming import current_sessions, start_session_changes

    t0 = dt.datetime(2031, 1, 10, 9)
    at = lambda m: t0 + dt.timedelta(minutes=m)
    schema = T._parse_datatype_string("usuario string, kind string, subject bigint, event_at timestamp_ntz, seq bigint, expires_at timestamp_ntz")
    people = spark.createDataFrame([(1,), (2,), (3,)], "k bigint")
    one = [("a", "LOGIN", 1, at(10), 1, None), ("b", "LOGIN", 2, at(10), 2, None), ("c", "LOGIN", 3, at(10), 3, at(90))]
    two = [("a", "LOGIN", 2, at(1), 4, None), ("a", "LOGOUT", None, at(5), 5, None),  # both late
           ("b", "LOGIN", 1, at(2), 6, None), ("b", "LOGOUT", None, at(20), 7, None), ("b", "LOGOUT", None, at(15), 8, None),
           ("c", "LOGOUT", None, at(3), 9, None), ("c", "LOGIN", 1, at(30), 10, None)]
    src = shared_path(spark, "test-late-sessions")
    for i, part in enumerate((one, two)):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{src}/part={i}")
    first, _, _ = apply_session_events(None, spark.createDataFrame(one, schema), people, "k")
    want = sorted(map(tuple, apply_session_events(first, spark.createDataFrame(two, schema), people, "k")[0].collect()))
    assert want == [("a", 1, True, at(10), None), ("b", 2, False, at(10), at(15)), ("c", 1, True, at(30), None)]
    stream = lambda: read_log_stream(spark, f"{src}/part=*", schema, max_files_per_trigger=1)
    table = shared_path(spark, "test-late-table")
    start_session_stream(stream(), people, "k", table, shared_path(spark, "test-late-log"), shared_path(spark, "test-ckpt")).awaitTermination()
    assert sorted(map(tuple, latest_sessions(spark, table).select(*[f.name for f in first.schema]).collect())) == want
    changes = shared_path(spark, "test-late-changes")
    start_session_changes(stream(), people, "k", changes, shared_path(spark, "test-ckpt")).awaitTermination()
    assert sorted(map(tuple, current_sessions(spark.read.parquet(changes)).select(*[f.name for f in first.schema]).collect())) == want


def test_a_lost_session_table_is_an_error_after_the_first_batch(spark):
    import pytest
    from pyspark.sql.utils import AnalysisException

    gone = shared_path(spark, "never-written")
    assert latest_sessions(spark, gone) is None
    with pytest.raises(AnalysisException):
        latest_sessions(spark, gone, before_version=3, required=True)

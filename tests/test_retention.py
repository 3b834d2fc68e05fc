import datetime as dt

import pytest
from pyspark.sql import functions as F

from govframe.operators import reports as R
from govframe.operators import retention as RT
from govframe.session import shared_path
from govframe.sources.tables import load_table
from tests.conftest import SF_SMALL

SCHEMA = "id bigint, at timestamp_ntz"
D = dt.datetime(2030, 5, 10)


def _log(spark, rows):
    return RT.write_day_log(spark.createDataFrame(rows, SCHEMA), shared_path(spark, "test-day-log"), "at")


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_whole_days_move_and_only_the_divided_day_is_rewritten(spark):
    ev = load_table(spark, SF_SMALL, "events")
    log = RT.write_day_log(ev, shared_path(spark, "test-day-log"), "ts")
    before = {r.folder for r in log.catalogue(spark).collect()}
    after = log.retain(spark, "2024-01-31 06:30:00", days=20)
    entries = after.catalogue(spark).collect()
    assert {str(r.day) for r in entries if r.rewritten} == {"2024-01-11"}
    assert {r.folder for r in entries if not r.rewritten} == {f for f in before if not f.endswith("2024-01-11")}
    kept, old = R.archive_split(ev, "ts", "2024-01-31 06:30:00", days=20)
    for want, got in ((kept, after.read(spark)), (old, after.read(spark, RT.ARCHIVED))):
        assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0
    assert log.read(spark).count() == ev.count()  # the version before is as it was


def test_cut_at_midnight_writes_no_rows(spark):
    log = _log(spark, [(1, D - dt.timedelta(seconds=1)), (2, D), (3, D + dt.timedelta(hours=3))])
    after = log.retain(spark, "2030-05-12 00:00:00", days=2)
    assert _ids(after.read(spark)) == [2, 3] and _ids(after.read(spark, RT.ARCHIVED)) == [1]
    assert after.catalogue(spark).filter("rewritten").count() == 0


def test_null_times_stay_and_repeats_count(spark):
    log = _log(spark, [(1, None), (2, D), (2, D), (3, D + dt.timedelta(hours=9))]).append(
        spark.createDataFrame([(4, D + dt.timedelta(hours=1)), (5, None), (6, D + dt.timedelta(days=1))], SCHEMA))
    after = log.retain(spark, D + dt.timedelta(days=3, hours=5), days=3)
    assert _ids(after.read(spark)) == [1, 3, 5, 6] and _ids(after.read(spark, RT.ARCHIVED)) == [2, 2, 4]
    again = after.retain(spark, D + dt.timedelta(days=3, hours=5), days=3)  # nothing left to move
    assert _ids(again.read(spark)) == [1, 3, 5, 6] and _ids(again.read(spark, RT.ARCHIVED)) == [2, 2, 4]
    assert _ids(again.read(spark, since=(D + dt.timedelta(days=1)).date())) == [6]


def test_empty_log_and_two_runs_on_one_version(spark):
    log = _log(spark, [])
    assert log.read(spark).count() == 0
    first = log.retain(spark, "2030-01-01 00:00:00", days=1)
    assert first.read(spark).columns == ["id", "at"] and first.read(spark, RT.ARCHIVED).count() == 0
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        log.retain(spark, "2030-01-01 00:00:00", days=1)
    with pytest.raises(ValueError):
        RT.write_day_log(spark.createDataFrame([(1, D)], SCHEMA).withColumn("_day", F.lit(1)), shared_path(spark, "x"), "at")

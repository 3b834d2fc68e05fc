"""Inline rows, the shared folder, and the run log."""

import datetime as dt

import pytest

from govframe import session
from govframe.sources.tables import rows

SCHEMA = "k int not null, v string, at timestamp_ntz, x double"


@pytest.mark.parametrize("n", [1, 1000, 1001, 5000])
def test_rows_are_checked_alike_at_every_size(spark, n):
    at = dt.datetime(2031, 5, 6, 23, 30)
    data = [(i, None if i % 2 else "v", at, 0.5) for i in range(n)]
    df = rows(spark, SCHEMA, data)
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema] == [
        ("k", "int", False), ("v", "string", True), ("at", "timestamp_ntz", True), ("x", "double", True)]
    assert sorted(tuple(r) for r in df.collect()) == data
    for bad in (("7", "v", at, 0.5), (7.9, "v", at, 0.5), (True, "v", at, 0.5), (None, "v", at, 0.5), (1 << 40, "v", at, 0.5), (1, 3, at, 0.5), (1, "v", at)):
        with pytest.raises(TypeError):
            rows(spark, SCHEMA, [*data[1:], bad])


def test_no_rows(spark):
    assert rows(spark, SCHEMA, []).collect() == []


def test_small_rows_are_known_to_be_small(spark):
    big = spark.range(100_000).selectExpr("id", "id % 7 AS k")
    plan = big.join(rows(spark, "k bigint, v string", [(1, "a"), (2, "b")]), "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"
        folder = None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

        def getConf(self):
            return self

        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = Context()
        conf = sparkContext

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        Session.sparkContext.master = master
        with pytest.raises(RuntimeError):
            session.ensure_checkpoint_dir(Session)
    Session.sparkContext.master = "local[4]"
    assert session.ensure_checkpoint_dir(Session)


def test_failed_snapshot_keeps_the_whole_message(spark, tmp_path):
    from pyspark.sql import functions as F

    from govframe.sources import sinks

    broken = spark.range(1).select(F.raise_error(F.lit("x" * 9000)).alias("v"))
    with pytest.raises(sinks.SnapshotError) as info:
        sinks.snapshot_full({"t": broken}, str(tmp_path), "school", dt.datetime(2031, 1, 1))
    row = info.value.log.first()
    message = [v for v in row if isinstance(v, str) and "xxxx" in v][0]
    assert "x" * 9000 in message

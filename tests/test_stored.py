import os

from pyspark.sql import functions as F

from govframe.plans import recipes as Q
from govframe.plans import standins as X
from govframe.session import shared_path
from govframe.sources import stored
from tests.conftest import SF_SMALL

READERS = ("purge_expired", "rls_session_filter", "rls_admin", "rls_child_table", "rls_view_inherits", "policy_probe", "policy_update",
           "policy_delete", "rls_all_principals", "active_sessions")


def test_session_queries_read_the_stored_version(spark):
    X.stored_sessions(spark, SF_SMALL)
    for name in READERS:
        files = Q.RECIPES[name](spark, SF_SMALL).inputFiles()
        assert files and not any("events.parquet" in f for f in files), name
    assert not any("sessions" in f for f in Q.rls_admin(spark, SF_SMALL).inputFiles())


def test_built_once_until_the_inputs_change_and_the_old_version_goes(spark):
    src = shared_path(spark, "test-stored-src")
    spark.range(3).write.parquet(src)
    built = []

    def build():
        built.append(1)
        return spark.read.parquet(src).agg(F.count("*").alias("n"))

    get = lambda: stored.stored_once(spark, "test-stored", [src], build)
    one = get()
    assert [r.n for r in get().collect()] == [3] and len(built) == 1
    old = one.inputFiles()[0].replace("file://", "")
    spark.range(2).write.mode("append").parquet(src)
    assert [r.n for r in get().collect()] == [5] and len(built) == 2
    assert not os.path.exists(old)
    fs, folder = stored._hadoop_path(spark, get().inputFiles()[0].rsplit("/", 1)[0])
    fs.delete(folder, True)  # lost: built again
    assert [r.n for r in get().collect()] == [5] and len(built) == 3

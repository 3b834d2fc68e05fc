"""Versions with key filters: only files that may hold a batch's keys are read, and results are those of the whole table."""

import pytest
from pyspark.sql import functions as F

from govframe.operators import constraints as C
from govframe.session import shared_path
from govframe.sources import keyfilters as K

SCHEMA = "id bigint, cust bigint, day string, v int"


@pytest.fixture(scope="module")
def stored(spark):
    rows = [(i, i % 50 if i % 11 else None, f"d{i // 50}" if i % 13 else None, i) for i in range(6000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(24, "id")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return K.write_filtered(df, shared_path(spark, "test-filters"), 1, {"pk": ["id"], "cust_day": ["cust", "day"]}, sort_within=["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_no_key_is_hidden(spark, stored):
    assert stored.n_files >= 20
    where = {r.id: r.f for r in stored.rows(spark).select("id", F.col("_metadata.file_path").alias("f")).collect()}
    some = list(range(0, 6000, 97))
    files = stored.files_for(batch(spark, [(i, None, None, 0) for i in some]), ["pk"])
    assert {where[i] for i in some} <= set(files)
    one = [stored.files_for(batch(spark, [(i, None, None, 0)]), ["pk"]) for i in some[:12]]
    assert all(where[i] in f for i, f in zip(some, one)) and sum(map(len, one)) <= 12 * 4  # of 24 files


def test_files_are_skipped(spark, stored):
    df = stored.rows_for(batch(spark, [(5, None, None, 0), (999_999, 1, "x", 0)]), ["pk"])
    assert 1 <= len(df.inputFiles()) <= 6 < stored.n_files and df.filter("id = 5").count() == 1
    assert len(stored.rows_for(batch(spark, [(-7, None, None, 0)]), ["pk"]).columns) == 4
    assert stored.rows_for(batch(spark, [])).count() == 0
    plan = spark.read.schema(K._FILTERS).parquet(stored.filters).filter("name = 'pk' AND word IN (1, 2)")._jdf.queryExecution().executedPlan().toString()
    assert "In(word, [1,2])" in plan


def results(target, new):
    ok, bad = C.validated_append(target, new, ["id"], unique={"cust_day": ["cust", "day"]})
    return sorted(((*r, "") for r in ok.collect()), key=str), sorted(((*r[:4], ",".join(r[4])) for r in bad.collect()), key=str)


def test_validation_on_the_files_equals_that_on_the_table(spark, stored):
    new = batch(spark, [
        (17, 900, "new", 0),          # id exists
        (7001, 17, "d0", 0),          # (customer, day) exists
        (7002, None, None, 0),        # the NULL pair exists
        (7003, 901, None, 0), (7003, 902, "x", 0),  # one id twice
        (None, 903, "y", 0),          # no id
        (7004, 904, "z", 0), (7005, 904, "z", 0),   # one pair twice in the batch
        (7006, 905, "fine", 0), (7007, None, "fine", 0),
    ])
    near = stored.rows_for(new)
    assert len(near.inputFiles()) <= stored.n_files
    whole, some = results(stored.rows(spark), new), results(near, new)
    assert whole == some
    assert {r[0]: r[4] for r in some[1] if r[0] != 7003} == {
        17: "pk:exists", 7001: "unique:cust_day", 7002: "unique:cust_day", None: "pk:null", 7004: "unique:cust_day", 7005: "unique:cust_day"}
    assert [r[4] for r in some[1] if r[0] == 7003] == ["pk:duplicate_in_batch"] * 2 and [r[0] for r in some[0]] == [7006, 7007]


def test_other_key_types_and_large_batches(spark, stored, monkeypatch):
    as_int = spark.createDataFrame([(5, 1)], "id int, v int")
    assert stored.rows_for(as_int, ["pk"]).filter("id = 5").count() == 1  # cast to the stored type before hashing
    everything = stored.rows(spark)
    assert len(stored.files_for(everything, ["pk"])) == stored.n_files
    monkeypatch.setattr(K, "MOST_PROBES", 10)
    assert stored.files_for(everything, ["pk"]) is None and stored.rows_for(everything, ["pk"]).count() == 6000


def test_an_empty_version(spark):
    v = K.write_filtered(spark.createDataFrame([], SCHEMA), shared_path(spark, "test-filters"), 1, {"pk": ["id"]})
    assert v.rows_for(batch(spark, [(1, 1, "x", 1)])).count() == 0

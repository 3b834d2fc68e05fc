"""Nested roles, runs of changes per key, and counts kept by a change feed."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govframe.operators import history as H
from govframe.operators import reports as R
from govframe.session import shared_path
from govframe.streaming.count_feed import CountFeed

# ------------------------------------------------------- nested roles ----


def closure(edges):
    """Ancestors of each role by plain search."""
    out = set()
    for r in {a for a, _ in edges}:
        todo, seen = [r], set()
        while todo:
            x = todo.pop()
            for a, b in edges:
                if a == x and b is not None and b not in seen:
                    seen.add(b)
                    todo.append(b)
        out |= {(r, s) for s in seen if s != r and r is not None}
    return out


@pytest.mark.parametrize("edges", [
    [(1, 2), (2, 3), (3, 4), (4, 5)],
    [(1, 2), (2, 3), (3, 1)],
    [(1, 1), (1, 2), (2, 2), (1, 2)],
    [(1, 2), (2, 3), (3, 2), (3, 4), (5, 3), (6, 7)],
    [(1, None), (None, 2), (2, 3)],
    [],
])
def test_role_ancestors(spark, edges):
    df = spark.createDataFrame(edges, "role_id long, parent_id long")
    got = [tuple(r) for r in R.role_ancestors(df).collect()]
    assert len(got) == len(set(got)) and set(got) == closure([e for e in edges if None not in e])


def test_random_role_graphs(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(25), rng.randrange(25)) for _ in range(40)]
    got = {tuple(r) for r in R.role_ancestors(spark.createDataFrame(edges, "role_id long, parent_id long")).collect()}
    assert got == closure([e for e in edges if e[0] != e[1]])


def test_deny_on_any_path_wins(spark):
    """User 1 is in role 10; 10 -> 20 -> 30 and 30 -> 10; user 2 is in role 40 only."""
    members = spark.createDataFrame([(1, 10), (2, 40)], "user_id long, role_id long")
    nested = spark.createDataFrame([(10, 20), (20, 30), (30, 10), (40, 41)], "role_id long, parent_id long")
    objects = spark.createDataFrame([(7, "s"), (8, "s"), (9, "t")], "object_id long, scope string")
    grants = spark.createDataFrame(
        [("R:20", "SCOPE", "s", "SELECT", "GRANT"), ("R:30", "OBJECT", "8", "SELECT", "DENY"), ("U:1", "OBJECT", "8", "SELECT", "GRANT"), ("R:41", "SCOPE", "t", "SELECT", "GRANT")],
        "grantee string, level string, securable string, permission string, state string")
    asked = spark.createDataFrame([(u, o, "SELECT") for u in (1, 2) for o in (7, 8, 9)], "user_id long, object_id long, permission string")
    got = {(r.user_id, r.object_id): r.effective for r in R.effective_permissions(asked, members, objects, grants, role_memberships=nested).collect()}
    assert got == {(1, 7): "GRANT", (1, 8): "DENY", (1, 9): "NONE", (2, 7): "NONE", (2, 8): "NONE", (2, 9): "GRANT"}
    flat = {(r.user_id, r.object_id): r.effective for r in R.effective_permissions(asked, members, objects, grants).collect()}
    assert flat[(1, 7)] == "NONE" and flat[(1, 8)] == "GRANT"


def test_answers_are_dealt_over_tasks_of_bounded_rows(spark, monkeypatch):
    """3,000 requests, some asked twice, some with NULLs: each task holds the answers of about TASK_ROWS of them, however few bytes they are."""
    monkeypatch.setattr(R, "TASK_ROWS", 100)
    pairs = [(u, o) for u in range(60) for o in range(50)]
    schema = "user_id long, object_id long, permission string"
    asked = spark.createDataFrame([(u, o, "SELECT") for u, o in pairs + pairs[:500]] + [(None, 1, "SELECT"), (1, None, "SELECT"), (1, 1, None)], schema)
    members = spark.createDataFrame([(u, u % 4) for u in range(60)] * 2, "user_id long, role_id long")
    objects = spark.createDataFrame([(o, "even" if o % 2 == 0 else None) for o in range(49)], "object_id long, scope string")
    grants = spark.createDataFrame(
        [("R:1", "SCOPE", "even", "SELECT", "GRANT"), ("R:1", "OBJECT", "4", "SELECT", "DENY"), ("U:2", "OBJECT", "49", "SELECT", "GRANT"), ("R:9", "OBJECT", "3", "SELECT", "DENY")],
        "grantee string, level string, securable string, permission string, state string")
    nested = spark.createDataFrame([(3, 9)], "role_id long, parent_id long")

    def effective(u, o):
        if (u % 4 == 1 and o == 4) or (u % 4 == 3 and o == 3):
            return "DENY"
        return "GRANT" if (u % 4 == 1 and o % 2 == 0) or (u, o) == (2, 49) else "NONE"

    found = R.effective_permissions(asked, members, objects, grants, role_memberships=nested).withColumn("task", F.spark_partition_id()).collect()
    got = {(r.user_id, r.object_id, r.permission): r.effective for r in found}
    assert len(found) == len(got) == 3003
    assert got == {(u, o, "SELECT"): effective(u, o) for u, o in pairs} | dict.fromkeys([(None, 1, "SELECT"), (1, None, "SELECT"), (1, 1, None)], "NONE")
    sizes = Counter(r.task for r in found)
    assert len(sizes) > 25 and max(sizes.values()) < 200


def test_no_requests(spark):
    """An empty list of requests has an empty answer, of the same columns."""
    asked = spark.createDataFrame([], "user_id long, object_id long, permission string")
    members, objects = spark.createDataFrame([(1, 1)], "user_id long, role_id long"), spark.createDataFrame([(1, "s")], "object_id long, scope string")
    grants = spark.createDataFrame([("R:1", "SCOPE", "s", "SELECT", "GRANT")], "grantee string, level string, securable string, permission string, state string")
    found = R.effective_permissions(asked, members, objects, grants)
    assert found.columns == ["user_id", "object_id", "permission", "effective"] and found.collect() == []


# ----------------------------------------------------- runs of changes ----

OPEN = "9999"


def merge(current, history, changes):
    """The same merge one change after the other."""
    now = {k: (v, t) for k, v, t in current}
    hist, late = list(history), []
    first = {k: t for k, _, t in current}
    for k, t, tie, op, v in sorted((c for c in changes if c[1] is not None), key=lambda c: (c[1], c[2])):
        if k in first and t < first[k]:
            late.append((k, t, tie))
            continue
        if k in now:
            old, since = now.pop(k)
            if since < t:
                hist.append((k, old, since, t))
        if op == "U":
            now[k] = (v, t)
    late += [(k, t, tie) for k, t, tie, _, _ in changes if t is None]
    return sorted((k, v, t) for k, (v, t) in now.items()), sorted(hist), sorted(late, key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs_of_changes(spark, seed):
    rng = random.Random(seed)
    day = lambda d: None if d is None else f"2024-01-{d:02d}"
    current = [(k, f"c{k}", rng.randint(3, 8)) for k in range(0, 30, 2)]
    history = [(k, "old", 1, t) for k, _, t in current[:5]]
    changes = [(rng.randrange(30), rng.choice([rng.randint(1, 28), rng.randint(10, 12), None]), i, rng.choice("UUUD"), f"n{i}") for i in range(90)]
    changes += [(0, rng.randint(9, 28), 100 + i, "U", f"hot{i}") for i in range(60)]  # a key with most of the changes
    cur = spark.createDataFrame([(k, v, day(t)) for k, v, t in current], "k long, v string, f string").select("k", "v", F.col("f").cast("timestamp_ntz").alias("valid_from"))
    hist = spark.createDataFrame([(k, v, day(a), day(b)) for k, v, a, b in history], "k long, v string, f string, t string").select(
        "k", "v", F.col("f").cast("timestamp_ntz").alias("valid_from"), F.col("t").cast("timestamp_ntz").alias("valid_to"))
    ch = spark.createDataFrame([(k, day(t), i, op, v) for k, t, i, op, v in changes], "k long, t string, tie long, op string, v string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    new, closed, late = H.scd2_merge(cur, hist, ch, ["k"], "t", ["tie"])
    want = merge(current, history, changes)
    d = lambda x: None if x is None else x.day
    assert sorted((r.k, r.v, d(r.valid_from)) for r in new.collect()) == want[0]
    assert sorted((r.k, r.v, d(r.valid_from), d(r.valid_to)) for r in closed.collect()) == want[1]
    assert late.columns == ch.columns and sorted(((r.k, d(r.t), r.tie) for r in late.collect()), key=str) == want[2]


def test_no_changes_and_unknown_keys(spark):
    cur = spark.createDataFrame([(1, "a")], "k long, v string").withColumn("valid_from", F.lit("2024-01-01").cast("timestamp_ntz"))
    hist = cur.limit(0).withColumn("valid_to", F.col("valid_from"))
    none = spark.createDataFrame([], "k long, t timestamp_ntz, tie long, op string, v string")
    new, closed, late = H.scd2_merge(cur, hist, none, ["k"], "t", ["tie"])
    assert new.count() == 1 and closed.count() == 0 and late.count() == 0
    gone = spark.createDataFrame([(9, 1, "D", "x")], "k long, tie long, op string, v string").withColumn("t", F.lit("2024-02-01").cast("timestamp_ntz"))
    new, closed, late = H.scd2_merge(cur, hist, gone, ["k"], "t", ["tie"])
    assert new.count() == 1 and closed.count() == 0 and late.count() == 0


# ------------------------------------------------------------- feeds ----

KEY = T.StructType([T.StructField("k", T.StringType())])


def counts(spark, feed):
    return {r.k: r.total for r in feed.counts(spark).collect()}


def rows(spark, changes):
    return spark.createDataFrame(changes, "k string, sign int")


def test_replayed_batches_count_once(spark):
    feed = CountFeed(shared_path(spark, "test-feed"), KEY)
    feed.create(spark.createDataFrame([("a", 2), ("b", 1), (None, 4)], "k string, total long"))
    assert counts(spark, feed) == {"a": 2, "b": 1, None: 4}
    first, second = rows(spark, [("a", 1), ("c", 1), ("b", -1), (None, 1)]), rows(spark, [("c", 1), ("c", 1), ("a", -1), ("d", 1), ("d", -1)])
    after = {"a": 2, "c": 3, None: 5}
    feed.write_batch(first, 0)
    feed.write_batch(first, 0)
    feed.write_batch(second, 1)
    feed.write_batch(first, 0)
    assert counts(spark, feed) == after
    feed.compact(spark, 0)
    feed.compact(spark, 0)
    assert feed.folded(spark) == 0 and counts(spark, feed) == after
    feed.write_batch(first, 0)  # folded already
    feed.write_batch(second, 1)
    assert counts(spark, feed) == after
    feed.compact(spark, 1)
    feed.write_batch(second, 1)
    assert feed.folded(spark) == 1 and counts(spark, feed) == after


def test_more_deletes_than_rows_are_reported(spark):
    feed = CountFeed(shared_path(spark, "test-feed"), KEY)
    feed.create(rows(spark, []).selectExpr("k", "cast(sign AS long) AS total"))
    feed.write_batch(rows(spark, [("x", -1), ("y", 1)]), 0)
    assert counts(spark, feed) == {"y": 1} and [r.k for r in feed.negative(spark).collect()] == ["x"]
    feed.compact(spark, 0)
    assert [(r.k, r.total) for r in feed.negative(spark).collect()] == [("x", -1)]
    feed.write_batch(rows(spark, [("x", 1)]), 1)
    assert counts(spark, feed) == {"y": 1} and feed.negative(spark).count() == 0


def test_stream_keeps_the_counts_and_survives_a_replay(spark, tmp_path):
    feed = CountFeed(shared_path(spark, "test-feed"), KEY)
    feed.create(rows(spark, []).selectExpr("k", "cast(sign AS long) AS total"))
    for i in range(3):
        rows(spark, [("a", 1), (f"k{i}", 1), ("a", 1)]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = lambda: spark.readStream.schema("k string, sign int").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    feed.start(stream(), f"{tmp_path}/ckpt", availableNow=True).awaitTermination(120)
    want = {"a": 6, "k0": 1, "k1": 1, "k2": 1}
    assert counts(spark, feed) == want
    feed.compact(spark, 1)
    feed.start(stream(), f"{tmp_path}/ckpt-lost", availableNow=True).awaitTermination(120)  # the progress is lost: all batches come again
    assert counts(spark, feed) == want

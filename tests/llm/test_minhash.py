import numpy as np
import pytest

from govframe.llm import minhash as M
from govframe.llm.components import components
from tests.llm.util import frame, messy_words, smallest_reachable


def sets_of(rows):
    out = {}
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        out[doc] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
    return out


def brute(rows):
    sets = sets_of(rows)
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    top = smallest_reachable(ids, links)
    return sorted((d, len(sets[d]), top[d], top[d] == d) for d in ids), links


def found(spark, df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(spark, df).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = [(i * 3 + 1, t) for i, t in enumerate(messy_words(seed))]
    want, links = brute(rows)
    assert len(links) > 10
    assert found(spark, frame(spark, rows)) == want


def test_chains_reach_across_documents_that_are_not_alike(spark):
    words = [f"v{i}" for i in range(140)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 60])) for i in range(20)]  # each like the next, the ends not alike
    want, links = brute(rows)
    assert {w[2] for w in want} == {0} and (0, 19) not in links
    assert found(spark, frame(spark, rows)) == want


def test_hot_groups_emit_no_square(spark):
    """A third of the rows are copies and many are edits of one text; the links stay as many as the rows."""
    import random

    rng = random.Random(4)
    base = [f"b{i}" for i in range(120)]
    rows = [(i, " ".join(base)) for i in range(150)]
    for i in range(150, 450):
        text = list(base)
        for _ in range(rng.randint(1, 9)):
            text[rng.randrange(120)] = f"n{rng.random()}"
        rows.append((i, " ".join(text)))
    want, _ = brute(rows)
    df = frame(spark, rows, 8)
    assert found(spark, df) == want


def test_nulls_repeats_and_empty(spark):
    text = " ".join(f"q{i}" for i in range(30))
    got = M.near_duplicates(spark, frame(spark, [(None, text), (5, text), (5, text), (3, text), (8, None), (9, ""), (10, "a b"), (11, "A  b"), (12, "a b c")])).collect()
    by = sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id, r.kept) for r in got)
    assert by == [(-1, 26, None, True), (3, 26, 3, True), (5, 26, 3, False), (5, 26, 3, False), (8, 0, 8, True), (9, 0, 9, True), (10, 1, 10, True), (11, 1, 10, False), (12, 1, 12, True)]
    assert M.near_duplicates(spark, frame(spark, [])).collect() == []


def test_keep_one_returns_whole_rows_once(spark):
    text = " ".join(f"q{i}" for i in range(30))
    df = frame(spark, [(None, text), (5, text), (3, text), (3, text), (7, "other text of few words"), (8, None), (8, None)])
    out = M.keep_one(spark, df)
    assert out.columns == df.columns
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in out.collect()) == [(-1, text), (3, text), (7, "other text of few words"), (8, "")]


def test_estimate_is_corrected_for_chance():
    """Two-bit agreement of random sets with known similarity estimates it within the margin."""
    rng = np.random.default_rng(0)
    factors = M.mix(np.arange(1, 129, dtype=np.uint64)) | np.uint64(1)
    low = lambda s: M.mix(M.minima(s, factors)) & np.uint64(3)
    errors = []
    for _ in range(150):
        both, alone = rng.integers(0, 2**63, (2, 300), dtype=np.uint64)
        a, b = np.concatenate((both, alone[:50])), np.concatenate((both, alone[50:100]))
        equal = (low(a) == low(b)).mean()
        errors.append((equal - 0.25) / 0.75 - 300 / 400)
    assert abs(np.mean(errors)) < 0.02 and np.abs(errors).max() < 0.23
    assert 70 < M.NearPolicy().least_equal < 90


def test_components_of_paths_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(300, 200), (250, 300), (250, 250)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.comp for r in components(spark, df).collect()}
    assert got == smallest_reachable({x for e in links for x in e}, links)
    assert components(spark, df.limit(0)).collect() == []


def test_labels_of_a_giant_component_are_dealt_over_tasks(spark):
    """Without a broadcast, as beyond BROADCAST_ROWS: one component with most of the nodes, whose label is one join key."""
    from pyspark.sql import functions as F

    from govframe.llm import components as M

    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB"}
    before, bound = {k: spark.conf.get(k, None) for k in settings}, M.BROADCAST_ROWS
    n = 20_000
    links = spark.range(1, n).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b")).union(
        spark.range(n, n + 8000, 2).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
        label = edges.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("comp"))
        out = M._lowered(spark, edges, label.repartition(8), small=False)
        assert out.filter("comp = 0").count() == n
        out.collect()
        assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
        M.BROADCAST_ROWS = 0
        got = components(spark, links)
        assert got.filter(f"node < {n} AND comp <> 0 OR node >= {n} AND comp <> node - (node % 2)").isEmpty() and got.count() == n + 8000
    finally:
        M.BROADCAST_ROWS = bound
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

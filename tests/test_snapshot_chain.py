"""Snapshot chains: fingerprint trees, incremental links, restore, and links that must be refused."""

import dataclasses
import datetime as dt
import glob
import os
import re
import shutil

import pytest
from pyspark.sql import functions as F

from govframe.session import shared_path
from govframe.sources import chains as K
from govframe.sources.sinks import SnapshotError

AT = dt.datetime(2024, 1, 31)
SHAPE = K.TreeShape(("id", "part"), buckets=20, fanout=3)
SCHEMA = "id bigint, part string, v string, n int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def base_rows():
    return {(i, p): (f"v{i}", None if i % 7 == 0 else i) for i in range(200) for p in ("a", "b")}


def as_frame(spark, rows):
    return frame(spark, [(*k, *v) for k, v in rows.items()])


def content(df):
    return sorted(tuple(r) for r in df.select("id", "part", F.coalesce("v", F.lit("<null>")), F.coalesce("n", F.lit(-1))).collect())


@pytest.fixture(scope="module")
def chain(spark):
    """Full link and three days: changes and deletes; keys that come back; nothing at all."""
    base, rows, links, states = shared_path(spark, "test-chain"), base_rows(), [], []
    for day in range(4):
        if day == 1:
            rows = {k: v for k, v in rows.items() if k[0] not in (3, 4)}
            rows[(5, "a")] = (None, 5)
            rows[(900, "a")] = ("new", 1)
        elif day == 2:
            rows = {k: v for k, v in rows.items() if k != (900, "a")}
            rows[(3, "b")] = ("back", None)
            rows[(5, "a")] = ("v5", 5)
        df = as_frame(spark, rows)
        link, log = K.write_full(df, base, "t", AT, SHAPE) if day == 0 else K.write_incremental(df, links, base, "t", AT + dt.timedelta(days=day))
        assert log.first().status == "SUCCESS" and log.first().kind == link.kind
        links.append(link)
        states.append(dict(rows))
    return links, states


@pytest.fixture()
def own(chain, tmp_path):
    """A copy of the chain that a test may damage."""
    out = []
    for i, link in enumerate(chain[0]):
        shutil.copytree(link.path.removeprefix("file:"), f"{tmp_path}/link{i}")
        out.append(dataclasses.replace(link, path=f"{tmp_path}/link{i}"))
    return out


def want(spark, rows):
    return content(as_frame(spark, rows))


def test_every_state_is_restored(spark, chain):
    links, states = chain
    for i, rows in enumerate(states):
        out = K.restore_chain(spark, links[: i + 1], check_rows=True)
        assert out.columns == ["id", "part", "v", "n"] and content(out) == want(spark, rows)
    some = [0, 5, 9]
    part = as_frame(spark, states[2]).filter(SHAPE.bucket().isin(some))
    assert content(K.restore_chain(spark, links[:3], some)) == content(part)


def test_only_buckets_that_differ_are_read_and_written(spark, chain):
    links, _ = chain
    trees = [link.tree(spark) for link in links]
    one_day = K.changed_buckets(trees[0], trees[1], SHAPE)
    touched = spark.createDataFrame([(3, "a"), (3, "b"), (4, "a"), (4, "b"), (5, "a"), (900, "a")], "id bigint, part string")
    assert one_day == sorted({r[0] for r in touched.select(SHAPE.bucket()).collect()}) and 0 < len(one_day) <= 6
    assert {r[0] for r in links[1].rows(spark).select(K.BUCKET).distinct().collect()} == set(one_day)
    assert links[1].rows(spark).count() == 6
    # the comparison side lists the folders of these buckets only
    plan = links[0].rows(spark, one_day)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_bucket#\d+ (IN|INSET)", plan)
    scanned = {r[0].rpartition(f"{K.BUCKET}=")[2].split("/")[0] for r in links[0].rows(spark, one_day).select(F.input_file_name()).distinct().collect()}
    assert scanned == {str(b) for b in one_day}


def test_a_day_without_changes_opens_no_node(spark, chain):
    links, _ = chain
    assert links[3].root == links[2].root and links[3].rows(spark).count() == 0
    assert K.changed_buckets(links[2].tree(spark), links[3].tree(spark), SHAPE) == []


def test_nulls_and_swapped_values_change_the_fingerprint(spark):
    rows = [(1, "a", None, 1), (2, "a", "x", None)]
    other = [(1, "a", "x", 1), (2, "a", None, None)]
    assert K.fingerprint_tree(frame(spark, rows), SHAPE) != K.fingerprint_tree(frame(spark, other), SHAPE)
    assert K.fingerprint_tree(frame(spark, rows), SHAPE) == K.fingerprint_tree(frame(spark, rows[::-1]).repartition(3), SHAPE)


def _one_file(link):
    return sorted(glob.glob(f"{link.path.removeprefix('file:')}/data/**/*.parquet", recursive=True))[0]


def _without_side_checksum(path):
    """Drop the local file system's own checksum file, so that only the manifest can tell."""
    side = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
    if os.path.exists(side):
        os.remove(side)


@pytest.mark.parametrize("which", [0, 1, 2])
def test_one_flipped_byte_refuses_the_chain(spark, own, which):
    links = own
    path = _one_file(links[which])
    _without_side_checksum(path)
    data = bytearray(open(path, "rb").read())
    data[len(data) // 2] ^= 1
    open(path, "wb").write(bytes(data))
    with pytest.raises(K.DamagedSnapshot) as exc:
        K.restore_chain(spark, links)
    assert exc.value.path == links[which].path and exc.value.reasons[0].startswith("CHECKSUM ")
    if which:
        K.restore_chain(spark, links[:which])  # the links before it are sound


def test_missing_and_extra_files_refuse_the_chain(spark, own):
    links = own
    path = _one_file(links[1])
    shutil.copy(path, path.replace(".parquet", "-2.parquet"))
    with pytest.raises(K.DamagedSnapshot, match="EXTRA"):
        K.restore_chain(spark, links)
    os.remove(path)
    with pytest.raises(K.DamagedSnapshot, match="MISSING"):
        K.restore_chain(spark, links)
    assert K.damaged_files(spark, links[1].path).count() == 2


def test_links_must_follow_one_another(spark, chain):
    links, _ = chain
    for wrong in ([links[0], links[2]], [links[1]], [links[0], links[2], links[1]], [links[0], links[0]]):
        with pytest.raises(K.DamagedSnapshot):
            K.restore_chain(spark, wrong)
    with pytest.raises(ValueError):
        K.restore_chain(spark, [])


def test_rows_are_checked_against_the_root(spark, chain):
    links, _ = chain
    changed = K.Link(links[0].path, "FULL", None, "not the root", 0, SHAPE, links[0].schema)
    with pytest.raises(K.DamagedSnapshot, match="root"):
        K.restore_chain(spark, [changed], check_files=False, check_rows=True)


def test_an_unfinished_link_is_refused_and_a_failure_logged(spark, chain):
    links, _ = chain
    with pytest.raises(SnapshotError) as exc:  # the same folder again
        K.write_full(as_frame(spark, base_rows()), links[0].path.rpartition("/")[0], "t", AT, SHAPE)
    assert exc.value.log.first().status == "FAILED"
    with pytest.raises(K.DamagedSnapshot, match="no link row"):
        K.open_link(spark, links[0].path + "_never")


def test_empty_table_and_first_rows(spark):
    base = shared_path(spark, "test-chain-empty")
    full, _ = K.write_full(frame(spark, []), base, "t", AT, SHAPE)
    assert full.root == "" and K.restore_chain(spark, [full]).collect() == []
    link, _ = K.write_incremental(frame(spark, [(1, "a", "x", 1)]), [full], base, "t", AT + dt.timedelta(days=1))
    assert content(K.restore_chain(spark, [full, link], check_rows=True)) == [(1, "a", "x", 1)]
    gone, _ = K.write_incremental(frame(spark, []), [full, link], base, "t", AT + dt.timedelta(days=2))
    assert K.restore_chain(spark, [full, link, gone], check_rows=True).collect() == []

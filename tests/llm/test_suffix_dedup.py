import hashlib
from collections import Counter

import numpy as np
import pytest

from govframe.llm import suffix_dedup as S
from tests.llm.util import frame, messy_texts


def brute(texts, window):
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i : i + window] = True
        gone = gone[: len(t)]
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return out


@pytest.mark.parametrize(("hot", "in_memory"), [(4096, 16384), (3, 16384), (4096, 2), (2, 3)])
def test_against_brute_force(spark, hot, in_memory):
    """Shards in memory, shards divided as hot ones are, and shards whose queues lie on disk."""
    texts = messy_texts(5)
    rows = [(i if i % 17 else None, t) for i, t in enumerate(texts)]
    window = 40
    want = sorted((d is not None, d or 0, *b) for (d, _), b in zip(rows, brute([(t or "").encode() for t in texts], window), strict=True))
    df = frame(spark, rows)
    spans = S.repeated_strings(spark, df, window, hot, in_memory)
    original = S.repeated_strings
    try:
        S.repeated_strings = lambda *_: spans
        got = S.remove_repeats(spark, df, window).collect()
    finally:
        S.repeated_strings = original
    assert sum(w[3] for w in want) > 10_000
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want


def test_query_against_brute_force(spark):
    from govframe.llm.queries import op7_suffix_dedup

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = sorted((d.doc_id, *b) for d, b in zip(docs, brute([(d.text or "").encode() for d in docs], 400), strict=True))
    got = op7_suffix_dedup(spark, "/root/testdata/sf0.001").collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
    assert sum(w[2] for w in want) > 0


def test_a_repeat_within_one_document_and_overlaps(spark):
    unit = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(60))
    rows = [(1, "x" + unit + "y" + unit), (2, "z" * 300), (3, "no repeat here"), (4, unit[:50])]
    got = {r.doc_id: r for r in S.remove_repeats(spark, frame(spark, rows), 50).collect()}
    assert bytes(got[1].kept) == b"xy" and got[1].n_spans == 2
    assert got[2].n_removed == 300 and got[4].n_removed == 50 and got[3].n_removed == 0


def test_strip_documents_keeps_columns_and_whole_characters(spark):
    body = "é" * 30 + "".join(chr(0x4E00 + i) for i in range(40))
    rows = [(1, "a" + body + "b", "en", "s"), (2, "c" + body, "de", None), (None, None), (3, "short", "fr", "t")]
    df = frame(spark, rows)
    out = S.strip_documents(spark, df, 50)
    assert out.columns == df.columns
    got = {r.doc_id: r for r in out.collect()}
    assert (got[1].text, got[1].n_chars, got[1].lang, got[1].key) == ("ab", 2, "en", "x")
    assert (got[2].text, got[3].text, got[None].text) == ("c", "short", None)


def test_empty(spark):
    assert S.remove_repeats(spark, frame(spark, [])).collect() == []
    assert [r.n_removed for r in S.remove_repeats(spark, frame(spark, [(1, None), (1, None)])).collect()] == [0, 0]


def test_range_min():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 50, 200)
    first = rng.integers(0, 200, 500)
    last = np.minimum(199, first + rng.integers(0, 90, 500))
    assert S.range_min(a, first, last).tolist() == [int(a[i : j + 1].min()) for i, j in zip(first, last, strict=True)]


def test_disk_queue_keeps_order():
    q = S.DiskQueue(small=64)
    for byte, n in ((5, 100), (2, 300), (5, 50)):
        q.push(byte, np.arange(n) + 1000 * byte, np.arange(n))
    out = [(r, c) for regions, common in q.pop(7) for r, c in zip(regions.tolist(), common.tolist(), strict=True)]
    assert out == [(2000 + i, i) for i in range(300)] + [(5000 + i, i) for i in range(100)] + [(5000 + i, i) for i in range(50)]


def test_no_sort_group_of_a_hot_passage_is_large(spark, monkeypatch):
    """Documents that share a long passage and differ around it: no part of its shards keeps a row of each of them."""
    rng = np.random.default_rng(3)
    noise = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    passage = noise(130)
    texts = [f"{noise(60)}{passage}{noise(60)}" for _ in range(40)]
    seen, original = [], S.shard_spans

    def counted(shards, window, in_memory):
        seen.extend(r["count"] for r in shards.groupBy("key").count().collect())
        return original(shards, window, in_memory)

    monkeypatch.setattr(S, "shard_spans", counted)
    spans = S.repeated_strings(spark, frame(spark, list(enumerate(texts))), 40, 5)
    monkeypatch.setattr(S, "repeated_strings", lambda *_: spans)
    got = S.remove_repeats(spark, frame(spark, list(enumerate(texts))), 40).collect()
    want = brute([t.encode() for t in texts], 40)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sorted(got, key=lambda r: r.doc_id)] == want
    assert all(w[1] >= 130 for w in want) and max(seen, default=0) <= 5

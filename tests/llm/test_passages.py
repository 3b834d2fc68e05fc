import hashlib

import pytest

from govframe.llm import passages as P
from tests.llm.util import frame, messy_words


def brute(rows, window):
    first = {}
    for doc, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1) if doc is not None else ():
            w = tuple(words[i : i + window])
            first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - window + 1) if doc is not None else ():
            if first[tuple(words[i : i + window])] < doc:
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc is not None, doc or 0, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(spark, df, window, hot=P.HOT_REGIONS):
    spans = P.repeated_passages(spark, df, window, hot)
    original = P.repeated_passages
    try:
        P.repeated_passages = lambda *_: spans
        rows = P.remove_passages(spark, df, window).collect()
    finally:
        P.repeated_passages = original
    return sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in rows)


@pytest.mark.parametrize("hot", [512, 2])
@pytest.mark.parametrize("window", [1, 2, 9])
def test_against_brute_force(spark, window, hot):
    rows = [(i * 2 if i % 19 else None, t) for i, t in enumerate(messy_words(7))]
    rows += [(4, rows[2][1]), (6, rows[1][1])]  # repeated ids, with the same text and with another
    want = brute(rows, window)
    assert sum(w[3] for w in want) > 500
    assert found(spark, frame(spark, rows), window, hot) == want


def test_a_repeat_within_one_document_stays(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(2, f"{text} gap {text}"), (1, "none"), (3, text), (9, None), (10, "")]
    assert found(spark, frame(spark, rows), 50) == brute(rows, 50)
    assert found(spark, frame(spark, []), 50) == []


def test_automaton_knows_every_substring_and_no_other():
    import random

    rng = random.Random(2)
    for _ in range(60):
        texts = [[rng.choice("abc") for _ in range(rng.randint(0, 14))] for _ in range(rng.randint(1, 5))]
        automaton = P.SuffixAutomaton()
        for t in texts:
            automaton.add(t)
        assert len(automaton.length) <= 2 * sum(map(len, texts)) + 1
        known = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        query = [rng.choice("abcd") for _ in range(40)]
        for least in (1, 2, 4):
            assert list(automaton.matches(query, least)) == [e for e in range(least, 41) if tuple(query[e - least : e]) in known]


def test_query_against_brute_force(spark):
    from govframe.llm.queries import op10_passages

    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = op10_passages(spark, "/root/testdata/sf0.001").collect()
    assert sorted((True, r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute(docs, 50)


def test_parts_of_a_hot_shard_meet_automata(spark, monkeypatch):
    """Passages around the same boilerplate, each in a few documents that differ around it: its shards are hot, their parts are not."""
    cores = [[f"c{g}x{i}" for i in range(13)] for g in range(6)]
    passages = [[f"l{g}x{p}", *core, f"m{g}x{p}", f"n{g}x{p}", *core[::-1], f"r{g}x{p}"] for p in range(12) for g, core in enumerate(cores)]
    rows = [(i, " ".join([f"a{i}x{j}" for j in range(1 + i % 7)] + passages[i % 72] + [f"b{i}x{j}" for j in range(1 + i % 5)])) for i in range(216)]
    seen, original = [], P.shard_spans

    def counted(regions, window):
        sizes = sorted(r["count"] for r in regions.groupBy("key").count().collect())
        seen.append((len(sizes), sizes[-1] if sizes else 0))
        return original(regions, window)

    monkeypatch.setattr(P, "shard_spans", counted)
    want = brute(rows, 16)
    assert found(spark, frame(spark, rows), 16, 4) == want and sum(w[3] for w in want) == 144 * 30
    assert len(seen) > 1 and sum(n for n, _ in seen[1:]) > 0  # automata of divided shards
    assert max(most for _, most in seen) <= 4

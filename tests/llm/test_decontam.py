import re

import pytest

from govframe.llm import decontam as D
from tests.llm.util import frame, messy_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size):
    windows = {}
    for item, text in items:
        words = words_of(text)
        n = min(size, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            if item is not None:
                windows.setdefault(tuple(words[i : i + n]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words, hit, found = words_of(text), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if (w := tuple(words[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[w]
        out.append((doc is not None, doc or 0, len(words), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(out)


def found(spark, docs, items, size, **kw):
    bench = spark.createDataFrame([(i, t, "x", "x") for i, t in items], "item_id long, text string, win string, n string")
    rows = D.find_contamination(spark, frame(spark, docs), bench, size, **kw).collect()
    assert all(r.n_items == len(r.item_ids) for r in rows)
    return sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_hit, list(r.item_ids), r.contaminated) for r in rows)


@pytest.mark.parametrize(("size", "bits"), [(13, 1 << 23), (4, 1 << 23), (4, 1 << 15), (1, 1 << 23)])
def test_against_brute_force(spark, size, bits):
    """The small bitmap lets many false candidates through; the result is the same."""
    texts = messy_words(11)
    docs = [(i if i % 13 else None, t) for i, t in enumerate(texts)] + [(500, "É1 w1,w2;W3 " * 3)]
    items = [(i, t) for i, t in enumerate(messy_words(12, 12, 40, 30))] + [(77, "w1 w2"), (None, texts[1]), (78, texts[3]), (79, texts[3]), (79, texts[3]), (80, " ".join((texts[5] or "").split()[3:40]))]
    want = brute(docs, items, size)
    assert sum(w[3] for w in want) > 100
    assert found(spark, docs, items, size, bits=bits) == want


def test_a_hot_window_and_a_long_text(spark):
    shared = " ".join(f"k{i}" for i in range(20))
    docs = [(i, f"a{i} {shared} b{i}") for i in range(80)] + [(100, "pad " * 50_000 + shared), (101, "clean words only")]
    items = [(1, shared), (2, "pad pad pad")]
    assert found(spark, docs, items, 13) == brute(docs, items, 13)


def test_nothing_on_one_side(spark):
    docs = [(1, "some words"), (None, None), (2, "")]
    assert [r[3] for r in found(spark, docs, [], 13)] == [0, 0, 0]
    assert [r[3] for r in found(spark, docs, [(1, None), (2, " ,;")], 13)] == [0, 0, 0]
    assert found(spark, [], [(1, "some words")], 13) == []


def test_drop_contaminated_keeps_rows_whole(spark):
    bad = " ".join(f"k{i}" for i in range(20))
    df = frame(spark, [(1, bad), (2, "clean text"), (None, bad), (None, "clean too"), (3, None), (2, "clean text")])
    out = D.drop_contaminated(spark, df, spark.createDataFrame([(1, bad)], "item_id long, text string"))
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == [(0, "clean too"), (2, "clean text"), (2, "clean text"), (3, "")]


def test_items_without_an_id_hit_as_in_the_sql(spark, tmp_path):
    import duckdb

    from govframe.llm.oracle import ORACLE
    from govframe.llm.queries import op8_decontaminate

    a, b, c = (" ".join(f"{x}{i}" for i in range(20)) for x in "abc")
    docs = [(1, a), (2, f"{a} {b}"), (3, f"{b} {c}"), (4, "clean text"), (5, f"{b} " + "pad " * 900), (6, None)]
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    items = [(None, a), (None, b), (None, b), (7, b), (8, c), (None, None)]
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    df = op8_decontaminate(spark, str(tmp_path))
    cur = con.execute(ORACLE["op8_decontaminate"])
    columns = [d[0] for d in cur.description]
    want = sorted(cur.fetchall())
    assert sorted(tuple(r) for r in df.select(*columns).collect()) == want
    assert [(r[columns.index("doc_id")], r[columns.index("n_items")]) for r in want] == [(1, 1), (2, 2), (3, 3), (4, 0), (5, 2), (6, 0)]


def test_drop_contaminated_counts_items_without_an_id(spark):
    bad = " ".join(f"k{i}" for i in range(20))
    out = D.drop_contaminated(spark, frame(spark, [(1, bad), (2, "clean text")]), spark.createDataFrame([(None, bad)], "item_id long, text string"))
    assert [r.doc_id for r in out.collect()] == [2]

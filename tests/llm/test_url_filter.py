from govframe.llm import url_filter as U


def judged(spark, urls, **kw):
    df = spark.createDataFrame([(i, u, "z", "z") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string").repartition(2)
    return {r.page_id: r for r in U.filter_urls(df, **kw).collect()}


def test_host_and_path():
    cases = {
        None: ("", ""), "": ("", ""), "example.com/a": ("", ""), "http://": ("", ""), "http://A.Example.COM": ("a.example.com", ""),
        "http://É.Net/x": ("É.net", "/x"), "x://h?q=/p": ("h", ""), "x://h#f/p": ("h", ""), "x://h/p/q?r#s": ("h", "/p/q"), "x://h/p#s?r": ("h", "/p"), "a://b://c/d": ("b:", "//c/d"),
    }
    assert {u: U.host_and_path(u) for u in cases} == cases


def test_contract_rules_longest_wins(spark):
    urls = [
        "http://x.net/a", "http://x.net", "http://net/", "http://xnet/", "http://example.net/en/1", "http://m.example.net/en/1", "http://example.net/de/1",
        "http://example.com/de/", "http://badexample.com/de/", "http://a.org/fr/x", "http://org/fr/", "http://a.org/FR/x", "http://a.net.org/fr/porn", None, "no scheme",
    ]
    got = judged(spark, urls, rules=U.CONTRACT_RULES)
    want = ["net/", None, "net/", None, "example.net/en/", "example.net/en/", "net/", "example.com/de/", None, "org/fr/", "org/fr/", None, "org/fr/", None, None]
    assert [got[i].rule for i in range(len(urls))] == want
    assert [got[i].verdict for i in (0, 4, 6, 7, 9, 12, 13, 14)] == ["block", "allow", "block", "block", "allow", "allow", "allow", "allow"]


def test_vocabulary_counts_distinct_terms_between_boundaries(spark):
    urls = ["http://a.b/porn", "http://pornography.b/", "http://a.b/hot/hot", "http://a.b/hot-win", "http://a.b/hotwin", "http://HOT.b/WIN", "porn", "http://éporn.b/", "http://a.b/" + "x" * 200_000 + "/porn"]
    got = judged(spark, urls)
    assert [got[i].verdict for i in range(len(urls))] == ["block", "allow", "allow", "block", "allow", "block", "block", "block", "block"]
    assert (got[2].terms, got[3].terms, got[0].score) == (["hot"], ["hot", "win"], 2)
    assert (got[0].n_strict, got[3].n_soft) == (1, 2)


def test_vocabulary_against_plain_search(spark):
    import itertools
    import re

    terms = ("aa", "aab", "b", "ab.c")
    urls = ["".join(x) for n in range(1, 6) for x in itertools.product("ab.c", repeat=n)]
    got = judged(spark, urls, vocabulary=(U.Term(terms[0], True), *(U.Term(t, False) for t in terms[1:])))
    for i, u in enumerate(urls):
        want = sorted(t for t in terms if re.search(rf"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", u))
        assert got[i].terms == want, u
        assert (got[i].verdict == "block") == ("aa" in want or len(want) >= 2)


def test_empty_table_repeated_rows_and_no_terms(spark):
    assert judged(spark, []) == {}
    df = spark.createDataFrame([(1, "http://a.b/porn")] * 3 + [(None, None)], "page_id long, url string")
    rows = U.filter_urls(df, vocabulary=()).collect()
    assert len(rows) == 4 and {r.verdict for r in rows} == {"allow"}


def test_weights_of_soft_terms_and_of_terms_listed_twice(spark):
    table = [("weak", "soft", 0.5), ("word", "soft", 1.0), ("heavy", "soft", 5.0), ("Weak", "soft", 0.25), ("two-part", "soft", None), ("both", "soft", 1.0), ("both", "strict", 9.0), ("", "strict", 1.0), (None, None, None)]
    terms = U.read_vocabulary(spark.createDataFrame(table, "term string, kind string, weight double"))
    urls = ["h/weak-word", "h/weak/word/two-part", "h/heavy", "h/heavy/weak", "h/both", "h/two-party", "h/WORD?two-part", "h/word/word/word"]
    got = judged(spark, urls, vocabulary=terms)
    assert [got[i].verdict for i in range(len(urls))] == ["allow", "block", "allow", "block", "block", "allow", "block", "allow"]
    assert [got[i].score for i in range(len(urls))] == [1.5, 2.5, 5.0, 5.5, 2.0, 0.0, 2.0, 1.0]


def test_vocabulary_tables_are_checked(spark, monkeypatch):
    import pytest

    table = spark.createDataFrame([("a", "soft", 1.0), ("b", "strict", 1.0)], "term string, kind string, weight double")
    assert set(U.read_vocabulary(table)) == {U.Term("a", False), U.Term("b", True)}
    assert U.read_vocabulary(table.limit(0)) == ()
    with pytest.raises(ValueError, match="strict or soft"):
        U.read_vocabulary(table.union(table.selectExpr("'c'", "cast(null as string)", "1d")))
    monkeypatch.setattr(U, "MAX_TERMS", 1)
    with pytest.raises(ValueError, match="at most"):
        U.read_vocabulary(table)
    with pytest.raises(ValueError, match="at most"):
        U.filter_urls(table.withColumnRenamed("term", "url").withColumn("page_id", table.weight), vocabulary=(U.Term("a", True), U.Term("b", True)))


def test_production_vocabulary_is_composed(spark):
    known = {t.text: t for t in U.PRODUCTION}
    assert len(known) > 10_000
    urls = ["http://bestcasino24.example/", "http://a.b/live-sex", "http://a.b/live-sexton", "http://a.b/free-bets", "http://a.b/top-sale", "http://a.b/top-sale-cheap-pills", "http://a.b/en/history/sussex"]
    got = judged(spark, urls)
    assert [got[i].verdict for i in range(len(urls))] == ["block", "block", "allow", "block", "allow", "block", "allow"]

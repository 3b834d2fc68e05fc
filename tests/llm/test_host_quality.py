import random
import re
from collections import Counter

from govframe.llm import host_quality as Q
from tests.llm.util import frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(again)


def test_measures_against_brute_force():
    rng = random.Random(1)
    letters = ["a", "b", "é", "漢", "#", "*", "|", "<", " ", " ", "\n", "\t", "\x0b", "\x1c", "\xa0", "\r"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 200))) for _ in range(400)] + [None, "", "a a a a", "x\nx\n \n \nx", "a b c a b c"]
    for t in texts:
        assert Q.measure(t.encode() if t is not None else None) == brute(t), t


def good(i):
    return " ".join(f"w{i}x{j}" for j in range(60))


def test_hosts_are_judged_by_shrunk_rates(spark):
    rows = [(i, good(i), "en", "fine") for i in range(60)]
    rows += [(100 + i, "short", "en", "spam") for i in range(97)] + [(200 + i, good(i), "en", "spam") for i in range(3)]
    rows += [(300 + i, "short", "en", "mixed") for i in range(40)] + [(350 + i, good(i), "en", "mixed") for i in range(40)]
    rows += [(400 + i, "short", "en", "tiny") for i in range(5)] + [(410, good(1), "en", "tiny")]
    rows += [(500, good(2), "en", None), (501, None, "en", None), (None, good(3), None, "fine"), (600, good(4), "en", "fine"), (600, good(4), "en", "fine")]
    got = Q.judge(spark, frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert not by[200].kept and by[200].host_rejected and not by[200].base_failed  # its host fails almost always
    assert by[350].kept and by[410].kept and by[500].kept and by[0].kept and by[None].kept
    assert not by[300].kept and by[300].base_failed and not by[501].kept
    kept = Q.keep_documents(spark, frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == sorted((r.doc_id or -1) for r in got if r.kept)


def test_prior_weighs_more_when_hosts_agree():
    total = {"hosts": 5, "mean_short": 0.2, "noise": 0.01}
    a, b = Q.beta_prior({**total, "var_short": 0.0}, "short", Q.HostPolicy())
    assert abs(a / (a + b) - 0.2) < 1e-9 and a + b == 1000
    a, b = Q.beta_prior({**total, "var_short": 0.04}, "short", Q.HostPolicy())
    assert 2 <= a + b < 5
    assert Q.beta_prior({"hosts": 0}, "short", Q.HostPolicy()) == (1.0, 1.0)


def test_empty_and_no_hosts(spark):
    assert Q.judge(spark, frame(spark, [])).collect() == []
    assert Q.keep_documents(spark, frame(spark, [])).collect() == []
    assert [r.kept for r in Q.judge(spark, frame(spark, [(1, good(1)), (1, good(1))])).collect()] == [True, True]


def test_failures_of_different_rules_count_together_and_no_host_is_too_small(spark):
    rows = [(i, good(i), "en", f"h{i % 30}") for i in range(900)]  # thirty clean hosts pull the prior down
    rows += [(1000 + i, "short" if i % 2 else f"again and again {i} " * 30, "en", "mixed") for i in range(100)] + [(1200, good(5), "en", "mixed")]
    rows += [(2000 + i, "short", "en", "small") for i in range(19)] + [(2100, "short", "en", "one")]
    by = {r.doc_id: r for r in Q.judge(spark, frame(spark, rows)).collect()}
    assert by[1200].host_rejected and not by[1200].kept and not by[0].host_rejected
    rate = {r.host: r for r in Q.host_verdicts(spark.createDataFrame(
        [(r[3], *((len(r[1].split()) < 50, "again" in r[1], False, False, False)), len(r[1].split()) < 50 or "again" in r[1]) for r in rows],
        "host string, " + ", ".join(f"fail_{x} boolean" for x in Q.RULES)), Q.HostPolicy()).collect()}
    assert rate["mixed"].rate_short < 0.9 and rate["mixed"].rate_repetitive < 0.9 and rate["mixed"].rate_any >= 0.9
    assert rate["small"].host_rejected == (rate["small"].rate_any >= 0.9) and not rate["one"].host_rejected  # the prior alone spares small hosts


def test_a_hot_host_can_be_split(spark):
    """Beyond the broadcast bound the verdicts meet the documents in a join that AQE splits: a host with a third of the rows."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = [(i, good(i % 50), "en", "hot" if i % 3 == 0 else f"h{i % 97}") for i in range(6000)]
        out = Q.judge(spark, frame(spark, rows).repartition(8))
        assert len(out.collect()) == len(rows)
        assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

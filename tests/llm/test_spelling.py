import random
import re
import zlib
from collections import Counter

import pytest

from govframe.llm import spelling as S
from tests.llm.util import frame


def brute(rows, shortest=7, least=2, ratio=10, every=31):
    held = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            held[run] += 1
    n = {w: c for w, c in held.items() if len(w) >= shortest and c >= least}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    nears = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(nears[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(nears[w]), n[form[w]] if form[w] else None) for w in n)


def found(spark, rows, **policy):
    got = S.spelling_variants(spark, frame(spark, rows), S.SpellingPolicy(**policy))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in got.collect()), key=lambda r: r[0])


def corpus(seed, docs=400, alphabet="abé"):
    rng = random.Random(seed)
    words = ["".join(rng.choices(alphabet, k=rng.randint(5, 9))) for _ in range(60)]
    weights = [3 ** -(i % 8) for i in range(60)]

    def word():
        w = rng.choices(words, weights)[0]
        if rng.random() < 0.2:
            at = rng.randrange(len(w))
            w = w[:at] + rng.choice(["", "x", "aa", "ÿ"]) + w[at + 1 :]
        return w.title() if rng.random() < 0.2 else w

    rows = [(i, rng.choice([" ", ", ", "1", "_"]).join(word() for _ in range(rng.randint(0, 40)))) for i in range(docs)]
    return [*rows, (None, "nullword nullword"), (7, rows[7][1]), (500, None), (501, ""), (502, "1234 ... Āā")]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    want = brute(rows)
    assert sum(w[1] is not None for w in want) > 10 and max(w[4] for w in want) > 5
    assert found(spark, rows) == want


def test_other_policies(spark):
    rows = corpus(3, 150, "ab")
    assert found(spark, rows, shortest=1, least=1, ratio=2, every=0) == brute(rows, 1, 1, 2, 0)
    assert found(spark, rows, shortest=5, least=3, ratio=3, every=5) == brute(rows, 5, 3, 3, 5)


def test_roots_follow_chains_and_ties_go_to_the_first_word(spark):
    words = {"abcdefgh": 2, "abcdefghi": 25, "abcdefghij": 300, "abcdefghijk": 3500, "zzzzzzz": 2, "zzzzzzb": 30, "zzzzzza": 30}
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(words.items())]
    got = {r[0]: r for r in found(spark, rows, every=0)}
    assert got["abcdefgh"][1:3] == ("abcdefghi", "abcdefghijk") and got["zzzzzzz"][1] == "zzzzzza" and got["zzzzzzz"][4] == 2
    assert list(got.values()) == brute(rows, every=0)


def test_equal_letters_in_a_row_count_once(spark):
    rows = [(1, "aaaaaaaa aaaaaaaa aaaaaaaaa aaaaaaaaa baaaaaaaa baaaaaaaa")]
    got = found(spark, rows, every=0)
    assert got == brute(rows, every=0) and {r[4] for r in got} == {2}


def test_words_over_many_partitions(spark):
    """Prefixes that reach over partition starts keep their numbers."""
    rng = random.Random(5)
    words = sorted({"common" + "".join(rng.choices("ab", k=rng.randint(1, 7))) for _ in range(150)})
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = S.trie_nodes(spark, df, "word", ["n"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert [r.word for r in sorted(rows, key=lambda r: r.rank)] == words and sorted(r["rank"] for r in rows) == list(range(len(words)))
    node = {}
    for r in rows:
        for k, x in enumerate(r.nodes):
            assert node.setdefault(r.word[:k], x) == x
    assert sorted(node.values()) == list(range(len(node)))


def test_very_long_word_and_empty(spark):
    long = "y" * 30_000
    rows = [(1, f"{long} {long}"), (2, f"{long}y {long}y {long}z {long}z")]
    got = found(spark, rows, every=0)
    assert [(len(r[0]), r[3], r[4]) for r in got] == [(30_000, 2, 2), (30_001, 2, 2), (30_001, 2, 2)]
    assert found(spark, []) == []


def test_forms_need_growth():
    with pytest.raises(ValueError):
        S.spelling_variants(None, None, S.SpellingPolicy(ratio=1))

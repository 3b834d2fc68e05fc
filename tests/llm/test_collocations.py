import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from govframe.llm import collocations as C
from tests.llm.util import frame


def counts_of(rows):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = lang if lang is not None else "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return f, n


def brute(rows, least=30, top=2000, longest=4):
    f, n = counts_of(rows)
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if 2 <= len(p) <= longest and a >= least}
        kept = []
        for p, a in found.items():
            score, _, l, r = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items())
            if not inside:
                kept.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def texts(seed, n=160):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(25)] + ["É", "a b", "x\x1cy", "The"]
    line = [rng.choice(vocabulary) for _ in range(14)]
    out = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 40)):
            a = rng.randrange(10)
            words += line[a : a + rng.randint(1, 6)] if rng.random() < 0.3 else [rng.choice(vocabulary)]
            if rng.random() < 0.1:
                words.append(rng.choice([".", "!", "\n", ",", ";x", "a:b", "\x0b", "\t", "\r\n"]))
        out.append((i, rng.choice([" ", "  ", "\t"]).join(words), rng.choice(["en", "en", "de", None, ""])))
    return [*out, (900, None, "en"), (901, "", "fr"), (None, "Lone words here", "xx"), (3, out[3][1], out[3][2])]


def found(spark, rows, policy=C.PhrasePolicy()):
    df = frame(spark, [(d, t, lang) for d, t, lang in rows])
    return sorted(tuple(r) for r in C.collocations(spark, df, policy).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = texts(seed)
    want = brute(rows)
    assert {w[0] for w in want} >= {"en", "de"} and len({len(w[2].split(" ")) for w in want}) > 1
    assert found(spark, rows) == want


def test_other_policies_and_ties(spark):
    rows = texts(3, 60)
    assert found(spark, rows, C.PhrasePolicy(least=4, top=7)) == brute(rows, least=4, top=7)
    assert found(spark, rows, C.PhrasePolicy(least=5, longest=3, rounds=0)) == brute(rows, least=5, longest=3)


def test_results_do_not_depend_on_the_sketch_or_on_what_a_task_holds(spark):
    """A sketch in which everything collides prunes nothing; small buffers are counted many times."""
    rows = texts(4, 60)
    want = brute(rows, least=6)
    for policy in (C.PhrasePolicy(least=6, counters=8), C.PhrasePolicy(least=6, counters=1 << 13, held=50)):
        assert found(spark, rows, policy) == want
    held = frame(spark, rows).selectExpr("coalesce(lang, 'und') AS lang", "cast(text AS binary) AS text")
    assert C.frequent_places(spark, held, C.PhrasePolicy(least=6, counters=8), []) == b"\xff"


def test_paths_hold_every_edge_once(spark):
    line = [f"p{i}" for i in range(40)]
    edges = [("en", " ".join(line[i : i + 4]), 50) for i in range(37)] + [("en", "p3 p4 p5 zz", 31), ("de", "a a a a", 40), ("de", "r s r s", 33), ("de", "s r s r", 33)]
    df = spark.createDataFrame(edges, "lang string, phrase string, c long")
    paths = [tuple(r) for r in C.compact_paths(spark, df, C.PhrasePolicy(rounds=8)).collect()]
    runs = sorted((lang, " ".join(w[i : i + 4]), c) for lang, w, c in paths for i in range(len(w) - 3))
    assert runs == sorted(edges)
    assert len(paths) < 20 and max(len(w) for _, w, _ in paths) > 8
    branch = [w for _, w, _ in paths if "p4 p5 p6" in " ".join(w) or "p4 p5 zz" in " ".join(w)]
    assert all("p3 p4 p5" not in " ".join(w[1:-1]) for w in branch)  # a node with two edges out is no inner node


def test_hot_language_long_text_and_empty(spark):
    rows = [(i, "to be or not to be", "en") for i in range(40)] + [(99, "very long words " * 60_000, "en")]
    assert found(spark, rows) == brute(rows)
    empty = C.collocations(spark, frame(spark, []))
    assert empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and empty.collect() == []


def test_many_words_in_one_batch():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 3, (5000, 4)) * 40_000
    for wide in (1 << 15, 1 << 17):
        packed = rows % wide
        first, counts = C._distinct(packed, wide)
        want = Counter(map(tuple, packed.tolist()))
        assert {tuple(packed[i].tolist()): int(c) for i, c in zip(first, counts, strict=True)} == want


def test_policy():
    for wrong in ({"least": 300}, {"longest": 5}, {"counters": 12}):
        with pytest.raises(ValueError):
            C.PhrasePolicy(**wrong)

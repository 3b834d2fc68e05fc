import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from govframe.llm import golay as G
from tests.llm.util import frame, messy_words, smallest_reachable


def brute(spark, rows):
    """Fingerprints by Spark's own XXH64 (its seed is 42), links by comparing every pair."""
    fps = {}
    for doc, text in rows:
        words = [w.decode() for w in (text or "").encode().lower().split()]
        grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)][: len(words)]
        hashed = [r.h & (2**64 - 1) for r in spark.createDataFrame([(g,) for g in grams], "g string").select(F.xxhash64("g").alias("h")).collect()] if grams else []
        fps[doc] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))
    ids = sorted(fps)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (fps[a] ^ fps[b]).bit_count() <= 4]
    top = smallest_reachable(ids, pairs)
    return [(d, f"{fps[d]:016x}", top[d]) for d in ids]


def found(spark, rows, **policy):
    return sorted(tuple(r) for r in G.simhash_classes(spark, frame(spark, rows), G.GolayPolicy(**policy)).collect())


def test_against_brute_force(spark):
    rows = [(i * 3 + 1, t) for i, t in enumerate(messy_words(5, n=50))]
    want = brute(spark, rows)
    assert len({w[2] for w in want}) < len(want)
    assert found(spark, rows) == want


def test_code_is_perfect():
    """Each 23-bit word has one codeword within 3 bits, so the syndromes of up to 3 errors are all different."""
    index = G.GolayIndex()
    weights = np.bitwise_count(index.errors[:, 0])
    assert np.bincount(weights).tolist() == [1, 23, 253, 1771]
    assert index.count.tolist() == np.where(weights == 3, 6, 1).tolist()


@pytest.mark.parametrize("seed", [1, 2])
def test_all_words_at_two_errors_share_an_index(seed):
    index, rng = G.GolayIndex(), random.Random(seed)
    for word in [rng.getrandbits(23) for _ in range(60)]:
        near = [word ^ (1 << i) ^ (1 << j) for i in range(23) for j in range(23)] + [word ^ (1 << i) for i in range(23)]
        codes, valid = index.of(np.array([word, *near]))
        mine = set(codes[0][valid[0]].tolist())
        assert all(mine & set(c[v].tolist()) for c, v in zip(codes[1:], valid[1:], strict=True))


def test_all_fingerprints_at_four_errors_share_a_key():
    rng, index = random.Random(3), G.GolayIndex()
    base = [rng.getrandbits(64) for _ in range(400)]
    far = [b ^ sum(1 << p for p in rng.sample(range(64), 4)) for b in base]

    def keys(fps):
        out = [set() for _ in fps]
        for at, key in index.keys(np.array(fps, np.uint64)):
            for a, k in zip(at.tolist(), key.tolist(), strict=True):
                out[a].add(k)
        return out

    assert all(a & b for a, b in zip(keys(base), keys(far), strict=True))


def linked_classes(spark, fps, policy=G.GolayPolicy()):
    signed = [(f - (f >> 63 << 64),) for f in fps]
    pairs = [(r.a, r.b) for r in G.links(spark, spark.createDataFrame(signed, "fp long"), policy).collect()]
    top = smallest_reachable([s[0] for s in signed], pairs)
    return top, pairs


def brute_classes(fps):
    signed = {f: f - (f >> 63 << 64) for f in fps}
    a = np.array(fps, np.uint64)
    pairs = [(signed[fps[i]], signed[int(x)]) for i in range(len(fps)) for x in a[i + 1 :][np.bitwise_count(a[i + 1 :] ^ a[i]) <= 4]]
    return smallest_reachable(list(signed.values()), pairs), len(pairs)


def test_links_of_random_and_near_fingerprints(spark):
    rng = random.Random(9)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for f in list(fps):
        for _ in range(rng.randint(0, 3)):
            fps.add(f ^ sum(1 << p for p in rng.sample(range(64), rng.randint(1, 7))))
    fps = sorted(fps | {0, 1, 2**64 - 1})
    assert linked_classes(spark, fps)[0] == brute_classes(fps)[0]


@pytest.mark.parametrize("block", [4096, 16])
def test_hot_key_emits_members_not_pairs(spark, monkeypatch, block):
    """Hundreds of fingerprints within a few bits: whole classes, also when a key is dealt out in blocks, and no square of rows."""
    monkeypatch.setattr(G, "BLOCK", block)
    rng = random.Random(11)
    centre = rng.getrandbits(64)
    fps = sorted({centre ^ sum(1 << p for p in rng.sample(range(64), rng.randint(0, 3))) for _ in range(500)})
    top, pairs = linked_classes(spark, fps)
    want, all_pairs = brute_classes(fps)
    assert top == want
    assert block < 100 or len(pairs) < all_pairs


def test_nulls_repeats_and_empty(spark):
    text = " ".join(f"q{i}" for i in range(30))
    rows = [(None, text), (5, text), (5, text), (3, text), (8, None), (9, ""), (10, "A b"), (11, "a  b"), (None, "alone here")]
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in G.simhash_classes(spark, frame(spark, rows)).collect()}
    by = {d: (f, c) for d, f, c in got if d is not None}
    assert by[5] == by[3] and by[3][1] == 3 and by[8] == by[9] == ("0" * 16, 8) and by[10] == by[11] and by[11][1] == 10
    assert {(f, c) for d, f, c in got if d is None} == {by[3], (by_text(spark, "alone here"), None)}
    assert len(G.simhash_classes(spark, frame(spark, rows)).collect()) == len(rows)
    empty = G.simhash_classes(spark, frame(spark, []))
    assert empty.columns == ["doc_id", "fingerprint", "component_id"] and empty.collect() == []


def by_text(spark, text):
    h = spark.createDataFrame([(text,)], "t string").select(F.xxhash64("t")).first()[0]
    return f"{h & (2**64 - 1):016x}"


def test_long_text(spark):
    words = [f"w{i % 977}" for i in range(200_000)]
    got = found(spark, [(1, " ".join(words)), (2, "\n".join(words)), (3, " ".join(words[:-1]))])
    assert {g[2] for g in got} == {1}


def test_policy():
    with pytest.raises(ValueError):
        G.GolayPolicy(most=5)

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from govframe.llm import langid_crf as L
from tests.llm.util import frame


def chain_marginals(scores, moves, start):
    """Forward-backward over one chain in logarithms, word by word."""
    a, b = np.zeros_like(scores), np.zeros_like(scores)
    a[0] = start + scores[0]
    for t in range(1, len(scores)):
        a[t] = scores[t] + np.logaddexp.reduce(a[t - 1][:, None] + moves, axis=0)
    for t in range(len(scores) - 2, -1, -1):
        b[t] = np.logaddexp.reduce(moves + scores[t + 1] + b[t + 1], axis=1)
    g = a + b
    return np.exp(g - np.logaddexp.reduce(g, axis=1, keepdims=True))


@pytest.mark.parametrize("segment", [1, 2, 7, 64])
@pytest.mark.parametrize("flat", [False, True])
def test_marginals_are_those_of_whole_chains(segment, flat):
    rng = np.random.default_rng(1)
    moves, start = (np.zeros((4, 4)), np.zeros(4)) if flat else (rng.normal(size=(4, 4)) * 2, rng.normal(size=4))
    lengths = np.array([1, 5, 64, 65, 128, 129, 3, 700, 200])
    scores = rng.normal(size=(lengths.sum(), 4)) * 3
    got, at = L.marginals(scores, lengths, moves, start, segment), 0
    for n in lengths:
        assert np.allclose(got[at : at + n], chain_marginals(scores[at : at + n], moves, start), atol=1e-9)
        at += n


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(2)
    chains = [[(rng.choice(["aa", "ab", "ba", "cc"]), int(rng.integers(0, 3))) for _ in range(n)] for n in (1, 4, 6, 6)]
    t = L.Trainer(chains, ["x", "y", "z"], L.Sample(least=1))
    at = [rng.normal(size=s) * 0.3 for s in ((len(t.index), 3), (3, 3), (3,))]

    def likelihood(weights, moves, start):
        total = 0.0
        for c in chains:
            s = np.array([sum(weights[t.index[f]] for f in L.features_of(w)) for w, _ in c])
            gold = start[c[0][1]] + sum(s[i, y] for i, (_, y) in enumerate(c)) + sum(moves[c[i][1], c[i + 1][1]] for i in range(len(c) - 1))
            a = start + s[0]
            for i in range(1, len(c)):
                a = s[i] + np.logaddexp.reduce(a[:, None] + moves, axis=0)
            total += gold - np.logaddexp.reduce(a)
        return total

    for k, g in enumerate(t.gradient(*at)):
        for place in np.ndindex(*g.shape) if g.size < 20 else [(0, 0), (1, 2), (3, 1)]:
            step = [x.copy() for x in at]
            step[k][place] += 1e-5
            up = likelihood(*step)
            step[k][place] -= 2e-5
            assert abs((up - likelihood(*step)) / 2e-5 - g[place]) < 1e-4


def test_held_out_accuracy_and_rows(spark):
    from govframe.llm.queries import op6_language_crf

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = op6_language_crf(spark, "/root/testdata/sf0.01").join(docs, "doc_id").collect()
    assert len(got) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    out = [r for r in got if r.held_out]
    assert len(out) > 150 and sum(r.lang == r.lang_pred for r in out) >= 0.98 * len(out)
    assert all(0 <= r.score <= 1 for r in got)


def test_switches_are_found_inside_a_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = L.learn(spark, docs)
    one = {r.lang: " ".join(r.text.split()[:60]) for r in docs.filter(L.held_out() & (F.size(F.split("text", " ")) > 80)).orderBy("doc_id").collect()}
    both = frame(spark, [(1, one["en"] + " " + one["de"]), (2, one["fr"])])
    got = {r.doc_id: r for r in L.label(spark, both, model, runs=True).collect()}
    longest = sorted(got[1].runs, key=lambda x: -x.words)[:2]
    assert {x.lang for x in longest} == {"en", "de"} and all(x.words > 40 for x in longest)
    assert got[1].score < 0.8 < got[2].score and got[2].lang_pred == "fr"
    assert sum(x.words for x in got[1].runs) == got[1].n_words


def test_nulls_and_texts_without_letters(spark):
    rows = [(i, "la casa de el perro " * 3, "es") for i in range(40)] + [(i + 40, "the house of the dog " * 3, "en") for i in range(40)]
    odd = [(None, "the dog", "en"), (200, None, "en"), (201, "", None), (202, "123 ²³ -- 😀", "en"), (203, "the dog", None), (203, "the dog", None), (204, "the house " * 30_000, None)]
    got = L.identify(spark, frame(spark, rows + odd)).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (200, 201, 202)] == ["und"] * 3 and by[200].score == 0
    assert by[203].lang_pred == by[None].lang_pred == by[204].lang_pred == "en" and by[None].held_out is False
    assert by[204].n_words == 60_000
    alone = L.identify(spark, frame(spark, [(1, "text", None), (2, None, "en")])).collect()
    assert {r.lang_pred for r in alone} == {"und"}
    assert L.identify(spark, frame(spark, [])).collect() == []


def test_prediction_never_sees_labels_or_sources(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = L.learn(spark, docs)
    plain = sorted((r.doc_id, r.lang_pred, r.score) for r in L.label(spark, docs, model).collect())
    blind = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string"))
    assert sorted((r.doc_id, r.lang_pred, r.score) for r in L.label(spark, blind, model).collect()) == plain


def test_only_the_most_frequent_languages_are_learned(spark):
    rows = [(i, "the cat sat on the mat and the dog ran " * 3, "en") for i in range(40)] + [(100 + i, "le chat est sur la table et le chien court " * 3, "fr") for i in range(40)]
    rows += [(200 + i, "odd words here", f"junk{i}") for i in range(30)] + [(300 + i, "le la les", "und") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.learn(spark, docs, L.Sample(langs=2, rounds=5))
    assert model.langs == ["en", "fr"]
    assert "und" not in L.learn(spark, docs, L.Sample(langs=5, rounds=1)).langs

import array
import hashlib

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from govframe.llm import host_quality
from govframe.llm.bpe import read_ranks
from tests.llm import test_decontam, test_host_quality, test_minhash
from tests.llm.test_suffix_dedup import brute as repeated_bytes
from tests.llm.util import frame

SF = "/root/testdata/sf0.001"


def cut_text(texts, window):
    """Texts without the bytes of repeated strings, partial characters dropped."""
    from collections import Counter

    import numpy as np

    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + window] for t in raw for i in range(len(t) - window + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i : i + window] = True
        out.append(bytes(np.frombuffer(t, np.uint8)[~gone]).decode(errors="ignore"))
    assert [len(r) for r in raw] == [b[0] for b in repeated_bytes(raw, window)]
    return out


def brute(docs, items):
    """The stages in plain Python."""
    kept = []
    for doc, text, source in docs:
        n_words, _, _, _, n_repeat = test_host_quality.brute(text)
        if n_words >= 50 and 100 * n_repeat <= 50 * n_words:
            kept.append((doc, text, source))
    top, _ = test_minhash.brute([(d, t) for d, t, _ in kept])
    stay = {d for d, _, _, keep in top if keep}
    kept = [(d, t) for d, t, _ in kept if d in stay]
    kept = list(zip([d for d, _ in kept], cut_text([t for _, t in kept], corpus_pipeline.PASSAGE_BYTES), strict=True))
    bad = {d for _, d, _, _, _, contaminated in test_decontam.brute(kept, items, 13) if contaminated}
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(f.read()), special_tokens={})
    out = []
    for d, t in kept:
        if d not in bad:
            ids = array.array("I", library.encode_ordinary(t))
            out.append((d, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out)


def test_run_against_brute_force(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    judged = host_quality.judge(spark, spark.read.parquet(f"{SF}/documents.parquet"))
    assert judged.filter("host_rejected").isEmpty()  # the brute force has no host verdicts
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == brute(docs, items) and 0 < len(got) < len(docs)


def test_stages_keep_the_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "suffix_array_dedup", "decontaminate", "token_ids"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")


def test_awkward_rows_and_no_rows_pass_through(spark):
    long = " ".join(f"w{i}" for i in range(80))
    rows = [(None, long + " null id", None, None), (1, long, "en", "s"), (1, long, "en", "s"), (2, None), (3, ""), (4, "y " * 70_000 + long), (5, " ".join(f"v{i}" for i in range(90)))]
    for docs, want in ((frame(spark, rows), [-1, 1, 5]), (frame(spark, []), [])):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert sorted(-1 if r.doc_id is None else r.doc_id for r in docs.collect()) == want


def rejected_hosts(docs):
    """Hosts that one rule, or all together, condemn, by the moments of the hosts' rates in plain Python."""
    from collections import defaultdict
    from statistics import mean, variance

    hosts = defaultdict(list)
    for _, text, source in docs:
        if source is not None:
            words, chars, symbols, dup, again = test_host_quality.brute(text)
            each = (words < 50, 2 * again > words, 10 * symbols > 3 * words, 2 * dup > words, words > 0 and not 2 * words <= chars <= 25 * words)
            hosts[source].append((*each, any(each)))
    noise, bad = mean(1 / len(x) for x in hosts.values()), set()
    for rule in range(6):
        failed = {h: sum(x[rule] for x in rows) for h, rows in hosts.items()}
        rates = [failed[h] / len(rows) for h, rows in hosts.items()]
        m = min(max(mean(rates), 1e-6), 1 - 1e-6)
        spread = (variance(rates) if len(rates) > 1 else 0.0) - m * (1 - m) * noise
        weight = min(max(m * (1 - m) / spread - 1, 2), 1000) if spread > 0 else 1000
        bad |= {h for h, rows in hosts.items() if (failed[h] + m * weight) / (len(rows) + weight) >= 0.9}
    return bad


def test_run_with_a_bad_host_against_brute_force(spark, tmp_path):
    """Two planted hosts: one fails a rule nearly always; the other fails two rules half the time each, which condemns it by both together."""
    columns = ["doc_id", "text", "source"]
    given = spark.read.parquet(f"{SF}/documents.parquet")
    planted = [(10**9 + i, f"short {i}", "planted bad") for i in range(120)]
    planted += [(2 * 10**9 + i, "short" if i % 2 else f"again and again {i} " * 30, "planted mixed") for i in range(120)]
    planted += [(k * 10**9 + 500 + i, test_host_quality.good(10 * k + i), h) for k, h in ((1, "planted bad"), (2, "planted mixed")) for i in range(4)]
    more = spark.createDataFrame(planted, "doc_id long, text string, source string")
    given.unionByName(more, allowMissingColumns=True).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = [tuple(r) for r in given.select(*columns).collect()] + planted
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = rejected_hosts(docs)
    assert bad == {"planted bad", "planted mixed"}
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == brute([d for d in docs if d[2] not in bad], items)
    assert not [d for d, *_ in got if d >= 10**9]
    assert len(brute(docs, items)) == len(got) + 8  # the verdicts are what removes these eight


def test_passages_of_fifty_words_go(spark):
    """Planted passages of 51 to 60 words, which are shorter than 400 bytes, go from every document; the rest of the texts stays."""
    import random

    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 8)))
    passages = [" ".join(word() for _ in range(51 + i)) for i in range(10)]
    rows = [(i, f"{' '.join(word() for _ in range(60))}\n{passages[i % 12]}\n{' '.join(word() for _ in range(60))}" if i % 12 < 10 else " ".join(word() for _ in range(120))) for i in range(120)]
    out = {r.doc_id: r.text for r in corpus_pipeline.suffix_array_dedup(spark, frame(spark, rows), SF).collect()}
    assert any(len(p) < 400 for p in passages)
    for i, text in rows:
        if i % 12 < 10:
            assert passages[i % 12][5:-5] not in out[i] and text[:200] == out[i][:200] and text[-200:] == out[i][-200:]
        else:
            assert out[i] == text

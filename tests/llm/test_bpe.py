import array
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from govframe.llm import bpe as B
from tests.llm.util import frame

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=B.read_ranks(f.read()), special_tokens={})


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    letters = "aab  \n\t'srtéßñ漢字😀́\x1c\x85١٢3.,!-_​\xa0"
    out = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(3000)]
    return [*out, "", "a" * 5000, "ab" * 3000, " " * 1000 + "x", "\n" * 777, "étéé" * 2000, "<|endoftext|>", "it's we'll I'D"]


def test_ids_are_the_librarys(library, texts):
    coder = B.Replay(library._mergeable_ranks, P.PATTERN)
    for part in (texts, texts[:7], texts):  # the known pieces of a block serve the next
        for text, packed in zip(part, coder.encode_block(part), strict=True):
            assert array.array("I", packed).tolist() == library.encode_ordinary(text)
            assert coder.decode(packed) == text.encode()


def test_forgetting_changes_nothing(library, texts, monkeypatch):
    monkeypatch.setattr(B, "KNOWN_PIECES", 3)
    coder = B.Replay(library._mergeable_ranks, P.PATTERN)
    for i in range(0, 300, 10):
        for text, packed in zip(texts[i : i + 10], coder.encode_block(texts[i : i + 10]), strict=True):
            assert array.array("I", packed).tolist() == library.encode_ordinary(text)


def test_tables_round_trip(spark, library, texts):
    rows = [(i, t) for i, t in enumerate(texts[:200])] + [(None, "null id"), (7, None), (7, None)]
    df = frame(spark, rows)
    encoded = B.encode_documents(spark, df, PATH, P.PATTERN)
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.ids, r.n_tokens) for r in encoded.collect())
    assert got == sorted((d is not None, d or 0, ids := library.encode_ordinary(t or ""), len(ids)) for d, t in rows)
    decoded = B.decode_documents(spark, encoded, PATH, P.PATTERN)
    assert sorted((r.doc_id is not None, r.doc_id or 0, bytes(r.decoded)) for r in decoded.collect()) == sorted((d is not None, d or 0, (t or "").encode()) for d, t in rows)
    assert B.encode_documents(spark, df.limit(0), PATH, P.PATTERN).collect() == []


def test_query(spark, library):
    from govframe.llm.queries import op5_byte_bpe

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in op5_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    assert got.keys() == docs.keys()
    for doc, text in docs.items():
        ids = array.array("I", library.encode_ordinary(text))
        assert got[doc].n_tokens == len(ids)
        assert got[doc].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got[doc].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_plan_has_no_shuffle(spark):
    from govframe.llm.queries import op5_byte_bpe

    assert "Exchange" not in op5_byte_bpe(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()

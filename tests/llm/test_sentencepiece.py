import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm import sentencepiece_bpe as B
from tests.llm.conftest import DOC_SCHEMA

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
MODEL = B.load(PATH)


def check(texts):
    for t, ids in zip(texts, MODEL.encode(texts)):
        assert ids.tolist() == LIBRARY.encode(t), repr(t[:60])
        assert MODEL.decode(ids) == LIBRARY.decode(ids.tolist())


def test_odd_texts(odd_texts):
    check([t or "" for t in odd_texts])


def test_random_mixtures():
    rng = random.Random(1)
    parts = [*"abethn \n\t▁.,10=", "  ", "é", "ﬁ", "漢", "😀", "́", "\x00", "ing", "the", "ation"]
    check(["".join(rng.choices(parts, k=rng.randint(0, 50))) for _ in range(800)])


def test_long_runs_and_the_queue():
    rng = random.Random(2)
    long = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABC0123/+", k=9_000))
    check([long, "a" * 5_000, "ab" * 6_000, " " * 300, "▁" * 77, "\n" * 50, "=" * 900])


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    check([text])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31_999)), max_size=12))
def test_decoding_any_ids(ids):
    assert MODEL.decode(ids) == LIBRARY.decode(ids)


def test_ids_outside_the_vocabulary():
    for ids in ([-1], [5, 32_000]):
        with pytest.raises(IndexError):
            MODEL.decode(ids)


def test_columns(spark, odd_texts):
    docs = spark.createDataFrame(
        [(i, t, None, None, None) for i, t in enumerate(odd_texts)], DOC_SCHEMA).selectExpr(
        "*", "1 AS ids")
    rows = B.decode(B.encode(docs, PATH), PATH).collect()
    for r in rows:
        assert r["ids"] == LIBRARY.encode(r["text"] or "") and r["decoded"] == LIBRARY.decode(r["ids"])
    assert len(rows) == len(odd_texts)
    for r in B.round_trip(docs, PATH).select("text", "tokens.*").collect():
        ids = LIBRARY.encode(r["text"] or "")
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest())
    assert B.round_trip(docs.limit(0), PATH).count() == 0

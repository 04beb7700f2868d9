import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import language_id as L
from tests.llm.conftest import DOC_SCHEMA

SYLLABLES = {"aa": "the and ing er on".split(), "bb": "sch ein ung ich der".split(),
             "cc": "ção não que dos éu".split()}


def text(lang, rng, n=40):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(8)
    rows = [(i, text(lang, rng), lang, "s", 0) for i, lang in enumerate(rng.choices("aa bb cc".split(), k=240))]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def brute_force_bundle(t, dimensions):
    """Vector by vector, as the method says."""
    a, b, c = L.letter_vectors(dimensions)
    classes = L.letter_classes()
    own = [0] + [int(classes[ord(ch)]) for ch in t] + [0]
    total = np.zeros(dimensions)
    for i in range(1, len(own) - 1):
        if own[i]:
            total += a[own[i - 1]].astype(float) * b[own[i]] * c[own[i + 1]]
    return total


def test_bundles_against_brute_force():
    texts = ["Abc de!", "", "éß ñandú ДЖ 漢字", "x", "a" * 50, "--"]
    found, n = L.bundles(texts, 256)
    for t, v, k in zip(texts, found, n):
        assert (v == brute_force_bundle(t, 256)).all() and k == sum(ch.isalpha() for ch in t)


def test_prototypes_sum_all_training_texts(docs):
    profiles = L.learn(docs, dimensions=256)
    for lang, v in zip(profiles.languages, profiles.prototypes):
        total = sum(brute_force_bundle(r["text"], 256) for r in docs.filter(
            F.col("lang") == lang).collect())
        assert np.allclose(v, total / np.linalg.norm(total))


def test_held_out_accuracy(docs):
    held = L.id_remainder("doc_id", 4) == 2
    profiles = L.learn(docs.filter(~held))
    rows = L.predict(docs.filter(held), profiles).collect()
    right = [r["language"]["lang"] == r["lang"] for r in rows]
    assert len(right) > 30 and sum(right) >= 0.98 * len(right)
    assert all(0 <= r["language"]["score"] <= 1 and r["language"]["known"] for r in rows)


def test_odd_texts(spark, docs, odd_texts):
    profiles = L.learn(docs)
    odd = spark.createDataFrame(
        [(i, t, None, None, None) for i, t in enumerate(odd_texts)], DOC_SCHEMA).selectExpr(
        "*", "1 AS language")
    rows = L.predict(odd, profiles).collect()
    assert len(rows) == len(odd_texts)
    for r in rows:
        letters = any(ch.isalpha() for ch in r["text"] or "")
        assert (r["language"]["lang"] == "und") == (not letters)
        assert letters or (r["language"]["score"], r["language"]["known"]) == (0.0, False)
    assert L.predict(odd.limit(0), profiles).count() == 0


def test_text_unlike_any_language(docs):
    profiles = L.learn(docs)
    strange = "".join(random.Random(1).choices("жщюйкзъхфц", k=400))
    lang, cosine, n = profiles.predict([strange])
    assert cosine[0] < 3 / np.sqrt(L.DIMENSIONS) and n[0] == 400


def test_nothing_learned(spark, docs):
    empty = spark.createDataFrame([(1, None, "aa"), (2, "abc", None)], "doc_id long, text string, lang string")
    profiles = L.learn(empty)
    assert profiles.languages == []
    assert {r["language"]["lang"] for r in L.predict(docs.limit(3), profiles).collect()} == {"und"}


def test_pieces_and_parts_of_trigrams_change_nothing(monkeypatch):
    rng = random.Random(3)
    letters = "abcxyzéßДЖ漢字 -1" + "".join(map(chr, range(0x4E00, 0x4E80)))
    texts = ["".join(rng.choices(letters, k=k)) for k in (0, 1, 9, 10, 11, 400, 1001)]
    monkeypatch.setattr(L, "PIECE_LETTERS", 10)
    monkeypatch.setattr(L, "PRODUCT_TRIGRAMS", 16)
    found, n = L.bundles(texts, 64)
    for t, v, k in zip(texts, found, n):
        assert (v == brute_force_bundle(t, 64)).all() and k == sum(ch.isalpha() for ch in t)
    assert (L._bundle_of_all(texts, 64) == sum(brute_force_bundle(t, 64) for t in texts)).all()


def test_a_long_text_of_many_scripts_needs_little_memory():
    rng = np.random.default_rng(2)
    points = rng.integers(0x4E00, 0x9000, 3_000_000).astype(np.uint32)
    text = points.tobytes().decode("utf-32-le")
    L.letter_classes()
    tracemalloc.start()
    _, n = L.bundles([text], L.DIMENSIONS)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n[0] == len(text) and most < 400 << 20

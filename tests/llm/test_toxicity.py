import random
import time

import pytest
from pyspark.sql import functions as F

from starloom.llm import language_id
from starloom.llm import toxicity as T
from tests.llm.conftest import DOC_SCHEMA


def test_folding():
    assert T.fold(["Ìd1ot! tr@sh​ m0r0n 108.51 IT!! \n 漢字", "", "ѕtupіd", "ﬀ $cum", "b11e"]) == [
        " idiot trash moron it 漢字 ", "  ", " stupid ", " f scum ", " biie "]


@pytest.fixture(scope="module")
def corpus(spark, words):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(900):
        text = rng.choices(words, k=rng.randint(1, 120))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                bad = rng.choice(["blarg", "snorkfool", "grimwit" + rng.choice(["", "s", "ted", "ling"])])
                if rng.random() < 0.3:
                    bad = bad.replace("o", "0").replace("i", "1").replace("a", "а")
                text.insert(rng.randrange(len(text) + 1), bad)
        elif i % 10 == 1:
            text.insert(rng.randrange(len(text) + 1), "kindly blarg")
        rows.append((i, " ".join(text), "en", "s", 0))
        labels.append((i, int(toxic)))
    rows.append((5000, None, None, None, None))
    return (spark.createDataFrame(rows, DOC_SCHEMA),
            spark.createDataFrame(labels + [(None, 1), (3, None), (99999, 1)], "doc_id long, toxic int"))


def test_held_out(corpus):
    docs, labels = corpus
    held = language_id.id_remainder("doc_id", 5) == 0
    lexicon = T.learn(docs, labels.filter(~held))
    rows = T.score(docs, lexicon).filter(held).join(labels.dropna(), "doc_id").collect()
    toxic = [r["toxicity"] for r in rows if r["toxic"]]
    clean = [r["toxicity"] for r in rows if not r["toxic"]]
    assert len(toxic) > 15 and sum(s >= 0.5 for s in toxic) >= 0.95 * len(toxic)
    assert sum(s >= 0.5 for s in clean) <= 0.03 * len(clean)
    patterns = {p for p, _ in lexicon.entries}
    assert any(" grimwit".startswith(p) for p in patterns)  # a beginning, so new endings match


def test_exceptions_cover_matches():
    lexicon = T.Lexicon(((" bad", 3.0), (" worse ", 2.0)), (" badminton club ",), (-1.0, 1.0, 1.0))
    match = lexicon.matches
    assert [(s, e) for s, e, _ in match(" a bad worse one ")] == [(2, 6), (6, 13)]
    assert match(" badminton club ") == [] and len(match(" badminton bad club ")) == 2
    assert lexicon.features(" x ") == (0.0, 0.0)
    assert lexicon.features(" bad ")[1] > lexicon.features(" bad one two three ")[1]


def test_learned_exceptions(corpus):
    lexicon = T.learn(*corpus)
    assert any(p == " kindiy biarg " for p in lexicon.exceptions) or not any(
        " biarg".startswith(p.rstrip()) for p, _ in lexicon.entries)


def test_odd_texts_and_no_labels(spark, corpus, odd_texts):
    docs, labels = corpus
    lexicon = T.learn(docs, labels)
    odd = spark.createDataFrame(
        [(i, t, None, None, None) for i, t in enumerate(odd_texts)], DOC_SCHEMA).selectExpr(
        "*", "1 AS toxicity", "2 AS label")
    rows = T.score(odd, lexicon).collect()
    assert len(rows) == len(odd_texts) and all(0 <= r["toxicity"] < 0.5 for r in rows)
    none = T.learn(docs, labels.limit(0))
    assert {r["toxicity"] for r in T.score(odd, none).collect()} == {0.5}
    assert T.score(odd.limit(0), lexicon).count() == 0


def test_the_sample_is_bounded(corpus):
    _, labels = corpus
    sample = T.labelled_sample(labels.unionAll(labels), "doc_id", "toxic", 50)
    assert sample.count() == 50 and sample.select("__id").distinct().count() == 50
    whole = T.labelled_sample(labels, "doc_id", "toxic", 10**6)
    assert whole.filter(F.col("__id").isNull() | F.col("__label").isNull()).count() == 0


def naive_matches(lexicon, text):
    found = [(i, i + len(p), w) for p, w in lexicon.entries for i in range(len(text)) if text.startswith(p, i)]
    covered = [(i, i + len(p)) for p in lexicon.exceptions for i in range(len(text)) if text.startswith(p, i)]
    return sorted(m for m in found if not any(s <= m[0] and m[1] <= e for s, e in covered))


def test_matches_against_a_naive_matcher():
    rng = random.Random(4)
    lexicon = T.Lexicon(((" ab", 1.0), (" abc ", 2.0), (" b ", 0.5), (" ca", 3.0)),
                        (" ab c ", " c ab ", " b ca ", " abc b ca "))
    for _ in range(300):
        text = f" {' '.join(rng.choices(['ab', 'abc', 'b', 'c', 'ca', 'cab'], k=rng.randint(0, 12)))} "
        assert sorted(lexicon.matches(text)) == naive_matches(lexicon, text)
        for s, e, _ in lexicon.matches(text):
            words = text.split()
            at = text[:s + 1].count(" ") - 1
            assert list(T._phrases(text, s, e)) == [
                f" {a} {b} " for a, b in zip(words, words[1:])][max(0, at - 1):at + 1]


def test_many_matches_and_exceptions_take_seconds():
    lexicon = T.Lexicon(((" bad", 1.0),), (" not bad ",))
    text = " bad not bad" * 100_000 + " "
    start = time.monotonic()
    found = lexicon.matches(text)
    assert len(found) == 100_000 and all(len(list(T._phrases(text, s, e))) for s, e, _ in found)
    assert time.monotonic() - start < 20

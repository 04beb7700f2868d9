"""Packing: ids against the tokenizer, patterns against their histogram, pieces against the texts."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starloom.llm import packing
from starloom.llm.queries import word_tokenizer
from tests.llm.conftest import DOC_SCHEMA


@pytest.fixture(scope="module")
def coder():
    return packing.WordCoder(word_tokenizer())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(word_tokenizer())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_words_are_coded_as_in_whole_texts(coder, library, odd_texts, words):
    rng = random.Random(4)
    letters = "aB.é'ΣςßİIǅ9,; \t\n\u0301\x1f\x85\xa0\u2003\ue000-漢<|>"
    texts = [t or "" for t in odd_texts] + [
        "".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(800)]
    texts += ["<|endoftext|> <|ENDOFTEXT|>, a<|endoftext|>b", "don't we'll L'x", "x" * 70 + "! x",
              " ".join(rng.choices(words, k=5000)), "naïve NAÏVE. Ærø, ĀĂĄ"]
    for _ in range(2):
        assert [np.frombuffer(c, "<u4").tolist() for c in coder.encode(texts)] == [
            ids_of(library, t) for t in texts]


def test_spellings_of_a_word_are_coded_once(library, monkeypatch):
    """Capitals and marks behind a word cost no further call of the tokenizer, in any batch."""
    coder = packing.WordCoder(word_tokenizer())
    coder.encode(["house été ātri , !? ###"])
    coded = coder._ids
    asked = []
    monkeypatch.setattr(coder, "_ids", lambda t, text: asked.append(text) or coded(t, text))
    texts = ["House HOUSE, house!? Été ÉTÉ### house", "", "Ātri, ĀTRI !?"]
    assert [np.frombuffer(c, "<u4").tolist() for c in coder.encode(texts)] == [
        ids_of(library, t) for t in texts]
    assert asked == []


def test_words_with_marks_and_long_words(library, monkeypatch):
    """Also when remembered words are forgotten between batches."""
    monkeypatch.setattr(packing, "CACHE_WORDS", 20)
    coder = packing.WordCoder(word_tokenizer())
    rng = random.Random(6)
    letters = "abBÉéßÿ×÷ªµĀįİ'.,#&<|>_9漢ж\u0301"
    for _ in range(20):
        texts = [" ".join("".join(rng.choices(letters, k=rng.choice([1, 2, 5, 70, 200])))
                          + rng.choice(["", ",", "'", "###", "<|", "'s"])
                          for _ in range(rng.randint(0, 30))) for _ in range(8)]
        texts.append("é" * 90 + "### " + "x" * 200 + "! y" + "#" * 200 + " <|ENDOFTEXT|>!")
        assert [np.frombuffer(c, "<u4").tolist() for c in coder.encode(texts)] == [
            ids_of(library, t) for t in texts]


def uses_up(patterns, counts, capacity):
    used = Counter()
    for pattern, copies in patterns:
        assert copies > 0 and 0 < sum(pattern) <= capacity
        for n in pattern:
            used[n] += copies
    return used == Counter({n: c for n, c in counts.items() if c})


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(0, 400), max_size=40))
def test_plans_use_up_every_rest(counts):
    capacity = 64
    patterns = packing.plan(counts, capacity)
    assert uses_up(patterns, counts, capacity)
    number = sum(c for _, c in patterns)
    assert number >= sum(n * c for n, c in counts.items()) / capacity
    # a place of a pattern is a run of ranks; together they are all ranks, each once
    seen = Counter()
    places = set()
    for n, first, end, sequence, copies, offset in packing.runs(patterns):
        for r in range(first, end):
            seen[n, r] += 1
            at = sequence + (r - first) % copies, offset + n * ((r - first) // copies)
            assert at not in places
            places.add(at)
    assert seen == Counter({(n, r): 1 for n, c in counts.items() for r in range(c)})


def test_generated_patterns_beat_the_greedy_ones():
    """Lengths for which taking the longest first leaves much: 51 + 27 + 22 fill a sequence."""
    counts = {51: 600, 27: 600, 26: 600, 23: 1200, 34: 500, 33: 1000}
    greedy = sum(c for _, c in packing.greedy(counts, 100))
    found, bound = packing.generate(counts, 100, gap=0)
    number = sum(x for _, x in found)
    assert abs(number - bound) <= 0.51
    planned = packing.plan(counts, 100)
    assert uses_up(planned, counts, 100)
    assert sum(c for _, c in planned) <= number + len(counts)
    assert sum(c for _, c in planned) < 0.97 * greedy


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.integers(1, 31), st.integers(1, 9), min_size=1, max_size=6))
def test_bound_holds_for_every_packing(counts):
    """No packing, found by first fit over many orders, needs fewer sequences than the bound."""
    _, bound = packing.generate(counts, 32)
    rests = [n for n, c in counts.items() for _ in range(c)]
    rng = random.Random(0)
    for _ in range(30):
        rng.shuffle(rests)
        rooms = []
        for n in rests:
            k = next((k for k, room in enumerate(rooms) if room >= n), None)
            if k is None:
                rooms.append(32 - n)
            else:
                rooms[k] -= n
        assert len(rooms) >= bound - 1e-6


def check(rows, texts, library, capacity):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    assert sorted(by_doc) == sorted(texts)
    for doc, pieces in by_doc.items():
        ids = ids_of(library, texts[doc]) + [1]
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            own = ids[at:at + r["length"]]
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
            if "ids" in r:
                assert r["ids"] == own
            at += r["length"]
        assert at == len(ids)
    return by_sequence


def test_pieces_are_the_texts(spark, library, odd_texts, words):
    rng = random.Random(8)
    texts = dict(enumerate(odd_texts + [" ".join(rng.choices(words, k=rng.randint(0, 90)))
                                        for _ in range(300)] + ["same text"] * 50))
    docs = spark.createDataFrame(
        [(i, t, None, None, None) for i, t in texts.items()], DOC_SCHEMA).repartition(5)
    packed = packing.pack(docs, word_tokenizer(), capacity=128)
    rows = [r.asDict() for r in packed.collect()]
    by_sequence = check(rows, texts, library, 128)
    tokens = sum(r["length"] for r in rows)
    assert 128 * len(by_sequence) <= 1.02 * tokens
    for r in packing.sequences(packed, 128, pad_id=0).collect():
        own = sorted(by_sequence[r["sequence_id"]], key=lambda p: p["offset"])
        ids = [i for p in own for i in p["ids"]]
        size = len(ids) if len(ids) & (len(ids) - 1) == 0 else 128
        assert r["ids"] == ids + [0] * (size - len(ids))
        assert r["lengths"] == [p["length"] for p in own]


def test_query_packs_whole_documents(spark, library):
    from starloom.llm.queries import QUERIES
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [r.asDict() for r in QUERIES["op13_packing"](spark, "/root/testdata/sf0.001").collect()]
    check(rows, {r["doc_id"]: r["text"] for r in docs.collect()}, library, 2048)


def test_empty_repeated_and_clashing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(empty, word_tokenizer()).collect() == []
    docs = spark.createDataFrame(
        [(None, "a b", 1, 2)] * 5 + [(1, None, 1, 2)] * 3,
        "doc_id long, text string, length int, sequence_id int")
    rows = packing.pack(docs, word_tokenizer(), capacity=8).collect()
    assert sorted(r["length"] for r in rows) == [1, 1, 1, 3, 3, 3, 3, 3]
    assert len({r["sequence_id"] for r in rows}) == 3


def test_other_tokenizers_are_refused():
    import public_tokenizers
    with pytest.raises(ValueError, match="drop white space"):
        packing.WordCoder(public_tokenizers.path("byte_bpe_50k.json"))

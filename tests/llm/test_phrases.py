"""Phrase mining against plain counting, and what its summaries guarantee."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm import phrases
from tests.llm.conftest import DOC_SCHEMA


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, threshold, most):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lower(text or "")):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i:i + k])] += 1
    found = []
    for lang, counts in f.items():
        big = {p: c for p, c in counts.items() if c >= threshold}
        rows = []
        for p, a in big.items():
            if len(p) < 2 or any(len(q) > len(p) and 100 * c >= 100 * a and any(
                    q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                    for q, c in big.items()):
                continue
            score, k = min((1000 * a * n[lang] // (big[p[:k]] * big[p[k:]]), k)
                           for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), big[p[:k]], big[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:most], 1):
            found.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(found)


def found(spark, rows, threshold, most=2000, schema=DOC_SCHEMA):
    docs = spark.createDataFrame(
        [(i, text, lang, None, None) for i, (text, lang) in enumerate(rows)], schema)
    return sorted(map(tuple, phrases.collocations(docs, threshold, most).collect()))


def texts(rng, words, n):
    pool = rng.choices(words, k=7)
    return [" ".join(rng.choice(pool) + rng.choice(["", "", "", ",", ".\n", "\t"])
                     for _ in range(rng.randint(0, 120))) for _ in range(n)]


def test_against_counting(spark, words, odd_texts):
    rng = random.Random(1)
    rows = [(t, rng.choice(["en", "de", None, ""])) for t in texts(rng, words, 300) + odd_texts]
    rows += [("New York City is. NEW YORK city", "en")] * 40 + [("ab cd é É ß", "fr")] * 30
    rows += [("a a a a a a a", "x")] * 9
    got = found(spark, rows, 20)
    assert got == brute(rows, 20, 2000)
    assert len(got) > 50
    assert found(spark, rows, 20, 3) == brute(rows, 20, 3)


def test_nothing_to_mine(spark):
    assert found(spark, [], 5) == []
    assert found(spark, [(None, None), ("", "en"), (" . ", "en"), ("once", "en")], 5) == []


def test_result_does_not_depend_on_the_map(spark, words, monkeypatch):
    rows = [(t, "en") for t in texts(random.Random(2), words, 200)]
    expected = brute(rows, 15, 2000)
    monkeypatch.setattr(phrases, "MAP_BITS", 6)
    monkeypatch.setattr(phrases.bit_map, "__defaults__", (6,))
    assert found(spark, rows, 15) == expected


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), min_size=1, max_size=80), max_size=40),
       st.integers(2, 30), st.integers(1, 12))
def test_every_frequent_key_survives(parts, threshold, capacity):
    """Whatever the order and size of the parts, and however few counters there are at first."""
    summary = phrases.Summary(threshold, capacity)
    total = Counter()
    for part in parts:
        keys, counts = np.unique(np.array(part, np.uint64), return_counts=True)
        summary.add(keys, counts.astype(np.int64))
        total.update(part)
    survivors = set(summary.survivors().tolist())
    assert {k for k, c in total.items() if c >= threshold} <= survivors
    assert summary.error < threshold and summary.mass == sum(total.values())
    left = dict(zip(summary.keys.tolist(), summary.counts.tolist()))
    assert all(left.get(k, 0) <= c <= left.get(k, 0) + summary.error for k, c in total.items())


def test_scores_beyond_64_bits(spark):
    rng = random.Random(3)
    rows = [tuple(rng.randrange(1, 10**k) for k in (12, 14, 10, 11)) for _ in range(200)]
    rows.append((10**13, 10**14, 10**13, 10**14))
    df = spark.createDataFrame(rows, "a long, n long, l long, r long")
    got = df.select("*", phrases._exact_score(*[df[c] for c in "anlr"]).alias("s")).collect()
    assert all(r["s"] == 1000 * r["a"] * r["n"] // (r["l"] * r["r"])
               for r in got if 1000 * r["a"] * r["n"] // (r["l"] * r["r"]) < 2**63)


def test_words_of_one_hash_are_told_apart():
    flat = np.frombuffer(b"ab cd ab", np.uint8)
    starts, stops = np.array([0, 3, 6]), np.array([2, 5, 8])
    same = np.zeros(3, np.uint64)
    kind, first = phrases.distinct(flat, starts, stops, same)
    assert kind.tolist() == [0, 1, 0] and first.tolist() == [0, 1]

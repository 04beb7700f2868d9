"""The prefix trie against rebuilt conversations that are really built."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from starloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[c].append((turn is not None, turn or 0, role, digest, text))
    for t in turns.values():
        t.sort()
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = turns.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])
        rebuilt[c] = [(x[2], x[4]) for x in base[:h] + own[h:]]
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    return sorted((
        min(m), len(k), min(members[k[:-1]]) if k else -10**9, len(m), children[k], leaves[k],
        saved[k], hashlib.sha256(",".join(
            str(c) for c in sorted(m) if len(rebuilt[c]) == len(k)).encode()).hexdigest())
        for k, m in members.items())


def found(spark, rows, schema=SCHEMA):
    return sorted(tuple(-10**9 if v is None else v for v in r) for r in prefix_trie.prefix_trie(
        spark.createDataFrame(rows, schema)).collect())


def conversations(rng, n, texts):
    return [(c, t, rng.choice(["user", "assistant", None]), rng.choice(texts))
            for c in rng.sample(range(-20, 4 * n), n) for t in range(rng.randint(1, 14))]


def test_against_brute_force(spark, odd_texts):
    rng = random.Random(5)
    rows = conversations(rng, 60, ["a", "b"]) + conversations(rng, 3, odd_texts)
    rows += [(7, None, "user", "x"), (7, None, "user", "x"), (7, 1, None, None), (None, 1, "a", "b"),
             (10, 0, "a", "bc"), (11, 0, "ab", "c"), (12, 5, "user", "long " * 50_000)]
    assert found(spark, rows) == brute(rows)


def test_long_conversation_is_cut_into_blocks(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(5, t, "user", rng.choice("ab")) for t in range(700)] + conversations(rng, 20, ["a"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = prefix_trie.turn_rows(spark.createDataFrame(rows, SCHEMA))
        assert turns.filter("conv = 5").select("block").distinct().count() > 3
        assert found(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_failed_fingerprints_are_replaced(spark, monkeypatch):
    """With bases of which the first makes every order of turns alike, the second is taken."""
    rng = random.Random(7)
    rows = conversations(rng, 40, ["a", "b", "c"])
    bases = prefix_trie._bases
    monkeypatch.setattr(prefix_trie, "_bases", lambda seed: [1] * 3 if seed == 0 else bases(seed))
    assert found(spark, rows) == brute(rows)


def test_many_ends_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ENDS_SPAN", 4)
    rows = [(c, 0, "user", "same") for c in range(-30, 95)]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "a", "b")]])
def test_no_conversation_has_no_root(spark, rows):
    assert found(spark, rows) == []


def test_other_columns_play_no_part(spark):
    rows = [(c, 0, "user", "hi", c, 1, 2) for c in range(9)]
    assert found(spark, rows, SCHEMA + ", f0 long, d long, owner long") == brute(
        [r[:4] for r in rows])

import zlib
from collections import Counter

import pytest

from starloom.llm import sharding as S
from tests.llm.conftest import DOC_SCHEMA


def place(spark, n, shards):
    rows = spark.range(n).selectExpr("id AS doc_id")
    return {r["doc_id"]: r for r in S.shard_rows(rows, "doc_id", shards).collect()}


def brute_force(points, shards, virtual_nodes=S.VIRTUAL_NODES):
    """Keys one round after the other, arcs in ring order, numbers by point."""
    ring = S.make_ring(shards, virtual_nodes)
    arcs = {}
    for key, point in points:
        arc = next((i for i, p in enumerate(ring.points) if p >= point), 0)
        arcs.setdefault(arc, []).append((point, key))
    room = S.capacities(len(points), shards)
    out, left = {}, {a: sorted(ks) for a, ks in arcs.items()}
    for step in range(shards):
        for arc in sorted(left):
            shard = ring.order[arc][step]
            take, left[arc] = left[arc][:room[shard]], left[arc][room[shard]:]
            room[shard] -= len(take)
            out.update({key: shard for _, key in take})
    return out


@pytest.mark.parametrize("n,shards", [(1, 8), (7, 8), (1000, 8), (4001, 5)])
def test_counts_are_at_most_one_apart_and_slots_gapless(spark, n, shards):
    rows = place(spark, n, shards).values()
    by = {s: sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(shards)}
    assert sum(map(len, by.values())) == n
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(slots == list(range(len(slots))) for slots in by.values())


def test_against_brute_force(spark):
    df = spark.range(3000).selectExpr(
        "id AS doc_id", "shiftrightunsigned(xxhash64(string(id)), 32) AS point")
    expected = brute_force([(r["doc_id"], r["point"]) for r in df.collect()], 6)
    got = {k: r["shard"] for k, r in place(spark, 3000, 6).items()}
    assert got == expected


def test_another_shard_moves_few_rows(spark):
    a, b = place(spark, 8000, 8), place(spark, 8000, 9)
    moved = sum(a[k]["shard"] != b[k]["shard"] for k in a)
    assert moved < 0.45 * 8000  # a ninth must move, a plain modulus moves 8 of 9


def test_hot_key_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "ROWS_PER_BLOCK", 50)
    rows = spark.range(3000).selectExpr("IF(id % 3 = 0, 7, id) AS doc_id", "id AS other")
    out = S.shard_rows(rows, "doc_id", 4).collect()
    assert Counter(r["shard"] for r in out) == {s: 750 for s in range(4)}
    for s in range(4):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(750))


def test_sizes_nulls_clashes_and_empty(spark, odd_texts):
    docs = spark.createDataFrame(
        [(i if i else None, t, None, None, None) for i, t in enumerate(odd_texts)], DOC_SCHEMA)
    sizes = {r["doc_id"]: r for r in S.text_sizes(docs).collect()}
    for i, t in enumerate(odd_texts):
        data = (t or "").encode()
        assert (sizes[i or None]["size"], sizes[i or None]["text_crc32"]) == (
            len(data) + 1, zlib.crc32(data))
    clash = docs.selectExpr("doc_id", "'x' AS shard", "n_chars AS slot")
    out = S.shard_rows(clash, "doc_id", 3)
    assert out.columns == ["doc_id", "shard", "slot"] and out.count() == len(odd_texts)
    assert S.shard_rows(docs.select("doc_id").limit(0), "doc_id", 3).count() == 0
    twice = docs.select("doc_id").unionAll(docs.select("doc_id"))
    assert S.shard_rows(twice, "doc_id", 3).count() == 2 * len(odd_texts)


def test_moved_rows(spark):
    rows = spark.range(500).selectExpr("id AS doc_id")
    a, b = S.shard_rows(rows, "doc_id", 3), S.shard_rows(rows, "doc_id", 4)
    assert sum(r["rows"] for r in S.moved_rows(a, b, "doc_id").collect()) == 500

import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.llm import simhash as S
from starloom.llm.components import connected_components
from tests.llm.conftest import DOC_SCHEMA


def brute_force_fp(text, words):
    found = (text or "").encode().lower().split()
    shingles = [b" ".join(found[i:i + words]) for i in range(max(1, len(found) - words + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_force_components(nodes, radius):
    """Least id reachable over links, for (id, fp) rows."""
    parent = {i: i for i, _ in nodes}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in nodes:
        for j, b in nodes:
            if i < j and bin(a ^ b).count("1") <= radius:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i, _ in nodes}


def test_fingerprints(odd_texts, words):
    texts = odd_texts + [" ".join(words[:n]) for n in (1, 2, 3, 4, 50)]
    for k in (3, 5):
        got = S.fingerprints([t or "" for t in texts], k)
        assert [int(x) for x in got] == [brute_force_fp(t, k) for t in texts]


@pytest.fixture(scope="module")
def rows(odd_texts, words):
    rng = random.Random(12)
    out = list(odd_texts)
    for _ in range(25):
        base = rng.choices(words, k=rng.randint(30, 300))
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
    out += ["one hot text of many copies in the table"] * 60
    rng.shuffle(out)
    return [(i, t, "x", "y", 0) for i, t in enumerate(out)]


@pytest.mark.parametrize("radius", [0, 3, 7])
def test_components_against_brute_force(spark, rows, radius, monkeypatch):
    monkeypatch.setattr(S, "BUCKET_ROWS", 16)  # large buckets are cut and meet part by part
    monkeypatch.setattr(S, "LISTED_ROWS", 4)
    docs = spark.createDataFrame(rows, DOC_SCHEMA).selectExpr("*", "1 AS fp", "2 AS component_id")
    got = {r["doc_id"]: (r["fp"] % (1 << 64), r["component_id"]) for r in S.near_components(
        docs, radius).collect()}
    nodes = [(i, brute_force_fp(t, 3)) for i, t, *_ in rows]
    assert {i: f for i, (f, _) in got.items()} == dict(nodes)
    assert {i: c for i, (_, c) in got.items()} == brute_force_components(nodes, radius)


def test_dense_group_in_many_parts(spark, monkeypatch):
    """Fingerprints around one centre: nearly all pairs are candidates and many are links."""
    monkeypatch.setattr(S, "BUCKET_ROWS", 32)
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    fps = sorted({centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 4))) % (1 << 64)
                  for _ in range(600)})
    nodes = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    edges = {(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in S.links(nodes, 3).collect()}
    assert all(bin(a ^ b).count("1") <= 3 for a, b in edges)
    ids = {f: i for i, f in enumerate(fps)}
    want = brute_force_components([(i, f) for f, i in ids.items()], 3)
    parent = {i: i for i in ids.values()}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = sorted((root(ids[a]), root(ids[b])))
        parent[y] = x
    assert {i: root(i) for i in parent} == want


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=8), st.integers(0, 2**32),
       st.integers(0, 8))
def test_links_share_a_signature(fp, flipped, seed, radius):
    """The pigeonhole holds for any plan that the statistics can give."""
    rng = np.random.default_rng(seed)
    bits = rng.random((200, 64)) < rng.random(64)
    together = bits.T.astype(float) @ bits
    n = int(rng.choice([200, 10**5, 10**8, 10**11]))
    plan = S.make_plan(n, np.diag(together) * (n / 200), together * (n / 200), radius)
    assert sorted(b for p in plan.partitions for b in p) == list(range(64))
    assert sum(t + 1 for t in plan.thresholds) == radius + 1
    other = fp ^ sum(1 << b for b in list(flipped)[:radius])
    assert any(fp & m == other & m for m in plan.signatures())


def test_plans_change_with_the_number_of_rows():
    half = np.full((64, 64), 0.25)
    np.fill_diagonal(half, 0.5)

    def plan(n):
        return S.make_plan(n, np.diag(half) * n, half * n, 3)

    assert len(plan(10**4).partitions) >= len(plan(10**10).partitions)
    assert len(set(plan(10**9).thresholds)) > 1 or set(plan(10**9).thresholds) != {0}


def test_missing_ids_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (None, "q r s")], "doc_id long, text string")
    got = sorted(str((r["doc_id"], r["component_id"])) for r in S.near_components(docs).collect())
    assert got == sorted(["(None, 4)", "(4, 4)", "(None, None)"])
    assert S.near_components(docs.limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark, rows):
    docs = spark.createDataFrame(rows, DOC_SCHEMA).selectExpr("*", "1 AS n", "2 AS fp")
    out = S.without_near_duplicates(docs, 7, 3, 0.8, 5)
    assert out.columns == docs.columns
    stay = {r["doc_id"] for r in out.collect()}
    sets = {i: set(S.shingle_hashes(t or "", 5).tolist()) for i, t, *_ in rows}

    def alike(i, j):
        a, b = sets[i], sets[j]
        return len(a & b) >= 0.8 * len(a | b)

    fps = {i: brute_force_fp(t, 3) for i, t, *_ in rows}
    links = {i: {j for j in fps if j != i and bin(fps[i] ^ fps[j]).count("1") <= 7 and alike(i, j)}
             for i in fps}
    for i in fps:  # the group of i over all links, its least id stays
        group, open_ = {i}, [i]
        while open_:
            new = links[open_.pop()] - group
            group |= new
            open_ += new
        if i == min(group):
            assert i in stay
        else:
            assert any(alike(i, j) for j in group - {i})
    assert len(stay) <= len(fps) - 59
    assert S.without_near_duplicates(docs.limit(0), 7, 3, 0.8, 5).count() == 0


def brute_force_stay(texts, radius, words, least, check_words):
    """Ids (places in ``texts``) that are the least of their group over all links."""
    fps = S.fingerprints([t or "" for t in texts], words)
    sets = [set(S.shingle_hashes(t or "", check_words).tolist()) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= radius).tolist():
            if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i for i in range(len(texts)) if root(i) == i}


def stay(spark, texts, *rule):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"] for r in S.without_near_duplicates(docs.repartition(5), *rule).collect()}


@pytest.mark.parametrize("most", [16, 4096])
def test_copies_that_only_their_centre_links(spark, words, most, monkeypatch):
    """Copies reach the similarity with the base text but not with each other."""
    monkeypatch.setattr(S, "BUCKET_ROWS", most)
    rng = random.Random(21)
    texts = []
    for _ in range(3):
        base = rng.choices(words, k=400)
        group = [base]
        for _ in range(90):
            copy = list(base)
            for at in rng.sample(range(400), 8):
                copy[at] = rng.choice(words)
            group.append(copy)
        texts += [" ".join(t) for t in group]
    rng.shuffle(texts)
    want = brute_force_stay(texts, 7, 3, 0.8, 5)
    assert 3 < len(want) < 200
    assert stay(spark, texts, 7, 3, 0.8, 5) == want


@pytest.mark.parametrize("bucket,listed", [(16, 2), (4096, 32)])
def test_the_least_of_each_group_stays_and_no_other(spark, rows, words, bucket, listed, monkeypatch):
    monkeypatch.setattr(S, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(S, "LISTED_ROWS", listed)
    rng = random.Random(30)
    base = rng.choices(words, k=400)
    group = [base]
    for _ in range(60):
        group.append(list(base))
        for at in rng.sample(range(400), 8):
            group[-1][at] = rng.choice(words)
    group = [" ".join(t) for t in group]
    fps = S.fingerprints(group, 3)
    assert fps.min() < fps[0]  # the centre does not have the smallest fingerprint
    texts = [t for _, t, *_ in rows] + group[1:] + group[:1]
    assert stay(spark, texts, 7, 3, 0.8, 5) == brute_force_stay(texts, 7, 3, 0.8, 5)


def test_rows_of_equal_fingerprint_link_without_their_head(spark, words):
    """One passage repeated over and over sets the fingerprint; the tails set the similarity."""
    rng = random.Random(8)
    passage = rng.choices(words, k=12)
    texts = []
    for _ in range(6):
        tail = rng.choices(words, k=60)
        for _ in range(5):
            copy = list(tail)
            copy[rng.randrange(60)] = rng.choice(words)
            texts += [" ".join(passage * 60 + copy)] * 2
            texts.append(" ".join(passage * 61 + copy))  # the same shingles, repeated once more
    rng.shuffle(texts)
    assert len(set(S.fingerprints(texts, 3).tolist())) < 40
    want = brute_force_stay(texts, 7, 3, 0.8, 5)
    assert 1 < len(want) < 30
    assert stay(spark, texts, 7, 3, 0.8, 5) == want


def test_connected_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 7), (3, 9), (9, 3), (3, 9)]
    edges += [(500, 500 + i) for i in range(1, 80)]
    edges += [(1000 + rng.randrange(80), 1000 + rng.randrange(80)) for _ in range(60)]
    got = {r["node"]: r["component"] for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {i: i for e in edges if e[0] != e[1] for i in e}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    assert got == {i: root(i) for i in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_least_of_each_component_stays(spark, rows):
    """Against the components by brute force, with clashing columns, repeated ids and rows."""
    docs = spark.createDataFrame(rows, DOC_SCHEMA).withColumns({
        c: F.lit(7) for c in ("fp", "row", "least", "component", "stays")})
    named = {r["doc_id"]: r["component_id"] for r in S.near_components(docs, 3).collect()}
    stay = S.one_of_each(docs.repartition(4), 3)
    assert stay.columns == docs.columns
    assert sorted(r["doc_id"] for r in stay.collect()) == sorted(
        i for i, c in named.items() if i == c)
    twice = docs.union(docs)
    assert S.one_of_each(twice, 3).count() == stay.count()
    assert S.one_of_each(docs.limit(0), 3).count() == 0

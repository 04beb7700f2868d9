import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import ann as A

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, asked, k):
    out = {}
    for i, v in rows:
        if asked(i):
            scored = sorted((-float(np.dot(v.astype(np.float64), w.astype(np.float64))), j)
                            for j, w in rows if j != i and len(w) == len(v))
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize("dim,n", [(3, 60), (48, 700)])
def test_recall_and_exact_scores(spark, dim, n, monkeypatch):
    monkeypatch.setattr(A, "VECTOR_ROWS", 128)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=dim) * rng.uniform(0.2, 3)).astype(np.float32)) for i in range(n)]
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in rows], SCHEMA)
    got = found(A.nearest(df, F.col("vec_id") % 5 == 0, 10))
    want = brute_force(rows, lambda i: i % 5 == 0, 10)
    assert got.keys() == want.keys()
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits >= 0.98 * sum(map(len, want.values()))
    scores = {(q, j): s for q in want for j, s in want[q]}
    for q in got:
        for j, s in got[q]:
            assert (q, j) not in scores or s == pytest.approx(scores[q, j], rel=1e-12)


def test_odd_vectors_ties_and_few_candidates(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [0.5, 2.0], 1), (2, [0.5, 1.0], 1), (3, None, 1), (4, [0.0, 0.0], 1),
            (5, [None, 1.0], 1), (6, [float("nan"), 1.0], 1), (7, [float("inf"), 1.0], 1), (8, [], 1),
            (None, [9.0, 9.0], 1), (20, [1.0, 2.0, 3.0], 1), (40, [-1.0, 0.0], None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS rank", "2 AS score")
    got = found(A.nearest(df, F.col("vec_id") % 20 == 0, 20))
    assert got == {0: [(1, 0.5), (2, 0.5), (40, -1.0)], 40: [(1, -0.5), (2, -0.5), (0, -1.0)]}
    assert A.nearest(df.limit(0), F.col("vec_id") % 20 == 0, 20).count() == 0


def test_many_copies_of_one_vector(spark, monkeypatch):
    monkeypatch.setattr(A, "VECTOR_ROWS", 64)
    rng = np.random.default_rng(1)
    hot = rng.normal(size=16).astype(np.float32)
    rows = [(i, hot if i % 3 else rng.normal(size=16).astype(np.float32)) for i in range(400)]
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in rows], SCHEMA)
    got = found(A.nearest(df, F.col("vec_id") == 1, 20))
    assert [j for j, _ in got[1]] == [j for j, _ in brute_force(rows, lambda i: i == 1, 20)[1]]


def test_bounds_hold(spark):
    rng = np.random.default_rng(2)
    v, q = (rng.normal(size=(n, 64)).astype(np.float32) for n in (500, 40))
    guess, bound = A.estimate(*A.encode(v), q)
    assert (np.abs(guess - v @ q.T) <= bound).mean() > 0.99

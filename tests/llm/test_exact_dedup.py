import hashlib
import re

import pytest
from pyspark.sql import functions as F

from starloom.llm import exact_dedup as E
from tests.llm.conftest import DOC_SCHEMA


def clean(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(clean(t), []).append(i)
    return {i: (min(groups[clean(t)]), len(groups[clean(t)]), i == min(groups[clean(t)]),
                hashlib.sha256(clean(t).encode()).hexdigest()) for i, t in rows}


def got(df):
    return {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"])
            for r in df.collect()}


@pytest.mark.parametrize("digest", [E.sha256_hex, lambda t: F.substring(E.sha256_hex(t), 1, 1)],
                         ids=["sha256", "colliding"])
def test_against_brute_force(spark, odd_texts, words, digest):
    rows = list(enumerate(odd_texts + odd_texts[::-1] + [" ".join(words[i:i + 3]) for i in range(60)]
                          + ["hot copy"] * 90))
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], DOC_SCHEMA)
    assert got(E.exact_duplicates(docs, digest=digest)) == expected(rows)


def test_ids_missing_or_repeated(spark):
    docs = spark.createDataFrame(
        [(None, "a"), (5, "a"), (3, "b"), (3, "b"), (None, "c"), (None, "c")],
        "doc_id long, text string")
    rows = E.exact_duplicates(docs).collect()
    kept = sorted((r["keep_id"] is None, r["keep_id"], r["group_size"]) for r in rows if r["kept"])
    assert kept == [(False, 3, 2), (False, 5, 2), (True, None, 2)]
    assert E.keep_first(docs).count() == 3


def test_keep_first_from_files_keeps_all_columns(spark, tmp_path):
    docs = spark.createDataFrame(
        [(2, "x y"), (1, "x  y"), (4, None), (3, "")], "doc_id long, text string").selectExpr(
        "*", "'a' AS keep", "1 AS digest", "2 AS kept")
    docs.write.parquet(str(tmp_path / "docs"))
    out = E.keep_first(spark.read.parquet(str(tmp_path / "docs")))
    assert out.columns == ["doc_id", "text", "keep", "digest", "kept"]
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 3]


def test_empty(spark):
    docs = spark.createDataFrame([], DOC_SCHEMA)
    assert E.exact_duplicates(docs).count() == 0 and E.keep_first(docs).count() == 0


def test_state_goes_on_with_later_tables(spark, tmp_path):
    store = E.DigestStore(spark, str(tmp_path / "state"))

    def rows(*pairs):
        return spark.createDataFrame(pairs, "id long, digest string").select(
            "digest", F.struct(F.lit(False).alias("no_id"), F.col("id").alias("id")).alias("row"))

    store.ingest(rows((5, "p"), (6, "q")))
    store.ingest(rows((3, "p"), (9, "r")))
    assert {(r["digest"], r["keep"]["id"], r["group_size"]) for r in store.current().collect()} == {
        ("p", 3, 2), ("q", 6, 1), ("r", 9, 1)}


def test_no_python_in_the_plan(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    plan = E.exact_duplicates(spark.read.parquet(str(tmp_path / "d")))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)

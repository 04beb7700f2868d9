"""The registered queries: against their SQL where it exists, else for whole tables and columns."""

import pytest

import corpus_pipeline
from starloom.llm.queries import ORACLES, QUERIES
from starloom.session import materialise
from tests.oracle import compare, duck

SF_DIR = "/root/testdata/sf0.001"

COLUMNS = {
    1: "doc_id size text_crc32 law shard slot grown_shard",
    2: "page_id payload_bytes payload_digest record_type refers_to",
    3: "doc_id n_tokens ids_sha256 decoded_sha256", 4: "query_id rank vec_id score",
    5: "doc_id held_out lang_pred score", 6: "doc_id fingerprint component_id",
    7: "doc_id held_out score predicted", 8: "doc_id source tokens epoch block position",
    9: "page_id url text n_chars", 10: "doc_id keep_id group_size kept text_sha256",
    11: "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    12: "lang rank phrase a l r n score",
    13: "doc_id start length ids_crc32 doc_tokens sequence_id offset",
}
TABLES = {2: "pages", 9: "pages"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    n = int(name[2:].split("_")[0])
    assert df.columns == COLUMNS[n].split()
    if name in ORACLES:
        assert compare(df, duck(SF_DIR), ORACLES[name]) == []
    elif n not in (4, 13):
        rows = df.collect()
        assert len(rows) == spark.read.parquet(f"{SF_DIR}/{TABLES.get(n, 'documents')}.parquet").count()
        assert len({r[0] for r in rows}) == len(rows)


def test_held_out_rows_are_predicted(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op5_language_id"](spark, SF_DIR).filter("held_out").join(docs, "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.9 * len(rows)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF_DIR), name)
        seen[name] = docs
        assert docs.columns == columns or name == "tokens"
    ids = {k: {r["doc_id"] for r in v.select("doc_id").collect()} for k, v in seen.items()}
    assert ids["mixing"] == ids["near_dedup"] == ids["tokens"] <= ids["exact_dedup"] <= ids["language_id"]
    assert seen["tokens"].filter("NOT lossless").count() == 0
    assert seen["tokens"].count() == corpus_pipeline.run(spark, SF_DIR).count()

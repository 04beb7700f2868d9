"""Locators tell rows apart, whatever stands between them and their files."""

import pytest
from pyspark.sql import functions as F

from starloom.llm import exact_dedup, mixing, simhash
from starloom.llm.common import LOCATOR, with_locator


@pytest.fixture
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


CHANGES = {
    "explode": lambda d: d.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy"),
    "join": lambda d: d.join(d.sparkSession.range(2).withColumnRenamed("id", "copy")).drop("copy"),
    "union": lambda d: d.union(d),
}


@pytest.mark.parametrize("change", CHANGES)
def test_doubled_rows_have_places_of_their_own(spark, docs, change):
    doubled = CHANGES[change](docs)
    assert with_locator(doubled).select(LOCATOR).distinct().count() == 2 * docs.count()
    assert exact_dedup.keep_first(doubled).count() == exact_dedup.keep_first(docs).count()
    assert simhash.one_of_each(doubled).count() == simhash.one_of_each(docs).count()


def test_doubled_rows_are_mixed_twice(spark, docs):
    """But for the last, partial epoch of a source, whose rows are others."""
    once, twice = (mixing.mix(d, 2.0).count() for d in (docs, CHANGES["explode"](docs)))
    assert abs(twice - 2 * once) <= 0.05 * twice


def test_scans_keep_the_places_of_their_files(docs):
    chosen = docs.filter("doc_id > 3").select("doc_id", "text")
    places = with_locator(chosen).select(f"{LOCATOR}.file", f"{LOCATOR}.row").collect()
    assert len(set(places)) == len(places) and all(p["file"] for p in places)

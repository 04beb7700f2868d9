"""From raw documents to tokens: five stages, each written as Parquet and read by the next one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import exact_dedup, language_id, mixing, sentencepiece_bpe, simhash
from starloom.llm.common import table
from starloom.llm.queries import MOST_EPOCHS, sentencepiece_model
from starloom.session import materialise

#: Fingerprints of three-word shingles link at so many differing bits or fewer.
RADIUS, SHINGLE_WORDS = 3, 3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have letters and resemble a language of the corpus."""
    profiles = language_id.learn(docs)
    found = language_id.predict(docs, profiles, into="__language")
    return found.filter("__language.known").drop("__language")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    return simhash.one_of_each(docs, RADIUS, SHINGLE_WORDS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as drawn: each at least once, those of small sources up to the limit."""
    return mixing.mix(docs, max_epochs=MOST_EPOCHS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and whether they decode to its text."""
    model = sentencepiece_model()
    coded = sentencepiece_bpe.encode(docs.select("doc_id", "source", "lang", "text"), model)
    back = sentencepiece_bpe.decode(coded, model)
    return back.select(
        "doc_id", "source", "lang", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("lossless"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mixed),
    ("tokens", tokens),
]

#: The language and token models cannot be told in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The queries of the operators, opN_<name>(spark, sf_dir), and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    ann,
    exact_dedup,
    language_id,
    main_text,
    mixing,
    packing,
    phrases,
    prefix_trie,
    sentencepiece_bpe,
    sharding,
    simhash,
    toxicity,
    warc,
)
from starloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: White space runs as one blank, in DuckDB's spelling.
_NORM_SQL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"


def sentencepiece_model() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7, counts at most one apart."""
    sizes = sharding.text_sizes(table(spark, sf_dir, "documents"))
    return sharding.shard_rows(sizes, "doc_id", 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived, deduplicated by revisit records, and read back."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.round_trip(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded and decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_bpe.round_trip(docs, sentencepiece_model()).select("doc_id", "tokens.*")


@query
def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th one among all vectors."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, F.col("vec_id") % 20 == 0, 20)


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", (language_id.id_remainder("doc_id", 4) == 2).alias("held_out"))
    profiles = language_id.learn(docs.filter("NOT held_out"))
    return language_id.predict(docs.select("doc_id", "text", "held_out"), profiles).select(
        "doc_id", "held_out", F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"))


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the component of its near-duplicates."""
    return simhash.near_components(table(spark, sf_dir, "documents"), radius=3, words=3).select(
        "doc_id", simhash.hex_of("fp").alias("fingerprint"), "component_id")


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every whole document, learned from labelled ones that are not held out."""
    held = language_id.id_remainder("doc_id", 5) == 0
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held.alias("held_out"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held)
    lexicon = toxicity.learn(docs, labels)
    return toxicity.score(docs, lexicon, into="score").select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


#: No source is repeated more often than this in the mix, and every document is read once.
MOST_EPOCHS = 2.0


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as drawn for the mix."""
    return mixing.draws(table(spark, sf_dir, "documents"), max_epochs=MOST_EPOCHS).select(
        F.col("id").alias("doc_id"), "source", "tokens", "epoch", "block",
        F.round("position", 9).alias("position"))


ORACLES["op8_mixing"] = f"""
    WITH RECURSIVE words AS (
        SELECT doc_id, source,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens
        FROM documents),
    totals AS (SELECT source, sum(tokens)::BIGINT AS total, count(*) AS n FROM words GROUP BY source),
    s AS (SELECT sum(total)::BIGINT AS t, min(total) AS lo, max(total) AS hi
          FROM totals WHERE total > 0),
    halves(step, low, high) AS (
        SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
        UNION ALL
        SELECT step + 1,
               CASE WHEN pow(lo / hi, (low + high) / 2 - 1) <= {MOST_EPOCHS} THEN low
                    ELSE (low + high) / 2 END,
               CASE WHEN pow(lo / hi, (low + high) / 2 - 1) <= {MOST_EPOCHS} THEN (low + high) / 2
                    ELSE high END
        FROM halves, s WHERE step < {mixing.STEPS}),
    power AS (SELECT CASE WHEN lo = hi THEN 1.0 ELSE high END AS a
              FROM halves, s WHERE step = {mixing.STEPS}),
    z AS (SELECT sum(pow(total / t, a)) AS z FROM totals, s, power WHERE total > 0),
    plan AS (
        SELECT source, total,
               round(CASE WHEN total > 0 THEN pow(total / t, a) / z ELSE 0 END
                     * t * pow(hi / t, 1 - a) * z)::BIGINT AS quota,
               least({mixing.MOST_BLOCKS}, greatest(1, ceil(greatest(total, n) / {mixing.BLOCK_TOKENS})))::INT
                   AS blocks
        FROM totals, s, power, z),
    cut AS (
        SELECT *, CASE WHEN total > 0 THEN quota // total ELSE 1 END AS rounds,
               CASE WHEN total > 0 THEN quota % total ELSE 0 END AS rest FROM plan),
    dealt AS (
        SELECT w.doc_id, w.source, w.tokens, c.total, c.quota, c.rounds, c.rest,
               (('0x' || substr(md5('0/block/' || doc_id), 1, 8))::BIGINT % c.blocks)::INT AS block,
               unnest(range(0, c.rounds + (c.rest > 0)::INT))::INT AS epoch
        FROM words w JOIN cut c ON w.source IS NOT DISTINCT FROM c.source),
    blocks AS (SELECT source, epoch, block, sum(tokens) AS size FROM dealt GROUP BY ALL),
    starts AS (
        SELECT source, epoch, block, sum(size) OVER (
            PARTITION BY source, epoch
            ORDER BY md5('0/order/' || epoch || '/' || block), block) - size AS block_start
        FROM blocks),
    placed AS (
        SELECT d.*, block_start + sum(tokens) OVER (
            PARTITION BY d.source, d.epoch, d.block
            ORDER BY md5('0/row/' || d.epoch || '/' || doc_id), doc_id) - tokens AS before
        FROM dealt d JOIN starts s ON d.source IS NOT DISTINCT FROM s.source
             AND d.epoch = s.epoch AND d.block = s.block)
    SELECT doc_id, source, tokens, epoch, block, CASE WHEN quota > 0 THEN
               round((epoch * total + before) / quota, 9) ELSE 0.0 END AS position
    FROM placed WHERE epoch < rounds OR before + tokens <= rest"""


@query
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every whole page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text.extract(pages).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the document that stays for its text."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op10_exact_dedup"] = f"""
    WITH clean AS (SELECT doc_id, {_NORM_SQL} AS t FROM documents)
    SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id,
           count(*) OVER (PARTITION BY t) AS group_size,
           doc_id = min(doc_id) OVER (PARTITION BY t) AS kept,
           sha256(t) AS text_sha256
    FROM clean"""


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie over all rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


ORACLES["op11_prefix_trie"] = """
    WITH numbered AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS said,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                   coalesce(role, ''), sha256(concat(strlen(coalesce(role, '')), ':', role, text))
               ) AS i
        FROM conversations WHERE conv_id IS NOT NULL),
    own AS (
        SELECT conv_id, list({'role': role, 'said': said} ORDER BY i) AS turns,
               xor(4294967295, list_reduce(list_concat([4294967295],
                   list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
                   lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)),
                       lambda x, step: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384)
                                         ELSE x >> 1 END))) % 9 AS h
        FROM numbered GROUP BY conv_id),
    rebuilt AS (
        SELECT c.conv_id, list_concat(coalesce(list_slice(b.turns, 1, c.h), []),
                                      list_slice(c.turns, c.h + 1, len(c.turns))) AS turns
        FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5),
    prefixes AS (
        SELECT conv_id, len(turns) AS size, d, list_slice(turns, 1, d) AS head
        FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
    nodes AS (
        SELECT min(conv_id) AS conv_id, d, head, count(*) AS n_convs, sha256(coalesce(string_agg(
                   CASE WHEN size = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), ''))
                   AS ends_sha256
        FROM prefixes GROUP BY d, head),
    family AS (
        SELECT n.*, p.conv_id AS parent_conv_id
        FROM nodes n LEFT JOIN nodes p ON p.d = n.d - 1 AND p.head = list_slice(n.head, 1, n.d - 1)),
    counted AS (
        SELECT f.*, (SELECT count(*) FROM nodes k WHERE k.d = f.d + 1
                     AND list_slice(k.head, 1, f.d) = f.head) AS n_children
        FROM family f)
    SELECT t.conv_id, t.d AS depth, any_value(t.parent_conv_id) AS parent_conv_id,
           any_value(t.n_convs) AS n_convs, any_value(t.n_children) AS n_children,
           count(*) FILTER (b.n_children = 0) AS n_leaves,
           sum((b.n_convs - 1) * CASE WHEN b.d = 0 THEN 0
               ELSE strlen(b.head[b.d].said) END)::BIGINT AS saved_tokens,
           any_value(t.ends_sha256) AS ends_sha256
    FROM counted t JOIN counted b ON b.d >= t.d AND list_slice(b.head, 1, t.d) = t.head
    GROUP BY t.conv_id, t.d, t.head"""


@query
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 phrases of each language that stand out most, over all whole documents."""
    return phrases.collocations(table(spark, sf_dir, "documents"), threshold=100, most=2000)


ORACLES["op12_phrases"] = r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(
                   coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
    runs AS (
        SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase
        FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
              FROM split, range(1, 6) t(m) WHERE len(w) >= m)),
    f AS (SELECT lang, m, phrase, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 100),
    inside AS (
        SELECT lang, unnest([regexp_replace(phrase, ' [^ ]*$', ''),
                             regexp_replace(phrase, '^[^ ]* ', '')]) AS phrase, f AS longer
        FROM f WHERE m > 2),
    kept AS (
        SELECT * FROM f WHERE m > 1 AND NOT EXISTS (
            SELECT 1 FROM inside i WHERE i.lang = f.lang AND i.phrase = f.phrase
                                         AND 100 * i.longer >= 100 * f.f)),
    cuts AS (
        SELECT *, array_to_string(list_slice(string_split(phrase, ' '), 1, k), ' ') AS a_part,
               array_to_string(list_slice(string_split(phrase, ' '), k + 1, m), ' ') AS b_part
        FROM (SELECT *, unnest(range(1, m)) AS k FROM kept)),
    scored AS (
        SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, n,
               ((1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
        FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = a_part
             JOIN f y ON y.lang = c.lang AND y.phrase = b_part JOIN sizes s ON s.lang = c.lang),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (
        PARTITION BY lang, phrase ORDER BY score, k) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
           phrase, a, l, r, n, score
    FROM best QUALIFY rank <= 2000"""


def word_tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@query
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), word_tokenizer(), ids=False).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")

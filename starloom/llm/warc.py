"""WARC archives with revisit records.

Pages are written as response records, many to an archive. Headers alone are then shuffled by payload
digest: of records with equal payloads one stays the response, the others are joined to it and
become revisits. The deduplicated archives are written with fresh headers, and reading them joins
every revisit to its response again.

Archives are gzip files of Spark's text writer whose line separator is the end of a record, so they
lie wherever Spark can write, and a lost task is written anew. They are read as whole files; the
number of records in an archive is chosen from the mean payload, so that one fits a task.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import whole_text
from starloom.session import materialise, scratch_path

#: An archive holds about this many bytes of payload.
ARCHIVE_BYTES = 8 << 20

VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n\r\n"

#: Payloads handed from a Python worker to Spark at once, in bytes.
_BATCH_BYTES = 8 << 20


def payload_digest(payload: Column) -> Column:
    """Base32 SHA-1 of the UTF-8 bytes, upper case, as WARC headers have it."""
    @F.pandas_udf("string")
    def base32(hexes: pd.Series) -> pd.Series:
        return pd.Series([base64.b32encode(bytes.fromhex(h)).decode() for h in hexes], dtype=object)

    return base32(F.sha1(F.encode(payload, "UTF-8")))


def _uri(url: Column) -> Column:
    """A header value: no line breaks, no blanks around; a missing url is an empty one."""
    return F.trim(F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]+", " "))


def record(kind: Column, page_id: Column, url: Column, digest: Column, payload: Column,
           refers_to: Column) -> Column:
    """A record without its end; ``payload`` null writes an empty block (a revisit).

    Record ids are made of the page id, so writing again gives the same archives.
    """
    def named(key: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))).otherwise("")

    def uuid(of: Column) -> Column:
        h = F.md5(F.concat_ws("/", F.lit("page"), of.cast("string")))
        cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))

    block = F.coalesce(payload, F.lit(""))
    revisit = kind == "revisit"
    return F.concat(
        F.lit(f"{VERSION}\r\n"), named("WARC-Type", kind), named("WARC-Record-ID", uuid(page_id)),
        named("WARC-Target-URI", _uri(url)), named("WARC-Page-Id", page_id.cast("string")),
        named("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        named("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        named("WARC-Refers-To", F.when(revisit, uuid(refers_to))),
        named("WARC-Refers-To-Page-Id", F.when(revisit, refers_to.cast("string"))),
        named("Content-Type", F.lit("text/html; charset=utf-8")),
        named("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)


def write_archives(records: DataFrame, path: str, records_per_archive: int) -> None:
    """Writes a column ``value`` of records to gzip archives below ``path``."""
    (records.select("value").write.mode("errorifexists").option("compression", "gzip")
     .option("lineSep", _END).option("maxRecordsPerFile", records_per_archive).text(path))


_FIELDS = ("page_id long, url string, record_type string, payload_digest string, "
           "refers_to long, payload_bytes long, payload string")


def parse(archive: bytes, with_payload: bool) -> Iterator[tuple]:
    """Records of an uncompressed archive, by their content lengths.

    payload_bytes and the digest are those of the block that was read; for a revisit the digest is
    that of its header. A damaged archive raises a ValueError.
    """
    at = 0
    while at < len(archive):
        head_end = archive.find(b"\r\n\r\n", at)
        if head_end < 0 or not archive.startswith(VERSION.encode(), at):
            raise ValueError(f"no record at byte {at}")
        fields = {}
        for line in archive[at:head_end].split(b"\r\n")[1:]:
            key, _, value = line.partition(b": ")
            fields[key.lower()] = value.decode("utf-8")
        start = head_end + 4
        end = start + int(fields[b"content-length"])
        if archive[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        block = archive[start:end]
        digest = fields[b"warc-payload-digest"].removeprefix("sha1:")
        kind = fields[b"warc-type"]
        if kind == "response":
            found = base64.b32encode(hashlib.sha1(block).digest()).decode()
            if found != digest:
                raise ValueError(f"the payload at byte {start} does not have its digest")
        page = fields.get(b"warc-page-id")
        refers = fields.get(b"warc-refers-to-page-id")
        yield (int(page) if page is not None else None, fields[b"warc-target-uri"], kind, digest,
               int(refers) if refers is not None else None, len(block),
               block.decode("utf-8") if with_payload else None)
        at = end + 4


def read_archives(spark: SparkSession, path: str, with_payload: bool) -> DataFrame:
    """All records of the archives below ``path``, with payloads only if asked for."""
    names = [f.split()[0] for f in _FIELDS.split(", ")]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)
        return out.astype({"page_id": "Int64", "refers_to": "Int64", "payload": object})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows, size = [], 0
                for r in parse(zlib.decompress(content, 31), with_payload):
                    rows.append(r)
                    size += 512 + (r[5] if with_payload else 0)
                    if size > _BATCH_BYTES:
                        yield frame(rows)
                        rows, size = [], 0
                if rows:
                    yield frame(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInPandas(run, _FIELDS)


def archive_pages(pages: DataFrame, path: str) -> None:
    """Writes every page (page_id, url, html) as a response; a missing html is an empty payload."""
    payload = whole_text("html")
    size = pages.select(F.octet_length(payload).alias("n")).agg(F.avg("n").alias("mean")).first()
    per_archive = max(1, int(ARCHIVE_BYTES / (512 + (size["mean"] or 0))))
    rows = pages.select("page_id", "url", payload.alias("html"))
    write_archives(rows.select(record(
        F.lit("response"), F.col("page_id"), F.col("url"), payload_digest(F.col("html")),
        F.col("html"), F.lit(None).cast("long")).alias("value")), path, per_archive)


def resolve_revisits(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """headers (page_id, payload_digest, payload_bytes) with record_type and refers_to.

    Of records with equal payloads of at least ``least_bytes`` bytes that with the largest page id
    is the response, the others revisit it; of smaller payloads each is a response. Pages without
    id, and those that share the largest id, are responses too, so no revisit refers to itself.
    """
    same = ["payload_digest", "payload_bytes"]
    last = headers.groupBy(*same).agg(F.max("page_id").alias("__last"))
    joined = headers.join(last, same)
    revisit = (F.col("payload_bytes") >= least_bytes) & (F.col("page_id") < F.col("__last"))
    return joined.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(revisit, F.col("__last"))).drop("__last")


def deduplicate(spark: SparkSession, path: str, into: str, least_bytes: int = 0) -> None:
    """Reads archives of responses and writes them with revisit records and fresh headers."""
    headers = materialise(read_archives(spark, path, with_payload=False).select(
        "page_id", "url", "payload_digest", "payload_bytes"), "warc-headers")
    resolved = materialise(resolve_revisits(headers, least_bytes), "warc-resolved")
    mean = resolved.agg(F.avg(F.when(F.col("record_type") == "response", F.col("payload_bytes"))
                              .otherwise(0)).alias("m")).first()["m"]
    per_archive = max(1, int(ARCHIVE_BYTES / (512 + (mean or 0))))
    # only responses meet their payloads again; revisits are written from their headers
    stay = resolved.filter("record_type = 'response'").select(
        F.col("page_id").alias("__id"), F.col("payload_digest").alias("__digest"))
    payloads = read_archives(spark, path, with_payload=True)
    null = F.lit(None)
    found = payloads.join(
        stay, F.col("page_id").eqNullSafe(F.col("__id")) & (
            F.col("payload_digest") == F.col("__digest")), "left_semi")
    responses = found.select(record(
        F.lit("response"), F.col("page_id"), F.col("url"), F.col("payload_digest"),
        F.col("payload"), null.cast("long")).alias("value"))
    revisits = resolved.filter("record_type = 'revisit'").select(record(
        F.lit("revisit"), F.col("page_id"), F.col("url"), F.col("payload_digest"),
        null.cast("string"), F.col("refers_to")).alias("value"))
    write_archives(responses.unionByName(revisits), into, per_archive)


def read_resolved(spark: SparkSession, path: str) -> DataFrame:
    """Headers of deduplicated archives; a revisit has the payload size of its response."""
    rows = materialise(read_archives(spark, path, with_payload=False).drop("payload"), "warc-read")
    original = rows.filter("record_type = 'response'").groupBy(
        F.col("page_id").alias("__id"), F.col("payload_digest").alias("__digest")).agg(
        F.max("payload_bytes").alias("__bytes"))
    joined = rows.join(original, (F.col("refers_to") == F.col("__id")) & (
        F.col("payload_digest") == F.col("__digest")), "left")
    return joined.withColumn(
        "payload_bytes", F.coalesce("__bytes", "payload_bytes")).drop("__id", "__digest", "__bytes")


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes the pages to archives, deduplicates these, and reads the result back.

    One row per row of ``pages``. Equal rows give equal records. Other columns are not read; an
    empty table gives no rows.
    """
    spark = pages.sparkSession
    raw, clean = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc-dedup")
    archive_pages(pages, raw)
    deduplicate(spark, raw, clean, least_bytes)
    return read_resolved(spark, clean)

import base64
import gzip
import hashlib

import pytest

from starloom.llm import warc as W

SCHEMA = "page_id long, url string, html string"
HARD = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\ny \u0000 é 漢"


def sha(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def pages():
    rows = [(0, "http://a", None), (1, "u\r\nWARC-Type: x", ""), (2, None, HARD), (3, "c", HARD),
            (4, "d", "long " * 50_000), (5, "e", "one"), (9, "f", "one"), (7, "g", "one")]
    return rows + [(100 + i, "hot", "the hot page") for i in range(150)]


def expected(rows, least):
    last = {}
    for i, _, t in rows:
        last[t or ""] = max(last.get(t or "", -1), i)
    out = {}
    for i, _, t in rows:
        n = len((t or "").encode())
        revisit = n >= least and last[t or ""] != i
        out[i] = (n, sha(t), "revisit" if revisit else "response", last[t or ""] if revisit else None)
    return out


@pytest.mark.parametrize("least", [0, 4])
@pytest.mark.parametrize("archive", [1 << 10, 8 << 20])
def test_round_trip(spark, least, archive, monkeypatch):
    monkeypatch.setattr(W, "ARCHIVE_BYTES", archive)
    df = spark.createDataFrame(pages(), SCHEMA).selectExpr("*", "1 AS record_type", "2 AS payload")
    rows = W.round_trip(df, least).collect()
    assert {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
            for r in rows} == expected(pages(), least)
    assert len(rows) == len(pages())


def test_payloads_come_back(spark, tmp_path):
    W.archive_pages(spark.createDataFrame(pages(), SCHEMA), str(tmp_path / "raw"))
    back = W.read_archives(spark, str(tmp_path / "raw"), with_payload=True).collect()
    assert {r["page_id"]: r["payload"] for r in back} == {i: t or "" for i, _, t in pages()}
    assert {r["page_id"]: r["url"] for r in back}[1] == "u WARC-Type: x"


def test_revisits_hold_no_payload(spark, tmp_path):
    raw, clean = str(tmp_path / "raw"), str(tmp_path / "clean")
    W.archive_pages(spark.createDataFrame(pages(), SCHEMA), raw)
    W.deduplicate(spark, raw, clean)
    data = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "clean").glob("*.gz"))
    assert data.count(b"the hot page") == 1 and data.count(b"WARC-Type: revisit\r\n") == 149 + 1 + 1 + 2
    records = list(W.parse(data, True))
    assert len(records) == len(pages())
    assert all(r[5] == 0 for r in records if r[2] == "revisit")


def test_missing_ids_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(None, "a", "t"), (None, "b", "t"), (3, "c", "t"), (3, "c", "t")], SCHEMA)
    rows = W.round_trip(df).collect()
    assert sorted(r["record_type"] for r in rows) == ["response"] * 4
    assert W.round_trip(df.limit(0)).count() == 0


def test_damaged_archives_are_refused():
    head = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: \r\nWARC-Payload-Digest: sha1:{}\r\nContent-Length: {}\r\n\r\n"
    good = (head.format(sha("ab"), 2) + "ab\r\n\r\n").encode()
    assert len(list(W.parse(good + good, True))) == 2
    for bad in (good[:-2], good.replace(b"ab\r\n", b"ac\r\n"), b"x" + good, good + b"tail"):
        with pytest.raises(ValueError):
            list(W.parse(bad, True))

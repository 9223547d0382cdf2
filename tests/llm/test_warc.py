from __future__ import annotations

import base64
import hashlib

import pytest

from farewind.llm import warc
from farewind.scratch import new_folder

PAGES = [
    (5, "http://a.org/x", "<p>same</p>"), (2, "http://b.org/", "<p>same</p>"), (9, None, "<p>same</p>"),
    (3, "http://c.org/\r\nX-Evil: 1", "é WARC/1.1\r\nWARC-Type: revisit\r\n\r\n"), (4, "http://d.org", None), (6, "u", ""),
    (2, "http://b.org/", "<p>same</p>"), (None, "http://n.org", "only without id"), (None, "http://n.org", "<p>same</p>"),
    (7, "http://l.org", "long " * 50_000), (8, "$1 \\ %", "tie"), (1, "u2", "tie"), (1, "u3", "other"),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "1 as payload", "2 as address", "3 as header", "4 as who"
    )


def archive(spark, rows=PAGES, **options):
    folder = new_folder(spark, "test-archive")
    warc.write_archive(pages(spark, rows), folder, **options)
    return folder


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_records_match_brute_force(spark, min_bytes):
    first = {}
    for page_id, _, html in PAGES:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    expected = []
    for page_id, _, html in PAGES:
        data = (html or "").encode()
        lead = first.get(html or "")
        again = len(data) >= min_bytes and lead is not None and page_id != lead
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected.append((page_id, len(data), digest, "revisit" if again else "response", lead if again else None))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    found = warc.read_archive(spark, archive(spark, min_bytes=min_bytes)).select(*names)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(expected, key=repr)


def test_whole_records_come_back(spark):
    rows = warc.record_bytes(warc.read_archive(spark, archive(spark))).collect()
    assert sorted(bytes(r["payload"]) for r in rows) == sorted((html or "").encode() for _, _, html in PAGES)
    for row in rows:
        head, _, rest = bytes(row["record"]).partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
        assert rest == bytes(row["payload"]) + b"\r\n\r\n"
        assert b"\r\nX-Evil" not in head
        assert f"Content-Length: {len(row['payload'])}".encode() in head


def test_each_payload_is_stored_once(spark):
    folder = archive(spark)
    assert spark.read.parquet(f"{folder}/payloads").count() == len({html or "" for _, _, html in PAGES})
    assert spark.read.parquet(f"{folder}/headers").count() == len(PAGES)


def test_damage_is_found(spark):
    folder, other = archive(spark), new_folder(spark, "test-archive")
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{other}/headers")
    spark.read.parquet(f"{folder}/payloads").selectExpr(
        "address", "case when payload = cast('tie' as binary) then cast('tye' as binary) else payload end as payload"
    ).write.parquet(f"{other}/payloads")
    with pytest.raises(Exception, match="archive record is damaged"):
        warc.read_archive(spark, other).collect()


def test_empty(spark):
    assert warc.read_archive(spark, archive(spark, [])).collect() == []

"""The WARC archive against plain Python, and exact round trips."""

import base64
import hashlib

import pytest
from pyspark.errors import PySparkException

from tutorlens.llm import warc_archive as w
from tutorlens.llm.common import write_table

SCHEMA = "page_id long, url string, html string, payload string, address int, response_id string, warc_header int"
EMBEDDED = "a\r\n\r\nWARC/1.1\r\nWARC-Type: revisit\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
PAGES = [
    (5, "http://a", "same"),
    (2, "http://b", "same"),
    (9, "http://c\r\nWARC-Type: revisit", "same"),
    (9, "http://c2", "same"),
    (3, None, None),
    (4, "", ""),
    (None, "http://d", "same"),
    (None, "http://e", "nobody else"),
    (None, "http://e", "nobody else"),
    (-7, "http://é", "größe 漢字 \x00 end"),
    (11, "u", EMBEDDED),
    (12, "u", EMBEDDED),
    (2, "http://b", "same"),
    (2, "other text of the same id", "different"),
    (20, "long", "x" * 3_000_000),
    (21, "long", "x" * 3_000_000),
]


def frame(spark, pages):
    return spark.createDataFrame([(*p, "x", 1, "y", 2) for p in pages], SCHEMA).repartition(5)


def plain(pages, min_bytes=0):
    data = [(i, (html or "").encode()) for i, _, html in pages]
    out = []
    for i, payload in data:
        ids = [j for j, other in data if other == payload and j is not None]
        first = min(ids) if ids else None
        revisit = len(payload) >= min_bytes and i != first
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((i, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def facts(spark, folder):
    return sorted((tuple(r) for r in w.record_facts(w.restore(spark, folder)).collect()), key=repr)


@pytest.mark.parametrize("min_bytes", [0, 1, 5])
def test_archive_matches_plain_python(spark, min_bytes):
    folder = w.archive(frame(spark, PAGES), min_bytes=min_bytes)
    assert facts(spark, folder) == plain(PAGES, min_bytes)
    # each payload is stored once
    stored = [bytes(r["payload"]) for r in spark.read.parquet(f"{folder}/payloads").collect()]
    assert sorted(stored) == sorted({(p[2] or "").encode() for p in PAGES})


def test_records_are_exact_and_survive_files(spark, tmp_path):
    folder = w.archive(frame(spark, PAGES))
    whole = lambda at: sorted(bytes(r["r"]) for r in w.restore(spark, at).select(w.record_bytes().alias("r")).collect())
    records = whole(folder)
    payloads = [(p[2] or "").encode() for p in PAGES]
    assert len(records) == len(PAGES)
    for record in records:
        ((header, block),) = w.split_records(record)
        lines = header.decode().split("\r\n")
        assert lines[0] == "WARC/1.1" and lines[-2:] == ["", ""]
        assert sum(x.startswith("WARC-Type:") for x in lines) == 1
        body = block.split(b"\r\n\r\n", 1)[1]
        assert body in payloads if "WARC-Type: response" in lines else body == b""
    w.export_warc(w.restore(spark, folder), str(tmp_path / "files"), file_bytes=1000)
    files = [p.read_bytes() for p in (tmp_path / "files").glob("part-*")]
    assert len(files) > 3 and sorted(h + b + w.RECORD_END for f in files for h, b in w.split_records(f)) == records
    again = w.import_warc(spark, str(tmp_path / "files"))
    assert whole(again) == records
    assert facts(spark, again) == plain(PAGES)


def test_damage_is_found(spark):
    folder = w.archive(frame(spark, PAGES[:4]))
    payloads = spark.read.parquet(f"{folder}/payloads")
    other = folder + "-damaged"
    write_table(payloads.selectExpr("address", "payload_bytes", "payload_digest", "CAST('evil' AS BINARY) AS payload", "response_id"), f"{other}/payloads")
    write_table(spark.read.parquet(f"{folder}/headers"), f"{other}/headers")
    with pytest.raises(PySparkException, match="does not have its address"):
        facts(spark, other)
    wrong = folder + "-wrong-headers"
    write_table(payloads, f"{wrong}/payloads")
    header = "CAST(replace(CAST(warc_header AS STRING), 'sha1:', 'sha1:A') AS BINARY) AS warc_header"
    write_table(spark.read.parquet(f"{folder}/headers").selectExpr("page_id", "address", header, "http_header"), f"{wrong}/headers")
    with pytest.raises(PySparkException, match="do not fit"):
        facts(spark, wrong)


def test_empty_table(spark):
    assert facts(spark, w.archive(frame(spark, PAGES).limit(0))) == []


def test_payloads_combine_before_the_shuffle(spark):
    df = frame(spark, PAGES)
    rows = w._pages(df).groupBy("address", "payload").agg({"page_id": "min"})
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning(address")

"""WARC: the query against SQL, chains against a sequential reader, magic inside payloads, odd rows."""

from __future__ import annotations

import glob
import hashlib

import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from cohortlens.llm import warc
from cohortlens.llm.queries import ORACLES, op9_warc

SF = "/root/testdata/sf0.01"
PAGE = "page_id long, url string, html string"


def sequential(path):
    """(id, payload bytes) of all records of all files, read front to back."""
    out = []
    for name in glob.glob(f"{path}/part-*"):
        data, at = open(name, "rb").read(), 0
        while at < len(data):
            assert data.startswith(b"WARC/1.0\r\n", at)
            end = data.index(b"\r\n\r\n", at) + 4
            fields = dict(line.split(b": ", 1) for line in data[at + 10:end - 4].split(b"\r\n"))
            size = int(fields[b"Content-Length"])
            block = data[end:end + size]
            assert data[end + size:end + size + 4] == b"\r\n\r\n"
            out.append((fields.get(b"WARC-Record-ID"), block[block.index(b"\r\n\r\n") + 4:]))
            at = end + size + 4
    return out


def test_query_against_sql(spark):
    problems, n, _ = compare(op9_warc(spark, SF), duck(SF), ORACLES["op9_warc"])
    assert not problems and n == 250


def test_files_hold_records_in_the_standard_layout(spark, tmp):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    warc.write_archives(warc.plan_records(pages), tmp + "/w")
    got = sequential(tmp + "/w")
    want = {f"<urn:page:{r.page_id}>".encode(): (r.html or "").encode() for r in pages.collect()}
    assert len(got) == len(want) and sum(1 for i, p in got if p == want[i]) >= len(want) - 1


ODD = [(3, "u\r\nx%", "same " * 40), (1, None, "same " * 40), (2, "u", "same " * 40), (2, "u", "same " * 40), (5, "u", None), (6, "u", ""), (7, "u", "short"), (8, "u", "short"),
       (9, "u", "x" * 50 + "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\nContent-Length: 99\r\n\r\n" + "é" * 60),
       (10, "u", "WARC/1.0\r\n" * 30), (11, "u", "long \n" * 300_000), (None, "u", "same " * 40), (12, "u", "no end WARC/1.0\r")]


def expected(rows):
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        same = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        revisit = len(body) >= 100 and same and i != min(same)
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", min(same) if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", ["64k", "1k", "317", "128m"])
def test_splits_anywhere(spark, split):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    pages = spark.createDataFrame(ODD, PAGE).coalesce(1).withColumn("digest", F.lit("x")).withColumn("id", F.lit(1))
    rows = ODD if split in ("64k", "128m") else [r for r in ODD if r[0] != 11]
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "64")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        got = warc.archive(pages.where("page_id is null or page_id <> 11") if rows is not ODD else pages).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == expected(rows)
    assert {r.url for r in got if r.page_id == 3} == {"u\r\nx%"}


def test_broken_chain_ends_the_file(spark, tmp):
    good = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nok\r\n\r\n"
    (__import__("pathlib").Path(tmp) / "a.warc").write_bytes(good * 2 + b"WARC/1.0\r\nContent-Length: 5\r\n\r\nok\r\n\r\n" + good)
    (__import__("pathlib").Path(tmp) / "b.warc").write_bytes(b"junk" + good)
    assert warc.read_archives(spark, tmp).where("record_type = 'response'").count() == 2


def test_empty(spark):
    assert warc.archive(spark.createDataFrame([], PAGE)).count() == 0


def test_many_records_that_hold_the_magic(spark):
    rows = [(i, "u", f"page {i} " + f"WARC/1.0\r\nContent-Length: {i}\r\n\r\n" * (i % 7) + "end " * (i % 90)) for i in range(2_000)]
    rows += [(5_000, "u", "WARC/1.0\r\n" * 20_000), (5_001, "u", "WARC/1.0\r\nContent-Length: 0\r\n\r\n\r\n\r\n" * 5_000)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    settings = {"spark.sql.files.maxPartitionBytes": "100k", "spark.sql.files.openCostInBytes": "64", "spark.sql.files.minPartitionNum": "1"}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        got = warc.archive(spark.createDataFrame(rows, PAGE).coalesce(1)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")
    want = [(i, len(h.encode()), hashlib.sha256(h.encode()).hexdigest()) for i, _, h in rows]
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == want

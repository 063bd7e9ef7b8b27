import base64
import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from adpulse.llm import queries, warc
from adpulse.scratch import scratch_dir

MARKER = "\r\n\r\nWARC/1.1\r\n"
PAGES = [
    (1, "http://a.org/", "<p>one</p>"),
    (2, "http://a.org/2", "<p>one</p>"),
    (3, None, None),
    (4, "http://a.org/4", ""),
    (5, "http://a.org/\r\nX: y", "line\r\n\r\nline\r\n"),
    (6, "http://a.org/6", f"{MARKER}{MARKER}x{MARKER}"),
    (7, "http://a.org/7", "é🙂" * 700 + "\r\n"),
    (8, "http://a.org/8", "\r\n\r\n\r\nWARC/1." * 40),
    (9, "http://a.org/9", "z" * 1000),
    (None, "http://a.org/n", "<p>one</p>"),
    (None, "http://a.org/n", "only without an id"),
    (10, "http://a.org/9", "z" * 1000),
    (11, "http://a.org/11", "é🙂" * 700 + "\r\n"),
]
SCHEMA = "page_id long, url string, html string"


def _digest(payload):
    return base64.b32encode(hashlib.sha1((payload or "").encode()).digest()).decode()


def _expected(pages, min_bytes=0):
    first: dict = {}
    for page_id, _, html in pages:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    rows = []
    for page_id, _, html in pages:
        html = html or ""
        of = first.get(html)
        again = of is not None and of != page_id and len(html.encode()) >= min_bytes
        rows.append(
            (page_id, len(html.encode()), _digest(html), "revisit" if again else "response",
             of if again else None, True)
        )
    return sorted(rows, key=str)


def _written(spark, pages, **options):
    path = scratch_dir(spark, "warc-test")
    frame = spark.createDataFrame(pages, SCHEMA).repartition(3)
    warc.write_archives(frame, path, **options)
    return path


@pytest.mark.parametrize("size", [7, 64, 1 << 16])
def test_round_trip(spark, size):
    path = _written(spark, PAGES, size=size)
    assert sorted(map(tuple, warc.read_archives(spark, path).collect()), key=str) == _expected(PAGES)


@pytest.mark.parametrize("size", [7, 64, 1 << 16])
def test_no_payload_ends_a_record(spark, size):
    """Payloads, and chunks of payloads, that begin or end like the start of a record."""
    starts = ["WARC/1.1\r\n", "\r\nWARC/1.1\r\n", "\n\r\nWARC/1.1\r\n", MARKER, "WARC/1.1", "\r\nWARC/1.1"]
    ends = ["\r\n\r\nWARC/1.1", "\r\n\r\nWARC/1.1\r", "WARC/1.1", "\r\nWARC/1.1", MARKER, "\r\n\r\n", "\r\n"]
    fill = "x" * (size - 3)
    pages = [start + "hello" for start in starts] + ["x" + end for end in ends]
    pages += [start + fill + end for start in starts for end in ends]
    pages += [fill + "abc" + start + fill for start in starts]
    pages += [fill[: max(size - k, 0)] + MARKER + "tail" for k in range(16)]
    pages += [*starts, *ends, "WARC/1.1" * 50, "WARC/1.1WARC/1.1\r\n"]
    rows = [(k, f"http://a.org/{k}", page) for k, page in enumerate(pages)]
    path = _written(spark, rows, size=size)
    found = sorted(map(tuple, warc.read_archives(spark, path).collect()), key=str)
    assert found == _expected(rows)


def test_payload_of_several_megabytes(spark):
    long = "".join(f"<p>{k} é🙂</p>\r\n\r\nWARC/1.1\r\n" for k in range(120_000))
    rows = [(1, "u", long), (2, "v", long), (3, "w", "z" * 3_000_000)]
    path = _written(spark, rows)
    found = sorted(map(tuple, warc.read_archives(spark, path).collect()), key=str)
    assert found == _expected(rows)


def test_smaller_payloads_are_all_responses(spark):
    path = _written(spark, PAGES, min_bytes=20)
    got = sorted(map(tuple, warc.read_archives(spark, path).collect()), key=str)
    assert got == _expected(PAGES, 20)


def _parse(data: bytes):
    """Records of an archive, by the lengths they state."""
    at = 0
    while at < len(data):
        assert data.startswith(b"WARC/1.1\r\n", at)
        head_end = data.index(b"\r\n\r\n", at)
        lines = data[at:head_end].decode().split("\r\n")[1:]
        head = dict(line.split(": ", 1) for line in lines)
        block = data[head_end + 4 : head_end + 4 + int(head["Content-Length"])]
        at = head_end + 4 + len(block)
        assert data[at : at + 4] == b"\r\n\r\n"
        at += 4
        yield head, block


def test_files_are_warc(spark):
    """Any reader that goes by the stated lengths finds the payloads."""
    path = _written(spark, PAGES, size=64)
    payloads, records = {}, {}
    files = [f for f in Path(path.removeprefix("file://")).iterdir() if f.name.endswith(".gz")]
    for file in files:
        for head, block in _parse(gzip.decompress(file.read_bytes())):
            assert head["WARC-Record-ID"] not in records
            records[head["WARC-Record-ID"]] = head
            assert len(block.decode()) <= 64 + len(warc.HTTP)
            if head["WARC-Type"] == "response":
                payloads[head["WARC-Record-ID"]] = block.removeprefix(warc.HTTP.encode())
            elif head["WARC-Type"] == "continuation":
                payloads[head["WARC-Segment-Origin-ID"]] += block
            else:
                assert head["WARC-Profile"] == warc.PROFILE
    assert {_digest(p.decode()) for p in payloads.values()} == {_digest(p[2]) for p in PAGES}
    for record, payload in payloads.items():
        stated = records[record]["WARC-Payload-Digest"]
        assert stated == f"sha1:{_digest(payload.decode())}"
        assert int(records[record]["Payload-Length"]) == len(payload)


def test_damage_is_seen(spark):
    path = _written(spark, [(1, None, "abc" * 30), (2, None, "xyz")], size=20)
    raw = spark.read.option("lineSep", warc._SEPARATOR).text(path)
    damaged = scratch_dir(spark, "warc-damaged")
    body = F.regexp_replace("value", "abc", "abd")
    full = F.concat(F.lit(warc.START), F.regexp_replace(body, r"\A" + warc.START, ""))
    full = F.regexp_replace(full, r"\r\n\r\n\z", "")
    raw.select(full.alias("value")).write.option("lineSep", warc.END).text(damaged)
    got = {row["page_id"]: row["intact"] for row in warc.read_archives(spark, damaged).collect()}
    assert got == {1: False, 2: True}


def test_repeated_rows_clashes_and_empty(spark):
    frame = spark.createDataFrame([(1, "u", "a" * 50)] * 3, SCHEMA).withColumn("at", F.lit("x"))
    path = scratch_dir(spark, "warc-test")
    warc.write_archives(frame, path, size=20)
    rows = warc.read_archives(spark, path).collect()
    assert [tuple(row)[:4] for row in rows] == [(1, 50, _digest("a" * 50), "response")] * 3
    path = scratch_dir(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert warc.read_archives(spark, path).collect() == []


def test_query_matches_python(spark):
    folder = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html")
    pages = [tuple(row) for row in pages.collect()]
    got = sorted(map(tuple, queries.op10_warc(spark, folder).collect()), key=str)
    assert got == _expected(pages)

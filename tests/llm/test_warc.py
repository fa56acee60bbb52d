import hashlib
import io
from urllib.parse import unquote

import duckdb
import pyarrow.fs as pafs
import pytest
import zstandard
from llm_helpers import SF, frame

from sowcast.llm import queries, warc
from sowcast.sources.scratch import scratch_dir

PAGES = "page_id LONG, url STRING, html STRING"


def brute(rows):
    largest, count = {}, {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= 1000:
            largest[html] = max(page, largest.get(html, page))
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        to = largest.get(html) if html else None
        to = None if to == page else to
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


def report(df):
    got = df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    return sorted((tuple(r) for r in got), key=repr)


@pytest.mark.parametrize(
    "uri, place",
    [
        ("/a/b:c", "file:///a/b:c"),
        ("file:/a/b", "file:///a/b"),
        ("file:///a/b", "file:///a/b"),
        ("s3a://bucket/a", "s3://bucket/a"),
        ("s3n://bucket/a", "s3://bucket/a"),
        ("gs://bucket/a", "gs://bucket/a"),
        ("abfss://c@account.dfs.core.windows.net/a", "abfss://c@account.dfs.core.windows.net/a"),
        ("hdfs://name:8020/a", "hdfs://name:8020/a"),
    ],
)
def test_places_are_called_as_tasks_call_them(uri, place):
    assert warc.task_uri(uri) == place


@pytest.mark.parametrize("uri", ["dbfs:/a", "a/b", "wasb://c@account/a", ""])
def test_unknown_places_are_refused_before_any_job(spark, uri):
    pages = spark.createDataFrame([(1, "u", "x")], PAGES)
    with pytest.raises(ValueError):
        warc.write_archives(pages, uri)


def test_query_against_brute_force(spark):
    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{SF}/pages.parquet'").fetchall()
    assert report(queries.op7_warc_bundles(spark, SF)) == brute(rows)


def test_repeats_nulls_sizes_and_odd_urls(spark):
    long = "ä" * 500 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"
    rows = [
        (1, "http://a/\r\nX: y", long),
        (7, None, long),
        (3, "http://ä/ b", long),
        (None, "", long),
        (5, "u", "x" * 999),
        (6, "u", "x" * 999),
        (8, "u", "y" * 1000),
        (8, "u", "y" * 1000),
        (9, "u", "y" * 1000),
        (10, "u", None),
        (11, "u", ""),
        (None, None, "z" * 2000),
        (None, None, "z" * 2000),
        (12, "u", "big" * 1_000_000),
    ]
    table = spark.createDataFrame([(*r, "x") for r in rows], PAGES + ", same STRING")
    got = warc.page_records(table, frame_bytes=3000, archive_bytes=1000)
    assert report(got) == brute(rows)
    assert {unquote(r.target_uri) for r in got.collect() if r.page_id in (1, 3)} == {"http://a/\r\nX: y", "http://ä/ b"}
    assert warc.page_records(table.limit(0)).count() == 0


def test_archives_are_plain_zstandard_and_records_can_be_fetched(spark):
    rows = [(i, f"http://h/{i}", f"page {i} " * (i * 10)) for i in range(200)]
    table = spark.createDataFrame(rows, PAGES)
    folder = scratch_dir(spark, "warc")
    index = warc.write_archives(table, folder, frame_bytes=20_000)
    assert index.count() == 200
    raw = b""
    for info in pafs.LocalFileSystem().get_file_info(pafs.FileSelector(folder.removeprefix("file:"))):
        with open(info.path, "rb") as f:
            raw += zstandard.ZstdDecompressor().stream_reader(io.BytesIO(f.read()), read_across_frames=True).read()
    assert raw.count(b"WARC-Type: response\r\n") == 200
    wanted = spark.createDataFrame([("urn:x-page:7",), ("urn:x-page:199",), ("urn:x-page:nothing",)], "record_id STRING")
    got = frame(warc.fetch_records(index, wanted)).set_index("record_id")
    assert sorted(got.index) == ["urn:x-page:199", "urn:x-page:7"]
    assert got.loc["urn:x-page:7"].payload == rows[7][2].encode()

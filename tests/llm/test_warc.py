from __future__ import annotations

import hashlib
import io
from pathlib import Path

import duckdb
import pandas as pd
import pytest
import zstandard

from tallyroll.llm import oracle_sql, warc

SCHEMA = "page_id long, url string, html string"


def brute_force(rows):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    found = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        least = first.get(html or "")
        revisit = len(data) >= 100 and least is not None and page_id != least
        found.append((str(page_id), len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", str(least if revisit else None)))
    return sorted(found)


def result(pages):
    return sorted((str(row[0]), row[1], row[2], row[3], str(row[4])) for row in warc.page_records(pages).collect())


def odd_pages():
    text = "é<p>\r\n\r\nWARC/1.1\r\n" * 20
    rows = [
        (7, "http://a/ b%20\r\nX: y", text),
        (3, "http://b", text),
        (9, None, text),
        (9, None, text),
        (3, "http://b", text),
        (None, "http://c", text),
        (None, None, None),
        (11, "http://d", None),
        (12, "", ""),
        (13, "http://e", "short"),
        (14, "http://e", "short"),
        (15, "u", "x" * 99),
        (16, "u", "x" * 99),
        (17, "u", "é" * 50),
        (18, "u", "é" * 50),
        (20, "u", "y" * 3_000_000),
        (19, "u", "y" * 3_000_000),
        (None, "u", "only null " * 30),
        (None, "u", "only null " * 30),
    ]
    return rows


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [(row.page_id, row.url, row.html) for row in pages.collect()]
    assert result(pages) == brute_force(rows)


def test_odd_rows(spark):
    rows = odd_pages()
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS digest", "2 AS bundle", "3 AS `a.b`").repartition(3)
    assert result(pages) == brute_force(rows)
    assert result(pages.limit(0)) == []


def test_bundles_are_plain_zstandard_and_seekable(spark, tmp_path):
    rows = [(number, f"http://x/{number}", f"<p>{number % 40}</p>" * 30) for number in range(200)]
    folder, index = warc.write_bundles(spark.createDataFrame(rows, SCHEMA), (tmp_path / "out").as_uri(), 4000, 30_000)
    places = index.collect()
    assert len(places) == 200 and max(place.frame for place in places) > 3
    assert len({place.bundle for place in places}) > 2
    by_id = dict((row[0], row[2]) for row in rows)
    for place in places[::7]:
        page_id, url, kind, refers_to, size, digest, payload = warc.read_record(
            folder, place.bundle, place.frame, place.offset, place.length
        )
        assert page_id == place.page_id and url == f"http://x/{page_id}" and size == len(by_id[page_id])
        assert digest == hashlib.sha256(by_id[page_id].encode()).hexdigest()
        if kind == "response":
            assert payload.decode() == by_id[page_id] and page_id < 40
        else:
            assert refers_to == page_id % 40 and payload is None
    files = list(Path(tmp_path / "out").iterdir())
    assert {file.name for file in files} == {place.bundle for place in places}
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(files[0].read_bytes()), read_across_frames=True).read()
    assert whole.count(b"WARC-Type: ") == sum(place.bundle == files[0].name for place in places)


def test_a_task_that_runs_again_leaves_one_file(tmp_path):
    for attempt in (1, 2):
        bundle = warc._Bundle(tmp_path.as_uri(), "pages-000000.warc.zst", attempt)
        bundle.add(warc.to_record(1, None, b"x", 1, hashlib.sha256(b"x").hexdigest(), None))
        bundle.close()
    (file,) = tmp_path.iterdir()
    assert file.name == "pages-000000.warc.zst"


@pytest.mark.parametrize("url", [None, "", "http://a/%41%20b c\n\x7f", "é"])
def test_urls_survive(url):
    record = warc.to_record(5, url, b"abc", 3, hashlib.sha256(b"abc").hexdigest(), None)
    ((page_id, found, *_),) = warc.from_records(record)
    assert (page_id, found) == (5, url)


def test_read_tasks_grow_with_the_bundles(spark):
    pages = spark.range(400).selectExpr("id AS page_id", "'http://a/' || id AS url", "repeat(sha2(cast(id AS string), 256), 20) AS html")
    folder, index = warc.write_bundles(pages.repartition(4), bundle_bytes=4000)
    bundles = index.select("bundle").distinct().count()
    assert bundles >= 100
    records = warc.read_bundles(folder, index)
    assert records.rdd.getNumPartitions() == -(-bundles // warc.BUNDLES_A_TASK)
    assert records.count() == 400


def test_sql_agrees_on_odd_pages():
    rows = odd_pages()
    with duckdb.connect() as database:
        table = pd.DataFrame({"page_id": pd.array([row[0] for row in rows], "Int64"), "html": [row[2] for row in rows]})
        database.register("pages", table)
        found = database.sql(oracle_sql.PAGE_RECORDS).fetchall()
    assert sorted((str(row[0]), row[1], row[2], row[3], str(row[4])) for row in found) == brute_force(rows)

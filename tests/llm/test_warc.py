import hashlib
from collections import defaultdict

import pytest

from swipelens.llm import warc
from swipelens.session import new_path

SCHEMA = "page_id BIGINT, url STRING, html STRING, record_type STRING"
BIG = "é" * 600


def brute(rows):
    """(page_id, bytes, digest, type, refers) of each page; one response per large payload."""
    groups = defaultdict(list)
    for i, (page, _, html, _) in enumerate(rows):
        data = (html or "").encode()
        groups[data if len(data) >= 1000 else (i,)].append((page, data))
    out = []
    for members in groups.values():
        first = max((p for p, _ in members if p is not None), default=None)
        at = [p for p, _ in members].index(first)
        for i, (page, data) in enumerate(members):
            kind = "response" if i == at else "revisit"
            out.append((page, len(data), hashlib.sha1(data).hexdigest(), kind, None if i == at else first))
    return sorted(out, key=repr)


def report(frame):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r) for r in warc.capture_report(frame).select(*names).collect()), key=repr)


def test_pages_come_back(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"], None) for r in pages.collect()]
    assert report(pages) == brute(rows)


def test_copies_nulls_and_ties(spark):
    rows = [(i, f"http://a/{i}", BIG, "x") for i in (3, 9, 5)]
    rows += [(i, "u", BIG[:499], "x") for i in (1, 2)] + [(7, None, "", "x"), (8, "a\r\nb: c é", None, "x")]
    rows += [(None, "n", "z" * 1000, "x"), (None, "n", "z" * 1000, "x"), (4, "n", "y" * 1000, "x"), (4, "n", "y" * 1000, "x")]
    rows += [(2**53 + 1, "n", "q" * 300_000, "x"), (2**53 + 3, "n", "q" * 300_000, "x")]
    assert report(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert report(spark.createDataFrame([], SCHEMA)) == []


@pytest.fixture(scope="module")
def folder(spark):
    rows = [(i, f"http://a/{i}\r\nx é", BIG if i % 3 else f"<p>{i}\r\n\r\nWARC/1.1", "x") for i in range(40)]
    path = new_path(spark)
    assert warc.write(spark.createDataFrame(rows, SCHEMA).repartition(3), path, archive_bytes=3000).count() > 3
    return path


def test_assembly_has_all_parts(spark, folder):
    records = warc.read_records(spark, folder)
    assert records.count() == 120
    found = {r["metadata"]["page_id"]: r for r in warc.assemble(records).collect()}
    assert sorted(found) == list(range(40))
    for page, r in found.items():
        assert r["metadata"]["url"] == f"http://a/{page}\r\nx é"
        assert r["request"]["target_uri"] == r["response"]["target_uri"] == f"http://a/{page}%0D%0Ax%20%C3%A9"
        assert (r["n_requests"], r["n_metadata"]) == (1, 1)
        if r["response"]["record_type"] == "response":
            assert r["response"]["digest_ok"]
            want = BIG if page % 3 else f"<p>{page}\r\n\r\nWARC/1.1"
            assert bytes(r["response"]["payload"]).decode() == want
    assert [p for p, r in found.items() if page_is_response(r) and p % 3] == [38]
    assert warc.orphans(records).count() == 0


def page_is_response(row):
    return row["response"]["record_type"] == "response"


def test_missing_and_repeated_partners(spark, folder):
    records = warc.read_records(spark, folder)
    some = records.where("record_type <> 'metadata'").unionByName(records.where("record_type = 'request'"))
    rows = warc.assemble(some).collect()
    assert len(rows) == 40
    assert all(r["metadata"] is None and (r["n_requests"], r["n_metadata"]) == (2, 0) for r in rows)
    assert warc.orphans(records.where("record_type <> 'response'")).count() > 0


def test_an_archive_cut_short_is_refused():
    data = warc.capture("a", 1, 2, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None)
    assert len(list(warc.members(data))) == 3
    with pytest.raises(ValueError):
        list(warc.members(data[:-9]))

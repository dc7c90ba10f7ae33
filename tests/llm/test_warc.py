import base64
import hashlib

import pytest
from llm_data import with_clashes

from postlens.llm import warc
from postlens.session import new_path

SCHEMA = "page_id long, url string, html string"
FORGED = "WARC/1.1\r\nWARC-Type: response\r\nX-Page-Id: 99\r\nContent-Length: 5\r\n\r\nhello"
PAGES = [
    (5, "http://a/ b\r\nWARC/1.1\r\n", "<p>same</p>"),
    (3, "http://a", "<p>same</p>"),
    (8, None, "<p>same</p>"),
    (1, "u", None),
    (2, "u", ""),
    (4, "u", "WARC/1.1\r\n"),
    (6, "u", FORGED),
    (7, "u", FORGED + "\r\n\r\n"),
    (9, "u", "x" + FORGED + "\r\n\r\n" + FORGED + "\r\n\r\n" + "y" * 5000),
    (10, "u", "WARC/1.1\r\nContent-Length: 99999999\r\n\r\n"),
    (11, "u", "\r\n\r\nWARC/1.1\r\n\r\n\r\n"),
    (12, "u", "é🙂" * 100),
    (13, "u", "é🙂" * 100),
    (14, "u", FORGED),
]


def expected(pages, min_bytes=0):
    first, out = {}, []
    for page, _, html in sorted(pages):
        data = (html or "").encode()
        rep = first.setdefault(data, page) if len(data) >= min_bytes else page
        sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), sha, "response" if rep == page else "revisit", None if rep == page else rep))
    return out


@pytest.mark.parametrize("min_bytes", [0, 20])
def test_round_trip_equals_brute_force(spark, min_bytes):
    pages = with_clashes(spark.createDataFrame(PAGES, SCHEMA), "payload", "sha", "file").repartition(3)
    got = sorted(tuple(r) for r in warc.round_trip(pages, min_bytes).collect())
    assert got == expected(PAGES, min_bytes)


def test_one_archive_is_read_by_many_tasks(spark):
    pages = PAGES + [(100 + i, "u", f"{i} " * (i * 37 % 400) + (FORGED if i % 7 == 0 else "")) for i in range(300)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        path = new_path(spark, "warc")
        warc.write_archive(spark.createDataFrame(pages, SCHEMA).coalesce(1), path)
        lines = warc.candidates(spark, path)
        assert lines.select("block").distinct().count() > 20
        assert sorted(tuple(r) for r in warc.read_archive(spark, path).collect()) == expected(pages)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_second_look_may_cut_archives_into_other_blocks(spark, monkeypatch):
    pages = PAGES + [(100 + i, "u", f"{i} " * (i * 37 % 400) + (FORGED if i % 7 == 0 else "")) for i in range(100)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    sizes, lines = iter(["5000", "3100"]), warc._lines

    def cut(*args):
        spark.conf.set("spark.sql.files.maxPartitionBytes", next(sizes))
        return lines(*args)

    path = new_path(spark, "warc")
    warc.write_archive(spark.createDataFrame(pages, SCHEMA).coalesce(1), path)
    monkeypatch.setattr(warc, "_lines", cut)
    try:
        assert sorted(tuple(r) for r in warc.read_archive(spark, path).collect()) == expected(pages)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_complete_record_without_its_payload_is_an_error(spark, monkeypatch):
    path = new_path(spark, "warc")
    warc.write_archive(spark.createDataFrame(PAGES, SCHEMA).coalesce(1), path)
    joined = warc._joined
    monkeypatch.setattr(warc, "_joined", lambda *a: joined(*a).limit(0))
    with pytest.raises(Exception, match="no payload of the record"):
        warc.read_archive(spark, path).collect()


def test_a_cut_off_archive_loses_its_last_record_only(spark, tmp_path):
    path = new_path(spark, "warc")
    warc.write_archive(spark.createDataFrame(PAGES[:1] + PAGES[11:12], SCHEMA).coalesce(1), path)
    [whole] = [r.value for r in spark.read.text(path, wholetext=True).collect() if r.value]
    cut = tmp_path / "cut.warc"
    cut.write_bytes(whole.encode()[:-100])
    assert [r.page_id for r in warc.read_archive(spark, str(cut)).collect()] == [5]


def test_null_and_repeated_ids_and_an_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(None, "u", "a"), (None, "u", "b"), (2, "u", "a"), (2, "u", "a"), (7, None, "a")]
    got = sorted((str(r.page_id), r.record_type, r.refers_to) for r in warc.round_trip(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [("2", "response", None), ("2", "response", None), ("7", "revisit", 2), ("None", "response", None), ("None", "revisit", 2)]

import base64
import hashlib

import pytest

from gaugeline.llm.storage import open_output
from gaugeline.llm.warc import (
    ArchiveWriter,
    WarcError,
    archive_round_trip,
    parse_record,
    read_archive,
    read_archives,
    record_bytes,
    write_archives,
)

SCHEMA = "page_id long, url string, html string"
HEADERS = [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>"), ("WARC-Date", "2026-01-01T00:00:00Z")]
PAGES = [(k, f"http://a/{k}", f"<p>page {k % 37} " + "text " * (k % 50)) for k in range(300)]
PAGES += [(1000, None, None), (1001, "u", ""), (1002, "u\r\nX: y", "é 日本"), (1003, "u", "z" * 3_000_000), (1004, "u", "\r\n\r\nWARC/1.1\r\n")]


def test_pages_equal_a_plain_round(spark):
    newest = {}
    for page_id, _, html in PAGES:
        newest[html or ""] = max(page_id, newest.get(html or "", 0))
    found = {r.page_id: r for r in archive_round_trip(spark.createDataFrame(PAGES, SCHEMA).repartition(3)).collect()}
    assert len(found) == len(PAGES)
    for page_id, _, html in PAGES:
        payload, row, first = (html or "").encode(), found[page_id], newest[html or ""]
        assert row.payload_bytes == len(payload)
        assert row.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (row.record_type, row.refers_to) == (("response", None) if first == page_id else ("revisit", first))
        assert bytes(row.payload) == (payload if first == page_id else b"")


def test_short_payloads_can_be_left_alone(spark):
    rows = archive_round_trip(spark.createDataFrame([(1, "", "ab"), (2, "", "ab"), (3, "", "abc"), (4, "", "abc")], SCHEMA), least=3)
    assert {r.page_id: r.refers_to for r in rows.collect()} == {1: None, 2: None, 3: 4, 4: None}


def test_empty_tables_null_ids_and_repeated_rows(spark):
    assert archive_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = spark.createDataFrame([(None, "u", "a"), (7, "u", "a"), (7, "u", "a"), (3, "u", "a")], SCHEMA).selectExpr("*", "1 AS content", "2 AS n")
    found = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in archive_round_trip(rows).collect())
    assert found == [(0, "response", None), (3, "revisit", 7), (7, "response", None), (7, "response", None)]


def test_archives_are_cut_and_listed(spark, monkeypatch):
    files = write_archives(spark.createDataFrame(PAGES, SCHEMA).repartition(2))
    assert sum(r.records for r in files.collect()) == len(PAGES)
    assert read_archives(files).count() == len(PAGES)
    name = files.first().file
    assert open(name.removeprefix("file://"), "rb").read(4) == bytes.fromhex("5D2A4D18")


@pytest.mark.parametrize(
    "bad",
    [
        b"WARC/2.0\r\nWARC-Type: a\r\n\r\n\r\n\r\n",
        record_bytes(HEADERS, b"abc")[:-1],
        record_bytes(HEADERS, b"abc").replace(b"Content-Length: 3", b"Content-Length: 4"),
        record_bytes(HEADERS, b"abc").replace(b"Content-Length: 3", b"Content-Length: +3"),
        record_bytes(HEADERS[1:], b"abc"),
        record_bytes([*HEADERS, ("WARC-Type", "again")], b"abc"),
        record_bytes([*HEADERS, ("no colon\r\nrest", "x")], b"abc"),
    ],
)
def test_bad_records_are_refused(bad):
    with pytest.raises(WarcError):
        parse_record(bad)


def test_damaged_archives_are_refused(tmp_path):
    name = str(tmp_path / "a.warc.zst")
    writer = ArchiveWriter(name, [b"sample"])
    for k in range(3):
        writer.write(record_bytes(HEADERS, b"x" * k))
    writer.close()
    assert [r.block for r in read_archive(name)] == [b"", b"x", b"xx"]
    data = open(name, "rb").read()
    import zstandard

    for k, bad in enumerate((data[8:], data[:-3], data[:6], data[:-10] + bytes(10))):
        other = str(tmp_path / f"{k}.warc.zst")
        with open_output(other) as out:
            out.write(bad)
        with pytest.raises((WarcError, zstandard.ZstdError)):
            list(read_archive(other))


def test_payloads_of_one_page_id_go_by_their_own(spark):
    pages = [(7, "u", "unique"), (7, "u", "shared"), (8, "u", "shared"), (5, "u", "a"), (5, "u", "b"), (6, "u", "a"), (9, "u", "b")]
    found = archive_round_trip(spark.createDataFrame(pages, SCHEMA)).collect()
    assert len(found) == len(pages)
    assert {bytes(r.payload) for r in found if r.record_type == "response"} == {b"unique", b"shared", b"a", b"b"}
    assert sorted((r.page_id, r.refers_to) for r in found if r.record_type == "revisit") == [(5, 6), (5, 9), (7, 8)]

from __future__ import annotations

import base64
import gzip
import hashlib
import json
from urllib.parse import urlparse

import pyarrow.fs as pafs

from lift.llm import warc
from lift.llm.warc import archived_pages, normalise, read_back, records_of, write_archives
from lift.sources.shared import fresh_path


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


ROWS = [(5, "http://a/x y", "<p>é</p>"), (3, "http://a/2", "<p>é</p>"), (9, None, None), (8, "http://b", ""), (1, "http://c/\r\nX: 1", "WARC/1.1\r\n\r\n" * 30),
        (2, "u", "z" * 300_000), (7, "u", "z" * 300_000), (4, "v", "unique"), (4, "v", "unique"), (None, "n", "<p>é</p>"), (None, "n", "alone")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*row, "x", "y") for row in rows], "page_id long, url string, html string, id string, sha string").repartition(3)


def plain(rows, least=0):
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = min(same, default=None)
        revisit = len(payload) >= least and first is not None and first != page
        out.append((page, len(payload), digest(payload), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_round_trip(spark):
    assert rows_of(archived_pages(frame(spark))) == plain(ROWS)
    assert archived_pages(frame(spark, [])).collect() == []


def test_an_empty_id_is_not_a_missing_one(spark):
    rows = [("", "u", "<p>same</p>"), ("b", "u", "<p>same</p>"), (None, "u", "<p>same</p>"), ("c", "u", "alone")]
    found = rows_of(archived_pages(spark.createDataFrame(rows, "page_id string, url string, html string")))
    assert sorted(((r[0], *r[3:5]) for r in found), key=str) == sorted(
        [("", "response", None), ("b", "revisit", ""), (None, "revisit", ""), ("c", "response", None)], key=str)


def test_small_payloads_do_not_revisit(spark):
    written = write_archives(frame(spark), fresh_path(spark, "warc"), least_bytes=100)
    found = read_back(normalise(written, fresh_path(spark, "warc")))
    kinds = sorted((str(r["id"]), r["record_type"]) for r in found.collect())
    assert kinds == sorted((str(p), kind) for p, _, _, kind, _ in plain(ROWS, 100))


def test_normaliser_gives_each_record_a_member(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 200_000)
    written = write_archives(frame(spark), fresh_path(spark, "warc"))
    whole = normalise(written, fresh_path(spark, "warc"))
    assert sum(r["records"] for r in written.collect()) == sum(r["records"] for r in whole.collect()) == len(ROWS)
    for row in whole.collect():
        with open(urlparse(row["archive"]).path, "rb") as file:
            data = file.read()
        with open(urlparse(row["index"]).path) as file:
            lines = [json.loads(line) for line in file]
        assert len(lines) == row["records"] and sum(line["length"] for line in lines) == len(data)
        for line in lines:
            member = gzip.decompress(data[line["offset"] : line["offset"] + line["length"]])
            (found, raw), = records_of(iter([member]))
            assert raw == member and found["warc-record-id"] == line["id"]


def test_records_across_pieces_and_members(tmp_path):
    raw = [warc.record(str(i), "u", b"x" * (i * 37), None, "1970-01-01T00:00:00Z") for i in range(20)]
    for packed in (gzip.compress(b"".join(raw)), b"".join(map(gzip.compress, raw))):
        path = tmp_path / "one.warc.gz"
        path.write_bytes(packed)
        with pafs.LocalFileSystem().open_input_stream(str(path), compression=None) as stream:
            assert [r for _, r in records_of(warc.inflated(stream))] == raw
    for size in (1, 7, 1000):
        joined = b"".join(raw)
        assert [r for _, r in records_of(joined[k : k + size] for k in range(0, len(joined), size))] == raw

"""WARC archives: writing them, normalising monolithic gzip, and reading them back.

A whole-file gzip stream can't be read from the middle. The normaliser inflates
each such archive once, in pieces, writes every record as a gzip member of its
own, and puts an index beside the archive: one JSON line per record with its
offset and length. The reader opens records through that index.

Archives are files in a folder that all executors share (any that Arrow's file
systems open), with names that no other attempt of a task has. A task's result
names the files that it finished, so a repeated or lost attempt leaves a
file that nobody reads, and never a wrong one.

Of records with equal payloads of at least ``least_bytes`` bytes the one with the
smallest id is a response, and the others revisit it; smaller ones are all
responses. A revisit stores the digest and the length of the payload, not the payload.

Defined results: a null html is an empty payload; a null url is an empty one;
rows that share the smallest id and the payload are all responses; a row without an
id revisits a row that has one, and is a response if there is none; a page of
any size is one record; an empty table gives no archives and an empty result; other
columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lift.functions.columns import named
from lift.llm.batches import slices, type_of
from lift.sources.shared import fresh_path, materialise

#: An archive is closed when it holds so many bytes before compression.
ARCHIVE_BYTES = 32 << 20
PIECE = 1 << 20
GZIP = 31  # zlib's window bits for a gzip wrapper
#: The name of a page without an id; an empty id is URN alone.
NO_PAGE = "urn:page"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: str | None, url: str, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One record, before compression. A revisit keeps the response's header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{NO_PAGE if page is None else URN + quote(page, safe='')}>",
            f"WARC-Target-URI: {quote(url, safe='%/:?#[]@!$&()*+,;=~')}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest_of(payload)}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{URN}{quote(refers_to, safe='')}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}


def page_of(value: str | None) -> str | None:
    """The page that ``<urn:page:...>`` names."""
    name = value.strip("<>") if value else NO_PAGE
    return None if name == NO_PAGE else unquote(name[len(URN):])


def located(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def kinds_of(df: DataFrame, id_col: str, html_col: str, least_bytes: int) -> DataFrame:
    """``(id, sha, refers_to)`` of the rows that revisit another."""
    payload = F.encode(F.coalesce(named(html_col), F.lit("")), "UTF-8")
    narrow = materialise(df.select(named(id_col).alias("id"), F.sha1(payload).alias("sha"), F.octet_length(payload).alias("size")), "warc-digests")
    large = narrow.where(F.col("size") >= least_bytes).drop("size")
    first = large.groupBy("sha").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null").select("sha", "first")
    return large.join(first, "sha").where(~F.col("id").eqNullSafe(F.col("first"))).select("id", "sha", F.col("first").alias("refers_to")).distinct()


def write_archives(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0,
                   date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write each row as a record into archives that are one gzip stream each; ``(archive, records)``."""
    payload = F.encode(F.coalesce(named(html_col), F.lit("")), "UTF-8")
    rows = df.select(named(id_col).alias("id"), F.coalesce(named(url_col), F.lit("")).alias("url"), payload.alias("payload"), F.sha1(payload).alias("sha"))
    again = kinds_of(df, id_col, html_col, least_bytes).select(F.col("id").alias("a_id"), F.col("sha").alias("a_sha"), "refers_to")
    joined = rows.join(again, F.col("id").eqNullSafe(F.col("a_id")) & (F.col("sha") == F.col("a_sha")), "left").select(
        F.col("id").cast("string").alias("id"), "url", "payload", F.col("refers_to").cast("string").alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = located(folder)
        out = packer = name = None
        records = size = 0
        for batch in batches:
            for part in slices(batch, "payload"):
                for page, url, body, refers_to in zip(*(part.column(c).to_pylist() for c in ("id", "url", "payload", "refers_to"))):
                    if out is None:
                        fs.create_dir(base, recursive=True)
                        name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                        out, packer = fs.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(1, zlib.DEFLATED, GZIP)
                    raw = record(page, url, body, refers_to, date)
                    out.write(packer.compress(raw))
                    records, size = records + 1, size + len(raw)
                    if size >= ARCHIVE_BYTES:
                        out.write(packer.flush())
                        out.close()
                        out = None
                        yield pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "records": [records]})
        if out is not None:
            out.write(packer.flush())
            out.close()
            yield pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "records": [records]})

    return materialise(joined.mapInArrow(write, "archive string, records long"), "warc-written")


def inflated(stream: pa.NativeFile) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, in pieces."""
    unpacker, rest = zlib.decompressobj(GZIP), b""
    while True:
        piece = rest or stream.read(PIECE)
        if not piece:
            return
        data = unpacker.decompress(piece, PIECE)
        rest = unpacker.unconsumed_tail
        if data:
            yield data
        if unpacker.eof:
            rest = unpacker.unused_data
            unpacker = zlib.decompressobj(GZIP)


def records_of(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Each record's fields and its bytes; one record is held at a time."""
    buffer = bytearray()
    for piece in pieces:
        buffer += piece
        while True:
            head = buffer.find(b"\r\n\r\n")
            if head < 0:
                break
            found = fields(bytes(buffer[:head]))
            end = head + 4 + int(found["content-length"]) + 4
            if len(buffer) < end:
                need = end - len(buffer)
                got = bytearray()
                for more in pieces:  # a long record: gather its pieces, then look again
                    got += more
                    if len(got) >= need:
                        break
                buffer += got
                if len(buffer) < end:
                    raise ValueError("an archive ends within a record")
            yield found, bytes(buffer[:end])
            del buffer[:end]
    if buffer.strip():
        raise ValueError("an archive ends within a record")


def one_to_a_task(archives: DataFrame) -> DataFrame:
    return archives.repartition(max(1, archives.count()), "archive")


def normalise(archives: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Rewrite each archive with a gzip member per record and an index beside it; ``(archive, index, records)``."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, base = located(folder)
        for batch in batches:
            for uri in batch.column("archive").to_pylist():
                to.create_dir(base, recursive=True)
                name = f"{uuid.uuid4().hex}.warc.gz"
                fs, path = located(uri)
                offset = count = 0
                with fs.open_input_stream(path, compression=None) as stream, to.open_output_stream(f"{base}/{name}", compression=None) as out, \
                        to.open_output_stream(f"{base}/{name}.idx", compression=None) as index:
                    for found, raw in records_of(inflated(stream)):
                        packer = zlib.compressobj(level, zlib.DEFLATED, GZIP)
                        member = packer.compress(raw) + packer.flush()
                        out.write(member)
                        line = {"id": found["warc-record-id"], "type": found["warc-type"], "offset": offset, "length": len(member)}
                        index.write(json.dumps(line).encode() + b"\n")
                        offset, count = offset + len(member), count + 1
                yield pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "index": [f"{folder}/{name}.idx"], "records": [count]})

    return materialise(one_to_a_task(archives).mapInArrow(rewrite, "archive string, index string, records long"), "warc-normalised")


def index_lines(uri: str) -> Iterator[dict]:
    fs, path = located(uri)
    rest = b""
    with fs.open_input_stream(path, compression=None) as stream:
        while piece := stream.read(PIECE):
            *lines, rest = (rest + piece).split(b"\n")
            yield from map(json.loads, lines)


def read_back(archives: DataFrame) -> DataFrame:
    """``(id, url, payload_bytes, payload_digest, record_type, refers_to)`` of every record, opened through the index.

    The digest of a stored payload is computed anew and must be the one that its record states.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
        types = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
        for batch in batches:
            for uri, index in zip(batch.column("archive").to_pylist(), batch.column("index").to_pylist()):
                fs, path = located(uri)
                rows: list[tuple] = []
                with fs.open_input_file(path) as file:
                    for line in index_lines(index):
                        file.seek(line["offset"])
                        rows.append(parsed(zlib.decompress(file.read(line["length"]), GZIP)))
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

    schema = "id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    return one_to_a_task(archives).mapInArrow(read, schema)


def parsed(raw: bytes) -> tuple[str | None, str, int, str, str, str | None]:
    head, _, block = raw.partition(b"\r\n\r\n")
    found = fields(head)
    http, _, payload = block[: int(found["content-length"])].partition(b"\r\n\r\n")
    size, digest = int(fields(http)["content-length"]), found["warc-payload-digest"].removeprefix("sha1:")
    if found["warc-type"] == "response" and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"{found['warc-record-id']} is damaged")
    return page_of(found["warc-record-id"]), unquote(found["warc-target-uri"]), size, digest, found["warc-type"], page_of(found.get("warc-refers-to"))


def archived_pages(df: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Write, normalise and read back; one row per page."""
    spark = df.sparkSession
    written = write_archives(df, fresh_path(spark, "warc-monolithic"), id_col=id_col)
    whole = normalise(written, fresh_path(spark, "warc"))
    kind = type_of(df, id_col)
    return read_back(whole).select(F.col("id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type",
                                   F.col("refers_to").cast(kind).alias("refers_to"))

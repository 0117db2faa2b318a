"""WARC archives of Zstandard frames with a shared dictionary: writer and validating reader."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from voxtally.llm.common import bounded_sample, settle
from voxtally.session import shared_path

# Frame magics (little endian) of the Zstandard format, and the skippable frame of a WARC dictionary.
DICT_FRAME = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Pages that the dictionary is made from, at most (about), and its size in bytes.
SAMPLE_ROWS = 400
DICT_BYTES = 65_536
#: Digests of several pages that are broadcast, at most (some 30 MB).
REPEATED = 500_000
#: Every record carries this time, so that a repeated task writes the same bytes.
DATE = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response with the payload, or, with `refers_to`, a revisit with the HTTP header only."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if refers_to is not None else head + payload
    clean = "".join(c for c in url or "" if c >= " ")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Target-URI", clean), ("WARC-Date", DATE),
        ("WARC-Payload-Digest", "sha1:" + payload_digest(payload)), ("WARC-Block-Digest", "sha1:" + payload_digest(block)),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if refers_to is not None:
        fields[4:4] = [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "surrogatepass")
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


class BadArchive(ValueError):
    """An archive or record that breaks the format."""


@dataclass
class Record:
    fields: dict[str, str]
    http: dict[str, str]
    payload: bytes


def _headers(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise BadArchive(f"header line {line[:60]!r}")
        out[name.decode("ascii").lower()] = value.strip().decode("utf-8", "surrogatepass")
    return out


def parse_record(data: bytes) -> Record:
    """Check one decoded frame: version, required fields, lengths and both digests."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise BadArchive("no WARC/1.1 header")
    fields = _headers(lines[1:])
    for name in ("warc-type", "warc-record-id", "warc-date", "warc-payload-digest", "warc-block-digest", "content-length"):
        if name not in fields:
            raise BadArchive(f"no {name}")
    if not fields["content-length"].isdecimal() or len(rest) != int(fields["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise BadArchive("content-length does not fit the record")
    block = rest[:-4]
    if fields["warc-block-digest"] != "sha1:" + payload_digest(block):
        raise BadArchive("block digest")
    http_head, gap, payload = block.partition(b"\r\n\r\n")
    http_lines = http_head.split(b"\r\n")
    if not gap or not http_lines[0].startswith(b"HTTP/"):
        raise BadArchive("no HTTP header")
    http = _headers(http_lines[1:])
    if not http.get("content-length", "").isdecimal():
        raise BadArchive("no HTTP length")
    if fields["warc-type"] == "response":
        if len(payload) != int(http["content-length"]) or fields["warc-payload-digest"] != "sha1:" + payload_digest(payload):
            raise BadArchive("payload length or digest")
    elif fields["warc-type"] != "revisit" or payload or "warc-refers-to" not in fields:
        raise BadArchive("revisit")
    return Record(fields, http, payload)


def dictionary_frame(dictionary: bytes) -> bytes:
    """The skippable frame that leads an archive; the dictionary in it is itself compressed."""
    body = zstandard.ZstdCompressor(level=9).compress(dictionary)
    return struct.pack("<II", DICT_FRAME, len(body)) + body


def read_archive(data: bytes | memoryview) -> Iterator[Record]:
    """Records of one archive. The leading skippable frame gives the dictionary, plain or compressed;
    an archive without one has none. Every further frame must hold exactly one record."""
    view, at, dictionary = memoryview(data), 0, None
    if len(view) >= 8 and struct.unpack_from("<I", view)[0] == DICT_FRAME:
        size = struct.unpack_from("<I", view, 4)[0]
        at = 8 + size
        if at > len(view):
            raise BadArchive("dictionary frame is cut off")
        body = bytes(view[8:at])
        if body:
            raw = zstandard.ZstdDecompressor().decompress(body) if body[:4] == ZSTD_MAGIC else body
            dictionary = zstandard.ZstdCompressionDict(raw)
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(view):
        if bytes(view[at : at + 4]) != ZSTD_MAGIC:
            raise BadArchive(f"no frame at {at}")
        frame = decoder.decompressobj()
        parts, step, begun = [], 1 << 16, at
        while not frame.eof:
            if at >= len(view):
                raise BadArchive(f"frame at {begun} is cut off")
            try:
                parts.append(frame.decompress(view[at : at + step]))
            except zstandard.ZstdError as err:
                raise BadArchive(f"frame at {begun}: {err}") from err
            at += step
        at = min(at, len(view)) - len(frame.unused_data)
        yield parse_record(b"".join(parts))


def train_dictionary(pages: DataFrame, page_id: str, html: str, rows: int = SAMPLE_ROWS, size: int = DICT_BYTES) -> bytes:
    """A dictionary from the first 8 kB of about `rows` sampled pages at most; empty when they give too little."""
    sample = bounded_sample(pages.select(F.col(page_id).alias("_id"), F.substring(html, 1, 8192).alias("h")), "_id", rows)
    texts = [r.h.encode("utf-8", "surrogatepass") for r in sample.select("h").where("h <> ''").limit(2 * rows).collect()]
    try:
        return zstandard.train_dictionary(size, texts).as_bytes()
    except zstandard.ZstdError:
        return b""


def with_references(pages: DataFrame, page_id: str, html: str, least_bytes: int = 0) -> DataFrame:
    """`pages` with (_payload, _refers): null for the page with the least id among equal payloads of
    at least `least_bytes`, and for shorter ones.

    Digests and ids alone are grouped. Digests of one page are dropped; up to REPEATED of the others
    are broadcast, so that no payload is shuffled. Beyond that they are joined by shuffle.
    """
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.withColumn("_payload", payload).withColumn("_sha1", F.unhex(F.sha1("_payload")))
    long = rows.where(F.octet_length("_payload") >= least_bytes)
    groups = long.groupBy("_sha1").agg(F.min(page_id).alias("_first"), F.max(page_id).alias("_last"))
    first = settle(groups.where("_first < _last").select("_sha1", "_first"), "repeated")
    joined = rows.join(F.broadcast(first) if first.count() <= REPEATED else first, "_sha1", "left")
    return joined.withColumn("_refers", F.when(F.col(page_id) != F.col("_first"), F.col("_first"))).drop("_sha1", "_first")


def write_archives(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", *, dictionary: bytes | None = None,
    least_bytes: int = 0, rows_per_archive: int = 5_000, bytes_per_archive: int = 1 << 26,
) -> DataFrame:
    """(archive, part, records, content): the bytes of one archive per row.

    Ids are bigints. A record per row of `pages`; null html is an empty payload, null url an empty
    one, and a row without id is a response without id. Rows that repeat an id and a payload are
    all responses. Each partition cuts its rows into archives of at most `rows_per_archive`, or of
    `bytes_per_archive` and one record.
    """
    dictionary = train_dictionary(pages, page_id, html) if dictionary is None else dictionary
    lead = dictionary_frame(dictionary)
    slim = pages.select(F.col(page_id).cast("bigint").alias("id"), F.col(url).alias("url"), F.col(html).alias("html"))
    rows = with_references(slim, "id", "html", least_bytes).select("id", "url", "_payload", "_refers")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        coder = zstandard.ZstdCompressor(level=3, dict_data=known, write_content_size=True)
        frames: list[bytes] = []
        size = 0

        def archive() -> pa.RecordBatch:
            content = lead + b"".join(frames)
            return pa.record_batch([
                pa.array([hashlib.sha1(content).hexdigest()], pa.string()), pa.array([len(frames)], pa.int64()),
                pa.array([content], pa.binary())], ["archive", "records", "content"])

        for batch in batches:
            for i in range(batch.num_rows):
                page, address, payload, refers = (batch.column(c)[i].as_py() for c in range(4))
                frames.append(coder.compress(make_record(page, address, payload, refers)))
                size += len(frames[-1])
                if len(frames) >= rows_per_archive or size >= bytes_per_archive:
                    yield archive()
                    frames.clear()
                    size = 0
        if frames:
            yield archive()

    return rows.mapInArrow(pack, "archive string, records bigint, content binary")


_ENTRY = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def _page(urn: str) -> int | None:
    if not urn.startswith("<urn:page:") or not urn.endswith(">"):
        raise BadArchive(f"record id {urn[:60]}")
    return int(urn[10:-1]) if urn[10:-1] else None


def read_archives(archives: DataFrame, content: str = "content") -> DataFrame:
    """One row per record of the archives in a binary column, such as Spark's binaryFile source
    gives: page_id, url, payload_bytes and payload_digest of the full payload, record_type,
    refers_to, payload (null for revisits). A broken archive or record fails the job. A null
    content is skipped.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
            names = [part.split()[0] for part in _ENTRY.split(", ")]
            return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

        for batch in batches:
            for value in batch.column(0):
                rows: list[tuple] = []
                for record in read_archive(value.as_buffer() if value.is_valid else b""):
                    f, revisit = record.fields, record.fields["warc-type"] == "revisit"
                    rows.append((
                        _page(f["warc-record-id"]), f.get("warc-target-uri"), int(record.http["content-length"]),
                        f["warc-payload-digest"].removeprefix("sha1:"), f["warc-type"],
                        _page(f["warc-refers-to"]) if revisit else None, None if revisit else record.payload))
                    if len(rows) >= 500:
                        yield out(rows)
                        rows = []
                yield out(rows)

    return archives.select(content).mapInArrow(unpack, _ENTRY)


def save_archives(archives: DataFrame, path: str | None = None) -> DataFrame:
    """Write the archives to the shared folder and give the table of what was written.

    They are rows of a Parquet table, one file's bytes each: Spark commits them on any file system,
    also when a task runs twice, and executors read them back from there.
    """
    path = path or shared_path(archives.sparkSession, "warc")
    archives.write.option("compression", "none").parquet(path)
    return archives.sparkSession.read.schema(archives.schema).parquet(path)


def export_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Write each archive as `<archive>.warc.zst` into a folder that executors reach, for tools
    outside Spark; gives the paths. The name is the content's hash, so a repeated task rewrites the
    same file. `spark.read.format("binaryFile")` and `read_archives` read them back.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        where, base = fs.FileSystem.from_uri(folder)
        where.create_dir(base, recursive=True)
        for batch in batches:
            names = []
            for name, content in zip(batch.column("archive").to_pylist(), batch.column("content")):
                with where.open_output_stream(f"{base}/{name}.part") as out:
                    out.write(content.as_buffer())
                where.move(f"{base}/{name}.part", f"{base}/{name}.warc.zst")
                names.append(f"{folder}/{name}.warc.zst")
            yield pa.record_batch([pa.array(names, pa.string())], ["path"])

    return archives.select("archive", "content").mapInArrow(put, "path string")

"""WARC archives: a Python data source that writes and reads them.

Writing: ``df.write.format("warc").mode("append").save(folder)`` takes the columns of
``RECORD`` (see ``to_records``). Each task writes files of its own names; only the
commit names them as archives, so a repeated task leaves nothing behind that is
read. With ``compression=gzip`` each record is a member of its own.

Reading: ``spark.read.format("warc").load(folder)``. Files are dealt to partitions
by size. A record's header is parsed first; equality and IN on ``record_type`` and equality and
prefix on ``target_uri`` are pushed down, and bodies of records that they or
``payload=false`` rule out are skipped over without being decoded or checked:
in a plain archive, and in a gzipped one whose members tell their length in the ``sl`` field of their header, as the writer's
do, by a seek; in other gzipped archives they must be inflated to find their end.
``payload=digest`` computes digest and length of a payload without returning it.

Nulls: a null payload is written as an empty one, a null address as none. Empty
folders read as no records. Repeated records are all kept. Damaged headers, records that are cut off and payloads that
differ from the digest in their header (unless ``verify=false``) raise with file and offset.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import struct
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    StringStartsWith,
    WriterCommitMessage,
)

from shopmart.llm.common import lookup, open_folder, ship, stored

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"

# What the writer takes.
RECORD = "record_id string, record_type string, target_uri string, refers_to string, html string"

# What the reader gives.
SCHEMA = (
    "record_id string, record_type string, target_uri string, refers_to_id string, "
    "payload_digest string, payload_bytes long, payload binary, headers map<string,string>, "
    "file string, offset long"
)

# Names and formats of the public WARC 1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BODY_TYPE = "application/http;msgtype=response"
HTML = "text/html; charset=utf-8"
DATE = "1970-01-01T00:00:00Z"
LENGTH_FIELD = "X-Payload-Length"  # an extension field, so that revisits tell the length too

# A file is one partition's work.
FILE_BYTES = PARTITION_BYTES = 1 << 26
# A gzip member's fixed header with an extra field, and the name of the field of lengths.
_MEMBER = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff"
_LENGTHS = b"sl"
_CHUNK = 1 << 16
_AHEAD = 1 << 12  # what is inflated of a member at a time while its header is parsed


def base32_digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(text: str) -> str:
    """A header value: without control characters, which are percent-encoded."""
    return "".join(urllib.parse.quote(c) if ord(c) < 32 or ord(c) == 127 else c for c in text)


def record_bytes(
    record_id: str, kind: str, uri: str | None, refers_to: str | None, payload: bytes
) -> bytes:
    """One record; a revisit has the payload's digest and length, but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: {HTML}\r\nContent-Length: {len(payload)}\r\n\r\n"
    body = http.encode() + (payload if kind == "response" else b"")
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{base32_digest(payload)}"),
        (LENGTH_FIELD, str(len(payload))),
        ("Content-Type", BODY_TYPE),
        ("Content-Length", str(len(body))),
    ]
    if uri is not None:
        fields.append(("WARC-Target-URI", _line(uri)))
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"{VERSION}\r\n{head}\r\n".encode() + body + b"\r\n\r\n"


def member_bytes(data: bytes) -> bytes:
    """A gzip member, whose header tells how long it is."""
    packer = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    length = len(_MEMBER) + 14 + len(body) + 8
    if max(length, len(data)) >> 32:
        return gzip.compress(data, 1, mtime=0)
    extra = _LENGTHS + struct.pack("<HII", 8, length, len(data))
    end = struct.pack("<II", zlib.crc32(data), len(data))
    return _MEMBER + struct.pack("<H", len(extra)) + extra + body + end


def member_length(head: bytes) -> int | None:
    """The length of the member that begins with ``head``, if its header tells it."""
    if len(head) < 12 or head[:4] != _MEMBER[:4]:
        return None
    at, stop = 12, 12 + struct.unpack_from("<H", head, 10)[0]
    while at + 4 <= min(stop, len(head)):
        size = struct.unpack_from("<H", head, at + 2)[0]
        if head[at : at + 2] == _LENGTHS and size == 8 and at + 12 <= len(head):
            return struct.unpack_from("<I", head, at + 4)[0]
        at += 4 + size
    return None


class _Inflated(io.RawIOBase):
    """The text of one gzip member, inflated no further than it is read."""

    def __init__(self, raw, where: str) -> None:
        self.raw, self.where, self.inflate, self.rest = raw, where, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.inflate.eof:
            data = self.inflate.unconsumed_tail or self.raw.read(_CHUNK)
            if not data:
                raise ValueError(f"record cut off at {self.where}")
            out = self.inflate.decompress(data, len(buffer))
            if out:
                buffer[: len(out)] = out
                return len(out)
        return 0


class _Files(WriterCommitMessage):
    def __init__(self, names: list[str]) -> None:
        self.names = names


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, gzipped: bool) -> None:
        self.folder, self.gzipped = folder, gzipped

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        files, base = open_folder(self.folder)
        names, stream, size = [], None, 0
        for batch in iterator:
            columns = {f.name: c.to_pylist() for f, c in zip(batch.schema, batch.columns, strict=True)}
            for record_id, kind, uri, refers_to, html in zip(
                *(columns[k] for k in ("record_id", "record_type", "target_uri", "refers_to", "html")),
                strict=True,
            ):
                data = record_bytes(record_id, kind, uri, refers_to, (html or "").encode())
                data = member_bytes(data) if self.gzipped else data
                if stream is None or size > FILE_BYTES:
                    if stream:
                        stream.close()
                    names.append(f"_{uuid.uuid4().hex}.warc" + ".gz" * self.gzipped)
                    stream, size = files.open_output_stream(f"{base}/{names[-1]}", compression=None), 0
                stream.write(data)
                size += len(data)
        if stream:
            stream.close()
        return _Files(names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, base = open_folder(self.folder)
        for name in (n for m in messages if m for n in m.names):
            files.move(f"{base}/{name}", f"{base}/{name[1:]}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        files, base = open_folder(self.folder)
        for name in (n for m in messages if m for n in m.names):
            files.delete_file(f"{base}/{name}")


class _Part(InputPartition):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths


def _deal(sizes: dict[str, int], most: int) -> list[list[str]]:
    """Files in groups of up to ``most`` bytes, a larger file alone."""
    groups, held = [], 0
    for path in sorted(sizes):
        if not groups or held + sizes[path] > most:
            groups.append([])
            held = 0
        groups[-1].append(path)
        held += sizes[path]
    return groups


def _header(stream, where: str) -> dict[str, str] | None:
    """The fields of the next record, or None at the end."""
    first = stream.readline()
    while first in (b"\r\n", b"\n"):
        first = stream.readline()
    if not first:
        return None
    if not first.startswith(b"WARC/"):
        raise ValueError(f"no WARC record at {where}")
    fields: dict[str, str] = {}
    name = ""
    while (line := stream.readline()) not in (b"\r\n", b"\n"):
        if not line:
            raise ValueError(f"record cut off in its header at {where}")
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in (" ", "\t") and name:  # goes on from the line before
            fields[name] += " " + text.strip()
            continue
        name, _, value = text.partition(":")
        name = name.strip().lower()
        fields[name] = value.strip()
    return fields


def _size(fields: dict[str, str], where: str) -> int:
    size = fields.get("content-length", "0")
    if not size.isdecimal():
        raise ValueError(f"content length {size!r} at {where}")
    return int(size)


def _skip(stream, n: int) -> None:
    if stream.seekable():
        stream.seek(n, 1)
        return
    while n > 0 and (got := len(stream.read(min(n, 1 << 20)))):
        n -= got


def _payload(body: bytes, content_type: str) -> bytes:
    """The body behind the HTTP header, if there is one."""
    if content_type.replace(" ", "").startswith("application/http"):
        return body.partition(b"\r\n\r\n")[2]
    return body


class WarcReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.folder = options["path"]
        self.payload = options.get("payload", "true").lower()
        if self.payload not in ("true", "digest", "false"):
            raise ValueError(f"payload must be true, digest or false, not {self.payload}")
        self.verify = options.get("verify", "true").lower() != "false"
        self.most = int(options.get("partitionBytes", PARTITION_BYTES))
        self.kinds: set[str] | None = None
        self.uri: str | None = None
        self.uri_prefix = ""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for one in filters:
            match one:
                case EqualTo(("record_type",), value):
                    kinds = {value}
                    self.kinds = kinds if self.kinds is None else self.kinds & kinds
                case In(("record_type",), values):
                    kinds = set(values)
                    self.kinds = kinds if self.kinds is None else self.kinds & kinds
                case EqualTo(("target_uri",), value) if self.uri in (None, value):
                    self.uri = value
                case StringStartsWith(("target_uri",), value) if value.startswith(self.uri_prefix):
                    self.uri_prefix = value
                case _:
                    yield one

    def partitions(self) -> list[InputPartition]:
        files, base = open_folder(self.folder)
        found = files.get_file_info(pafs.FileSelector(base, allow_not_found=True))
        sizes = {
            x.path: x.size
            for x in found
            if x.is_file and x.base_name[0] not in "._" and x.base_name.endswith((".warc", ".warc.gz"))
        }
        return [_Part(paths) for paths in _deal(sizes, self.most)]

    def _wanted(self, fields: dict[str, str]) -> bool:
        uri = fields.get("warc-target-uri")
        return (
            (self.kinds is None or fields.get("warc-type") in self.kinds)
            and (self.uri is None or uri == self.uri)
            and (not self.uri_prefix or (uri or "").startswith(self.uri_prefix))
        )

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        files, _ = open_folder(self.folder)
        for path in partition.paths if partition else []:  # an empty folder has no partition
            with files.open_input_file(path) as source:
                raw = io.BufferedReader(source, _CHUNK)
                if path.endswith(".gz"):
                    yield from self._members(raw, path, source.size())
                else:
                    yield from self._records(raw, path)

    def _members(self, raw, path: str, size: int) -> Iterator[tuple]:
        """Records of an archive with one member each, as long as members tell their length."""
        at = 0
        while at < size:
            raw.seek(at)
            length = member_length(raw.read(64))
            raw.seek(at)
            if length is None:
                # Read as the text of all members from here on.
                yield from self._records(gzip.open(raw), path)
                return
            if at + length > size:
                raise ValueError(f"record cut off at {path}:{at}")
            where = f"{path}:{at}"
            stream = io.BufferedReader(_Inflated(raw, where), _AHEAD)
            fields = _header(stream, where)
            if fields is not None and self._wanted(fields):
                yield self._record(stream, fields, path, at)
            at += length

    def _records(self, stream, path: str) -> Iterator[tuple]:
        while True:
            offset = stream.tell()
            where = f"{path}:{offset}"
            try:
                fields = _header(stream, where)
                if fields is None:
                    return
                if self._wanted(fields):
                    yield self._record(stream, fields, path, offset)
                else:
                    _skip(stream, _size(fields, where))
                if stream.readline(3) not in (b"\r\n", b"\n"):  # what follows every record
                    raise ValueError(f"record cut off at {where}")
            except EOFError as cut:
                raise ValueError(f"record cut off at {where}") from cut

    def _record(self, stream, fields: dict[str, str], path: str, offset: int) -> tuple:
        where = f"{path}:{offset}"
        size = _size(fields, where)
        kind = fields.get("warc-type")
        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        length = fields.get(LENGTH_FIELD.lower())
        payload = None
        if self.payload != "false" and kind != "revisit":
            body = stream.read(size)
            if len(body) < size:
                raise ValueError(f"record cut off at {where}")
            payload = _payload(body, fields.get("content-type", ""))
            stated, length = digest, len(payload)
            digest = base32_digest(payload)
            if self.verify and fields.get("warc-payload-digest", "").startswith("sha1:") and stated != digest:
                raise ValueError(f"payload differs from its digest at {where}")
            payload = payload if self.payload == "true" else None
        else:
            _skip(stream, size)
        return (
            fields.get("warc-record-id", "").strip("<>"),
            kind,
            fields.get("warc-target-uri"),
            fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
            digest,
            None if length is None else int(length),
            payload,
            fields,
            path,
            offset,
        )


class WarcSource(DataSource):
    """Options: path; payload (true, digest, false), verify (true, false) and partitionBytes when
    reading, compression (none, gzip) when writing. ``offset`` is that of the record or its member in
    the file, in a gzipped archive without lengths that in the inflated text."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        folder = self.options["path"]
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        return WarcWriter(folder, self.options.get("compression", "none") == "gzip")


def register(spark: SparkSession) -> None:
    spark.conf.set(PUSHDOWN, "true")
    ship(spark)
    spark.dataSource.register(WarcSource)


def page_urn(page_id: Column) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")))


def page_of(urn: Column) -> Column:
    return F.regexp_extract(urn, r"^urn:page:(-?\d+)$", 1).try_cast("long")


def to_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Records of ``pages`` (page_id, url, html), as the writer takes them.

    Of pages with equal payloads of at least ``min_bytes`` bytes, that with the smallest
    page_id is the response and others are revisits of it; the rest are all
    responses. Digests are compared with ids alone; a page's text goes through at most
    one shuffle, none if its payload is that of very many pages. Of rows that repeat a
    page_id and a payload, those with the least address are responses. A null page_id counts
    as the largest.
    """
    text = F.coalesce("html", F.lit(""))
    keyed = pages.select(
        "page_id",
        F.col("url").cast("string").alias("url"),
        text.alias("html"),
        F.sha1(text.cast("binary")).alias("digest"),
        (F.octet_length(text) >= min_bytes).alias("shared"),
    )
    order = F.struct(F.col("page_id").isNull(), "page_id", F.coalesce("url", F.lit("")))
    firsts = keyed.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = stored(firsts, "warc-firsts")
    found = lookup(keyed, firsts, "digest", "n")
    is_first = (order == F.col("first")) | ~F.col("shared")
    return found.select(
        page_urn(F.col("page_id")).alias("record_id"),
        F.when(is_first, "response").otherwise("revisit").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.when(~is_first, page_urn(F.col("first.page_id"))).alias("refers_to"),
        "html",
    )


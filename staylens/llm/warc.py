"""WARC archives as a Spark data source, and a table of pages written as one.

Reading plans a partition per archive. Of each record the WARC header is parsed first; predicates on
record type and header columns are tested on it, and a rejected record is passed over. Archives written
here are gzip with a member per record whose extra field "sl" tells its length, so a skipped payload is
neither inflated nor read; in archives without that field it is inflated and dropped, and in plain
ones the reader seeks past it.

Writing makes archives of bounded size in the tasks. A write counts when its list of archives stands in
the folder; files of failed attempts are in no list and are never read.

`path` is any folder that Arrow's file systems reach (file, hdfs, s3, gs).
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from staylens.llm.store import shared_folder

SCHEMA = (
    "file string, position bigint, record_type string, record_id string, target_uri string, warc_date string, "
    "payload_digest string, refers_to string, payload_bytes bigint, payload binary"
)
# Header names and values fixed by the WARC 1.1 standard.
HEADERS = {
    "record_type": b"warc-type",
    "record_id": b"warc-record-id",
    "target_uri": b"warc-target-uri",
    "warc_date": b"warc-date",
    "payload_digest": b"warc-payload-digest",
    "refers_to": b"warc-refers-to",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
ARCHIVE_BYTES = 1 << 27
HEAD_BYTES = 4096
BATCH_BYTES = 1 << 24
LIST = "_archives-"


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "file:///" + path[5:].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_value(text: str) -> bytes:
    return text.replace("\r", "%0D").replace("\n", "%0A").encode()


def record(kind: str, record_id: str, uri: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """One WARC record. A revisit keeps the HTTP header, which tells the payload's length, and no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    lines = [b"WARC/1.1", b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: " + record_id.encode(), b"WARC-Date: " + date.encode()]
    if uri is not None:
        lines.append(b"WARC-Target-URI: " + _header_value(uri))
    lines.append(b"WARC-Payload-Digest: sha1:" + digest(payload).encode())
    if refers_to is not None:
        lines += [b"WARC-Refers-To: " + refers_to.encode(), b"WARC-Profile: " + REVISIT_PROFILE.encode()]
    lines += [b"Content-Type: application/http;msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """A gzip member with its own length and the data's in the extra field "sl"."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    length = 24 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, length & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04" + struct.pack("<IBBH", 0, 0, 255, len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


@dataclass
class Archive(InputPartition):
    path: str


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class _Records:
    """The records of an archive one by one; `data` is what has been read of the present one."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file, self.at, self.data = file, 0, b""

    def _further(self) -> bool:
        """Read about as much again as there is of the record; False at its end."""
        raise NotImplementedError

    def block_start(self, head: int, length: int) -> bytes:
        """The block at least as far as its first blank line, or all of it where it has none."""
        while b"\r\n\r\n" not in self.data[head : head + length] and len(self.data) < head + length and self._further():
            pass
        return self.data[head : head + length]


class _Plain(_Records):
    """The records of an archive that is not compressed."""

    def head(self) -> bytes | None:
        self.file.seek(self.at)
        self.data = self.file.read(HEAD_BYTES)
        while self.data.strip(b"\r\n") and b"\r\n\r\n" not in self.data and self._further():
            pass
        return self.data.split(b"\r\n\r\n", 1)[0] if self.data.strip(b"\r\n") else None

    def _further(self) -> bool:
        more = self.file.read(max(HEAD_BYTES, len(self.data)))
        self.data += more
        return bool(more)

    def block(self, head: int, length: int) -> bytes:
        self.file.seek(self.at + head)
        return self.file.read(length)

    def skip(self, head: int, length: int) -> None:
        self.at += head + length + 4


class _Gzip(_Records):
    """The records of an archive with one gzip member per record."""

    def head(self) -> bytes | None:
        self.file.seek(self.at)
        self.raw = self.file.read(HEAD_BYTES)
        if not self.raw:
            return None
        self.length = struct.unpack("<I", self.raw[16:20])[0] if self.raw[3] & 4 and self.raw[12:14] == b"sl" else None
        self.inflate = zlib.decompressobj(31)
        self.data = self.inflate.decompress(self.raw, HEAD_BYTES)
        while b"\r\n\r\n" not in self.data and self._further():
            pass
        return self.data.split(b"\r\n\r\n", 1)[0]

    def _further(self) -> bool:
        # What is fetched is inflated at once: a later step goes on from the unconsumed tail alone.
        more = self.inflate.unconsumed_tail or self._more()
        self.data += self.inflate.decompress(more, max(HEAD_BYTES, len(self.data)))
        return bool(more)

    def _more(self) -> bytes:
        if self.inflate.eof:
            return b""
        found = self.file.read(1 << 20)
        self.raw += found
        return found

    def block(self, head: int, length: int) -> bytes:
        if self.length and self.length > len(self.raw):
            self.raw += self.file.read(self.length - len(self.raw))
            self.data = zlib.decompressobj(31).decompress(self.raw)
        else:
            self._all()
        return self.data[head : head + length]

    def _all(self) -> None:
        more = self.inflate.unconsumed_tail
        while not self.inflate.eof:
            self.data += self.inflate.decompress(more or self._more())
            more = self.inflate.unconsumed_tail

    def skip(self, head: int, length: int) -> None:
        if self.length is None:
            self._all()
            self.length = len(self.raw) - len(self.inflate.unused_data)
        self.at += self.length


class WarcReader(DataSourceReader):
    """payload option: read (default), skip (the column is null), or verify (checked against its digest, then null).

    payload_bytes is the same with each: the payload's length, for a revisit the one its HTTP header tells or null.
    """

    def __init__(self, options: dict) -> None:
        self.path, self.payload = options["path"], options.get("payload", "read")
        self.tests: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) else None
            if column in HEADERS:
                self.tests.append((column, frozenset(f.value if isinstance(f, In) else [f.value])))
            else:
                yield f

    def partitions(self) -> list[Archive]:
        files, folder = _file_system(self.path)
        found = [i.path for i in files.get_file_info(pafs.FileSelector(folder, allow_not_found=True))]
        lists = [p for p in found if p.rsplit("/", 1)[-1].startswith(LIST)]
        if lists:
            names = [n for p in lists for n in json.loads(files.open_input_stream(p).read())]
            return [Archive(f"{folder}/{n}") for n in sorted(names)]
        return [Archive(p) for p in sorted(found) if p.endswith((".warc", ".warc.gz"))]

    def read(self, partition: Archive | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there are no archives
            return
        schema = _arrow_schema()
        rows: list[tuple] = []
        held = 0
        for row in self._records(partition.path):
            rows.append(row)
            held += 200 + len(row[-1] or b"")
            if held > BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def _records(self, path: str) -> Iterator[tuple]:
        files, _ = _file_system(self.path)
        with files.open_input_file(path) as file:
            source = _Gzip(file) if path.endswith(".gz") else _Plain(file)
            while (head := source.head()) is not None:
                fields = {}
                for line in head.split(b"\r\n")[1:]:
                    name, _, value = line.partition(b":")
                    fields[name.strip().lower()] = value.strip()
                values = {c: fields[h].decode() if h in fields else None for c, h in HEADERS.items()}
                if values["payload_digest"]:
                    values["payload_digest"] = values["payload_digest"].removeprefix("sha1:")
                start, length, at = len(head) + 4, int(fields.get(b"content-length", b"0")), source.at
                if all(values[c] in wanted for c, wanted in self.tests):
                    yield (path, at, *values.values(), *self._payload(source, fields, values, start, length))
                source.skip(start, length)

    def _payload(self, source: _Gzip | _Plain, fields: dict, values: dict, start: int, length: int) -> tuple[int | None, bytes | None]:
        http = fields.get(b"content-type", b"").startswith(b"application/http")
        if values["record_type"] == "revisit":
            # It has no payload to read or verify; its HTTP header tells the length of the one it stands for.
            lines = source.block_start(start, length).split(b"\r\n\r\n", 1)[0].lower().split(b"\r\n") if http else []
            told = [x.partition(b":")[2].strip() for x in lines if x.startswith(b"content-length:")]
            return (int(told[0]) if told and told[0].isdigit() else None), None
        if self.payload == "skip":
            # The HTTP header is enough: what follows it in the block is the payload.
            header, blank, _ = source.block_start(start, length).partition(b"\r\n\r\n") if http else (b"", b"", b"")
            return length - (len(header) + len(blank) if blank else 0), None
        block = source.block(start, length)
        body = block.split(b"\r\n\r\n", 1)[-1] if http else block
        if self.payload == "verify":
            if values["payload_digest"] and digest(body) != values["payload_digest"]:
                raise ValueError(f"payload of {values['record_id']} does not match its digest")
            return len(body), None
        return len(body), body


def _arrow_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in SCHEMA.split(", "))])


class WarcWriter(DataSourceArrowWriter):
    """Rows (record_type, record_id, target_uri, refers_to, payload) as archives of at most about `archive_bytes`."""

    def __init__(self, options: dict) -> None:
        self.path, self.date = options["path"], options.get("date", DATE)
        self.archive_bytes = int(options.get("archive_bytes", ARCHIVE_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, folder = _file_system(self.path)
        files.create_dir(folder, recursive=True)
        names, out, size = [], None, 0
        for batch in iterator:
            columns = [batch.column(c).to_pylist() for c in ("record_type", "record_id", "target_uri", "payload", "refers_to")]
            for kind, record_id, uri, payload, refers_to in zip(*columns, strict=True):
                if out is None:
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    out, size = files.open_output_stream(f"{folder}/{names[-1]}", compression=None), 0
                member = gzip_member(record(kind, record_id, uri, payload or b"", refers_to, self.date))
                out.write(member)
                size += len(member)
                if size >= self.archive_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        files, folder = _file_system(self.path)
        files.create_dir(folder, recursive=True)
        names = [n for m in messages if m for n in m.files]
        with files.open_output_stream(f"{folder}/{LIST}{uuid.uuid4().hex}") as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages: list[Written | None]) -> None:
        files, folder = _file_system(self.path)
        for name in (n for m in messages if m for n in m.files):
            files.delete_file(f"{folder}/{name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only added to; write to a new folder")
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Rows for the writer, one per row of `pages` (page_id, url, html; other columns are ignored).

    Of pages with equal payloads of at least `least_bytes`, that with the smallest page_id is the
    response and the others revisit it. Null html is an empty payload. A null page_id never revisits and is
    nobody's target; rows that repeat a page_id and payload get the same record. Only page ids and digests
    are grouped: the html goes once through a join on the page, which no frequent payload can skew.
    """
    own = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload")
    )
    thin = own.filter(F.octet_length("payload") >= least_bytes).select("page_id", F.sha1("payload").alias("sha"))
    first = thin.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("sha", "first")
    revisits = thin.join(first, "sha").filter("page_id <> first").distinct()
    wide = own.withColumn("sha", F.sha1("payload")).join(revisits, ["page_id", "sha"], "left")
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    return wide.select(
        F.when(F.col("first").isNull(), "response").otherwise("revisit").alias("record_type"),
        name(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.when(F.col("first").isNotNull(), name(F.col("first"))).alias("refers_to"),
        "payload",
    )


def archived(pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> str:
    """Write `pages` as archives and return their folder: `path`, or a new one in the shared folder."""
    spark = pages.sparkSession
    register(spark)
    path = path or f"{shared_folder(spark)}/warc"
    records(pages, least_bytes).write.format("warc").mode("append").save(path)
    return path


def page_number(name: str) -> F.Column:
    """The page id in a record id, null where it has none."""
    return F.expr(f"try_cast(regexp_extract({name}, '^<urn:page:(-?[0-9]+)>$', 1) AS BIGINT)")

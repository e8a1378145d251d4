"""WARC archives as a Spark data source, and pages written to them without repeating equal payloads.

``register(spark)`` makes the format ``warc`` known. Reading lists the files on the driver and deals them to
partitions by size; a file is the unit of work. Filters on columns that come from a record's headers are pushed
into the source: a record's headers are parsed first, and what fails a filter is skipped, its payload neither
inflated nor decoded where the member tells its length, and inflated without being kept where it does not. With
the option ``payload`` ``false`` no payload is decoded at all.

Writing puts each record in a gzip member of its own, whose extra field holds the member's length, and begins a
new file when one is full, so files stay of a size that a task can read. Only files that the job's manifest
names are read, so what a lost or repeated task left behind is not seen, and a folder can be appended to.

Records are ``response`` (an HTTP head and the payload), ``revisit`` (the HTTP head of a payload that another
record holds), or any other type (the payload alone). Null payloads are empty, null headers are left out and
read back as null. Line breaks and other control characters in header values are written as ``%XX``. Files that
are cut off or are no WARC files raise an error that names the place. An empty table gives an archive without files
and no rows. Extra columns are refused by the writer, as a record has no place for them; ``archive_pages`` ignores them.
"""

from __future__ import annotations

import base64
import json
import operator
import sys
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

READ = (
    "record_id string, record_type string, date string, target_uri string, refers_to string, content_type string, "
    "content_length long, payload_digest string, payload_length long, headers map<string,string>, payload binary, "
    "file string, offset long"
)
WRITE = "record_id string, record_type string, date string, target_uri string, refers_to string, payload_digest string, payload binary, payload_length long"
COLUMNS = [c.split()[0] for c in READ.split(", ")]
# Columns of the headers, which filters can be pushed to.
HEADS = ("record_id", "record_type", "date", "target_uri", "refers_to", "content_type", "content_length", "payload_digest", "payload_length")

# Bytes of files for a partition, of a file before the next begins, and of payloads in a batch.
SPLIT_BYTES = 128 << 20
FILE_BYTES = 256 << 20
BATCH_BYTES = 4 << 20
CHUNK = 1 << 16
LEVEL = 3
# A payload shorter than this is written again rather than referred to.
LEAST_REVISIT = 1000

# Names and forms of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype=response"
MANIFEST = "_manifest-"


class _Plain:
    """The bytes of a file that is not compressed; skipping costs nothing."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.size, self.at = file, file.size(), 0
        self.buffer = b""

    def start(self) -> int:
        return self.at

    def fill(self) -> bool:
        more = self.file.read_at(min(CHUNK, self.size - self.at - len(self.buffer)), self.at + len(self.buffer))
        self.buffer += more
        return bool(more)

    def take(self, n: int) -> bytes:
        if n > len(self.buffer):
            missing = n - len(self.buffer)
            self.buffer += self.file.read_at(min(missing, self.size - self.at - len(self.buffer)), self.at + len(self.buffer))
        out, self.buffer = self.buffer[:n], self.buffer[n:]
        self.at += len(out)
        return out

    def skip(self, n: int) -> None:
        if self.at + n > self.size:
            raise ValueError("the file ends inside a record")
        self.buffer = self.buffer[n:]
        self.at += n


class _Gzip:
    """The inflated bytes of a file of gzip members; a rest of a member of known length is not inflated."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.size, self.next = file, file.size(), 0
        self.ahead, self.ahead_at = b"", 0
        self.buffer = b""
        self.inflate = None
        self.member = self.begun = 0
        self.length: int | None = None
        self.alone = False

    def start(self) -> int:
        """Where the member of what comes next begins."""
        if not self.buffer:
            self.fill()
        self.alone = bool(self.buffer) and not self.begun and self.length is not None
        return self.member

    def _bytes(self, n: int) -> bytes:
        """Up to ``n`` compressed bytes from the next place on, by way of one block read ahead."""
        inside = self.next - self.ahead_at
        if not 0 <= inside <= len(self.ahead) - min(n, self.size - self.next):
            self.ahead, self.ahead_at, inside = self.file.read_at(min(CHUNK, self.size - self.next), self.next), self.next, 0
        return self.ahead[inside : inside + n]

    def _open(self) -> bool:
        if self.next >= self.size:
            return False
        self.member = self.next
        head = self._bytes(24)
        if head[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at {self.member}")
        own = len(head) == 24 and head[3] == 4 and head[10:16] == b"\x0c\x00dl\x08\x00"
        self.length = int.from_bytes(head[16:24], "little") if own else None
        self.inflate = zlib.decompressobj(31)
        self.begun = 0
        return True

    def fill(self) -> bool:
        while True:
            if (self.inflate is None or self.inflate.eof) and not self._open():
                return False
            pending = self.inflate.unconsumed_tail
            if not pending:
                pending = self._bytes(min(CHUNK, self.size - self.next) >> 2 or self.size - self.next)
                self.next += len(pending)
            if not pending:
                raise ValueError("the file ends inside a gzip member")
            more = self.inflate.decompress(pending, 1 << 20)
            if self.inflate.eof:
                self.next -= len(self.inflate.unused_data)
            self.buffer += more
            if more:
                return True

    def take(self, n: int) -> bytes:
        parts = []
        while n:
            if not self.buffer and not self.fill():
                break
            out, self.buffer = self.buffer[:n], self.buffer[n:]
            self.begun += len(out)
            parts.append(out)
            n -= len(out)
        return b"".join(parts)

    def skip(self, n: int) -> None:
        if self.alone:
            # A member of this writer holds one record: go to the next.
            self.next = self.member + self.length
            if self.next > self.size:
                raise ValueError("the file ends inside a gzip member")
            self.buffer, self.inflate = b"", None
            return
        while n:
            out = len(self.take(min(n, 1 << 20)))
            if not out:
                raise ValueError("the file ends inside a record")
            n -= out


def _head(source: _Plain | _Gzip, limit: int = 1 << 20) -> bytes:
    """The bytes up to and with the next empty line."""
    while True:
        end = source.buffer.find(b"\r\n\r\n")
        if end >= 0:
            return source.take(end + 4)
        if len(source.buffer) > limit or not source.fill():
            raise ValueError("a record's headers do not end")


def _headers(head: bytes) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            name, value = name.decode("utf-8", "replace").strip(), value.decode("utf-8", "replace").strip()
            found[name] = f"{found[name]}, {value}" if name in found else value
    return found


def _bare(value: str | None) -> str | None:
    return value[1:-1] if value and value.startswith("<") and value.endswith(">") else value


def _hex(digest: str | None) -> str | None:
    """A SHA-1 in base 32 as lower-case hex digits; other digests as they are."""
    if digest and digest[:5].lower() == "sha1:" and len(digest) == 37:
        return base64.b32decode(digest[5:].upper()).hex()
    return digest


def records(source: _Plain | _Gzip, wanted, decode: bool) -> Iterator[dict]:
    """The records whose headers pass ``wanted``; headers are parsed first, payloads only if asked for."""
    while True:
        offset = source.start()
        if not source.buffer and not source.fill():
            return
        head = _head(source)
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {offset}")
        headers = _headers(head)
        lower = {name.lower(): value for name, value in headers.items()}
        length = int(lower["content-length"])
        left = length
        kind = lower.get("content-type")
        size = length
        http = b""
        if kind and kind.lower().startswith("application/http") and length:
            http = _head(source, max(length, 1))
            left -= len(http)
            size = left
            if lower.get("warc-type") == "revisit":
                of_http = {name.lower(): value for name, value in _headers(http).items()}
                size = int(of_http["content-length"]) if of_http.get("content-length", "").isdigit() else None
        row = {
            "record_id": _bare(lower.get("warc-record-id")),
            "record_type": lower.get("warc-type"),
            "date": lower.get("warc-date"),
            "target_uri": lower.get("warc-target-uri"),
            "refers_to": _bare(lower.get("warc-refers-to")),
            "content_type": kind,
            "content_length": length,
            "payload_digest": _hex(lower.get("warc-payload-digest")),
            "payload_length": size,
            "headers": headers,
            "payload": None,
            "offset": offset,
        }
        if wanted(row):
            if decode:
                row["payload"] = source.take(left)
                if len(row["payload"]) < left:
                    raise ValueError("the file ends inside a record")
                source.take(4)
            else:
                source.skip(left + 4)
            yield row
        else:
            source.skip(left + 4)


def _tests(filters: list[Filter]):
    """One test of a record's header columns for all filters. Nulls fail, as they do in SQL."""

    def one(f: Filter):
        if isinstance(f, Not):
            inside, name = one(f.child), f.child.attribute[0]
            return lambda row: row[name] is not None and not inside(row)
        name = f.attribute[0]
        if isinstance(f, IsNull):
            return lambda row: row[name] is None
        if isinstance(f, IsNotNull):
            return lambda row: row[name] is not None
        if isinstance(f, EqualNullSafe):
            return lambda row: row[name] == f.value
        if isinstance(f, In):
            values = set(f.value)
            return lambda row: row[name] is not None and row[name] in values
        compare = next(c for kind, c in COMPARE.items() if isinstance(f, kind))
        return lambda row: row[name] is not None and compare(row[name], f.value)

    tests = [one(f) for f in filters]
    return lambda row: all(test(row) for test in tests)


COMPARE = {
    EqualTo: operator.eq,
    GreaterThan: operator.gt,
    GreaterThanOrEqual: operator.ge,
    LessThan: operator.lt,
    LessThanOrEqual: operator.le,
    StringStartsWith: str.startswith,
    StringEndsWith: str.endswith,
    StringContains: operator.contains,
}
# ``<``, ``<=``, ``>`` and ``>=`` of texts are compared by code point here and by byte in Spark: the same order.
KNOWN = (*COMPARE, In, IsNull, IsNotNull, EqualNullSafe)


def _pushable(f: Filter) -> bool:
    if isinstance(f, Not):
        return isinstance(f.child, (EqualTo, In, StringStartsWith, StringEndsWith, StringContains)) and _pushable(f.child)
    if not isinstance(f, KNOWN) or len(f.attribute) != 1 or f.attribute[0] not in HEADS:
        return False
    # Comparisons with null are left to Spark.
    return not (isinstance(f, In) and None in f.value or isinstance(f, tuple(COMPARE)) and f.value is None)


def _store(path: str):
    """The file system of a path and the path within it."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def archive_files(path: str) -> list[tuple[str, int]]:
    """Names and sizes of an archive's files: those the manifests name, else all that look like archives."""
    from pyarrow import fs

    store, folder = _store(path)
    own = store.get_file_info(folder)
    if own.type == fs.FileType.File:
        return [(own.path, own.size)]
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    manifests = [f.path for f in found if f.base_name.startswith(MANIFEST)]
    if not manifests:
        return sorted((f.path, f.size) for f in found if f.is_file and f.base_name.endswith((".warc", ".warc.gz")))
    named = []
    for manifest in manifests:
        with store.open_input_stream(manifest) as stream:
            named += [(f"{folder.rstrip('/')}/{name}", size) for name, size in json.loads(stream.read())]
    return sorted(named)


@dataclass
class Files(InputPartition):
    names: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.decode = options.get("payload", "true").lower() != "false"
        self.split = int(options.get("splitbytes", options.get("splitBytes", SPLIT_BYTES)))
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if _pushable(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Files]:
        parts: list[Files] = []
        room = 0
        for name, size in archive_files(self.path):
            if not parts or size > room:
                parts.append(Files([]))
                room = self.split
            parts[-1].names.append(name)
            room -= size
        return parts or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.path)
        wanted = _tests(self.filters)
        held, size = [], 0
        for name in partition.names:
            with store.open_input_file(name) as file:
                source = _Gzip(file) if name.endswith(".gz") else _Plain(file)
                try:
                    for row in records(source, wanted, self.decode):
                        held.append(row | {"file": name.rsplit("/", 1)[-1]})
                        size += len(row["payload"] or b"") + 500
                        if size >= BATCH_BYTES:
                            yield _batch(held)
                            held, size = [], 0
                except (ValueError, KeyError, zlib.error) as error:
                    raise ValueError(f"{name}: {error}") from error
        if held:
            yield _batch(held)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"content_length": pa.int64(), "payload_length": pa.int64(), "offset": pa.int64(), "payload": pa.binary()}
    kinds["headers"] = pa.map_(pa.string(), pa.string())
    columns = []
    for name in COLUMNS:
        values = [list(r["headers"].items()) if name == "headers" else r[name] for r in rows]
        columns.append(pa.array(values, kinds.get(name, pa.string())))
    return pa.RecordBatch.from_arrays(columns, names=COLUMNS)


def _line(name: str, value: str | None) -> str:
    if value is None:
        return ""
    return f"{name}: " + "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value) + "\r\n"


def record(row: dict) -> bytes:
    """One record's bytes, see ``WRITE``."""
    payload = row["payload"] or b""
    kind = row["record_type"]
    block, content = payload, "application/octet-stream"
    if kind in ("response", "revisit"):
        content = HTTP
        size = len(payload) if row["payload_length"] is None else row["payload_length"]
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
        block += payload if kind == "response" else b""
    digest = row["payload_digest"] and "sha1:" + base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    bare = lambda v: None if v is None else f"<{v}>"
    head = "".join(
        _line(name, value)
        for name, value in (
            ("WARC-Type", kind),
            ("WARC-Record-ID", bare(row["record_id"])),
            ("WARC-Date", row["date"]),
            ("WARC-Target-URI", row["target_uri"]),
            ("WARC-Payload-Digest", digest),
            ("WARC-Profile", PROFILE if kind == "revisit" else None),
            ("WARC-Refers-To", bare(row["refers_to"])),
            ("Content-Type", content),
            ("Content-Length", str(len(block))),
        )
    )
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member whose extra field ``dl`` holds its own length."""
    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    length = 24 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x0c\0dl\x08\0" + length.to_bytes(8, "little")
    return head + body + zlib.crc32(data).to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little")


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.full = int(options.get("filebytes", options.get("fileBytes", FILE_BYTES)))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, folder = _store(self.path)
        store.create_dir(folder, recursive=True)
        files: list[tuple[str, int]] = []
        stream, size = None, 0
        try:
            for row in (r for batch in iterator for i in range(0, batch.num_rows, 64) for r in batch.slice(i, 64).to_pylist()):
                if stream is None:
                    # No name is used twice, so a repeated task never touches another's files.
                    name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                    stream = store.open_output_stream(f"{folder}/{name}", compression=None)
                data = member(record(row))
                stream.write(data)
                size += len(data)
                if size >= self.full:
                    stream.close()
                    files.append((name, size))
                    stream = None
        finally:
            if stream is not None:
                stream.close()
        if stream is not None:
            files.append((name, size))
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        """Name the files of the tasks that count in one manifest, which is what makes them readable."""
        from pyarrow import fs

        store, folder = _store(self.path)
        store.create_dir(folder, recursive=True)
        former = store.get_file_info(fs.FileSelector(folder)) if self.overwrite else []
        listed = [f for m in messages if m is not None for f in m.files]
        with store.open_output_stream(f"{folder}/{MANIFEST}{uuid.uuid4().hex}.json") as stream:
            stream.write(json.dumps(listed).encode())
        kept = {name for name, _ in listed}
        for f in former:
            if f.is_file and f.base_name not in kept:
                store.delete_file(f.path)

    def abort(self, messages: list[Written | None]) -> None:
        store, folder = _store(self.path)
        for message in messages:
            for name, _ in message.files if message is not None else []:
                store.delete_file(f"{folder}/{name}")


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)`` and ``df.write.format("warc").mode("append").save(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        names = [c.split()[0] for c in WRITE.split(", ")]
        if schema.fieldNames() != names:
            raise ValueError(f"records have the columns {names}, found {schema.fieldNames()}")
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to a session. Spark sends the classes whole, so workers need not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def write_warc(rows: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Append records, see ``WRITE``, to an archive."""
    register(rows.sparkSession)
    rows.write.format("warc").option("fileBytes", file_bytes).mode("append").save(path)


def page_records(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """A record for each row of (page_id, url, html); one row holds each larger payload, the others refer to it.

    Of rows with equal payloads of at least ``least`` bytes the one with the largest page_id is the response;
    all others revisit it. Rows that share that page_id are responses all. Rows without page_id refer to it as well,
    and are responses where none has one.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha1("payload"), "payload_length": F.octet_length("payload").cast("long")})
    key = ["payload_digest", "payload_length"]
    # Only keys leave their tasks here, and only those of payloads that come more than once meet the rows again.
    times = rows.where(F.col("payload_length") >= least).groupBy(*key)
    shared = times.agg(F.max("page_id").alias("latest"), F.count("*").alias("times")).where("times > 1").drop("times")
    linked = rows.join(shared, key, "left")
    again = F.col("latest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("latest"))
    return linked.select(
        _urn(F.col("page_id")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.lit("2025-01-01T00:00:00Z").alias("date"),
        F.col("url").alias("target_uri"),
        F.when(again, _urn(F.col("latest"))).alias("refers_to"),
        "payload_digest",
        F.when(~again, F.col("payload")).alias("payload"),
        "payload_length",
    )


def _urn(page_id):
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")))


def page_id(urn):
    """The page a record id names, null where it names none."""
    return F.nullif(F.regexp_extract(urn, "^urn:page:(-?[0-9]+)$", 1), F.lit("")).cast("long")


def archive_pages(pages: DataFrame, path: str, least: int = LEAST_REVISIT) -> DataFrame:
    """Write a record per page to an archive and return its records as they are read back."""
    write_warc(page_records(pages, least), path)
    return read_warc(pages.sparkSession, path)

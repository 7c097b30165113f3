"""WARC archives as a Spark data source.

``spark.dataSource.register(WarcSource)``, then ``format("warc")`` reads and writes. A record is a
gzip member of its own whose extra field names its length, so a reader that has seen the headers and
does not want the record goes on to the next one without inflating the payload. Predicates on the
record type and the other header columns are evaluated on the headers alone.

Archives of others are read too: plain ones, and compressed ones with any number of records in a
member. Zeros behind the last record are padding. An archive that ends inside a record or member, or
holds anything that is no record, is damaged: reading it fails with its name and place, or, with the
option ``on_damage`` set to ``tell``, gives the records before the damage and then a row whose
``damage`` says what is wrong.

Paths are those of Arrow's file systems: local ones, ``file``, ``hdfs``, ``viewfs``, ``s3`` (also by the names
``s3a`` and ``s3n``), ``gs``, ``abfs`` and ``abfss``. Any other scheme is refused.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
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

#: What a reader returns. ``payload`` is null for revisits and where it is not asked for.
READ_SCHEMA = (
    "record_id string, record_type string, target_uri string, refers_to string, "
    "payload_digest string, payload_length long, payload binary, damage string"
)
#: What a writer takes. A row with ``refers_to`` becomes a revisit, and its payload is not needed.
WRITE_COLUMNS = (
    "record_id", "target_uri", "refers_to", "payload_digest", "payload_length", "payload"
)
_ARROW = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
    ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_length", pa.int64()),
    ("payload", pa.binary()), ("damage", pa.string()),
])

#: Fixed values of the archive format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LENGTH_HEADER = "X-Payload-Length"

#: A file is closed once it has so many bytes, and a read partition gets about as many.
FILE_BYTES = 64 << 20
_BATCH_BYTES = 8 << 20
_PEEK = 4096


def digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1 of a payload."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


#: Schemes by which Spark's file systems are named and Arrow's are not.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}
_KNOWN_SCHEMES = ("file", "hdfs", "viewfs", "s3", "gs", "abfs", "abfss")


def _filesystem(path: str) -> tuple[arrow_fs.FileSystem, str]:
    scheme, rest = path.split(":", 1) if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:/", path) else ("", path)
    scheme = _SCHEMES.get(scheme, scheme)
    if scheme and scheme not in _KNOWN_SCHEMES:
        raise ValueError(f"archives cannot be on {scheme}: ({path}); known are {', '.join(_KNOWN_SCHEMES)}")
    return arrow_fs.FileSystem.from_uri(f"{scheme}:{rest}" if scheme else path)


def _line(value) -> str:
    """A header value on one line."""
    return re.sub(r"[\r\n]+", " ", str(value))


def _member(record: bytes, level: int) -> bytes:
    """A record as a gzip member that tells its own length and that of its content."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    length = 24 + len(body) + 8
    told = (length, len(record)) if max(length, len(record)) < 1 << 32 else (0, 0)
    return b"".join((
        b"\x1f\x8b\x08\x04\0\0\0\0\0\xff", struct.pack("<H2sHII", 12, b"sl", 8, *told), body,
        struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF),
    ))


def record_bytes(row: dict, date: str) -> bytes:
    """One response or revisit record."""
    revisit = row["refers_to"] is not None
    payload = b"" if revisit else row["payload"] or b""
    known = row["payload_digest"] if revisit else digest(payload)
    length = row["payload_length"] if revisit else len(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n"
    block = http.encode() + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{_line(row['record_id'])}>"),
        ("WARC-Date", date),
    ]
    if row["target_uri"] is not None:
        headers.append(("WARC-Target-URI", _line(row["target_uri"])))
    if revisit:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{_line(row['refers_to'])}>")]
    headers += [
        ("WARC-Payload-Digest", f"sha1:{known}"), (LENGTH_HEADER, length),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block)),
    ]
    head = VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


class _Written(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    """Writes files of whole records. A file counts once the commit has listed it, so files of
    attempts that were lost or repeated are never read."""

    def __init__(self, folder: str, level: int, date: str):
        self.folder, self.level, self.date = folder, level, date
        system, path = _filesystem(folder)
        system.create_dir(path, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        system, folder = _filesystem(self.folder)
        files, out, size = [], None, 0
        for batch in iterator:
            names = batch.schema.names
            for i in range(batch.num_rows):
                row = {n: batch.column(k)[i].as_py() for k, n in enumerate(names)}
                if out is None:
                    files.append(f"{uuid.uuid4().hex}.warc.gz")
                    out, size = system.open_output_stream(f"{folder}/{files[-1]}", compression=None), 0
                member = _member(record_bytes(row, self.date), self.level)
                out.write(member)
                size += len(member)
                if size >= FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return _Written(files)

    def commit(self, messages: list) -> None:
        system, folder = _filesystem(self.folder)
        files = [name for m in messages if m is not None for name in m.files]
        with system.open_output_stream(f"{folder}/_committed-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list) -> None:
        system, folder = _filesystem(self.folder)
        for message in messages:
            for name in message.files if message is not None else ():
                system.delete_file(f"{folder}/{name}")


class Damage(ValueError):
    """What is wrong with an archive, and where."""


class _Bytes:
    """The bytes of an archive that is not compressed, from a place on."""

    def __init__(self, file):
        self.file, self.at, self.content = file, 0, bytearray()

    def more(self) -> bool:
        block = self.file.read(1 << 16)
        self.content += block
        return bool(block)

    def take(self, length: int, wanted: bool) -> bytes:
        """Go on by so many bytes, and return them where they are wanted."""
        parts, left = [], length
        while left:
            if not self.content and not self.more():
                raise Damage(f"ends {left} bytes before the end of a record")
            own = min(left, len(self.content))
            if wanted:
                parts.append(bytes(self.content[:own]))
            del self.content[:own]
            self.at += own
            left -= own
        return b"".join(parts)

    def head(self) -> bytes | None:
        """The head of the next record without the empty line behind it; none at the end."""
        while True:
            lead = len(self.content) - len(self.content.lstrip(b"\r\n\0"))
            del self.content[:lead]
            self.at += lead
            if self.content or not self.more():
                break
        if not self.content:
            return None
        looked = 0
        while (end := self.content.find(b"\r\n\r\n", looked)) < 0:
            looked = max(0, len(self.content) - 3)
            if not self.content.startswith(b"WARC/"[:len(self.content)]):
                raise Damage(f"no record: {bytes(self.content[:40])!r}")
            if not self.more():
                raise Damage("ends inside the head of a record")
        return self.take(end + 4, True)[:-4]

    def skip_member(self, taken: int, length: int) -> bool:
        return False


class _Members(_Bytes):
    """The inflated bytes of an archive of gzip members."""

    def __init__(self, file):
        super().__init__(file)
        self.size = file.seek(0, io.SEEK_END)
        file.seek(0)
        self.raw, self.place, self.inflater, self.fresh = b"", 0, None, True
        #: Of the member begun last: where it begins, in the file and in the content, and its lengths if told.
        self.begin = self.first = self.told = self.length = 0

    def more(self) -> bool:
        while True:
            if self.inflater is None and not self._begin():
                return False
            if not self.raw:
                self.raw = self.file.read(_PEEK if self.fresh else 1 << 16)
                self.fresh = False
                self.place += len(self.raw)
                if not self.raw:
                    raise Damage("ends inside a gzip member")
            try:
                block = self.inflater.decompress(self.raw)
            except zlib.error as error:
                raise Damage(f"gzip member at byte {self.begin}: {error}") from error
            self.raw = self.inflater.unused_data if self.inflater.eof else b""
            if self.inflater.eof:
                self.inflater = None
            if block:
                self.content += block
                return True

    def _begin(self) -> bool:
        """Begin the next member; zeros before it are padding."""
        self.raw = self.raw.lstrip(b"\0")
        while len(self.raw) < 20:
            block = self.file.read(_PEEK)
            if not block:
                break
            self.place += len(block)
            self.raw = (self.raw + block).lstrip(b"\0")
        if not self.raw:
            return False
        self.begin, self.told = self.place - len(self.raw), 0
        if not self.raw.startswith(b"\x1f\x8b"[:len(self.raw)]):
            raise Damage(f"no gzip member at byte {self.begin}")
        if self.raw[3:4] == b"\x04" and self.raw[12:14] == b"sl" and len(self.raw) >= 24:
            self.told, self.length = struct.unpack("<II", self.raw[16:24])
        self.inflater, self.first, self.fresh = zlib.decompressobj(31), self.at + len(self.content), True
        return True

    def skip_member(self, taken: int, length: int) -> bool:
        """Go to the next member where this one holds just this record and tells its own length."""
        if not self.told or self.first + taken != self.at or self.length != taken + length + 4:
            return False
        if self.size < self.begin + self.told:
            raise Damage("ends inside a gzip member")
        self.file.seek(self.begin + self.told)
        self.place, self.raw, self.inflater = self.begin + self.told, b"", None
        self.content.clear()
        self.at = self.first + self.length
        return True


def _parse(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise Damage(f"no record: {lines[0][:40]!r}")
    return {
        name.strip().lower(): value.strip()
        for name, _, value in (line.partition(":") for line in lines[1:])
    }


def _number(value: str | None) -> int | None:
    """A length; none where the header is missing or no number that a column holds."""
    return int(value) if value and re.fullmatch("[0-9]{1,18}", value) else None


def _columns(headers: dict[str, str]) -> dict:
    """The header columns of a record."""
    bare = lambda v: v.strip("<>") if v is not None else None
    found = headers.get("warc-payload-digest")
    return {
        "record_id": bare(headers.get("warc-record-id")),
        "record_type": headers.get("warc-type"),
        "target_uri": headers.get("warc-target-uri"),
        "refers_to": bare(headers.get("warc-refers-to")),
        "payload_digest": found.rpartition(":")[2] if found else None,
        "payload_length": _number(headers.get(LENGTH_HEADER.lower())),
    }


def _holds(condition: Filter, row: dict) -> bool | None:
    """Whether a predicate holds on the header columns, null where SQL's would be null."""
    if isinstance(condition, Not):
        inner = _holds(condition.child, row)
        return None if inner is None else not inner
    value = row[condition.attribute[0]]
    if isinstance(condition, IsNull):
        return value is None
    if isinstance(condition, IsNotNull):
        return value is not None
    if value is None or getattr(condition, "value", None) is None:
        return None
    if isinstance(condition, EqualTo):
        return value == condition.value
    if isinstance(condition, In):
        return True if value in condition.value else None if None in condition.value else False
    if isinstance(condition, GreaterThan):
        return value > condition.value
    if isinstance(condition, GreaterThanOrEqual):
        return value >= condition.value
    if isinstance(condition, LessThan):
        return value < condition.value
    if isinstance(condition, LessThanOrEqual):
        return value <= condition.value
    if isinstance(condition, StringStartsWith):
        return value.startswith(condition.value)
    if isinstance(condition, StringEndsWith):
        return value.endswith(condition.value)
    return condition.value in value


_PUSHED = (
    EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, IsNull, IsNotNull,
    StringStartsWith, StringEndsWith, StringContains,
)


class _Files(InputPartition):
    def __init__(self, names: list[str]):
        super().__init__(names)


class WarcReader(DataSourceReader):
    def __init__(self, folder: str, payloads: bool, partition_bytes: int, tell: bool = False):
        self.folder, self.payloads, self.partition_bytes = folder, payloads, partition_bytes
        self.tell = tell
        self.conditions: list[Filter] = []

    def pushFilters(self, filters: list[Filter]):
        """Keep predicates on header columns; the payload and its length where a foreign archive
        does not tell it in a header are Spark's to test."""
        for condition in filters:
            plain = condition.child if isinstance(condition, Not) else condition
            if isinstance(plain, _PUSHED) and plain.attribute[0] not in (
                "payload", "payload_length", "damage"
            ):
                self.conditions.append(condition)
            else:
                yield condition

    def partitions(self) -> list[_Files]:
        """Committed files, or all archives of a folder that no commit describes, largest first,
        in partitions of about equal bytes."""
        system, folder = _filesystem(self.folder)
        found = system.get_file_info(arrow_fs.FileSelector(folder, recursive=True))
        sizes = {f.path: f.size for f in found if f.is_file}
        notes = [p for p in sizes if re.search(r"/_committed-[0-9a-f]+\.json$", p)]
        if notes:
            listed = set()
            for note in notes:
                with system.open_input_stream(note) as stream:
                    listed |= {f"{folder}/{n}" for n in json.loads(stream.read())}
        else:
            listed = {p for p in sizes if p.endswith((".warc", ".warc.gz"))}
        groups, filled = [[]], 0
        for path in sorted(listed, key=lambda p: (-sizes[p], p)):
            if groups[-1] and filled + sizes[path] > self.partition_bytes:
                groups.append([])
                filled = 0
            groups[-1].append(path)
            filled += sizes[path]
        return [_Files(g) for g in groups]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for path in partition.value:
            for row in self._records(path):
                rows.append(row)
                held += len(row["payload"] or b"") + 500
                if held >= _BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                    rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    def _records(self, path: str) -> Iterator[dict]:
        system, _ = _filesystem(self.folder)
        with system.open_input_file(path) as source:
            source = io.BufferedReader(source, 1 << 16)
            archive = (_Members if path.endswith(".gz") else _Bytes)(source)
            try:
                while (head := archive.head()) is not None:
                    yield from self._record(archive, head)
            except Damage as damage:
                told = f"{path}: {damage}, behind {archive.at} bytes of content"
                if not self.tell:
                    raise Damage(told) from damage
                yield {"damage": told, "payload": None}

    def _record(self, archive: _Bytes, head: bytes) -> Iterator[dict]:
        headers = _parse(head)
        length = _number(headers.get("content-length"))
        if length is None:
            raise Damage(f"a record's length is no number: {headers.get('content-length')!r}")
        row = _columns(headers) | {"payload": None}
        holds = all(_holds(c, row) for c in self.conditions)
        wanted = holds and row["record_type"] != "revisit" and (self.payloads or row["payload_length"] is None)
        if not wanted and archive.skip_member(len(head) + 4, length):
            if holds:
                yield row
            return
        block = archive.take(length, wanted)
        if wanted:
            if headers.get("content-type", "").startswith("application/http"):
                block = block.partition(b"\r\n\r\n")[2]
            if row["payload_length"] is None:
                row["payload_length"] = len(block)
            if self.payloads:
                row["payload"] = block
        if archive.take(4, True) != b"\r\n\r\n":
            raise Damage("a record is longer than its length says")
        if holds:
            yield row


class WarcSource(DataSource):
    """Format ``warc``. Options: ``path``, a folder that executors share; reading: ``payload``
    (``false`` leaves payloads out), ``partition_bytes``, ``on_damage`` (``raise`` or ``tell``); writing: ``level`` of compression and
    ``date`` of the records."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(
            self.options["path"],
            self.options.get("payload", "true").lower() == "true",
            int(self.options.get("partition_bytes", FILE_BYTES)),
            self.options.get("on_damage", "raise").lower() == "tell",
        )

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only added to; choose mode append")
        return WarcWriter(
            self.options["path"], int(self.options.get("level", 6)),
            self.options.get("date", "1970-01-01T00:00:00Z"),
        )


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read(spark: SparkSession, folder: str, payload: bool = True, on_damage: str = "raise") -> DataFrame:
    """The records of a folder of archives."""
    register(spark)
    options = {"payload": str(payload).lower(), "on_damage": on_damage}
    return spark.read.format("warc").options(**options).load(folder)


def read_split(spark: SparkSession, folder: str) -> DataFrame:
    """The records, responses with payloads and all others by their headers alone.

    Both predicates go to the source, which skips the payloads of what it does not return.
    """
    is_response = F.col("record_type") == "response"
    others = F.col("record_type").isNull() | ~is_response
    return read(spark, folder).where(is_response).unionByName(read(spark, folder, payload=False).where(others))


def base32(digits: Column) -> Column:
    """Upper-case base32 of 40 hexadecimal digits: each five of them are four of base32."""
    quads = []
    for i in range(1, 41, 5):
        short = F.lpad(F.conv(F.substring(digits, i, 5), 16, 32), 4, "0")
        quads.append(F.translate(F.upper(short), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"))
    return F.concat(*quads)


def write_pages(pages: DataFrame, folder: str, least: int = 0) -> None:
    """Write a record for each row of ``page_id``, ``url``, ``html``.

    Of rows whose payloads are equal and have at least ``least`` bytes, the one with the largest
    page_id is written whole, the others as revisits of it. A null html is empty. A null page_id
    counts as smaller than any other; rows that share the largest page_id of a payload, or have no
    id at all, are all written whole. A null url is left out of the headers. Equal payloads may be
    any share of all rows: only their digest is grouped, and combined before the shuffle.
    """
    register(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("long"), "url",
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    ).withColumns({"sha1": F.sha1("payload"), "bytes": F.octet_length("payload").cast("long")})
    last = rows.where(F.col("bytes") >= least).groupBy("sha1").agg(F.max("page_id").alias("last"))
    joined = rows.join(last, "sha1", "left").withColumn(
        "revisits", F.col("last").isNotNull() & (F.coalesce(F.col("page_id") < F.col("last"), F.lit(True)))
    )
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("none")))
    records = joined.select(
        urn(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.when(F.col("revisits"), urn(F.col("last"))).alias("refers_to"),
        base32(F.col("sha1")).alias("payload_digest"),
        F.col("bytes").alias("payload_length"),
        F.when(~F.col("revisits"), F.col("payload")).alias("payload"),
    )
    records.write.format("warc").mode("append").option("path", folder).save()


def page_records(records: DataFrame) -> DataFrame:
    """What the archives say about pages: ids from the records' names."""
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^urn:page:(-?[0-9]+)$', 1) AS bigint)")
    return records.select(
        number("record_id").alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("long"), "payload_length").alias("payload_bytes"),
        "payload_digest", "record_type", number("refers_to").alias("refers_to"),
    )

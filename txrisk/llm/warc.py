"""Legacy ARC archives, and their conversion to WARC.

An ARC file starts with a version block; each record is a header line, whose fields depend on the version, and as many
bytes as the line declares. A converted record gets what WARC asks for and ARC doesn't have: an identifier, a type, a time with zone, and
digests of block and payload. Of records with equal payloads one stays a response and the others refer to it.

Archives are gzip files that Spark's text sink writes and its text source reads, so they can lie in any store
that Spark knows. A file of any size is read as a stream: the source cuts it at blank lines, which heads end with, and a
task puts the pieces together again, so that it holds a record and some pieces at a time, never the file.
"""

from __future__ import annotations

import base64
import hashlib
import io
import os
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

# The fields of a record's header line by version.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename",
        "Archive-length"],
}
FETCHED = "19970214093000"
LEAST_REVISIT = 1000
BYTES_AT_ONCE = 4_000_000
CUT = b"\r\n\r\n"
KEY, REFERS = "X-Record-Key", "X-Refers-To-Key"
PARSED = ("file string, offset long, version int, type string, record_id string, date string, uri string, content_type string, "
          "head binary, payload binary, payload_bytes long, payload_sha1 string, key long")


def _write(records: DataFrame, path: str, separator: str) -> None:
    """Byte strings, one after the other, as gzip files."""
    (records.select(F.col("value").cast("string")).write.option("lineSep", separator)
     .option("compression", "gzip").text(path))


def _rows(lists: Iterable[tuple], kinds: list[pa.DataType], names: list[str], size) -> Iterator[pa.RecordBatch]:
    """Record batches of about `BYTES_AT_ONCE`."""
    rows: list[tuple] = []
    held = 0
    for row in lists:
        rows.append(row)
        held += size(row)
        if held > BYTES_AT_ONCE:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def arc_record(version: int, url: str | None, payload: bytes, key: int | None) -> bytes:
    """A response as an ARC record, without the newline after it."""
    keyed = f"{KEY}: {key}\r\n" if key is not None else ""
    head = f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{keyed}Content-Length: {len(payload)}\r\n\r\n".encode()
    values = {"URL": "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "unknown:"), "IP-address": "0.0.0.0",
              "Archive-date": FETCHED, "Content-type": "text/html", "Result-code": "200", "Checksum": "-", "Location": "-",
              "Offset": "-", "Filename": "-", "Archive-length": str(len(head) + len(payload))}
    return " ".join(values[name] for name in ARC_FIELDS[version]).encode() + b"\n" + head + payload


def arc_version_block(version: int) -> bytes:
    block = f"{version} 0 origin\n{' '.join(ARC_FIELDS[version])}\n".encode()
    line = {1: "filedesc://pages.arc 0.0.0.0 {} text/plain {}", 2: "filedesc://pages.arc 0.0.0.0 {} text/plain 200 - - 0 pages.arc {}"}
    return line[version].format(FETCHED, len(block)).encode() + b"\n" + block


def write_arc(pages: DataFrame, path: str, key_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
              version: int = 1) -> None:
    """Pages as ARC files, one a task. Null payloads count as empty."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple]:
            yield (arc_version_block(version),)
            for batch in batches:
                for key, url, payload in zip(*(column.to_pylist() for column in batch.columns)):
                    yield (arc_record(version, url, payload, key),)

        yield from _rows(records(), [pa.binary()], ["value"], lambda row: len(row[0]))

    rows = pages.select(F.col(key_col).cast("long"), F.col(url_col).cast("string"),
                        F.coalesce(F.col(payload_col), F.lit("")).cast("binary"))
    _write(rows.mapInArrow(run, "value binary"), path, "\n")


class Pieces:
    """The bytes of a file from what it holds between blank lines.

    The source drops a blank line at the very end. It is given back to a record that lacks just these bytes, and isn't
    missed between records; so a last record cut short by exactly four bytes isn't noticed.
    """

    def __init__(self, pieces: Iterable[bytes]) -> None:
        self.pieces = iter(pieces)
        self.held, self.at, self.before = next(self.pieces, b""), 0, 0

    def tell(self) -> int:
        return self.before + self.at

    def _more(self, least: int) -> bool:
        """Hold `least` bytes more than are held now, or all there are; whether there were any."""
        found, size = [], 0
        while size < least and (piece := next(self.pieces, None)) is not None:
            found += [CUT, piece]
            size += len(CUT) + len(piece)
        self.held, self.before, self.at = b"".join([self.held[self.at:], *found]), self.tell(), 0
        return size > 0

    def read(self, size: int) -> bytes:
        short = size - (len(self.held) - self.at)
        if short > 0:
            self._more(short)
        found = self.held[self.at:self.at + size]
        self.at += len(found)
        return found + CUT if size - len(found) == len(CUT) else found

    def readline(self) -> bytes:
        while not (end := self.held.find(b"\n", self.at) + 1):
            if not self._more(1):
                end = len(self.held)
                break
        found, self.at = self.held[self.at:end], end
        return found


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(path, piece) of gzip files; a file's pieces lie in one partition, in order."""
    read = spark.read.option("lineSep", CUT.decode()).text(path)
    return read.select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("piece"))


def _streams(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, Pieces]]:
    """File by file, its name and its bytes."""
    rows = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
    for path, pieces in groupby(rows, key=lambda row: row[0]):
        yield os.path.basename(path), Pieces(piece for _, piece in pieces)


@dataclass
class ArcRecord:
    offset: int
    version: int
    fields: dict[str, str]
    body: bytes


def parse_arc(stream: io.BufferedIOBase | Pieces) -> Iterator[ArcRecord]:
    """Records of an ARC stream, the version block first. A record cut short or a line of other fields is an error."""
    version = None
    while line := stream.readline():
        offset = stream.tell() - len(line)
        line = line.rstrip(b"\r\n")
        if not line:
            continue
        text = line.decode("utf-8", "surrogateescape")
        declared = text.rpartition(" ")[2]
        if not declared.isdigit():
            raise ValueError(f"no length in the header line at byte {offset}")
        body = stream.read(int(declared))
        if len(body) < int(declared):
            raise ValueError(f"the record at byte {offset} is cut short")
        if version is None:
            if not text.startswith("filedesc:"):
                raise ValueError("no version block")
            version = int(body.split(b" ", 1)[0])
        names = ARC_FIELDS[version]
        values = text.rsplit(" ", len(names) - 1)
        if len(values) != len(names):
            raise ValueError(f"the header line at byte {offset} has other fields than version {version}")
        yield ArcRecord(offset, version, dict(zip(names, values)), body)


def warc_type(url: str, content_type: str, body: bytes) -> str:
    if url.startswith("filedesc:"):
        return "warcinfo"
    return "response" if body.startswith(b"HTTP/") else "resource"


def warc_date(arc_date: str) -> str:
    """An ARC date of up to 14 digits in the form of WARC; missing digits count as the earliest time."""
    whole = arc_date + "00000101000000"[len(arc_date):]
    return f"{whole[:4]}-{whole[4:6]}-{whole[6:8]}T{whole[8:10]}:{whole[10:12]}:{whole[12:14]}Z"


def _head_value(head: bytes, name: str) -> str | None:
    for line in head.split(b"\r\n")[1:]:
        label, _, value = line.partition(b":")
        if label.strip().lower() == name.lower().encode():
            return value.strip().decode("utf-8", "replace")
    return None


def _number(text: str | None) -> int | None:
    return int(text) if text is not None and text.lstrip("-").isdigit() else None


def read_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of ARC files with what WARC asks for beyond; without `payloads` those are null."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple]:
            for name, stream in _streams(batches):
                for record in parse_arc(stream):
                    url, kind = record.fields["URL"], record.fields["Content-type"]
                    type_ = warc_type(url, kind, record.body)
                    head, mark, payload = record.body.partition(b"\r\n\r\n") if type_ == "response" else (b"", b"", record.body)
                    identity = hashlib.sha1(f"{name}:{record.offset}".encode()).digest()[:16]
                    yield (name, record.offset, record.version, type_, f"urn:uuid:{uuid.UUID(bytes=identity, version=5)}",
                           warc_date(record.fields["Archive-date"]), url.encode("utf-8", "surrogateescape").decode("utf-8", "replace"),
                           kind, head + mark, payload if payloads else None, len(payload), hashlib.sha1(payload).hexdigest(),
                           _number(_head_value(head, KEY)))

        kinds = [pa.string(), pa.int64(), pa.int32(), *[pa.string()] * 5, pa.binary(), pa.binary(), pa.int64(), pa.string(), pa.int64()]
        yield from _rows(records(), kinds, [part.split()[0] for part in PARSED.split(", ")], lambda row: 500 + len(row[9] or b""))

    return _files(spark, path).mapInArrow(run, PARSED)


def revisits(records: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(file, offset, refers_to, refers_key) of responses that repeat the payload of another.

    Of equal payloads of at least `least` bytes the one with the largest key stays; without keys, or of those with
    equal keys, the first by file and place.
    """
    rows = (records.filter((F.col("type") == "response") & (F.col("payload_bytes") >= least))
            .select("file", "offset", "record_id", "key", "payload_sha1", "payload_bytes"))
    best = F.min(F.struct(F.col("key").isNull().alias("none"), (-F.col("key")).alias("least"), "file", "offset", "record_id", "key"))
    groups = (rows.groupBy("payload_sha1", "payload_bytes").agg(best.alias("best"), F.count("*").alias("n"))
              .filter("n > 1").drop("n"))
    joined = rows.join(groups, ["payload_sha1", "payload_bytes"]).filter("record_id != best.record_id")
    return joined.select("file", "offset", F.col("best.record_id").alias("refers_to"), F.col("best.key").alias("refers_key"))


def _digest(sha1_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def warc_record(row: dict) -> bytes:
    """A record, without the two line ends after it."""
    type_, head, payload = row["type"], row["head"] or b"", row["payload"] or b""
    extra = []
    if type_ == "response" and row["refers_to"] is not None:
        type_, payload = "revisit", b""
        if row["refers_key"] is not None:
            head = head[:-2] + f"{REFERS}: {row['refers_key']}\r\n\r\n".encode()
        extra = [("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", f"<{row['refers_to']}>")]
    block = head + payload
    kinds = {"warcinfo": "application/warc-fields", "response": "application/http; msgtype=response",
             "revisit": "application/http; msgtype=response"}
    fields = [("WARC-Type", type_), ("WARC-Record-ID", f"<{row['record_id']}>"), ("WARC-Date", row["date"])]
    if type_ != "warcinfo":
        fields += [("WARC-Target-URI", row["uri"]), ("WARC-Payload-Digest", _digest(row["payload_sha1"]))]
    fields += [("WARC-Block-Digest", _digest(hashlib.sha1(block).hexdigest())), *extra,
               ("Content-Type", kinds.get(type_, row["content_type"])), ("Content-Length", str(len(block)))]
    return ("WARC/1.0\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n").encode() + block


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = LEAST_REVISIT) -> None:
    """The ARC files of a folder as WARC files in another."""
    decided = revisits(read_arc(spark, arc_path, payloads=False), least)
    records = read_arc(spark, arc_path).join(decided, ["file", "offset"], "left")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def all_records() -> Iterator[tuple]:
            for batch in batches:
                for row in batch.to_pylist():
                    yield (warc_record(row),)

        yield from _rows(all_records(), [pa.binary()], ["value"], lambda row: len(row[0]))

    _write(records.mapInArrow(run, "value binary"), warc_path, "\r\n\r\n")


def parse_warc(stream: io.BufferedIOBase | Pieces) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, by lower-case name, and block of each record."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {stream.tell() - len(line)}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        if len(block) < int(fields["content-length"]):
            raise ValueError("a record is cut short")
        yield fields, block


READ = ("type string, record_id string, date string, uri string, refers_to string, key long, refers_key long, payload_bytes long, "
        "payload_sha1 string, intact boolean, payload binary")


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of WARC files, warcinfo records left out.

    Size and digest are those of the full payload, also of revisits, whose own payload is empty; `intact` tells
    whether the block's and, in full records, the payload's bytes have the stated digests.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple]:
            for _, stream in _streams(batches):
                for fields, block in parse_warc(stream):
                    type_ = fields["warc-type"]
                    if type_ == "warcinfo":
                        continue
                    http = type_ in ("response", "revisit")
                    head, _, payload = block.partition(b"\r\n\r\n") if http else (b"", b"", block)
                    stated = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                    intact = fields["warc-block-digest"] == _digest(hashlib.sha1(block).hexdigest())
                    size = len(payload)
                    if type_ == "revisit":
                        size = _number(_head_value(head, "Content-Length"))
                    else:
                        intact = intact and hashlib.sha1(payload).hexdigest() == stated
                    refers = fields.get("warc-refers-to")
                    yield (type_, fields["warc-record-id"].strip("<>"), fields["warc-date"], fields["warc-target-uri"],
                           refers and refers.strip("<>"), _number(_head_value(head, KEY)), _number(_head_value(head, REFERS)),
                           size, stated, intact, payload if payloads else None)

        kinds = [*[pa.string()] * 5, *[pa.int64()] * 3, pa.string(), pa.bool_(), pa.binary()]
        yield from _rows(records(), kinds, [part.split()[0] for part in READ.split(", ")], lambda row: 500 + len(row[10] or b""))

    return _files(spark, path).mapInArrow(run, READ)

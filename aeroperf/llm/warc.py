"""Legacy archives to WARC: write ARC files, convert them, and read WARC files back.

An ARC file begins with a version block; each record is one header line, whose
fields depend on the version, then as many bytes as its last field declares.
The converter gives every record what WARC wants and ARC lacks: a record id
(a UUID of its content, URL and date, so that a retry gives the same), an ISO
timestamp, a type and digests. A record whose payload another one holds
becomes a ``revisit`` of it.

Payloads are never shuffled. Parsing an ARC file gives a narrow row for each
record; responses are chosen from digests by a partial aggregation and a join
of two stored tables, which adaptive execution splits when a digest is hot;
then each ARC file is read once more beside the rows of its own revisits and
written as the WARC file of the same name. Files are dealt over a number of
tasks that follows theirs, as their bytes are not in the shuffle that adaptive
execution sees. Files close at ``max_bytes`` of payload. Every record is a gzip
member of its own.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroperf.llm.hashing import slices
from aeroperf.llm.storage import AtomicFile, list_files, make_folder, open_fs, stored
from aeroperf.llm.workers import tidy

#: The header lines of the two ARC versions.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
ROW_ID, REFERS = "X-Source-Row", "WARC-Refers-To-Source-Row"
INDEX = "file string, position long, row_id long, payload_digest string, payload_bytes long, record_id string, url string, date string"
KINDS = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
#: What a header line holds before its last fields; a URL or a content type may have blanks.
LEFT = re.compile(r"(.*?) (\S+) (\d{4,14})(?: (.*))?", re.DOTALL)


class GzipReader:
    """Bytes of a file of gzip members, read in pieces; ``take`` and ``line`` are all that the formats need."""

    def __init__(self, path: str):
        fs, name = open_fs(path)
        self.f, self.inflate = fs.open_input_stream(name, compression=None), zlib.decompressobj(31)
        self.buf, self.at, self.done = bytearray(), 0, False

    def _more(self) -> bool:
        raw = self.inflate.unused_data
        if raw:
            self.inflate = zlib.decompressobj(31)
        else:
            raw = self.f.read(1 << 18)
            if not raw:
                self.done = True
                return False
            if self.inflate.eof:
                self.inflate = zlib.decompressobj(31)
        if self.at > 1 << 20:
            del self.buf[: self.at]
            self.at = 0
        self.buf += self.inflate.decompress(raw)
        return True

    def take(self, n: int) -> bytes:
        while len(self.buf) - self.at < n and self._more():
            pass
        out = bytes(memoryview(self.buf)[self.at : self.at + n])
        if len(out) < n:
            raise ValueError(f"the archive ends {n - len(out)} bytes early")
        self.at += n
        return out

    def line(self) -> bytes | None:
        """Up to and with the next newline; None at the end."""
        while (end := self.buf.find(b"\n", self.at)) < 0:
            if not self._more():
                rest = bytes(self.buf[self.at :])
                self.at = len(self.buf)
                return rest or None
        out = bytes(self.buf[self.at : end + 1])
        self.at = end + 1
        return out


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(1, wbits=31)
    return z.compress(data) + z.flush()


@dataclass
class ArcRecord:
    fields: dict[str, str]
    content: bytes  # the HTTP head and the payload

    @property
    def split(self) -> tuple[bytes, bytes]:
        head, gap, payload = self.content.partition(b"\r\n\r\n")
        return (head + gap, payload) if gap and head.startswith(b"HTTP/") else (b"", self.content)


def arc_line(version: int, url: str, date: str, mime: str, size: int, ip: str = "0.0.0.0", name: str = "-", digest: str = "-") -> bytes:
    values = (url, ip, date, mime, str(size)) if version == 1 else (url, ip, date, mime, "200", digest, "-", "0", name, str(size))
    return " ".join(values).encode() + b"\n"


def arc_fields(version: int, line: str) -> dict[str, str] | None:
    """Fields of a header line; None where it has too few. The last ones are taken from the right, as a URL and a content type may hold blanks."""
    names, behind = ARC_FIELDS[version], len(ARC_FIELDS[version]) - 4
    values = line.strip().rsplit(maxsplit=behind)
    left = LEFT.fullmatch(values[0]) if len(values) == behind + 1 else None
    return dict(zip(names, (*left.groups(default="-"), *values[1:]))) if left else None


def iso_date(date: str) -> str:
    """An ARC date of up to 14 digits as an ISO timestamp; what it lacks is the earliest."""
    d = date + "00000101000000"[len(date) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def read_arc(path: str) -> Iterator[ArcRecord]:
    """Records of an ARC file of either version, by their declared lengths."""
    f = GzipReader(path)
    first = (f.line() or b"").split()
    if not first or not first[0].startswith(b"filedesc://"):
        raise ValueError(f"{path} is no ARC file")
    block = f.take(int(first[-1]))
    version = int(block.split(None, 1)[0])
    while (line := f.line()) is not None:
        if not line.strip():
            continue
        fields = arc_fields(version, line.decode("utf-8", "replace"))
        if fields is None:
            raise ValueError(f"{path}: no ARC {version} header: {line[:200]!r}")
        yield ArcRecord(fields, f.take(int(fields["Archive-length"])))


def write_arc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", version: int | None = None, date: str = "20240101000000", max_bytes: int = 32 << 20) -> int:
    """Write ARC files and return the number of records; by default tasks alternate between versions 1 and 2.

    A null html is an empty payload, a null URL ``urn:null``; white space,
    control and non-ASCII characters of a URL are percent-encoded. A null id
    is left out of the record. An empty table leaves an empty folder.
    """
    make_folder(pages.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        kind, out, files, size, total = version or 1 + task % 2, None, 0, 0, 0
        for part in (p for b in batches for p in slices(b, html_col)):
            for row, url, html in zip(*(part.column(c).to_pylist() for c in (id_col, url_col, html_col))):
                if out is None:
                    name = f"part-{task:05d}-{files:05d}.arc.gz"
                    out, files, size = AtomicFile(folder, name), files + 1, 0
                    block = f"{kind} 0 legacy\n{' '.join(ARC_FIELDS[kind])}\n\n".encode()
                    out.write(_member(f"filedesc://{name} 0.0.0.0 {date} text/plain {len(block)}\n".encode() + block))
                payload = (html or "").encode("utf-8", "surrogatepass")
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n" + (f"{ROW_ID}: {row}\r\n" if row is not None else "") + "\r\n"
                content = head.encode() + payload
                line = arc_line(kind, quote(url or "urn:null", safe="!#$%&'()*+,/:;=?@[]~"), date, "text/html", len(content), name=name)
                out.write(_member(line + content + b"\n"))
                size, total = size + len(content), total + 1
                if size >= max_bytes:
                    out.close()
                    out = None
        if out:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64())], ["n"])

    return pages.select(id_col, url_col, html_col).mapInArrow(tidy(run), "n long").agg(F.sum("n")).first()[0] or 0


def _header(head: bytes, name: str) -> str | None:
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name.lower().encode():
            return value.strip().decode()
    return None


def index_arc(spark: SparkSession, folder: str) -> DataFrame:
    """One row per ARC record: file, position, row_id, payload_digest, payload_bytes, and the record_id, url and date that a WARC response of it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for b in batches for p in b.column("path").to_pylist()):
            rows = []
            for i, record in enumerate(read_arc(path)):
                head, payload = record.split
                row, digest, url, date = _header(head, ROW_ID), hashlib.sha256(payload).hexdigest(), record.fields["URL"], record.fields["Archive-date"]
                rows.append((path, i, int(row) if row else None, digest, len(payload), _record_id("response", url, date, row, digest), url, iso_date(date)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), KINDS)], [x.split()[0] for x in INDEX.split(", ")])

    return list_files(spark, folder).select("path").mapInArrow(tidy(run), INDEX)


def choose_responses(index: DataFrame, least_bytes: int = 100) -> DataFrame:
    """Adds refers_to and original: for a record of at least ``least_bytes`` whose payload a record of a smaller row_id holds too, the smallest such row_id, and its record_id, url and date; else null.

    A record without a row_id revisits the smallest that has one. Records that
    share the smallest row_id are all responses.
    """
    large = F.col("payload_bytes") >= least_bytes
    first = F.min(F.when(F.col("row_id").isNotNull(), F.struct("row_id", "record_id", "url", "date")))
    shared = index.where(large).groupBy("payload_digest").agg(first.alias("original"), F.count("*").alias("n")).where("n > 1 and original is not null")
    shared = stored(shared.select("payload_digest", "original"), "responses")
    out = index.join(shared, "payload_digest", "left")
    revisit = large & F.col("original").isNotNull() & ~F.col("original.row_id").eqNullSafe(F.col("row_id"))
    return out.withColumns({"refers_to": F.when(revisit, F.col("original.row_id")), "original": F.when(revisit, F.col("original"))})


def _record_id(kind: str, url: str, date: str, row: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{kind} {url} {date} {row} {digest}')}>"


def warc_record(record: ArcRecord, original: dict | None) -> bytes:
    """The WARC/1.1 record that is equivalent to an ARC record; the block of a revisit (of ``original``) is the HTTP head alone."""
    url, d = record.fields["URL"], record.fields["Archive-date"]
    date = iso_date(d)
    head, payload = record.split
    digest, row = hashlib.sha256(payload).hexdigest(), _header(head, ROW_ID)
    kind = "response" if head and original is None else "revisit" if original is not None else "resource"
    block = head if kind == "revisit" else record.content
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(kind, url, d, row, digest)}", f"WARC-Date: {date}", f"WARC-Target-URI: {url}",
        f"WARC-IP-Address: {record.fields['IP-address']}", f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"Content-Type: {'application/http; msgtype=response' if head else record.fields['Content-type']}",
    ]
    if kind == "revisit":
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {original['record_id']}",
            f"WARC-Refers-To-Target-URI: {original['url']}", f"WARC-Refers-To-Date: {original['date']}", f"{REFERS}: {original['row_id']}",
        ]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def convert_arc(spark: SparkSession, arc_folder: str, warc_folder: str, least_bytes: int = 100) -> int:
    """Convert all ARC files of a folder to WARC files of the same names, and return the number of records.

    An empty folder gives none. A damaged file raises ValueError.
    """
    make_folder(spark, warc_folder)
    files = list_files(spark, arc_folder).select(F.col("path").alias("file"))
    n_files = files.count()
    if not n_files:
        return 0
    decided = choose_responses(stored(index_arc(spark, arc_folder), "arc-index"), least_bytes).where("refers_to is not null").select("file", "position", "original")
    every = decided.unionByName(files, allowMissingColumns=True)

    def run(table: pa.Table) -> pa.Table:
        path, n = table.column("file")[0].as_py(), 0
        originals = dict(zip(table.column("position").to_pylist(), table.column("original").to_pylist()))
        name = path.rsplit("/", 1)[1]
        out = AtomicFile(warc_folder, name.replace(".arc.gz", ".warc.gz"))
        out.write(_member(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: " + f"<urn:uuid:{uuid.uuid5(NAMESPACE, name)}>".encode() + b"\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\nContent-Length: 22\r\n\r\nconformsTo: WARC/1.1\r\n\r\n\r\n"))
        for i, record in enumerate(read_arc(path)):
            out.write(_member(warc_record(record, originals.get(i))))
            n += 1
        out.close()
        return pa.table({"n": pa.array([n], pa.int64())})

    # about a file a task while there are few, and at most some 16 (of max_bytes each) beyond
    tasks = max(min(n_files, 8 * spark.sparkContext.defaultParallelism), n_files // 16)
    return every.repartition(tasks, "file").groupBy("file").applyInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


@dataclass
class WarcRecord:
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""


def iterate_warc(path: str) -> Iterator[WarcRecord]:
    """Records of a WARC file, in order."""
    f = GzipReader(path)
    while (line := f.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{path}: no WARC version line")
        headers = {}
        while (line := f.line()) is not None and line.strip():
            key, _, value = line.decode("utf-8", "replace").partition(":")
            headers[key.strip().lower()] = value.strip()
        yield WarcRecord(headers, f.take(int(headers["content-length"])))


def read_warc(spark: SparkSession, folder: str, keep_payload: bool = False) -> DataFrame:
    """One row per response, resource or revisit record: row_id, url, payload_bytes, payload_digest, record_type, refers_to, and with ``keep_payload`` the payload (null for a revisit).

    The digest of a payload that is there is computed from it, and an archive whose
    header says otherwise raises ValueError; a revisit's is its header's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), *[pa.binary()] * keep_payload]
        names = ["row_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * keep_payload]
        for path in (p for b in batches for p in b.column("path").to_pylist()):
            rows, held = [], 0
            for r in iterate_warc(path):
                kind = r.headers["warc-type"]
                if kind not in ("response", "resource", "revisit"):
                    continue
                head, gap, payload = r.block.partition(b"\r\n\r\n") if kind != "resource" else (b"", b"", r.block)
                said = r.headers["warc-payload-digest"].removeprefix("sha256:")
                if kind != "revisit" and hashlib.sha256(payload).hexdigest() != said:
                    raise ValueError(f"{path}: {r.headers['warc-record-id']} has another payload digest than it says")
                row, size = _header(head, ROW_ID), int(_header(head, "Content-Length") or 0) if kind == "revisit" else len(payload)
                refers = r.headers.get(REFERS.lower())
                rows.append((int(row) if row else None, r.headers.get("warc-target-uri"), size, said, kind, int(refers) if refers else None, *[None if kind == "revisit" else payload] * keep_payload))
                held += len(payload) * keep_payload + 200
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names)

    schema = "row_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * keep_payload
    return list_files(spark, folder).select("path").mapInArrow(tidy(run), schema)

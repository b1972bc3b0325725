"""WARC records in ZIP packages: writing, and reading by range.

Each task writes packages of its rows: members ``archive/*.warc.gz`` (every
record its own gzip member) and ``indexes/*.cdxj`` (one JSON line per record
with its place), all stored, so that a record lies in the package as one byte
range. Reading parses the central directory (with ZIP64 records), finds the
stored members, and reads each record's range by its index line. Nothing is
extracted to disk.

Of records with equal payloads of at least ``min_bytes`` bytes, that with the
smallest page id is a response and the others revisit it. Payloads are equal
if their SHA-256 is. Payloads that hold more than one in a thousand rows are
broadcast (at most a thousand can), the others joined by a shuffle.

A package counts once its row is in the written table of packages; a task that
is run again leaves an unnamed file. Defined results: a null payload is empty;
a null URL is written as an empty target; a row without a page id is always a
response and gives no id to revisit; all rows that share the smallest id are
responses. Extra columns are ignored; an empty table gives no packages.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zipfile
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescope.llm import zip_reader
from tablescope.llm.files import file_system, shared_folder
from tablescope.llm.skew import FREQUENT, split_by_keys
from tablescope.session import materialize, materialize_observed

#: Bytes of records in one member and in one package, but for a longer record.
MEMBER_BYTES, PACKAGE_BYTES = 1 << 25, 1 << 30
#: Bytes read at once when records lie side by side.
READ_BYTES = 1 << 22

RESPONSE, REVISIT = "response", "revisit"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"  # the pages carry no time


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _number(name: str) -> int | None:
    text = name.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit keeps the HTTP head and no payload."""
    head = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = head if revisit else head + payload
    fields = [("WARC-Type", REVISIT if revisit else RESPONSE), ("WARC-Record-ID", _name(page_id)),
              ("WARC-Date", _DATE), ("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%")),
              ("WARC-Payload-Digest", "sha1:" + payload_digest(payload)),
              *([("WARC-Profile", _PROFILE), ("WARC-Refers-To", _name(refers_to))] if revisit else []),
              ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in fields), "\r\n"]).encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(fields by lower-case name, HTTP head, payload) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = rest[: int(fields["content-length"])]
    if len(block) < int(fields["content-length"]):
        raise ValueError("a record that is cut off")
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


class _Package:
    """One package being written."""

    def __init__(self, folder: str, task: int):
        fs, path = file_system(folder)
        fs.create_dir(path, recursive=True)
        name = f"/{task:06d}-{uuid.uuid4().hex}.wacz"
        self.path = folder + name
        self.out = fs.open_output_stream(path + name)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.records, self.lines, self.total, self.held, self.member = [], [], 0, 0, 0
        self.count = 0

    def add(self, page_id, url: str, raw: bytes) -> None:
        packed = gzip.compress(raw, 1, mtime=0)
        line = {"page_id": page_id, "url": url, "offset": self.held, "length": len(packed)}
        self.lines.append(json.dumps(line, ensure_ascii=True))
        self.records.append(packed)
        self.held += len(packed)
        self.count += 1
        if self.held >= MEMBER_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.records:
            name = f"{self.member:06d}"
            self.zip.writestr(zipfile.ZipInfo(f"archive/{name}.warc.gz"), b"".join(self.records))
            self.zip.writestr(zipfile.ZipInfo(f"indexes/{name}.cdxj"), "\n".join(self.lines))
            self.total += self.held
            self.records, self.lines, self.held, self.member = [], [], 0, self.member + 1

    def close(self) -> pa.RecordBatch:
        self.flush()
        self.zip.close()
        self.out.close()
        return pa.RecordBatch.from_arrays([pa.array([self.path]), pa.array([self.count], pa.int64())],
                                          names=["package", "records"])


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, package = TaskContext.get().partitionId(), None
        for batch in batches:
            get = [batch.column(c) for c in ("id", "url", "payload", "first")]
            for i in range(batch.num_rows):
                page_id, url, payload, first = (c[i].as_py() for c in get)
                revisit = first is not None and page_id is not None and first != page_id
                package = package or _Package(folder, task)
                package.add(page_id, url, record(page_id, url, payload, first if revisit else None, revisit))
                if package.total >= PACKAGE_BYTES:
                    yield package.close()
                    package = None
        if package:
            yield package.close()
    return run


class PackageReader:
    """Range reads from one package."""

    def __init__(self, uri: str):
        fs, path = file_system(uri)
        self.file = fs.open_input_file(path)
        read = lambda at, n: self.file.read_at(n, at)
        self.members = {m.name: m for m in zip_reader.members(read, self.file.size())}
        self.read = read

    def archives(self) -> Iterator[tuple[int, list[dict]]]:
        """Offset in the package and index lines of each archive member."""
        for name in sorted(n for n in self.members if n.startswith("indexes/")):
            index = self.members[name]
            lines = self.read(zip_reader.data_at(self.read, index), index.size).decode().split("\n")
            archive = self.members["archive/" + name.removeprefix("indexes/").removesuffix(".cdxj") + ".warc.gz"]
            yield zip_reader.data_at(self.read, archive), [json.loads(x) for x in lines if x]

    def records(self) -> Iterator[tuple[dict, bytes]]:
        """Index line and raw record, neighbours read together."""
        for base, lines in self.archives():
            a = 0
            while a < len(lines):
                b, end = a + 1, lines[a]["offset"] + lines[a]["length"]
                while (b < len(lines) and lines[b]["offset"] == end
                       and end + lines[b]["length"] - lines[a]["offset"] <= READ_BYTES):
                    end += lines[b]["length"]
                    b += 1
                held = memoryview(self.read(base + lines[a]["offset"], end - lines[a]["offset"]))
                for line in lines[a:b]:
                    at = line["offset"] - lines[a]["offset"]
                    yield line, gzip.decompress(held[at: at + line["length"]])
                a = b

    def close(self) -> None:
        self.file.close()


_RECORD = "id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _read(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("package").to_pylist():
                reader, rows = PackageReader(uri), []
                for line, raw in reader.records():
                    fields, http, payload = parse_record(raw)
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    revisit = fields["warc-type"] == REVISIT
                    if revisit:
                        length = next(int(x.partition(":")[2]) for x in http.decode().split("\r\n")
                                      if x.lower().startswith("content-length:"))
                    else:
                        length = len(payload)
                        if payload_digest(payload) != digest:
                            raise ValueError(f"{uri}: the payload of {fields['warc-record-id']} is damaged")
                    row = [_number(fields["warc-record-id"]), line["url"], length, digest, fields["warc-type"],
                           _number(fields["warc-refers-to"]) if revisit else None]
                    rows.append([*row, None if revisit else payload] if with_payload else row)
                    if len(rows) == 1000:
                        yield _batch(rows, with_payload)
                        rows = []
                reader.close()
                if rows:
                    yield _batch(rows, with_payload)
    return run


def _batch(rows: list[list], with_payload: bool) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    n = len(names) if with_payload else len(names) - 1
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds[:n], strict=True)],
                                      names=names[:n])


def write_packages(pages: DataFrame, folder: str | None = None, *, min_bytes: int = 0, id_col: str = "page_id",
                   url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes every row as a record below ``folder`` (default: a new one in the
    checkpoint folder) and returns the table of packages: ``package``,
    ``records``."""
    folder = folder or shared_folder(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = (pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
                         payload.alias("payload"))
            .withColumn("key", F.when(F.octet_length("payload") >= min_bytes, F.unhex(F.sha2("payload", 256)))
                        # a smaller payload repeats nothing: a key that spreads, of another length
                        .otherwise(F.unhex(F.md5(F.concat_ws(":", "id", "url"))))))
    copies, seen = materialize_observed(
        rows.where("octet_length(key) = 32").groupBy("key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")),
        rows=F.coalesce(F.sum("n"), F.lit(0)), repeated=F.count_if(F.col("n") > 1))
    repeated = copies.where("n > 1")
    hot = F.col("n") * FREQUENT > seen["rows"]
    frequent = F.broadcast(repeated.where(hot).select("key", "first"))
    few = repeated.where(~hot).select("key", "first")
    order = ["id", "url", "payload", "first"]
    # Payloads move only if they may be repeated, but not frequent, ones.
    maybe, once = split_by_keys(rows.join(frequent.select("key"), "key", "left_anti"), few, "key", seen["repeated"] or 0)
    typed = (rows.join(frequent, "key").select(order)
             .union(maybe.join(few, "key", "left").select(order))
             .union(once.withColumn("first", F.lit(None).cast("long")).select(order)))
    return materialize(typed.mapInArrow(_write(folder), "package string, records long"))


def read_packages(packages: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record of the packages named in column ``package``: ``id``,
    ``url``, ``payload_bytes``, ``payload_digest``, ``record_type``,
    ``refers_to`` and, if asked for, ``payload`` (null for a revisit). A task
    reads a package, of PACKAGE_BYTES or little more, however few bytes name it."""
    columns = _RECORD + ", payload binary" * with_payload
    return packages.select("package").repartition(max(1, packages.count())).mapInArrow(_read(with_payload), columns)

"""WARC archives as a data source: ``spark.read.format("warc")`` and
``df.write.format("warc")`` after ``register(spark)``.

Writing: every task writes archives of its own, one gzip member a record, with the
member's length in the gzip header (the format's skip-length field).  The commit writes a
manifest that names the files of tasks that succeeded and, every ``splitBytes``, the place
where a record begins; files of lost or repeated tasks are in no manifest and are not read.

Reading: files are planned into partitions by those places (archives without a manifest
are read whole, a file at a time; small pieces share a partition).  Predicates on record
type and header columns are pushed down.  Of each record the headers are parsed first, from
the first bytes of its member.  If a predicate fails, or the schema asked for has no
``payload``, the rest is not decoded: the skip length leads to the next member (or the
content length, in archives that are not compressed).

Memory: one record, a batch of at most ``BATCH_BYTES`` of payloads or one payload, and the
input batch.  The manifests hold a name for each file and a number for every 128 MB.

Columns, all but payload from headers: record_type, record_id, target_uri, date, refers_to,
payload_digest (lower-case hex SHA-1), payload_length, payload.  A response's block is a
short HTTP head and the payload; a revisit's is the head alone, which keeps the length of
the payload that it refers to.

Defined cases: a NULL payload is empty.  NULL header columns are left out and read as NULL.
Control and non-ASCII characters of header values are percent-encoded.  Very long payloads
are written whole; a member of 4 GB or more has no skip length and is read through.  An
empty table gives a manifest without files, which reads as no rows; extra columns are not
written.  Clashing names do not matter, the columns are selected by name.
"""

from __future__ import annotations

import base64
import json
import struct
import urllib.parse
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from leadlake.llm.common import written
from leadlake.session import scratch_dir

HEADERS = {     # column -> header
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest",
}
SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", payload_length long, payload binary"
HEAD_SCHEMA = SCHEMA.removesuffix(", payload binary")
SMALLEST_COPY = 1000        # bytes of a payload that is worth a revisit record
ARCHIVED = "2000-01-01T00:00:00Z"   # date of records whose source has none
BATCH_BYTES = 8 << 20
BATCH_ROWS = 2000
FILE_BYTES = 1 << 30
SPLIT_BYTES = 128 << 20
OPEN_BYTES = 4 << 20        # what opening a file counts for in planning
LONGEST_HEAD = 1 << 20
PRINTABLE = "".join(map(chr, range(0x21, 0x7F)))    # stays as it is in a header; "%" too


# -- records


def _value(column: str, value: str) -> str:
    if column == "payload_digest":
        return "sha1:" + base64.b32encode(bytes.fromhex(value)).decode()
    value = urllib.parse.quote(value, safe=PRINTABLE)
    return f"<{value}>" if column in ("record_id", "refers_to") else value


def _column(column: str, value: str) -> str:
    if column == "payload_digest":
        name, _, digest = value.partition(":")
        if name.lower() != "sha1":
            return value
        return (base64.b32decode(digest.upper()) if len(digest) == 32 else bytes.fromhex(digest)).hex()
    return value[1:-1] if column in ("record_id", "refers_to") and value[:1] == "<" else value


def record(row: dict) -> bytes:
    """The bytes of one record."""
    payload = row.get("payload") or b""
    length = row.get("payload_length")
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload) if length is None else length}\r\n\r\n").encode()
    block = head + (b"" if row.get("record_type") == "revisit" else payload)
    lines = [f"{name}: {_value(c, row[c])}" for c, name in HEADERS.items() if row.get(c) is not None]
    if row.get("record_type") == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = 3) -> bytes:
    """``data`` as a gzip member that tells its own length (field ``sl``)."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    size = 24 + len(body) + 8
    lengths = (size, len(data)) if max(size, len(data)) < 1 << 32 else (0, 0)
    head = struct.pack("<BBBBIBBH2sHII", 0x1F, 0x8B, 8, 4, 0, 0, 255, 12, b"sl", 8, *lengths)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _parsed(head: bytes) -> dict[str, str]:
    """Header lines by lower-case name; lines that begin with white space go on."""
    out: dict[str, str] = {}
    name = ""
    for line in head.split(b"\r\n")[1:]:
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and name:
            out[name] += " " + text.strip()
            continue
        name, _, value = text.partition(":")
        name = name.strip().lower()
        out[name] = value.strip()
    return out


class _Plain:
    """The bytes of a record in an archive that is not compressed."""

    def __init__(self, file, at: int):
        self.file, self.start, self.at, self.data = file, at, at, b""

    def more(self, size: int) -> bool:
        got = self.file.read_at(size, self.at)
        self.at += len(got)
        self.data += got
        return bool(got)

    def end(self, length: int) -> int:
        return self.start + length


class _Member:
    """The bytes of a record in a gzip member, inflated only as far as asked for."""

    def __init__(self, file, at: int):
        self.file, self.start, self.at, self.data = file, at, at, b""
        self.inflate, self.waiting = zlib.decompressobj(31), b""
        head = file.read_at(24, at)
        self.skip = 0
        if len(head) == 24 and head[3] & 4 and head[12:16] == b"sl\x08\x00":
            self.skip = struct.unpack("<I", head[16:20])[0]

    def more(self, size: int) -> bool:
        while not self.inflate.eof:
            got = self.inflate.decompress(self.waiting, size)   # may have more without more input
            self.waiting = self.inflate.unconsumed_tail
            if got:
                self.data += got
                return True
            if not self.waiting and not self.inflate.eof:
                self.waiting = self.file.read_at(max(min(size, 1 << 20), 1 << 12), self.at)
                self.at += len(self.waiting)
                if not self.waiting:
                    raise EOFError(f"the record at {self.start} is cut off")
        return False

    def end(self, length: int) -> int:
        if self.skip:
            return self.start + self.skip
        while self.more(1 << 20):   # no skip length: on to the end of the member
            self.data = b""
        return self.at - len(self.inflate.unused_data)


def _head(record_, begin: int) -> "int | None":
    """Place behind the blank line that ends the lines from ``begin`` on; None at the end."""
    while (found := record_.data.find(b"\r\n\r\n", begin)) < 0:
        if len(record_.data) - begin > LONGEST_HEAD:
            raise ValueError(f"no end of the headers of the record at {record_.start}")
        if not record_.more(1 << 12):
            return None
    return found + 4


def records(file, start: int, end: int, wanted: list, payloads: bool) -> Iterator[dict]:
    """The records that begin in [start, end) and pass all of ``wanted``, functions of a
    record's columns."""
    compressed = file.read_at(2, start) == b"\x1f\x8b"
    at = start
    while at < end:
        now = _Member(file, at) if compressed else _Plain(file, at)
        body = _head(now, 0)
        if body is None:
            if now.data.strip():
                raise EOFError(f"the record at {at} is cut off")
            return
        names = _parsed(now.data[:body])
        size = int(names["content-length"])
        row = {c: _column(c, names[name.lower()]) if name.lower() in names else None for c, name in HEADERS.items()}
        if all(test(row) for test in wanted):
            inner, http = body, {}
            if names.get("content-type", "").startswith("application/http"):
                inner = _head(now, body) or body
                http = _parsed(now.data[body:inner])
            stop = body + size
            row["payload_length"] = int(http.get("content-length", stop - inner))
            if payloads:
                parts, have = [now.data], len(now.data)
                while have < stop:
                    now.data = b""
                    if not now.more(stop - have):
                        raise EOFError(f"the record at {at} is cut off")
                    parts.append(now.data)
                    have += len(now.data)
                row["payload"] = b"".join(parts)[inner:stop]
            yield row
        at = now.end(body + size + 4)


# -- the data source


def _files(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


class WarcSource(DataSource):
    """Options: path; splitBytes, fileBytes and level when writing; partitions (how many are
    wanted at least) when reading."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options, overwrite)


TESTS = {   # filter -> test of a header's value
    EqualTo: lambda f: lambda v: v == f.value,
    In: lambda f: lambda v: v in f.value,
    IsNotNull: lambda f: lambda v: True,
    StringStartsWith: lambda f: lambda v: v.startswith(f.value),
    StringEndsWith: lambda f: lambda v: v.endswith(f.value),
    StringContains: lambda f: lambda v: f.value in v,
}


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.schema = options["path"], schema
        self.partitions_wanted = int(options.get("partitions", 8))
        unknown = set(schema.names) - set(HEADERS) - {"payload_length", "payload"}
        if unknown:
            raise ValueError(f"a WARC record has no {', '.join(sorted(unknown))}")
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if type(f) in TESTS and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        """Lists of (file, first byte, end)."""
        fs, path = _files(self.path)
        pieces: list[tuple[str, int, int]] = []
        listed = fs.get_file_info(pyarrow.fs.FileSelector(path, recursive=True))
        manifests = [x.path for x in listed if x.base_name.startswith("_manifest-") and x.base_name.endswith(".json")]
        for manifest in sorted(manifests):
            with fs.open_input_stream(manifest) as stream:
                for one in json.loads(stream.read()):
                    ends = [*one["splits"][1:], one["size"]]
                    pieces += [(f"{path}/{one['name']}", a, b) for a, b in zip(one["splits"], ends)]
        if not manifests:
            pieces = [(x.path, 0, x.size) for x in sorted(listed, key=lambda x: x.path)
                      if x.is_file and x.size and x.base_name.endswith((".warc", ".warc.gz"))]
        share = sum(b - a for _, a, b in pieces) / max(self.partitions_wanted, 1)
        target, out, held = min(SPLIT_BYTES, max(OPEN_BYTES, share)), [], 0
        for piece in pieces:
            size = piece[2] - piece[1]
            if not out or held + size > target:
                out.append(InputPartition([]))
                held = 0
            out[-1].value.append(piece)
            held += size + OPEN_BYTES // 16
        return out or [InputPartition([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        fs, _ = _files(self.path)
        names = self.schema.names
        kinds = {"payload_length": pa.int64(), "payload": pa.binary()}
        tests = [(f.attribute[0], TESTS[type(f)](f)) for f in self.filters]
        wanted = [lambda row, c=c, test=test: row[c] is not None and test(row[c]) for c, test in tests]

        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], type=kinds.get(c, pa.string())) for c in names], names=names)

        rows, held = [], 0
        for name, start, end in partition.value:
            with fs.open_input_file(name) as file:
                for row in records(file, start, end, wanted, "payload" in names):
                    rows.append(row)
                    held += len(row.get("payload", b""))
                    if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield batch(rows)
                        rows, held = [], 0
        if rows:
            yield batch(rows)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        self.most = int(options.get("fileBytes", FILE_BYTES))
        self.level = int(options.get("level", 3))

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, path = _files(self.path)
        fs.create_dir(path, recursive=True)
        files, out = [], None
        try:
            for batch in batches:
                columns = {c: batch.column(batch.schema.get_field_index(c)) for c in (*HEADERS, "payload_length", "payload")
                           if c in batch.schema.names}
                for k in range(batch.num_rows):
                    data = member(record({c: x[k].as_py() for c, x in columns.items()}), self.level)
                    if out is not None and files[-1]["size"] + len(data) > self.most:
                        out.close()
                        out = None
                    if out is None:
                        files.append({"name": f"{uuid.uuid4().hex}.warc.gz", "size": 0, "splits": [0]})
                        out = fs.open_output_stream(f"{path}/{files[-1]['name']}", compression=None)
                    now = files[-1]
                    if now["size"] - now["splits"][-1] >= self.split:
                        now["splits"].append(now["size"])
                    out.write(data)
                    now["size"] += len(data)
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list["Written | None"]) -> None:
        fs, path = _files(self.path)
        fs.create_dir(path, recursive=True)
        before = fs.get_file_info(pyarrow.fs.FileSelector(path)) if self.overwrite else []
        files = [f for m in messages if m for f in m.files]
        name = f"{path}/_manifest-{uuid.uuid4().hex}.json"
        with fs.open_output_stream(name) as out:
            out.write(json.dumps(files).encode())
        new = {f["name"] for f in files}
        for old in sorted(before, key=lambda x: not x.base_name.startswith("_manifest-")):
            if old.is_file and old.base_name not in new:
                fs.delete_file(old.path)

    def abort(self, messages: list["Written | None"]) -> None:
        fs, path = _files(self.path)
        for m in messages:
            for f in m.files if m else []:
                fs.delete_file(f"{path}/{f['name']}")


def register(spark: SparkSession) -> None:
    """Make the format ``warc`` known to the session and let it have predicates."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    register(spark)
    return spark.read.format("warc").schema(schema).option(
        "partitions", spark.sparkContext.defaultParallelism).load(path)


def write_warc(rows: DataFrame, path: str, mode: str = "append") -> None:
    register(rows.sparkSession)
    rows.write.format("warc").mode(mode).save(path)


# -- pages


def page_records(pages: DataFrame) -> DataFrame:
    """A record for each page (page_id, url, html).  Of equal payloads of at least
    ``SMALLEST_COPY`` bytes the one with the largest page_id is the response and the others
    revisit it; rows that repeat that page_id are the same page, so responses too.  A NULL
    page_id is below all others.

    The table of payloads that several pages have is written first: the join to it keeps
    every page on its preserved side, which can be split where one payload is very common,
    and broadcasts the table while it is small."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"),
                        payload.alias("payload"))
    rows = rows.withColumns({"payload_length": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    copies = written(
        rows.where(F.col("payload_length") >= SMALLEST_COPY)
        .groupBy(F.col("payload_digest").alias("__digest"), F.col("payload_length").alias("__length"))
        .agg(F.max("page_id").alias("__first"), F.count("*").alias("__n")).where("__n > 1").drop("__n"), "copies")
    joined = rows.join(
        copies, (F.col("payload_digest") == F.col("__digest")) & (F.col("payload_length") == F.col("__length")), "left")
    revisit = F.col("__digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("__first"))

    def urn(column: str):
        return F.concat(F.lit("urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")))

    return joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), urn("page_id").alias("record_id"),
        "target_uri", F.lit(ARCHIVED).alias("date"), F.when(revisit, urn("__first")).alias("refers_to"),
        "payload_digest", "payload_length", F.when(~revisit, F.col("payload")).alias("payload"))


def page_results(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) read back: of
    responses from the decoded payload, of revisits from headers alone."""
    def page(column: str):
        return F.expr(f"try_cast(substring({column}, {len('urn:page:') + 1}) as long)")

    responses = read_warc(spark, path).where("record_type = 'response'").select(
        page("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    revisits = read_warc(spark, path, HEAD_SCHEMA).where("record_type = 'revisit'").select(
        page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest",
        "record_type", page("refers_to").alias("refers_to"))
    return responses.unionByName(revisits)


def archived(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and read these."""
    spark = pages.sparkSession
    path = f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(page_records(pages), path)
    return page_results(spark, path)

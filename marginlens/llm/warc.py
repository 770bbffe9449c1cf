"""WARC archives as a PySpark Python data source, reader and writer.

Reading plans partitions from the archive's manifest (record-aligned byte
ranges) or, for archives written elsewhere, one partition per file. Within a
partition each record's header is parsed first; when the pushed filters on
record type or headers reject it, or the payload is not asked for, the reader
jumps to the next record by the member length in the gzip ``sl`` field and
never decodes the block.

Predicates pushed down: ``=``, ``IN`` and ``IS NOT NULL`` on ``warc_type``,
``record_id``, ``target_uri``, ``payload_digest`` and ``refers_to``, and
``startswith`` on the text ones. They need
``spark.sql.python.filterPushdown.enabled``; without it Spark filters after
the scan.

Writing: every task writes its own files under a unique name; the driver's
commit adds a manifest that names the files of the successful tasks only, so
a retried or lost task leaves nothing that a reader would see. Paths go
through pyarrow's filesystems (local, HDFS, S3, GCS).

Payloads: the block of an ``application/http`` record without its HTTP headers,
the whole block of any other record (``resource``, ``metadata``, ``conversion``,
DNS responses ...); a block is cut by the record's Content-Length.

Defined cases: a null payload is an empty one; a null record id gets a random
URN; null headers are left out and read back as null; no rows give an archive
without records.
"""
from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition,
                                    IsNotNull, StringStartsWith, WriterCommitMessage)

from marginlens.llm.common import driver_table, open_fs, ship_package, staged
from marginlens.session import scratch_path

# --- fixed values: WARC 1.1 header names by column ---
HEADERS = {
    "warc_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_HEAD = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff"  # deflate, extra field, no time

READ_SCHEMA = ("warc_type string, record_id string, target_uri string, payload_digest string, "
               "refers_to string, payload_length long, payload binary")
ROLL_BYTES = 256 << 20   # start a new file beyond this size
SPLIT_BYTES = 32 << 20   # record-aligned read partitions of about this size
READ_BYTES = 1 << 20
PIECE_BYTES = 16 << 10   # compressed bytes decoded at once
MANIFEST = "_manifest"
#: A revisit's block is read only for its HTTP headers.
_SINGLE_LINE = re.compile(r"[\r\n]+")


def _member(data: bytes) -> bytes:
    """One gzip member with the compressed and plain length in an ``sl`` field."""
    z = zlib.compressobj(3, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    extra = 12
    total = len(GZIP_HEAD) + 2 + extra + len(body) + 8
    if total >> 32 or len(data) >> 32:
        sl = b"xx" + struct.pack("<HQ", 8, 0)  # too long for the field: read through
    else:
        sl = b"sl" + struct.pack("<HII", 8, total, len(data))
    return b"".join((GZIP_HEAD, struct.pack("<H", extra), sl, body,
                     struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)))


def record_bytes(row: dict) -> bytes:
    """A plain (uncompressed) WARC record."""
    payload = bytes(row.get("payload") or b"")
    length = row.get("payload_length")
    length = len(payload) if length is None else length
    head = ["WARC/1.1"]
    for col, name in HEADERS.items():
        value = row.get(col)
        if col == "record_id":
            value = value if value is not None else f"urn:uuid:{uuid.uuid4()}"
        if value is not None:
            value = _SINGLE_LINE.sub(" ", value)
            head.append(f"{name}: <{value}>" if col in ("record_id", "refers_to") else f"{name}: {value}")
    if row.get("warc_type") == "warcinfo":
        block = b"software: marginlens\r\nformat: WARC File Format 1.1\r\n"
        head.append("Content-Type: application/warc-fields")
    else:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length
        if row.get("warc_type") == "revisit":
            head.append(f"WARC-Profile: {REVISIT_PROFILE}")
        else:
            block += payload
        head.append("Content-Type: application/http; msgtype=response")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class _Written(WriterCommitMessage):
    files: list = field(default_factory=list)


class WarcWriter(DataSourceWriter):
    def __init__(self, path: str, columns: list[str], overwrite: bool):
        self.path, self.columns, self.overwrite = path, columns, overwrite

    def write(self, rows) -> _Written:
        fs, root = open_fs(self.path)
        fs.create_dir(root, recursive=True)
        done = _Written()
        out = None
        entry: dict = {}
        try:
            for row in rows:
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    data = _member(record_bytes({"warc_type": "warcinfo"}))
                    out.write(data)
                    entry = {"file": name, "size": len(data), "splits": [0]}
                data = _member(record_bytes({c: row[c] for c in self.columns}))
                if entry["size"] - entry["splits"][-1] >= SPLIT_BYTES:
                    entry["splits"].append(entry["size"])
                out.write(data)
                entry["size"] += len(data)
                if entry["size"] >= ROLL_BYTES:
                    out.close()
                    out = None
                    done.files.append(entry)
        finally:
            if out is not None:
                out.close()
        if out is not None:
            done.files.append(entry)
        return done

    def commit(self, messages) -> None:
        from pyarrow import fs as pafs

        fs, root = open_fs(self.path)
        fs.create_dir(f"{root}/{MANIFEST}", recursive=True)
        old = [i.path for i in fs.get_file_info(pafs.FileSelector(f"{root}/{MANIFEST}"))] if self.overwrite else []
        files = [f for m in messages if m is not None for f in m.files]
        with fs.open_output_stream(f"{root}/{MANIFEST}/{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(files).encode())
        for path in old:  # files that no manifest names are invisible
            fs.delete_file(path)

    def abort(self, messages) -> None:
        fs, root = open_fs(self.path)
        for m in messages:
            for f in (m.files if m is not None else []):
                fs.delete_file(f"{root}/{f['file']}")


@dataclass
class _Range(InputPartition):
    parts: list = field(default_factory=list)  # (file, start, end or None)


class _Input:
    """Sequential reads with cheap skips over one archive file.

    What has been skipped stays in the buffer until the next read; skipping
    moves an index.
    """

    def __init__(self, fs, path: str, start: int, end: int | None):
        self.f = fs.open_input_file(path)
        self.size = self.f.size()
        self.at, self.buf, self.pos = start, b"", 0
        self.end = self.size if end is None else end

    def peek(self, n: int, after: int = 0) -> bytes:
        """Up to ``n`` bytes that lie ``after`` bytes ahead; nothing is consumed."""
        ahead = len(self.buf) - self.pos
        if ahead < after + n and self.at + ahead < self.size:
            self.f.seek(self.at + ahead)
            self.buf = self.buf[self.pos:] + self.f.read(max(READ_BYTES, after + n - ahead))
            self.pos = 0
        return self.buf[self.pos + after:self.pos + after + n]

    def skip(self, n: int) -> None:
        self.at += n
        self.pos += n
        if self.pos >= len(self.buf):
            self.buf, self.pos = b"", 0


def _gzip_records(src: _Input):
    """``(header bytes, rest())`` per member; ``rest`` decodes the block on demand.

    A member of unknown length is consumed as it is decoded, one of known
    length (``sl`` field) is skipped as a whole.
    """
    while src.at < src.end and (head := src.peek(12)):
        known = None
        if len(head) == 12 and head[3] == 4:
            extra = src.peek(struct.unpack("<H", head[10:12])[0], 12)
            if extra[:2] == b"sl" and len(extra) >= 12:
                known = struct.unpack("<I", extra[4:8])[0]
        z = zlib.decompressobj(31)
        used = 0

        def more(z=z, known=known):
            """The next decoded bytes; b"" at the end of the member or file."""
            nonlocal used
            while not z.eof:
                if known is None:
                    chunk = src.peek(PIECE_BYTES)
                    out = z.decompress(chunk)
                    src.skip(len(chunk) - len(z.unused_data))
                else:
                    chunk = src.peek(min(PIECE_BYTES, known - used), used)
                    out = z.decompress(chunk)
                    used += len(chunk)
                if out or not chunk:
                    return out
            return b""

        plain = b""
        while b"\r\n\r\n" not in plain and (out := more()):
            plain += out
        head_bytes, _, begun = plain.partition(b"\r\n\r\n")

        def rest(begun=begun, more=more):
            got = [begun]
            while out := more():
                got.append(out)
            return b"".join(got)

        yield head_bytes, rest
        if known is None:
            while more():
                pass
        else:
            src.skip(known)


def _plain_records(src: _Input):
    """Uncompressed archives: skip by Content-Length."""
    while src.at < src.end:
        n = 1024
        while b"\r\n\r\n" not in (got := src.peek(n)) and len(got) == n:
            n *= 2
        head, found, _ = got.partition(b"\r\n\r\n")
        if not found:
            return
        length, skip = _content_length(head) or 0, len(head) + 4
        yield head, lambda length=length, skip=skip: src.peek(length, skip)
        src.skip(skip + length + 4)


def _content_length(head: bytes) -> int | None:
    m = re.search(rb"(?im)^content-length:\s*(\d+)", head)
    return int(m[1]) if m else None


def record_payload(head: bytes, block: bytes, revisit: bool) -> tuple[int | None, bytes | None]:
    """``(length, payload)`` of a record from its header and (at least) its block.

    The block ends where the header's Content-Length says. Only an
    ``application/http`` block has HTTP headers before its payload; any other
    block is the payload. A revisit has no payload of its own: its length is
    what its HTTP headers say.
    """
    length = _content_length(head)
    block = block if length is None else block[:length]
    if re.search(rb"(?im)^content-type:\s*application/http\b", head):
        http, _, block = block.partition(b"\r\n\r\n")
        if revisit:
            return _content_length(http), None
    elif revisit:
        return None, None
    return len(block), block


def parse_header(head: bytes) -> dict:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    found = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    return {col: v.strip("<>") if col in ("record_id", "refers_to") and v else v
            for col, v in ((c, found.get(n.lower())) for c, n in HEADERS.items())}


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.tests = path, payload, []

    def pushFilters(self, filters):
        for f in filters:
            col = f.attribute[0] if getattr(f, "attribute", None) else None
            if col in HEADERS and isinstance(f, (EqualTo, In, IsNotNull, StringStartsWith)):
                self.tests.append((type(f).__name__, col, getattr(f, "value", None)))
            else:
                yield f

    def _wanted(self, row: dict) -> bool:
        for kind, col, value in self.tests:
            got = row[col]
            if got is None:
                return False
            if kind == "EqualTo" and got != value or kind == "In" and got not in value:
                return False
            if kind == "StringStartsWith" and not got.startswith(value):
                return False
        return True

    def partitions(self):
        from pyarrow import fs as pafs

        fs, root = open_fs(self.path)
        entries = []
        if fs.get_file_info(f"{root}/{MANIFEST}").type == pafs.FileType.Directory:
            for info in fs.get_file_info(pafs.FileSelector(f"{root}/{MANIFEST}")):
                with fs.open_input_stream(info.path) as f:
                    entries += json.loads(f.read())
        else:
            for info in fs.get_file_info(pafs.FileSelector(root)):
                if info.base_name.endswith((".warc", ".warc.gz")):
                    entries.append({"file": info.base_name, "size": info.size, "splits": [0]})
        ranges = [(e["file"], a, b) for e in entries
                  for a, b in zip(e["splits"], [*e["splits"][1:], e["size"]])]
        packed, size = [], SPLIT_BYTES  # neighbouring small files share a partition
        for name, a, b in ranges:
            if size + (b - a) > SPLIT_BYTES:
                packed.append(_Range([]))
                size = 0
            packed[-1].parts.append((name, a, b))
            size += b - a
        return packed or [_Range([])]

    def read(self, partition):
        fs, root = open_fs(self.path)
        for name, start, end in partition.parts:
            src = _Input(fs, f"{root}/{name}", start, end)
            records = _gzip_records if src.peek(2) == b"\x1f\x8b" else _plain_records
            for head, rest in records(src):
                row = parse_header(head)
                if not self._wanted(row):
                    continue
                length = payload = None
                revisit = row["warc_type"] == "revisit"
                if revisit or self.payload:
                    length, payload = record_payload(head, rest(), revisit)
                yield (*(row[c] for c in HEADERS), length, payload)


class WarcDataSource(DataSource):
    """``format("warc")``; options ``path`` and ``payload`` (default true)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() == "true")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], schema.fieldNames(), overwrite)


def write_warc(records: DataFrame, path: str) -> None:
    """Write ``records`` (any of the header columns, ``payload_length``, ``payload``)."""
    ship_package(records.sparkSession)
    records.sparkSession.dataSource.register(WarcDataSource)
    records.write.format("warc").mode("append").option("path", path).save()


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    ship_package(spark)
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("payload", str(payload).lower()).option("path", path).load()


def capture_records(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """WARC records of ``pages``; repeated payloads become revisits.

    Of equal payloads of at least ``min_bytes``, the page with the smallest id
    is the response (rows repeating that id too); a null id always revisits
    when its group has an id. Only groups of two or more are joined back: the
    table of their digests is written first, so Catalyst knows its size and
    AQE can split a hot digest.
    """
    raw = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    raw = raw.withColumns({"digest": F.sha2("payload", 256), "bytes": F.octet_length("payload")})
    groups = staged(
        raw.filter(F.col("bytes") >= min_bytes).groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) & F.col("first_id").isNotNull())
        .select(F.col("digest").alias("group_digest"), "first_id"), "warc_repeats")
    linked = raw.join(groups, raw["digest"] == groups["group_digest"], "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))

    def urn(col: str):
        return F.concat(F.lit("urn:page:"), F.col(col).cast("string"))

    return linked.select(
        F.when(revisit, "revisit").otherwise("response").alias("warc_type"),
        urn("page_id").alias("record_id"),
        F.col("url").alias("target_uri"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.when(revisit, urn("first_id")).alias("refers_to"),
        F.col("bytes").cast("long").alias("payload_length"),
        F.when(~revisit, F.col("payload")).alias("payload"))


def op1_warc(spark, sf_dir):
    """Write ``pages`` as WARC, read the archives back."""
    path = scratch_path(spark, "archive")
    write_warc(capture_records(driver_table(spark, sf_dir, "pages")), path)
    back = read_warc(spark, path).filter(F.col("warc_type").isin("response", "revisit"))
    response = F.col("warc_type") == "response"

    def page(col: str):
        return F.regexp_extract(col, r"^urn:page:(-?\d+)$", 1).try_cast("long")

    return back.select(
        page("record_id").alias("page_id"),
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length"))
        .alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(F.substring_index("payload_digest", ":", -1))
        .alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        page("refers_to").alias("refers_to"))


SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), g AS (
  SELECT *, CASE WHEN octet_length(encode(body)) >= 100
                 THEN min(page_id) OVER (PARTITION BY body) END AS first_id FROM p
)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM g
"""

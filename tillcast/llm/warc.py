"""WARC archives as a PySpark data source, written and read.

Reading plans whole files as partitions (small files share one), parses the header of each
record first, tests the pushed-down predicates on record type and header fields, and steps
over the block of a record that is not wanted (a seek in plain files) without decoding it.
Payloads can be left out altogether (option ``payloads``). Writing makes one file or more for
each task under a name of that attempt, rolled at ``file_bytes``; the commit writes a manifest
of the files of the successful attempts, and readers of the folder follow it, so that a lost
executor or a repeated task leaves no record twice.

``archive_records`` turns pages into records: of equal payloads (by SHA-1 and length) of at
least ``least_bytes`` the one with the largest id is the response, the others are revisits
that refer to it.

Paths are opened with pyarrow's file systems (file, hdfs, s3, gs).

Defined results: a null payload is empty. A null url has no WARC-Target-URI, line breaks in it are
percent-encoded. Repeated rows of the largest id are responses each; rows without an id refer to
the largest id of their payload, or are responses if there is none. No rows: an archive without
records, read back as an empty table. Further columns are not written. A record that is cut off
or lacks its length is an error, not an end.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition,
                                    IsNotNull, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage)

from tillcast.llm.common import narrow, small_enough

SCHEMA = ("record_id string, warc_type string, target_uri string, warc_date string, refers_to string, payload_digest string, "
          "payload_length long, payload binary, digest_ok boolean")
#: Column and header field.
FIELDS = {"record_id": "warc-record-id", "warc_type": "warc-type", "target_uri": "warc-target-uri", "warc_date": "warc-date",
          "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
LENGTH_FIELD = "X-Payload-Length"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_manifest.json"


def file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---------------------------------------------------------------- records as bytes


def record_bytes(kind: str, record_id: str, uri: str | None, date: str, digest: str, payload: bytes, refers_to: str | None, compress: bool) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if kind == "response" else head
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {date}"]
    if uri is not None:
        lines.append("WARC-Target-URI: " + uri.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"{LENGTH_FIELD}: {len(payload)}", "Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(block)}", "", ""]
    data = "\r\n".join(lines).encode() + block + b"\r\n\r\n"
    if compress:
        z = zlib.compressobj(wbits=31)  # a gzip member for each record
        data = z.compress(data) + z.flush()
    return data


class _Plain:
    """Reads lines and blocks of a plain file; stepping over a block seeks."""

    def __init__(self, file) -> None:
        self.file, self.buffer = file, b""

    def _fill(self) -> bool:
        more = self.file.read(1 << 16)
        self.buffer += more
        return bool(more)

    def until(self, mark: bytes) -> bytes | None:
        while (at := self.buffer.find(mark)) < 0:
            if not self._fill():
                if self.buffer.strip():
                    raise ValueError("a WARC header is cut off")
                return None
        out, self.buffer = self.buffer[:at], self.buffer[at + len(mark):]
        return out

    def take(self, n: int) -> bytes:
        if len(self.buffer) < n:
            self.buffer += self.file.read(n - len(self.buffer))
        if len(self.buffer) < n:
            raise ValueError("a WARC block is cut off")
        out, self.buffer = self.buffer[:n], self.buffer[n:]
        return out

    def skip(self, n: int) -> None:
        if n <= len(self.buffer):
            self.buffer = self.buffer[n:]
            return
        n -= len(self.buffer)
        self.buffer = b""
        if self.file.tell() + n > self.file.size():
            raise ValueError("a WARC block is cut off")
        self.file.seek(n, 1)


class _Gzip(_Plain):
    """The same over gzip members: a skipped block is inflated piece by piece and thrown away."""

    def __init__(self, file) -> None:
        super().__init__(file)
        self.z, self.rest = zlib.decompressobj(wbits=31), b""

    def _fill(self) -> bool:
        while True:
            data = self.rest or self.file.read(1 << 16)
            if not data:
                return False
            if self.z.eof:
                self.z = zlib.decompressobj(wbits=31)
            out = self.z.decompress(data, 1 << 20)
            self.rest = self.z.unconsumed_tail or self.z.unused_data
            if out:
                self.buffer += out
                return True

    def take(self, n: int) -> bytes:
        parts, have = [self.buffer], len(self.buffer)
        while have < n:
            self.buffer = b""
            if not self._fill():
                raise ValueError("a WARC block is cut off")
            parts.append(self.buffer)
            have += len(self.buffer)
        whole = b"".join(parts)
        self.buffer = whole[n:]
        return whole[:n]

    def skip(self, n: int) -> None:
        while len(self.buffer) < n:
            n -= len(self.buffer)
            self.buffer = b""
            if not self._fill():
                raise ValueError("a WARC block is cut off")
        self.buffer = self.buffer[n:]


def headers(raw: bytes) -> dict[str, str]:
    """Fields by lower-case name; folded lines belong to the field above."""
    out: dict[str, str] = {}
    name = None
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def records(source, wanted, payloads: bool) -> Iterator[dict]:
    """The wanted records of one open file. ``wanted`` sees the header columns only."""
    while True:
        raw = source.until(b"\r\n\r\n")
        if raw is None:
            return
        raw = raw.lstrip(b"\r\n")
        if not raw:  # the line breaks between records
            continue
        if not raw.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should begin")
        head = headers(raw)
        if not head.get("content-length", "").isdigit():
            raise ValueError("a WARC record lacks its length")
        size = int(head["content-length"])
        row = {c: head.get(f) for c, f in FIELDS.items()}
        if row["payload_digest"] and row["payload_digest"].lower().startswith("sha1:"):
            row["payload_digest"] = row["payload_digest"][5:]
        if not wanted(row):
            source.skip(size)
            continue
        length = head.get(LENGTH_FIELD.lower(), "")
        row |= {"payload_length": int(length) if length.isdigit() else None, "payload": None, "digest_ok": None}
        if payloads and row["warc_type"] != "revisit":
            block = source.take(size)
            if head.get("content-type", "").lower().startswith("application/http"):
                at = block.find(b"\r\n\r\n")
                block = block[at + 4:] if at >= 0 else block
            row["payload"], row["payload_length"] = block, len(block)
            if row["payload_digest"] is not None:
                row["digest_ok"] = base32_sha1(block) == row["payload_digest"].upper()
        else:
            source.skip(size)
        yield row


# ---------------------------------------------------------------- the data source


@dataclass
class FileGroup(InputPartition):
    files: tuple[str, ...]


class WarcReader(DataSourceReader):
    def __init__(self, options, schema) -> None:
        self.path = options["path"]
        self.payloads = str(options.get("payloads", "true")).lower() == "true"
        self.partition_bytes = int(options.get("partitionbytes", 64 << 20))
        self.schema, self.pushed = schema, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        tests = {EqualTo: lambda v, x: v is not None and v == x, EqualNullSafe: lambda v, x: v == x, In: lambda v, x: v is not None and v in x,
                 IsNotNull: lambda v, x: v is not None, StringStartsWith: lambda v, x: v is not None and v.startswith(x),
                 StringEndsWith: lambda v, x: v is not None and v.endswith(x), StringContains: lambda v, x: v is not None and x in v}
        for f in filters:
            column = ".".join(f.attribute) if hasattr(f, "attribute") else None
            if type(f) in tests and column in FIELDS:
                self.pushed.append((column, type(f).__name__, getattr(f, "value", None), tests[type(f)]))
            else:
                yield f

    def wanted(self, row: dict) -> bool:
        return all(test(row[column], value) for column, _, value, test in self.pushed)

    def partitions(self) -> list[FileGroup]:
        from pyarrow import fs

        store, root = file_system(self.path)
        info = store.get_file_info(root)
        if info.type == fs.FileType.File:
            files = [(info.path, info.size)]
        elif store.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.File:
            with store.open_input_stream(f"{root}/{MANIFEST}") as f:
                files = [(f"{root}/{x['file']}", x["bytes"]) for x in json.loads(f.read())["files"]]
        else:
            found = store.get_file_info(fs.FileSelector(root, recursive=True))
            files = [(x.path, x.size) for x in found if x.path.endswith((".warc", ".warc.gz"))]
        groups: list[list[str]] = []
        room = 0
        for path, size in sorted(files):
            if size > room:
                groups.append([])
                room = self.partition_bytes
            groups[-1].append(path)
            room -= size
        return [FileGroup(tuple(g)) for g in groups] or [FileGroup(())]

    def read(self, partition: FileGroup) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.schema)
        store, _ = file_system(self.path)
        rows, size = [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in schema], schema=schema)

        for path in partition.files:
            with store.open_input_file(path) as file:
                for row in records(_Gzip(file) if path.endswith(".gz") else _Plain(file), self.wanted, self.payloads):
                    rows.append(row)
                    size += 200 + len(row["payload"] or b"")
                    if size >= 8 << 20:
                        yield batch()
                        rows, size = [], 0
        if rows:
            yield batch()


@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


class WarcWriter(DataSourceArrowWriter):
    """Input columns: record_id, warc_type, target_uri, warc_date, refers_to, payload."""

    def __init__(self, options, overwrite: bool) -> None:
        self.path, self.compress = options["path"], options.get("compression", "none") == "gzip"
        self.file_bytes = int(options.get("filebytes", 64 << 20))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        store, root = file_system(self.path)
        store.create_dir(root, recursive=True)
        attempt = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        files, out = [], None
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None:
                        name = f"{attempt}-{len(files):04d}.warc" + ".gz" * self.compress
                        files.append({"file": name, "bytes": 0, "records": 0})
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    payload = row["payload"] or b""
                    data = record_bytes(row["warc_type"], row["record_id"], row["target_uri"], row["warc_date"], base32_sha1(payload), payload,
                                        row["refers_to"], self.compress)
                    out.write(data)
                    files[-1]["bytes"] += len(data)
                    files[-1]["records"] += 1
                    if files[-1]["bytes"] >= self.file_bytes:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = file_system(self.path)
        store.create_dir(root, recursive=True)
        files = [f for m in messages if m for f in m.files]
        with store.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(json.dumps({"files": files}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, root = file_system(self.path)
        for f in (f for m in messages if m for f in m.files):
            store.delete_file(f"{root}/{f['file']}")


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options, schema)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("payloads", str(payloads).lower()).load(path)


def write_warc(recs: DataFrame, path: str, gzip: bool = False, file_bytes: int = 64 << 20) -> None:
    """Writes the records into a new folder."""
    recs.sparkSession.dataSource.register(WarcDataSource)
    (recs.select("record_id", "warc_type", "target_uri", "warc_date", "refers_to", "payload").write.format("warc").mode("append")
     .option("compression", "gzip" if gzip else "none").option("filebytes", file_bytes).save(path))


def archive_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", least_bytes: int = 0,
                    date: str = "1970-01-01T00:00:00Z", salts: int = 16) -> DataFrame:
    """One record per page, responses and revisits."""
    rows = narrow(pages, row_id=id_col, target_uri=url_col, body=body_col).withColumn("payload", F.encode(F.coalesce("body", F.lit("")), "UTF-8")).drop("body")
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload")})
    first = (rows.where(F.col("size") >= least_bytes).groupBy("digest", "size").agg(F.max("row_id").alias("first"), F.count("*").alias("copies"))
             .where("copies > 1").select(F.col("digest").alias("d"), F.col("size").alias("s"), "first"))
    if small_enough(first):
        joined = rows.join(F.broadcast(first), (F.col("digest") == F.col("d")) & (F.col("size") == F.col("s")), "left")
    else:  # copies of one payload are spread over ``salts`` keys
        first = first.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("row_id"), F.lit(salts)).cast("int")).join(
            first, (F.col("digest") == F.col("d")) & (F.col("size") == F.col("s")) & (F.col("salt") == F.col("t")), "left")
    revisit = F.col("first").isNotNull() & ~F.col("row_id").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    return joined.select(urn(F.col("row_id")).alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("warc_type"), "target_uri",
                         F.lit(date).alias("warc_date"), F.when(revisit, urn(F.col("first"))).alias("refers_to"), "payload")


def page_of(urn: F.Column) -> F.Column:
    return F.regexp_extract(urn, r"^<urn:page:(-?\d*)>$", 1).try_cast("long")

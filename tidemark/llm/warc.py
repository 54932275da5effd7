"""Operator 4: a deterministic, sharded WARC writer and the reader for what it wrote.

Records are sorted by key over ranges. Each task rolls its files by compressed size, makes headers, digests and record
ids anew from the contents alone, writes every file under a temporary name in the shared folder, renames it when it is
whole, and reports it. The manifest, written last, is the commit: a reader takes only the files that it lists, so what
a lost or repeated task leaves behind is never read. A record's bytes follow from its contents alone; which records
share a file follows from the ranges, so tables that are too large for Spark to see every key when it sets the ranges
may be dealt to files in another way in another run. ``shards`` gives their number.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stage

ROLL_BYTES = 8 << 20
#: Payloads of fewer bytes are always stored in full.
LEAST_REVISIT_BYTES = 0
SALTS = 16
#: Fixed, so that equal input gives equal bytes.
DATE = "2024-01-01T00:00:00Z"
ID_SPACE = uuid.UUID("7d0f52a4-6a0c-5d0e-9b1c-2f2f4f6f8f10")
MANIFEST = "file string, shard int, records long, bytes long, sha1 string"
RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def with_revisits(pages: DataFrame, least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Rows page_id, digest, refers_to, url, payload: all pages, and a row without payload before each page that revisits.

    Of pages with equal payloads of ``least`` bytes or more, that with the largest page_id stores it; for the others a row
    says which that is, as ``refers_to``. It has the page's id and digest, so it is sorted next to the page and payloads
    are never joined. A null html is an empty payload. Rows without a page_id, and rows that repeat the largest id, store
    their own.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload")).withColumn("digest", F.sha1("payload"))
    keys = stage(rows.where(F.octet_length("payload") >= least).select("page_id", "digest"), "payload-keys")
    last = keys.groupBy("digest").agg(F.max("page_id").alias("last_id"), F.count("*").alias("n")).where("n > 1")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")  # a digest may be that of a third of all pages
    salted = keys.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    marks = salted.join(last.select("digest", "last_id", salts), ["digest", "salt"]).where("page_id < last_id").select("page_id", "digest", F.col("last_id").alias("refers_to")).distinct()
    own = rows.select("page_id", "digest", F.lit(None).cast("long").alias("refers_to"), "url", "payload")
    return own.unionByName(marks, allowMissingColumns=True)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(ID_SPACE, f'{page_id}:{payload_digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record; a revisit has the HTTP header of the payload that it leaves out."""
    own = digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, own)}", f"WARC-Date: {DATE}"]
    if url is not None:
        clean = "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url)
        head.append(f"WARC-Target-URI: {clean}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head += [f"WARC-Payload-Digest: sha1:{own}", f"WARC-Block-Digest: sha1:{digest(block)}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, own)}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzipped(data: bytes) -> bytes:
    """A gzip member without name or time."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def local_uri(path: str) -> str:
    """The path as ``pyarrow.fs`` reads it: Hadoop writes local paths with one slash after ``file:``."""
    return re.sub(r"^file:/+", "/", path)


def write_archives(pages: DataFrame, path: str, roll_bytes: int = ROLL_BYTES, least: int = LEAST_REVISIT_BYTES, shards: int | None = None) -> DataFrame:
    """Writes ``path``/part-*.warc.gz and ``path``/manifest; returns the manifest: file, shard, records, bytes, sha1.

    A file ends with the record that takes it to ``roll_bytes``. An empty table gives an empty manifest. Pages are sorted
    by page_id, nulls first, then payload digest and url, and so are files.
    """
    order = ["page_id", "digest"]
    rows = with_revisits(pages, least)
    rows = (rows.repartitionByRange(shards, *order) if shards else rows.repartitionByRange(*order)).sortWithinPartitions(*order, F.col("payload").isNotNull(), "url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(local_uri(path))
        shard, files = TaskContext.get().partitionId(), 0
        out, own, count = io.BytesIO(), hashlib.sha1(), 0

        def close() -> pa.RecordBatch:
            nonlocal out, own, count, files
            name = f"part-{shard:05d}-{files:05d}.warc.gz"
            temporary = f"{base}/_temporary/{name}.{uuid.uuid4().hex}"
            store.create_dir(f"{base}/_temporary", recursive=True)
            with store.open_output_stream(temporary, compression=None) as f:
                f.write(out.getbuffer())
            store.move(temporary, f"{base}/{name}")
            done = pa.RecordBatch.from_pydict({"file": [name], "shard": pa.array([shard], pa.int32()), "records": [count], "bytes": [out.tell()], "sha1": [own.hexdigest()]})
            out, own, count, files = io.BytesIO(), hashlib.sha1(), 0, files + 1
            return done

        mark = None  # id, digest and target of the last mark
        for batch in batches:
            ids, digests, targets, urls = (batch.column(c).to_pylist() for c in ("page_id", "digest", "refers_to", "url"))
            for page_id, own_digest, target, url, payload in zip(ids, digests, targets, urls, batch.column("payload"), strict=True):
                if not payload.is_valid:
                    mark = (page_id, own_digest, target)
                    continue
                refers_to = mark[2] if mark and mark[:2] == (page_id, own_digest) else None
                member = gzipped(record(page_id, url, payload.as_py(), refers_to))
                out.write(member)
                own.update(member)
                count += 1
                if out.tell() >= roll_bytes:
                    yield close()
        if count:
            yield close()

    rows.mapInArrow(write, MANIFEST).write.parquet(f"{path}/manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{path}/manifest")


#: Bytes given to the unpacker at once.
CHUNK = 16 << 10


def members(data: bytes) -> Iterator[bytes]:
    """The contents of each gzip member. Data is fed in chunks, so what stands after a member is not copied for each."""
    view, at = memoryview(data), 0
    while at < len(view):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if at >= len(view):
                raise ValueError("the last member of an archive is cut off")
            parts.append(unpacker.decompress(view[at : at + CHUNK]))
            at = min(at + CHUNK, len(view)) - len(unpacker.unused_data)
        yield b"".join(parts)


def parsed(member: bytes) -> tuple:
    """page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload; digests are worked out again."""
    head, _, rest = member.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if f"sha1:{digest(block)}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {fields['WARC-Record-ID']} does not fit")
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda name: int(fields[name]) if name in fields else None
    if fields["WARC-Type"] == "response":
        if f"sha1:{digest(payload)}" != fields["WARC-Payload-Digest"]:
            raise ValueError(f"payload digest of {fields['WARC-Record-ID']} does not fit")
        size, body = len(payload), payload
    else:
        size, body = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"]), None
    return number("X-Page-ID"), fields.get("WARC-Target-URI"), fields["WARC-Type"], size, fields["WARC-Payload-Digest"].removeprefix("sha1:"), number("X-Refers-To-Page-ID"), body


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of all files in the manifest; digests are checked, and a file that changed is an error.

    One row of the scan is one file, which rolling keeps near ``roll_bytes``; its members are unpacked one at a time.
    """
    listed = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").select("file", "sha1")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    columns = RECORDS if payloads else RECORDS.rsplit(",", 1)[0]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in columns.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        types = [kinds[c.split()[1]] for c in columns.split(", ")]
        make = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*(r[: len(types)] for r in rows), strict=True), types, strict=True)], names=names)
        for batch in batches:
            for data, want in zip(batch.column("content"), batch.column("sha1").to_pylist(), strict=True):
                data = data.as_py()
                if hashlib.sha1(data).hexdigest() != want:
                    raise ValueError("a file differs from its manifest")
                rows = []
                for member in members(data):
                    rows.append(parsed(member))
                    if len(rows) == 1000:
                        yield make(rows)
                        rows = []
                if rows:
                    yield make(rows)

    return files.join(listed, "file").select("content", "sha1").mapInArrow(read, columns)


def has_archives(manifest: DataFrame) -> bool:
    return not manifest.isEmpty()


def archive_digest(pages: DataFrame, path: str, least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Writes all pages, reads the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    manifest = write_archives(pages, path, least=least)
    columns: list[Column] = [F.col(c) for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")]
    if not has_archives(manifest):
        return spark.createDataFrame([], RECORDS).select(*columns)
    return read_archives(spark, path, payloads=False).select(*columns)

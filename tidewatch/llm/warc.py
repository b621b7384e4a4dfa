"""WARC archives: writing, the monolithic-gzip normaliser, reading back.

``write_archives`` has Spark's text writer produce ordinary ``.warc.gz`` files
that are one gzip stream each.  ``normalise_archives`` inflates each such
stream once, from front to back, rewrites every record as a gzip member of
its own and writes a sidecar index of offsets beside it.  ``read_archives``
goes by that index: each record is inflated from its own member alone.

Files live in the shared folder.  The normaliser writes to a name derived
from the archive's own name and moves the finished file in place, and its
output is the same bytes each time, so a task that runs twice does no harm.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import scratch_path, tidy

REVISIT_MIN_BYTES = 1000
#: Fixed values of the format.
VERSION = "WARC/1.0"
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORD_DATE = "1970-01-01T00:00:00Z"

INDEX_SCHEMA = "file string, offset long, length long, n int"
RECORD_SCHEMA = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
                 "refers_to long, target_uri string, payload binary")


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html", min_bytes: int = REVISIT_MIN_BYTES) -> DataFrame:
    """(page_id, url, payload, bytes, digest, refers_to) of each row.

    Rows with equal payloads of at least ``min_bytes`` refer to the largest
    page_id among them (the response); a null html is an empty payload.  A
    null id is kept, as a response when it alone has the payload and else as
    a revisit.  Repeated ids with equal payloads are all the response.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"))
    rows = (rows.withColumn("bytes", F.octet_length("payload").cast("long"))
            .withColumn("digest", F.sha1(F.col("payload").cast("binary"))))
    first = (pages.select(F.col(id_col).cast("long").alias("page_id"), payload.alias("payload"))
             .where(F.octet_length("payload") >= min_bytes)
             .groupBy(F.sha1(F.col("payload").cast("binary")).alias("of"))
             .agg(F.max("page_id").alias("response"), F.count("*").alias("copies"))
             .where("copies > 1 and response is not null").drop("copies"))
    small = rows.where(F.col("bytes") < min_bytes).withColumn("refers_to", F.lit(None).cast("long"))
    large = (rows.where(F.col("bytes") >= min_bytes)
             .join(first, F.col("digest") == F.col("of"), "left")
             .withColumn("refers_to", F.when(~F.col("response").eqNullSafe(F.col("page_id")), F.col("response")))
             .drop("of", "response"))
    return small.unionByName(large)


def _record_text(id_="page_id"):
    """One WARC record, without its closing blank lines.  The payload of a
    revisit is not stored again; its size and digest are named."""
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ")
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    name = F.coalesce(F.col(id_).cast("string"), F.lit("none"))
    line = lambda key, value: F.concat(F.lit(f"\r\n{key}: "), value)
    return F.concat(
        F.lit(VERSION),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), name, F.lit(">"))),
        line("WARC-Date", F.lit(RECORD_DATE)),
        line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("X-Payload-Length", F.col("bytes").cast("string")),
        F.when(revisit, F.concat(
            line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
            line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n\r\n"), block)


def write_archives(records: DataFrame, folder: str) -> str:
    """Write planned records as ``.gz`` files of one gzip stream each."""
    (records.select(_record_text().alias("value")).write.mode("overwrite")
     .option("lineSep", RECORD_END).option("compression", "gzip").text(folder))
    return folder


class _Stream:
    """Reads records from one gzip stream that is inflated piece by piece."""

    def __init__(self, data: memoryview, piece: int = 1 << 18):
        self.data, self.piece, self.at = data, piece, 0
        self.inflater = zlib.decompressobj(31)
        self.have = bytearray()

    def fill(self) -> bool:
        while self.at < len(self.data):
            part = self.inflater.decompress(self.data[self.at:self.at + self.piece])
            self.at += self.piece
            if self.inflater.eof:  # writers may also close and reopen a stream
                rest = self.inflater.unused_data
                self.at -= len(rest)
                self.at = min(self.at, len(self.data))
                self.inflater = zlib.decompressobj(31)
            self.have += part
            if part:
                return True
        return False

    def until(self, mark: bytes) -> bytes | None:
        start = 0
        while (to := self.have.find(mark, start)) < 0:
            start = max(0, len(self.have) - len(mark))
            if not self.fill():
                return None
        out = bytes(self.have[:to])
        del self.have[:to + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.have) < n:
            if not self.fill():
                raise ValueError("archive ends inside a record")
        out = bytes(self.have[:n])
        del self.have[:n]
        return out


def _records(data: memoryview) -> Iterator[tuple[bytes, bytes]]:
    """(header, block) of each record of an archive."""
    stream = _Stream(data)
    while (header := stream.until(b"\r\n\r\n")) is not None:
        length = int(re.search(rb"\r\nContent-Length: (\d+)", header)[1])
        block = stream.take(length)
        stream.take(len(RECORD_END))
        yield header, block


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # no time stamp: the same bytes each time
    return packer.compress(data) + packer.flush()


def _put(filesystem, path: str, chunks) -> list[tuple[int, int]]:
    """Write chunks to a fresh name, then move the file in place."""
    import uuid
    spans, at, fresh = [], 0, f"{path}.{uuid.uuid4().hex}.part"
    with filesystem.open_output_stream(fresh) as out:
        for chunk in chunks:
            out.write(chunk)
            spans.append((at, len(chunk)))
            at += len(chunk)
    filesystem.move(fresh, path)
    return spans


def _uri(folder: str) -> str:
    return folder if "://" in folder else re.sub(r"^(file:)?/+", "file:///", folder)


def normalise_archives(spark: SparkSession, monolithic: str, folder: str) -> DataFrame:
    """Rewrite each archive under ``monolithic`` with one gzip member per
    record, plus a sidecar ``.idx`` (lines ``offset length``); returns the
    index (file, offset, length, n).  Both files are put in ``folder``,
    which all executors must share."""
    target = _uri(folder)
    pafs_, root = pafs.FileSystem.from_uri(target)
    pafs_.create_dir(root, recursive=True)

    def run(batches):
        filesystem, base = pafs.FileSystem.from_uri(target)
        for batch in batches:
            for i in range(batch.num_rows):
                name = re.sub(r"\W", "_", batch.column(0)[i].as_py().rsplit("/", 1)[-1])
                data = memoryview(batch.column(1)[i].as_buffer())
                members = (_member(h + b"\r\n\r\n" + b + RECORD_END.encode()) for h, b in _records(data))
                spans = _put(filesystem, f"{base}/{name}.warc.gz", members)
                if not spans:
                    continue
                _put(filesystem, f"{base}/{name}.idx", ["".join(f"{a} {n}\n" for a, n in spans).encode()])
                yield pa.RecordBatch.from_arrays([
                    pa.array([f"{name}.warc.gz"] * len(spans)), pa.array([a for a, _ in spans], pa.int64()),
                    pa.array([n for _, n in spans], pa.int64()), pa.array(range(len(spans)), pa.int32())],
                    names=["file", "offset", "length", "n"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(monolithic)
    return files.select("path", "content").mapInArrow(tidy(run), INDEX_SCHEMA)


def parse_record(raw: bytes) -> tuple:
    """A row of RECORD_SCHEMA from one inflated record."""
    header, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in header.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    number = lambda key: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(key, ""))) else None
    kind = fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and hashlib.sha1(block).hexdigest() != digest:
        raise ValueError(f"digest of {fields['WARC-Record-ID']} does not fit its payload")
    size = len(block) if kind == "response" else int(fields["X-Payload-Length"])
    return (number("WARC-Record-ID"), size, digest, kind, number("WARC-Refers-To"),
            fields.get("WARC-Target-URI", ""), block if kind == "response" else None)


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Records of normalised archives (RECORD_SCHEMA), each found by the
    sidecar index and inflated from its own member; payloads are checked
    against their digests.  ``payloads=False`` returns null payloads."""
    target = _uri(folder)

    def run(batches):
        filesystem, base = pafs.FileSystem.from_uri(target)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                name = path.rsplit("/", 1)[-1]
                index = filesystem.open_input_stream(f"{base}/{name}").read().decode().split("\n")[:-1]
                rows, held = [], 0
                with filesystem.open_input_file(f"{base}/{name.removesuffix('.idx')}.warc.gz") as archive:
                    for line in index:
                        at, n = map(int, line.split(" "))
                        archive.seek(at)
                        row = parse_record(zlib.decompress(archive.read(n), 31))
                        rows.append(row if payloads else (*row[:-1], None))
                        held += len(row[-1] or b"") if payloads else 200
                        if held > 4 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    sidecars = spark.read.format("binaryFile").option("pathGlobFilter", "*.idx").load(folder)
    return sidecars.select("path").mapInArrow(tidy(run), RECORD_SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri", "payload")
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=list(names))


def archive_pages(pages: DataFrame, payloads: bool = False, **columns) -> DataFrame:
    """Write ``pages`` as monolithic archives, normalise them and read the
    normalised archives back.  Empty tables give an empty result; urls and
    html may be null; columns beyond the three named ones are not read."""
    spark = pages.sparkSession
    base = scratch_path(spark, "warc")
    write_archives(plan_records(pages, **columns), f"{base}/monolithic")
    index = normalise_archives(spark, f"{base}/monolithic", f"{base}/normalised")
    index.write.parquet(f"{base}/index")
    return read_archives(spark, f"{base}/normalised", payloads)

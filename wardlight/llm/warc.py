"""WARC archives: records written one gzip member each, and a sequential reader that checks them."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_folder, write_stage
from .common import pick, ship

VERSION = b"WARC/1.1"
#: Payloads shorter than this are always stored in full.
LEAST_REVISIT = 100
#: An archive is closed once it holds so many compressed bytes.
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 16
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "archive string, records bigint, bytes bigint"
RECORDS = (
    "archive string, offset bigint, page_id bigint, url string, record_type string, refers_to bigint, "
    "payload_bytes bigint, payload_digest string, payload binary"
)


def member(headers: list[tuple[str, str]], block: bytes, level: int = 6) -> bytes:
    """One record as one gzip member."""
    lines = [VERSION, *[f"{k}: {v}".encode() for k, v in headers], b"Content-Length: %d" % len(block)]
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n") + squeeze.flush()


class DamagedArchive(ValueError):
    """A record whose frame, length or digest does not hold."""


def read_members(stream: BinaryIO, chunk: int = CHUNK) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each gzip member, read once from front to end.

    Memory holds one chunk of the file and one member.
    """
    offset, data, end = 0, b"", False
    while True:
        if not data and not end:
            data = stream.read(chunk)
            end = not data
        if not data:
            return
        inflate, parts, used = zlib.decompressobj(31), [], 0
        while not inflate.eof:
            if not data:
                data = stream.read(chunk)
                if not data:
                    raise DamagedArchive(f"the member at {offset} has no end")
            try:
                parts.append(inflate.decompress(data))
            except zlib.error as e:
                raise DamagedArchive(f"the member at {offset}: {e}") from e
            used += len(data) - len(inflate.unused_data)
            data = inflate.unused_data
        yield offset, b"".join(parts)
        offset += used


def parse_record(content: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record, framed by its Content-Length."""
    head, found, rest = content.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or not lines[0].startswith(b"WARC/"):
        raise DamagedArchive("a record without a head")
    headers = {}
    for line in lines[1:]:
        name, _, value = line.decode().partition(":")
        headers[name.strip().lower()] = value.strip()
    length = int(headers.get("content-length", -1))
    if length < 0 or len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise DamagedArchive("the block is not as long as Content-Length says")
    block = rest[:length]
    if headers.get("warc-block-digest", "sha256:" + hashlib.sha256(block).hexdigest()) != "sha256:" + hashlib.sha256(block).hexdigest():
        raise DamagedArchive("the block does not have its digest")
    return headers, block


def _urn(page) -> str:
    return "<urn:page:null>" if page is None else f"<urn:page:{page}>"


def _page(urn: str | None) -> int | None:
    value = urn.strip("<>").rpartition(":")[2] if urn else "null"
    return None if value == "null" else int(value)


def record(page, url, payload: bytes, digest: str, refers_to) -> bytes:
    """The member of a page: the payload itself, or a revisit of the page that holds the same payload."""
    revisit = refers_to is not None
    block = b"" if revisit else payload
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page))]
    if url is not None:
        headers.append(("WARC-Target-URI", url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")))
    headers += [("WARC-Payload-Digest", "sha256:" + digest), ("X-Payload-Length", str(len(payload)))]
    headers.append(("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()))
    if revisit:
        headers += [("WARC-Refers-To", _urn(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    return member(headers, block)


def plan_records(df: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): which pages are stored and which revisit another.

    Of the rows with equal payloads of at least `least` bytes, those of the smallest id are stored and
    the others refer to it; a null id counts as larger than any. A null text is an empty payload. The
    smallest ids are combined before the shuffle, and only payloads that occur under several ids come
    out of it; the join back is on the digest, whose hot values adaptive execution splits.
    """
    rows = pick(df, page_id=id_col, url=url_col, html=text_col)
    rows = rows.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long = F.octet_length("payload") >= least
    firsts = rows.filter(long).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    joined = rows.join(firsts.filter("n > 1 and first is not null").drop("n"), "digest", "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def write_archives(planned: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the records of plan_records into .warc.gz files under `folder`; returns the manifest.

    Every task writes files of its own attempt, and only those the stored manifest names count: what a
    lost or repeated attempt left behind is never read. An empty table gives an empty manifest.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        name = f"{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        out, done, path, records, size = None, [], "", 0, 0
        for batch in batches:
            for page, url, payload, digest, refers in batch.itertuples(index=False, name=None):
                if out is None:
                    path, records, size = f"{root}/{name}-{len(done):04d}.warc.gz", 0, 0
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(path, compression=None)
                data = record(None if pd.isna(page) else int(page), url, payload, digest, None if pd.isna(refers) else int(refers))
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    done.append((path, records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, records, size))
        yield pd.DataFrame(done, columns=["archive", "records", "bytes"])

    ship(planned.sparkSession)
    exact = planned.select(
        F.col("page_id").cast("decimal(20,0)"), "url", "payload", "digest", F.col("refers_to").cast("decimal(20,0)")
    )  # as decimals, ids beside nulls don't turn into floats
    return write_stage(exact.mapInPandas(write, MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Every record of the manifest's archives, checked: RECORDS.

    Stored payloads are measured and hashed as read and must have the digest their head states; a
    record that does not hold stops the job. Files are read one after the other within a task.
    """
    names = RECORDS.split(", ")[: None if with_payload else -1]
    schema = pa.schema(
        [("archive", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string())]
        + [("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
        + [("payload", pa.binary())] * with_payload
    )

    def one(path: str, offset: int, content: bytes) -> tuple:
        headers, block = parse_record(content)
        revisit = headers["warc-type"] == "revisit"
        digest = headers["warc-payload-digest"].removeprefix("sha256:")
        length = int(headers["x-payload-length"]) if revisit else len(block)
        if not revisit and hashlib.sha256(block).hexdigest() != digest:
            raise DamagedArchive(f"{path} at {offset}: the payload does not have its digest")
        url = headers.get("warc-target-uri")
        url = url if url is None else url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
        row = (path, offset, _page(headers["warc-record-id"]), url, headers["warc-type"], _page(headers.get("warc-refers-to")), length, digest)
        return (*row, None if revisit else block) if with_payload else row

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, count in zip(batch.column("archive").to_pylist(), batch.column("records").to_pylist(), strict=True):
                rows, held, seen = [], 0, 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for offset, content in read_members(stream):
                        rows.append(one(path, offset, content))
                        held, seen = held + len(content), seen + 1
                        if held >= 4 << 20 or len(rows) >= 2000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                if seen != count:
                    raise DamagedArchive(f"{path} holds {seen} records, not {count}")

    ship(manifest.sparkSession)
    files = manifest.select("archive", "records")
    spread = files.repartition(max(1, min(4096, manifest.count())))
    return spread.mapInArrow(read, ", ".join(names))


def archive_round_trip(df: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """Write the pages into archives under the shared folder and read every record back (no payloads)."""
    folder = f"{work_folder(df.sparkSession)}/warc-{uuid.uuid4().hex}"
    manifest = write_archives(plan_records(df, id_col, url_col, text_col), folder)
    return read_archives(manifest, folder, with_payload=False)

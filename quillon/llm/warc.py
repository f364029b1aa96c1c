"""WARC archives with a Zstandard dictionary: written by Spark tasks, read back and checked.

An archive starts with a skippable frame that holds the dictionary, then has one frame for
each record. Records with equal payloads are written once: the one with the smallest page id
is a response, the others are revisits that name it and have its digest.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm.common import cut, shared_folder

#: Fixed by the format: the skippable frame of the dictionary and Zstandard's own frames.
DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

#: Payload bytes from which one archive's dictionary is trained, and the dictionary's size.
SAMPLE_BYTES, DICTIONARY_BYTES = 1 << 20, 16 << 10
#: Compressed bytes after which the next archive begins.
ARCHIVE_BYTES = 8 << 20
LEVEL = 3
#: Bytes that the reader hands to the decoder at once.
STEP = 16 << 10


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_value(text: str) -> str:
    """No line breaks or other control characters in a header."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record: an HTTP response, or a revisit with the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest_of(payload)}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The record's fields; ValueError where headers, lengths or the digest don't agree."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not mark or lines[0] != "WARC/1.1":
        raise ValueError("not a WARC/1.1 record")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not re.fullmatch(r"[!#$%&'*+.^_`|~0-9A-Za-z-]+", name) or name.lower() in fields:
            raise ValueError(f"bad header line {line!r}")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"):
        if name not in fields:
            raise ValueError(f"{name} is missing")
    if not fields["content-length"].isdigit() or int(fields["content-length"]) + 4 != len(rest) or not rest.endswith(b"\r\n\r\n"):
        raise ValueError("Content-Length and the block differ")
    http, mark, payload = rest[:-4].partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length: (\d+)\r?$", http)
    if not mark or not length:
        raise ValueError("no HTTP header in the block")
    n, digest = int(length[1]), fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != n or digest_of(payload) != digest):
        raise ValueError("the payload's length or digest differs")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise ValueError("a revisit has a payload or names no record")
    if kind not in ("response", "revisit"):
        raise ValueError(f"unexpected record type {kind}")

    def page(name: str) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+|none)>", fields.get(name, ""))
        if not found:
            raise ValueError(f"{name} names no page")
        return None if found[1] == "none" else int(found[1])

    return {"page_id": page("warc-record-id"), "url": fields.get("warc-target-uri"), "payload_bytes": n, "payload_digest": digest, "record_type": kind, "refers_to": page("warc-refers-to") if kind == "revisit" else None, "payload": payload if kind == "response" else None}


def dictionary_for(samples: list[bytes]) -> bytes:
    """Trained on the samples; where these are too few, the samples' own end."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


class Archive:
    """Builds one archive: the dictionary first, then a frame for each record."""

    def __init__(self, samples: list[bytes]):
        words = dictionary_for(samples)
        self.body = io.BytesIO()
        self.body.write(struct.pack("<II", DICTIONARY_MAGIC, len(words)) + words)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(words) if words else None, write_checksum=True)

    def add(self, raw: bytes) -> None:
        self.body.write(self.compressor.compress(raw))


def frames(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, one decoded frame each."""
    if len(archive) < 8:
        raise ValueError("the archive has no dictionary frame")
    magic, size = struct.unpack_from("<II", archive)
    if magic != DICTIONARY_MAGIC or 8 + size > len(archive):
        raise ValueError("the archive has no dictionary frame")
    words = archive[8 : 8 + size]
    if words[:4] == struct.pack("<I", FRAME_MAGIC):  # the format allows a compressed dictionary
        words = zstandard.ZstdDecompressor().decompress(words)
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words) if words else None)
    view, at = memoryview(archive), 8 + size
    while at < len(archive):
        one, out = decoder.decompressobj(), []
        while not one.eof:
            if at >= len(archive):
                raise ValueError("the last frame is cut short")
            piece = view[at : at + STEP]
            out.append(one.decompress(piece))
            at += len(piece) - len(one.unused_data)
        yield b"".join(out)


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Writes archives below folder and returns their manifest (path, records). A task's
    archives have names of its own attempt, and the manifest, kept as a table, lists those
    of the attempts that counted. Rows that repeat in page id and payload are all the
    smallest of their payload and all responses; null page ids come last; a null html is an
    empty payload; payloads under min_bytes are all responses."""
    known = pages.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    known = known.withColumn("dg", F.sha1(F.col("html").cast("binary")))
    # an id of null sorts after all others
    first = known.groupBy("dg").agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("id"))).alias("first")).withColumnRenamed("dg", "dg_first")
    rows = known.join(cut(first, "first"), F.col("dg") == F.col("dg_first")).select("page_id", "url", "html", F.col("first.id").alias("first_id"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context, done = TaskContext.get(), []
        filesystem, top = _filesystem(folder)
        filesystem.create_dir(top, recursive=True)
        archive, waiting, size, records = None, [], 0, 0

        def close() -> None:
            nonlocal archive, records
            if archive is not None:
                name = f"{top}/part-{context.partitionId():06d}-{context.taskAttemptId()}-{len(done):04d}-{uuid.uuid4().hex[:8]}.warc.zst"
                with filesystem.open_output_stream(name, compression=None) as out:
                    out.write(archive.body.getbuffer())
                done.append((name, records))
            archive, records = None, 0

        def flush() -> None:
            nonlocal archive, waiting, size, records
            for page_id, url, payload, first_id in waiting:
                if archive is None:
                    archive = Archive([w[2] for w in waiting if w[2]])
                revisit = len(payload) >= min_bytes and page_id != first_id
                archive.add(record(page_id, url, payload, first_id, revisit))
                records += 1
                if archive.body.tell() >= ARCHIVE_BYTES:
                    close()
            waiting, size = [], 0

        for batch in batches:
            for page_id, url, html, first_id in zip(batch["page_id"], batch["url"], batch["html"], batch["first_id"], strict=True):
                payload = html.encode("utf-8", "surrogatepass")
                waiting.append((None if pd.isna(page_id) else int(page_id), url if isinstance(url, str) else None, payload, None if pd.isna(first_id) else int(first_id)))
                size += len(payload)
                if size >= SAMPLE_BYTES:
                    flush()
        flush()
        close()
        yield pd.DataFrame(done, columns=["path", "records"])

    # ids as text: pandas would turn long ids beside nulls into doubles
    asked = rows.select(F.col("page_id").cast("string").alias("page_id"), "url", "html", F.col("first_id").cast("string").alias("first_id"))
    return cut(asked.mapInPandas(run, "path string, records bigint"), "manifest")


def read(spark: SparkSession, folder: str, manifest: DataFrame | None = None) -> DataFrame:
    """Every record of the archives below folder (of those in the manifest, if given):
    page_id, url, payload_bytes, payload_digest, record_type, refers_to and payload (null in
    a revisit). A record that breaks the format stops the job with its reason."""
    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").option("recursiveFileLookup", "true").load(folder)
    files = files.withColumn("name", F.element_at(F.split("path", "/"), -1))
    if manifest is not None:
        files = files.join(manifest.select(F.element_at(F.split("path", "/"), -1).alias("name")), "name", "left_semi")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows, size = [], 0
                for raw in frames(bytes(content)):
                    rows.append(parse(raw))
                    size += len(raw)
                    if size > 4 << 20:
                        yield _frame(rows)
                        rows, size = [], 0
                yield _frame(rows)

    return files.select("content").mapInPandas(run, schema)


def _frame(rows: list[dict]) -> pd.DataFrame:
    columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    out = pd.DataFrame(rows, columns=columns)
    return out.astype({"page_id": "Int64", "payload_bytes": "int64", "refers_to": "Int64"})


def round_trip(pages: DataFrame) -> DataFrame:
    """The contract's row for each page: written to archives in the shared folder and read
    back from there."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    manifest = write(pages.select("page_id", "url", "html"), folder)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    if manifest.isEmpty():
        return spark.createDataFrame([], "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")
    return read(spark, folder, manifest).select(*columns)

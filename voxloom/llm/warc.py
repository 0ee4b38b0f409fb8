"""WARC archives compressed with Zstandard, one frame per record.

An archive begins with a skippable frame that holds the dictionary of all its frames.
Archives are written by the tasks that hold the pages and named in a manifest table;
Spark commits a manifest row only for a task that ended well, so files of lost or
repeated tasks are named nowhere and never read. Records are streamed: a task holds
one record, and for a new archive the records its dictionary is made from.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import checked
from voxloom.session import as_lookup, cut_lineage, qualified
from voxloom.sources.corpus import open_files

#: Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ["WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"]

#: Payloads from this size on are written once; the others with the same payload revisit it.
MIN_REVISIT_BYTES = 0
#: Records, and their bytes, that an archive's dictionary is made from; its size.
SAMPLE_RECORDS = 256
SAMPLE_BYTES = 4 << 20
DICTIONARY_BYTES = 32 << 10
#: An archive is closed when it has this size.
ARCHIVE_BYTES = 256 << 20
DATE = "1970-01-01T00:00:00Z"
READ_BYTES = 1 << 20
BATCH_ROWS = 256
BATCH_BYTES = 8 << 20


class ArchiveError(ValueError):
    """An archive is not as it should be."""


def digest(data: bytes) -> str:
    """SHA-1 in base 32."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: str | None) -> str:
    return "<urn:voxloom:none>" if key is None else f"<urn:voxloom:page:{quote(key, safe='')}>"


def key_of(record: str) -> str | None:
    if record == "<urn:voxloom:none>":
        return None
    head = "<urn:voxloom:page:"
    if not (record.startswith(head) and record.endswith(">")):
        raise ArchiveError(f"not a record of a page: {record}")
    return unquote(record[len(head) : -1])


def record(key: str | None, url: str | None, payload: bytes, refers_to: str | None, date: str = DATE) -> bytes:
    """A response record, or a revisit of the record of ``refers_to``."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(key),
        "WARC-Date": date,
        "WARC-Payload-Digest": "sha1:" + digest(payload),
        "WARC-Block-Digest": "sha1:" + digest(block),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if url is not None:
        # White space and controls would break the header.
        fields["WARC-Target-URI"] = "".join(quote(c) if ord(c) <= 32 or ord(c) == 127 else c for c in url)
    if refers_to is not None:
        fields["WARC-Refers-To"] = record_id(refers_to)
        fields["WARC-Profile"] = REVISIT_PROFILE
    head = VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-cased name."""
    found = {}
    for line in head.decode("utf-8").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ArchiveError(f"not a header field: {line[:80]!r}")
        if name.lower() in found:
            raise ArchiveError(f"repeated header field: {name}")
        found[name.lower()] = value.strip()
    return found


def parsed(data: bytes) -> dict:
    """The validated parts of a record."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    version, _, fields = head.partition(b"\r\n")
    if not blank or not version.startswith(b"WARC/1."):
        raise ArchiveError(f"no record header: {data[:20]!r}")
    fields = _fields(fields)
    missing = [n for n in REQUIRED if n.lower() not in fields]
    if missing:
        raise ArchiveError(f"missing header fields: {', '.join(missing)}")
    length = fields["content-length"]
    if not (length.isascii() and length.isdigit()) or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ArchiveError(f"Content-Length {length} but {len(rest) - 4} bytes of block")
    block = rest[:-4]
    if fields.get("warc-block-digest", "sha1:" + digest(block)) != "sha1:" + digest(block):
        raise ArchiveError("the block is not that of its digest")
    kind = fields["warc-type"]
    http, blank, payload = block.partition(b"\r\n\r\n")
    if kind not in ("response", "revisit") or not blank:
        raise ArchiveError(f"not a response or revisit with HTTP header: {kind}")
    size = _fields(http.partition(b"\r\n")[2]).get("content-length", "")
    if not (size.isascii() and size.isdigit()):
        raise ArchiveError(f"no length of the payload: {size!r}")
    named = fields.get("warc-payload-digest", "")
    if kind == "response" and (int(size) != len(payload) or named != "sha1:" + digest(payload)):
        raise ArchiveError("the payload is not that of its length and digest")
    if kind == "revisit" and ("warc-refers-to" not in fields or payload):
        raise ArchiveError("a revisit names its response and has no payload")
    return {
        "key": key_of(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": key_of(fields["warc-refers-to"]) if kind == "revisit" else None,
        "payload_digest": named.removeprefix("sha1:"),
        "payload_bytes": int(size),
        "payload": payload if kind == "response" else None,
    }


def dictionary_of(samples: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict:
    """A trained dictionary, or the samples themselves where they are too few to train."""
    try:
        return zstandard.train_dictionary(size, samples)
    except zstandard.ZstdError:
        content = b"".join(samples)[:size]
        return zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class _Writer:
    """Writes records to archives of a folder; each closed one becomes a manifest row."""

    def __init__(self, folder: str, open_folder: Callable, archive_bytes: int):
        self.folder, self.archive_bytes = folder.rstrip("/"), archive_bytes
        self.fs, self.path = open_folder(self.folder)
        self.fs.create_dir(self.path, recursive=True)
        self.samples: list[bytes] = []
        self.sampled, self.out = 0, None
        self.closed: list[dict] = []

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.samples.append(data)
            self.sampled += len(data)
            if len(self.samples) >= SAMPLE_RECORDS or self.sampled >= SAMPLE_BYTES:
                self._begin()
            return
        self._frame(data)
        if self.bytes >= self.archive_bytes:
            self.close()

    def _begin(self) -> None:
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.out = self.fs.open_output_stream(f"{self.path}/{self.name}", compression=None)
        dictionary = dictionary_of(self.samples)
        content = dictionary.as_bytes()
        self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(content)) + content)
        self.compressor = zstandard.ZstdCompressor(dict_data=dictionary)
        self.records, self.bytes = 0, 8 + len(content)
        samples, self.samples, self.sampled = self.samples, [], 0
        for data in samples:
            self._frame(data)

    def _frame(self, data: bytes) -> None:
        frame = self.compressor.compress(data)
        self.out.write(frame)
        self.records += 1
        self.bytes += len(frame)

    def close(self) -> None:
        if self.out is None and self.samples:
            self._begin()
        if self.out is not None:
            self.out.close()
            self.out = None
            path = f"{self.folder}/{self.name}"
            self.closed.append({"path": path, "records": self.records, "bytes": self.bytes})


MANIFEST = "path string, records long, bytes long"


def write_archives(df: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url",
                   payload_column: str = "html", min_revisit_bytes: int = MIN_REVISIT_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES, open_folder: Callable = open_files) -> DataFrame:
    """Write a record for each row and return the manifest: path, records and bytes.

    Of the rows with one payload of at least ``min_revisit_bytes`` bytes, that with
    the smallest id is a response and the others revisit it; rows that share the
    smallest id are all responses. A null payload is empty. A null id is larger than
    any other, so null-id rows revisit one with an id, or else are responses. An
    empty table writes no archive. Other columns are not archived.
    """
    checked(df, id_column, url_column, payload_column)
    spark = df.sparkSession
    # Tasks open archives by themselves, so they have to know the file system.
    folder = qualified(spark, folder)
    key = F.col(f"`{id_column}`")
    rows = df.select(
        key.alias("id"),
        F.col(f"`{url_column}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{payload_column}`"), F.lit("")).alias("payload"),
    )
    long_enough = F.octet_length("payload") >= min_revisit_bytes
    sha = F.when(long_enough, F.sha1(F.col("payload").cast("binary")))
    first = F.min(F.struct(F.col("id").isNull().alias("n"), "id"))
    shared = rows.select("id", sha.alias("sha")).where("sha is not null").groupBy("sha")
    shared = shared.agg(first["id"].alias("first"), F.count(F.lit(1)).alias("rows"))
    shared = cut_lineage(spark, shared.where("rows > 1").drop("rows"), "shared_payloads")
    rows = rows.withColumn("sha", sha).join(as_lookup(shared, "shared_payloads"), "sha", "left")
    later = F.col("first").isNotNull() & (F.col("id").isNull() | (F.col("id") > F.col("first")))
    rows = rows.select(
        F.col("id").cast("string"), "url", "payload", F.when(later, F.col("first")).cast("string").alias("refers")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            columns = (batch.column(i) for i in (0, 1, 3))
            payloads = batch.column(2).cast(pa.large_binary())
            for k, url, refers, payload in zip(*columns, payloads, strict=True):
                writer = writer or _Writer(folder, open_folder, archive_bytes)
                writer.add(record(k.as_py(), url.as_py(), payload.as_py(), refers.as_py()))
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pylist(writer.closed)

    return cut_lineage(spark, rows.mapInArrow(write, MANIFEST), "manifest")


def frames(stream) -> Iterator[tuple[int, bytes]]:
    """Number and content of each frame after the dictionary's."""
    head = stream.read(8)
    if len(head) < 8 or struct.unpack("<I", head[:4])[0] != DICTIONARY_FRAME:
        raise ArchiveError("no dictionary frame at the beginning")
    size = struct.unpack("<I", head[4:])[0]
    content = stream.read(size)
    if len(content) < size:
        raise ArchiveError("the dictionary frame is cut off")
    if content.startswith(ZSTD_FRAME):
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
    number, rest = 0, stream.read(READ_BYTES)
    while rest:
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if not rest:
                raise ArchiveError(f"record {number} is cut off")
            try:
                parts.append(frame.decompress(rest))
            except zstandard.ZstdError as e:
                raise ArchiveError(f"record {number} is no frame: {e}") from e
            rest = b"" if frame.eof else stream.read(READ_BYTES)
        yield number, b"".join(parts)
        number, rest = number + 1, frame.unused_data or stream.read(READ_BYTES)


RECORDS = (
    "key string, url string, record_type string, refers_to string, payload_digest string, "
    "payload_bytes long, payload binary"
)
_RECORDS = pa.schema(
    [(n, pa.string()) for n in ("key", "url", "record_type", "refers_to", "payload_digest")]
    + [("payload_bytes", pa.int64()), ("payload", pa.binary())]
)


def read_archives(manifest: DataFrame, payloads: bool = True, open_folder: Callable = open_files) -> DataFrame:
    """The records of the archives that ``path`` names, validated; see ``RECORDS``.

    Keys are texts. A record that is not as its header says, or a cut-off archive,
    fails the job with the archive's name. Without ``payloads`` they are checked but
    not returned. Revisits have no payload.
    """
    checked(manifest, "path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, name = open_folder(path)
                with fs.open_input_stream(name, compression=None) as stream:
                    try:
                        for number, data in frames(stream):
                            row = parsed(data)
                            if not payloads:
                                row["payload"] = None
                            rows.append(row)
                            held += len(row["payload"] or b"") + 500
                            if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                                yield pa.RecordBatch.from_pylist(rows, schema=_RECORDS)
                                rows, held = [], 0
                    except ArchiveError as e:
                        raise ArchiveError(f"{path}: {e}") from e
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_RECORDS)

    archives = manifest.count()
    # Dealt row by row: a count of its own, which Spark does not merge for being small.
    return manifest.select("path").repartition(max(1, archives)).mapInArrow(read, RECORDS)


def digests(records: DataFrame, id_column: str, id_type: str) -> DataFrame:
    """What identifies each record, with ids of ``id_type`` again."""
    key: Column = F.col("key").cast(id_type)
    return records.select(
        key.alias(id_column), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(id_type).alias("refers_to"),
    )

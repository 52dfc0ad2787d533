"""WARC archives in Zstandard form, each with its own dictionary.

An archive starts with a skippable frame that holds the dictionary; every record
is a frame of its own, compressed with it.  Spark's text writer commits the files,
so a lost executor's archives are written again and never half kept: the bytes of
a frame pass as one line, and the line separator is an empty skippable frame,
which any Zstandard reader passes over.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsieve.session import shared_folder

#: Fixed values of the formats: skippable frames that hold a dictionary and that hold nothing, a dictionary's first bytes.
DICTIONARY_FRAME = b"\x5d\x2a\x4d\x18"
SEPARATOR = "\x50\x2a\x4d\x18\x00\x00\x00\x00"
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:docsieve:record:"

FRAME_SCHEMA = "frame binary"
RECORD_SCHEMA = (
    "record_type string, id bigint, url string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"
)


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Add ``refers_to``: the largest id with an equal payload, where that is not the row's own.

    ``pages`` has ``(id, url, payload, digest)``.  Only ids and digests are
    grouped; payloads move once, by id.  A digest that many rows share is counted
    before it is shuffled, and its join is split by adaptive execution.
    """
    narrow = pages.where(F.octet_length("payload") >= least_bytes).select("id", "digest").distinct()
    latest = narrow.groupBy("digest").agg(F.max("id").alias("latest"), F.count("*").alias("n")).where("n > 1").drop("n")
    revisits = narrow.join(latest, "digest").where("id < latest").select(
        F.col("id").alias("own_id"), F.col("digest").alias("own_digest"), F.col("latest").alias("refers_to")
    )
    same = (F.col("id") == F.col("own_id")) & (F.col("digest") == F.col("own_digest"))
    return pages.join(revisits, same, "left").select("id", "url", "payload", "digest", "refers_to")


def _lines(*fields: tuple[str, object]) -> bytes:
    out = [f"{name}: {value}\r\n" for name, value in fields if value is not None]
    return "".join(out).encode()


def _record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\n" + _lines(("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))) + b"\r\n"
    block = http if refers_to is not None else http + payload
    target = None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    head = _lines(
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{RECORD_ID}{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", None if refers_to is None else PROFILE),
        ("WARC-Refers-To", None if refers_to is None else f"<{RECORD_ID}{refers_to}>"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    )
    return b"WARC/1.1\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def _info(date: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    head = _lines(
        ("WARC-Type", "warcinfo"),
        ("WARC-Record-ID", f"<{RECORD_ID}info>"),
        ("WARC-Date", date),
        ("Content-Type", "application/warc-fields"),
        ("Content-Length", len(block)),
    )
    return b"WARC/1.1\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def train_dictionary(samples: list[bytes], size: int):
    """A dictionary from sample records; of few or tiny ones, their own bytes."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-size:] or b"WARC/1.1\r\n")


def _archive(batches: Iterator[pa.RecordBatch], sample_bytes: int, dictionary_bytes: int, level: int, date: str) -> Iterator[pa.RecordBatch]:
    """One task's rows as one archive; the dictionary is built from its first ``sample_bytes``."""
    import base64

    import zstandard

    waiting: list[bytes] | None = [_info(date)]
    held, compressor = 0, None

    def frames(records: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([compressor.compress(r) for r in records], pa.binary())], ["frame"])

    def begin() -> pa.RecordBatch:
        nonlocal compressor
        # A record longer than the dictionary's window teaches no more than its first part.
        dictionary = train_dictionary([r[: 16 * 1024] for r in waiting], dictionary_bytes)
        compressor = zstandard.ZstdCompressor(level=level, dict_data=dictionary)
        data = dictionary.as_bytes()
        return pa.RecordBatch.from_arrays([pa.array([DICTIONARY_FRAME + len(data).to_bytes(4, "little") + data], pa.binary())], ["frame"])

    empty = True
    for batch in batches:
        columns = [batch.column(i) for i in range(5)]
        for start in range(0, batch.num_rows, 256):
            rows = zip(*[c.slice(start, 256).to_pylist() for c in columns], strict=True)
            records = [_record(i, u, p, base64.b32encode(bytes.fromhex(d)).decode(), r, date) for i, u, p, d, r in rows]
            empty = False
            if compressor is not None:
                yield frames(records)
                continue
            waiting += records
            held += sum(map(len, records))
            if held >= sample_bytes:
                yield begin()
                yield frames(waiting)
                waiting = None
    if compressor is None and not empty:
        yield begin()
        yield frames(waiting)


def write_warc(
    pages: DataFrame,
    path: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
    sample_bytes: int = 1 << 20,
    dictionary_bytes: int = 32 << 10,
    level: int = 3,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write a record for every row into Zstandard WARC archives under ``path``, one archive per task.

    Of rows with equal payloads of at least ``least_bytes`` bytes, the one with
    the largest id is a response and the others revisit it (rows that repeat that
    id are responses too); rows with a null id are responses.  A null payload is
    empty, a null URL gives no target header, line ends in a URL are escaped.  An
    archive's dictionary is built from its first ``sample_bytes`` of records, in
    the task; nothing else is held back, so memory does not grow with the archive.
    An empty table writes no archive.  Other columns are ignored.
    """
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    complete = with_revisits(rows.withColumn("digest", F.sha1("payload")), least_bytes)

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _archive(batches, sample_bytes, dictionary_bytes, level, date)

    frames = complete.mapInArrow(archive, FRAME_SCHEMA)
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR).text(path)


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n") if ": " in line)


def _number(name: str | None) -> int | None:
    digits = (name or "").strip("<>").removeprefix(RECORD_ID)
    return int(digits) if digits.lstrip("-").isdigit() else None


def parse_archive(content: bytes) -> Iterator[bytes]:
    """The records of one archive, decompressed with its dictionary, one at a time."""
    import zstandard

    view, at, reader = memoryview(content), 0, zstandard.ZstdDecompressor()
    while at < len(view):
        magic = bytes(view[at : at + 4])
        if magic == DICTIONARY_FRAME or (magic[1:] == b"\x2a\x4d\x18" and 0x50 <= magic[0] <= 0x5F):
            size = int.from_bytes(view[at + 4 : at + 8], "little")
            if magic == DICTIONARY_FRAME:
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(view[at + 8 : at + 8 + size])))
            at += 8 + size
            continue
        frame = reader.decompressobj()
        parts, step = [], 1 << 16
        while not frame.eof:
            if at >= len(view):
                raise ValueError("the archive ends inside a record")
            parts.append(frame.decompress(view[at : at + step]))
            at += step
        at = min(at, len(view)) - len(frame.unused_data) if frame.unused_data else min(at, len(view))
        yield b"".join(parts)


def _rows(content: bytes, with_payload: bool) -> Iterator[tuple]:
    import base64
    import hashlib

    for record in parse_archive(content):
        head, _, block = record.partition(b"\r\n\r\n")
        fields = _fields(head)
        if fields["WARC-Type"] not in ("response", "revisit"):
            continue
        block = block[: int(fields["Content-Length"])]
        http, _, payload = block.partition(b"\r\n\r\n")
        url = fields.get("WARC-Target-URI")
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if fields["WARC-Type"] == "response":
            size = len(payload)
            if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError(f"record {fields['WARC-Record-ID']} does not match its digest")
        else:
            size = int(_fields(http)["Content-Length"])
        yield (
            fields["WARC-Type"],
            _number(fields["WARC-Record-ID"]),
            url,
            size,
            digest,
            _number(fields.get("WARC-Refers-To")),
            payload if with_payload and fields["WARC-Type"] == "response" else None,
        )


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records under ``path``: ``(record_type, id, url, payload_bytes, payload_digest, refers_to, payload)``.

    Payloads of responses are checked against their digests.  A revisit has no
    payload; its size and digest are those of the payload it repeats.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = ["record_type", "id", "url", "payload_bytes", "payload_digest", "refers_to", "payload"]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

        for contents in batches:
            for content in contents.column(0):
                rows = []
                for row in _rows(content.as_py(), with_payload):
                    rows.append(row)
                    if len(rows) == 500:
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    return files.mapInArrow(parse, RECORD_SCHEMA)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives in the folder that all executors share."""
    return f"{shared_folder(spark)}/docsieve-archives/{uuid.uuid4().hex}"

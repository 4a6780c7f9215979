"""Operator 12: dictionary-compressed WARC archives, written and read with Spark.

``write_archives`` writes a WARC record for every row: a response with the payload, or a revisit that
refers to the response with the same payload. A Zstandard dictionary is built from a bounded sample of the
records to be archived; each archive begins with a skippable frame (0x184D2A5D) that holds it, then
come a warcinfo record and the rows' records, each compressed by itself with the dictionary.

The files are written by Spark's text writer, on any file system that Spark writes, and so keep its commit
protocol: a task that is lost or run twice leaves one file. The line feed that this writer puts after each row
is the one byte of a skippable frame whose header ends the row, so a file is a plain sequence of
Zstandard frames. ``read_archives`` reads any such file (dictionary plain or itself compressed, or none).

* Equal payloads are found by SHA-256 with a group-by over narrow rows. Payloads shared by more than 1/1000 of
  all rows (fewer than 1000) are broadcast, and their revisits lose the payload before the shuffle; the
  others meet their group in the one shuffle that also deals the records to the archives.
* The number of archives follows the bytes of all payloads (``archive_bytes`` before compression, and at least one a
  shuffle partition), so that a reader holds a bounded file; the sample for the dictionary holds about
  ``SAMPLE`` records of at most ``SAMPLE_BYTES`` together, and is no limit to what is archived.

Edge cases: a null payload is an empty one. Payloads under ``min_bytes`` are always responses. Rows that tie on the
largest id, and rows of a group without any id, are all responses. A null or odd url is left out or percent-
encoded. With too few samples for a dictionary the archives have none. Empty table: no record. Other columns are
not read. A damaged archive gives a row with ``problem`` instead of its remaining records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from castwright.llm.common import join_groups
from castwright.session import materialize

DICTIONARY_MAGIC = 0x184D2A5D
SPACER_MAGIC = 0x184D2A50
#: Header of a skippable frame of one byte: the line feed that follows every row.
SPACER = struct.pack("<II", SPACER_MAGIC, 1)
ARCHIVE_BYTES = 64 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE = 2000
SAMPLE_BYTES = 8 << 20
LEVEL = 3
WINDOW = 1 << 15
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE = uuid.UUID("6f1e2f0a-7c3a-5d0b-9a55-3c1f4b0f7d21")

_ODD = re.compile(r"[\x00-\x20\x7f]")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(id_: str | None, digest: str) -> str:
    """The record id of a row, the same in every run: of its id and its payload's digest."""
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{id_}/{digest}')}>"


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [f"{name}: {value}" for name, value in [*fields, ("Content-Length", str(len(block)))] if value is not None]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def row_record(id_: str | None, url: str | None, digest: str, n_bytes: int, payload: bytes | None, refers_to: str | None, date: str = DATE) -> bytes:
    """A response (``payload``) or a revisit (``refers_to``: the id of the row that has the payload)."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    again = refers_to is not None
    uri = None if url is None else _ODD.sub(lambda m: f"%{ord(m[0]):02X}", url)
    block = head if again else head + (payload or b"")
    return _record([
        ("WARC-Type", "revisit" if again else "response"),
        ("WARC-Record-ID", record_id(id_, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", uri),
        ("WARC-Profile", PROFILE if again else None),
        ("WARC-Refers-To", record_id(refers_to, digest) if again else None),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("X-Row-Id", id_),
        ("X-Refers-To-Row-Id", refers_to),
        ("Content-Type", "application/http; msgtype=response"),
    ], block)


def info_record(date: str = DATE) -> bytes:
    block = b"software: castwright\r\nformat: WARC File Format 1.1\r\n"
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(SPACE, date)}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")]
    return _record(fields, block)


def train(records: list[bytes], size: int = DICTIONARY_BYTES) -> bytes | None:
    """A Zstandard dictionary of the records; None where they are too few or too small for one."""
    distinct = list(dict.fromkeys(records))
    if len(distinct) < 16 or sum(map(len, distinct)) < 4 * 1024:
        return None
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, distinct)) // 8), distinct, k=1024, d=8).as_bytes()
    except zstandard.ZstdError:
        return None


class Writer:
    """Rows of one archive: every one a frame and the header of the spacer that follows it."""

    def __init__(self, dictionary: bytes | None, level: int = LEVEL):
        self.dictionary = dictionary
        data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_FULLDICT) if dictionary else None
        if data:
            data.precompute_compress(level=level)
        self.compress = zstandard.ZstdCompressor(level=level, dict_data=data, write_checksum=True).compress

    def start(self, date: str = DATE) -> list[bytes]:
        """The first rows of an archive: the dictionary's frame and the warcinfo record."""
        held = [struct.pack("<II", DICTIONARY_MAGIC, len(self.dictionary)) + self.dictionary + SPACER] if self.dictionary else []
        return [*held, self.row(info_record(date))]

    def row(self, record: bytes) -> bytes:
        return self.compress(record) + SPACER


def records(data: bytes):
    """The decompressed records of an archive, one frame after another."""
    view, at = memoryview(data), 0
    plain = reader = zstandard.ZstdDecompressor()
    while at < len(view):
        magic, size = struct.unpack_from("<II", view, at) if len(view) - at >= 8 else (0, 0)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if at + 8 + size > len(view):
                raise ValueError("skippable frame cut off")
            if magic == DICTIONARY_MAGIC and at == 0:
                raw = bytes(view[8 : 8 + size])
                raw = plain.decompressobj().decompress(raw) if raw[:4] == zstandard.FRAME_HEADER else raw
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_FULLDICT))
            at += 8 + size
            continue
        one, parts = reader.decompressobj(), []
        while not one.eof:
            window = view[at : at + WINDOW]
            if not len(window):
                raise ValueError("record cut off")
            parts.append(one.decompress(window))
            at += len(window) - len(one.unused_data)
        yield b"".join(parts)


FIELDS = ("record_type", "row_id", "uri", "record_id", "refers_to_id", "refers_to_row", "payload_digest", "payload_bytes", "payload", "problem")
SCHEMA = ", ".join(f"{f} {'long' if f == 'payload_bytes' else 'binary' if f == 'payload' else 'string'}" for f in FIELDS)


def parse(record: bytes) -> dict:
    """Fields of a record; digests and sizes of a response are those of the payload that it holds."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    named = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(named.get("content-length", 0))]
    out = dict.fromkeys(FIELDS)
    out |= {"record_type": named.get("warc-type"), "row_id": named.get("x-row-id"), "uri": named.get("warc-target-uri"), "record_id": named.get("warc-record-id"),
            "refers_to_id": named.get("warc-refers-to"), "refers_to_row": named.get("x-refers-to-row-id")}
    written = named.get("warc-payload-digest", "").removeprefix("sha1:") or None
    http, _, payload = block.partition(b"\r\n\r\n")
    if out["record_type"] == "response":
        out |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": base32_sha1(payload)}
        if written is not None and written != out["payload_digest"]:
            out["problem"] = "payload digest differs"
    elif out["record_type"] == "revisit":
        size = re.search(rb"(?im)^content-length:\s*(\d+)", http)
        out |= {"payload_digest": written, "payload_bytes": int(size[1]) if size else None}
    if not lines[0].startswith("WARC/"):
        out["problem"] = "not a WARC record"
    elif "warc-block-digest" in named and named["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
        out["problem"] = "block digest differs"
    return out


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of all archives under ``path``: type, ids, uri, digest, size and (on request) payload."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                try:
                    for record in records(content.as_buffer()):
                        rows.append(parse(record) | ({} if payload else {"payload": None}))
                        held += len(record) if payload else 0
                        if held > WINDOW * 256 or len(rows) >= 1000:
                            yield as_batch(rows)
                            rows, held = [], 0
                except (ValueError, zstandard.ZstdError) as error:
                    rows.append(dict.fromkeys(FIELDS) | {"problem": str(error)})
                yield as_batch(rows)

    def as_batch(rows):
        kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array([r[f] for r in rows], kinds.get(f, pa.string())) for f in FIELDS], names=list(FIELDS))

    return files.mapInArrow(run, SCHEMA)


def _dictionary(rows: DataFrame, n_rows: int, size: int) -> bytes | None:
    """Dictionary from a hash sample of about SAMPLE records, built in one task; only it comes back."""
    taken = rows.where(F.pmod(F.xxhash64("id", "url", "sha1"), F.lit(max(1, n_rows // SAMPLE))) == 0)
    small = taken.where(F.length("payload") <= SAMPLE_BYTES // 32).repartition(1)

    def run(batches):
        held, total = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                record = row_record(row["id"], row["url"], row["sha1"], row["n_bytes"], row["payload"], None)
                if total + len(record) <= SAMPLE_BYTES:
                    held.append(record)
                    total += len(record)
        yield pa.RecordBatch.from_arrays([pa.array([train(held, size)], pa.binary())], names=["dictionary"])

    made = small.select("id", "url", "sha1", "n_bytes", "payload").mapInArrow(run, "dictionary binary").first()
    return None if made is None or made[0] is None else bytes(made[0])


def write_archives(df: DataFrame, path: str, id_: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0, date: str = DATE,
                   archive_bytes: int = ARCHIVE_BYTES, dictionary_bytes: int = DICTIONARY_BYTES, level: int = LEVEL) -> None:
    """Write a record for every row to archives in the folder ``path`` (see the module's text)."""
    spark = df.sparkSession
    body = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    rows = df.select(F.col(f"`{id_}`").alias("key"), F.col(f"`{id_}`").cast("string").alias("id"), F.col(f"`{url}`").cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumns({"sha256": F.sha2("payload", 256), "sha1": F.sha1("payload"), "n_bytes": F.octet_length("payload").cast("long")})
    groups = materialize(rows.groupBy("sha256").agg(F.max("key").alias("keeper"), F.count(F.lit(1)).alias("n"), F.max("n_bytes").alias("each")), "payload-groups")
    n_rows, n_bytes = groups.agg(F.sum("n"), F.sum(F.col("n") * F.col("each"))).first()
    archives = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(n_bytes or 0) // archive_bytes))
    dictionary = _dictionary(rows, n_rows or 0, dictionary_bytes)

    def again(keeper):
        return (F.col("n_bytes") >= min_bytes) & keeper.isNotNull() & ~F.col("key").eqNullSafe(keeper)

    def early(held, hot, cols):
        return held.withColumn("payload", F.when(hot & again(cols["keeper"]), None).otherwise(F.col("payload")))

    met = join_groups(rows, groups, {"sha256": "sha256"}, "n", ["keeper"], F.xxhash64("id", "url"), archives, early)
    met = met.withColumn("refers_to", F.when(again(F.col("keeper")), F.col("keeper").cast("string")))
    met = met.select("id", "url", "sha1", "n_bytes", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "refers_to")

    def run(batches):
        writer = None
        for batch in batches:
            made = []
            if writer is None and batch.num_rows:
                writer = Writer(dictionary, level)
                made += writer.start(date)
            for r in batch.to_pylist():
                digest = base64.b32encode(bytes.fromhex(r["sha1"])).decode()
                made.append(writer.row(row_record(r["id"], r["url"], digest, r["n_bytes"], r["payload"], r["refers_to"], date)))
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["frame"])

    met.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value")).write.option("lineSep", "\n").text(path)


def archive_and_read(df: DataFrame, path: str, id_: str = "page_id", payload: bool = True, **options) -> DataFrame:
    """Write the archives of ``df`` and read their response and revisit records back; ``id_`` and
    ``refers_to`` have the type of the id column."""
    write_archives(df, path, id_, **options)
    kind = dict(df.dtypes)[id_]
    back = read_archives(df.sparkSession, path, payload).where("record_type IN ('response', 'revisit') OR problem IS NOT NULL")
    own, refers = F.col("row_id").cast(kind).alias(id_), F.col("refers_to_row").cast(kind).alias("refers_to")
    return back.select(own, "uri", "record_type", "payload_digest", "payload_bytes", refers, "payload", "problem")

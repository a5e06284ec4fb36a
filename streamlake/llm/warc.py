"""WARC archives with a Zstandard dictionary, written and read by Spark.

Every task writes archives (``.warc.zst``) of the rows it scans. An archive
starts with a skippable frame (magic 0x184D2A5D) that holds a dictionary built
from the archive's own records; every record is a frame of its own, compressed
with that dictionary, so one record can be read by its offset. The dictionary
is fitted on whole records, every k-th one, ``SAMPLE_BYTES`` at most (a model's
bounded sample: it changes sizes, never content); an archive with too few
records to fit one carries none, as the format allows.

Of rows with equal payloads (by SHA-256) one becomes the response and the others
revisit records that refer to it. Payloads stay with the task that scans them:
digests are grouped as narrow rows, and a revisit learns of its response by its
position in the input (``marks``). A task buffers one archive's records.

Records carry the row's id as ``Page-ID`` and, in revisits, the response's as
``Refers-To-Page-ID``, beside the record ids of the standard fields.

Archives are named by task and number and moved into place when complete, so a
task that runs again replaces its own files. ``read`` returns every record of a
folder, with its offset and length, and recomputes digests from the payloads.

Defined results: a null payload is an empty one; a null url leaves its field
out, control characters and spaces in urls are percent-encoded; null ids are
carried (the response of a group is the row with the largest id, null smallest;
of equal ids the last by position); repeated rows are records of their own; an
empty table gives no archive; other columns are ignored. A payload shorter than
``least`` bytes is always a response.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import marks
from .common import table_folder, write_table

SKIPPABLE = 0x184D2A5D  # the frame that holds the dictionary
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVE_BYTES = 32 << 20  # of uncompressed records
DICTIONARY_BYTES = 32 << 10
SAMPLE_BYTES = 100 * DICTIONARY_BYTES
LEVEL = 6
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the standard's namespace for URLs


def digest(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record_id(file: str, at: int) -> str:
    """Stable for a row of an input file."""
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{file}/{at}')}>"


def _encoded(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)


def record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def http_block(size: int, payload: bytes | None) -> bytes:
    """A response's block; of a revisit only the header, which keeps the full size."""
    return (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            + f"Content-Length: {size}\r\n\r\n".encode() + (payload or b""))


def dictionary(records: list[bytes], size: int = DICTIONARY_BYTES,
               sample: int = SAMPLE_BYTES) -> zstandard.ZstdCompressionDict | None:
    """A dictionary fitted on every k-th record, or none if they are too few."""
    step = max(1, -(-sum(map(len, records)) // sample))
    chosen, held = [], 0
    for r in records[::step]:
        if len(r) <= sample // 8:
            chosen.append(r)
            held += len(r)
            if held >= sample:
                break
    if held < 4 * size:
        size = max(held // 8, 256)
    try:
        return zstandard.train_dictionary(size, chosen, threads=0) if len(chosen) >= 8 else None
    except zstandard.ZstdError:  # too little in common
        return None


def archive(records: list[bytes], level: int = LEVEL) -> bytes:
    """The bytes of an archive: dictionary frame, then a frame per record."""
    fitted = dictionary(records)
    out = io.BytesIO()
    if fitted is not None:
        content = zstandard.ZstdCompressor(level=level).compress(fitted.as_bytes())
        out.write(SKIPPABLE.to_bytes(4, "little") + len(content).to_bytes(4, "little") + content)
        fitted.precompute_compress(level=level)
        packer = zstandard.ZstdCompressor(dict_data=fitted, write_checksum=True)
    else:
        packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
    for r in records:
        out.write(packer.compress(r))
    return out.getvalue()


def frames(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, compressed length and content of every record of an archive."""
    at, fitted = 0, None
    if data[:4] == SKIPPABLE.to_bytes(4, "little"):
        size = int.from_bytes(data[4:8], "little")
        content = data[8:8 + size]
        if content[:4] == b"\x28\xb5\x2f\xfd":  # itself compressed
            content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        fitted, at = zstandard.ZstdCompressionDict(content), 8 + size
    reader = zstandard.ZstdDecompressor(dict_data=fitted) if fitted else zstandard.ZstdDecompressor()
    view = memoryview(data)
    while at < len(data):
        one, parts, end = reader.decompressobj(), [], at
        while not one.eof:
            if end >= len(data):
                raise ValueError("the archive ends inside a record")
            piece = view[end:end + 16384]
            parts.append(one.decompress(piece))
            end += len(piece)
        end -= len(one.unused_data)
        yield at, end - at, b"".join(parts)
        at = end


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields (lower-case names) and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length does not fit its block")
    return fields, rest[:size]


def _revisits(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least: int) -> DataFrame:
    """``file, at`` of the rows that are revisits, with the response's
    ``to_id, to_url, to_file, to_at``."""
    rows = marks.placed(pages).select("file", "at", F.col(f"row.{id_col}").alias("id"),
                                      F.col(f"row.{url_col}").cast("string").alias("url"),
                                      F.coalesce(F.col(f"row.{payload_col}").cast("binary"), F.lit(b"")).alias("payload"))
    seen = write_table(rows.filter(F.octet_length("payload") >= least)
                       .select("file", "at", "id", "url", F.unhex(F.sha2("payload", 256)).alias("sha")), "warc-payloads")
    of = (seen.groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "file", "at", "url")).alias("to"))
          .filter("n > 1").select("sha", "to"))
    return (seen.select("file", "at", "sha").join(of, "sha")
            .filter("file != to.file or at != to.at")
            .select("file", "at", F.col("to.id").alias("to_id"), F.col("to.url").alias("to_url"),
                    F.col("to.file").alias("to_file"), F.col("to.at").alias("to_at")))


def write(pages: DataFrame, folder: str | None = None, least: int = 0, date: str = "1970-01-01T00:00:00Z",
          archive_bytes: int = ARCHIVE_BYTES, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html") -> tuple[str, DataFrame]:
    """Write the archives of ``pages`` below ``folder`` (shared by all
    executors; a new one in the checkpoint folder if null) and return it with
    one row per archive: ``path, records, raw_bytes, bytes, dictionary_bytes``."""
    folder = folder or table_folder(pages.sparkSession, "warc")
    pages = marks.scan(pages, "warc-pages")
    again = marks.save(_revisits(pages, id_col, url_col, payload_col, least), "warc-revisits")
    body = F.coalesce(F.col(f"row.{payload_col}").cast("binary"), F.lit(b""))
    rows = (marks.placed(pages).withColumn("to", again.of(F.col("file"), F.col("at")))
            .select("file", "at", F.col(f"row.{id_col}").cast("string").alias("id"),
                    F.col(f"row.{url_col}").cast("string").alias("url"), F.unhex(F.sha1(body)).alias("sha1"),
                    F.octet_length(body).cast("long").alias("size"),
                    F.when(F.col("to").isNull(), body).alias("payload"),
                    F.col("to.to_id").cast("string").alias("to_id"), "to.to_url", "to.to_file", "to.to_at"))

    def one(r: dict) -> bytes:
        block, own = http_block(r["size"], r["payload"]), record_id(r["file"], r["at"])
        shared = [("WARC-Record-ID", own), ("WARC-Date", date),
                  ("WARC-Target-URI", None if r["url"] is None else _encoded(r["url"])),
                  ("WARC-Payload-Digest", "sha1:" + digest(r["sha1"])),
                  ("WARC-Block-Digest", "sha1:" + digest(hashlib.sha1(block).digest())),
                  ("Content-Type", "application/http; msgtype=response"), ("Page-ID", r["id"])]
        if r["payload"] is not None:
            return record([("WARC-Type", "response"), *shared], block)
        return record([("WARC-Type", "revisit"), *shared, ("WARC-Profile", PROFILE),
                       ("WARC-Refers-To", record_id(r["to_file"], r["to_at"])),
                       ("WARC-Refers-To-Target-URI", None if r["to_url"] is None else _encoded(r["to_url"])),
                       ("WARC-Refers-To-Date", date), ("Refers-To-Page-ID", r["to_id"])], block)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = marks.filesystem(folder)
        store.create_dir(path, recursive=True)
        task, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            data = archive(held)
            name = f"part-{task:06d}-{number:06d}.warc.zst"
            draft = f"{path}/_{uuid.uuid4().hex}"
            with store.open_output_stream(draft) as out:
                out.write(data)
            if store.type_name != "local" and store.get_file_info(f"{path}/{name}").is_file:
                store.delete_file(f"{path}/{name}")  # other stores don't replace on a move
            store.move(draft, f"{path}/{name}")
            leading = 8 + int.from_bytes(data[4:8], "little") if data[:4] == SKIPPABLE.to_bytes(4, "little") else 0
            return pa.RecordBatch.from_pylist([{"path": name, "records": len(held), "raw_bytes": size,
                                                "bytes": len(data), "dictionary_bytes": leading}])

        for batch in batches:
            for k in range(batch.num_rows):
                text = one({n: batch.column(c)[k].as_py() for c, n in enumerate(batch.schema.names)})
                held.append(text)
                size += len(text)
                if size >= archive_bytes:
                    yield flush()
                    held, size, number = [], 0, number + 1
        if held:
            yield flush()

    listed = rows.mapInArrow(written, "path string, records long, raw_bytes long, bytes long, dictionary_bytes long")
    return folder, write_table(listed, "warc-archives")


def read(spark: SparkSession, folder: str, id_type: str = "long", payloads: bool = True) -> DataFrame:
    """Every record of the archives in ``folder``: ``archive, offset, length,
    record_type, record_id, id, url, payload_bytes, payload_digest, refers_to,
    refers_to_id, intact`` (digests fit) and ``payload`` (null for a revisit).
    Sizes and digests of responses are those of the payload read."""
    fields = ("archive string, offset long, length long, record_type string, record_id string, id string, url string, "
              "payload_bytes long, payload_digest string, refers_to string, refers_to_id string, intact boolean"
              + (", payload binary" if payloads else ""))
    kinds = marks.to_arrow_schema(fields)

    def records(path: str, data: bytes) -> Iterator[dict]:
        for offset, length, text in frames(data):
            f, block = parse(text)
            head, _, payload = block.partition(b"\r\n\r\n")
            stated = int(next(x for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))[15:])
            whole = f["warc-type"] == "response"
            own = "sha1:" + digest(hashlib.sha1(payload).digest()) if whole else f["warc-payload-digest"]
            yield {"archive": path, "offset": offset, "length": length, "record_type": f["warc-type"],
                   "record_id": f["warc-record-id"], "id": f.get("page-id"), "url": f.get("warc-target-uri"),
                   "payload_bytes": len(payload) if whole else stated, "payload_digest": own[5:],
                   "refers_to": f.get("warc-refers-to"), "refers_to_id": f.get("refers-to-page-id"),
                   "intact": own == f["warc-payload-digest"] and (not whole or stated == len(payload))
                   and f["warc-block-digest"] == "sha1:" + digest(hashlib.sha1(block).digest()),
                   **({"payload": payload if whole else None} if payloads else {})}

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                held, size = [], 0
                for r in records(batch.column(0)[k].as_py(), batch.column(1)[k].as_py()):
                    held.append(r)
                    size += r["payload_bytes"] if payloads else 100
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_pylist(held, schema=kinds)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=kinds)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return (files.select("path", "content").mapInArrow(opened, fields)
            .withColumn("id", F.col("id").cast(id_type)).withColumn("refers_to_id", F.col("refers_to_id").cast(id_type)))


def archived(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) and read back, one row per page:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    spark, kind = pages.sparkSession, pages.schema["page_id"].dataType.simpleString()
    folder, listed = write(pages, least=least)
    if listed.isEmpty():
        return spark.createDataFrame([], f"page_id {kind}, payload_bytes long, payload_digest string, "
                                         f"record_type string, refers_to {kind}, intact boolean")
    return read(spark, folder, kind, payloads=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to_id").alias("refers_to"), "intact")

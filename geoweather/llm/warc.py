"""WARC records in seekable Zstandard bundles.

Each page becomes a WARC/1.1 record.  Of records with equal payloads (at least
``MIN_PAYLOAD`` bytes), the one with the largest page_id is a response; the others are
revisits that name it and carry no payload.  Records are grouped into independent Zstandard frames
of about ``FRAME_BYTES``; a bundle is a run of frames and, as a skippable frame at its
end, the seek table (compressed and decompressed size of each frame).  An index maps a
record identifier to bundle, frame and offset within the decompressed frame, so one record
is read by decompressing one frame.

Bundles are rows of a table (bundle, data, index) under the cluster's shared folder, which any
store that Spark writes to can hold; ``data`` is the whole file, and ``export_bundles`` writes
such files to a folder.

Null html is an empty payload, null url gives no target URI, null page_id the identifier
``null``.  Rows that repeat the response's page_id and payload are responses too.  An empty
table gives no bundle and an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoweather.llm.common import stage, table

MIN_PAYLOAD = 0
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 8 << 20  # of compressed frames
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the seekable format: skippable frame, and the magic number that ends the seek table.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

BUNDLES = "bundle string, data binary, index array<struct<record:string,frame:int,first:bigint,size:bigint>>"
RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def record_id(page_id: int | None) -> str:
    return f"urn:page:{'null' if page_id is None else page_id}"


def page_of(record: str) -> int | None:
    number = record.rpartition(":")[2]
    return None if number == "null" else int(number)


def one_line(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in value or "\n" in value else value


def write_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP header, which tells the payload's length."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id(page_id)}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {one_line(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_id(refers_to)}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def headers(data: bytes, first: int) -> tuple[dict[str, str], int]:
    """Header fields from ``first`` on (names in lower case), and where the body starts."""
    end = data.index(b"\r\n\r\n", first)
    lines = data[first:end].decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}, end + 4


def read_record(data: bytes, first: int) -> tuple[dict[str, str], dict[str, str], bytes, int]:
    """(WARC fields, HTTP fields, payload stored, where the next record starts)."""
    fields, body = headers(data, first)
    end = body + int(fields["content-length"])
    http, start = headers(data, body)
    return fields, http, data[start:end], end + 4


def pack(frames: list[tuple[bytes, int]]) -> bytes:
    """Frames (compressed, decompressed size) and the seek table behind them."""
    entries = b"".join(struct.pack("<II", len(c), n) for c, n in frames)
    table_ = entries + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return b"".join(c for c, _ in frames) + struct.pack("<II", SKIPPABLE, len(table_)) + table_


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, decompressed size) of each frame, from the end of the bundle."""
    count, flags, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE or flags:
        raise ValueError("not a seekable bundle")
    out, at = [], 0
    for c, n in struct.iter_unpack("<II", data[-9 - 8 * count : -9]):
        out.append((at, c, n))
        at += c
    return out


def frame(data: bytes, entry: tuple[int, int, int]) -> bytes:
    at, size, whole = entry
    return zstandard.ZstdDecompressor().decompress(data[at : at + size], max_output_size=whole) if whole else b""


def assign_records(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """(page_id, url, html, refers_to): refers_to is null for responses."""
    p = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("digest", F.sha2("html", 256))
    long = F.octet_length("html") >= min_payload
    groups = p.where(long).groupBy("digest").agg(F.max("page_id").alias("newest"), F.count("*").alias("n"))
    groups = groups.where("n > 1").select(F.col("digest").alias("same"), "newest")
    joined = p.join(groups, (p["digest"] == groups["same"]) & long, "left")
    revisit = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    return joined.select("page_id", "url", "html", F.when(revisit, F.col("newest")).alias("refers_to"))


def _write(batches):
    part, number = TaskContext.get().partitionId(), 0
    squeeze = zstandard.ZstdCompressor(level=LEVEL)
    frames, index, records, size, packed = [], [], [], 0, 0

    def close_frame():
        nonlocal records, size, packed
        if records:
            frames.append((squeeze.compress(b"".join(records)), size))
            packed += len(frames[-1][0])
            records, size = [], 0

    def close_bundle():
        nonlocal frames, index, number, packed
        out = {"bundle": f"part-{part:06d}-{number:06d}.warc.zst", "data": pack(frames), "index": index}
        frames, index, number, packed = [], [], number + 1, 0
        return pa.RecordBatch.from_arrays(
            [pa.array([out["bundle"]]), pa.array([out["data"]], pa.binary()), pa.array([out["index"]], index_type)], names=list(out)
        )

    index_type = pa.list_(pa.struct([("record", pa.string()), ("frame", pa.int32()), ("first", pa.int64()), ("size", pa.int64())]))
    for batch in batches:
        for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            record = write_record(page_id, url, html.encode("utf-8", "surrogatepass"), refers_to)
            index.append({"record": record_id(page_id), "frame": len(frames), "first": size, "size": len(record)})
            records.append(record)
            size += len(record)
            if size >= FRAME_BYTES:
                close_frame()
                if packed >= BUNDLE_BYTES:
                    yield close_bundle()
    close_frame()
    if frames:
        yield close_bundle()


def write_bundles(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Write all pages; the table of bundles (columns of BUNDLES), already stored."""
    return stage(assign_records(pages, min_payload).mapInArrow(_write, BUNDLES), "warc-bundles")


def record_index(bundles: DataFrame) -> DataFrame:
    """(record, bundle, frame, first, size) of every record."""
    return bundles.select("bundle", F.explode("index").alias("i")).select("i.record", "bundle", "i.frame", "i.first", "i.size")


def described(fields: dict[str, str], http: dict[str, str], payload: bytes) -> tuple:
    """A row of RECORDS; a response's payload must agree with its digest."""
    digest = fields["warc-payload-digest"].partition(":")[2]
    revisit = fields["warc-type"] == "revisit"
    if not revisit and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload of {fields['warc-record-id']} does not have its digest")
    other = page_of(fields["warc-refers-to"].strip("<>")) if revisit else None
    return page_of(fields["warc-record-id"].strip("<>")), int(http["content-length"]), digest, fields["warc-type"], other


def _read(batches):
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    names = [x.split()[0] for x in RECORDS.split(", ")]
    for batch in batches:
        for cell in batch.column(0):
            data = cell.as_py()
            for entry in seek_table(data):
                raw, at, rows = frame(data, entry), 0, []
                while at < len(raw):
                    fields, http, payload, at = read_record(raw, at)
                    rows.append(described(fields, http, payload))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def read_bundles(bundles: DataFrame) -> DataFrame:
    """Every record of the bundles (columns of RECORDS), frame by frame."""
    return bundles.select("data").mapInArrow(_read, RECORDS)


def fetch(bundles: DataFrame, records: DataFrame) -> DataFrame:
    """(record, payload) for the identifiers in ``records`` (column ``record``): one frame is decompressed for each."""
    wanted = record_index(bundles).join(records.select("record").distinct(), "record")
    places = wanted.groupBy(F.col("bundle").alias("holder")).agg(F.collect_list(F.struct("record", "frame", "first")).alias("places"))
    found = bundles.join(places, bundles["bundle"] == places["holder"]).select("data", "places")

    def work(batches):
        for batch in batches:
            for cell, places in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                data, out = cell.as_py(), []
                entries, last, raw = seek_table(data), None, b""
                for p in sorted(places, key=lambda p: (p["frame"], p["first"])):
                    if p["frame"] != last:
                        last, raw = p["frame"], frame(data, entries[p["frame"]])
                    out.append((p["record"], read_record(raw, p["first"])[2]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r for r, _ in out]), pa.array([b for _, b in out], pa.binary())], names=["record", "payload"]
                )

    return found.mapInArrow(work, "record string, payload binary")


def export_bundles(bundles: DataFrame, folder: str) -> int:
    """Write each bundle as a file under ``folder``, which executors must share; returns their number."""

    def work(batches):
        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            for name, cell in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                path = os.path.join(folder, name)
                with open(f"{path}.{os.getpid()}", "wb") as f:
                    f.write(cell.as_py())
                os.replace(f"{path}.{os.getpid()}", path)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return bundles.select("bundle", "data").mapInArrow(work, "n bigint").agg(F.sum("n")).first()[0] or 0


def query(spark, sf_dir: str) -> DataFrame:
    """Archive all pages and read the archives back."""
    return read_bundles(write_bundles(table(spark, sf_dir, "pages")))

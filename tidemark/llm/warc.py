"""WARC archives: one gzip member per record, written by tasks to the shared folder and read back in sequence.

Writing. Payloads of at least ``MIN_REVISIT`` bytes that recur are stored once, with the largest page id;
the others become revisit records that name it. Which payload recurs is a grouping by SHA-1 and size with
map-side sums; the answer is joined to the pages by digest, so copies that make up a third of all rows are
split by Spark. A task streams its records into archives of bounded size under names of their own and
returns a manifest row for each; only files in the manifest count, so a lost or repeated task does no harm.

Reading. One archive is read from start to end in small chunks: incremental decompression, the end of a gzip
member is the end of a record, the header's Content-Length frames the block, and the digests of block and
payload are computed on the way and compared. A task holds one record at most, and no payload unless asked.

Files are opened with Arrow's file systems by the URI of ``spark.checkpoint.dir`` (local paths, hdfs, s3, gs).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, work_path, written

MIN_REVISIT = 1000
ARCHIVE_BYTES = 256 << 20
CHUNK = 1 << 18
LEVEL = 6
#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:tidemark:page:"
DATE = "1970-01-01T00:00:00Z"


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


# --- writing
def sha1_text(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def record_id(page_id: int | None) -> str:
    return f"<{RECORD_ID}{'none' if page_id is None else page_id}>"


def one_line(value: str) -> str:
    """A header value: control characters are percent-encoded, as a URL may hold anything."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as one gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = [http] if refers_to is not None else [http, payload]
    whole = hashlib.sha1()
    for b in block:
        whole.update(b)
    head = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": record_id(page_id), "WARC-Date": DATE}
    if url is not None:
        head["WARC-Target-URI"] = one_line(url)
    if refers_to is not None:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to)}
    head |= {"WARC-Block-Digest": sha1_text(whole.digest()), "WARC-Payload-Digest": sha1_text(hashlib.sha1(payload).digest()),
             "Content-Type": "application/http; msgtype=response", "Content-Length": str(sum(map(len, block)))}
    lines = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n"
    gz = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return b"".join([gz.compress(lines), *map(gz.compress, block), gz.compress(b"\r\n\r\n"), gz.flush()])


def with_revisits(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``payload`` (null html: empty) and ``refers_to``, the page that holds an equal
    payload. Rows that repeat the largest page id of their payload are all responses; null ids are below
    all others."""
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    pages = pages.withColumn("__sha1", F.sha1("payload"))
    large = pages.where(F.octet_length("payload") >= MIN_REVISIT)
    recurring = (large.groupBy(F.col("__sha1").alias("__same")).agg(F.max("page_id").alias("__holder"), F.count("*").alias("__n"))
                 .where("__n > 1").drop("__n"))
    revisits = F.when((F.octet_length("payload") >= MIN_REVISIT) & (F.coalesce(F.col("page_id") < F.col("__holder"), F.col("page_id").isNull())), F.col("__holder"))
    return pages.join(recurring, F.col("__sha1") == F.col("__same"), "left").select("page_id", "url", "payload", revisits.alias("refers_to"))


def write_archives(pages: DataFrame) -> DataFrame:
    """Write ``page_id``, ``url``, ``html`` and return the manifest: ``path``, ``n_records``, ``n_bytes``.

    Null html is an empty payload, a null URL leaves its header out; other columns are ignored; an empty
    table has an empty manifest."""
    rows = with_revisits(pages)
    folder = work_path(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, count, size = None, "", 0, 0
        files, at = open_fs(folder)

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "n_records": [count], "n_bytes": [size]})

        for b in slices(batches, "payload"):
            for page_id, url, payload, refers_to in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if out is None:
                    files.create_dir(at, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    path, count, size, out = f"{folder}/{name}", 0, 0, files.open_output_stream(f"{at}/{name}", compression=None)
                member = record(page_id, url, payload, refers_to)
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= ARCHIVE_BYTES:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return written(rows.mapInArrow(run, "path string, n_records long, n_bytes long"), "warc-manifest")


# --- reading
class Damaged(ValueError):
    """An archive breaks the format or a digest."""


def members(chunks: Iterator[bytes]) -> Iterator[Iterator[bytes]]:
    """Cut a stream of chunks into gzip members, each an iterator of decompressed bytes to be read to its end."""
    rest = b""

    def one() -> Iterator[bytes]:
        nonlocal rest
        gz = zlib.decompressobj(31)
        while not gz.eof:
            if not rest:
                rest = next(chunks, b"")
                if not rest:
                    raise Damaged("the archive ends inside a gzip member")
            data = gz.decompress(rest, CHUNK)
            while data:
                yield data
                rest = gz.unconsumed_tail
                data = b"" if gz.eof else gz.decompress(rest, CHUNK)
            rest = gz.unused_data if gz.eof else gz.unconsumed_tail

    while True:
        if not rest:
            rest = next(chunks, b"")
        if not rest:
            return
        yield one()


def head_of(stream: Iterator[bytes], held: bytes) -> tuple[list[str], bytes]:
    """Lines up to the first empty one, and what was read beyond it."""
    while (at := held.find(b"\r\n\r\n")) < 0:
        more = next(stream, b"")
        if not more:
            raise Damaged("a header has no end")
        held += more
    return held[:at].decode("utf-8").split("\r\n"), held[at + 4:]


def fields(lines: list[str]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def page_of(value: str | None) -> int | None:
    name = (value or "").strip("<>").removeprefix(RECORD_ID)
    return int(name) if name not in ("", "none") else None


def read_record(stream: Iterator[bytes], with_payload: bool) -> dict:
    """One record from the decompressed bytes of its member; raises ``Damaged`` if anything is off."""
    lines, held = head_of(stream, b"")
    if lines[0].encode() != VERSION:
        raise Damaged(f"not a record: {lines[0][:40]}")
    head = fields(lines[1:])
    left = int(head["content-length"])
    whole, payload, kept, size, http, http_held = hashlib.sha1(), hashlib.sha1(), [], 0, None, b""
    while left:
        if not held:
            held = next(stream, b"")
            if not held:
                raise Damaged("a block is shorter than its Content-Length")
        data, held = held[:left], held[left:]
        left -= len(data)
        whole.update(data)
        if http is None:
            http_held += data
            if b"\r\n\r\n" not in http_held:
                continue
            top, data = head_of(iter(()), http_held)
            http = fields(top[1:])
        payload.update(data)
        size += len(data)
        if with_payload:
            kept.append(data)
    if held + b"".join(stream) != b"\r\n\r\n":
        raise Damaged("a record does not end with its member")
    revisit = head["warc-type"] == "revisit"
    told = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:"))
    length = int((http or {}).get("content-length", -1))
    if sha1_text(whole.digest()) != head["warc-block-digest"] or revisit and size or not revisit and (payload.digest() != told or size != length):
        raise Damaged(f"a digest or length differs in {head.get('warc-record-id')}")
    return {"page_id": page_of(head["warc-record-id"]), "payload_bytes": length, "payload_digest": told.hex(), "record_type": head["warc-type"],
            "refers_to": page_of(head.get("warc-refers-to")), "url": head.get("warc-target-uri"), "payload": b"".join(kept) if with_payload and not revisit else None}


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record of the manifest's archives: ``page_id``, ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to``, ``url`` and ``payload`` (null unless asked for). A damaged archive, a record
    count that differs from the manifest's, or a revisit of no response with its digest and length raises."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, told in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                files, at = open_fs(path)
                with files.open_input_stream(at, compression=None) as f:
                    rows, held, n = [], 0, 0
                    for member in members(iter(lambda: f.read(CHUNK), b"")):
                        rows.append(read_record(member, with_payload))
                        n += 1
                        held += len(rows[-1]["payload"] or b"") + 200
                        if held >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                    if n != told:
                        raise Damaged(f"{path} has {n} records, the manifest {told}")
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    n = manifest.count()  # archives, not rows
    found = written(manifest.select("path", "n_records").repartition(max(1, n))
                    .mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"), "warc-records")
    lost = unmatched(found).first()
    if lost is not None:
        raise Damaged(f"revisits of page {lost['refers_to']} with {lost['payload_bytes']} bytes and digest {lost['payload_digest']} have no such response")
    return found


def unmatched(records: DataFrame) -> DataFrame:
    """Distinct targets of revisits (``refers_to``, ``payload_digest``, ``payload_bytes``) that no response has."""
    told = ["payload_digest", "payload_bytes"]
    targets = records.where("record_type = 'revisit'").select("refers_to", *told).distinct()
    held = records.where("record_type = 'response'").select(F.col("page_id").alias("__id"), *[F.col(c).alias(f"__{c}") for c in told])
    same = F.col("refers_to").eqNullSafe(F.col("__id"))
    for c in told:
        same &= F.col(c) == F.col(f"__{c}")
    return targets.join(held, same, "left_anti")

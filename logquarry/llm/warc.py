"""WARC archives as a chunked record table (operator 9).

Writing: equal payloads are found by digest, then every task streams its records into archives of its own,
one gzip member a record: the page with the largest id holds the payload, the others revisit it. Reading:
every archive is one stream; a payload comes out as rows of record id and chunk number, each with the
SHA-1 of the payload up to its end, so no record is held as a whole, however long.

Archives go to a folder that all executors reach, opened through ``pyarrow.fs`` (local and shared disks,
object stores, HDFS). Names are unique for every attempt of a task and only those of finished attempts are
listed, so a lost executor leaves at most a file that nobody reads.
"""

import gzip
import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import bitmap, checkpoint_folder, filter_bits, maybe_in, stored

LEAST_BYTES = 1000  # shorter payloads are always written
CHUNK = 1 << 20
ARCHIVE_BYTES = 256 << 20  # of payloads in an archive before the next one begins
DATE = "2000-01-01T00:00:00Z"  # pages carry no date

# The names the WARC format prescribes.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_CHUNKS = pa.schema(
    [
        ("record_id", pa.string()), ("chunk_no", pa.int64()), ("record_type", pa.string()), ("target_uri", pa.string()),
        ("refers_to", pa.string()), ("start", pa.int64()), ("chunk_bytes", pa.int64()), ("chunk", pa.binary()),
        ("digest_so_far", pa.string()), ("last", pa.bool_()),
    ]
)
_CHUNKS_DDL = (
    "record_id string, chunk_no bigint, record_type string, target_uri string, refers_to string, start bigint,"
    " chunk_bytes bigint, chunk binary, digest_so_far string, last boolean"
)


def record_id(page_id) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def _line(value: str) -> str:
    """A header value: control characters, which would break the header, as percent codes."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def write_record(
    out, page_id, url: str | None, payload, size: int, digest: str, refers_to, revisits: bool, date: str = DATE
) -> None:
    """One gzip member: headers, the HTTP head, and the payload in slices unless the record is a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = [
        ("WARC-Type", "revisit" if revisits else "response"),
        ("WARC-Record-ID", f"<{record_id(page_id)}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(http) + (0 if revisits else size))),
    ]
    if url is not None:
        head.append(("WARC-Target-URI", _line(url)))
    if revisits:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{record_id(refers_to)}>")]
    with gzip.GzipFile(filename="", fileobj=out, mode="wb", compresslevel=1, mtime=0) as member:
        member.write(VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + http)
        if not revisits:
            for at in range(0, size, CHUNK):
                member.write(payload[at : at + CHUNK])
        member.write(b"\r\n\r\n")


def _write(batches: Iterator[pa.RecordBatch], folder: str, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    """(page_id, url, html, size, digest, refers_to, revisits) into archives; yields (path, records)."""
    system, root = fs.FileSystem.from_uri(folder)
    out, path, records, filled, done = None, "", 0, 0, []
    try:
        for batch in batches:
            page, size, digest, refers, revisits = (batch.column(i).to_pylist() for i in (0, 3, 4, 5, 6))
            for i, (url, html) in enumerate(zip(batch.column(1), batch.column(2))):
                if out is None or filled >= archive_bytes:
                    if out is not None:
                        out.close()
                        done.append((path, records))
                    path, records, filled = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{root}/{path}", compression=None)
                payload = memoryview(html.as_buffer()) if html.is_valid else b""
                write_record(out, page[i], url.as_py(), payload, size[i], digest[i], refers[i], revisits[i])
                records, filled = records + 1, filled + (0 if revisits[i] else size[i])
        if out is not None:
            out.close()
            done.append((path, records))
    finally:
        if out is not None and not out.closed:
            out.close()
    yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["path", "records"])


def _headers(stream, what: str) -> dict[str, str]:
    """Lines up to an empty one, names in lower case."""
    out = {}
    while line := stream.readline().rstrip(b"\r\n"):
        name, found, value = line.partition(b":")
        if not found:
            raise ValueError(f"{what}: a header line without a name: {line[:80]!r}")
        out[name.decode().strip().lower()] = value.decode().strip()
    return out


def read_records(stream, chunk: int = CHUNK, with_data: bool = True) -> Iterator[dict]:
    """Chunk rows of an uncompressed stream of records; at most one chunk is held at a time."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line.strip() == b"":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:80]!r}")
        head = _headers(stream, "record")
        left, kind = int(head["content-length"]), head["warc-type"]
        row = {
            "record_id": head["warc-record-id"].strip("<>"),
            "record_type": kind,
            "target_uri": head.get("warc-target-uri"),
            "refers_to": head["warc-refers-to"].strip("<>") if "warc-refers-to" in head else None,
        }
        stated = head.get("warc-payload-digest", "").removeprefix("sha1:")
        size = left
        if head.get("content-type", "").startswith("application/http"):
            while left > 0:  # the HTTP head is not part of the payload
                line = stream.readline(left)
                left -= len(line)
                if line.lower().startswith(b"content-length:"):
                    size = int(line.partition(b":")[2])
                if line.strip() == b"":
                    break
        if kind == "revisit":
            stream.read(left)
            yield row | {"chunk_no": 0, "start": size, "chunk_bytes": 0, "chunk": b"" if with_data else None, "digest_so_far": stated, "last": True}
            continue
        sha, start, number = hashlib.sha1(), 0, 0
        while True:
            data = stream.read(min(chunk, left))
            if len(data) < min(chunk, left):
                raise ValueError(f"{row['record_id']} ends early")
            left -= len(data)
            sha.update(data)
            last = left == 0
            if last and stated and sha.hexdigest() != stated:
                raise ValueError(f"{row['record_id']}: the payload does not match its digest")
            yield row | {"chunk_no": number, "start": start, "chunk_bytes": len(data), "chunk": data if with_data else None, "digest_so_far": sha.hexdigest(), "last": last}
            if last:
                break
            start, number = start + len(data), number + 1


def _read(batches: Iterator[pa.RecordBatch], folder: str, chunk: int, with_data: bool) -> Iterator[pa.RecordBatch]:
    system, root = fs.FileSystem.from_uri(folder)
    rows, held = [], 0
    for batch in batches:
        for path in batch.column(0).to_pylist():
            with system.open_input_stream(f"{root}/{path}", compression=None, buffer_size=CHUNK) as raw, gzip.GzipFile(fileobj=raw) as stream:
                for row in read_records(stream, chunk, with_data):
                    rows.append(row)
                    held += row["chunk_bytes"] if with_data else 0
                    if len(rows) >= 5000 or held >= 8 * CHUNK:
                        yield pa.RecordBatch.from_pylist(rows, _CHUNKS)
                        rows, held = [], 0
    yield pa.RecordBatch.from_pylist(rows, _CHUNKS)


def _rows_of(batches: Iterator[pa.RecordBatch], keep: Callable[[np.ndarray], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows whose last column, a long, ``keep`` lets through; without that column."""
    for batch in batches:
        mask = pa.array(keep(batch.column(batch.num_columns - 1).to_numpy().view(np.uint64)))
        yield batch.filter(mask).select(list(range(batch.num_columns - 1)))


def write_archives(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url_column: str | None = "url",
    payload_column: str = "html",
    least_bytes: int = LEAST_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write a record per row of ``pages`` and return the archives (path, records), names below ``folder``.

    Pages whose payload no other page holds are written by the task that reads them. For all others it is
    decided without their html which one is the response, and only the html of responses is shuffled.

    Of rows with equal payloads of at least ``least_bytes`` bytes the one with the largest id is the
    response and the others revisit it; all other rows are responses. A null payload is empty. Ids are
    longs; a null id is never the largest, and when rows repeat the largest id each of them is a response.
    Other columns are ignored. ``folder`` must exist and be reachable from all executors.
    """
    payload = F.coalesce(F.col(f"`{payload_column}`").cast("string"), F.lit(""))
    url = F.lit(None).cast("string") if url_column is None else F.col(f"`{url_column}`").cast("string")
    rows = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"), url.alias("url"), payload.alias("html"),
        F.octet_length(payload).cast("long").alias("size"), F.sha1(payload.cast("binary")).alias("digest"),
    )
    columns = ["page_id", "url", "html", "size", "digest", "refers_to", "revisits"]
    pair, no_id, response = F.xxhash64("page_id", "digest").alias("pair"), F.lit(None).cast("long").alias("refers_to"), F.lit(False).alias("revisits")
    # without html: a page is known by its id and its payload's digest
    narrow = stored(rows.select("page_id", "url", "size", "digest"))
    groups = narrow.where(F.col("size") >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    # stored, so that the join can split a payload that very many pages hold
    shared = stored(groups.where("n > 1 AND refers_to IS NOT NULL").select("digest", "refers_to", F.xxhash64("digest").alias("key")))
    sc = pages.sparkSession.sparkContext
    many = shared.count()
    table = sc.broadcast(bitmap(shared, "key", filter_bits(many, 8)))

    def alone(batches):
        return _write(_rows_of(batches, lambda keys: ~maybe_in(table.value, keys)), folder, archive_bytes)

    out = "path string, records bigint"
    written = rows.select("page_id", "url", "html", "size", "digest", no_id, response, F.xxhash64("digest").alias("key")).mapInArrow(alone, out)
    if not many:
        return stored(written)
    # what the table lets through, among it a few payloads that no other page holds
    maybe = narrow.withColumn("key", F.xxhash64("digest")).mapInArrow(
        lambda batches: _rows_of(batches, lambda keys: maybe_in(table.value, keys)), "page_id bigint, url string, size bigint, digest string"
    )
    judged = stored(maybe.join(shared.drop("key"), "digest", "left").select("*", (F.col("page_id") != F.col("refers_to")).alias("other")))
    revisits = F.col("refers_to").isNotNull() & (F.col("page_id").isNull() | F.col("other"))
    nothing = F.lit(None).cast("string").alias("html")
    again = judged.where(revisits).select("page_id", "url", nothing, "size", "digest", "refers_to", F.lit(True).alias("revisits"))
    again = again.select(columns).mapInArrow(lambda batches: _write(batches, folder, archive_bytes), out)
    held = stored(judged.where(~revisits).select(F.col("page_id").alias("id"), F.col("digest").alias("of"), pair).distinct())
    pairs = sc.broadcast(bitmap(held, "pair", filter_bits(held.count(), 8)))
    first = rows.withColumn("pair", pair).mapInArrow(
        lambda batches: _rows_of(batches, lambda keys: maybe_in(pairs.value, keys)), "page_id bigint, url string, html string, size bigint, digest string"
    )
    first = first.join(held, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of")), "left_semi")
    first = first.select("page_id", "url", "html", "size", "digest", no_id, response).select(columns)
    return stored(written.unionAll(again).unionAll(first.mapInArrow(lambda batches: _write(batches, folder, archive_bytes), out)))


def read_archives(archives: DataFrame, folder: str, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunked record table of ``archives`` (path below ``folder``).

    One row per chunk: record_id, chunk_no (from 0), record_type, target_uri, refers_to, start, chunk_bytes,
    chunk (null without ``with_data``), digest_so_far (SHA-1 of the payload up to the chunk's end) and last. An
    empty payload has one empty chunk; so has a revisit, with the full payload's size as ``start`` and its
    digest. A payload that does not match the digest in its header is an error.
    """
    many = max(1, archives.count())
    paths = archives.select("path").repartitionByRange(many, "path")  # an archive a task
    return paths.mapInArrow(lambda batches: _read(batches, folder, chunk, with_data), _CHUNKS_DDL)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, read back from archives.

    The archives are written below the checkpoint folder and removed once the rows are stored.
    """
    base = checkpoint_folder(pages.sparkSession)
    system, root = fs.FileSystem.from_uri(base)
    name = f"warc-{uuid.uuid4().hex}"
    system.create_dir(f"{root}/{name}")
    folder = f"{base.rstrip('/')}/{name}"
    try:
        chunks = read_archives(write_archives(pages, folder, **options), folder, with_data=False).where("last")
        page = lambda c: F.when(F.col(c) != record_id(None), F.substring_index(c, ":", -1)).cast("long")
        return stored(
            chunks.select(
                page("record_id").alias("page_id"),
                (F.col("start") + F.col("chunk_bytes")).alias("payload_bytes"),
                F.col("digest_so_far").alias("payload_digest"),
                "record_type",
                page("refers_to").alias("refers_to"),
            )
        )
    finally:
        system.delete_dir(f"{root}/{name}")


def op9_warc(spark, sf_dir) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
 s AS (SELECT page_id, strlen(html) AS n, sha1(html) AS digest FROM p),
 k AS (SELECT digest, max(page_id) AS keep FROM s WHERE n >= 1000 GROUP BY digest)
SELECT page_id, n AS payload_bytes, s.digest AS payload_digest,
       CASE WHEN keep IS NULL OR keep = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keep <> page_id THEN keep END AS refers_to
FROM s LEFT JOIN k ON s.digest = k.digest
"""

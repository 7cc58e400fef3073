"""WARC archives: a deterministic writer in shards, and a reader.

Writing:

1. Every payload (the html in UTF-8) gets its SHA-1. Of records with equal payloads the one
   with the largest page_id becomes the response, the others revisit it. Only ids and
   digests are shuffled for that, and copies meet as one row per task.
2. Page ids are counted in ``BINS`` equal ranges, and consecutive ranges make shards of
   about ``shard_bytes`` of payload. The records are range-sorted into them by one shuffle.
   Shards and order depend on the data only, so every run writes the same files.
3. A task writes its shards record by record: each a gzip member of its own, headers and
   digests made anew. A file that has reached ``roll_bytes`` compressed is closed and the
   next begun. Files get a temporary name with a part that no other attempt has.
4. The manifest lists the files of the attempts that succeeded. It is written first, as a
   table; then the files get their final names, and ``_SUCCESS`` comes last. Renaming again
   does no harm, so a lost executor or driver can repeat it; what other attempts left is
   never read.

The archive's folder must be in a store that Arrow's file systems open (local or shared
folders, S3, GCS, HDFS with its native library). Reading goes through Spark, one file a
row; files are as small as ``roll_bytes`` plus one record.

Null html is an empty payload, and empty payloads are payloads like others. Rows with the
same page_id and payload are separate records: the first by url is the response. Null
page_ids come first and are the smallest. Null urls are ``urn:none``; bytes that a header
cannot hold are percent-encoded. An empty table gives an archive without files. Only
page_id, url and html are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

BINS = 10_000
# Compressed bytes handed on at once: what follows a record's end is looked at again.
PIECE = 1 << 14
# A fixed date keeps archives of the same pages equal.
DATE = "2024-01-01T00:00:00Z"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
MANIFEST = "temporary string, final string, records long, bytes long, sha256 string"
RECORDS = (
    "page_id long, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, url string, html string"
)


# --- records -----------------------------------------------------------------------


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'page:{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, revisits: int | None, is_revisit: bool) -> bytes:
    """One record, not compressed. A revisit holds the HTTP header only."""
    digest = base32_sha1(payload)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode("ascii")
    block = http if is_revisit else http + payload
    headers = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", "urn:none" if url is None else quote(url, safe="%/:?#[]@!$&'()*+,;=-._~")),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("X-Page-Id", "" if page_id is None else str(page_id)),
        ("X-Payload-Length", str(len(payload))),
    ]
    if is_revisit:
        headers += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(revisits, digest)),
            ("X-Refers-To-Page-Id", "" if revisits is None else str(revisits)),
        ]
    headers.append(("Content-Length", str(len(block))))
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in headers]]
    return "\r\n".join(lines).encode("ascii") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(stream: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an archive file."""
    data, at = memoryview(stream), 0
    while at < len(data):
        member = zlib.decompressobj(wbits=31)
        parts = []
        while not member.eof:
            if at >= len(data):
                raise ValueError("the archive file ends within a record")
            parts.append(member.decompress(data[at : at + PIECE]))
            at = min(at + PIECE, len(data)) - len(member.unused_data)
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode("ascii").split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        yield headers, rest[: int(headers["Content-Length"])]


# --- writing -----------------------------------------------------------------------


def _decisions(pages: DataFrame) -> DataFrame:
    """page_id, digest (of the payload) and winner, for payloads of several records."""
    digests = pages.select("page_id", F.sha1(F.encode("html", "utf-8")).alias("digest"))
    winners = digests.groupBy("digest").agg(
        F.max("page_id").alias("winner"), F.count(F.lit(1)).alias("n")
    )
    return digests.join(winners.where("n > 1").drop("n"), "digest").select("page_id", "digest", "winner").distinct()


def _shards(pages: DataFrame, shard_bytes: int) -> DataFrame:
    """bin and shard: consecutive bins of page ids, about ``shard_bytes`` in a shard."""
    sizes = pages.groupBy("bin").agg(F.sum(F.octet_length("html") + 500).alias("bytes"))
    before = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("bytes").over(before), F.lit(0))
    return sizes.select("bin", F.floor(start / F.lit(float(shard_bytes))).cast("int").alias("shard"))


class _Writer:
    """The files of one shard."""

    def __init__(self, store: pafs.FileSystem, folder: str, shard: int, roll_bytes: int):
        self.store, self.folder, self.shard, self.roll = store, folder, shard, roll_bytes
        self.attempt = uuid.uuid4().hex
        self.number, self.out = 0, None
        self.done: list[tuple[str, str, int, int, str]] = []

    def add(self, raw: bytes) -> None:
        if self.out is None:
            self.name = f"{self.folder}/_temporary/{self.shard:06d}-{self.number:05d}-{self.attempt}.warc.gz"
            self.out = self.store.open_output_stream(self.name, compression=None)
            self.records, self.bytes, self.sum = 0, 0, hashlib.sha256()
        member = gzip.compress(raw, compresslevel=6, mtime=0)
        self.out.write(member)
        self.records += 1
        self.bytes += len(member)
        self.sum.update(member)
        if self.bytes >= self.roll:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            final = f"{self.folder}/part-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.done.append((self.name, final, self.records, self.bytes, self.sum.hexdigest()))
            self.out = None
            self.number += 1


def write(pages: DataFrame, folder: str, shard_bytes: int = 64 << 20, roll_bytes: int = 16 << 20) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as an archive to the new ``folder``; returns the
    manifest."""
    spark = pages.sparkSession
    store, base = _store(folder)
    store.create_dir(f"{base}/_temporary", recursive=True)
    pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    low, high = pages.agg(F.min("page_id"), F.max("page_id")).first()
    width = ((high or 0) - (low or 0)) // BINS + 1
    # As decimals: ids may be further apart than a long can say.
    binned = F.expr(f"(cast(page_id as decimal(20, 0)) - {low or 0}BD) div {width}BD")
    binned = F.coalesce(binned, F.lit(-1)).cast("long").alias("bin")
    shards = _shards(pages.select(binned, "html"), shard_bytes)
    count = (shards.agg(F.max("shard")).first()[0] or 0) + 1

    # Decisions come before the records they are about.
    none = F.lit(None).cast("string")
    decided = _decisions(pages).select(
        binned, "page_id", F.lit(0).alias("kind"), none.alias("url"), none.alias("html"), "digest", "winner"
    )
    records = pages.select(
        binned, "page_id", F.lit(1).alias("kind"), "url", "html",
        none.alias("digest"), none.cast("long").alias("winner"),
    )
    rows = records.union(decided).join(F.broadcast(shards), "bin")  # at most BINS + 1 rows
    order = ["shard", "page_id", "kind", "url", "html"]
    laid = rows.repartitionByRange(count, "shard").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        writer, page = None, object()
        winners: dict[str, int | None] = {}
        seen: set[str] = set()
        done = []
        for batch in batches:
            names = ("shard", "page_id", "kind", "url", "html", "digest", "winner")
            for shard, page_id, kind, url, html, digest, winner in zip(
                *[batch.column(n).to_pylist() for n in names], strict=True
            ):
                if writer is None or shard != writer.shard:
                    if writer:
                        writer.close()
                        done += writer.done
                    writer = _Writer(store, base, shard, roll_bytes)
                if page_id != page:
                    page, winners, seen = page_id, {}, set()
                if kind == 0:
                    winners[digest] = winner
                    continue
                payload = html.encode("utf-8")
                digest = hashlib.sha1(payload).hexdigest()
                is_revisit = digest in winners and (winners[digest] != page_id or digest in seen)
                seen.add(digest)
                writer.add(record(page_id, url, payload, winners.get(digest), is_revisit))
        if writer:
            writer.close()
            done += writer.done
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(x)) for x in zip(*done, strict=True)],
                ["temporary", "final", "records", "bytes", "sha256"],
            )

    laid.select(*order, "digest", "winner").mapInArrow(run, MANIFEST).write.parquet(f"{folder}/_manifest")
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")
    commit(manifest, folder)
    return manifest


def commit(manifest: DataFrame, folder: str) -> None:
    """Give the files of the manifest their final names; then mark the archive complete."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _store(folder)
        for batch in batches:
            for temporary, final in zip(batch.column("temporary").to_pylist(), batch.column("final").to_pylist(), strict=True):
                if store.get_file_info(final).type == pafs.FileType.NotFound:
                    store.move(temporary, final)
            yield batch.select(["final"])

    moved = manifest.select("temporary", "final").mapInArrow(run, "final string").count()
    if moved != manifest.count():
        raise RuntimeError(f"{folder}: not all files could be renamed")
    store, base = _store(folder)
    with store.open_output_stream(f"{base}/_SUCCESS"):
        pass


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("/") else f"file:{folder}")


# --- reading -----------------------------------------------------------------------


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The records of a complete archive, without its order. ``html`` is null for revisits;
    the digest of a response is taken from what was read, and must be the one written."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split(" ")[0] for f in RECORDS.split(", ")]
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for headers, block in parse(content.as_buffer().to_pybytes()):
                    revisit = headers["WARC-Type"] == "revisit"
                    payload = None if revisit else block.partition(b"\r\n\r\n")[2]
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not revisit and base32_sha1(payload) != digest:
                        raise ValueError(f"record {headers['WARC-Record-ID']} is damaged")
                    number = lambda name, headers=headers: int(headers[name]) if headers[name] else None
                    rows.append((
                        number("X-Page-Id"), headers["WARC-Type"],
                        number("X-Payload-Length") if revisit else len(payload), digest,
                        number("X-Refers-To-Page-Id") if revisit else None,
                        headers["WARC-Target-URI"], None if revisit else payload.decode("utf-8"),
                    ))
                    size += len(block)
                    if size > 4 << 20:
                        yield _batch(rows, names)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, names)

    return files.select("content").mapInArrow(run, RECORDS)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64()}
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kinds.get(n, pa.string())) for n, c in zip(names, columns, strict=True)], names
    )

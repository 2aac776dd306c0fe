"""WARC archives: a deterministic, sharded writer, and a reader.

Rows are dealt to shards by ranges of the page id and sorted within each; a shard's records
are written in that order, each as its own gzip member, and a new file begins when the current
one reaches a compressed size. Headers, record ids and digests are computed anew from the
payload. A file is written under a temporary name and moved to its final name when complete;
the manifest, one row per file, is the last thing written. Readers open only what the manifest
lists, so leftovers of a lost executor are never read, and a task that runs again writes the
same bytes to the same names.

Equal payloads of at least ``min_bytes``: the smallest page id is the response, the others are
revisits that refer to it. Rows that repeat that page id as well are responses, too. A null page
id counts as larger than any other. Null html is an empty payload; null urls are left out of the
header. Other columns of the pages are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, stored

MANIFEST = "file string, shard int, records bigint, bytes bigint, sha1 string, first_page bigint, last_page bigint"
RECORDS = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, payload binary"
)
_BUCKETS = 1 << 16
_DATE = "2000-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    """SHA-1 as bare base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, payload_digest: str) -> str:
    """A record's name: the same for the same page and payload in every run."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{payload_digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record, not compressed; a revisit has the HTTP header only."""
    name = digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, name)}",
        f"WARC-Date: {_DATE}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=_SAFE)}")
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {record_id(refers_to, name)}")
        if refers_to is not None:
            lines.append(f"X-Refers-To-Page-ID: {refers_to}")
    lines += [
        f"WARC-Payload-Digest: sha1:{name}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_SAFE = "".join(map(chr, range(0x21, 0x7F)))


class _Parts:
    """Writes the files of one shard."""

    def __init__(self, folder: str, shard: int, roll: int) -> None:
        self.system, self.path = fs.FileSystem.from_uri(folder)
        self.shard, self.roll, self.number, self.out = shard, roll, 0, None

    def add(self, page_id: int | None, raw: bytes) -> Iterator[tuple]:
        if self.out is None:
            task = TaskContext.get()
            self.name = f"shard-{self.shard:06d}-{self.number:06d}.warc.gz"
            self.temporary = f"{self.path}/.{self.name}.{task.taskAttemptId() if task else 0}-{uuid.uuid4().hex}"
            self.out, self.sha = self.system.open_output_stream(self.temporary, compression=None), hashlib.sha1()
            self.size = self.records = 0
            self.first = page_id
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = packer.compress(raw) + packer.flush()
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)
        self.records += 1
        self.last = page_id
        if self.size >= self.roll:
            yield self.close()

    def close(self) -> tuple:
        self.out.close()
        self.out = None
        self.number += 1
        self.system.move(self.temporary, f"{self.path}/{self.name}")
        return self.name, self.shard, self.records, self.size, self.sha.hexdigest(), self.first, self.last


def _shards(pages: DataFrame, rows: DataFrame, shard_bytes: int | None) -> tuple[DataFrame, int]:
    """The rows with a shard number that rises with the page id, and how many shards the pages fill.

    Page ids fall into equal steps between the smallest and the largest; the bytes in each step,
    at most 65,537 numbers, decide where a shard ends. A step that alone is larger is split by a
    hash of the row, so many rows of one page id do not stay together.
    """
    spark = rows.sparkSession
    low, high = pages.agg(F.min("page_id"), F.max("page_id")).first()
    low, high = (0, 0) if low is None else (low, high)
    width = max(1, -(-(high - low + 1) // _BUCKETS))
    step = F.floor((F.col("page_id").cast("double") - F.lit(float(low))) / F.lit(float(width)))
    step = F.coalesce(step, F.lit(_BUCKETS)).cast("int")
    sizes = dict(pages.groupBy(step.alias("s")).agg(F.sum(F.col("_bytes") + 600)).collect())
    if shard_bytes is None:
        shard_bytes = min(1 << 30, max(16 << 20, sum(sizes.values()) // 4096))
    plan, shard, filled = [], 0, 0
    for s in sorted(sizes):
        parts = max(1, -(-sizes[s] // shard_bytes))
        if filled and filled + sizes[s] > shard_bytes:
            shard, filled = shard + 1, 0
        plan.append((s, shard, parts))
        shard, filled = (shard + parts, 0) if parts > 1 else (shard, filled + sizes[s])
    steps = spark.createDataFrame(plan, "_step int, _shard int, _parts int")
    within = F.pmod(F.xxhash64("page_id", "_digest"), F.col("_parts")).cast("int")
    dealt = rows.withColumn("_step", step).join(F.broadcast(steps), "_step")
    return dealt.withColumn("_shard", F.col("_shard") + within).drop("_step", "_parts"), shard + 1


def write_warc(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 0,
    shard_bytes: int | None = None,
    roll_bytes: int = 64 << 20,
) -> DataFrame:
    """Writes a record for each page (page_id, url, html) and returns the manifest.

    ``shard_bytes`` bounds the bytes a task writes: by default a 4,096th of all, between 16 MB
    and 1 GB. ``roll_bytes`` is the compressed size at which a new file begins. ``folder`` must be
    one that all executors share, at a store that ``pyarrow.fs`` opens.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html")).withColumn("_bytes", F.octet_length("html"))
    rows = rows.withColumn("_digest", F.sha1(F.encode("html", "utf-8")))
    large = rows.where(F.col("_bytes") >= min_bytes)
    shared = large.groupBy("_digest").agg(F.count("*").alias("n"), F.min("page_id").alias("_first")).where("n > 1")
    # stored, so that the join deals both sides anew and Spark can split the pages of one digest, all empty ones for one
    shared = stored(shared, f"{folder}/shared")
    # slim rows find the revisits; they then travel with the pages as marks, so html moves once
    marks = (
        large.select("page_id", "_digest")
        .join(shared, "_digest")
        .where("page_id is null and _first is not null or page_id <> _first")
        .select(
            "page_id",
            F.lit(None).cast("string").alias("url"),
            F.lit(None).cast("string").alias("html"),
            F.lit(0).alias("_bytes"),
            "_digest",
            "_first",
            F.lit(0).alias("_kind"),
        )
    )
    pages_and_marks = rows.select(
        "*", F.lit(None).cast("bigint").alias("_first"), F.lit(1).alias("_kind")
    ).unionByName(marks)
    dealt, shards = _shards(rows, pages_and_marks, shard_bytes)
    ordered = (
        dealt.select("_shard", "page_id", "_digest", "_kind", "url", "html", "_first")
        .repartitionById(shards, F.col("_shard").cast("int"))  # a task for each shard, and no two in one
        .sortWithinPartitions("_shard", "page_id", "_digest", "_kind", "url")
    )
    files = f"{folder}/archives"
    names = [x.split()[0] for x in MANIFEST.split(", ")]
    whole = {"first_page": "Int64", "last_page": "Int64"}

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, mark = None, None
        for batch in batches:
            done = []
            for shard, page, sha, kind, url, text, first in zip(*(batch[c] for c in batch), strict=True):
                page = None if pd.isna(page) else int(page)
                if kind == 0:
                    mark = page, sha, int(first)
                    continue
                if part is None or part.shard != shard:
                    if part is not None and part.out is not None:
                        done.append(part.close())
                    part = _Parts(files, int(shard), roll_bytes)
                revisit = mark is not None and mark[:2] == (page, sha)
                raw = record(page, url, text.encode(), mark[2] if revisit else None, revisit)
                done += part.add(page, raw)
            yield pd.DataFrame(done, columns=names).astype(whole)
        if part is not None and part.out is not None:
            yield pd.DataFrame([part.close()], columns=names).astype(whole)

    system, path = fs.FileSystem.from_uri(files)
    system.create_dir(path, recursive=True)
    manifest = stored(ordered.mapInPandas(write, MANIFEST), f"{folder}/manifest")
    dropped(pages.sparkSession, f"{folder}/shared")
    return manifest


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of one archive: header fields and block, one gzip member at a time."""
    rest = b""
    while True:
        unpack, raw = zlib.decompressobj(31), []
        while not unpack.eof:
            chunk = rest or stream.read(1 << 20)
            rest = b""
            if not chunk:
                if raw:
                    raise ValueError("an archive ends within a record")
                return
            raw.append(unpack.decompress(chunk))
        rest = unpack.unused_data
        head, _, tail = b"".join(raw).partition(b"\r\n\r\n")
        first, *lines = head.decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record begins with {first[:20]!r}")
        fields = dict(line.split(": ", 1) for line in lines)
        block = tail[: int(fields["Content-Length"])]
        if f"sha1:{digest(block)}" != fields["WARC-Block-Digest"]:
            raise ValueError(f"block digest of {fields['WARC-Record-ID']} is wrong")
        yield fields, block


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of all files of the manifest. Revisits have no payload of their own."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    files = manifest.select("file", "records", "bytes")
    names = [x.split()[0] for x in RECORDS.split(", ")]
    whole = {"page_id": "Int64", "refers_to": "Int64"}

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = fs.FileSystem.from_uri(f"{folder}/archives")
        for batch in batches:
            for name, records, size in zip(batch["file"], batch["records"], batch["bytes"], strict=True):
                source = f"{path}/{name}"
                if system.get_file_info(source).size != size:
                    raise ValueError(f"{name} is not as long as the manifest says")
                rows, held, seen = [], 0, 0
                with system.open_input_stream(source, compression=None) as stream:
                    for fields, block in read_records(stream):
                        head, _, payload = block.partition(b"\r\n\r\n")
                        length = int(head.decode().rpartition("Content-Length: ")[2])
                        page, first = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
                        kind = fields["WARC-Type"]
                        payload_digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response" and digest(payload) != payload_digest:
                            raise ValueError(f"payload digest of {fields['WARC-Record-ID']} is wrong")
                        body = payload if payloads and kind == "response" else None
                        page, first = page and int(page), first and int(first)
                        uri = fields.get("WARC-Target-URI")
                        rows.append((page, uri, length, payload_digest, kind, first, body))
                        held += len(body or b"") + 200
                        seen += 1
                        if held > 8 << 20:
                            yield pd.DataFrame(rows, columns=names).astype(whole)
                            rows, held = [], 0
                if seen != records:
                    raise ValueError(f"{name} has {seen} records, the manifest says {records}")
                yield pd.DataFrame(rows, columns=names).astype(whole)

    return files.repartition(partitions_of(files), "file").mapInPandas(read, RECORDS)


def partitions_of(files: DataFrame) -> int:
    """A part for each file, up to 100,000."""
    return max(1, min(100_000, files.count()))

"""WARC archives: a deterministic sharded writer and a reader.

Records are range-sorted by page id and written by one task per range as gzip members, one per record; a file is
rolled when its compressed size reaches ``roll_bytes``. Headers, digests and record ids are made anew from the row, so
equal input gives equal archives. Each task attempt writes under a temporary name of its own and reports its files;
the files that the successful attempts report are renamed and listed in a manifest, and only what the manifest lists
is read back. Ranges come from a bounded sample of ids chosen by hash.

Of pages with equal payloads of at least ``least_bytes`` bytes the one with the largest id is a ``response``; the
others are ``revisit`` records that refer to it and carry no payload of their own.

Cases: null html is an empty payload; null urls are written as an empty target; pages with a null id are responses
and are refused as targets of a revisit; rows that repeat an id are records of their own, and all with the largest id
are responses; an empty table gives an empty manifest and no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch, if_small, read

DATE = "2024-01-01T00:00:00Z"
MANIFEST = "shard int, number int, temporary string, records long, bytes long, sha256 string"


def plan_records(pages: DataFrame, path: str, least_bytes: int = 0, small_rows: int = 100_000) -> DataFrame:
    """``page_id, url, html`` plus the payload's ``sha1``, and id and URL of the response it revisits (``refers_to``, ``target_url``).
    The digests that occur more than once are written to ``<path>/targets`` and broadcast while they are few."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html).alias("sha1"))
    last = rows.where(F.octet_length("html") >= least_bytes).groupBy("sha1").agg(F.max("page_id").alias("target"), F.max_by("url", "page_id").alias("target_url"), F.count(F.lit(1)).alias("n"))
    last.where("n > 1 AND target IS NOT NULL").select("sha1", "target", "target_url").write.mode("overwrite").parquet(f"{path}/targets")
    last = if_small(pages.sparkSession.read.parquet(f"{path}/targets"), small_rows)
    long_enough = (F.octet_length("html") >= least_bytes) & (F.col("page_id") < F.col("target"))
    return rows.join(last, "sha1", "left").select("page_id", "url", "html", "sha1", F.when(long_enough, F.col("target")).alias("refers_to"), "target_url")


def _id(page_id: int | None, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>"


def record(page_id: int | None, url: str | None, html: str, refers_to: int | None, target_url: str | None = None) -> bytes:
    """One WARC/1.1 record. A revisit has the block digest of nothing and the payload digest of the full payload."""
    payload = html.encode("utf-8", "surrogatepass")
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = payload if refers_to is None else b""
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_id(page_id, url)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {(url or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        f"X-Page-ID: {'' if page_id is None else page_id}", f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_id(refers_to, target_url)}", f"WARC-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)  # the gzip header so made has no time and no name
    return z.compress(data) + z.flush()


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of one archive: headers and block. Block digests and lengths are verified."""
    rest = memoryview(data)
    while rest:
        z, raw, step = zlib.decompressobj(31), [], 1 << 16
        while not z.eof and rest:  # in steps, so that what follows a record isn't copied for each
            raw.append(z.decompress(rest[:step]))
            rest = rest[min(step, len(rest)) - len(z.unused_data) :]
        raw = b"".join(raw) + z.flush()
        head, _, body = raw.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
        block = body[: int(fields["Content-Length"])]
        said = fields["WARC-Block-Digest"].removeprefix("sha1:")
        if version != "WARC/1.1" or body[len(block) :] != b"\r\n\r\n" or base64.b32encode(hashlib.sha1(block).digest()).decode() != said:
            raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
        yield fields, block


def _bounds(pages: DataFrame, shards: int, sample: int) -> list[int]:
    """Range bounds of the ids, the same for the same rows: quantiles of the ids with the ``sample`` smallest hashes."""
    ids = sorted(r[0] for r in pages.where("page_id IS NOT NULL").select("page_id", F.xxhash64("page_id").alias("h")).orderBy("h", "page_id").limit(sample).select("page_id").collect())
    return sorted({ids[len(ids) * k // shards] for k in range(1, shards)}) if ids else []


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0, roll_bytes: int = 8 << 20, shards: int | None = None, level: int = 5, sample: int = 20_000) -> DataFrame:
    """Write the archives and ``<path>/manifest``; returns the manifest with the final names (``file``)."""
    spark = pages.sparkSession
    shards = shards or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = _bounds(pages, shards, sample)
    planned = plan_records(pages, path, least_bytes)
    shard = F.coalesce(F.aggregate(F.lit(bounds), F.lit(0), lambda n, b: n + (F.col("page_id") >= b).cast("int")), F.lit(0)) if bounds else F.lit(0)
    dealt = planned.withColumn("shard", shard.cast("int")).repartition(shards, "shard").sortWithinPartitions("shard", "page_id", "url", "sha1")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(path)
        fs.create_dir(f"{base}/temporary", recursive=True)
        attempt = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex}"
        done, out, at, records, size, digest, number, name = [], None, None, 0, 0, None, 0, ""

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                done.append((at, number, name, records, size, digest.hexdigest()))
                out = None

        for b in batches:
            for r in b.to_pylist():
                if out is not None and (r["shard"] != at or size >= roll_bytes):
                    close()
                    number = number + 1 if r["shard"] == at else 0
                if out is None:
                    at, records, size, digest, name = r["shard"], 0, 0, hashlib.sha256(), f"{base}/temporary/{r['shard']:06d}-{number:06d}-{attempt}"
                    out = fs.open_output_stream(name, compression=None)
                data = _member(record(r["page_id"], r["url"], r["html"], r["refers_to"], r["target_url"]), level)
                out.write(data)
                digest.update(data)
                records, size = records + 1, size + len(data)
        close()
        cols = list(zip(*done, strict=True)) if done else [[]] * 6
        yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=[f.strip().split(" ")[0] for f in MANIFEST.split(",")])

    # the list of files that successful attempts made is written first; renames follow from it and can be repeated
    dealt.mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(f"{path}/reported")

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(path)
        fs.create_dir(f"{base}/archive", recursive=True)
        for b in batches:
            names = []
            for r in b.to_pylist():
                final = f"{base}/archive/{r['shard']:06d}-{r['number']:06d}.warc.gz"
                if fs.get_file_info(r["temporary"]).type == pafs.FileType.File:
                    fs.move(r["temporary"], final)
                if fs.get_file_info(final).size != r["bytes"]:
                    raise OSError(f"{final} was not committed whole")
                names.append(final.rsplit("/", 1)[1])
            yield pa.record_batch([*b.columns, pa.array(names, pa.string())], names=[*b.schema.names, "file"])

    spark.read.parquet(f"{path}/reported").mapInArrow(commit, MANIFEST + ", file string").drop("temporary").write.mode("overwrite").parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of the archives that the manifest lists, checked against its sizes and digests: :data:`READ`."""
    manifest = spark.read.parquet(f"{path}/manifest").select(F.col("file").alias("listed"), "sha256")
    if manifest.isEmpty():
        return spark.createDataFrame([], READ)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(f"{path}/archive").select("path", "content")
    files = files.withColumn("listed", F.element_at(F.split("path", "/"), -1)).join(manifest, "listed").select("content", "sha256")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content, sha in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                data = content.as_py()
                if hashlib.sha256(data).hexdigest() != sha:
                    raise OSError("an archive differs from its manifest")
                rows = []
                for h, block in parse(data):
                    number = lambda x: int(x) if x else None
                    rows.append((number(h["X-Page-ID"]), h["WARC-Target-URI"], int(h["X-Payload-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Type"], number(h.get("WARC-Refers-To-Page-ID")), block if payloads and h["WARC-Type"] == "response" else None))
                types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[f.strip().split(" ")[0] for f in READ.split(",")])

    return files.mapInArrow(run, READ)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark, "warc").path("out")
    write_warc(read(spark, sf_dir, "pages"), path)
    return read_warc(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
m AS (SELECT x, max(page_id) AS target FROM p GROUP BY x)
SELECT page_id, strlen(h) AS payload_bytes,
  array_to_string(list_transform(range(0, 8), lambda k: array_to_string(list_transform(range(0, 4), lambda j:
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((('0x' || p.x[k * 5 + 1 : k * 5 + 5])::BIGINT >> (15 - 5 * j)) & 31) + 1]), '')), '') AS payload_digest,
  CASE WHEN page_id < target THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < target THEN target END AS refers_to
FROM p JOIN m ON p.x = m.x
"""

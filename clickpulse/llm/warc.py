"""Deterministic sharded WARC archives: write, commit by manifest, read back.

Records are dealt to shards by ranges of (id, payload digest) whose bounds
come from a content-hashed sample, sorted inside each shard, and written as
one gzip member each. Files roll by compressed size and are committed by
renaming from a temporary name; the manifest is written last and lists what
counts. The same input gives byte-identical files, whatever the partitioning
or the number of attempts.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.plans.iterate import cut_lineage

#: Payload bytes per shard aimed for, and the most shards (their bounds are broadcast).
SHARD_BYTES = 32 << 20
MAX_SHARDS = 16_384
SAMPLES_PER_SHARD = 32
#: Compressed bytes after which a file is closed.
FILE_BYTES = 64 << 20
MIN_REVISIT_BYTES = 100
DATE = "1970-01-01T00:00:00Z"
_MANIFEST = "shard int, seq int, file string, records bigint, bytes bigint, sha256 string"
_RECORDS = ("page_id {id}, url string, record_type string, payload_bytes bigint, "
            "payload_digest string, refers_to {id}, payload binary")


# ------------------------------------------------------------------ records

def _record_id(page_id, digest: str, copy: int) -> str:
    name = hashlib.sha256(json.dumps([page_id, digest, copy]).encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=name[:16], version=5)}>"


def _gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)      # gzip wrapper, no name, time 0
    return z.compress(data) + z.flush()


def encode_record(page_id, url: str | None, payload: bytes, digest: str, copy: int, refers_to,
                  revisit: bool) -> bytes:
    """One WARC record (uncompressed); headers and block digest are made anew."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {_record_id(page_id, digest, copy)}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha256:{digest}",
            f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
            f"X-Page-Id: {json.dumps(page_id)}", f"X-Payload-Length: {len(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
        if "\r" in url or "\n" in url or url != url.strip():
            head.append("X-Url: " + json.dumps(url))
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_record_id(refers_to, digest, 0)}",
                 f"X-Refers-To-Page-Id: {json.dumps(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def decode_record(data: bytes) -> dict:
    """Headers and payload of one record; raises if a length or digest disagrees."""
    cut = data.index(b"\r\n\r\n")
    lines = data[:cut].decode("utf-8", "surrogatepass").split("\r\n")
    head = dict(x.split(": ", 1) for x in lines[1:])
    block = data[cut + 4:-4]
    if lines[0] != "WARC/1.1" or data[-4:] != b"\r\n\r\n" or len(block) != int(head["Content-Length"]):
        raise ValueError(f"damaged record {head.get('WARC-Record-ID')}")
    if "sha256:" + hashlib.sha256(block).hexdigest() != head["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {head['WARC-Record-ID']} disagrees")
    revisit = head["WARC-Type"] == "revisit"
    payload = None if revisit else block[block.index(b"\r\n\r\n") + 4:]
    digest, size = head["WARC-Payload-Digest"][7:], int(head["X-Payload-Length"])
    if payload is not None and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {head['WARC-Record-ID']} disagrees")
    return {"page_id": json.loads(head["X-Page-Id"]),
            "url": json.loads(head["X-Url"]) if "X-Url" in head else head.get("WARC-Target-URI"),
            "record_type": head["WARC-Type"], "payload_bytes": size, "payload_digest": digest,
            "refers_to": json.loads(head["X-Refers-To-Page-Id"]) if revisit else None, "payload": payload}


# -------------------------------------------------------------------- write

class _Roller:
    """Writes the members of one shard into files of about ``limit`` bytes."""

    def __init__(self, folder: str, shard: int, limit: int):
        self.fs, self.path = pafs.FileSystem.from_uri(folder)
        self.shard, self.limit, self.seq, self.out, self.done = shard, limit, 0, None, []

    def add(self, member: bytes) -> None:
        if self.out is None:
            self.name = f"shard-{self.shard:05d}-{self.seq:05d}.warc.gz"
            self.temp = f"{self.path}/_temporary/{self.name}.{uuid.uuid4().hex}"
            self.fs.create_dir(f"{self.path}/_temporary", recursive=True)
            self.out, self.sha, self.size, self.records = self.fs.open_output_stream(
                self.temp, compression=None), hashlib.sha256(), 0, 0
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)
        self.records += 1
        if self.size >= self.limit:
            self.close()

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.out = None
        final = f"{self.path}/{self.name}"
        try:
            self.fs.move(self.temp, final)
        except OSError:             # another attempt was first; its bytes are the same
            if self.fs.get_file_info(final).type != pafs.FileType.File:
                raise
            self.fs.delete_file(self.temp)
        self.done.append((self.shard, self.seq, self.name, self.records, self.size, self.sha.hexdigest()))
        self.seq += 1


def _range_bounds(keys: DataFrame, rows: int, total: int, shard_bytes: int) -> list[tuple]:
    """Upper bounds of all shards but the last, from a sample chosen by content hash.

    The sample depends on the rows alone, so the bounds do too. At most about
    ``SAMPLES_PER_SHARD * MAX_SHARDS`` distinct keys reach the driver.
    """
    shards = max(1, min(MAX_SHARDS, -(-total // shard_bytes)))
    if shards == 1:
        return []
    every = max(1, rows // (shards * SAMPLES_PER_SHARD))
    sample = (keys.where(F.pmod(F.xxhash64("id", "digest"), F.lit(every)) == 0)
              .groupBy("id", "digest").agg(F.sum(F.col("n") + 200).alias("w")).collect())
    ranked = sorted(((r.id is not None, r.id if r.id is not None else 0, r.digest), r.w) for r in sample)
    step, seen, bounds = sum(w for _, w in ranked) / shards, 0, []
    for key, w in ranked:
        seen += w
        if seen >= step * (len(bounds) + 1) and len(bounds) < shards - 1:
            bounds.append(key)
    return bounds


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", shard_bytes: int = SHARD_BYTES,
                   file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row of ``pages`` below ``folder`` (a shared path or URI); return the manifest.

    Of records with equal payloads of at least 100 bytes the one with the
    smallest id is a response, the others are revisits of it. Defined edge
    cases: null html is an empty payload, a null url gives no target header,
    a null id sorts first and is never referred to; of rows repeating the
    smallest id the first in (url) order is the response; equal rows all get
    a record; an empty table writes an empty manifest; other columns are not
    archived. Only digests are shuffled to find revisits; the html moves once.
    """
    spark = pages.sparkSession
    html = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), html.alias("html"),
                        F.sha2(html, 256).alias("digest"))
    keys = cut_lineage(base.select("id", "digest", F.length("html").cast("bigint").alias("n")))
    size = keys.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("bytes")).first()
    bounds = _range_bounds(keys, size.rows, size.bytes or 0, shard_bytes)

    @F.arrow_udf("int")
    def shard_of(ids: pa.Array, digests: pa.Array) -> pa.Array:
        return pa.array([bisect_right(bounds, (i is not None, i if i is not None else 0, d))
                         for i, d in zip(ids.to_pylist(), digests.to_pylist())], pa.int32())

    large = keys.where(F.col("n") >= MIN_REVISIT_BYTES)
    first = (large.groupBy("digest").agg(F.min("id").alias("ref"), F.count(F.lit(1)).alias("c"))
             .where("c > 1 AND ref IS NOT NULL").select("digest", "ref"))
    notes = large.join(first, "digest").select("id", "digest", "ref").distinct()
    empty = F.lit(None)
    dealt = (base.select("id", "digest", F.lit(1).alias("kind"), "url", "html", empty.cast(base.schema["id"].dataType).alias("ref"))
             .unionByName(notes.select("id", "digest", F.lit(0).alias("kind"), empty.cast("string").alias("url"),
                                       empty.cast("binary").alias("html"), "ref"))
             .withColumn("shard", shard_of("id", "digest")))
    dealt = (dealt.repartitionById(len(bounds) + 1, F.col("shard"))
             .sortWithinPartitions("shard", "id", "digest", "kind", "url"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, done, note, copies, last = None, [], None, 0, None
        for b in batches:
            cols = [b.column(b.schema.get_field_index(c)) for c in
                    ("shard", "id", "digest", "kind", "url", "html", "ref")]
            for i in range(b.num_rows):
                shard, pid, digest, kind, url, payload, ref = (c[i].as_py() for c in cols)
                if roller is None or roller.shard != shard:
                    if roller:
                        roller.close()
                        done += roller.done
                    roller, last, note = _Roller(folder, shard, file_bytes), None, None
                if kind == 0:           # says that this (id, digest) has equal payloads elsewhere
                    note = (pid, digest, ref)
                    continue
                copies = copies + 1 if last == (pid, digest) else 0
                last = (pid, digest)
                noted = note is not None and note[:2] == last
                revisit = noted and (note[2] != pid or copies > 0)
                roller.add(_gzip_member(encode_record(pid, url, payload, digest, copies,
                                                      note[2] if revisit else None, revisit)))
        if roller:
            roller.close()
            done += roller.done
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("shard", "seq", "file", "records", "bytes", "sha256"), r)) for r in done],
            schema=pa.schema([("shard", pa.int32()), ("seq", pa.int32()), ("file", pa.string()),
                              ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())]))

    # Spark commits the manifest; archives it does not list are leftovers of lost attempts
    dealt.mapInArrow(write, _MANIFEST).write.parquet(f"{folder}/_manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/_manifest")


# --------------------------------------------------------------------- read

def _members(stream, check) -> Iterator[bytes]:
    """The decompressed gzip members of a stream, one at a time."""
    z, parts = None, []
    while chunk := stream.read(1 << 20):
        check.update(chunk)
        while chunk:
            z = z or zlib.decompressobj(31)
            parts.append(z.decompress(chunk))
            chunk = z.unused_data
            if z.eof:
                yield b"".join(parts)
                z, parts = None, []
    if z is not None:
        raise ValueError("archive ends inside a record")


def read_archives(spark: SparkSession, folder: str, id_type: str = "bigint",
                  payloads: bool = True) -> DataFrame:
    """The records of the archives that the manifest of ``folder`` lists.

    Every file is checked against the manifest and every record against its
    digests. ``payload`` is null for revisits, and for all if not asked for.
    """
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/_manifest")
    schema = _RECORDS.format(id=id_type)
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]
    out_schema = pa.schema([("page_id", arrow), ("url", pa.string()), ("record_type", pa.string()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("refers_to", arrow), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for m in b.to_pylist():
                sha, rows, held, count = hashlib.sha256(), [], 0, 0
                with fs.open_input_stream(f"{path}/{m['file']}", compression=None) as stream:
                    for data in _members(stream, sha):
                        r = decode_record(data)
                        if not payloads:
                            r["payload"] = None
                        rows.append(r)
                        held += len(r["payload"] or b"") + 200
                        count += 1
                        if held >= 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=out_schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=out_schema)
                if count != m["records"] or sha.hexdigest() != m["sha256"]:
                    raise ValueError(f"{m['file']} differs from the manifest")

    files = manifest.repartition(max(1, min(MAX_SHARDS, manifest.count())))
    return files.mapInArrow(read, schema)

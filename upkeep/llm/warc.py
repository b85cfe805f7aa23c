"""WARC archives: a deterministic sharded writer and a reader.

Records are range-sorted: shard bounds come from a share of the records picked by hash, so they depend on the records
alone. Each shard is one task that writes gzip members, one a record, and begins a new file when the compressed size
reaches the limit. A file is written under a temporary name and renamed when it is closed; a task that is run again
writes the same bytes under the same names. The manifest names the files that count, with size and SHA-256, and is
itself written under a temporary name and renamed last: a folder without one holds no archive.
"""

import hashlib
import json
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.llm.common import search, written

DATE = "2000-01-01T00:00:00Z"  # a date of now would make every run another archive
SAMPLE = 20_000  # at about this many records shard bounds are taken from; it steers balance only
RECORD = "file string, page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"


def write_warc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
               least: int = 100, shard_bytes: int = 64 << 20, roll_bytes: int = 16 << 20) -> DataFrame:
    """Write one record a row and return the manifest (file, records, bytes, sha256).

    Of records with equal payloads of `least` bytes or more, the one with the smallest key is a response (all of
    them, if rows repeat that key) and the others are revisits of it; a revisit carries no payload. Payloads without any
    key to refer to are all responses. A null text is an empty payload, a null url gets a urn, null keys come last.
    Other columns are not read. An empty table gives a manifest without files.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"))
    digest, size = F.sha2("html", 256), F.octet_length("html").cast("long")
    # Sorts as the key does, nulls last, then by payload.
    place = F.concat(F.when(F.col("page_id").isNull(), F.lit("1")).otherwise("0"), F.lpad((F.coalesce("page_id", F.lit(0)).cast("decimal(20,0)") + F.lit("9223372036854775808").cast("decimal(20,0)")).cast("decimal(20,0)").cast("string"), 20, "0"), F.lit("|"), digest)
    rows = rows.withColumns({"digest": digest, "size": size, "place": place})
    slim = written(rows.select("page_id", "digest", "size", "place"), "digests")
    first = slim.where((F.col("size") >= least) & F.col("page_id").isNotNull()).groupBy("digest").agg(F.min("page_id").alias("first"))
    repeats = slim.where(F.col("size") >= least).join(first, "digest").where("page_id is null or page_id <> first").select("place", "first").distinct()

    total = slim.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    shards = max(1, -(-(total["bytes"] or 0) // shard_bytes))
    one_in = max(1, total["rows"] // SAMPLE)
    sample = slim.where(F.pmod(F.xxhash64("place"), F.lit(one_in)) == 0).select("place", "size").orderBy("place").collect()
    bounds, goal, seen = [], sum(r["size"] + 500 for r in sample) / shards, 0
    for r in sample:
        if seen >= goal * (len(bounds) + 1) and len(bounds) + 1 < shards and r["place"] not in bounds[-1:]:
            bounds.append(r["place"])
        seen += r["size"] + 500
    cuts = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<string>")
    shard = search(cuts, F.col("place"), len(bounds))

    records = rows.select(shard.alias("shard"), "place", F.lit(1).alias("kind"), "page_id", "url", "html", "digest", F.lit(None).cast("long").alias("first"))
    decided = repeats.select(shard.alias("shard"), "place", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("page_id"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), F.lit(None).cast("string").alias("digest"), "first")
    dealt = records.unionByName(decided).repartitionById(len(bounds) + 1, "shard").sortWithinPartitions("shard", "place", "kind", "url")

    def write(batches):
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        out, shard, refers, done = None, None, None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["kind"] == 0:
                    refers = (r["place"], r["first"])
                    continue
                if r["shard"] != shard or out.bytes >= roll_bytes:
                    if out:
                        done.append(out.close())
                    number = 0 if r["shard"] != shard else number + 1  # noqa: F821
                    shard = r["shard"]
                    out = _File(store, base, f"part-{shard:06d}-{number:05d}.warc.gz")
                out.add(record(r, refers[1] if refers and refers[0] == r["place"] else None))
        if out:
            done.append(out.close())
        yield pa.RecordBatch.from_pylist(done, schema=_MANIFEST) if done else pa.RecordBatch.from_pylist([], schema=_MANIFEST)

    made = written(dealt.mapInArrow(write, "file string, records long, bytes long, sha256 string"), "manifest")
    store, base = _store(folder)
    store.create_dir(base, recursive=True)
    hidden = f"{base}/_manifest.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(hidden) as out:  # one line a file of roll_bytes
        for r in made.orderBy("file").toLocalIterator():
            out.write((json.dumps(r.asDict()) + "\n").encode())
    store.move(hidden, f"{base}/MANIFEST.jsonl")
    return made


_MANIFEST = pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])


def _store(folder: str):
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder)


class _File:
    """One archive under a temporary name; close() renames it."""

    def __init__(self, store, base: str, name: str):
        self.store, self.base, self.name = store, base, name
        self.hidden = f"{base}/_{name}.{uuid.uuid4().hex}.tmp"
        self.out, self.bytes, self.records, self.digest = store.open_output_stream(self.hidden), 0, 0, hashlib.sha256()
        self._member(_block("warcinfo", "info-" + name, b"software: upkeep\r\nformat: WARC File Format 1.1\r\n", [("Content-Type", "application/warc-fields"), ("WARC-Filename", name)]))

    def _member(self, raw: bytes) -> None:
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        packed = pack.compress(raw) + pack.flush()
        self.out.write(packed)
        self.bytes += len(packed)
        self.digest.update(packed)

    def add(self, raw: bytes) -> None:
        self._member(raw)
        self.records += 1

    def close(self) -> dict:
        self.out.close()
        self.store.move(self.hidden, f"{self.base}/{self.name}")
        return {"file": self.name, "records": self.records, "bytes": self.bytes, "sha256": self.digest.hexdigest()}


def _block(kind: str, identity: str, body: bytes, headers: list[tuple[str, str]]) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, identity)}>"), ("WARC-Date", DATE),
             *headers, ("WARC-Block-Digest", "sha256:" + hashlib.sha256(body).hexdigest()), ("Content-Length", str(len(body)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + body + b"\r\n\r\n"


def _plain(value: str) -> str:
    """A header value without line breaks."""
    return "".join(c if c not in "\r\n%" else f"%{ord(c):02X}" for c in value) if any(c in value for c in "\r\n") else value


def record(row: dict, refers) -> bytes:
    """A row as a WARC record. The headers, those of the HTTP answer too, are made anew."""
    payload = row["html"].encode()
    number = "" if row["page_id"] is None else str(row["page_id"])
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    headers = [("WARC-Target-URI", _plain(row["url"]) if row["url"] else f"urn:page:{number}"), ("WARC-Page-ID", number),
               ("WARC-Payload-Digest", "sha256:" + row["digest"]), ("Content-Type", "application/http; msgtype=response")]
    if refers is None:
        return _block("response", row["place"], http.encode() + f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload, headers)
    headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                ("WARC-Refers-To-Page-ID", str(refers)), ("WARC-Payload-Length", str(len(payload)))]
    return _block("revisit", row["place"], (http + "\r\n").encode(), headers)


def records(data: bytes):
    """(headers, block) of the records of a gzip archive; a digest that does not fit its block is an error."""
    at = 0
    while at < len(data):
        unpack = zlib.decompressobj(31)
        raw = unpack.decompress(data[at : at + (1 << 16)])
        at += 1 << 16
        parts = [raw]
        while not unpack.eof and at < len(data):
            parts.append(unpack.decompress(data[at : at + (1 << 20)]))
            at += 1 << 20
        if not unpack.eof:
            raise ValueError("archive ends within a record")
        at = min(at, len(data)) - len(unpack.unused_data)
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        block = rest[: int(headers["Content-Length"])]
        if "sha256:" + hashlib.sha256(block).hexdigest() != headers["WARC-Block-Digest"]:
            raise ValueError(f"digest of {headers['WARC-Record-ID']} does not fit")
        yield headers, block


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the files that the manifest names, one row each; files are read by Spark, one a row."""
    manifest = spark.read.schema("file string, records long, bytes long, sha256 string").json(f"{folder}/MANIFEST.jsonl")

    def parse(batches):
        for batch in batches:
            for name, data, right in zip(*(batch.column(c) for c in ("file", "content", "sha256"))):
                data, rows = data.as_py(), []
                if hashlib.sha256(data).hexdigest() != right.as_py():
                    raise ValueError(f"{name}: content differs from the manifest")
                weight = 0
                for h, block in records(data):
                    if h["WARC-Type"] == "warcinfo":
                        continue
                    payload = block.partition(b"\r\n\r\n")[2] if h["WARC-Type"] == "response" else None
                    rows.append({
                        "file": name.as_py(), "page_id": int(h["WARC-Page-ID"]) if h["WARC-Page-ID"] else None, "url": h["WARC-Target-URI"],
                        "record_type": h["WARC-Type"], "payload": payload,
                        "payload_bytes": len(payload) if payload is not None else int(h["WARC-Payload-Length"]),
                        "payload_digest": hashlib.sha256(payload).hexdigest() if payload is not None else h["WARC-Payload-Digest"].removeprefix("sha256:"),
                        "refers_to": int(h["WARC-Refers-To-Page-ID"]) if "WARC-Refers-To-Page-ID" in h else None})
                    weight += len(block)
                    if weight > 1 << 23:
                        yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)
                        rows, weight = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.warc.gz").load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").join(manifest, "file")
    return named.select("file", "content", "sha256").mapInArrow(parse, RECORD)


_RECORD = pa.schema([("file", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])

"""Operator 5: deterministic sharded WARC writer and its reader.

Records are sorted by (page_id, payload digest, URL digest) and cut into shards
of near equal bytes; where to cut follows from exact running sums over all
keys, so neither sampling, partitioning nor session settings change a byte.
One shard is one task.  It appends gzip members to a file until it reaches the
target of compressed bytes, then rolls to the next.  Headers and digests are
made anew from the payload, dates are a parameter, and nothing depends on the
task attempt, so a retry writes the same bytes.  Files appear under a temporary
name and are renamed when complete; the list of files is committed as a
manifest table at the end, and the reader opens nothing that the manifest does
not name.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .util import app_scratch_dir, materialize, shuffle_partitions

VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, shard int, bytes long, records long, sha256 string"
OVERHEAD = 512  # bytes that a record counts beside its payload
PAGE, PREFIX = 16, 56  # characters of a sort key for the page_id, and for page_id and payload digest
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, file string, offset long, payload binary, digest_ok boolean"


@dataclass(frozen=True)
class WarcOptions:
    file_bytes: int = 64 << 20  # compressed bytes at which a file is closed
    least_revisit: int = 0  # smaller payloads are never revisits
    date: str = "2020-01-01T00:00:00Z"
    level: int = 4
    shard_bytes: int = 1 << 30  # payload bytes of a shard, within these numbers of shards
    least_shards: int = 64
    most_shards: int = 16384  # bounds what the driver holds of the cuts


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or path: file, hdfs, s3 or gs as Arrow has them."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + uri)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, copy: int) -> str:
    name = "null" if page_id is None else str(page_id)
    return f"<urn:page:{name}:{copy}>" if copy else f"<urn:page:{name}>"


def page_of(record: str) -> int | None:
    name = record.strip("<>").split(":")[2]
    return None if name == "null" else int(name)


def target_uri(url: str | None) -> str:
    """The URL with control characters, spaces and other bytes that a header can't hold escaped."""
    return "urn:no-url" if url is None else "urn:empty-url" if url == "" else quote(url, safe="!#$%&'()*+,/:;=?@[]~-._|\\^`{}\"<>")


def member(headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    """One record as a gzip member without name or time."""
    head = VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(head.encode() + block + b"\r\n\r\n") + z.flush()


def page_record(page_id: int | None, copy: int, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, o: WarcOptions) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, copy)), ("WARC-Date", o.date),
               ("WARC-Target-URI", target_uri(url)), ("Content-Type", "application/http; msgtype=response"),
               ("WARC-Payload-Digest", "sha1:" + digest), ("WARC-Block-Digest", "sha1:" + base32_sha1(block))]
    if revisit:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, 0)), ("WARC-Truncated", "length")]
    return member(headers, block, o.level)


class Roller:
    """Writes one shard: files under temporary names, renamed when full."""

    def __init__(self, root: str, shard: int, attempt: str, o: WarcOptions) -> None:
        self.fs, self.root = open_store(root)
        self.shard, self.attempt, self.o = shard, attempt, o
        self.seq, self.out, self.done = 0, None, []

    def _start(self) -> None:
        self.name = f"shard-{self.shard:05d}-{self.seq:05d}.warc.gz"
        self.temp = f"{self.root}/_temporary/{self.attempt}-{self.name}"
        self.out = self.fs.open_output_stream(self.temp, compression=None)
        self.size = self.records = 0
        self.sha = hashlib.sha256()
        info = f"software: warc writer\r\nformat: {VERSION}\r\nisPartOf: {self.name}\r\n".encode()
        headers = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:file:{self.name}>"), ("WARC-Date", self.o.date), ("WARC-Filename", self.name),
                   ("Content-Type", "application/warc-fields"), ("WARC-Block-Digest", "sha1:" + base32_sha1(info))]
        self._put(member(headers, info, self.o.level))

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)

    def add(self, data: bytes) -> None:
        if self.out is None:
            self._start()
        self._put(data)
        self.records += 1
        if self.size >= self.o.file_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.temp, f"{self.root}/{self.name}")  # another attempt's file has the same bytes
            self.done.append((self.name, self.shard, self.size, self.records, self.sha.hexdigest()))
            self.seq, self.out = self.seq + 1, None


def page_key(page_id: Column) -> Column:
    """16 characters in the order of the page_id, null first."""
    return F.when(page_id.isNull(), F.lit("-" * PAGE)).otherwise(F.lpad(F.hex(page_id.bitwiseXOR(F.lit(-(1 << 63)))), PAGE, "0"))


def page_rows(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, sha, key) of every page; rows of one key make equal records."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    url = F.when(F.col("url").isNull(), F.lit("-" * 40)).otherwise(F.sha1(F.col("url").cast("binary")))
    return rows.withColumn("key", F.concat(page_key(F.col("page_id")), "sha", url))


def revisits(keys: DataFrame, least: int) -> DataFrame:
    """(page_id, sha, refers_to) of the pages whose payload another page with a
    larger page_id has; the payloads themselves do not move."""
    rows = keys.where(F.col("size") >= least).select("page_id", "sha")
    same = rows.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")  # partial sums shrink a hot payload
    return rows.join(same, "sha").where("NOT refers_to <=> page_id").select("page_id", "sha", "refers_to").distinct()


@dataclass
class Cuts:
    """Where shards begin.  ``firsts`` are the smallest keys of the shards
    ``shards``; rows of one key that lie in several shards are in ``split``:
    key -> (shard, rows) each.  ``copies``: rows of a shard's first page_id
    in earlier shards."""

    shards: int
    firsts: list[str] = field(default_factory=list)
    numbers: list[int] = field(default_factory=list)
    split: dict[str, list[tuple[int, int]]] = field(default_factory=dict)
    copies: dict[int, int] = field(default_factory=dict)


def running_sums(keys: DataFrame) -> DataFrame:
    """(key, n, weight, rank, before) of every key: its rows, the bytes of one,
    and the rows and bytes of all smaller keys.  A sort into ranges written once
    and a running sum within each: the ranges' borders do not change a sum."""
    counts = keys.groupBy("key").agg(F.count("*").alias("n"), (F.max("size") + OVERHEAD).alias("weight"))
    ranged = materialize(counts.repartitionByRange(shuffle_partitions(keys.sparkSession), "key").withColumn("part", F.spark_partition_id()), "warc-keys")
    sums = ranged.groupBy("part").agg(F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("weight")).alias("bytes"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = sums.select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows"), F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes"))
    smaller = Window.partitionBy("part").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    rank = F.coalesce(F.sum("n").over(smaller), F.lit(0)) + F.col("rows")
    before = F.coalesce(F.sum(F.col("n") * F.col("weight")).over(smaller), F.lit(0)) + F.col("bytes")
    return materialize(ranged.join(F.broadcast(starts), "part").select("key", "n", "weight", rank.alias("rank"), before.alias("before")), "warc-sums")


def find_cuts(keys: DataFrame, o: WarcOptions, shards: int | None = None) -> Cuts:
    """Shards of near equal bytes: a row goes where the bytes before it say.
    The driver gets at most three rows for each shard."""
    sums = running_sums(keys)
    total = sums.agg(F.sum(F.col("n") * F.col("weight"))).first()[0]
    if not total:
        return Cuts(1, [""], [0])
    shards = shards or min(max(-(-int(total) // o.shard_bytes), o.least_shards), o.most_shards)
    width = -(-int(total) // shards)
    first, last = F.expr(f"before div {width}"), F.expr(f"(before + (n - 1) * weight) div {width}")
    at = sums.withColumns({"first": first, "last": last})
    begins = at.groupBy("first").agg(F.min(F.struct("key", "rank")).alias("at")).orderBy("first").collect()
    cuts = Cuts(shards, [r["at"]["key"] for r in begins], [int(r["first"]) for r in begins])
    opening = {int(r["first"]): (r["at"]["key"][:PAGE], r["at"]["rank"]) for r in begins}
    for r in at.where("first < last").collect():  # at most one a shard
        done = 0
        for shard in range(r["first"], r["last"] + 1):
            upto = min(r.n, -(-((shard + 1) * width - r.before) // r.weight))  # rows that begin before the shard's end
            if upto > done:
                if done:
                    opening[shard] = (r.key[:PAGE], r["rank"] + done)
                cuts.split.setdefault(r.key, []).append((shard, upto - done))
                done = upto
    wanted = sorted({page for page, _ in opening.values()})
    page = F.substring("key", 1, PAGE)
    started = dict(sums.groupBy(page.alias("page")).agg(F.min("rank").alias("rank")).join(F.broadcast(_column(sums.sparkSession, "page", wanted)), "page").collect())
    cuts.copies = {shard: rank - started[page] for shard, (page, rank) in opening.items() if rank > started[page]}
    return cuts


def _column(spark: SparkSession, name: str, values: list[str]) -> DataFrame:
    return spark.createDataFrame(pa.table({name: pa.array(values, pa.string())}))


def deal(rows: DataFrame, notes: DataFrame, cuts: Cuts) -> DataFrame:
    """Pages and notes with their shard.  A key whose rows lie in several shards
    moves as one row for each of them, with the number of its records."""
    firsts, numbers, split = cuts.firsts, cuts.numbers, cuts.split
    tail = sorted(split)

    def place(key: str) -> int:
        return -1 if key in split else numbers[max(0, bisect_right(firsts, key) - 1)]

    def reach(prefix: str) -> list[int]:
        """From the first to the last shard that can hold keys with the prefix."""
        lo, hi = (numbers[max(0, bisect_right(firsts, k) - 1)] for k in (prefix, prefix + "~"))
        k = bisect_right(tail, prefix + "~") - 1
        if k >= 0 and tail[k].startswith(prefix):
            hi = max(hi, split[tail[k]][-1][0])
        return list(range(lo, hi + 1))

    @F.arrow_udf("int")
    def shard_of(keys: pa.Array) -> pa.Array:
        return pa.array([place(k) for k in keys.to_pylist()], pa.int32())

    @F.arrow_udf("array<int>")
    def shards_of(prefixes: pa.Array) -> pa.Array:
        return pa.array([reach(p) for p in prefixes.to_pylist()], pa.list_(pa.int32()))

    dealt = rows.withColumns({"shard": shard_of("key"), "copies": F.lit(1).cast("long")}).where("shard >= 0")
    if split:
        spark = rows.sparkSession
        parts = [(k, shard, n) for k, v in split.items() for shard, n in v]
        table = spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(zip(*parts, strict=True), [pa.string(), pa.int32(), pa.int64()], strict=True)], names=["key", "shard", "copies"]))
        one = rows.join(F.broadcast(_column(spark, "key", tail)), "key").groupBy("key").agg(*[F.first(c).alias(c) for c in ["page_id", "url", "payload", "sha"]])
        dealt = dealt.unionByName(one.join(F.broadcast(table), "key"))
    prefix = F.concat(page_key(F.col("page_id")), "sha")
    notes = notes.withColumn("key", prefix).withColumn("shard", F.explode(shards_of("key")))
    full = dealt.withColumns({"refers_to": F.lit(None).cast("long"), "is_page": F.lit(True)})
    return full.unionByName(notes.withColumn("is_page", F.lit(False)), allowMissingColumns=True)


def write_warc(pages: DataFrame, root: str, o: WarcOptions = WarcOptions(), shards: int | None = None) -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html) below
    ``root`` and return the manifest (file, shard, bytes, records, sha256).

    Of the rows with equal payloads of at least ``o.least_revisit`` bytes that
    with the largest page_id is a response and others revisit it; smaller ones
    are all responses.  Null html: an empty payload; very long ones are one
    record.  Null page_id: sorted first, never the largest, unless a payload has
    no other row, which are all responses then.  Rows that repeat the largest
    page_id are all responses, told apart by a copy number, and may lie in
    several shards.  Null or empty URLs get a ``urn:`` target.  Empty table: an
    empty manifest.  Extra columns are not read.

    The number of shards is ``shards``, or follows from the bytes (see
    ``WarcOptions``).  The same rows always give the same files."""
    spark = pages.sparkSession
    store, path = open_store(root)
    store.create_dir(f"{path}/_temporary", recursive=True)
    rows = page_rows(pages)
    keys = materialize(rows.select("key", "page_id", "sha", F.octet_length("payload").cast("long").alias("size")), "warc-pages")
    cuts = find_cuts(keys, o, shards)
    # a page's reference travels as a short row that sorts just before it: payloads move once
    dealt = deal(rows, revisits(keys, o.least_revisit), cuts).repartitionById(cuts.shards, F.col("shard"))
    dealt = dealt.sortWithinPartitions("key").select("page_id", "url", "payload", "sha", "refers_to", "is_page", "copies", "shard")
    copies = cuts.copies

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = last = None
        noted: tuple = (None, None, None)
        for b in batches:
            for page_id, url, payload, sha, refers_to, is_page, n, shard in zip(*b.columns, strict=True):
                page_id, sha = page_id.as_py(), sha.as_py()
                if not is_page.as_py():
                    noted = (page_id, sha, refers_to.as_py())
                    continue
                if roll is None:
                    roll = Roller(root, shard.as_py(), f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}", o)
                    last = (page_id, copies.get(roll.shard, 0) - 1)
                to = noted[2] if noted[:2] == (page_id, sha) else None
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                target, data = url.as_py(), payload.as_py()
                for _ in range(n.as_py()):
                    last = (page_id, last[1] + 1 if page_id == last[0] else 0)
                    roll.add(page_record(page_id, last[1], target, data, digest, to, to is not None, o))
        done = []
        if roll is not None:
            roll.close()
            done = roll.done
        cols = list(zip(*done, strict=True)) if done else [[]] * 5
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["file", "shard", "bytes", "records", "sha256"])

    manifest = f"{root}/manifest"
    dealt.mapInArrow(write, MANIFEST).write.parquet(manifest)  # its own commit makes the archive visible
    store.delete_dir(f"{path}/_temporary")
    return spark.read.schema(MANIFEST).parquet(manifest)


def _records(stream) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of each gzip member of a stream."""
    held, offset, eof = b"", 0, False
    while True:
        z, parts, used = zlib.decompressobj(31), [], 0
        while not z.eof:
            if not held:
                held = stream.read(1 << 20)
                if not held:
                    eof = True
                    break
            parts.append(z.decompress(held))
            used += len(held) - len(z.unused_data)
            held = z.unused_data
        if eof:
            if parts and any(parts):
                raise ValueError("truncated WARC file")
            return
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        n = int(headers["Content-Length"])
        if lines[0] != VERSION or rest[n:] != b"\r\n\r\n":
            raise ValueError("damaged WARC record")
        yield offset, headers, rest[:n]
        offset += used


def read_warc(manifest: DataFrame, root: str, payloads: bool = True) -> DataFrame:
    """The page records of the archives that ``manifest`` names, a task for a file.

    payload_bytes and payload_digest are those of the full payload, also for
    revisits, whose payload is null.  digest_ok: the block (and a response's
    payload) has the digest that its header states."""
    spark = manifest.sparkSession
    files = manifest.select("file", "bytes")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(root)
        for b in batches:
            for name in b.column(0).to_pylist():
                out, size = [], 0
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for offset, h, block in _records(stream):
                        if h["WARC-Type"] == "warcinfo":
                            continue
                        http, _, body = block.partition(b"\r\n\r\n")
                        length = int(http.decode().lower().rpartition("content-length: ")[2].split("\r\n")[0])
                        digest = h["WARC-Payload-Digest"].partition(":")[2]
                        revisit = h["WARC-Type"] == "revisit"
                        ok = base32_sha1(block) == h["WARC-Block-Digest"].partition(":")[2] and (revisit or base32_sha1(body) == digest and len(body) == length)
                        out.append((page_of(h["WARC-Record-ID"]), h["WARC-Target-URI"], length, digest, h["WARC-Type"], page_of(h["WARC-Refers-To"]) if revisit else None, name, offset,
                                    None if revisit or not payloads else body, ok))
                        size += len(block)
                        if size > 8 << 20:
                            yield _batch(out)
                            out, size = [], 0
                yield _batch(out)

    return files.repartition(shuffle_partitions(spark)).mapInArrow(rows, RECORD)


def _batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.bool_()]
    cols = list(zip(*out, strict=True)) if out else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in RECORD.split(", ")])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    root = f"{app_scratch_dir(spark)}/warc-{uuid.uuid4().hex[:12]}"
    records = read_warc(write_warc(pages, root), root, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")

"""WARC archives with a two-level capture index.

Pages are written in order of their reversed-host URL key, one gzip member per
record.  The index lines of a shard, in the same order, are cut into compressed
blocks; a sparse directory at the shard's end holds the first key of each block.
A lookup searches the list of shards, then the shard's directory, reads one
block, searches it, and reads the record's byte range.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import files, runtime
from cairn.llm.scratch import Scratch

#: Payloads of fewer bytes are never stored as revisits.
MIN_REVISIT_BYTES = 1000
#: Index lines of one compressed block.
BLOCK_LINES = 512
#: Bytes of adjacent records that one range read takes together, at most.
READ_BYTES = 1 << 20
GZIP_LEVEL = 3
#: Date of records whose pages carry none.
RECORD_DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FOOTER = struct.Struct("<QI4s")
_MAGIC = b"CDX2"


# --- records ---------------------------------------------------------------


def _page_urn(page_id: int | None) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}"


def _page_of(urn: str) -> int | None:
    name = urn.strip("<>").rpartition(":")[2]
    return None if name == "none" else int(name)


def _header_value(text: str) -> str:
    """A URL as a header value: control characters and spaces are percent-encoded."""
    return "".join(c if "!" <= c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def record_bytes(page_id: int | None, url: str | None, payload: bytes | None, payload_bytes: int,
                 sha1_hex: str, refers_to: int | None, date: str = RECORD_DATE) -> bytes:
    """One WARC record: a response with its payload, or a revisit (payload None) of another page's."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {payload_bytes}\r\n\r\n").encode()
    content = http + (payload or b"")
    digest = base64.b32encode(bytes.fromhex(sha1_hex)).decode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}",
            f"WARC-Record-ID: <{_page_urn(page_id)}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_value(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if payload is None:
        head += [f"WARC-Refers-To: <{_page_urn(refers_to)}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(content)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + content + b"\r\n\r\n"


@dataclass
class Record:
    headers: dict[str, str]
    http_headers: dict[str, str]
    payload: bytes

    @property
    def page_id(self) -> int | None:
        return _page_of(self.headers["warc-record-id"])

    @property
    def is_revisit(self) -> bool:
        return self.headers["warc-type"] == "revisit"

    @property
    def refers_to(self) -> int | None:
        return _page_of(self.headers["warc-refers-to"]) if self.is_revisit else None

    @property
    def declared_sha1(self) -> str:
        return base64.b32decode(self.headers["warc-payload-digest"].partition(":")[2]).hex()


def parse_record(raw: bytes) -> Record:
    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    headers = _fields(head)
    content = rest[: int(headers["content-length"])]
    http, _, payload = content.partition(b"\r\n\r\n")
    return Record(headers, _fields(http), payload)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


# --- capture index ---------------------------------------------------------


def capture_key(url: Column) -> Column:
    """The URL with its host's labels reversed, ``com,example)/path?query``; ``-`` for none. No white space."""
    text = F.coalesce(url, F.lit(""))
    rest = F.when(F.locate("://", text) > 0, F.substr(text, F.locate("://", text) + 3)).otherwise(F.lit(""))
    host = F.lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^#]*)", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path)
    return F.when(rest == "", F.lit("-")).otherwise(F.regexp_replace(key, r"[\x00-\x20\x7F\s]", "_"))


class IndexWriter:
    """Compressed blocks of sorted lines and, at the end, their directory."""

    def __init__(self, uri: str):
        self.out = files.Writer(uri)
        self.lines: list[str] = []
        self.directory: list[tuple[str, int, int]] = []

    def add(self, line: str) -> None:
        self.lines.append(line)
        if len(self.lines) >= BLOCK_LINES:
            self._flush()

    def _flush(self) -> None:
        if self.lines:
            block = zlib.compress("\n".join(self.lines).encode(), GZIP_LEVEL)
            self.directory.append((self.lines[0].split(" ", 1)[0], self.out.write(block), len(block)))
            self.lines = []

    def close(self) -> None:
        self._flush()
        packed = zlib.compress(json.dumps(self.directory).encode(), GZIP_LEVEL)
        at = self.out.write(packed)
        self.out.write(_FOOTER.pack(at, len(packed), _MAGIC))
        self.out.close()


class IndexReader:
    """Searches one shard: directory first, then one block."""

    def __init__(self, uri: str):
        self.reader = files.Reader(uri)
        size = self.reader.size()
        at, length, magic = _FOOTER.unpack(self.reader.read(size - _FOOTER.size, _FOOTER.size))
        if magic != _MAGIC:
            raise ValueError("not a capture index")
        self.directory = json.loads(zlib.decompress(self.reader.read(at, length)))
        self.first_keys = [d[0].encode() for d in self.directory]
        self._held: tuple[int, list[list[str]], list[bytes]] | None = None

    def _block(self, i: int) -> tuple[list[list[str]], list[bytes]]:
        if self._held is None or self._held[0] != i:
            _, at, length = self.directory[i]
            lines = [x.split(" ") for x in zlib.decompress(self.reader.read(at, length)).decode().split("\n")]
            self._held = (i, lines, [x[0].encode() for x in lines])
        return self._held[1], self._held[2]

    def find(self, key: str) -> list[list[str]]:
        """Fields of all lines of a key: key, page, archive's offset, length, type."""
        wanted, found = key.encode(), []
        i = max(0, bisect.bisect_left(self.first_keys, wanted) - 1)
        while i < len(self.directory) and self.first_keys[i] <= wanted:
            lines, keys = self._block(i)
            j = bisect.bisect_left(keys, wanted)
            while j < len(keys) and keys[j] == wanted:
                found.append(lines[j])
                j += 1
            i += 1
        return found

    def close(self) -> None:
        self.reader.close()


# --- writing ---------------------------------------------------------------


@dataclass
class Archive:
    """Shards in key order: (archive uri, index uri, first key, last key)."""

    spark: SparkSession
    shards: list[tuple[str, str, str, str]]


def page_key(page_id: Column, url: Column) -> Column:
    """The capture key of a page: its URL's key and its id, so that keys are unique."""
    return F.concat_ws("!", capture_key(url), F.coalesce(page_id.cast("string"), F.lit("none")))


def plan_records(pages: DataFrame, scratch: Scratch, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``key, page_id, url, html, payload_bytes, sha1, refers_to`` of each page; refers_to is set for revisits."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html"), F.octet_length(payload).cast("long").alias("payload_bytes"),
                        F.sha1(payload).alias("sha1"))
    # a row for each payload that occurs again, written so that Spark knows its size: payloads move for the join only if it is large
    stored = scratch.cut(rows.where(F.col("payload_bytes") >= min_bytes).groupBy("sha1").agg(
        F.max("page_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").select("sha1", "_first"), "stored")
    refers = F.when((F.col("payload_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    return rows.join(stored, "sha1", "left").select(
        page_key(F.col("page_id"), F.col("url")).alias("key"),
        "page_id", "url", F.when(refers.isNull(), F.coalesce("html", F.lit(""))).alias("html"),
        "payload_bytes", "sha1", refers.alias("refers_to"))


def write_archive(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES, shards: int | None = None) -> Archive:
    """Write a record for each page, with the index of each shard.

    Null html is an empty payload; a null URL has no target and the key ``-``.
    Of equal payloads of ``min_bytes`` or more the page of largest id is the
    response; repeated rows of that page are responses too.  Repeated rows get a
    record each; an empty table gives an archive without shards.
    """
    spark = pages.sparkSession
    runtime.prepare(spark)
    scratch = Scratch(spark, "warc")
    folder = folder or scratch.path("archive")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out = index = first = last = None
        for b in batches:
            for r in b.to_pylist():
                if out is None:
                    out = files.Writer(files.fresh_name(folder, "archive", part, ".warc.gz"))
                    index = IndexWriter(files.fresh_name(folder, "index", part, ".cdx"))
                    first = r["key"]
                payload = None if r["html"] is None else r["html"].encode()
                raw = record_bytes(r["page_id"], r["url"], payload, r["payload_bytes"], r["sha1"], r["refers_to"])
                packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
                member = packer.compress(raw) + packer.flush()
                at = out.write(member)
                index.add(f"{r['key']} {r['page_id']} {at} {len(member)} {'revisit' if payload is None else 'response'}")
                last = r["key"]
        if out is not None:
            out.close()
            index.close()
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "warc": [out.uri], "cdx": [index.out.uri], "first": [first], "last": [last]})

    rows = plan_records(pages, scratch, id_col, url_col, html_col, min_bytes)
    manifest = (
        rows.repartitionByRange(shards or runtime.partitions_for(spark), "key").sortWithinPartitions("key")
        .mapInArrow(run, "part long, warc string, cdx string, first string, last string").collect()
    )
    return Archive(spark, [(r.warc, r.cdx, r["first"], r["last"]) for r in sorted(manifest, key=lambda r: r.part)])


# --- reading ---------------------------------------------------------------


def look_up(archive: Archive, keys: DataFrame) -> DataFrame:
    """Read the records of capture keys back through the index.

    keys: a column ``key``.  Returns ``page_id, key, record_type, refers_to, payload_bytes, payload_digest,
    target_uri, payload`` for every line of every distinct key; the payload of a revisit is null, and its
    length and digest are those that the record declares for the full payload.  A response whose payload
    does not have the declared digest fails the job.
    """
    firsts = archive.spark.sparkContext.broadcast([s[2].encode() for s in archive.shards])
    shards = archive.spark.sparkContext.broadcast([s[:2] for s in archive.shards])

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = b.column("key").to_pylist()
            at = [max(0, bisect.bisect_right(firsts.value, k.encode()) - 1) for k in found]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(found, pa.string())], names=["shard", "key"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_shard, index, warc = None, None, None
        for b in batches:
            lines: list[list[str]] = []
            for shard, key in zip(b.column("shard").to_pylist(), b.column("key").to_pylist()):
                if shard != open_shard:
                    yield from _records(warc, lines)
                    lines = []
                    if index is not None:
                        index.close()
                        warc.close()
                    index, warc = IndexReader(shards.value[shard][1]), files.Reader(shards.value[shard][0])
                    open_shard = shard
                lines += index.find(key)
            yield from _records(warc, lines)

    wanted = keys.select("key").where(F.col("key").isNotNull()).distinct()
    if not archive.shards:
        wanted = wanted.where("false")
    return (
        wanted.mapInArrow(locate, "shard long, key string")
        .repartition(max(1, len(archive.shards)), "shard").sortWithinPartitions("shard", "key")
        .mapInArrow(read, "page_id long, key string, record_type string, refers_to long, payload_bytes long, "
                          "payload_digest string, target_uri string, payload binary")
    )


def _records(warc: files.Reader | None, lines: list[list[str]]) -> Iterator[pa.RecordBatch]:
    """Records of index lines of one archive, reading adjacent ranges together."""
    i = 0
    while i < len(lines):
        begin, j = int(lines[i][2]), i
        end = begin
        while j < len(lines) and int(lines[j][2]) == end and (j == i or end + int(lines[j][3]) - begin <= READ_BYTES):
            end += int(lines[j][3])
            j += 1
        raw = warc.read(begin, end - begin)
        out: dict[str, list] = {n: [] for n in (
            "page_id", "key", "record_type", "refers_to", "payload_bytes", "payload_digest", "target_uri", "payload")}
        for line in lines[i:j]:
            at = int(line[2]) - begin
            record = parse_record(zlib.decompress(raw[at : at + int(line[3])], 31))
            if record.is_revisit:
                size, digest, payload = int(record.http_headers["content-length"]), record.declared_sha1, None
            else:
                size, digest, payload = len(record.payload), hashlib.sha1(record.payload).hexdigest(), record.payload
                if digest != record.declared_sha1:
                    raise ValueError(f"payload of {record.headers['warc-record-id']} does not have its digest")
            for name, value in zip(out, (record.page_id, line[0], record.headers["warc-type"], record.refers_to,
                                         size, digest, record.headers.get("warc-target-uri"), payload)):
                out[name].append(value)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
            ("page_id", pa.int64()), ("key", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("target_uri", pa.string()),
            ("payload", pa.binary())]))
        i = j

"""WARC archives with a two-level capture index.

Writing: one record per page, gzipped on its own, laid end to end in archive files that Spark's
text writer commits to any file system it knows (so a lost executor or a second attempt leaves no
half file). Of pages with equal payloads the one with the largest id is a response, the others are
revisits that refer to it.

Index: every capture is a line keyed by its reversed-host URL. Lines are range-partitioned and
sorted by key, cut into blocks, and each block is compressed: the first level. The second level is
a sparse directory with the first key of each block. A look-up searches the directory by bisection,
unpacks one block, searches it by bisection, and reads one range of one archive.

Whole tables are read back that way: the keys of all pages find their blocks in the directory (its size is bounded, since blocks grow with the
index), meet them in tasks by block, and the captures found there are read by range in tasks by archive file, where every record is held against
its line. Archives are bounded by their number of records.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom.llm.rows import col
from patchloom.operators.sketch import key_sketch
from patchloom.session import fresh_path, materialised

#: Captures in one index block, the most blocks of an index (blocks of a larger one hold more), and the most records of an archive file.
BLOCK_LINES, MOST_BLOCKS, ARCHIVE_RECORDS = 3000, 200_000, 4096
_LEVEL = 3
_CHUNK = 1 << 16

# Every archive row ends with this byte, written as the text writer's line separator. The last byte of a gzip member is
# the high byte of its length; it is zero below 16 MiB, and always zero for the empty member that is put behind others.
_LAST = b"\0"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


_EMPTY = _member(b"")


def packed(record: bytes) -> bytes:
    """A record as gzip members, the last byte being zero."""
    data = _member(record)
    return data if data.endswith(_LAST) else data + _EMPTY


def records(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of every non-empty gzip member; an empty one belongs to the record before it."""
    view, at, held = memoryview(data), 0, None
    while at < len(data):
        start, unpacker, out = at, zlib.decompressobj(31), []
        while not unpacker.eof:
            if at >= len(data):
                raise ValueError("the archive ends inside a record")
            chunk = view[at: at + _CHUNK]
            out.append(unpacker.decompress(chunk))
            at += len(chunk) - len(unpacker.unused_data)
        record = b"".join(out)
        if record:
            if held:
                yield held
            held = (start, at - start, record)
        elif held:
            held = (held[0], at - held[0], held[2])
    if held:
        yield held


def _header_safe(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f%]", lambda m: quote(m[0], safe=""), url)


def warc_record(page_id, url: str | None, payload: bytes, digest: str, refers_to, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One response record, or a revisit record (without payload) where ``refers_to`` is an id. Every record has an id of its own; page ids
    stand in headers beside it."""
    head = [b"WARC/1.1", b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"),
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>".encode(), f"WARC-Date: {date}".encode()]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}".encode())
    if url is not None:
        head.append(b"WARC-Target-URI: " + _header_safe(url).encode("utf-8", "surrogatepass"))
    head += [b"WARC-Payload-Digest: sha1:" + digest.encode(), f"X-Payload-Length: {len(payload)}".encode()]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is None:
        block = http + f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload
    else:
        head += [f"X-Refers-To-Page: {refers_to}".encode(),
                 b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        block = http + b"\r\n"
    head += [b"Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}".encode()]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(record: bytes) -> dict:
    """Headers and, for a response, the payload of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b": ")
        fields[name.decode()] = value.decode("utf-8", "surrogatepass")
    block = rest[: int(fields["Content-Length"])]
    kind = fields["WARC-Type"]
    url = fields.get("WARC-Target-URI")
    return {
        "page_id": fields.get("X-Page-Id"), "url": None if url is None else unquote(url),
        "record_type": kind, "refers_to": fields.get("X-Refers-To-Page"),
        "digest": fields["WARC-Payload-Digest"][len("sha1:"):], "payload_bytes": int(fields["X-Payload-Length"]),
        "payload": block.partition(b"\r\n\r\n")[2] if kind == "response" else None,
    }


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """The sort key of a URL: host labels reversed, then port, path and query; scheme, user, ``www.`` and fragment left out."""
    if url is None:
        return ""
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url.strip()).partition("#")[0]
    host, slash, path = re.match(r"([^/?]*)([/?]?)(.*)$", rest, re.S).groups()
    host = host.rpartition("@")[2].lower()
    host, _, port = host.partition(":")
    if host.startswith("www."):
        host = host[4:]
    path = "/" + (path if slash == "/" else slash + path)
    return ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in ("80", "443") else "") + ")" + path


def write_archives(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0,
) -> str:
    """Writes a record for every row of ``pages`` under ``path`` and returns it.

    The payload is ``html`` in UTF-8 (null: empty). Among records with equal payloads of at least ``least_bytes`` bytes,
    those with the largest id are responses and the others revisits of it; smaller payloads are all responses. A null id is never
    referred to: where all ids of a payload are null, all are responses. Null URLs are left out of the header.
    An empty table writes an empty archive.

    Payloads are compared by SHA-1 and length. Which payloads repeat is counted on digests alone, before anything wide moves. A sketch of
    the repeated digests parts the pages in their scan: payloads that stand alone are never shuffled, the others join the few rows per
    digest, and a digest shared by very many pages is split by skew-join handling. A payload is written whole, however long.
    """
    spark = pages.sparkSession
    payload = F.coalesce(col(html).cast("string"), F.lit(""))
    rows = pages.select(col(page_id).alias("page_id"), col(url).cast("string").alias("url"), payload.alias("html"))
    key = [F.sha1("html").alias("sha"), F.octet_length("html").alias("size")]
    first = (
        rows.select("page_id", *key).filter(F.col("size") >= least_bytes).groupBy("sha", "size")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1 and refers_to is not null").drop("n")
    )
    first = materialised(first, "repeated")
    may_repeat = key_sketch(first, ["sha", "size"])(F.col("sha"), F.col("size"))
    marked = rows.select("*", *key)
    alone = marked.filter(~may_repeat).select(F.col("page_id").cast("string").alias("page_id"), "url", "html", F.lit(None).cast("string").alias("refers_to"))
    shared = marked.filter(may_repeat).join(first, ["sha", "size"], "left").select(
        F.col("page_id").cast("string").alias("page_id"), "url", "html",
        F.when(F.col("page_id").eqNullSafe(F.col("refers_to")), None).otherwise(F.col("refers_to").cast("string")).alias("refers_to"))
    told, date = alone.unionAll(shared), datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches):
        for batch in batches:
            ids, urls, texts, refers = (batch.column(i) for i in range(4))
            for i in range(0, len(batch), 256):
                out = []
                for p, u, t, r in zip(*(c.slice(i, 256).to_pylist() for c in (ids, urls, texts, refers))):
                    data = t.encode("utf-8", "surrogatepass")
                    out.append(packed(warc_record(p, u, data, base32_sha1(data), r, date))[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    told.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value")) \
        .write.option("lineSep", _LAST.decode()).option("maxRecordsPerFile", ARCHIVE_RECORDS).text(path)
    return path


_CAPTURE = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("page_id", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()),
])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row for every record of the archives under ``path``: key, ids, type, length and digest of the full payload, and where the
    record lies. Of responses, length and digest are worked out from the payload that was read, and held against the header's."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        for batch in batches:
            for i in range(len(batch)):
                file, out = batch.column(0)[i].as_py(), []
                for offset, length, record in records(batch.column(1)[i].as_py()):
                    x = parsed(record)
                    if x["payload"] is not None and (len(x["payload"]), base32_sha1(x["payload"])) != (x["payload_bytes"], x["digest"]):
                        raise ValueError(f"{file}: the record at {offset} does not hold the payload it names")
                    out.append((url_key(x["url"]), x["page_id"], x["url"], x["record_type"], x["refers_to"],
                                x["payload_bytes"], x["digest"], file, offset, length))
                kinds = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                columns = zip(*out) if out else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_CAPTURE.names)

    return files.mapInArrow(run, _CAPTURE)


def _line(row: dict) -> str:
    return row["key"].replace("\\", "\\\\").replace("\n", "\\n").replace("\t", "\\t") + "\t" + json.dumps(
        {k: v for k, v in row.items() if k != "key"}, ensure_ascii=True)


def _unkey(line: str) -> str:
    key = line.partition("\t")[0]
    return re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), key) if "\\" in key else key


def _unline(line: str) -> dict:
    return {"key": _unkey(line)} | json.loads(line.partition("\t")[2])


_BLOCK = T.StructType([
    T.StructField("first_key", T.StringType()), T.StructField("last_key", T.StringType()),
    T.StructField("lines", T.LongType()), T.StructField("block", T.BinaryType()),
])


def write_index(captures: DataFrame, path: str, block_lines: int | None = None) -> str:
    """Writes the two levels: ``path``/blocks (compressed blocks of sorted capture lines) and ``path``/directory (the first and
    last key, file and place of each block), and returns ``path``. Captures with equal keys (repeats of a URL) are sorted by
    archive place and may run over several blocks; a key that very many captures share is cut into as many. Blocks hold ``BLOCK_LINES``
    lines unless told otherwise, more where there would be over ``MOST_BLOCKS`` of them."""
    spark = captures.sparkSession
    if block_lines is None:
        captures = materialised(captures, "captures")
        block_lines = max(BLOCK_LINES, -(-captures.count() // MOST_BLOCKS))
    rows = captures.select(_CAPTURE.names).repartitionByRange("key", "file", "offset").sortWithinPartitions("key", "file", "offset")

    def run(batches):
        held: list[dict] = []

        def block(part: list[dict]) -> pa.RecordBatch:
            data = zlib.compress("\n".join(map(_line, part)).encode(), 6)
            return pa.RecordBatch.from_arrays([
                pa.array([part[0]["key"]]), pa.array([part[-1]["key"]]), pa.array([len(part)]), pa.array([data], pa.binary())],
                names=_BLOCK.names)

        for batch in batches:
            held += batch.to_pylist()
            while len(held) >= block_lines:
                yield block(held[:block_lines])
                held = held[block_lines:]
        if held:
            yield block(held)

    rows.mapInArrow(run, _BLOCK).withColumn("block_id", F.monotonically_increasing_id()).write.parquet(f"{path}/blocks")
    blocks = spark.read.parquet(f"{path}/blocks")
    blocks.select("first_key", "last_key", "lines", "block_id", F.length("block").alias("bytes")).write.parquet(f"{path}/directory")
    return path


def index_captures(spark: SparkSession, path: str) -> DataFrame:
    """All captures of an index, unpacked block by block."""

    def run(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                yield _captures([_unline(x) for x in zlib.decompress(data).decode().split("\n")])

    return spark.read.parquet(f"{path}/blocks").select("block").mapInArrow(run, _CAPTURE)


def _directory(spark: SparkSession, path: str) -> list[tuple[str, str, int]]:
    """First key, last key and id of every block, by key; about ``MOST_BLOCKS`` rows at most."""
    return sorted(tuple(r) for r in spark.read.parquet(f"{path}/directory").select("first_key", "last_key", "block_id").collect())


def looked_up(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """All captures whose key is one of ``keys`` (column ``key``, each key once, no nulls), by the index under ``path``.

    A key is searched in the directory by bisection, which names the blocks that may hold it; keys meet those blocks, one block at a
    time, and are searched in there by bisection. Blocks that no key asks for are read but not unpacked.
    """
    directory = _directory(spark, path)
    firsts = [d[0] for d in directory]

    def find(batches):
        for batch in batches:
            names, blocks = [], []
            for key in batch.column(0).to_pylist():
                at = max(bisect.bisect_left(firsts, key) - 1, 0)  # an equal key may begin in the block before
                while at < len(directory) and firsts[at] <= key:
                    if key <= directory[at][1]:
                        names.append(key)
                        blocks.append(directory[at][2])
                    at += 1
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(names, pa.string())], names=["block_id", "key"])

    def search(batches):
        data, names, lines = None, None, None
        for batch in batches:
            found = []
            for key, block in zip(batch.column(1).to_pylist(), batch.column(2)):
                if key is None:
                    data, names = block, None
                    continue
                if names is None:
                    lines = zlib.decompress(data.as_py()).decode().split("\n")
                    names = [_unkey(x) for x in lines]
                for i in range(bisect.bisect_left(names, key), bisect.bisect_right(names, key)):
                    found.append(_unline(lines[i]))
            yield _captures(found)

    asked = keys.select("key").mapInArrow(find, "block_id long, key string").select("block_id", "key", F.lit(None).cast("binary").alias("block"))
    held = spark.read.parquet(f"{path}/blocks").select("block_id", F.lit(None).cast("string").alias("key"), "block")
    return (
        asked.unionAll(held).repartition("block_id").sortWithinPartitions("block_id", F.col("key").asc_nulls_first())
        .mapInArrow(search, _CAPTURE)
    )


def _captures(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[n] for r in rows], pa.int64() if n in ("payload_bytes", "offset", "length") else pa.string()) for n in _CAPTURE.names],
        names=_CAPTURE.names)


def range_read(spark: SparkSession, captures: DataFrame, archive: str) -> DataFrame:
    """The captures as their records tell them, each read by its range, in tasks by archive file, and held against its index line.

    Tasks read ranges themselves where the archives lie in a mounted folder; on other file systems, which only Spark's reader knows, a
    whole archive file (``ARCHIVE_RECORDS`` records at most) meets its captures instead.
    """
    mounted = re.match(r"(file:|/)", archive) is not None
    lines = captures.select(*_CAPTURE.names, F.lit(None).cast("binary").alias("content"))
    if not mounted:
        files = spark.read.format("binaryFile").load(archive)
        lines = files.select(*[F.col("path").alias("file") if f.name == "file" else F.lit(None).cast(f.dataType).alias(f.name) for f in _CAPTURE],
                             "content").unionAll(lines)

    def run(batches):
        name, held, stream = None, None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["file"] != name:
                    name = row["file"]
                    if mounted:
                        if stream:
                            stream.close()
                        stream = open(unquote(re.sub(r"^file:(//)?", "", name)), "rb")
                if row["offset"] is None:
                    held = row["content"]
                    continue
                if mounted:
                    stream.seek(row["offset"])
                    data = stream.read(row["length"])
                else:
                    data = held[row["offset"]: row["offset"] + row["length"]]
                x = parsed(next(records(data))[2])
                if x["payload"] is not None and (len(x["payload"]), base32_sha1(x["payload"])) != (x["payload_bytes"], x["digest"]):
                    raise ValueError(f"{name}: the record at {row['offset']} does not hold the payload it names")
                read = {"key": url_key(x["url"]), "page_id": x["page_id"], "url": x["url"], "record_type": x["record_type"], "refers_to": x["refers_to"],
                        "payload_bytes": x["payload_bytes"], "payload_digest": x["digest"],
                        "file": name, "offset": row["offset"], "length": row["length"]}
                if any(read[n] != row[n] for n in _CAPTURE.names):
                    raise ValueError(f"{name}: the record at {row['offset']} is not the one its index line tells")
                out.append(read)
            yield _captures(out)
        if stream:
            stream.close()

    return lines.repartition("file").sortWithinPartitions("file", F.col("offset").asc_nulls_first()).mapInArrow(run, _CAPTURE)


class CaptureIndex:
    """Point look-ups. The directory is sparse (a row for ``BLOCK_LINES`` captures) and held sorted; blocks are read on demand."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.directory = _directory(spark, path)
        self.firsts = [d[0] for d in self.directory]

    def captures(self, url: str) -> list[dict]:
        """The captures of a URL, in the order of the index."""
        key, out = url_key(url), []
        at = max(bisect.bisect_left(self.firsts, key) - 1, 0)  # an equal key may begin in the block before
        wanted = []
        while at < len(self.directory) and self.firsts[at] <= key:
            if key <= self.directory[at][1]:
                wanted.append(self.directory[at][2])
            at += 1
        if not wanted:
            return []
        rows = self.spark.read.parquet(f"{self.path}/blocks").filter(F.col("block_id").isin(wanted)).orderBy("block_id").collect()
        for row in rows:
            lines = zlib.decompress(row["block"]).decode().split("\n")
            lo = bisect.bisect_left(lines, key, key=lambda x: _unline(x)["key"])
            while lo < len(lines) and (x := _unline(lines[lo]))["key"] == key:
                out.append(x)
                lo += 1
        return out

    def record(self, capture: dict) -> dict:
        """The record of a capture, by a range read of its archive through Spark's file system client."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop
        place = hadoop.fs.Path(capture["file"])
        stream = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).open(place)
        try:
            stream.seek(capture["offset"])
            data = bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, capture["length"]))
        finally:
            stream.close()
        return parsed(next(records(data))[2])


def url_keys(pages: DataFrame, url: str = "url") -> DataFrame:
    """The keys of all URLs of a table, each once."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(list({url_key(u) for u in batch.column(0).to_pylist()}), pa.string())], names=["key"])

    return pages.select(col(url).cast("string").alias("url")).mapInArrow(run, "key string").distinct()


def archived(pages: DataFrame, page_id: str = "page_id", url: str = "url", **settings) -> DataFrame:
    """Writes the archives and their index under the shared folder, looks the URLs of all pages up in the index, and returns the captures
    found, as their records tell them (``range_read``). Nulls, repeated rows and empty tables: see ``write_archives``."""
    spark = pages.sparkSession
    archive = write_archives(pages, fresh_path(spark, "warc"), page_id, url, **settings)
    index = write_index(read_archives(spark, archive), fresh_path(spark, "cdx"))
    found = range_read(spark, looked_up(spark, index, url_keys(pages, url)), archive)
    kind = pages.schema[page_id].dataType
    return found.withColumns({"page_id": F.col("page_id").cast(kind), "refers_to": F.col("refers_to").cast(kind)})

"""WARC archives with a two-level capture index.

``write`` stores one record per page in compressed WARC files, each record a
gzip member of its own; of records with equal payloads one is a response and
the others revisit it.  ``index`` sorts the captures by reversed-host key into
compressed blocks and keeps a sparse directory with the first key and place of
each block.  ``look_up`` deals a table of keys out to runs of the directory,
finds the block of a key by binary search, reads only that block, and then only
the byte range of the record.  ``read`` goes through all blocks in order.

Files are written below a folder that all machines share, through the file
system of its address.  Every attempt of a task writes files of its own, and
only the files named in the captures that Spark committed count, so a lost
executor leaves nothing behind but unused files.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import shuffle_width
from tideline.llm.url_filter import host_of
from tideline.operators.running import row_numbers
from tideline.session import materialize

#: A new file is begun when one has reached this size.
FILE_BYTES = 256 << 20
BLOCK_LINES = 1000
DATE = "2024-01-01T00:00:00Z"
ID_PREFIX = "urn:page:"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

#: Runs of blocks whose first keys are held by every task, at most.
GROUPS = 1024
#: A task reads about so many bytes of a file at a time.
READ_BYTES = 32 << 20

CAPTURES = "key string, page_id long, file string, offset long, length long"
DIRECTORY = "first_key string, last_key string, file string, offset long, length long, lines long"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_digest string, "
    "payload_bytes long, payload binary"
)


def _store(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pa.fs.LocalFileSystem(), folder)


def _plain(folder: str) -> str:
    """``file:/x`` as ``file:///x``."""
    return "file://" + folder[5:] if folder.startswith("file:/") and not folder.startswith("file://") else folder


def capture_key(url: Column) -> Column:
    """The reversed host, a closing bracket, and the rest of the url: ``com,example,www)/path?x=1``.

    Urls of a host, and hosts of a domain, sort together.  A url without a
    host keeps its text behind an empty host; null gives ``)``.
    """
    host = host_of(url)
    reversed_host = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3 + F.length(host))).otherwise(F.coalesce(url, F.lit("")))
    return F.concat(reversed_host, F.lit(")"), rest)


def decide(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` with payload, payload_digest, payload_bytes and refers_to.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with
    the smallest page_id is the response, and refers_to of the others names it;
    smaller payloads refer to nothing.  A null html is an empty payload.  Rows
    without a page_id are responses; rows that repeat a page_id and its payload
    are of one kind.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    marked = pages.select(
        "page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes")
    ).withColumn("__equal", F.sha2("payload", 256))
    slim = marked.where(F.col("payload_bytes") >= min_bytes).select("page_id", "__equal").distinct()
    groups = slim.groupBy("__equal").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("__last"))
    # Only copies are joined to the pages, and by the page id, which no hot payload can make uneven.
    copies = (
        slim.join(groups.where(F.col("refers_to") < F.col("__last")), "__equal")
        .where(F.col("page_id") != F.col("refers_to"))
        .select("page_id", "__equal", "refers_to")
    )
    return marked.join(copies, ["page_id", "__equal"], "left").drop("__equal")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record, uncompressed."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    body = HTTP_HEAD if refers_to is not None else HTTP_HEAD + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{ID_PREFIX}{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
        if "\r" in url or "\n" in url:  # would end the header
            head.append("X-Target-URI-Base64: " + base64.b64encode(url.encode()).decode())
    if refers_to is not None:
        head += [
            f"WARC-Refers-To: <{ID_PREFIX}{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Payload-Length: {len(payload)}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    return fields, rest[: int(fields["content-length"])]


def write(decided: DataFrame, folder: str, file_bytes: int = FILE_BYTES, level: int = 3) -> DataFrame:
    """Write the archives and return the captures (key, page_id, file, offset, length).

    The result writes files whenever it is computed, so keep it in a table.
    """
    folder = _plain(folder)

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        out, name = None, ""
        for batch in batches:
            places = []
            for row in zip(*(batch.column(c) for c in ("key", "page_id", "url", "payload", "refers_to"))):
                key, page_id, url, payload, refers_to = (x.as_py() for x in row)
                if out is None or out.tell() >= file_bytes:
                    if out is not None:
                        out.close()
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                begin = out.tell()
                out.write(gzip.compress(record(page_id, url, payload, refers_to), level, mtime=0))
                places.append((key, page_id, name, begin, out.tell() - begin))
            yield _batch(places, ("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()))
        if out is not None:
            out.close()

    rows = decided.select(capture_key(F.col("url")).alias("key"), F.col("page_id").cast("long"), "url", "payload", F.col("refers_to").cast("long"))
    return rows.mapInArrow(archive, CAPTURES)


def _batch(rows: list[tuple], *fields: tuple[str, pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sort the captures into compressed blocks and return the sparse directory, one row per block.

    Like ``write``, it writes files whenever it is computed.
    """
    folder = _plain(folder)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        out, name, held, rows = None, f"{uuid.uuid4().hex}.cdx.z", [], []

        def flush() -> None:
            nonlocal out
            if out is None:
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{base}/{name}", compression=None)
            begin = out.tell()
            out.write(zlib.compress("\n".join("\t".join(map(str, line)) for line in held).encode()))
            rows.append((_unescape(held[0][0]), _unescape(held[-1][0]), name, begin, out.tell() - begin, len(held)))
            held.clear()

        for batch in batches:
            for key, page_id, file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                held.append((_escape(key), "" if page_id is None else page_id, file, offset, length))
                if len(held) >= block_lines:
                    flush()
        if held:
            flush()
        if out is not None:
            out.close()
        yield _batch(rows, ("first_key", pa.string()), ("last_key", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("lines", pa.int64()))

    columns = ["key", "page_id", "file", "offset", "length"]
    # The page id splits a key that many captures share.
    ordered = captures.select(*columns).repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    return ordered.mapInArrow(blocks, DIRECTORY)


def _escape(key: str) -> str:
    return key.replace("%", "%25").replace("\t", "%09").replace("\n", "%0A").replace("\r", "%0D")


def _unescape(key: str) -> str:
    return key.replace("%0D", "\r").replace("%0A", "\n").replace("%09", "\t").replace("%25", "%")


class Archive:
    """Range reads of index blocks and records."""

    def __init__(self, folder: str):
        self.store, self.base = _store(_plain(folder))
        self.open: dict[str, pa.NativeFile] = {}

    def bytes_at(self, file: str, offset: int, length: int) -> bytes:
        if file not in self.open:
            if len(self.open) >= 64:
                self.open.pop(next(iter(self.open))).close()
            self.open[file] = self.store.open_input_file(f"{self.base}/{file}")
        return self.open[file].read_at(length, offset)

    def captures(self, file: str, offset: int, length: int) -> list[tuple[str, int, str, int, int]]:
        lines = zlib.decompress(self.bytes_at(file, offset, length)).decode().split("\n")
        parts = (line.split("\t") for line in lines)
        return [(_unescape(k), int(p) if p else None, f, int(o), int(n)) for k, p, f, o, n in parts]

    def record(self, file: str, offset: int, length: int) -> tuple:
        """page_id, url, type, refers_to, digest, payload length and payload (null for a revisit)."""
        fields, block = parse(gzip.decompress(self.bytes_at(file, offset, length)))
        url = fields.get("warc-target-uri")
        if "x-target-uri-base64" in fields:
            url = base64.b64decode(fields["x-target-uri-base64"]).decode()
        number = fields["warc-record-id"].removeprefix(f"<{ID_PREFIX}").rstrip(">")
        page_id = int(number) if number else None
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        if fields["warc-type"] == "revisit":
            first = int(fields["warc-refers-to"].removeprefix(f"<{ID_PREFIX}").rstrip(">"))
            return page_id, url, "revisit", first, digest, int(fields["warc-payload-length"]), None
        payload = block.partition(b"\r\n\r\n")[2]
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest:
            raise ValueError(f"the payload of page {page_id} does not have the digest of its record")
        return page_id, url, "response", None, digest, len(payload), payload


CAPTURE_FIELDS = (("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()))
RECORD_FIELDS = (
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
)


def _dealt(directory: DataFrame) -> DataFrame:
    """A task reads a few blocks; the records behind a block are a thousand times its row in the directory."""
    blocks = directory.count()
    tasks = max(1, min(blocks, max(shuffle_width(directory.sparkSession), blocks // 32)))
    return directory.repartition(tasks, "file", "offset")


def read(directory: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Every record the index names, through its blocks; the payload of a revisit is null."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = Archive(folder)
        for batch in batches:
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                # In the order of the files, so that neighbouring ranges are read one after the other.
                rows = [archive.record(*c[2:]) for c in sorted(archive.captures(file, offset, length), key=lambda c: c[2:])]
                yield _batch(rows if payloads else [r[:-1] + (None,) for r in rows], *RECORD_FIELDS)

    return _dealt(directory).select("file", "offset", "length").mapInArrow(records, RECORDS)


def find(directory: DataFrame, folder: str, asked: DataFrame) -> DataFrame:
    """The captures (key, page_id, file, offset, length) of the asked keys (a column ``key``); unknown and null keys have none.

    The sorted directory is cut into at most ``GROUPS`` runs of blocks, whose
    first keys every task holds: the asked keys are dealt out by them.  A task
    then bisects the first keys of its run for each key, reads the blocks that
    can hold it, and bisects those.
    """
    spark = directory.sparkSession
    blocks = directory.count()
    step = max(1, -(-blocks // max(1, min(GROUPS, max(4 * shuffle_width(spark), blocks // 32)))))
    placed = row_numbers(directory, ["first_key", "file", "offset"], "__n")
    runs = materialize(placed.select(F.floor((F.col("__n") - 1) / step).alias("run"), "first_key", "last_key", "file", "offset", "length"), "runs")
    bounds = runs.groupBy("run").agg(F.min("first_key").alias("first"), F.max("last_key").alias("last")).orderBy("run").collect()
    firsts, lasts = [r["first"] for r in bounds], [r["last"] for r in bounds]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key in batch.column(0).to_pylist():
                at = bisect.bisect_right(firsts, key) - 1
                # A key with very many captures lies in several runs.
                while at >= 0 and lasts[at] >= key:
                    rows.append((at, key))
                    at -= 1
            yield _batch(rows, ("run", pa.int64()), ("key", pa.string()))

    def search(keys: pa.Table, held: pa.Table) -> pa.Table:
        wanted = sorted(keys.column("key").to_pylist())
        if not wanted or not held.num_rows:
            return pa.Table.from_batches([_batch([], *CAPTURE_FIELDS)])
        archive = Archive(folder)
        here = sorted(zip(*(held.column(c).to_pylist() for c in ("first_key", "last_key", "file", "offset", "length"))))
        starts = [b[0] for b in here]
        inside: dict[int, list[str]] = {}
        for key in wanted:
            at = bisect.bisect_right(starts, key) - 1
            while at >= 0 and here[at][1] >= key:
                inside.setdefault(at, []).append(key)
                at -= 1
        found = []
        for at in sorted(inside, key=lambda at: here[at][2:]):
            captures = archive.captures(*here[at][2:])
            own = [c[0] for c in captures]
            for key in inside[at]:
                found += captures[bisect.bisect_left(own, key) : bisect.bisect_right(own, key)]
        return pa.Table.from_batches([_batch(found, *CAPTURE_FIELDS)])

    keys = asked.where(F.col("key").isNotNull()).select(F.col("key").cast("string")).distinct()
    dealt = keys.mapInArrow(deal, "run long, key string")
    return dealt.groupBy("run").cogroup(runs.groupBy("run")).applyInArrow(search, CAPTURES)


def fetch(captures: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records at the places of ``captures``, each with its key, by reading their byte ranges alone."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = Archive(folder)
        for batch in batches:
            places = zip(*(batch.column(c).to_pylist() for c in ("key", "file", "offset", "length")))
            rows = [(key, *archive.record(file, offset, length)) for key, file, offset, length in places]
            yield _batch(rows if payloads else [r[:-1] + (None,) for r in rows], ("key", pa.string()), *RECORD_FIELDS)

    # Neighbouring ranges of a file are one task's, in their order.
    near = captures.repartition("file", F.floor(F.col("offset") / READ_BYTES)).sortWithinPartitions("file", "offset")
    return near.select("key", "file", "offset", "length").mapInArrow(records, "key string, " + RECORDS)


def look_up(directory: DataFrame, folder: str, keys: Sequence[str] | DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the asked keys, each with its key; unknown keys give no row.

    ``keys`` is a list or a table with a column ``key``, of any size.  The
    directory is searched for each key; only blocks that can hold one are read,
    and of the archives only the byte ranges of the records found.
    """
    if not isinstance(keys, DataFrame):
        keys = directory.sparkSession.createDataFrame([(k,) for k in set(keys)], "key string")
    return fetch(materialize(find(directory, folder, keys), "found-captures"), folder, payloads)

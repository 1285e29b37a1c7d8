"""Web archives with a two-level capture index.

Writing: each task writes one archive, every record a gzip member of its own, and gives back
where each record lies. Indexing: keys (reversed host, then path) are range-sorted; each task
writes its keys in compressed blocks, and one directory row per block. Reading: a key finds
its range by the first keys of the ranges, its block by binary search in the directory, and
its line by binary search in the block; records are then read by byte ranges, in file order.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docferry.llm.common import n_tasks, stage
from docferry.session import scratch_dir

#: Payloads below this many bytes are always stored.
LEAST_BYTES, BLOCK_LINES, LEVEL = 1000, 1000, 1
#: Neighbouring records are read together up to so many bytes.
SPAN_BYTES = 4_000_000
#: What one task reads of the archives.
FETCH_BYTES = 64_000_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(path: str):
    """File system and path below it; any store pyarrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _clean(text: str | None) -> str:
    """A URL fit for a header line and an index line: blanks and controls as percent codes."""
    return "".join(c if " " < c != "\x7f" else f"%{ord(c):02X}" for c in text or "")


def url_key(url: str | None) -> str:
    """Sort key of a URL: the host's labels reversed, then port, path and query; scheme and fragment do not count."""
    url = _clean(url)
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").split(".")
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        return url
    query = f"?{parts.query}" if parts.query else ""
    return ",".join(reversed(host)) + port + ")" + (parts.path or "/") + query


def record(page: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit holds the headers of the answer but not its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {_clean(url)}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers of a record, headers of its answer, payload."""

    def headers(lines: bytes) -> dict[str, str]:
        return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines.decode().split("\r\n")[1:])}

    top, _, rest = data.partition(b"\r\n\r\n")
    outer = headers(top)
    http, _, payload = rest[: int(outer["content-length"])].partition(b"\r\n\r\n")
    return outer, headers(http), payload


def _pack(data: bytes) -> bytes:
    made = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return made.compress(data) + made.flush()


def _write(folder: str):
    names = ["key", "page_id", "file", "at", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Another name for each attempt: the index names only files of attempts that were committed.
        name = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        files, path = _open(name)
        files.create_dir(path.rsplit("/", 1)[0], recursive=True)
        at = 0
        with files.open_output_stream(path, compression=None) as out:
            for batch in batches:
                rows: list[tuple] = []
                for page, url, payload, sha1, first, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    data = _pack(record(page, url, payload, sha1, first, revisit))
                    out.write(data)
                    rows.append((url_key(url), page, name, at, len(data)))
                    at += len(data)
                kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)], names=names)

    return run


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one record per row below ``folder``; returns where each lies (``key``, ``page_id``, ``file``, ``at``, ``length``).

    Of rows with equal payloads of at least ``LEAST_BYTES`` bytes those with the largest
    identifier are stored and the others revisit it; null payloads are empty. Where only
    null identifiers share a payload, all are stored. A row is written once; what a lost task
    wrote is never referred to.
    """
    html = F.coalesce(F.col(f"`{html_col}`"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page"), F.col(f"`{url_col}`").alias("url"), html.alias("payload")).withColumn("sha1", F.sha1("payload"))
    large = F.octet_length("payload") >= LEAST_BYTES
    groups = rows.where(large).groupBy("sha1", F.octet_length("payload").alias("n")).agg(F.max("page").alias("first"), F.count("*").alias("rows"))
    # Repeated payloads only: written and read again, so that Spark knows how few they are.
    repeated = stage(groups.where("rows > 1 and first is not null"), "warc-repeated").select("sha1", "n", "first")
    joined = rows.join(repeated, (rows["sha1"] == repeated["sha1"]) & (F.octet_length("payload") == F.col("n")), "left").drop(repeated["sha1"])
    revisit = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    sent = joined.select("page", "url", "payload", "sha1", F.when(revisit, F.col("first")).alias("first"), revisit.alias("revisit"))
    return stage(sent.mapInArrow(_write(folder), "key string, page_id long, file string, at long, length long"), "warc-places")


def _blocks(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name = f"{folder}/{part:06d}-{uuid.uuid4().hex}.cdx.gz"
        lines, out, at, rows = [], None, 0, []

        def close():
            nonlocal at
            data = _pack("\n".join("\t".join(map(str, x)) for x in lines).encode())
            out.write(data)
            rows.append((part, lines[0][0], lines[0][1], name, at, len(data)))
            at += len(data)
            lines.clear()

        for batch in batches:
            if out is None and batch.num_rows:
                files, path = _open(name)
                files.create_dir(path.rsplit("/", 1)[0], recursive=True)
                out = files.open_output_stream(path, compression=None)
            for line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lines.append(line)
                if len(lines) == BLOCK_LINES:
                    close()
        if out is not None:
            if lines:
                close()
            out.close()
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        columns = zip(*rows, strict=True) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", "key", "page_id", "file", "at", "length"])

    return run


def index(places: DataFrame, folder: str) -> DataFrame:
    """Write the sorted blocks below ``folder``; returns the directory, one row per block.

    Null identifiers sort and are found as -1.
    """
    rows = places.select("key", F.coalesce("page_id", F.lit(-1).cast("long")).alias("page_id"), "file", "at", "length")
    # Spark orders strings by their bytes, Python by code points: the same order.
    ordered = rows.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    return stage(ordered.mapInArrow(_blocks(folder), "part int, key string, page_id long, file string, at long, length long"), "warc-directory")


def _route(starts: list[tuple[str, int]], parts: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [url_key(u) for u in batch.column(1).to_pylist()]
            ids = batch.column(0).to_pylist()
            at = [parts[max(0, bisect.bisect_right(starts, x) - 1)] for x in zip(keys, ids, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(keys, pa.string()), batch.column(0)], names=["part", "key", "page_id"])

    return run


def _find(key, wanted: pa.Table, directory: pa.Table) -> pa.Table:
    """Lines of the wanted keys of one range."""
    found: list[tuple] = []
    if directory.num_rows:
        blocks = sorted(zip(*(directory.column(c).to_pylist() for c in ("key", "page_id", "file", "at", "length")), strict=True))
        starts = [b[:2] for b in blocks]
        files, path = _open(blocks[0][2])
        open_block, lines = -1, []
        with files.open_input_file(path) as source:
            for k in sorted(set(zip(wanted.column("key").to_pylist(), wanted.column("page_id").to_pylist(), strict=True))):
                # Rows that repeat a key and identifier may begin in an earlier block.
                for i in range(max(0, bisect.bisect_left(starts, k) - 1), bisect.bisect_right(starts, k)):
                    if i != open_block:
                        _, _, _, at, length = blocks[i]
                        text = zlib.decompress(source.read_at(length, at), 31).decode()
                        lines = [(x[0], int(x[1]), *x[2:]) for x in (y.split("\t") for y in text.split("\n"))]
                        open_block = i
                    j = bisect.bisect_left(lines, k)
                    while j < len(lines) and lines[j][:2] == k:
                        found.append((k[1], lines[j][2], int(lines[j][3]), int(lines[j][4])))
                        j += 1
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
    columns = zip(*found, strict=True) if found else [[]] * 4
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["page_id", "file", "at", "length"])


def lookup(directory: DataFrame, captures: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Where the records of (identifier, URL) pairs lie: ``page_id``, ``file``, ``at``, ``length``.

    A pair that is asked for more than once is looked up once; all records of a pair are found.
    """
    # One row per range of the index, so as many as the index had tasks.
    first = directory.groupBy("part").agg(F.min(F.struct("key", "page_id")).alias("s")).orderBy("s").collect()
    starts, parts = [(r.s.key, r.s.page_id) for r in first], [r.part for r in first]
    rows = captures.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-1).cast("long")).alias("page_id"), F.col(f"`{url_col}`").alias("url"))
    wanted = rows.mapInArrow(_route(starts, parts or [0]), "part int, key string, page_id long")
    kinds = "page_id long, file string, at long, length long"
    return wanted.groupBy("part").cogroup(directory.groupBy("part")).applyInArrow(_find, kinds)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    files = path = source = None
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    for batch in batches:
        rows = list(zip(*(batch.column(c).to_pylist() for c in ("page_id", "file", "at", "length")), strict=True))
        lo = 0
        while lo < len(rows):
            hi = lo + 1
            while hi < len(rows) and rows[hi][1] == rows[lo][1] and rows[hi][2] + rows[hi][3] - rows[lo][2] <= SPAN_BYTES:
                hi += 1
            if rows[lo][1] != path:
                if source is not None:
                    source.close()
                path = rows[lo][1]
                files, name = _open(path)
                source = files.open_input_file(name)
            start = rows[lo][2]
            span = memoryview(source.read_at(rows[hi - 1][2] + rows[hi - 1][3] - start, start))
            out: list[tuple] = []
            for page, _, at, length in rows[lo:hi]:
                outer, http, payload = parse(zlib.decompress(span[at - start : at - start + length], 31))
                told = base64.b32decode(outer["warc-payload-digest"].removeprefix("sha1:")).hex()
                revisit = outer["warc-type"] == "revisit"
                if not revisit and hashlib.sha1(payload).hexdigest() != told:
                    raise ValueError(f"record of page {page} at {at} in {path}: payload differs from its digest")
                first = int(outer["warc-refers-to"].rstrip(">").rpartition(":")[2]) if revisit else None
                n = int(http["content-length"]) if revisit else len(payload)
                out.append((None if page == -1 and ":None>" in outer["warc-record-id"] else page, n, told, outer["warc-type"], first, outer["warc-target-uri"], None if revisit else payload))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
            lo = hi
    if source is not None:
        source.close()


def fetch(places: DataFrame) -> DataFrame:
    """Records by their places: identifier, length and digest of the full payload, type, what it refers to, URL, payload.

    Ranges of about ``FETCH_BYTES`` of the archives are read by a task each, in file order, near
    records in one read. Places that are given more than once are read once.
    """
    kinds = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
    # As a table: its bytes are summed, and sampled for ranges, before it is read.
    known = stage(places.distinct(), "warc-places")
    size = known.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(n_tasks(places.sparkSession), -(-size // FETCH_BYTES))
    return known.repartitionByRange(tasks, "file", "at").sortWithinPartitions("file", "at").mapInArrow(_fetch, kinds)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write archives and index of ``pages`` (page_id, url, html) and read every record back through the index.

    An empty table gives no rows. Rows that repeat a page_id and URL are records of their own,
    and each comes back once.
    """
    folder = folder or scratch_dir(pages.sparkSession, "warc")
    directory = index(write(pages, f"{folder}/archive"), f"{folder}/index")
    return fetch(lookup(directory, pages)).drop("payload", "url")

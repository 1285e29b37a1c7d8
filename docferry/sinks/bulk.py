"""Parallel bulk writing with retry.

Each task cuts its own rows into batches and sends them one at a time, so writing needs
no shuffle and a task holds one batch. Delivery is at least once: a task that Spark runs
again sends its documents again, which are those of one parcel (see ``docferry.sinks.ledger``).
Turn ``spark.speculation`` off for these jobs.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.parquet
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)

from docferry.operators.batch import DEFAULT_BATCH_SIZE, DEFAULT_MAX_REQUESTS, checked_lines
from docferry.operators.validate import DocumentError, enforce, error_totals
from docferry.session import discard, scratch_dir, stored_at
from docferry.sinks.ledger import PARCEL_DOCS, Ledger
from docferry.sinks.transport import BulkRequest, DryRun, HttpTransport, Transport, load_transport

# Seconds before a refused request is sent again, doubled up to the second.
FIRST_WAIT = 1.0
LONGEST_WAIT = 30.0

REPLIES_DDL = "task bigint, seq bigint, n_docs bigint, n_bytes bigint, attempts int, status int, reply string, parcel string"


@dataclass(frozen=True)
class BulkTarget:
    """Where batches go and how."""

    index: str
    transport: Transport
    batch_size: int = DEFAULT_BATCH_SIZE
    pipeline: str | None = None
    max_attempts: int | None = None
    fail_on_server_error: bool = False
    sleep: object = field(default=time.sleep, repr=False)

    def __post_init__(self):
        if not self.index:
            raise ValueError("the target needs an index name")
        if self.batch_size < 1:
            raise ValueError("batch size must be at least 1")

    def request(self, body: bytes, n_docs: int) -> BulkRequest:
        params = {"pipeline": self.pipeline} if self.pipeline else {}
        return BulkRequest(f"/{self.index}/_bulk", params, body, n_docs)

    def send(self, body: bytes, n_docs: int) -> tuple[int, int, str]:
        """Send until the target does not answer 429: ``(attempts, status, reply)``."""
        request = self.request(body, n_docs)
        wait, attempts = FIRST_WAIT, 0
        while True:
            attempts += 1
            status, reply = self.transport(request)
            if status >= 500 and self.fail_on_server_error:
                raise RuntimeError(f"bulk request failed with status {status}: {reply[:1000]}")
            if status != 429 or attempts == self.max_attempts:
                return attempts, status, reply
            self.sleep(wait)
            wait = min(wait * 2, LONGEST_WAIT)


def _line_bytes(batch: pa.RecordBatch) -> tuple[pa.Buffer, np.ndarray]:
    """The text of all lines as one buffer, and where each line begins and ends.

    Lines carry their newline, so any run of rows is one slice of the buffer.
    """
    lines = batch.column(batch.schema.get_field_index("line")).cast(pa.large_string())
    _, offsets, data = lines.buffers()
    return data, np.frombuffer(offsets, np.int64)[lines.offset : lines.offset + len(lines) + 1]


def cut_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[bytes, int]]:
    """``(body, number of documents)`` for every ``size`` rows; the last one may be short."""
    pieces, held = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        data, bounds = _line_bytes(batch)
        at = 0
        while at < batch.num_rows:
            take = min(size - held, batch.num_rows - at)
            pieces.append(memoryview(data)[bounds[at] : bounds[at + take]])
            at, held = at + take, held + take
            if held == size:
                yield b"".join(pieces), held
                pieces, held = [], 0
    if held:
        yield b"".join(pieces), held


def _sender(target: BulkTarget):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, parcel = TaskContext.get().partitionId(), None

        def noted() -> Iterator[pa.RecordBatch]:
            # All rows of a task are of one parcel, or of none.
            nonlocal parcel
            for batch in batches:
                if parcel is None and batch.num_rows and "parcel" in batch.schema.names:
                    parcel = batch.column("parcel")[0].as_py()
                yield batch

        for seq, (body, n_docs) in enumerate(cut_batches(noted(), target.batch_size)):
            attempts, status, reply = target.send(body, n_docs)
            yield pa.RecordBatch.from_pydict(
                {
                    "task": [task], "seq": [seq], "n_docs": [n_docs], "n_bytes": [len(body)],
                    "attempts": pa.array([attempts], pa.int32()), "status": pa.array([status], pa.int32()),
                    "reply": [reply], "parcel": pa.array([parcel], pa.string()),
                }
            )

    return send


def write_bulk(
    df: DataFrame,
    target: BulkTarget,
    replies_path: str,
    action: str = "create",
    max_requests: int | None = DEFAULT_MAX_REQUESTS,
    errors: str = "failfast",
    ledger: str | None = None,
    parcel_docs: int = PARCEL_DOCS,
    refused_path: str | None = None,
    rounds: int | None = None,
) -> DataFrame:
    """Send the documents and return the table of replies, one row per request.

    The replies go to ``replies_path``, where the reply of each finished task is kept exactly
    once; count them with ``docferry.operators.account``. At most ``max_requests`` requests are
    in flight: the input is read and checked by all tasks, its lines are staged in the shared
    folder in parcels of at most ``parcel_docs`` documents, and rounds of that many tasks send
    one parcel each. ``None`` sets no limit and stages nothing; every running task reads and
    sends: give that on a large cluster whose target can take it.

    ``ledger`` names a folder that outlives the run: a call with the folder of an earlier one
    takes its parcels up, whatever ``df`` holds now, and sends those without a reply. ``rounds``
    leaves the rest to a later call. Without a folder the load starts anew and replaces
    ``replies_path``.

    No document in error fails a task that sends, as Spark would run it again and send its
    good documents again. ``failfast`` (default) sends each good document and then raises
    one error that names the first bad one; ``gate`` reads everything first and sends
    nothing if one is bad; ``keep`` sends the good ones. What is refused goes to
    ``refused_path``, where one is given: ``path``, ``doc`` and ``error``.
    """
    if max_requests is not None and max_requests < 1:
        raise ValueError("max requests must be at least 1")
    if errors not in ("failfast", "gate", "keep"):
        raise ValueError(f"unknown error mode: {errors}")
    if max_requests is None and ledger is not None:
        raise ValueError("a ledger needs a limit of requests")
    spark = df.sparkSession
    lines = checked_lines(df, action, validated="error" in df.columns)
    found = Observation()
    seen = lines.observe(found, *error_totals(lines))
    if max_requests is None:
        if errors == "gate":
            enforce(lines, "gate")
        _write_replies(seen.where("error is null").select("line"), target, replies_path)
        if refused_path is not None and found.get["n_bad"]:
            _write_refused(lines, refused_path)
    else:
        book = Ledger(ledger or scratch_dir(spark, "bulk-ledger"), replies_path)
        if ledger is None:
            discard(spark, replies_path)
        if book.is_(spark, "done"):
            return spark.read.schema(REPLIES_DDL).parquet(replies_path)
        fresh = not book.is_(spark, "ready")
        # Of a refused document the line is the document itself, kept for the refused table.
        path = F.col("path") if "path" in lines.columns else F.lit(None).cast("string")
        book.prepare(seen.select(F.when(F.col("error").isNull(), F.col("line")).alias("line"), "error", path.alias("path"), F.when(F.col("error").isNotNull(), F.col("doc")).alias("doc")), parcel_docs)
        bad = found.get if fresh else _refused(book.staged(spark))
        n_bad = bad["n_bad"]
        if refused_path is not None and n_bad:
            _write_refused(book.staged(spark), refused_path)
        if errors == "gate" and n_bad:
            discard(spark, book.folder)
            raise DocumentError(f"{bad['first']} ({n_bad} in error)")
        book.send(spark, _sender(target), REPLIES_DDL, max_requests, rounds)
        if ledger is None:
            discard(spark, book.folder)
    if errors == "failfast" and (max_requests is None or fresh) and found.get["n_bad"]:
        raise DocumentError(f"{found.get['first']} ({found.get['n_bad']} in error, all others sent)")
    return spark.read.schema(REPLIES_DDL).parquet(replies_path)


def _refused(staged: DataFrame) -> dict:
    """Number and first of the refused documents of staged parcels."""
    text = F.concat_ws(": ", "path", "error")
    return staged.where("error is not null").agg(F.count("*").alias("n_bad"), F.min(text).alias("first")).first().asDict()


def _write_replies(lines: DataFrame, target: BulkTarget, path: str) -> None:
    lines.mapInArrow(_sender(target), REPLIES_DDL).write.mode("overwrite").parquet(path)


def _write_refused(rows: DataFrame, path: str) -> None:
    columns = [c if c in rows.columns else F.lit(None).cast("string").alias(c) for c in ("path", "doc", "error")]
    rows.where("error is not null").select(*columns).write.mode("overwrite").parquet(path)


COMMITS_DDL = "outcome string, batch bigint, task bigint, n_requests bigint, n_docs bigint, n_refused bigint, statuses map<int, bigint>"
_COMMITS = pa.schema(
    [("outcome", pa.string()), ("batch", pa.int64()), ("task", pa.int64()), ("n_requests", pa.int64()), ("n_docs", pa.int64()),
     ("n_refused", pa.int64()), ("statuses", pa.map_(pa.int32(), pa.int64()))]
)


@dataclass
class _Counts(WriterCommitMessage):
    task: int
    n_requests: int = 0
    n_docs: int = 0
    n_refused: int = 0
    statuses: dict[int, int] = field(default_factory=dict)


@dataclass(frozen=True)
class _Sender:
    """What both writers of the data source do."""

    target: BulkTarget
    commits: str | None
    strict: bool

    def send(self, batches: Iterator[pa.RecordBatch]) -> _Counts:
        counts = _Counts(TaskContext.get().partitionId())

        def good() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lines = batch.column("line")
                counts.n_refused += lines.null_count
                yield pa.RecordBatch.from_arrays([lines.drop_null()], names=["line"])

        for body, n_docs in cut_batches(good(), self.target.batch_size):
            _, status, _ = self.target.send(body, n_docs)
            counts.n_requests += 1
            counts.n_docs += n_docs
            counts.statuses[status] = counts.statuses.get(status, 0) + 1
        return counts

    def note(self, outcome: str, messages: list, batch: int | None = None) -> None:
        """Add one row per task to the table of commits: a few numbers, however many documents were sent."""
        done = [m for m in messages if m is not None]
        if self.commits:
            rows = [(outcome, batch, m.task, m.n_requests, m.n_docs, m.n_refused, list(m.statuses.items())) for m in done]
            table = pa.Table.from_pylist([dict(zip(_COMMITS.names, r, strict=True)) for r in rows], _COMMITS)
            files, folder = stored_at(self.commits)
            files.create_dir(folder)
            pa.parquet.write_table(table, f"{folder}/{outcome}-{uuid.uuid4().hex}.parquet", filesystem=files)
        refused = sum(m.n_refused for m in done)
        if outcome == "sent" and self.strict and refused:
            raise DocumentError(f"{refused} documents had no line to send, all others were sent")


class _BulkWriter(DataSourceArrowWriter):
    def __init__(self, sender: _Sender):
        self.sender = sender

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return self.sender.send(iterator)

    def commit(self, messages: list) -> None:
        self.sender.note("sent", messages)

    def abort(self, messages: list) -> None:
        self.sender.note("aborted", messages)


class _BulkStreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, sender: _Sender):
        self.sender = sender

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return self.sender.send(iterator)

    def commit(self, messages: list, batchId: int) -> None:
        self.sender.note("sent", messages, batchId)

    def abort(self, messages: list, batchId: int) -> None:
        self.sender.note("aborted", messages, batchId)


class BulkDataSource(DataSource):
    """``write.format("docferry_bulk")``, or ``writeStream``, for a ``line`` column made by
    ``checked_lines``: rows without a line are counted and not sent, so no task fails after it
    has sent.

    Options: ``index``, ``transport`` (``http``, ``dry-run``, or ``module:callable``, given all
    options), ``batchSize``, ``pipeline``, ``maxAttempts``, ``failOnServerError``; ``commits``, a
    shared folder where every commit adds a row per task to a Parquet table (``COMMITS_DDL``);
    ``errors``, ``keep`` (default) or ``failfast``: the commit fails if a row had no line.
    """

    @classmethod
    def name(cls) -> str:
        return "docferry_bulk"

    def writer(self, schema, overwrite):
        return _BulkWriter(self._sender(schema))

    def streamWriter(self, schema, overwrite):
        return _BulkStreamWriter(self._sender(schema))

    def _sender(self, schema) -> _Sender:
        if "line" not in schema.names:
            raise ValueError("the bulk sink needs a 'line' column; see checked_lines")
        options = self.options
        attempts, errors = options.get("maxAttempts"), options.get("errors", "keep")
        if errors not in ("keep", "failfast"):
            raise ValueError(f"unknown error mode: {errors}")
        target = BulkTarget(
            index=options.get("index", ""),
            transport=_transport(options["transport"], dict(options)),
            batch_size=int(options.get("batchSize", DEFAULT_BATCH_SIZE)),
            pipeline=options.get("pipeline"),
            max_attempts=int(attempts) if attempts else None,
            fail_on_server_error=options.get("failOnServerError", "false") == "true",
        )
        return _Sender(target, options.get("commits"), errors == "failfast")


def _transport(name: str, options: dict[str, str]) -> Transport:
    known = {"http": http_transport, "dry-run": dry_run_transport}
    return known[name](options) if name in known else load_transport(name, options)


def http_transport(options: dict[str, str]):
    """Transport factory for the data source: options ``url``, ``apiKey``, ``username``,
    ``password``, ``compress``, ``insecure``."""
    return HttpTransport(
        url=options["url"],
        api_key=options.get("apiKey"),
        username=options.get("username"),
        password=options.get("password"),
        compress=options.get("compress", "true") == "true",
        insecure=options.get("insecure", "false") == "true",
    )


def dry_run_transport(options: dict[str, str]):
    """Transport factory for the data source that sends nothing."""
    return DryRun(options.get("index", "dry-run"))


def register(spark: SparkSession) -> None:
    """Make the bulk format known to the session."""
    spark.dataSource.register(BulkDataSource)

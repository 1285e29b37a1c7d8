"""A ledger of what has been sent, so that a load can be taken up where it stopped.

The lines to send are staged in files of a bounded number of documents, the parcels. There are as
many tasks as there may be requests in flight; each sends its parcels one after another, and the
replies of a parcel become visible in one file as soon as it is sent, not when the task or the job
ends. So the replies are the ledger: what is missing there has to be sent, and a task that runs
again, or a run that died, sends again at most the parcels that were under way. A round is one
parcel for each task. Where the tasks cannot open the store of the replies themselves, each round
is a job of its own, whose tasks put their replies in place when they end.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.session import discard, exists, listing_by_few_tasks, stored_at

#: Documents of a parcel: what a lost task sends again at most.
PARCEL_DOCS = 50_000
#: Bytes no parcel reaches. With the same cost for opening a file, every file is a task of its own.
_ONE_FILE = str(1 << 40)

PARCELS_DDL = "line string, error string, path string, doc string"
# Of a round that is a job of its own: a task's replies are moved into place when the task ends.
_BY_TASK = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


Sender = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _by_parcel(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Batches cut where another parcel begins, and their parcel. A task reads one parcel after another."""
    for batch in batches:
        runs = pc.run_end_encode(batch.column("parcel"))
        at = 0
        for parcel, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
            yield parcel, batch.slice(at, end - at)
            at = end


def _send_parcels(sender: Sender, replies: str):
    """Send parcels one after another; the replies of each are put in place when it is sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = stored_at(replies)
        sent = 0
        for parcel, parts in groupby(_by_parcel(batches), key=lambda p: p[0]):
            # One name for each parcel, whichever task or attempt sends it.
            place = f"{folder}/replies-{parcel}"
            if files.get_file_info(place).type != pa.fs.FileType.NotFound:
                continue
            hidden, writer = f"{folder}/.{uuid.uuid4().hex}-{parcel}", None
            for answers in sender(part for _, part in parts):
                writer = writer or pa.parquet.ParquetWriter(hidden, answers.schema, filesystem=files)
                writer.write_batch(answers)
            if writer is not None:
                writer.close()
                files.move(hidden, place)
                sent += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([sent], pa.int64())})

    return run


def _can_open(folder: str) -> bool:
    try:
        stored_at(folder)
    except (pa.ArrowException, OSError):
        return False
    return True


@dataclass(frozen=True)
class Ledger:
    """Where the parcels of one load lie, and where its replies go."""

    folder: str
    replies: str

    @property
    def lines(self) -> str:
        return f"{self.folder}/lines"

    def is_(self, spark: SparkSession, state: str) -> bool:
        return exists(spark, f"{self.folder}/{state}")

    def mark(self, spark: SparkSession, state: str) -> None:
        """``ready``: all parcels are staged. ``done``: all are sent."""
        spark.range(1).write.mode("overwrite").parquet(f"{self.folder}/{state}")

    def prepare(self, lines: DataFrame, parcel_docs: int = PARCEL_DOCS) -> None:
        """Stage the parcels, unless an earlier run did. The marker is written last."""
        spark = lines.sparkSession
        if parcel_docs < 1:
            raise ValueError("a parcel holds at least 1 document")
        if not self.is_(spark, "ready"):
            lines.write.mode("overwrite").option("maxRecordsPerFile", parcel_docs).parquet(self.lines, compression="zstd")
            self.mark(spark, "ready")

    def staged(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(PARCELS_DDL).parquet(self.lines)

    def open_parcels(self, spark: SparkSession) -> list[str]:
        """Files that have no reply yet. Spark's listing holds one entry for each file on the driver; so does this."""
        files = spark.createDataFrame([(f, f.rsplit("/", 1)[-1]) for f in self.staged(spark).inputFiles()], "file string, parcel string")
        if exists(spark, self.replies):
            files = files.join(spark.read.schema("parcel string").parquet(self.replies).where("parcel is not null"), "parcel", "left_anti")
        return [r.file for r in files.orderBy("file").collect()]

    def send(self, spark: SparkSession, sender: Sender, schema: str, max_requests: int | None, rounds: int | None = None) -> None:
        """Send what is open, ``max_requests`` parcels at a time; after ``rounds`` rounds leave the rest open."""
        if self.is_(spark, "done"):
            return
        todo = self.open_parcels(spark)
        size = max_requests or max(1, len(todo))
        some = todo if rounds is None else todo[: rounds * size]
        own = spark.newSession()
        own.conf.set("spark.sql.files.maxPartitionBytes", _ONE_FILE)
        own.conf.set("spark.sql.files.openCostInBytes", _ONE_FILE)

        def lines(parcels: list[str]) -> DataFrame:
            with listing_by_few_tasks(own):
                read = own.read.schema(PARCELS_DDL).parquet(*parcels)
            return read.where("line is not null").select("line", F.col("_metadata.file_name").alias("parcel"))

        if _can_open(self.replies):
            # The folder is there even if no parcel has a line to send. (Made by ``own``, it would leave that session active.)
            spark.createDataFrame([], schema).write.mode("append").parquet(self.replies)
            if some:
                lines(some).coalesce(size).mapInArrow(_send_parcels(sender, self.replies), "n long").agg(F.sum("n")).first()
        else:
            for i in range(0, len(some), size):
                lines(some[i : i + size]).mapInArrow(sender, schema).write.mode("append").options(**_BY_TASK).parquet(self.replies)
        if len(some) < len(todo):
            return
        self.mark(spark, "done")
        discard(spark, self.lines)

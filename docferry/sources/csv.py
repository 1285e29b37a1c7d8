"""CSV rows as JSON objects of strings.

A quoted value may hold line breaks, so a line alone does not tell whether it begins a record.
Files are still read in splits: one pass tells for every file block how it ends if it begins
outside a quoted value, and how if it begins inside one. These are functions of two states, and
composing them along a file gives the state at the start of every block. A second pass cuts each
block at its true record ends; the pieces left at the borders of blocks are joined.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docferry.functions.paths import plain_path
from docferry.session import stage
from docferry.sources.blocks import block_runs, byte_lines, join_pieces
from docferry.sources.envelope import ENVELOPE_DDL, envelope
from docferry.sources.listing import local_form

BAD_WIDTH = "row length differs from header"
NOT_CLOSED = "quoted value is not closed"
NOT_TEXT = "invalid UTF-8"
#: Fields that the row parser makes room for, or twice those of the header.
MOST_FIELDS = 1_000_000
#: Lines looked at for a header, and how many times more if a quoted name goes on.
HEADER_LINES = 16

_BYTE_ORDER_MARK = b"\xef\xbb\xbf"


class HeaderError(ValueError):
    """Files that are read together have different headers."""


def row_to_json(columns: dict[str, Column]) -> Column:
    """JSON object of the given columns, nulls kept."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in columns.items()]), {"ignoreNullFields": "false"})


def ends_quoted(line: bytes, quoted: bool) -> bool:
    """Is the end of the line inside a quoted value, if its beginning is or is not?

    A quote opens a value only where the value begins; inside, two quotes are one.
    """
    at = 0
    while True:
        if quoted:
            at = line.find(b'"', at)
            while at >= 0 and line[at + 1 : at + 2] == b'"':
                at = line.find(b'"', at + 2)
            if at < 0:
                return True
            quoted = False
        else:
            at = line.find(b'"', at)
            if at < 0:
                return False
            if at == 0 or line[at - 1 : at] == b",":
                quoted, at = True, at + 1
                continue
        # Behind a closed value, or a quote within a plain one, nothing opens before a comma.
        at = line.find(b",", at)
        if at < 0:
            return False
        at += 1


def _tell_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block: its first line's place, its lines, whether one is not empty, how it ends
    from either state, whether a value open at its start is closed in it, and from either state
    the last line before whose end an open value is closed (-1: none).

    Lines without a quote come as null; they change no state.
    """
    found: dict[tuple[str, int], list] = {}
    for batch in batches:
        paths, starts, places, lines, fills = batch.columns
        for path, start, lo, hi in block_runs(paths, starts):
            first, n, filled, outside, inside, closes, last_outside, last_inside = found.get((path, start)) or (places[lo].as_py(), 0, False, False, True, False, -1, -1)
            filled = filled or bool(fills.slice(lo, hi - lo).true_count)
            some, place = lines.slice(lo, hi - lo), places.slice(lo, hi - lo).to_numpy()
            quoting = np.flatnonzero(some.is_valid().to_numpy(zero_copy_only=False)).tolist()
            for i, line in zip(quoting, some.drop_null().to_pylist(), strict=True):
                was_outside, was_inside = outside, inside
                outside, inside = ends_quoted(line, outside), ends_quoted(line, inside)
                last_outside = int(place[i]) if was_outside and not outside else last_outside
                last_inside = int(place[i]) if was_inside and not inside else last_inside
                closes = closes or not inside
            found[path, start] = [first, n + hi - lo, filled, outside, inside, closes, last_outside, last_inside]
    if found:
        columns = [list(c) for c in zip(*((p, s, *v) for (p, s), v in found.items()), strict=True)]
        names = ["path", "block_start", "first", "n", "filled", "outside", "inside", "closes", "last_outside", "last_inside"]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def block_states(lines: DataFrame) -> DataFrame:
    """``path``, ``block_start``; ``first``, the place of the block's first line, and ``before``,
    the lines of the file before it; ``leads``: are all these empty; ``quoted``: does the block
    begin inside a quoted value; ``closed``: does what is open at its end get closed; ``last``, the
    place of the last line that closes an open value in the block.

    One row per file block, whatever a block holds.
    """
    seen = lines.select("path", "block_start", "pos", F.when(F.contains("value", F.lit(b'"')), F.col("value")).alias("value"), ~_is_empty(F.col("value")))
    schema = "path string, block_start long, first long, n long, filled boolean, outside boolean, inside boolean, closes boolean, last_outside long, last_inside long"
    told = seen.mapInArrow(_tell_blocks, schema)
    # A block either ends the same way from both states, or turns the state, or keeps it.
    order = Window.partitionBy("path").orderBy("block_start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.col("outside") & ~F.col("inside")
    counted = told.withColumn("turned", F.sum(turns.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    settled = F.when(F.col("outside") == F.col("inside"), F.struct(F.col("outside").cast("int").alias("to"), "turned"))
    last = F.coalesce(F.last(settled, ignorenulls=True).over(before), F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("turned")))
    since = F.coalesce(F.lag("turned").over(order), F.lit(0)) - last["turned"]
    states = counted.withColumn("quoted", (last["to"] + since) % 2 == 1)
    later = order.rowsBetween(1, Window.unboundedFollowing)
    closed = F.coalesce(F.max(F.col("quoted") & F.col("closes")).over(later), F.lit(False))
    lines_before = F.coalesce(F.sum("n").over(before), F.lit(0))
    crossed = F.col("quoted") | F.when(F.col("quoted"), F.col("inside")).otherwise(F.col("outside"))
    leads = ~F.coalesce(F.max("filled").over(before), F.lit(False))
    return states.select("path", "block_start", "first", lines_before.alias("before"), leads.alias("leads"), "quoted", closed.alias("closed"), crossed.alias("crossed"), F.when(F.col("quoted"), F.col("last_inside")).otherwise(F.col("last_outside")).alias("last"))


def _is_empty(line: Column) -> Column:
    return line.isin(b"", b"\r")


def _cut_records(header: bytes):
    """Records of each block, without headers; a piece at a border says which end of a record it
    is, and whether it begins a header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "block_start", "pos", "record", "opens", "ends", "heads"]
        types = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.bool_(), pa.bool_()]
        block: tuple[str, int] | None = None
        quoted = closed = opens = first = False
        held: list[bytes] = []
        place = last = 0

        def row(record: list[bytes] | None, ends: bool) -> pa.RecordBatch:
            text = b"\n".join(record) if record is not None else None
            values = (*block, place, text, opens, ends, first)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)

        def is_header(record: list[bytes]) -> bool:
            # A file's first record, which is looked at once.
            if _header_text(b"\n".join(record)) != header:
                raise HeaderError(f"{block[0]}: header differs from that of the first file")
            return True

        def rest() -> Iterator[pa.RecordBatch]:
            if held:
                yield row(held if closed else None, False)

        for batch in batches:
            paths, starts, positions, lines, quotes, states, closings, leads, lasts = batch.columns
            for path, start, lo, hi in block_runs(paths, starts):
                if block != (path, start):
                    yield from rest()
                    block, held, first = (path, start), [], leads[lo].as_py()
                    quoted, closed, last = states[lo].as_py(), closings[lo].as_py(), lasts[lo].as_py()
                    opens = not quoted
                some, pos = lines.slice(lo, hi - lo), positions.slice(lo, hi - lo).to_numpy()
                # The state changes at lines with a quote only.
                after = np.empty(hi - lo, bool)
                done, now = 0, quoted
                for i in np.flatnonzero(quotes.slice(lo, hi - lo).to_numpy(zero_copy_only=False)).tolist():
                    after[done:i] = now
                    now = ends_quoted(some[i].as_py(), now)
                    after[i], done = now, i + 1
                after[done:] = now
                ends = np.flatnonzero(~after)
                begin = 0
                if len(ends) and (held or first or not opens or ends[0] > 0):
                    # The first record may go on from an earlier batch or block, or be a header.
                    if not held:
                        place = int(pos[0])
                    held += some.slice(0, int(ends[0]) + 1).to_pylist()
                    if first and (held != [b""] and held != [b"\r"]):
                        first = not is_header(held)
                    elif not first:
                        yield row(held, True)
                    held, opens, begin = [], True, int(ends[0]) + 1
                    ends = ends[1:]
                while first and len(ends):  # only blank lines came before
                    held = some.slice(begin, int(ends[0]) + 1 - begin).to_pylist()
                    if held != [b""] and held != [b"\r"]:
                        first = not is_header(held)
                    held, begin, ends = [], int(ends[0]) + 1, ends[1:]
                if len(ends):
                    starts_at = np.append(begin, ends[:-1] + 1)
                    alone = starts_at == ends
                    if alone.all():
                        records = some.slice(begin, int(ends[-1]) + 1 - begin)
                    else:
                        values = some.slice(0, int(ends[-1]) + 1).to_pylist()
                        records = pa.array([b"\n".join(values[a : b + 1]) for a, b in zip(starts_at.tolist(), ends.tolist(), strict=True)], pa.binary())
                    n = len(records)
                    yes = pa.array(np.ones(n, bool))
                    arrays = [pa.repeat(path, n), pa.repeat(pa.scalar(start, pa.int64()), n), pa.array(pos[starts_at]), records.cast(pa.binary()), yes, yes, pa.array(np.zeros(n, bool))]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)
                    begin = int(ends[-1]) + 1
                if begin < hi - lo:
                    if not held:
                        place = int(pos[begin])
                    # A value that nothing closes may be the rest of the file: only its place is kept.
                    # What is open at the end of a batch may be closed later in the block.
                    held = held + some.slice(begin).to_pylist() if closed or not after[-1] or pos[-1] < last else held or [b""]
                quoted = bool(after[-1])
        yield from rest()

    return run


def _header_text(record: bytes) -> bytes:
    return record.removeprefix(_BYTE_ORDER_MARK).removesuffix(b"\r")


def _header(spark: SparkSession, path: str) -> bytes | None:
    """The first record of a file that is not empty: of the path, or of one file in the folder."""
    text = spark.read.text(path, lineSep="\n").select(plain_path(F.col("_metadata.file_path")).alias("path"), F.col("value").cast("binary").alias("value"))
    head = text.where((F.col("_metadata.file_block_start") == 0) & ~F.col("value").isin(b"", b"\r")).first()
    if head is None:
        return None
    n = HEADER_LINES
    while True:
        some = spark.read.text(head["path"], lineSep="\n").select(F.col("value").cast("binary")).limit(n).collect()
        record, quoted = [], False
        for line in (bytes(r[0]) for r in some):
            if not record and line in (b"", b"\r"):
                continue
            line = line if record else line.removeprefix(_BYTE_ORDER_MARK)
            record.append(line)
            quoted = ends_quoted(line, quoted)
            if not quoted:
                return _header_text(b"\n".join(record))
        if len(some) < n:
            raise HeaderError(f"{head['path']}: {NOT_CLOSED}")
        n *= HEADER_LINES


def csv_records(spark: SparkSession, path: str, header: bytes) -> DataFrame:
    """``path``, ``block_start``, ``pos`` (the number of its first line, from 1) and ``record``
    (bytes; null if not closed), without headers."""
    text = byte_lines(spark.read.text(path, lineSep="\n"))
    states = stage(block_states(text), "csv-blocks")
    # One row per file block goes to every task.
    placed = text.join(F.broadcast(states), ["path", "block_start"])
    has_quote = F.contains("value", F.lit(b'"')).alias("has_quote")
    line = F.col("before") + F.col("pos") - F.col("first") + 1
    last = F.when(F.col("last") >= 0, F.col("before") + F.col("last") - F.col("first") + 1).otherwise(-1)
    schema = "path string, block_start long, pos long, record binary, opens boolean, ends boolean, heads boolean"

    def cut(lines: DataFrame) -> DataFrame:
        return lines.select("path", "block_start", line.alias("pos"), "value", has_quote, "quoted", "closed", "leads", last.alias("last")).mapInArrow(_cut_records(header), schema)

    whole = cut(placed).where("opens and ends").select("path", "block_start", "pos", "record")
    if states.where("crossed").isEmpty():
        return whole
    # Pieces are looked for only in blocks that a record crosses.
    joined = join_pieces(cut(placed.where("crossed")), F.col("ends"))
    # A header over a border of blocks is looked at here.
    start = F.when(F.startswith("record", F.lit(_BYTE_ORDER_MARK)), len(_BYTE_ORDER_MARK) + 1).otherwise(1)
    same = F.startswith(F.substring("record", start, F.octet_length("record")), F.lit(header))
    other = F.raise_error(F.concat("path", F.lit(": header differs from that of the first file"))).cast("boolean")
    return whole.unionByName(joined.where(F.when(~F.col("heads"), True).when(same, False).otherwise(other)).drop("heads"))


def read_csv_docs(spark: SparkSession, path: str) -> DataFrame:
    """One document per CSV row, keys from the header, every value a string.

    A quoted value may hold line breaks; files are split all the same, and one set of rules
    holds for files of any size. A row longer or shorter than the header, one that is no
    UTF-8 text, and one whose quoted value nothing closes are errors; the last one takes in
    the rest of its file; ``doc`` is then the record as it was read. ``pos`` is the number of
    the record's first line. Empty lines are skipped. All files of a folder need one header.
    """
    path = local_form(path)
    header = _header(spark, path)
    if header is None:
        return spark.createDataFrame([], ENVELOPE_DDL)
    try:
        names = next(csv.reader(io.StringIO(header.decode(), newline="")))
    except UnicodeDecodeError as err:
        raise HeaderError(f"{path}: header is {NOT_TEXT}") from err
    # A repeated name cannot be a column name twice; the last column of a name counts.
    unique = len({n.lower() for n in names}) == len(names)
    columns = names if unique else [f"_c{i}" for i in range(len(names))]
    corrupt = "_docferry_corrupt"
    while corrupt in {n.lower() for n in names}:
        corrupt += "_"
    schema = ", ".join("`" + c.replace("`", "``") + "` string" for c in [*columns, corrupt])
    most = max(MOST_FIELDS, 2 * len(names))
    options = {
        "quote": '"', "escape": '"', "maxCharsPerColumn": "-1", "maxColumns": str(most), "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": corrupt, "lineSep": "\n",
    }
    records = csv_records(spark, path, header)
    data = F.col("record")
    # A carriage return before the line break belongs to it.
    data = F.when(F.endswith(data, F.lit(b"\r")), F.substring(data, 1, F.octet_length(data) - 1)).otherwise(data)
    rows = records.withColumn("text", data.cast("string")).where("text is null or text <> ''")
    text = F.col("text")
    commas = F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))
    sound = text.isNotNull() & F.is_valid_utf8(text) & (commas < most)
    rows = rows.withColumn("row", F.when(sound, F.from_csv(text, schema, options)))
    error = (
        F.when(text.isNull(), NOT_CLOSED)
        .when(~F.is_valid_utf8(text), NOT_TEXT)
        .when(F.col("row").isNull() | F.col("row").getField(corrupt).isNotNull(), BAD_WIDTH)
    )
    values = {n: F.coalesce(F.col("row").getField(c), F.lit("")) for n, c in zip(names, columns, strict=True)}
    return envelope(rows, F.when(error.isNull(), row_to_json(values)).otherwise(text), error)

"""Concatenate and cut: documents as one run of token ids, cut into fixed windows.

First pass: every task tokenises its documents, writes the ids with their place within the
task, and so gives one total per task. The prefix sums over these totals are the global
offsets. Second pass: each document is cut where its place crosses a multiple of the window;
a document over a border gives one record on each side. No document is moved by a shuffle.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docferry.llm.common import arrow_rows, stage, worker_store

WINDOW, END_ID = 2048, 1
#: Words whose ids a worker remembers; when full it starts anew, which changes no result.
REMEMBERED = 500_000
#: Texts handed to Python at a time, and encoded at a time.
ROWS = 500


class WordIds(dict):
    """Token ids of blank-separated pieces as the tokenizers library gives them, each made once.

    The vocabulary's normaliser and splitter never join across a blank, so the ids of a text
    are those of its pieces. A piece of letters below U+0250 that stay letters in lower case
    (U+0130 does not) is one pre-token and goes to the library's model at once; any other
    piece goes through the whole of the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self[""] = b""
        self.tokenizer = Tokenizer.from_file(path)
        # The printable letter that stands for each byte in byte-level vocabularies.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        spare = iter(range(256, 512))
        self.letters = {b: b if b in set(plain) else next(spare) for b in range(256)}

    @staticmethod
    def one_pre_token(piece: str) -> bool:
        return piece.isalpha() and max(piece) < "ɐ" and piece.lower().isalpha()

    def ids(self, piece: str) -> bytes:
        if self.one_pre_token(piece):
            text = piece.lower()
            if not text.isascii():
                text = text.encode().decode("latin-1").translate(self.letters)
            ids = [t.id for t in self.tokenizer.model.tokenize(text)]
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def __missing__(self, piece: str) -> bytes:
        # A final stop or comma is a pre-token of its own behind such letters; others may end in a mark, which joins it.
        if piece[-1] in ".," and self.one_pre_token(piece[:-1]):
            out = self[piece[:-1]] + self[piece[-1]]
        else:
            out = self.ids(piece)
        if len(piece) < 64:
            self[piece] = out
        return out

    def encode(self, text: str) -> bytes:
        if "<|" in text:  # a special token may hold no blank, but leave all of it to the library
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if len(self) > REMEMBERED:
            self.clear()
            self[""] = b""
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def _tokenise(vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_store(f"words:{vocabulary}", lambda: WordIds(vocabulary))
        part, start, end = TaskContext.get().partitionId(), 0, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                piece = batch.slice(lo, ROWS)
                ids = [words.encode(t or "") + end for t in piece.column(1).to_pylist()]
                n = np.array([len(x) // 4 for x in ids], np.int64)
                starts = start + np.cumsum(n) - n
                start += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(np.full(len(ids), part, np.int32)), pa.array(starts), pa.array(n), pa.array(ids, pa.binary())],
                    names=["id", "part", "place", "n", "ids"],
                )

    return run


def _cut(window: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], [], [], []]
            keys, place, n, ids = (batch.column(i) for i in range(4))
            for key, at, count, data in zip(keys, place.to_pylist(), n.to_pylist(), ids, strict=True):
                data = memoryview(data.as_buffer())
                start = 0
                while start < count:
                    sequence, offset = divmod(at + start, window)
                    length = min(window - offset, count - start)
                    piece = data[4 * start : 4 * (start + length)]
                    row = (key.as_py(), start, length, zlib.crc32(piece), count, sequence, offset, bytes(piece) if with_ids else None)
                    for column, value in zip(rows, row, strict=True):
                        column.append(value)
                    start += length
            types = [keys.type, *[pa.int64()] * 6, pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(rows, types, strict=True)],
                names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    return run


def pack(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID, with_ids: bool = True
) -> DataFrame:
    """Pieces of documents and their places in sequences of ``window`` tokens.

    One row per piece: the identifier, ``start`` and ``length`` in the document, the CRC-32 of
    its ids (little-endian, 32 bits each), the document's tokens with the end id, the sequence
    and the offset in it, and the ids themselves (``ids``, same form). Only the last sequence is
    short, and is padded by its reader. Null and empty texts are one end id. Rows that repeat
    an identifier are packed each. An empty table gives no rows. ``vocabulary`` is a file that
    every worker can open.
    """
    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    with arrow_rows(docs.sparkSession, ROWS):
        tokens = stage(rows.mapInArrow(_tokenise(vocabulary, end_id), f"id {kind}, part int, place long, n long, ids binary"), "pack-tokens")
    totals = tokens.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row of 12 bytes per task of the first pass, so small enough to send to all.
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    placed = tokens.join(F.broadcast(offsets), "part").select("id", (F.col("place") + F.col("offset")).alias("place"), "n", "ids")
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    out = placed.mapInArrow(_cut(window, with_ids), schema).withColumnRenamed("id", id_col)
    return out if with_ids else out.drop("ids")

"""Token counts by a two-tier lookup in the map, without a shuffle of the corpus's pre-tokens.

First tier: a table of frequent pre-tokens and their lengths, made from a bounded sample and
sent to all workers. Second tier: what it lacks is encoded by the library and remembered in
the worker. Both tiers only save work; every count is the library's own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docferry.llm.common import worker_store

#: Bounds of the frequent table: documents looked at, entries each task gives, entries kept, longest entry.
SAMPLE_DOCS, PER_TASK, ENTRIES, LONGEST = 20_000, 20_000, 65_536, 48
#: Entries a worker remembers besides; when full it starts anew.
REMEMBERED = 250_000


PRE_TOKEN = re.compile(r" +(?:[^ ]+(?: +\Z)?|\Z)")


def split_text(text: str) -> list[str]:
    """Pre-tokens of a sentencepiece text: cut before each run of blanks.

    A pre-token is written without its first blank, as the library puts one in front of any
    text. No piece of the vocabulary holds a blank behind another character, so the tokens
    of a text are those of its pre-tokens. Blanks at the end stay with the last pre-token.
    """
    if not text:
        return []
    if "▁" in text:  # the library's own sign for a blank
        text = text.replace("▁", " ")
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [p[1:] for p in PRE_TOKEN.findall(" " + text)]
    return text.split(" ")


def _processor(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def frequent_lengths(docs: DataFrame, model: str, text_col: str) -> dict[str, int]:
    """Frequent pre-tokens and their lengths in tokens: ``ENTRIES`` at most, of 48 letters at most."""
    n = docs.count()
    sample = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    if n > SAMPLE_DOCS:
        sample = sample.sample(SAMPLE_DOCS / n, seed=7)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(split_text(text))
            if len(seen) > 20 * PER_TASK:
                seen = Counter(dict(seen.most_common(10 * PER_TASK)))
        top = [(t, c) for t, c in seen.most_common(PER_TASK) if c > 1 and len(t) <= LONGEST]
        yield pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in top], pa.string()), pa.array([c for _, c in top], pa.int64())], names=["token", "n"]
        )

    # Sums of the tasks' summaries; the sample bounds how many there are.
    top = sample.mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    tokens = [r.token for r in top.orderBy(F.desc("n"), "token").limit(ENTRIES).select("token").collect()]
    return dict(zip(tokens, map(len, _processor(model).encode(tokens)), strict=True)) if tokens else {}


def count_tokens(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``n_bytes`` and ``n_tokens`` of every whole text, as the sentencepiece file ``model`` gives them.

    No begin, end or added tokens; the names of such tokens inside a text are plain text.
    Null and empty texts count 0. Rows that repeat an identifier are counted each; an empty
    table gives no rows. ``model`` is a file that every worker can open.
    """
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_lengths(docs, model, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = worker_store(f"pieces:{model}", lambda: _processor(model))
        table = frequent.value
        known: dict[str, int] = worker_store(f"lengths:{model}", dict)
        for batch in batches:
            counts = []
            for text in batch.column(1).to_pylist():
                total, missing = 0, []
                for token in split_text(text or ""):
                    n = table.get(token)
                    if n is None:
                        n = known.get(token)
                    if n is None:
                        missing.append(token)
                    else:
                        total += n
                if missing:
                    if len(known) > REMEMBERED:
                        known.clear()
                    lengths = list(map(len, processor.encode(missing, num_threads=1)))
                    total += sum(lengths)
                    known.update((t, n) for t, n in zip(missing, lengths, strict=True) if len(t) <= LONGEST)
                counts.append(total)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    text = F.col(f"`{text_col}`")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), text.alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes")
    )
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)

"""From raw documents to packed sequences: five stages, each on all rows the one before kept.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last give the
columns of documents, whatever further columns there are and however they are called. Stages are
written as Parquet and read again in between, so a lost executor costs the running stage only.
A stage deletes the tables that earlier ones staged, unless the rows it is given are still to be
read from them. In every stage null texts count as empty, and an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.llm import exact, minhash, mixing, packing, toxicity
from docferry.llm.common import recorded, stage, table
from docferry.llm.queries import vocabulary
from docferry.session import discard


Step = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Folders that stages of this process have staged and not deleted.
_STAGED: list[str] = []


def _tidy(step: Step) -> Step:
    """A stage that first deletes what earlier stages staged, as their rows have been written since."""

    @wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles()
        for folder in [f for f in _STAGED if not any(f.split(":", 1)[-1].lstrip("/") in path for path in read)]:
            discard(spark, folder)
            _STAGED.remove(folder)
        with recorded(_STAGED):
            return step(spark, docs, sf_dir)

    return run


def _by_place(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows with columns named by their place, which no inner column is called, and the new names."""
    places = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*places), dict(zip(docs.columns, places, strict=True))


@_tidy
def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold stay.

    Rows are scored each, those without text or identifier too; rows that repeat a text share
    its score. Where labels of one kind only are known, all stay.
    """
    net = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    rows, at = _by_place(docs)
    scored = toxicity.score(rows, net, text_col=at["text"])
    return scored.where(F.col("score") < toxicity.THRESHOLD).drop("score").toDF(*docs.columns)


@_tidy
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, A-Z lower-cased, the one with the largest id stays.

    Null identifiers are the smallest; of rows that repeat both, one stays. All texts without a
    letter or sign at all are equal.
    """
    rows, at = _by_place(docs)
    return exact.drop_exact(rows, at["doc_id"], at["text"]).toDF(*docs.columns)


@_tidy
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked on shingles of five words one row stays, of those with the smallest id.

    Rows are told apart by a number, as ids may repeat or be null; as a table, so that it is
    the same number whenever the rows are read. Texts without words are linked with nothing
    and stay.
    """
    rows, at = _by_place(docs)
    numbered = stage(rows.withColumn("near_row", F.monotonically_increasing_id()), "near-rows")
    gone = minhash.near_groups(numbered, at["doc_id"], at["text"], words=5, row_col="near_row").where("not kept").select("near_row")
    return numbered.join(gone, "near_row", "left_anti").drop("near_row").toDF(*docs.columns)


@_tidy
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one at each source's cut in part.

    A null source is a source of its own. Rows without words come once where their source is
    used at all; rows that repeat identifier and text share one decision.
    """
    rows, at = _by_place(docs)
    return mixing.take_rows(rows, at["doc_id"], at["source"], at["text"], at.get("n_chars", "")).toDF(*docs.columns)


@_tidy
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of fixed length, with their token ids.

    A text without tokens is its end id; rows that repeat an identifier are packed each.
    """
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("minhash_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The model and the signatures cannot be told in SQL; tests hold the stages against plain forms.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

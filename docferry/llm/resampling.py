"""Resampling towards a target by hashed n-grams, with a seeded draw.

Every run of one to three words is a feature, and its checksum names one of a fixed number of
buckets. Buckets are counted over all documents and over all target texts; the logarithm of the
ratio is the bucket's gain, and a document weighs the sum of its features' gains. Gumbel noise
from a hash of the identifier turns the highest scores into a draw without replacement.

The work is in Arrow kernels: texts are lower-cased and split by ``ascii_lower`` and
``split_pattern_regex``, the lists flattened, words encoded by ``dictionary_encode``. Shifted
indices side by side are pairs of words; a pair's index and the next word are a triple. Checksums
are taken once for each distinct one in a slice, gains go back to the places by ``take``, and
differences of running sums reduce them to documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docferry.llm.common import row_slices, stage
from docferry.operators.batch import number_sorted

BUCKETS, SEED = 10_000, 42
#: Documents of fewer words are never drawn; the draw takes this part of the others.
LEAST_WORDS, PERCENT = 20, 5
#: What is no part of a word once A-Z are lower-cased: all of ASCII but digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Text handled at once.
SLICE_BYTES = 4_000_000


class Grams:
    """The features of some texts: what is distinct, and which of it stands at each place."""

    def __init__(self, texts: pa.Array, buckets: int = BUCKETS):
        pieces = pc.split_pattern_regex(pc.ascii_lower(texts.fill_null("")), BETWEEN)
        flat, of = pc.list_flatten(pieces), pc.list_parent_indices(pieces)
        filled = pc.greater(pc.binary_length(flat), 0)
        words, self.of = flat.filter(filled).dictionary_encode(), of.filter(filled).to_numpy()
        #: Words of each text.
        self.lengths = np.bincount(self.of, minlength=len(texts)).astype(np.int64)
        first, kinds = words.indices.to_numpy().astype(np.int64), len(words.dictionary)
        spelt = [w.encode() for w in words.dictionary.to_pylist()]
        sums = list(map(crc32, spelt))
        #: For runs of 1, 2 and 3 words: the buckets of the distinct runs, the run of each place, and the places.
        self.runs = [(np.array(sums, np.int64) % buckets, first, np.arange(len(first)))]
        run = first
        for n in (2, 3):
            together = np.flatnonzero(self.of[n - 1 :] == self.of[: len(self.of) - n + 1]) if len(first) >= n else np.empty(0, np.int64)
            pairs = pa.array(run[together] * kinds + first[together + n - 1]).dictionary_encode()
            left, last = np.divmod(pairs.dictionary.to_numpy(), max(kinds, 1))
            # The checksum of a run goes on from that of the run before its last word.
            so_far = [crc32(b" ", c) for c in sums]
            sums = [crc32(spelt[j], so_far[i]) for i, j in zip(left.tolist(), last.tolist(), strict=True)]
            which = pairs.indices.to_numpy().astype(np.int64)
            self.runs.append((np.array(sums, np.int64) % buckets, which, together))
            run = np.zeros(len(first), np.int64)
            run[together] = which

    def counts(self, buckets: int) -> np.ndarray:
        """Features in each bucket."""
        return sum(np.bincount(bucket[which], minlength=buckets) for bucket, which, _ in self.runs)

    def weights(self, gains: np.ndarray) -> np.ndarray:
        """The sum of the gains of each text's features."""
        at_place = np.zeros(len(self.of), np.int64)
        for bucket, which, places in self.runs:
            at_place[places] += gains[bucket].take(which)
        running = np.concatenate(([0], np.cumsum(at_place)))
        ends = np.cumsum(self.lengths)
        return running[ends] - running[ends - self.lengths]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` and ``n``, the features of all texts that fall into it. ``texts`` has one column."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for lo, hi in row_slices(batch.column(0), SLICE_BYTES):
                total += Grams(batch.column(0).slice(lo, hi - lo), buckets).counts(buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    return texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket: floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))).

    What comes to the driver is one number per bucket and table, whatever the tables hold.
    """

    def counted(df: DataFrame) -> np.ndarray:
        out = np.zeros(buckets)
        for row in bucket_counts(df, buckets).collect():
            out[row.bucket] = row.n
        return out

    s, t = counted(documents), counted(target)
    ratio = ((t + 1) * (s.sum() + buckets)) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``n_words``, ``n_features`` and ``weight`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in row_slices(batch.column(1), SLICE_BYTES):
                grams = Grams(batch.column(1).slice(lo, hi - lo), len(sent.value))
                n = grams.lengths
                features = n + np.maximum(n - 1, 0) + np.maximum(n - 2, 0)
                arrays = [batch.column(0).slice(lo, hi - lo), *map(pa.array, (n, features, grams.weights(sent.value)))]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    seed: int = SEED, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS,
) -> DataFrame:
    """``n_features``, ``weight``, ``score`` and ``rank`` of every row; ``rank`` is null unless the row is drawn.

    Of the rows with at least ``least_words`` words, ``percent`` of a hundred with the highest
    scores are drawn, ties to the smaller identifier, null identifiers last. Null and empty texts
    have no features and weigh 0. Rows that repeat an identifier are weighed each; equal ones are
    ranked in any order. An empty table gives no rows; with an empty target the gains tell rare
    buckets from frequent ones. Other columns of both tables are not looked at.
    """
    gain = gains(docs.select(F.col(f"`{text_col}`").alias("text")), target.select(F.col(f"`{target_col}`").alias("text")), buckets)
    # As a table, for the sort reads its input twice.
    weighed = stage(weigh(docs, gain, id_col, text_col), "resample-weights")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = weighed.withColumn("score", F.col("weight") + noise.cast("long"))
    eligible = F.col("n_words") >= least_words
    # The last key tells equal rows apart, so that many of them spread over ranges.
    order = [F.desc(eligible), F.desc("score"), F.asc_nulls_last("id"), F.monotonically_increasing_id()]
    numbered = number_sorted(scored.orderBy(*order))
    drawn = weighed.where(eligible).count() * percent // 100
    rank = F.when(eligible & (F.col("row_index") < drawn), F.col("row_index") + 1)
    return numbered.select(F.col("id").alias(id_col), "n_features", "weight", "score", rank.alias("rank"))

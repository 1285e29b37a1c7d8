"""Language of whole texts by the nearest of several centroids per language.

A text is a vector of hashed letter 1-, 2- and 3-grams: (1 + log count) times the inverse document
frequency, of length one. Each language's learned vectors are clustered, since texts of one
language differ by kind, and a text takes the language of the centroid with the largest cosine. A
text is rejected that lies too far from it: at less than half the cosine its learned texts reach.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docferry.llm.common import crc_class, stage, worker_store

DIM = 1 << 15
#: Bounds of the fit: distinct texts of a language that are clustered, its centroids, rounds, and languages.
SAMPLE_DOCS, CENTROIDS, ROUNDS, LANGUAGES = 600, 4, 8, 1_000
FOLDS, HELD_OUT = 5, 0
UNKNOWN = "und"
#: Steepness of the score, and letters of a text handled at once.
SCALE, BLOCK = 30.0, 1_000_000
_BLANK = 32


class Letters:
    """Lower-case form of every letter, marks as they are, and a blank for all else."""

    def __init__(self):
        top = 0x32400  # no letters are assigned above
        self.fold, self.letter = np.full(0x110000, _BLANK, np.uint32), np.zeros(0x110000, bool)
        for c in range(top):
            kind = unicodedata.category(chr(c))[0]
            if kind == "L":
                self.fold[c], self.letter[c] = ord(chr(c).lower()[0]), True
            elif kind == "M":
                self.fold[c] = c

    def counts(self, text: str) -> np.ndarray | None:
        """How often each bucket's grams occur in the whole text; None if it has no letter."""
        total, tail, found = np.zeros(DIM, np.int64), np.array([_BLANK], np.uint32), False
        for lo in range(0, len(text), BLOCK):
            codes = np.frombuffer(text[lo : lo + BLOCK].encode("utf-32-le", "surrogatepass"), "<u4")
            found = found or bool(self.letter[codes].any())
            seq = np.concatenate((tail, self.fold[codes]))
            if lo + BLOCK >= len(text):
                seq = np.append(seq, np.uint32(_BLANK))
            blank = seq == _BLANK
            keep = np.append(True, ~(blank[1:] & blank[:-1]))
            old, seq = len(tail), seq[keep]
            a, b, c = seq * np.uint32(0x9E3779B1), seq * np.uint32(0x85EBCA77), seq * np.uint32(0xC2B2AE3D)
            two = (a[:-1] ^ (b[1:] + np.uint32(0x7F4A7C15)))[max(old - 1, 0) :]
            three = (a[:-2] ^ (b[1:-1] >> np.uint32(3)) ^ (c[2:] + np.uint32(0x165667B1)))[max(old - 2, 0) :]
            for grams in (a[old:], two, three):
                mixed = grams ^ (grams >> np.uint32(15))
                total += np.bincount((mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - DIM.bit_length() + 1), minlength=DIM)
            tail = seq[-2:]
        return total if found else None


def _letters() -> Letters:
    return worker_store("langid-letters", Letters)


def _vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the unit vector."""
    at = np.flatnonzero(counts)
    value = (1 + np.log(counts[at])) * idf[at]
    return at, value / np.sqrt(value @ value)


@dataclass(frozen=True)
class Model:
    """Centroids in the order of their languages, and the least cosine each accepts."""

    idf: np.ndarray
    languages: list[str]
    of: np.ndarray
    centroids: np.ndarray  # DIM rows
    least: np.ndarray

    def predict(self, counts: np.ndarray) -> tuple[str, float, float, bool]:
        """Language, score, distance and whether that is too far."""
        at, value = _vector(counts, self.idf)
        cosine = value @ self.centroids[at]
        first = np.flatnonzero(np.append(True, self.of[1:] != self.of[:-1]))
        best = np.maximum.reduceat(cosine, first)
        lang = int(np.argmax(best))
        own = np.flatnonzero(self.of == lang)
        near = own[np.argmax(cosine[own])]
        far = bool(cosine[near] < self.least[near])
        share = 1 / np.exp(SCALE * (best - best[lang])).sum()
        return self.languages[lang], 0.0 if far else float(share), float(1 - cosine[near]), far


def _learning(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    lang, text = F.col(f"`{lang_col}`"), F.col(f"`{text_col}`")
    rows = docs.where(crc_class(F.col(f"`{id_col}`"), FOLDS) != HELD_OUT)
    return rows.select(lang.cast("string").alias("lang"), text.alias("text")).where("lang is not null and text is not null")


def frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and texts with a letter: one number per bucket comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, total = _letters(), np.zeros(DIM + 1, np.int64)
        for batch in batches:
            for text in batch.column(0):
                counts = letters.counts(text.as_py())
                if counts is not None:
                    total[:DIM] += counts > 0
                    total[DIM] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])

    out = np.zeros(DIM + 1, np.int64)
    for row in texts.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[row.at] = row.n
    return out[:DIM], int(out[DIM])


def clustered(vectors: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means of unit rows from far-apart starts: unit centroids, and the least cosine each accepts.

    That is half of what all but the farthest hundredth of its own rows reach.
    """
    centre = vectors.mean(0)
    chosen = [int(np.argmax(vectors @ centre))]
    nearest = vectors @ vectors[chosen[0]]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    centroids = vectors[chosen]
    for _ in range(rounds):
        of = np.argmax(vectors @ centroids.T, 1)
        centroids = np.stack([vectors[of == i].sum(0) if (of == i).any() else centroids[i] for i in range(len(centroids))])
        centroids = centroids / np.linalg.norm(centroids, axis=1, keepdims=True)
    cosine = vectors @ centroids.T
    of = np.argmax(cosine, 1)
    own = [cosine[of == i, i] for i in range(len(centroids))]
    return centroids, np.array([float(np.quantile(c, 0.01)) / 2 if len(c) else 0.0 for c in own])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Learn from rows outside the held-out class with text and language; None if there are none.

    Document frequencies cover all of these rows. Centroids are of ``SAMPLE_DOCS`` distinct
    texts of each language at most, drawn by a hash, each clustered in a task of its own. More
    than ``LANGUAGES`` languages are refused, as the centroids are sent to all workers.
    """
    learn = _learning(docs, id_col, text_col, lang_col)
    df, n = frequencies(learn.select("text"))
    idf = np.log((1 + n) / (1 + df)) + 1
    # Four times the texts wanted pass a hash that repeated texts share; the first of them by hash stay.
    hashed = learn.withColumn("h", F.xxhash64("text"))
    sizes = hashed.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).limit(LANGUAGES + 1).collect()
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    limits = [(r.lang, int((1 << 30) * min(1.0, 4.0 * SAMPLE_DOCS / r.n))) for r in sizes]
    # One row for each language, which are counted above.
    limits = F.broadcast(docs.sparkSession.createDataFrame(limits, "lang string, below long"))
    passed = hashed.join(limits, "lang").where(F.pmod("h", F.lit(1 << 30)) < F.col("below"))
    once = passed.groupBy("lang", "h").agg(F.min("text").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(idf)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters()
        for batch in batches:
            for i, text in enumerate(batch.column(2)):
                counts = letters.counts(text.as_py())
                if counts is not None:
                    at, value = _vector(counts, sent.value)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([at.astype(np.int32)]), pa.array([value.astype(np.float32)])],
                        names=["lang", "h", "at", "value"],
                    )

    found = stage(once.mapInArrow(vectors, "lang string, h long, at array<int>, value array<float>"), "langid-vectors")
    ranked = found.withColumn("place", F.expr("row_number() over (partition by lang order by pmod(h, 1073741824), h)"))

    def cluster(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        rows = np.zeros((len(table), DIM), np.float32)
        for i, (at, value) in enumerate(zip(table.column("at"), table.column("value"), strict=True)):
            rows[i, at.values.to_numpy()] = value.values.to_numpy()
        centroids, least = clustered(rows)
        k = len(least)
        return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * k), "k": pa.array(range(k), pa.int32()), "least": least, "centroid": pa.array(list(centroids.astype(np.float32)))})

    model = ranked.where(F.col("place") <= SAMPLE_DOCS).groupBy("lang").applyInArrow(cluster, "lang string, k int, least double, centroid array<float>")
    rows = sorted(model.collect(), key=lambda r: (r.lang, r.k))
    if not rows:
        return None
    languages = sorted({r.lang for r in rows})
    of = np.array([languages.index(r.lang) for r in rows])
    return Model(idf, languages, of, np.array([r.centroid for r in rows], np.float32).T.copy(), np.array([r.least for r in rows]))


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", reject: bool = False) -> DataFrame:
    """``held_out``, ``lang_pred``, ``score`` (0 to 1), ``distance`` and ``rejected`` of every row.

    Texts that are null or hold no letter are ``und`` with score 0 and no distance, as is every
    text without a model. A rejected text has score 0 and keeps its nearest language, unless
    ``reject`` is set: then it is ``und`` too. Rows that repeat an identifier are predicted
    each; an empty table gives no rows; other columns are not looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, net = _letters(), sent.value
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text in batch.column(2):
                counts = letters.counts(text.as_py() or "") if net is not None else None
                row = (UNKNOWN, 0.0, None, False) if counts is None else net.predict(counts)
                if reject and row[3]:
                    row = (UNKNOWN, *row[1:])
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            arrays = [pa.array(v, t) for v, t in zip(out, (pa.string(), pa.float64(), pa.float64(), pa.bool_()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=["id", "held_out", "lang_pred", "score", "distance", "rejected"])

    key: Column = F.col(f"`{id_col}`")
    rows = docs.select(key.alias("id"), (crc_class(key, FOLDS) == HELD_OUT).alias("held_out"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double, distance double, rejected boolean").withColumnRenamed("id", id_col)

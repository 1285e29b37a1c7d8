"""Context-tree weighting over bytes, trained on a corpus by counting.

A text is its bytes (A-Z lower-cased) and one end mark. Each byte is eight binary choices,
and each choice is predicted by the nodes of a context tree: the node of depth d knows the d
bytes before and the bits chosen so far. A node's Krichevsky-Trofimov estimate and the
product of its children are weighed by one half each, which mixes all depths by how well
they tell the corpus. As counts do not change while scoring, the mixture gives every
(context, byte) one code length.

1. Tasks cut their documents into chunks of bounded size and count, once in each chunk, words
   and ``DEPTH`` + 1 bytes in a row (grams), which hold the counts of all shorter contexts.
   The texts are kept next to these tables, compressed.
2. Counts are summed over the corpus. Grams meet by their two nearest context bytes, and such a
   subtree is staged as one row: all deeper nodes are settled in it, the few nodes above from
   one summary per subtree, and then the code lengths are told, without another shuffle.
3. Code lengths and word counts go back to the chunks that asked for them, so nothing that
   grows with the corpus is sent to all tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docferry.llm.common import crc_class, n_tasks, row_slices, stage

DEPTH = 5
END, BEFORE = 0xFF, 0x00  # bytes that no UTF-8 text holds, and the context before a text
CHUNK_BYTES, BLOCK_BYTES = 32_000_000, 6_000_000
FOLDS, HELD_OUT = 7, 2
_HALF = np.log(0.5)


def grams_of(texts: list[bytes], depth: int = DEPTH) -> np.ndarray:
    """The context and byte of every place of the texts: ``depth`` + 1 bytes, the byte lowest."""
    lead, tail = bytes([BEFORE]) * depth, bytes([END])
    data = b"".join(lead + t + tail for t in texts)
    # Eight bytes from every place on, read as one big-endian number; the upper ones are cut off.
    n = len(data) - depth
    eight = np.ndarray((n,), ">u8", bytes(7 - depth) + data, strides=(1,))
    key = (eight.astype(np.int64)) & ((1 << 8 * (depth + 1)) - 1)
    if len(texts) == 1:
        return key
    keep = np.ones(n, bool)
    ends = np.cumsum([len(t) + 1 + depth for t in texts])[:-1]
    for i in range(depth):  # places that reach over from one text into the next
        keep[ends - depth + i] = False
    return key[keep]


def _counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if weights is None:
        keys = np.sort(keys)
        weights = np.ones(len(keys), np.int64)
    else:
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
    if not len(keys):
        return keys, weights
    start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[start], np.add.reduceat(weights, start)


class _Chunk:
    """Words and grams of the documents of one chunk; counts are of those learned from."""

    def __init__(self, block_bytes: int):
        self.learned, self.words = Counter(), set()
        self.blocks: dict[bool, list[bytes]] = {True: [], False: []}
        self.block_bytes, self.size, self.waiting, self.parts = block_bytes, 0, 0, []

    def add(self, text: bytes, held: bool):
        (self.words if held else self.learned).update(text.split())
        self.blocks[held].append(text)
        self.size += len(text)
        self.waiting += len(text)
        if self.waiting > self.block_bytes:
            self.flush()

    def flush(self):
        for held, texts in self.blocks.items():
            if texts:
                keys, n = _counted(grams_of(texts))
                self.parts.append((keys, n * (not held)))
        self.blocks, self.waiting = {True: [], False: []}, 0

    def tables(self) -> list:
        """Hashes of the words and their counts, grams and their counts."""
        self.flush()
        words = list(self.learned) + list(self.words - self.learned.keys())
        keys, n = _counted(*(np.concatenate(x) for x in zip(*self.parts, strict=True))) if self.parts else (np.empty(0, np.int64),) * 2
        return [list(map(_word_hash, words)), [self.learned[w] for w in words], keys, n]


def _word_hash(word: bytes) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(word) - (1 << 63)


def _survey(chunk_bytes: int, block_bytes: int):
    """Blocks of documents with their chunk; a chunk's last block carries its tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(3).compress
        part, number, chunk = TaskContext.get().partitionId() << 24, 0, _Chunk(block_bytes)
        waiting: list | None = None
        names = ["chunk", "ids", "held", "sizes", "texts", "word_h", "word_n", "grams", "gram_n"]

        def row(ids: pa.Array, helds: list[bool], texts: list[bytes], tables: list | None) -> pa.RecordBatch:
            arrays = [
                pa.array([part + number]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.array([helds], pa.list_(pa.bool_())), pa.array([list(map(len, texts))], pa.list_(pa.int32())),
                pa.array([pack(b"".join(texts))], pa.binary()),
                *[pa.array([t], pa.list_(pa.int64())) for t in tables or [None] * 4],
            ]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for lo, hi in row_slices(batch.column(2), block_bytes):
                if waiting:
                    if chunk.size >= chunk_bytes:
                        yield row(*waiting, chunk.tables())
                        number, chunk = number + 1, _Chunk(block_bytes)
                    else:
                        yield row(*waiting, None)
                piece = batch.slice(lo, hi - lo)
                texts, held = [t.lower() for t in piece.column(2).to_pylist()], piece.column(1).to_pylist()
                for t, h in zip(texts, held, strict=True):
                    chunk.add(t, h)
                waiting = [piece.column(0), held, texts]
        if waiting:
            yield row(*waiting, chunk.tables())

    return run


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x >= 0.5, by Stirling's series above 8."""
    shift = np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov probability of so many zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - np.log(np.pi) + 0.0


class _Level:
    """The nodes of one depth and bit, with counts and the weighted probability."""

    def __init__(self, context: np.ndarray, prefix: np.ndarray, bit: np.ndarray, n: np.ndarray, below: _Level | None):
        key = context * 256 + prefix
        self.key, self.of = np.unique(key, return_inverse=True)
        ones = np.bincount(self.of, n * bit, len(self.key))
        self.n = np.bincount(self.of, n, len(self.key))
        self.ones = ones
        kt = np.where(self.n > 0, _log_kt(self.n - ones, ones), 0)
        if below is None:
            self.log_p, self.own = kt, np.ones(len(kt))
        else:
            first = np.zeros(len(below.key), np.int64)
            first[below.of] = self.of
            deeper = np.bincount(first, below.log_p, len(self.key))
            self.log_p = np.logaddexp(_HALF + kt, _HALF + deeper)
            self.own = np.exp(_HALF + kt - self.log_p)


def predictions(grams: np.ndarray, n: np.ndarray, top: int, depth: int = DEPTH) -> tuple[np.ndarray, list[_Level]]:
    """For each gram and bit: what the nodes from ``depth`` up to ``top`` bytes of context give to a one; the nodes at ``top``."""
    byte = grams & 255
    ones, roots = np.empty((8, len(grams))), []
    for b in range(8):
        prefix, bit = (byte >> (8 - b)) | (1 << b), (byte >> (7 - b)) & 1
        below, p = None, None
        for d in range(depth, top - 1, -1):
            level = _Level((grams >> 8) & ((1 << 8 * d) - 1), prefix, bit, n, below)
            own = ((level.ones + 0.5) / (level.n + 1))[level.of]
            w = level.own[level.of]
            p = own if p is None else w * own + (1 - w) * p
            below = level
        ones[b] = p
        roots.append(below)
    return ones, roots


def _subtrees(grams: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes at depth 2 of these grams: key (context, bits), visits, ones, log of the weighted probability."""
    _, roots = predictions(grams, n, 2)
    return tuple(np.concatenate(x) for x in zip(*((r.key, r.n, r.ones, r.log_p) for r in roots), strict=True))


class Upper:
    """The nodes of depth 0 and 1, settled from the nodes of depth 2: at most 256 * 255 of them."""

    def __init__(self, key: np.ndarray, n: np.ndarray, ones: np.ndarray, log_p: np.ndarray):
        prefix, context = key & 255, key >> 8
        self.table = {}
        for d in (1, 0):
            at, of = np.unique((context & (255 if d else 0)) * 256 + prefix, return_inverse=True)
            count, hits, deeper = (np.bincount(of, x, len(at)) for x in (n, ones, log_p))
            kt = np.where(count > 0, _log_kt(count - hits, hits), 0)
            weighted = np.logaddexp(_HALF + kt, _HALF + deeper)
            self.table[d] = (at, (hits + 0.5) / (count + 1), np.exp(_HALF + kt - weighted))
            key, n, ones, log_p, context = at, count, hits, weighted, at >> 8
            prefix = at & 255

    def lengths(self, grams: np.ndarray, n: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's byte in its context."""
        p, _ = predictions(grams, n, 2)
        byte, out = grams & 255, np.zeros(len(grams))
        for b in range(8):
            prefix, one = (byte >> (8 - b)) | (1 << b), p[b]
            for d in (1, 0):
                at, own, w = self.table[d]
                i = np.searchsorted(at, ((grams >> 8) & (255 if d else 0)) * 256 + prefix)
                one = w[i] * own[i] + (1 - w[i]) * one
            out += np.log10(np.where((byte >> (7 - b)) & 1, one, 1 - one))
        return out


class Lookup:
    """Values by key for many keys at once: a direct table, and a search where two keys share its place."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.shift = np.uint64(64 - max(10, int(len(keys) * 4).bit_length()))
        self.slot = np.zeros(1 << int(64 - self.shift), np.int32)
        self.slot[self._at(self.keys)] = np.arange(len(keys), dtype=np.int32)

    def _at(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.slot[self._at(keys)]
        wrong = np.flatnonzero(self.keys[at] != keys)
        at[wrong] = np.searchsorted(self.keys, keys[wrong])
        return self.values[at]


class _Counts(dict):
    """Counts of words, looked up once by hash for each word."""

    def __init__(self, of: dict[int, int]):
        self.of = of

    def __missing__(self, word: bytes) -> int:
        self[word] = n = self.of.get(_word_hash(word), 0)
        return n


def _scored(seen: int, kinds: int, learned: int):
    def run(key, docs: pa.Table, tables: pa.Table) -> pa.Table:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        is_word = tables.column("is_word").to_numpy()
        keys, values = tables.column("key").to_numpy(), tables.column("value").to_numpy()
        counts = _Counts(dict(zip(keys[is_word].tolist(), values[is_word].astype(np.int64).tolist(), strict=True)))
        lengths = Lookup(keys[~is_word], values[~is_word])
        level = np.log10(seen + kinds + 1)
        out: list[list] = [[], [], [], []]
        for blob, sizes in zip(docs.column("texts"), docs.column("sizes"), strict=True):
            data, ends = unpack(blob.as_py()), np.cumsum(sizes.values.to_numpy(), dtype=np.int64).tolist()
            block = [data[i:j] for i, j in zip([0, *ends[:-1]], ends, strict=True)]
            coded = lengths(grams_of(block))
            out[3] += np.add.reduceat(coded, np.cumsum([0] + [len(t) + 1 for t in block[:-1]])).tolist()
            for text in block:
                tokens = text.split()
                c = np.fromiter(map(counts.__getitem__, tokens), np.int64, len(tokens))
                out[0].append(len(tokens) + 1)
                # The end counts as known where any document was learned from.
                out[1].append(int(np.count_nonzero(c)) + (learned > 0))
                out[2].append(float(np.log10(c + 1).sum() + np.log10(learned + 1) - (len(tokens) + 1) * level))
        ids, held = (docs.column(c).combine_chunks().flatten() for c in ("ids", "held"))
        n = pa.array(np.full(len(ids), seen, np.int64))
        return pa.table([ids, held, pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), n, pa.array(out[2], pa.float64()), pa.array(out[3], pa.float64())],
                        names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def _per_subtree(work: Callable[[np.ndarray, np.ndarray], dict[str, np.ndarray]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grams, n in zip(batch.column(0), batch.column(1), strict=True):
                yield pa.RecordBatch.from_pydict(work(grams.values.to_numpy(), n.values.to_numpy()))

    return run


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """For every row: tokens, known tokens, the unigram ``base_score``, and ``score``.

    ``score`` is the log10 probability of the text's bytes and end under the model learned
    from rows outside the held-out class; ``base_score`` sums log10((c + 1) / (N + V + 1)) over
    the words and the end. Null and empty texts are the end only. Rows that repeat an
    identifier count and are scored each. Where nothing is learned, all choices are even. An
    empty table gives no rows. ``chunk_bytes`` and ``block_bytes`` bound what a task counts and
    handles at once and change no result.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        (crc_class(F.col(f"`{id_col}`"), FOLDS) == HELD_OUT).alias("held"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    lists = "word_h array<long>, word_n array<long>, grams array<long>, gram_n array<long>"
    blocks = f"chunk long, ids array<{kind}>, held array<boolean>, sizes array<int>, texts binary, {lists}"
    survey = stage(rows.mapInArrow(_survey(chunk_bytes, block_bytes), blocks), "lm-survey")
    chunks = survey.where("grams is not null")

    # Words meet by a 64-bit hash, which is shorter than they are.
    words = chunks.select("chunk", F.explode(F.arrays_zip("word_h", "word_n")).alias("w")).select("chunk", "w.word_h", "w.word_n")
    counts = stage(words.groupBy("word_h").agg(F.sum("word_n").alias("word_c")).where("word_c > 0"), "lm-words")
    learned = survey.agg(F.coalesce(F.sum(F.size(F.filter("held", lambda h: ~h))), F.lit(0))).first()[0]
    total = counts.agg(F.coalesce(F.sum("word_c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    seen, kinds = total.n + learned, total.v + (learned > 0)
    known = words.join(counts, "word_h").select(F.col("chunk").alias("of"), F.lit(True).alias("is_word"), F.col("word_h").alias("key"), F.col("word_c").cast("double").alias("value"))

    grams = chunks.select("chunk", F.explode(F.arrays_zip("grams", "gram_n")).alias("g")).select("chunk", "g.grams", "g.gram_n")
    # All grams with the same two nearest bytes lie in one group; a group holds several such subtrees.
    subtree = F.pmod(F.xxhash64(F.shiftright("grams", 8).bitwiseAND(0xFFFF)), F.lit(4 * n_tasks(docs.sparkSession)))
    sums = grams.groupBy("grams").agg(F.sum("gram_n").alias("n")).withColumn("near", subtree)

    def together(table: pa.Table) -> pa.Table:
        table = table.sort_by("grams")
        return pa.table({c: pa.array([table.column(c).to_numpy()], pa.list_(pa.int64())) for c in ("grams", "n")})

    subtrees = stage(sums.groupBy("near").applyInArrow(together, "grams array<long>, n array<long>"), "lm-subtrees")

    def settle(grams: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
        return dict(zip(("key", "n", "ones", "log_p"), _subtrees(grams, n), strict=True))

    nodes = subtrees.mapInArrow(_per_subtree(settle), "key long, n double, ones double, log_p double")
    # Summed by their depth-1 parents first: what comes to the driver has 256 * 255 rows at most.
    parents = nodes.groupBy((F.shiftright("key", 8).bitwiseAND(255) * 256 + F.col("key").bitwiseAND(255)).alias("key"))
    upper_rows = parents.agg(F.sum("n").alias("n"), F.sum("ones").alias("ones"), F.sum("log_p").alias("log_p")).toArrow()
    upper = Upper(*(upper_rows.column(c).to_numpy() for c in ("key", "n", "ones", "log_p")))

    def lengths(grams: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
        return {"grams": grams, "log_p": upper.lengths(grams, n)}

    coded = subtrees.mapInArrow(_per_subtree(lengths), "grams long, log_p double")
    asked = grams.select("chunk", "grams").join(coded, "grams")
    tables = asked.select(F.col("chunk").alias("of"), F.lit(False).alias("is_word"), F.col("grams").alias("key"), F.col("log_p").alias("value")).unionByName(known)
    schema = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    texts = survey.select("chunk", "ids", "held", "sizes", "texts")
    return texts.groupBy("chunk").cogroup(tables.groupBy("of")).applyInArrow(_scored(seen, kinds, learned), schema).withColumnRenamed("id", id_col)

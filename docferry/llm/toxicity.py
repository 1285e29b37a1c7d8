"""Toxicity of whole texts: a bidirectional gated recurrent network over overlapping windows.

Every word enters by an embedding of the word and one of its letters' 3- and 4-grams, both
hashed. Windows of ``SPAN`` words, each half over the next, go through the network and are
pooled by attention; a document's score is that of its worst window. The network is trained
in numpy, by one task, on a bounded sample of labelled rows; scoring is one pass over all texts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docferry.llm.common import crc_class, stage, worker_store

SPAN, STRIDE = 16, 8
WORD_ROWS, GRAM_ROWS, WIDTH, HIDDEN, ATTENTION = 1 << 15, 1 << 16, 6, 8, 8
#: Bounds of the training sample: documents of each label, their rows where identifiers repeat, and letters of the whole sample.
SAMPLE_DOCS, SAMPLE_ROWS, SAMPLE_LETTERS = 2_500, 10_000, 24_000_000
#: Letters of each window that a text too long for the sample is cut to.
CUT_LETTERS = 2_000
ROUNDS, STEPS, BATCH = 4, 150, 192
#: Rows whose checksum falls into this class of four are never learned from.
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
#: Words whose input a worker remembers, and letters of text it handles at once.
REMEMBERED, CHUNK_LETTERS = 150_000, 1_000_000
#: Windows that go through the network together.
WINDOWS_AT_ONCE = 1024
_TRIM = "".join(chr(c) for c in range(33, 128) if not chr(c).isalnum())


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed rows of each word, and of the letter grams of all words with the words' first places."""
    from xxhash import xxh3_64_intdigest

    cores = [w.lower().strip(_TRIM).encode() or w.encode() for w in words]
    rows = np.array([xxh3_64_intdigest(c) % (WORD_ROWS - 1) + 1 for c in cores], np.int64)
    text = np.frombuffer(b" " + b" ".join(cores) + b" \x00\x00\x00", np.uint8).astype(np.uint64)
    n = len(text) - 3
    first = np.concatenate(([0], np.cumsum([len(c) + 1 for c in cores])[:-1])).astype(np.int64)
    three = (text[:n] * np.uint64(0x1F123BB5)) ^ (text[1 : n + 1] * np.uint64(0x5851F42D4C957F2D)) ^ (text[2 : n + 2] * np.uint64(0x14057B7EF767814F))
    four = three ^ (text[3:] * np.uint64(0x2545F4914F6CDD1D))
    shift = np.uint64(64 - GRAM_ROWS.bit_length() + 1)
    grams = np.stack([np.maximum((h * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int64), 1) for h in (three, four)], 1)
    blank = text == 32
    # A gram lies in one word: blanks only at its ends. Others point to the empty row 0.
    grams[blank[1 : n + 1], 0] = 0
    grams[blank[1 : n + 1] | blank[2 : n + 2], 1] = 0
    return rows, grams[: first[-1] + len(cores[-1]) + 1], first


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _soft(x: np.ndarray) -> np.ndarray:
    """Softsign, the squashing function of the gates and states: no exponential in the recurrence."""
    return x / (1 + np.abs(x))


class Network:
    """Parameters by name, the pass forward, and the gradients of a batch."""

    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        h, d = HIDDEN, 2 * WIDTH
        draw = lambda *s: r.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32)
        self.p = {
            "words": r.normal(0, 0.05, (WORD_ROWS, WIDTH)).astype(np.float32), "grams": r.normal(0, 0.05, (GRAM_ROWS, WIDTH)).astype(np.float32),
            "attend": draw(2 * h, ATTENTION), "focus": draw(ATTENTION), "out": draw(2 * h), "bias": np.zeros(1, np.float32),
        }
        for side in "fb":
            self.p |= {f"in_{side}": draw(d, 3 * h), f"base_{side}": np.zeros(3 * h, np.float32), f"back_{side}": draw(h, 3 * h)}

    def inputs(self, rows: np.ndarray, grams: np.ndarray, first: np.ndarray) -> np.ndarray:
        """One row of word and letter embeddings for each word, from the words' features."""
        p = self.p
        letters = np.cumsum(p["grams"][grams[:, 0]] + p["grams"][grams[:, 1]], axis=0, dtype=np.float64)
        last = np.append(first[1:], len(grams)) - 1
        letters = np.diff(letters[last], axis=0, prepend=0)
        counts = np.cumsum((grams[:, 0] > 0).astype(np.int32) + (grams[:, 1] > 0))[last]
        count = np.maximum(np.diff(counts, prepend=0), 1)
        return np.concatenate((p["words"][rows], letters / np.sqrt(count)[:, None]), 1).astype(np.float32)

    def projected(self, x: np.ndarray) -> np.ndarray:
        """What a word gives to the gates of both directions; row 0 is no word."""
        p = self.p
        return np.concatenate([x @ p[f"in_{s}"] + p[f"base_{s}"] for s in "fb"], -1)

    def forward(self, gates: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows. gates: (SPAN, 6 * HIDDEN, windows); mask, (SPAN, windows): which places hold words.

        Windows lie along the last axis, so every step works on long contiguous rows.
        """
        p, h = self.p, HIDDEN
        n = gates.shape[-1]
        states = np.empty((SPAN, 2 * h, n), np.float32)
        for i, side in enumerate("fb"):
            state, back = np.zeros((h, n), np.float32), np.ascontiguousarray(p[f"back_{side}"].T)
            for t in range(SPAN) if side == "f" else range(SPAN - 1, -1, -1):
                x, u = gates[t, 3 * h * i : 3 * h * (i + 1)], back @ state
                zr = _soft(x[: 2 * h] + u[: 2 * h])
                zr *= 0.5
                zr += 0.5
                z, r = zr[:h], zr[h:]
                new = _soft(x[2 * h :] + r * u[2 * h :])
                if keep is not None:
                    keep[side, t] = (state, z, r, new, u[2 * h :])
                state = new + z * (state - new)
                states[t, h * i : h * (i + 1)] = state
        view = _soft(p["attend"].T @ states)
        weight = np.where(mask, np.tensordot(p["focus"], view, (0, 1)), np.float32(-1e9))
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        pooled = (weight[:, None] * states).sum(0)
        if keep is not None:
            keep |= {"states": states, "view": view, "weight": weight, "pooled": pooled}
        return p["out"] @ pooled + p["bias"][0]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the mean cross-entropy by parameter, and of the inputs. x: (SPAN, windows, inputs)."""
        p, h, g, keep = self.p, HIDDEN, {}, {}
        gates = np.ascontiguousarray(self.projected(x).transpose(0, 2, 1))
        d = (_sigmoid(self.forward(gates, mask, keep)) - y).astype(np.float32) / len(y)
        states, view, weight = keep["states"], keep["view"], keep["weight"]
        g["out"], g["bias"] = keep["pooled"] @ d, d.sum(keepdims=True)
        pooled = p["out"][:, None] * d
        dw = (states * pooled).sum(1)
        dw = weight * (dw - (dw * weight).sum(0))
        g["focus"] = np.einsum("tn,tan->a", dw, view)
        dv = p["focus"][:, None] * dw[:, None] * (1 - np.abs(view)) ** 2
        g["attend"] = np.einsum("thn,tan->ha", states, dv)
        ds = weight[:, None] * pooled + p["attend"] @ dv
        dx = np.zeros_like(x)
        for i, side in enumerate("fb"):
            back = p[f"back_{side}"]
            g[f"back_{side}"], g[f"in_{side}"], g[f"base_{side}"] = np.zeros_like(back), 0, 0
            carry = np.zeros((h, len(y)), np.float32)
            for t in range(SPAN - 1, -1, -1) if side == "f" else range(SPAN):
                state, z, r, new, u = keep[side, t]
                dh = ds[t, h * i : h * (i + 1)] + carry
                da = dh * (1 - z) * (1 - np.abs(new)) ** 2
                dz, dr = (v * (0.5 * (1 - np.abs(2 * q - 1)) ** 2) for v, q in ((dh * (state - new), z), (da * u, r)))
                du, dg = np.concatenate((dz, dr, da * r)), np.concatenate((dz, dr, da))
                g[f"back_{side}"] += state @ du.T
                carry = dh * z + back @ du
                g[f"in_{side}"] += x[t].T @ dg.T
                g[f"base_{side}"] += dg.sum(1)
                dx[t] += (p[f"in_{side}"] @ dg).T
        return g, dx * mask[:, :, None]


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and number of words of each window of texts laid end to end, and each text's first window."""
    count = np.maximum(1, -(-(lengths - SPAN) // STRIDE) + 1)
    first = np.cumsum(count) - count
    text = np.repeat(np.arange(len(lengths)), count)
    shift = (np.arange(len(text)) - first[text]) * STRIDE
    begin = np.cumsum(lengths) - lengths
    return begin[text] + shift, np.minimum(lengths[text] - shift, SPAN).astype(np.int32), first


def places_of(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word places and mask (SPAN, windows) of these windows."""
    step = np.arange(SPAN)[:, None]
    mask = step < size
    return np.where(mask, start + step, 0), mask


def _by_row(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows and the sum of the values of each."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    start = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    return rows[start], np.add.reduceat(values[order], start, axis=0)


def train(rows: Iterable[tuple[str, int]], seed: int = 11) -> Network | None:
    """Fit to labelled texts; None unless both labels occur.

    A label holds for a text, not for each window. Of a text labelled 1, the window that
    now scores worst is taught as 1; texts labelled 0 teach random windows and the worst.
    Texts are read one by one; what stays of them is one number for each word.
    """
    index: dict[str, int] = {}
    numbers, labels = [], []
    for text, label in rows:
        doc = text.split() or [""]
        numbers.append(np.fromiter((index.setdefault(w, len(index)) for w in doc), np.int32, len(doc)))
        labels.append(label)
    y = np.array(labels)
    if not (0 < y.sum() < len(y)):
        return None
    r, net = np.random.default_rng(seed), Network(seed)
    words = _Features(list(index))
    del index
    # In how many texts of each label a word occurs.
    positive, negative = np.zeros(words.n, np.int32), np.zeros(words.n, np.int32)
    for doc, label in zip(numbers, labels, strict=True):
        (positive if label else negative)[np.unique(doc)] += 1
    lengths = np.array(list(map(len, numbers)))
    ids = np.concatenate(numbers)
    del numbers
    # The first number of every embedding starts at the log-odds of its row among the texts.
    odds = lambda a, b: np.log((a + 0.5) / (y.sum() + 1)) - np.log((b + 0.5) / (len(y) - y.sum() + 1))
    for name, size, columns, of in (("words", WORD_ROWS, [words.rows], slice(None)), ("grams", GRAM_ROWS, words.grams.T, words.of_gram())):
        a, b = (sum(np.bincount(at, c[of], size) for at in columns) for c in (positive, negative))
        net.p[name][:, 0] = np.clip(odds(a, b), -2, 4) * np.minimum(1, (a + b) / 10) / 2
        net.p[name][0] = 0
    start, size, begin = windows(lengths)
    texts_of = np.repeat(np.arange(len(lengths), dtype=np.int32), np.diff(np.append(begin, len(start))))
    word_score = (np.clip(odds(positive, negative), 0, None) * (positive > 2)).astype(np.float32)
    score = np.empty(len(start), np.float32)
    for i in range(0, len(start), WINDOWS_AT_ONCE):
        places, mask = places_of(start[i : i + WINDOWS_AT_ONCE], size[i : i + WINDOWS_AT_ONCE])
        score[i : i + WINDOWS_AT_ONCE] = np.where(mask, word_score[ids[places]], 0).sum(0)
    clean = np.flatnonzero(y[texts_of] == 0)
    rows, grams, first, span = words.rows, words.grams, words.first, words.span
    scale = np.sqrt(np.maximum(np.add.reduceat((grams > 0).sum(1), first), 1)).astype(np.float32)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    for step_round in range(ROUNDS):
        order = np.lexsort((-score, texts_of))
        worst = order[begin]
        bad, hard = worst[y == 1], worst[y == 0]
        hard = hard[np.argsort(-score[hard])][: max(BATCH, len(hard) // 4)]
        for step in range(STEPS):
            take = np.concatenate((r.choice(bad, BATCH // 2), r.choice(clean, BATCH // 4), r.choice(hard, BATCH // 4)))
            places, m = places_of(start[take], size[take])
            w = ids[places]
            used, back = np.unique(w, return_inverse=True)
            back = back.reshape(w.shape)
            # The letter grams of the words in use, and which of these words each belongs to.
            of = np.repeat(np.arange(len(used)), span[used])
            at = np.arange(len(of)) - np.repeat(np.cumsum(span[used]) - span[used], span[used]) + np.repeat(first[used], span[used])
            some = grams[at]
            letters = np.zeros((len(used), WIDTH), np.float32)
            np.add.at(letters, of, net.p["grams"][some].sum(1))
            x_used = np.concatenate((net.p["words"][rows[used]], letters / scale[used, None]), 1)
            g, dx = net.gradients(x_used[back] * m[:, :, None], m, y[texts_of[take]])
            d_used = np.zeros_like(x_used)
            np.add.at(d_used, back, dx)
            g["words"] = _by_row(rows[used], d_used[:, :WIDTH])
            g["grams"] = _by_row(some.ravel(), np.repeat((d_used[:, WIDTH:] / scale[used, None])[of], 2, axis=0))
            t = step_round * STEPS + step + 1
            for k, v in g.items():
                # Rows of embeddings that the batch does not use stay as they are.
                here, v = v if k in ("words", "grams") else (slice(None), v)
                a, b = moment[k]
                a[here] += 0.1 * (v - a[here])
                b[here] += 0.01 * (v * v - b[here])
                net.p[k][here] -= 0.01 * (a[here] / (1 - 0.9**t)) / (np.sqrt(b[here] / (1 - 0.99**t)) + 1e-6)
            net.p["grams"][0] = 0
        score = _sigmoid(_forward(net, words.gates(net), ids, start, size))
    return net


class _Features:
    """Features of many words, made in blocks: embedding rows, letter grams, and where a word's grams begin."""

    BLOCK = 50_000

    def __init__(self, words: list[str]):
        self.n = len(words)
        blocks = [features(words[i : i + self.BLOCK]) for i in range(0, self.n, self.BLOCK)]
        self.rows = np.concatenate([b[0] for b in blocks])
        self.grams = np.concatenate([b[1].astype(np.int32) for b in blocks])
        before = np.cumsum([0] + [len(b[1]) for b in blocks])
        self.first = np.concatenate([b[2] + n for b, n in zip(blocks, before, strict=False)])
        self.span = np.diff(np.append(self.first, len(self.grams)))

    def of_gram(self) -> np.ndarray:
        """The word each gram belongs to."""
        return np.repeat(np.arange(self.n, dtype=np.int32), self.span)

    def gates(self, net: Network) -> np.ndarray:
        """What every word gives to the gates."""
        out = np.empty((self.n, 6 * HIDDEN), np.float32)
        ends = np.append(self.first, len(self.grams))
        for i in range(0, self.n, self.BLOCK):
            j = min(i + self.BLOCK, self.n)
            out[i:j] = net.projected(net.inputs(self.rows[i:j], self.grams[ends[i] : ends[j]], self.first[i:j] - ends[i]))
        return out


def _forward(net: Network, gates: np.ndarray, ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Logits of windows of the words ``ids``, whose inputs are rows of ``gates``."""
    out, nothing = np.empty(len(start), np.float32), net.projected(np.zeros(2 * WIDTH, np.float32))
    for i in range(0, len(out), WINDOWS_AT_ONCE):
        places, mask = places_of(start[i : i + WINDOWS_AT_ONCE], size[i : i + WINDOWS_AT_ONCE])
        block = np.stack([np.take(gates, r, axis=0).T for r in ids[places]])
        # Behind the words of a short window nothing enters, as in training.
        step, window = np.nonzero(~mask)
        block[step, :, window] = nothing
        out[i : i + WINDOWS_AT_ONCE] = net.forward(block, mask)
    return out


class Words(dict):
    """Numbers of words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Scorer:
    """Scores texts; remembers the inputs of words it has seen."""

    def __init__(self, net: Network):
        self.net, self.known, self.gates = net, Words(), None

    def __call__(self, texts: list[str]) -> np.ndarray:
        if self.gates is None or len(self.known) > REMEMBERED:
            self.known, self.gates = Words(), np.empty((0, 6 * HIDDEN), np.float32)
        known = self.known
        known.new = new = []
        tokens = [t.split() or [""] for t in texts]
        ids = np.concatenate([np.fromiter(map(known.__getitem__, t), np.int32, len(t)) for t in tokens])
        made = [self.net.projected(self.net.inputs(*features(new[i : i + 20_000]))) for i in range(0, len(new), 20_000)]
        self.gates = np.concatenate([self.gates, *made])
        start, size, first = windows(np.array(list(map(len, tokens))))
        out = _forward(self.net, self.gates, ids, start, size)
        return _sigmoid(np.maximum.reduceat(out, first).astype(np.float64))


def shares(lengths: dict[int, list[int]], letters: int) -> dict[int, int]:
    """The longest text of each label that the sample takes whole.

    Each label has half of ``letters``, and what the other leaves of its half. Within a label
    the bound is as high as the sum of all texts, each up to the bound, allows.
    """
    total = {y: sum(n) for y, n in lengths.items()}
    out = {}
    for y, own in lengths.items():
        left = max(letters // 2, letters - (sum(total.values()) - total[y]))
        if total[y] <= left:
            out[y] = max(own, default=0)
            continue
        for i, n in enumerate(own := sorted(own)):
            if n * (len(own) - i) > left:
                out[y] = left // (len(own) - i)
                break
            left -= n
    return out


def sampled(text: str, letters: int) -> str:
    """Windows of a text, at random places in equal parts of it, of ``letters`` letters together.

    A window loses what it has of a word at its borders, unless it holds no blank.
    """
    if len(text) <= letters:
        return text
    n = max(1, letters // CUT_LETTERS)
    size, part = letters // n, len(text) // n
    r = np.random.default_rng(len(text))
    out = []
    for i, shift in enumerate(r.integers(0, part - size + 1, n).tolist()):
        lo = i * part + shift
        hi = lo + size
        words = text[lo:hi].split()
        if len(words) > 2:
            words = words[lo > 0 and not text[lo - 1].isspace() :]
            words = words[: len(words) - (hi < len(text) and not text[hi].isspace())]
        out.append(" ".join(words)[:size])
    return " ".join(out)[:letters]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(batch.num_rows):
            one = batch.slice(lo, 1)
            text = sampled(one.column(2)[0].as_py(), one.column(3)[0].as_py())
            yield pa.RecordBatch.from_arrays([*one.columns[:2], pa.array([text], pa.string())], names=["_id", "_y", "_t"])


def _teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    net = train((t.as_py(), y.as_py()) for batch in batches for y, t in zip(batch.column(1), batch.column(2), strict=True))
    for name, value in net.p.items() if net else ():
        row = [pa.array([name]), pa.array([value.shape], pa.list_(pa.int32())), pa.array([value.astype(np.float32).tobytes()])]
        yield pa.RecordBatch.from_arrays(row, names=["name", "shape", "value"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Network | None:
    """Train on labelled rows outside the held-out class; at most ``SAMPLE_DOCS`` documents of each label.

    Training is one task over that bounded sample. The sample is drawn by a hash of the identifier, so it is the same in every run and spread
    over the table. Rows without label, identifier or text teach nothing. A document with
    several labels has the largest. Of rows that repeat identifiers, ``SAMPLE_ROWS`` of each
    label teach, one of each identifier before others. Where the texts exceed
    ``SAMPLE_LETTERS``, every one still teaches: the longest of each label are cut to random
    windows, so no text takes the place of another.
    """
    known = labels.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_y")).where("_y is not null and _id is not null")
    learn = known.where(crc_class(F.col("_id"), FOLDS) != HELD_OUT)
    chosen = None
    for y in (0, 1):
        some = learn.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE_DOCS)
        chosen = some if chosen is None else chosen.union(some)
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_t")).join(F.broadcast(chosen), "_id").where("_t is not null")
    # As a table: what is counted here and what is read below are then the same rows.
    rows = stage(rows.withColumn("_row", F.monotonically_increasing_id()).withColumn("_h", F.xxhash64("_t")), "toxicity-sample")
    one = rows.groupBy("_id").agg(F.min(F.struct("_h", "_row")).alias("_one"))
    each = rows.select("_id", "_y", "_h", "_row", F.length("_t").alias("_n")).join(F.broadcast(one), "_id")
    lengths, taken = {}, []
    for y in (0, 1):
        order = [F.col("_row") != F.col("_one._row"), F.xxhash64("_id", "_h"), "_id", "_h", "_row"]
        some = each.where(F.col("_y") == y).orderBy(*order).limit(SAMPLE_ROWS).select("_row", "_n").collect()
        lengths[y] = [r._n for r in some]
        taken += [r._row for r in some]
    longest = shares(lengths, SAMPLE_LETTERS)
    numbers = F.broadcast(docs.sparkSession.createDataFrame([(n,) for n in taken], "_row long"))
    rows = rows.join(numbers, "_row", "left_semi").select("_id", "_y", "_t", F.when(F.col("_y") == 1, longest[1]).otherwise(longest[0]).alias("_n"))
    rows = rows.mapInArrow(_cut, rows.select("_id", "_y", "_t").schema)
    # One task trains, on the bounded sample only; its parameters come back.
    taught = rows.repartition(1).sortWithinPartitions(F.xxhash64("_id"), "_id", "_t").mapInArrow(_teach, "name string, shape array<int>, value binary")
    found = {r.name: np.frombuffer(bytes(r.value), np.float32).reshape(r.shape) for r in taught.collect()}
    if not found:
        return None
    net = Network.__new__(Network)
    net.p = found
    return net


def score(docs: DataFrame, net: Network | None, text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of every row with ``score``, from 0 to 1; a name ``score`` among them is an error.

    Null and empty texts are scored as a text without words; rows that repeat an identifier are
    scored each, and equal texts have equal scores. Without a network (one label
    only was known) every score is 0.
    """
    columns = docs.columns if columns is None else columns
    rows = docs.select(*(F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(columns)), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    if net is None:
        return rows.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)), F.lit(0.0).alias("score"))
    sent, name = docs.sparkSession.sparkContext.broadcast(net.p), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A worker keeps the scorer of one network, with the words it has seen.
        kept = worker_store("toxicity", dict)
        if kept.get("name") != name:
            own = Network.__new__(Network)
            own.p = sent.value
            kept |= {"name": name, "scorer": Scorer(own)}
        scorer = kept["scorer"]
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            out, lo, letters = [], 0, 0
            for hi, text in enumerate(texts, 1):
                letters += len(text)
                if letters >= CHUNK_LETTERS or hi == len(texts):
                    out.append(scorer(texts[lo:hi]))
                    lo, letters = hi, 0
            scores = pa.array(np.concatenate(out) if out else np.empty(0))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], scores], names=[*batch.schema.names[:-1], "score"])

    from pyspark.sql import types as T

    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema).toDF(*columns, "score")

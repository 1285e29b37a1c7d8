"""Two tokenizers' ids of the same texts, aligned where both cut.

Both tokenise the whole of a text. Where a token of each begins with a blank at the same byte, as
their byte lengths tell, lies an anchor; anchors cut the ids of a text into windows. How a window
falls into groups (between bytes where tokens of both end) depends on its ids alone, so a worker
works out each window once and remembers it: by the pair of both runs of ids, packed, and where
a unit of text is one window, by that text, which determines the ids and is met first.

How many documents hold a pair of ids linked is counted over the whole corpus. Documents are kept
in chunks of bounded size; a chunk's windows and the pairs in them are numbered within it. Pair
counts are summed by a shuffle of (chunk, pair), and only counts that other chunks have raised go
back to a chunk, so no table that grows is sent to all tasks.
"""

from __future__ import annotations

import os
import re
import string
from array import array
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docferry.llm.common import row_slices, stage, worker_store

#: Text whose pairs are numbered together, and text aligned at once.
CHUNK_BYTES, SLICE_BYTES = 8_000_000, 1_000_000
#: Windows that a worker carries on from chunk to chunk, with their units, and the most letters or ids of these.
REMEMBERED, LONGEST = 300_000, 64
#: Pairs of ids are one number: this many bits for the second id.
_BITS = 24
_BLANK_BEHIND_SPACE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= +[^ ])")

Runs = tuple[bytes, bytes]  # the ids of both tokenizers, 32 bits each


class Tokens:
    """Both tokenizers, and how many bytes each of their ids stands for."""

    def __init__(self, first: str, second: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task for each core
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(first)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=second)
        # The letter that stands for each byte in byte-level vocabularies.
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        spare = iter(range(256, 512))
        self.letters = {b: b if b in plain else next(spare) for b in range(256)}
        byte_of = {chr(c): b for b, c in self.letters.items()}
        a = [b""] * (max(self.first.get_vocab().values()) + 1)
        for token, i in self.first.get_vocab().items():
            a[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        b = []
        for i in range(self.second.get_piece_size()):
            piece = self.second.id_to_piece(i)
            b.append(bytes([int(piece[3:5], 16)]) if self.second.is_byte(i) else piece.replace("▁", " ").encode())
        self.bytes_of = (a, b)
        self.length_of = tuple(np.array(list(map(len, x)), np.int64) for x in (a, b))
        self.spaced = tuple(np.array([t[:1] == b" " for t in x]) for x in (a, b))

    def _first_ids(self, texts: list[str]) -> list[list[int]]:
        """The first tokenizer's ids of texts that begin with a blank.

        Letters behind the blank, and marks behind these, are one piece each to its splitter;
        such texts go to the library's model at once, others through the whole of the library.
        """
        model, out, others, letters = self.first.model.tokenize, [], [], self.letters
        for text in texts:
            core = text[1:]
            if not core.isalpha():
                core = core.rstrip(string.punctuation)
                if not core.isalpha():
                    others.append(text)
                    out.append(None)
                    continue
            ids = [t.id for t in model(f"Ġ{core}" if core.isascii() else f" {core}".encode().decode("latin-1").translate(letters))]
            if len(text) > len(core) + 1:
                ids += [t.id for t in model(text[len(core) + 1 :])]
            out.append(ids)
        found = iter(self.first.encode_batch_fast(others, add_special_tokens=False) if others else ())
        return [next(found).ids if x is None else x for x in out]

    def encode(self, texts: list[str]) -> tuple[list[Runs], np.ndarray]:
        """Both runs of ids of texts that begin with a blank, and whether both spell the text."""
        runs = (self._first_ids(texts), self.second.encode([t[1:] for t in texts], num_threads=1))
        data = [t.encode() for t in texts]
        sizes, packed, exact = np.array(list(map(len, data))), [], np.ones(len(texts), bool)
        for ids, of, length in zip(runs, self.bytes_of, self.length_of, strict=True):
            flat = array("I", chain.from_iterable(ids))
            ends = np.cumsum(list(map(len, ids)))
            spelt = np.diff(np.append(0, np.cumsum(length[np.frombuffer(flat, np.uint32)]))[np.append(0, ends)])
            if (spelt != sizes).any() or b"".join(map(of.__getitem__, flat)) != b"".join(data):
                exact &= [b"".join(map(of.__getitem__, x)) == d for x, d in zip(ids, data, strict=True)]
            flat, ends = flat.tobytes(), [0, *(4 * ends).tolist()]
            packed.append([flat[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)])
        return list(zip(*packed, strict=True)), exact


def units(text: str) -> list[str]:
    """A text cut before blanks that follow a letter or sign; blanks at the end stay with the last unit.

    Neither splitter joins across such a place, so the ids of a text are those of its units.
    """
    if text[-1] != " " and "\0" not in text and not _BLANK_BEHIND_SPACE.search(text):
        return text.replace(" ", "\0 ")[1:].split("\0")
    return _CUT.split(text)


def numbers(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, np.uint32)


class Groups:
    """Runs of ids between places where tokens of both end, for windows laid end to end."""

    def __init__(self, a: np.ndarray, b: np.ndarray, tokens: Tokens):
        self.a, self.b = a, b
        ends_a, ends_b = (np.cumsum(n[x]) for n, x in zip(tokens.length_of, (a, b), strict=True))
        self.ends, i, j = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        #: Where groups begin, and how many ids they have.
        self.at_a, self.at_b = np.append(0, i + 1), np.append(0, j + 1)
        self.n_a, self.n_b = np.diff(self.at_a), np.diff(self.at_b)

    def text(self) -> list[str]:
        a, b = list(map(str, self.a.tolist())), list(map(str, self.b.tolist()))
        places = zip(self.at_a[:-1].tolist(), self.at_a[1:].tolist(), self.at_b[:-1].tolist(), self.at_b[1:].tolist(), strict=True)
        return [f"{a[i]}|{b[k]}" if j - i == m - k == 1 else ",".join(a[i:j]) + "|" + ",".join(b[k:m]) for i, j, k, m in places]

    def links(self, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By owner (one of ``of`` for each group): the distinct pairs of ids that share a group, and how often each does."""
        size = self.n_a * self.n_b
        few = size <= LONGEST**2
        n, m = size[few], self.n_b[few]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        m = np.repeat(m, n)
        x = self.a[np.repeat(self.at_a[:-1][few], n) + step // m].astype(np.int64)
        y = self.b[np.repeat(self.at_b[:-1][few], n) + step % m]
        owner, codes, times = [np.repeat(of[few], n)], [x << _BITS | y], [np.ones(len(x), np.int64)]
        for g in np.flatnonzero(~few).tolist():
            # Ids that a large group repeats meet once, with the product of their numbers.
            (x, n), (y, m) = (np.unique(v[at[g] : at[g + 1]], return_counts=True) for v, at in ((self.a, self.at_a), (self.b, self.at_b)))
            codes.append(((x.astype(np.int64)[:, None] << _BITS) | y).ravel())
            times.append((n[:, None] * m).ravel())
            owner.append(np.full(len(codes[-1]), of[g]))
        owner, codes, times = map(np.concatenate, (owner, codes, times))
        order = np.lexsort((codes, owner))
        owner, codes = owner[order], codes[order]
        start = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (codes[1:] != codes[:-1])))
        return owner[start], codes[start], np.add.reduceat(times[order], start)


class Windows:
    """Windows by their ids, numbered as they are met, with what each holds."""

    def __init__(self):
        self.number: dict[tuple[bytes, bytes], int] = {}
        self.text: list[str] = []
        #: Ids of both kinds, groups and links of each window.
        self.sizes = np.empty((4, 0), np.int64)
        #: The pairs of all windows end to end, how often each, and where a window's pairs begin.
        self.codes, self.times, self.bounds = [np.empty(0, np.int64)], [np.empty(0, np.int64)], np.zeros(1, np.int64)

    def add(self, new: list[tuple[bytes, bytes]], tokens: Tokens):
        """Work out windows that have no number yet; they get the next ones."""
        a, b = (numbers(b"".join([w[k] for w in new])) for k in (0, 1))
        ends = np.cumsum([len(w[0]) // 4 for w in new])
        found = Groups(a, b, tokens)
        of = np.searchsorted(ends, found.at_a[:-1], "right")
        count = np.bincount(of, minlength=len(new))
        first = np.cumsum(count) - count
        parts = found.text()
        self.text += [parts[i] if n == 1 else ";".join(parts[i : i + n]) for i, n in zip(first.tolist(), count.tolist(), strict=True)]
        ids = [[len(w[k]) // 4 for w in new] for k in (0, 1)]
        self.sizes = np.concatenate((self.sizes, [*ids, count, np.add.reduceat(found.n_a * found.n_b, first)]), 1)
        owner, codes, times = found.links(of)
        self.codes.append(codes)
        self.times.append(times)
        self.bounds = np.append(self.bounds, self.bounds[-1] + np.cumsum(np.bincount(owner, minlength=len(new))))

    def keep(self, which: np.ndarray) -> np.ndarray:
        """Forget all windows but these; the new number of each old one, -1 for the others."""
        new = np.full(len(self.text), -1, np.int64)
        new[which] = np.arange(len(which))
        codes, times, n = self.pairs(which)
        self.codes, self.times, self.bounds = [codes], [times], np.append(0, np.cumsum(n))
        self.text, self.sizes = [self.text[w] for w in which.tolist()], self.sizes[:, which]
        places = new.tolist()
        self.number = {k: places[w] for k, w in self.number.items() if places[w] >= 0}
        return new

    def pairs(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs of these windows end to end, how often each, and the number of each window's."""
        self.codes, self.times = ([np.concatenate(x)] for x in (self.codes, self.times))
        n = self.bounds[which + 1] - self.bounds[which]
        at = np.arange(n.sum()) + np.repeat(self.bounds[which] - np.cumsum(n) + n, n)
        return self.codes[0][at], self.times[0][at], n


def _starts(ids: np.ndarray, length: np.ndarray, spaced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and bytes at which tokens that begin with a blank start."""
    n = length[ids]
    at = np.flatnonzero(spaced[ids])
    return at, (np.cumsum(n) - n)[at]


def windows_of(pairs: list[Runs], tokens: Tokens, known: Windows) -> list[tuple[int, ...]]:
    """Window numbers of each text, from the runs of ids that both spell it. The texts are distinct.

    All texts are one run of bytes, on which both tokenizers stay level. The ids of a window
    and its text determine each other, so a text that is one window has not been met before;
    windows of other texts are looked up by their ids.
    """
    if not pairs:
        return []
    x, y = (b"".join([p[k] for p in pairs]) for k in (0, 1))
    (at_a, byte_a), (at_b, byte_b) = (_starts(numbers(v), n, s) for v, n, s in zip((x, y), tokens.length_of, tokens.spaced, strict=True))
    _, i, j = np.intersect1d(byte_a, byte_b, assume_unique=True, return_indices=True)
    first = at_a[i]
    # Both runs of a text begin with a blank, so each text begins a window.
    begin = np.searchsorted(first, np.cumsum([0] + [len(p[0]) // 4 for p in pairs]))
    alone = np.diff(begin) == 1
    fresh = [p for p, one in zip(pairs, alone.tolist(), strict=True) if one]
    n = len(known.text)
    out = [(n,)] * len(pairs)
    for number, place in enumerate(np.flatnonzero(alone).tolist(), n):
        out[place] = (number,)
    a, b = [*(4 * first).tolist(), len(x)], [*(4 * at_b[j]).tolist(), len(y)]
    n += len(fresh)
    found: dict[Runs, int] = {}
    for place in np.flatnonzero(~alone).tolist():
        keys = [(x[a[k] : a[k + 1]], y[b[k] : b[k + 1]]) for k in range(begin[place], begin[place + 1])]
        for key in keys:
            if key not in known.number and key not in found:
                found[key] = n + len(found)
                fresh.append(key)
        out[place] = tuple([known.number[k] if k in known.number else found[k] for k in keys])
    if fresh:
        known.add(fresh, tokens)
        known.number.update((k, v) for k, v in found.items() if len(k[0]) + len(k[1]) <= 4 * LONGEST)
    return out


class Aligner:
    """Windows of texts. Units come again and again, so their windows are remembered too."""

    def __init__(self, tokens: Tokens):
        self.tokens, self.windows, self.used = tokens, Windows(), np.empty(0, np.int64)
        self.known: dict[str, tuple[int, ...]] = {}

    def rest(self, used: np.ndarray):
        """Behind a chunk, of which ``used`` counts the windows: when full, forget what came once, then the rarest."""
        self.used = _longer(self.used, used)
        if len(self.windows.text) <= REMEMBERED:
            return
        hot = np.flatnonzero(self.used > 1)
        if len(hot) > REMEMBERED // 2:
            hot = np.sort(hot[np.argsort(-self.used[hot], kind="stable")[: REMEMBERED // 2]])
        new, self.used = self.windows.keep(hot).tolist(), np.zeros(len(hot), np.int64)
        moved = ((u, tuple([new[w] for w in ws])) for u, ws in self.known.items() if ws)
        self.known = {u: ws for u, ws in moved if min(ws) >= 0}

    def __call__(self, texts: list[str]) -> list[np.ndarray | None]:
        """Window numbers of blank + text; None where there is no text or a tokenizer does not spell it."""
        cut, known = [units(f" {t}") if t else [] for t in texts], self.known
        missing = list(set().union(*cut).difference(known))
        for lo in range(0, len(missing), 10_000):
            some = missing[lo : lo + 10_000]
            pairs, exact = self.tokens.encode(some)
            if exact.all():
                known.update(zip(some, windows_of(pairs, self.tokens, self.windows), strict=True))
            else:
                known.update(dict.fromkeys(some, ()))
                spelt = np.flatnonzero(exact).tolist()
                known.update(zip([some[i] for i in spelt], windows_of([pairs[i] for i in spelt], self.tokens, self.windows), strict=True))
        found = [list(map(known.__getitem__, us)) for us in cut]
        for unit in [u for u in missing if len(u) > LONGEST]:
            del known[unit]
        return [np.fromiter(chain.from_iterable(f), np.int64) if f and all(f) else self._whole(t) for t, f in zip(texts, found, strict=True)]

    def _whole(self, text: str) -> np.ndarray | None:
        """A text with a unit that is not spelt alone: its bytes are compared as a whole."""
        pairs, exact = self.tokens.encode([f" {text}"]) if text else ([], [False])
        return np.array(windows_of(pairs, self.tokens, self.windows)[0], np.int64) if exact[0] else None


def _longer(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sum of two counts, of which one may be shorter."""
    out = np.zeros(max(len(a), len(b)), np.int64)
    out[: len(a)] += a
    out[: len(b)] += b
    return out


class _Chunk:
    """The windows and pairs of the texts of one chunk."""

    def __init__(self):
        self.size, self.rows, self.used = 0, [[], [], [], [], [], [], []], np.empty(0, np.int64)
        self.seen: list[np.ndarray] = []  # windows in the order of their numbers within the chunk
        self.local = np.empty(0, np.int32)  # and these numbers, by window
        self.codes: list[np.ndarray] = []

    def number(self, which: np.ndarray, known: Windows) -> np.ndarray:
        """Numbers of windows within the chunk."""
        self.local = np.append(self.local, np.full(len(known.text) - len(self.local), -1, np.int32))
        new = np.unique(which[self.local[which] < 0])
        self.local[new] = np.arange(len(new)) + sum(map(len, self.seen))
        self.seen.append(new)
        return self.local[which]

    def add(self, ids: pa.Array, texts: list[str], aligner: Aligner):
        found, known = aligner(texts), aligner.windows
        which = [f for f in found if f is not None]
        if which:
            n = list(map(len, which))
            self.used = _longer(self.used, np.bincount(np.concatenate(which)))
            which, text = np.concatenate(which), np.repeat(np.arange(len(which)), n)
            # Each document counts once for a pair.
            codes, _, pairs = known.pairs(which)
            both = np.unique(np.repeat(text << 2 * _BITS, pairs) | codes)
            self.codes.append(both & ((1 << 2 * _BITS) - 1))
            own, sizes = self.number(which, known), np.add.reduceat(known.sizes[:, which], np.cumsum(n) - n, axis=1).T.tolist()
            own = iter(np.split(own, np.cumsum(n)[:-1]))
            sizes = iter(sizes)
        for key, f in zip(ids.to_pylist(), found, strict=True):
            if f is None:
                row = (key, 0, 0, 0, 0, "", np.empty(0, np.int32))
            else:
                text = ";".join(map(known.text.__getitem__, f.tolist()))
                row = (key, *next(sizes), sha256(text.encode()).hexdigest(), next(own))
            for column, value in zip(self.rows, row, strict=True):
                column.append(value)

    def tables(self, known: Windows) -> list:
        """Codes of the chunk's pairs, documents that hold each, and for its windows the pairs (by place), how often, and where they end."""
        if not self.codes:
            return [[], [], [], [], []]
        codes, docs = np.unique(np.concatenate(self.codes), return_counts=True)
        mine, times, n = known.pairs(np.concatenate(self.seen))
        return [codes, docs, np.searchsorted(codes, mine), times, np.cumsum(n)]


_LISTS = {"codes": pa.int64(), "docs": pa.int64(), "pair": pa.int32(), "times": pa.int64(), "ends": pa.int32()}


def _aligned(first: str, second: str, chunk_bytes: int, slice_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_store(f"align:{first}:{second}", lambda: Tokens(first, second))
        # Of one task at a time; what it remembers changes no result.
        aligner = worker_store(f"aligner:{first}:{second}", lambda: Aligner(tokens))
        part, number, chunk, kind = TaskContext.get().partitionId() << 24, 0, _Chunk(), None

        def rows() -> pa.RecordBatch:
            n = len(chunk.rows[0])
            tables = zip(chunk.tables(aligner.windows), _LISTS.values(), strict=True)
            filled = [pa.array([None] * (n - 1) + [np.asarray(x, t.to_pandas_dtype())], pa.list_(t)) for x, t in tables]
            aligner.rest(chunk.used)
            kinds = [kind, *[pa.int64()] * 4, pa.string(), pa.list_(pa.int32())]
            columns = [pa.array(c, t) for c, t in zip(chunk.rows, kinds, strict=True)]
            names = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "windows", *_LISTS]
            return pa.RecordBatch.from_arrays([pa.array([part + number] * n), *columns, *filled], names=["chunk", *names])

        for batch in batches:
            kind = batch.column(0).type
            for lo, hi in row_slices(batch.column(1), slice_bytes):
                texts = [t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                chunk.add(batch.column(0).slice(lo, hi - lo), texts, aligner)
                chunk.size += sum(map(len, texts))
                if chunk.size >= chunk_bytes:
                    yield rows()
                    number, chunk = number + 1, _Chunk()
        if chunk.rows[0]:
            yield rows()

    return run


def _counted(best_of: np.ndarray):
    def run(key, docs: pa.Table, raised: pa.Table) -> pa.Table:
        at = int(np.flatnonzero(docs.column("codes").is_valid().to_numpy())[0])
        codes, count, pair, times, ends = (docs.column(c)[at].values.to_numpy().copy() for c in _LISTS)
        count[raised.column("at").to_numpy()] = raised.column("count").to_numpy()
        of_pair = count[pair] * times
        is_best = (count == best_of[codes >> _BITS])[pair] * times
        sums = []
        for values in (of_pair, is_best):
            running = np.concatenate(([0], np.cumsum(values)))[np.concatenate(([0], ends))]
            sums.append(np.diff(running))
        lists = docs.column("windows").combine_chunks()
        windows, bounds = lists.values.to_numpy(), lists.offsets.to_numpy()
        out = []
        for values in sums:
            running = np.concatenate(([0], np.cumsum(values[windows])))
            out.append(pa.array(running[bounds[1:]] - running[bounds[:-1]]))
        kept = [docs.column(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links")]
        return pa.table([*kept, out[1], out[0], docs.column("groups_sha256")], names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return run


def align(
    docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Tokens, groups and links of every row's text under two tokenizers.

    ``first`` is a byte-level vocabulary for tokenizers, given blank + text; ``second`` a
    sentencepiece model, which adds the blank. ``n_links`` counts pairs of token occurrences
    that share a group; ``count_sum`` adds up in how many rows of the table each link's pair of
    ids is linked, ``n_best`` counts the links whose pair is linked in as many rows as any pair
    of its first id. ``groups_sha256`` is the hash of all groups as text. Null and empty texts,
    and texts that either tokenizer does not spell byte for byte, have zeros and an empty hash.
    Rows that repeat an identifier count each. An empty table gives no rows; other columns are
    not looked at. Both files must be readable by every worker. ``chunk_bytes`` and
    ``slice_bytes`` bound what is numbered and handled at once and change no result.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    lists = ", ".join(f"{c} array<{'int' if t == pa.int32() else 'long'}>" for c, t in _LISTS.items())
    schema = f"chunk long, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, windows array<int>, {lists}"
    aligned = stage(rows.mapInArrow(_aligned(first, second, chunk_bytes, slice_bytes), schema), "align-chunks")
    found = aligned.where("codes is not null").select("chunk", F.posexplode(F.arrays_zip("codes", "docs")).alias("at", "p"))
    found = found.select("chunk", "at", F.col("p.codes").alias("code"), F.col("p.docs").alias("n"))
    counts = stage(found.groupBy("code").agg(F.sum("n").alias("count"), F.count("*").alias("chunks")), "align-counts")
    # One number for each id of the first vocabulary.
    best = counts.groupBy(F.shiftright("code", _BITS).alias("a")).agg(F.max("count").alias("n")).collect()
    best_of = np.zeros(max((r.a for r in best), default=0) + 1, np.int64)
    for row in best:
        best_of[row.a] = row.n
    raised = found.join(counts.where("chunks > 1").select("code", "count"), "code").where("count > n")
    raised = raised.select(F.col("chunk").alias("of"), "at", "count")
    out = f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    done = aligned.groupBy("chunk").cogroup(raised.groupBy("of")).applyInArrow(_counted(best_of), out)
    return done.withColumnRenamed("id", id_col)


def spans(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The groups themselves: ``place`` (from 0), the bytes ``start`` to ``end`` of blank + text, and both lists of ids.

    Texts without tokens, as ``align`` tells, give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_store(f"align:{first}:{second}", lambda: Tokens(first, second))
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                pairs, exact = tokens.encode([f" {text}"]) if text else ([], [False])
                if not exact[0]:
                    continue
                part = Groups(*map(numbers, pairs[0]), tokens)
                n, ends = len(part.ends), part.ends
                lists = [pa.ListArray.from_arrays(at.astype(np.int32), x.astype(np.int32)) for at, x in ((part.at_a, part.a), (part.at_b, part.b))]
                arrays = [pa.array([key] * n, batch.column(0).type), pa.array(np.arange(n)), pa.array(np.append(0, ends[:-1])), pa.array(ends)]
                yield pa.RecordBatch.from_arrays([*arrays, *lists], names=["id", "place", "start", "end", "first", "second"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, place long, start long, end long, first array<int>, second array<int>").withColumnRenamed("id", id_col)

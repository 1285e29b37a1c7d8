"""The trained models against forms written out step by step."""

from __future__ import annotations

import math
import zlib
from collections import defaultdict

import numpy as np

from docferry.llm import ctw, toxicity


def context_tree_scores(texts, learned, depth=ctw.DEPTH):
    """log10 probability of each text and its end by the recursion over all nodes, bit by bit."""
    visits = defaultdict(lambda: [0, 0])

    def places(text):
        data = bytes([ctw.BEFORE]) * depth + text + bytes([ctw.END])
        for at in range(depth, len(data)):
            for b in range(8):
                bits, bit = data[at] >> (8 - b) | 1 << b, data[at] >> (7 - b) & 1
                yield [(d, data[at - d : at], bits) for d in range(depth + 1)], bit

    for text, learn in zip(texts, learned, strict=True):
        for nodes, bit in places(text):
            for node in nodes:
                visits[node][bit] += learn
    children = defaultdict(set)
    for d, context, bits in visits:
        if d:
            children[d - 1, context[1:], bits].add((d, context, bits))

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    weighted: dict = {}
    for node in sorted(visits, key=lambda n: -n[0]):
        own = kt(*visits[node])
        weighted[node] = own if node[0] == depth else math.log(0.5) + float(np.logaddexp(own, sum(weighted[c] for c in children[node])))
    for text in texts:
        total = 0.0
        for nodes, bit in places(text):
            one = None
            for node in reversed(nodes):
                zeros, ones = visits[node]
                own = (ones + 0.5) / (zeros + ones + 1)
                w = 1 if node[0] == depth else math.exp(math.log(0.5) + kt(zeros, ones) - weighted[node])
                one = own if one is None else w * own + (1 - w) * one
            total += math.log10(one if bit else 1 - one)
        yield total


def test_context_tree_scores(spark):
    """Whole scores, with borders of chunks and blocks within the table."""
    r = np.random.default_rng(4)
    words = ["tree", "über", "context", "KT", "a", "weighting,", "\n", "東京"]
    given = [(i, " ".join(r.choice(words, r.integers(0, 30)))) for i in range(40)] + [(40, None), (41, ""), (42, "x" * 300), (7, "again"), (None, "no id")]
    texts = [(t or "").encode().lower() for _, t in given]
    learned = [zlib.crc32(("" if i is None else str(i)).encode()) % ctw.FOLDS != ctw.HELD_OUT for i, _ in given]
    want = sorted(zip([repr(i) for i, _ in given], context_tree_scores(texts, learned), strict=True))
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    for sizes in ({}, {"chunk_bytes": 600, "block_bytes": 150}):
        got = sorted((repr(x.doc_id), x.score) for x in ctw.score(docs, **sizes).collect())
        assert [k for k, _ in got] == [k for k, _ in want]
        assert np.allclose([s for _, s in got], [s for _, s in want], rtol=1e-9, atol=0)


def plain_score(net, text):
    """The network word by word and window by window, as its definition reads."""
    p, h = {k: v.astype(np.float64) for k, v in net.p.items()}, toxicity.HIDDEN
    words = text.split() or [""]

    def soft(x):
        return x / (1 + np.abs(x))

    def enter(word):
        rows, grams, _ = toxicity.features([word])
        used = [g for g in grams.ravel() if g > 0]
        letters = sum((p["grams"][g] for g in used), np.zeros(toxicity.WIDTH)) / math.sqrt(max(1, len(used)))
        return np.concatenate((p["words"][rows[0]], letters))

    worst = -math.inf
    for begin in range(0, max(1, len(words) - toxicity.SPAN + toxicity.STRIDE), toxicity.STRIDE):
        window = words[begin : begin + toxicity.SPAN]
        padded = [enter(w) for w in window]
        states = {}
        for side, order in (("f", range(len(padded))), ("b", range(len(padded) - 1, -1, -1))):
            state = np.zeros(h)
            if side == "b":
                for _ in range(toxicity.SPAN - len(padded)):  # nothing enters behind a short window's words
                    state = step(p, side, np.zeros(2 * toxicity.WIDTH), state, soft)
            for t in order:
                state = step(p, side, padded[t], state, soft)
                states[side, t] = state
        both = [np.concatenate((states["f", t], states["b", t])) for t in range(len(padded))]
        focus = np.array([p["focus"] @ soft(p["attend"].T @ s) for s in both])
        weight = np.exp(focus - focus.max())
        pooled = sum(w * s for w, s in zip(weight / weight.sum(), both, strict=True))
        worst = max(worst, float(p["out"] @ pooled + p["bias"][0]))
    return 1 / (1 + math.exp(-worst))


def step(p, side, x, state, soft):
    h = toxicity.HIDDEN
    given, back = x @ p[f"in_{side}"] + p[f"base_{side}"], state @ p[f"back_{side}"]
    z, r = (0.5 + 0.5 * soft(given[i : i + h] + back[i : i + h]) for i in (0, h))
    new = soft(given[2 * h :] + r * back[2 * h :])
    return new + z * (state - new)


def test_scorer_word_by_word():
    """Remembered words, windows and blocks give what the network gives word by word."""
    net, r = toxicity.Network(5), np.random.default_rng(6)
    for k in net.p:
        net.p[k] = (net.p[k] * 3).astype(np.float32)
    net.p["grams"][0] = 0  # the row of no gram, as training leaves it
    words = [f"w{i}" for i in range(50)] + ["Été!", "don't", "東京", "x" * 40]
    texts = [" ".join(r.choice(words, n)) for n in (1, 3, 15, 16, 17, 23, 24, 25, 40, 200)] + ["", "  \n "]
    want = [plain_score(net, t) for t in texts]
    assert np.allclose(toxicity.Scorer(net)(texts), want, atol=2e-5)
    scorer = toxicity.Scorer(net)
    assert np.allclose([float(scorer([t])[0]) for t in texts], want, atol=2e-5)

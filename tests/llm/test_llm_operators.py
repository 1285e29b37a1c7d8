"""Each operator against a plain form on small rows, empty tables and clashing column names."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docferry.llm import crosspoly, ctw, exact, minhash, mixing, packing, sharding, tokens, toxicity, warc
from docferry.llm.queries import vocabulary

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def rows(df):
    return [tuple(r) for r in df.collect()]


def low(text):
    return (text or "").encode().lower()


def named(docs):
    """The same rows with columns whose names the operators use inside."""
    extra = {c: docs["source"] for c in ("part", "rep", "id", "comp", "digest", "size", "target", "place", "n", "chunk", "keep_id", "run", "edge")}
    return docs.withColumns(extra)


def test_exact(docs, nothing):
    groups = defaultdict(list)
    for r in docs.collect():
        groups[low(r.text)].append(r.doc_id)
    want = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        ids.sort(key=lambda i: -1 if i is None else i, reverse=True)
        want += [(i, keep, len(ids), k == 0, hashlib.sha256(text).hexdigest()) for k, i in enumerate(ids)]
    got = rows(exact.exact_groups(named(docs)))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = exact.drop_exact(named(docs))
    assert kept.columns == named(docs).columns and kept.count() == len(groups)
    assert exact.exact_groups(nothing).count() == 0


def test_exact_group_over_many_tasks(spark):
    many = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN concat('t', id) ELSE 'Same' END AS text").repartition(8)
    got = exact.exact_groups(many).where("group_size > 1")
    assert got.select("keep_id", "group_size").distinct().collect() == [(2999, 2000)]
    assert got.where("kept").count() == 1


def near_brute(texts, n):
    sets = []
    for t in texts:
        w = WORDS.findall(low(t))
        sets.append({tuple(w)} if 0 < len(w) < n else set(zip(*(w[i:] for i in range(n)), strict=False)))
    link = list(range(len(sets)))

    def root(i):
        while link[i] != i:
            i = link[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and 100 * common >= 80 * (len(a) + len(sets[j]) - common):
                link[max(root(i), root(j))] = min(root(i), root(j))
    return [len(s) for s in sets], [root(i) for i in range(len(sets))]


@pytest.mark.parametrize("n", [2, 5])
def test_near(docs, nothing, n):
    given = docs.where("doc_id is not null").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    sizes, roots = near_brute([r.text for r in given], n)
    want = sorted((r.doc_id, s, given[k].doc_id, given[k].doc_id == r.doc_id) for r, s, k in zip(given, sizes, roots, strict=True))
    got = sorted(rows(minhash.near_groups(named(docs).where("doc_id is not null"), words=n).distinct()))
    assert got == want
    assert minhash.near_groups(nothing).count() == 0


def test_near_null_ids(spark):
    """Of near copies without an id one is kept; texts without words are kept each."""
    text = " ".join(f"w{i}" for i in range(100))
    given = [(None, text), (None, text + " end"), (None, text), (None, ""), (None, None), (3, "other words"), (3, "OTHER words")]
    got = minhash.near_groups(spark.createDataFrame(given, "doc_id long, text string").repartition(3), words=2).collect()
    assert sorted((r.doc_id is None, r.n_shingles > 0, r.kept) for r in got) == sorted(
        [(True, True, True), (True, True, False), (True, True, False), (True, False, True), (True, False, True), (False, True, True), (False, True, True)]
    )


def test_near_group_of_copies(spark):
    r = np.random.default_rng(5)
    base = [f"w{i}" for i in r.integers(0, 5000, 120)]
    texts = [" ".join(base)]
    for _ in range(150):
        copy = list(base)
        for at in r.choice(120, r.integers(1, 9), replace=False):
            copy[at] = f"x{r.integers(0, 60)}"
        texts.append(" ".join(copy))
    texts += [" ".join(f"v{i}" for i in r.integers(0, 5000, 80)) for _ in range(60)]
    order = r.permutation(len(texts))
    given = [texts[i] for i in order]
    _, roots = near_brute(given, 2)
    got = minhash.near_groups(spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").repartition(5), words=2)
    assert {r.doc_id: r.component_id for r in got.collect()} == dict(enumerate(roots))


def test_pack(docs, nothing):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    got = packing.pack(named(docs), vocabulary("word_bpe_49k.json"), window=64).collect()
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4"))
    for r in got:
        assert r.doc_tokens == len(texts[r.doc_id][0])
        piece = texts[r.doc_id][0][r.start : r.start + r.length].tobytes()
        assert bytes(r.ids) == piece and r.ids_crc32 == zlib.crc32(piece)
    places = sorted((r.sequence_id * 64 + r.offset, r.length) for r in got)
    assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:], strict=False))
    assert all(r.offset + r.length <= 64 for r in got)
    assert sum(r.length for r in got) == sum(len(x) for ids in texts.values() for x in ids)
    assert packing.pack(nothing, vocabulary("word_bpe_49k.json")).count() == 0


def test_pack_letters():
    """Every letter below U+0250, and letters above that lose a mark, as the library gives them."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    words = packing.WordIds(vocabulary("word_bpe_49k.json"))
    for x in [*filter(str.isalpha, map(chr, range(0x250))), "\ufb1d", "\u1e9e", "\u212b", "\u0958"]:
        for text in (x, f"a{x}b", f"{x}stanbul", f"{x}.", f"a{x},", f"{x}{x}. a{x}"):
            ids = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            assert words.encode(text) == ids, (hex(ord(x)), text)


def test_tokens(docs, nothing):
    import sentencepiece

    model = vocabulary("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    want = sorted(((r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in docs.collect()), key=repr)
    assert sorted(rows(tokens.count_tokens(named(docs), model)), key=repr) == want
    assert tokens.count_tokens(nothing, model).count() == 0
    for text in ("", " ", "  ", "a ", " a", "a  b", "a\n\nb  ", "  a b   c", "▁ ▁a", "\x00 \t"):
        assert sum(len(library.encode(t)) for t in tokens.split_text(text)) == len(library.encode(text)), repr(text)


def test_mix(docs, nothing):
    got = mixing.mix(named(docs)).collect()
    again = mixing.mix(named(docs).repartition(3)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again)) and len(got) == docs.count()
    size = Counter()
    for r in docs.collect():
        size[r.source] += len(WORDS.findall(low(r.text)))
    names = sorted(s for s in size if s is not None) + [None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    target, open_ = dict.fromkeys(names, 0.0), set(names)
    rest = float(sum(size.values()))
    while rest > 1e-9 and open_:
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        rest = 0.0
        for s in list(open_):
            target[s] += share[s]
            if target[s] >= 3 * size[s]:
                rest += target[s] - 3 * size[s]
                target[s] = 3.0 * size[s]
                open_.discard(s)
    taken, wanted = Counter(), {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.target] += r.taken
    for s in names:
        wanted[round(target[s], 6)] = size[s]
    for t, n in taken.items():
        assert round(t, 6) in wanted and abs(n - t) <= 1, (t, n)
    assert mixing.mix(nothing).count() == 0
    kept = mixing.take_rows(named(docs).dropDuplicates(["doc_id"]))
    assert kept.columns == named(docs).columns and kept.count() > 0


def test_shards(spark, docs, nothing):
    for df, limit in ((named(docs), 100), (spark.range(500).selectExpr("id % 2 AS doc_id", "'0123456789' AS text"), 300)):
        got = sharding.shards(df, limit=limit).collect()
        assert len(got) == df.count()
        shards = defaultdict(list)
        for r in got:
            shards[r.depth, r.prefix, r.piece].append(r)
        for members in shards.values():
            assert {(r.shard_bytes, r.shard_rows) for r in members} == {(sum(r.n_bytes for r in members), len(members))}
            assert members[0].shard_bytes <= limit or len(members) == 1
    assert sharding.shards(nothing).count() == 0


def test_shards_of_repeated_ids_keep_the_limit(spark):
    """Sizes that do not divide the limit, and rows above it among others, under one id and under null."""
    sizes = [90, 90, 90, 250, 7, 33, 50, 51, 90, 100, 101, 1, 0, 49, 49] * 4
    given = [(key, "x" * n) for n in sizes for key in (1, None)]
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    got = sharding.shards(df, limit=100).collect()
    shards = defaultdict(list)
    for r in got:
        shards[r.depth, r.prefix, r.piece].append(r.n_bytes)
        assert r.shard_bytes <= 100 or r.shard_rows == 1
    assert sorted(n for s in shards.values() for n in s) == sorted(2 * sizes)
    assert all({(r.shard_bytes, r.shard_rows)} == {(sum(s), len(s))} for r in got for s in [shards[r.depth, r.prefix, r.piece]])
    for prefix in {r.prefix for r in got}:
        pieces = {r.piece for r in got if r.prefix == prefix}
        assert pieces == set(range(len(pieces)))


def test_search(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(600, 24))
    x[5], x[7], x[11] = x[3], x[3] * 2, 0
    given = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    given += [(600, None), (601, [float("nan")] * 24), (602, []), (603, [1.0, None]), (None, [1.0] * 24), (650, [1.0, 0.0]), (651, [1.0, 1.0])]
    vectors = spark.createDataFrame(given, "vec_id long, embedding array<double>").repartition(4)
    got = crosspoly.search(vectors, vectors.where("vec_id % 50 == 0")).collect()
    unit = np.where((n := np.linalg.norm(x, axis=1))[:, None] > 0, x / np.where(n, n, 1)[:, None], 0)
    hits = 0
    for q in range(0, 600, 50):
        s = unit @ unit[q]
        s[q], s[11] = -2, -2
        best = np.lexsort((np.arange(600), -np.round(s, 12)))[:5]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        assert all(abs(s[v] - score) < 1e-12 for _, v, score in mine)
        hits += len({v for _, v, _ in mine} & set(best))
    assert hits >= 0.9 * 60
    # Another length has one candidate only.
    assert [(r.vec_id, round(r.score, 12)) for r in got if r.query_id == 650] == [(651, round(math.sqrt(0.5), 12))]
    assert crosspoly.search(vectors.limit(0), vectors.limit(0)).count() == 0


def test_search_one_common_vector(spark):
    same = spark.range(9000).selectExpr("id AS vec_id", "array(1.0D, 2.0D, 3.0D) AS embedding")
    got = crosspoly.search(same, same.where("vec_id = 0")).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [1, 2, 3, 4, 5] and all(abs(r.score - 1) < 1e-15 for r in got)


def test_search_repeated_nearest(spark):
    """An id with more rows than neighbours asked for is one neighbour; the others stay."""
    given = [(0, [1.0, 0.0, 0.0])] + [(7, [1.0, 0.001 * i, 0.0]) for i in range(9)] + [(i, [1.0, 0.1 * i, 0.0]) for i in range(1, 7)]
    vectors = spark.createDataFrame(given, "vec_id long, embedding array<double>").repartition(3)
    got = crosspoly.search(vectors, vectors.where("vec_id = 0")).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [7, 1, 2, 3, 4] and got[0].score == 1
    assert math.isclose(got[1].score, 1 / math.hypot(1, 0.1))


def test_archives(spark, tmp_path):
    big, small = "é" * 800, "x" * 10
    given = [(1, "http://A.example.com/x?q=1#f", big), (2, "https://b.example.com:8080/", big), (3, None, small), (4, "bad url\n", small),
             (5, "http://a.example.com/x?q=1", None), (6, "http://[bad", big), (7, "", big[:-1]), (None, "http://a.example.com/", "y" * 2000)]
    pages = spark.createDataFrame(given, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r for r in warc.round_trip(pages, f"{tmp_path}/w").collect()}
    assert len(got) == len(given)
    for page, _, html in given:
        data, r = (html or "").encode(), got[page]
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", 6) if page in (1, 2) else ("response", None))
    assert warc.url_key("http://www.Example.com:80/a?b#c") == "com,example,www:80)/a?b"
    assert warc.round_trip(pages.limit(0), f"{tmp_path}/e").count() == 0


def test_context_tree(docs, nothing):
    given = docs.collect()
    got = ctw.score(named(docs)).collect()
    learn = [low(r.text) for r in given if zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 7 != 2]
    count = Counter(w for t in learn for w in WORDS.findall(t))
    n, v = sum(count.values()) + len(learn), len(count) + 1
    for r in got:
        text = next(low(x.text) for x in given if x.doc_id == r.doc_id)
        words = WORDS.findall(text)
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words) + math.log10((len(learn) + 1) / (n + v + 1))
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.n_tokens == len(words) + 1
        assert r.n_known == sum(w in count for w in words) + 1 and r.train_tokens == n
        assert r.score < 0
    assert ctw.score(nothing).count() == 0


def test_context_tree_weights():
    """Against the recursion written out for every node, bit by bit."""
    texts, depth = [b"abracadabra", b"abba", b""], 2
    grams, n = ctw._counted(ctw.grams_of(texts, depth))
    visits = defaultdict(lambda: [0, 0])
    for g, c in zip(grams.tolist(), n.tolist(), strict=True):
        for b in range(8):
            for d in range(depth + 1):
                visits[d, (g >> 8) & ((1 << 8 * d) - 1), (g & 255) >> (8 - b) | 1 << b][(g >> (7 - b)) & 1] += c

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(d, context, bits):
        own = kt(*visits[d, context, bits])
        if d == depth:
            return own
        below = sum(weighted(*k) for k in list(visits) if k[0] == d + 1 and k[2] == bits and k[1] & ((1 << 8 * d) - 1) == context)
        return math.log(0.5) + np.logaddexp(own, below)

    p, _ = ctw.predictions(grams, n, 0, depth)
    for i, g in enumerate(grams.tolist()):
        for b in (0, 3, 7):
            bits = (g & 255) >> (8 - b) | 1 << b
            one = None
            for d in range(depth, -1, -1):
                key = d, (g >> 8) & ((1 << 8 * d) - 1), bits
                zeros, ones = visits[key]
                own = (ones + 0.5) / (zeros + ones + 1)
                w = 1 if d == depth else math.exp(math.log(0.5) + kt(zeros, ones) - weighted(*key))
                one = own if one is None else w * own + (1 - w) * one
            assert math.isclose(p[b][i], one, rel_tol=1e-9)


def test_toxicity(spark, docs, nothing):
    r = np.random.default_rng(0)
    good = ["calm", "river", "stone", "light", "green", "paper", "window", "bread"]
    given = []
    for i in range(400):
        words = list(r.choice(good, 60))
        if i % 4 == 0:
            words[r.integers(0, 60)] = r.choice(["vile", "nasty", "rotten"])
        given.append((i, " ".join(words), int(i % 4 == 0)))
    table = spark.createDataFrame(given, "doc_id long, text string, toxic int")
    net = toxicity.fit(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    got = {r.doc_id: r.score for r in toxicity.score(table, net).collect()}
    held = [(got[i], y) for i, _, y in given if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((s >= toxicity.THRESHOLD) == (y == 1) for s, y in held) >= 0.95 * len(held)
    odd = toxicity.score(named(docs), net)
    assert odd.count() == docs.count() and odd.where("score between 0 and 1").count() == docs.count()
    assert toxicity.fit(docs, table.select("doc_id", "toxic").limit(0)) is None
    assert toxicity.score(docs, None).where("score = 0").count() == docs.count()
    assert toxicity.score(nothing, net).count() == 0


def test_toxicity_long_text_first(spark):
    """A labelled text longer than the whole sample takes no other row's place."""
    order = spark.range(400).selectExpr("id", "crc32(cast(cast(id AS string) AS binary)) % 4 AS c").where("c <> 2").orderBy(F.xxhash64("id"), "id")
    first, *others = [r.id for r in order.collect()]
    for long_label in (0, 1):
        given = [(i, f"calm river stone light {'vile' if i % 4 == 0 else 'green'} paper window bread", int(i % 4 == 0)) for i in others]
        table = spark.createDataFrame(given, "doc_id long, text string, toxic int")
        long = spark.range(1).selectExpr(f"{first}L AS doc_id", "repeat('calm stone ', 2300000) AS text", f"{long_label} AS toxic")
        table = table.unionByName(long)
        net = toxicity.fit(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
        assert net is not None
        asked = spark.createDataFrame(given, "doc_id long, text string, toxic int")
        got = toxicity.score(asked, net).collect()
        assert sum((r.score >= toxicity.THRESHOLD) == (r.toxic == 1) for r in got) >= 0.95 * len(got), long_label


def test_toxicity_shares():
    assert toxicity.shares({0: [5, 9], 1: [7]}, 100) == {0: 9, 1: 7}
    assert toxicity.shares({0: [1000, 10, 20], 1: [7]}, 100) == {0: 63, 1: 7}
    assert toxicity.shares({0: [1000, 1000], 1: [300]}, 100) == {0: 25, 1: 50}
    assert toxicity.shares({0: [], 1: [300]}, 100) == {0: 0, 1: 100}
    text = " ".join(f"w{i}" for i in range(100_000))
    cut = toxicity.sampled(text, 50_000)
    assert 40_000 < len(cut) <= 50_000 and set(cut.split()) <= set(text.split())
    numbers = [int(w[1:]) for w in cut.split()]
    assert numbers == sorted(numbers) and numbers[0] < 8_000 and numbers[-1] > 92_000
    assert toxicity.sampled(text, len(text)) == text and len(toxicity.sampled("x" * 99, 10)) == 10


def test_gradients():
    net, r = toxicity.Network(), np.random.default_rng(1)
    for k, v in net.p.items():
        net.p[k] = v.astype(np.float64)
    x, y = r.normal(size=(toxicity.SPAN, 3, 2 * toxicity.WIDTH)), np.array([0, 1, 1])
    mask = np.ones((toxicity.SPAN, 3), bool)
    mask[10:, 1] = False

    def loss():
        z = net.forward(net.projected(x).transpose(0, 2, 1), mask)
        return np.mean(np.log1p(np.exp(z)) - y * z)

    g, dx = net.gradients(x, mask, y)
    for name in ("in_f", "back_b", "base_f", "attend", "focus", "out", "bias"):
        at = tuple(r.integers(0, s) for s in net.p[name].shape)
        net.p[name][at] += 1e-3
        up = loss()
        net.p[name][at] -= 2e-3
        down = loss()
        net.p[name][at] += 1e-3
        assert math.isclose((up - down) / 2e-3, g[name][at], rel_tol=0.02, abs_tol=2e-4), name

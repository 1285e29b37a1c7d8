"""Language, alignment and resampling against plain forms, with odd rows and clashing names."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docferry.llm import alignment, langid, resampling
from docferry.llm.common import row_slices
from docferry.llm.queries import QUERIES, vocabulary

SF = "/root/testdata/sf0.001"
FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def same(got, want):
    return sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)


def clashing(docs):
    names = ("id", "n", "chunk", "lang_pred", "score", "weight", "rank", "row_index", "h", "at", "place", "codes", "held_out", "bucket", "_place")
    return docs.withColumns({c: docs["source"] for c in names})


# Resampling ------------------------------------------------------------------------------


def resampled(docs, target, least=20, percent=5):
    words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def features(text):
        w = words.findall(low(text))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    found = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for _, _, f in found for b in f), Counter(b for x in target for b in features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in s}
    out = []
    for i, n, f in found:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, n])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    for place, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = place
    return [r[:5] for r in out]


def test_resampling_query(spark):
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet").collect()
    want = resampled([(r.doc_id, r.text) for r in read("documents")], [r.text for r in read("benchmark")])
    assert same(QUERIES["op13_resampling"](spark, SF).collect(), want)


def test_resampling_odd_rows(spark, docs, nothing):
    target = spark.createDataFrame([("quick brown FOX",), (None,), ("",), ("東京 タワー",)], "text string")
    given = [(r.doc_id, r.text) for r in docs.collect()]
    want = resampled(given, [r.text for r in target.collect()], least=1, percent=50)
    got = resampling.resample(clashing(docs), target.withColumn("n", F.lit(1)), least_words=1, percent=50).collect()
    # Equal rows are ranked in any order.
    assert same([r[:4] for r in got], [r[:4] for r in want])
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, sum(r[4] is not None for r in want) + 1))
    assert {(r.doc_id, r["rank"]) for r in got if r.doc_id != 8} == {(r[0], r[4]) for r in want if r[0] != 8}
    assert resampling.resample(nothing, target).count() == 0
    assert resampling.resample(docs, target.limit(0)).where("rank is not null").count() == 0  # too few rows of 20 words


def test_resampling_ties_and_copies(spark):
    """A hot identifier and text: every draw has its own rank, and smaller identifiers go first among equals."""
    rows = [(7, "a b c " * 10)] * 300 + [(i, "a b c " * 10) for i in range(100)]
    got = resampling.resample(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), spark.createDataFrame([("a b",)], "text string")).collect()
    want = resampled(rows, ["a b"])
    assert sorted(((r["rank"], r.doc_id) for r in got if r["rank"])) == sorted((r[4], r[0]) for r in want if r[4])


def test_grams_of_slices():
    """Slices of a column far from its start, with letters beyond ASCII, give what their texts give alone."""
    texts = [f"É{i} très GROß x{i % 7}" * 40 for i in range(2_000)] + [None, "", "." * 50]
    column = pa.array(texts)
    parts = list(row_slices(column, 50_000))
    assert parts[0][0] == 0 and parts[-1][1] == len(texts) and all(a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False))
    gain = np.arange(resampling.BUCKETS)
    for lo, hi in parts[-3:]:
        grams, alone = resampling.Grams(column.slice(lo, hi - lo)), resampling.Grams(pa.array(texts[lo:hi]))
        assert grams.lengths.tolist() == alone.lengths.tolist()
        assert grams.weights(gain).tolist() == alone.weights(gain).tolist()
        sums = [sum(zlib.crc32(" ".join(w[i : i + n]).encode()) % resampling.BUCKETS for n in (1, 2, 3) for i in range(len(w) - n + 1))
                for w in (re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t)) for t in texts[lo:hi])]
        assert grams.weights(gain).tolist() == sums


# Alignment -------------------------------------------------------------------------------

ODD = [
    "a", " ", "  ", "word ", " word", "two  blanks", "tab\tand\nline \n end\n", "it's John's 3,000 €", "été É straße 東京  タワー", "<|endoftext|> <s> </s> <unk>",
    "▁sign", "a▁b", " no break", " em x", "x​y", "😀😀 👩‍👩‍👧 z", "\x00\x01 nul", "à combining", "ﬁ ligature Ａ", "trailing　", "\r\n\r\n x", "'s 't 're",
    "a" * 300, "é" * 200, "1234567890" * 30, "\x1c a \x85 b", "ab  \n  cd   ", "İstanbul ǅ", "𝒳𝒴 𐍈", "�", "<0x41> x", "…—“q”", "x ▁", " ▁ ",
]


def aligned(docs):
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(vocabulary(FIRST))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=vocabulary(SECOND))
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    byte_of = {chr(b if b in plain else next(spare)): b for b in range(256)}

    def bytes_b(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()

    count, found = Counter(), []
    for key, text in docs:
        whole = f" {text}"
        a = first.encode(whole, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        data_a, data_b = [bytes(byte_of[c] for c in first.id_to_token(i)) for i in a], [bytes_b(i) for i in b]
        if not text or b"".join(data_a) != whole.encode() or b"".join(data_b) != whole.encode():
            found.append((key, None))
            continue
        ends_a, ends_b = ([sum(map(len, d[: i + 1])) for i in range(len(d))] for d in (data_a, data_b))
        groups, done = [], (0, 0)
        for end in sorted(set(ends_a) & set(ends_b)):
            to = (ends_a.index(end) + 1, ends_b.index(end) + 1)
            groups.append((a[done[0] : to[0]], b[done[1] : to[1]]))
            done = to
        links = Counter((x, y) for p, q in groups for x in p for y in q)
        count.update(links.keys())
        found.append((key, (a, b, groups, links)))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    for key, f in found:
        if f is None:
            yield key, 0, 0, 0, 0, 0, 0, ""
            continue
        a, b, groups, links = f
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        n_best = sum(n for k, n in links.items() if count[k] == best[k[0]])
        yield key, len(a), len(b), len(groups), sum(links.values()), n_best, sum(n * count[k] for k, n in links.items()), hashlib.sha256(text.encode()).hexdigest()


def test_alignment_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    assert same(QUERIES["op12_alignment"](spark, SF).collect(), aligned(docs))


def test_alignment_odd_rows(spark, docs, nothing, monkeypatch):
    given = [(r.doc_id, (r.text or None) and r.text[:3000]) for r in docs.collect()] + [(100 + i, t) for i, t in enumerate(ODD)] + [(100, "a")]
    table = spark.createDataFrame([(*r, "s") for r in given], "doc_id long, text string, source string").repartition(3)
    got = alignment.align(clashing(table), vocabulary(FIRST), vocabulary(SECOND)).collect()
    assert same(got, aligned(given))
    assert alignment.align(nothing, vocabulary(FIRST), vocabulary(SECOND)).count() == 0
    groups = alignment.spans(clashing(table), vocabulary(FIRST), vocabulary(SECOND))
    per = {r.doc_id: (r.n, r.e, r.s) for r in groups.where("doc_id > 100").groupBy("doc_id").agg(F.count("*").alias("n"), F.max("end").alias("e"), F.sum(F.expr("end - start")).alias("s")).collect()}
    for r in got:
        if r.doc_id and r.doc_id > 100 and r.n_a:
            size = len(f" {ODD[r.doc_id - 100]}".encode())
            assert per[r.doc_id] == (r.n_groups, size, size)


def test_alignment_over_chunks(spark):
    """The same table in one chunk and in many gives the same rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    one = alignment.align(docs, vocabulary(FIRST), vocabulary(SECOND)).collect()
    many = alignment.align(docs.repartition(7), vocabulary(FIRST), vocabulary(SECOND), chunk_bytes=20_000, slice_bytes=5_000).collect()
    assert same(one, many)


def test_links_of_large_groups(monkeypatch):
    """A group that repeats ids meets them once, with the product of their numbers, however large it is."""
    tokens = alignment.Tokens(vocabulary(FIRST), vocabulary(SECOND))
    pairs, exact = tokens.encode([" " + "😀" * 9 + "abc" * 30 + "é\x07" * 20, " a" + " " * 40 + "b"])
    assert exact.all()
    a, b = (alignment.numbers(b"".join(p[k] for p in pairs)) for k in (0, 1))
    groups = alignment.Groups(a, b, tokens)
    of = np.zeros(len(groups.n_a), np.int64)
    want = [x.tolist() for x in groups.links(of)]
    monkeypatch.setattr(alignment, "LONGEST", 0)
    assert [x.tolist() for x in groups.links(of)] == want and groups.n_a.max() > 1


# Language --------------------------------------------------------------------------------

SAYINGS = {
    "en": "the house of my father stands near the river and the children play with the dog in the garden while mother reads".split(),
    "de": "das haus meines vaters steht nahe am fluss und die kinder spielen mit dem hund im garten während mutter liest".split(),
    "ru": "дом моего отца стоит у реки и дети играют с собакой в саду пока мама читает книгу".split(),
}


@pytest.fixture(scope="module")
def spoken(spark):
    r = np.random.default_rng(3)
    rows = []
    for i in range(300):
        lang = list(SAYINGS)[i % 3]
        text = " ".join(r.choice(SAYINGS[lang], 25)) + ("! 123 @x.org" if i % 2 else "")
        rows.append((i, text, None if i % 17 == 0 else lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).cache()


def test_language(spark, spoken, docs, nothing):
    model = langid.fit(clashing_language(spoken))
    assert model.languages == ["de", "en", "ru"] and len(model.of) <= 3 * langid.CENTROIDS
    truth = {i: list(SAYINGS)[i % 3] for i in range(300)}
    got = langid.predict(clashing_language(spoken), model).collect()
    assert len(got) == 300 and all(r.lang_pred == truth[r.doc_id] and 0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    odd = langid.predict(clashing(docs), model).collect()
    assert len(odd) == docs.count()
    for r, d in zip(sorted(odd, key=repr), sorted(docs.collect(), key=repr), strict=True):
        if not any(c.isalpha() for c in d.text or ""):
            assert (r.lang_pred, r.score, r.distance) == ("und", 0.0, None)
    assert langid.predict(nothing, model).count() == 0
    assert langid.fit(nothing) is None and langid.fit(spoken.withColumn("lang", F.lit(None).cast("string"))) is None
    assert langid.predict(docs, None).where("lang_pred = 'und' and score = 0").count() == docs.count()


def clashing_language(df):
    return df.withColumns({c: F.lit("x") for c in ("h", "n", "at", "id", "place", "held_out", "lang_pred", "score")})


def test_language_against_plain_form(spoken):
    """Vectors by dictionary and cosines by loops give the operator's language, score and distance."""
    model, letters = langid.fit(spoken), langid.Letters()
    for row in langid.predict(spoken, model).collect()[:40]:
        text = next(r.text for r in spoken.where(F.col("doc_id") == row.doc_id).collect())
        counts = Counter({i: n for i, n in enumerate(letters.counts(text).tolist()) if n})
        vector = {i: (1 + math.log(n)) * model.idf[i] for i, n in counts.items()}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        cosines = [(sum(v * float(model.centroids[i, k]) for i, v in vector.items()) / norm, model.languages[of]) for k, of in enumerate(model.of)]
        best = {}
        for c, lang in cosines:
            best[lang] = max(best.get(lang, -1), c)
        lang = max(best, key=best.get)
        score = 1 / sum(math.exp(langid.SCALE * (c - best[lang])) for c in best.values())
        assert row.lang_pred == lang and math.isclose(row.score, score, rel_tol=1e-4) and math.isclose(row.distance, 1 - best[lang], abs_tol=1e-5)


def test_language_rejects_what_is_far(spark, spoken):
    model = langid.fit(spoken)
    far = spark.createDataFrame([(1, "東京 タワー 日本 語 の 文 章 です"), (2, "the house of my father and the garden")], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.predict(far, model).collect()}
    assert got[1].rejected and got[1].score == 0 and got[1].lang_pred in model.languages
    assert not got[2].rejected and got[2].lang_pred == "en"
    assert {r.doc_id: r.lang_pred for r in langid.predict(far, model, reject=True).collect()} == {1: "und", 2: "en"}


def test_letters_over_blocks(monkeypatch):
    """Cutting a long text into blocks changes no count."""
    text = "Ärger  mit 12 Blöcken,\n\nund   mehr! " * 50
    whole = langid.Letters().counts(text)
    monkeypatch.setattr(langid, "BLOCK", 7)
    assert (langid.Letters().counts(text) == whole).all()
    assert langid.Letters().counts("12 3!") is None and langid.Letters().counts("") is None
    # Plain counting of the folded text.
    folded = " " + re.sub(r"[^a-zäö]+", " ", text.lower()).strip() + " "
    # The blank in front begins runs only.
    assert whole.sum() == (len(folded) - 1) + (len(folded) - 1) + (len(folded) - 2)


def test_clusters():
    """Four kinds of one language have a centroid each."""
    r = np.random.default_rng(1)
    middles = np.eye(6)[:4]
    rows = np.concatenate([m + r.normal(0, 0.05, (30, 6)) for m in middles])
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    centroids, least = langid.clustered(rows)
    assert (np.sort(np.argmax(centroids, 1)) == np.arange(4)).all() and (centroids.max(1) > 0.99).all() and (least > 0.45).all()
    centroids, least = langid.clustered(rows[:2])
    assert len(centroids) == 2 == len(least)


def test_language_query_held_out(spark):
    """Held-out rows of the synthetic table get their language."""
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = [r for r in QUERIES["op11_language"](spark, sf).collect() if r.held_out]
    assert len(got) > 100 and sum(r.lang_pred == truth[r.doc_id] for r in got) >= 0.98 * len(got)

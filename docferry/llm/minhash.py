"""Near-duplicates by an inverted join over the coordinates of MinHash signatures.

1. Every document becomes its set of word shingles, as 64-bit hashes, and a signature of
   ``MINIMA`` minima, two to a coordinate. Documents with equal sets are one class with one
   representative.
2. Each representative is posted under its coordinate-value pairs. Two sets with similarity
   0.8 share fewer than ``SHARED`` of 24 coordinates with a chance of about 3e-7, and fewer
   than ``MATCHES`` of 48 minima with one of about 5e-7. Ordered by how many representatives
   hold a pair, rarest first, two signatures that share ``SHARED`` pairs must share
   ``IN_PREFIX`` of them among the first ``PREFIX``: only these are posted for the join, and
   pairs held once are skipped.
3. A posting list is not joined with itself. Each member meets the centre of its list,
   collisions of the full signatures are counted, pairs above ``MATCHES`` are confirmed on
   the full sets, and confirmed links make components. Lists whose members lie in one
   component are done. The rest meet another centre. The members of what is still mixed then
   meet under their rarest shingles: of two linked sets, in one common order, each has a
   common shingle among its first fifth, early enough for what follows to suffice. Members of
   one component do not meet, and the collisions of these pairs are counted as before.

So a group of copies that link costs a number of pairs in proportion to its size, and no link
between different components is left out. The last step is not bounded that way: G texts that
share a rare shingle, all just below the limit and so each its own component, meet each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import pandas_udf

from docferry.llm.common import stage, worker_store

MINIMA, MATCHES = 48, 22
COORDINATES, SHARED = MINIMA // 2, 4
IN_PREFIX = 2
PREFIX = COORDINATES - SHARED + IN_PREFIX
#: Rounds in which lists meet one centre before all that is left meets each other.
ROUNDS = 2
REMEMBERED = 300_000
# Odd multipliers of the hash functions, from a fixed seed.
_A, _B = np.random.default_rng(20_240_501).integers(1, 2**63, (2, MINIMA), dtype=np.uint64) | np.uint64(1)
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _Q
    return x ^ (x >> np.uint64(29))


def shingle_set(text: bytes, words: int, known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of lower-cased text; empty without words."""
    from xxhash import xxh3_64_intdigest

    tokens = text.lower().split()  # splits at the bytes 9 to 13 and 32
    if not tokens:
        return np.empty(0, np.uint64)
    try:
        hashes = list(map(known.__getitem__, tokens))
    except KeyError:
        if len(known) > REMEMBERED:
            known.clear()
        for t in tokens:
            if t not in known:
                known[t] = xxh3_64_intdigest(t)
        hashes = list(map(known.__getitem__, tokens))
    h = np.array(hashes, np.uint64)
    n = min(words, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)  # a shorter sequence is one shingle of its own kind
    for i in range(n):
        out = _mixed(out * _P + h[i : len(h) - n + 1 + i])
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minimum of each hash function, 32 bits each."""
    out = np.empty(MINIMA, np.uint32)
    for i in range(MINIMA):
        out[i] = ((shingles ^ _B[i]) * _A[i]).min() >> np.uint64(32)
    return out


def _describe(words: int, with_set: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        known = worker_store("word-hashes", dict)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                n, digest, sig = [], [], []
                for text in part.column(1):
                    s = shingle_set(text.as_py() or b"", words, known)
                    n.append(len(s))
                    data = s.tobytes()
                    digest.append(xxh3_128_digest(data) if len(s) else None)
                    sig.append(data if with_set else signature(s).tobytes() if len(s) else None)
                if with_set:
                    columns = [part.column(0), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["id", "digest", "shingles"])
                else:
                    columns = [part.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary()), part.column(2)]
                    yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "digest", "sig", "row"])

    return run


def _posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Coordinate-value pairs as one long each: a hash of the two minima and the coordinate."""
    place = np.arange(1, COORDINATES + 1, dtype=np.uint64) * _Q
    for batch in batches:
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint64).reshape(-1, COORDINATES)
        pairs = _mixed((sig ^ place) * _P).view(np.int64).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), COORDINATES)), pa.array(pairs)], names=["rep", "pair"])


@pandas_udf(T.IntegerType())
def _collisions(a, b):
    import pandas as pd

    if not len(a):
        return pd.Series([], dtype="int32")
    x, y = (np.frombuffer(b"".join(s), np.uint32).reshape(-1, MINIMA) for s in (a, b))
    return pd.Series((x == y).sum(axis=1).astype("int32"))


@pandas_udf(T.BooleanType())
def _linked(a, b):
    import pandas as pd

    def alike(x: bytes, y: bytes) -> bool:
        s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = np.concatenate((s, t))
        both.sort()
        common = int((both[1:] == both[:-1]).sum())
        return 100 * common >= 80 * (len(s) + len(t) - common)

    return pd.Series([alike(x, y) for x, y in zip(a, b, strict=True)], dtype="bool")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node each can reach; ``edges`` has ``a`` and ``b``.

    Each round takes the least label among neighbours and then the label of that label, so
    the rounds grow with the logarithm of the longest chain.
    """
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "links")
    labels = stage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("comp")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("comp").alias("near"))
        nearer = labels.join(near, labels["node"] == near["a"]).select("node", "comp", F.least("comp", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("comp").alias("far"))
        least = F.least("next", "far")
        new = stage(nearer.join(jump, "next").select("node", least.alias("comp"), (least < F.col("comp")).alias("moved")), "labels")
        labels = new.select("node", "comp")
        if new.where("moved").isEmpty():
            return labels


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, row_col: str | None = None) -> DataFrame:
    """For every row: ``n_shingles``, ``component_id`` and ``kept``.

    A set holds the distinct shingles of ``words`` words of the text with A-Z lower-cased;
    a text of fewer words is one shingle; null or empty texts have an empty set and no links.
    Documents with ``100 * common >= 80 * union`` are linked. ``component_id`` is the smallest
    identifier that a document can reach by links, ``kept`` marks that document. Rows that
    repeat an identifier are separate nodes of one name: each links by its own text, and a
    component's id is their smallest name, and all its rows of that name are marked. Rows
    with a null identifier take part, and a component of such rows only has a null id; its
    first row by place is kept.

    ``row_col`` names a column of whole numbers, one for each row and the same whenever
    ``docs`` is read. It is then given as well, and ``kept`` marks one row only of each
    component: of those with the smallest identifier the one with the smallest number.
    """
    number = F.monotonically_increasing_id() if row_col is None else F.col(f"`{row_col}`").cast("long")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    numbered = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"), number.alias("row"))
    described = stage(numbered.mapInArrow(_describe(words, False), f"id {kind}, n long, digest binary, sig binary, row long"), "near-sets")
    # One class for each set; its number is the row number of one member, so it fits any id.
    classes = stage(
        described.where("digest is not null").groupBy("digest")
        .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("least"), F.first("n").alias("n"), F.first("sig").alias("sig"))
        .withColumn("id", F.col("least.id")).withColumn("rep", F.monotonically_increasing_id()),
        "near-classes",
    )

    posts = classes.select("rep", "sig").mapInArrow(_posted, "rep long, pair long")
    held = posts.groupBy("pair").agg(F.count("*").alias("held")).where("held > 1")
    shared = posts.join(held, "pair")
    # Pairs held once come first in the order and meet nobody, so they only shorten the prefix.
    ranked = shared.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("held", "pair"))).alias("p"))
    alone = F.lit(COORDINATES) - F.size("p")
    # A text that others were made from shares more, and in longer lists, than its copies do.
    central = F.aggregate("p", F.lit(0).cast("long"), lambda s, x: s + x["held"]).alias("central")
    prefix = stage(
        ranked.where(alone <= COORDINATES - SHARED).select("rep", central, F.explode(F.slice("p", 1, PREFIX - alone)).alias("p")).select("rep", "central", "p.pair"),
        "near-prefixes",
    )
    sigs = classes.select("rep", "sig", "n")
    comps = links = sets = None
    for step in range(ROUNDS + 1):
        lists = prefix.withColumn("comp", F.col("rep")) if comps is None else (
            prefix.join(comps, prefix["rep"] == comps["node"], "left").select("rep", "central", "pair", F.coalesce("comp", "rep").alias("comp"))
        )
        within = lists.groupBy("pair", "comp").agg(F.count("*").alias("k"), F.max(F.struct("central", "rep")).alias("c"))
        mixed = within.groupBy("pair").agg(F.count("*").alias("comps"), F.max(F.struct("k", "comp")).alias("main")).where("comps > 1")
        mixed = mixed.select("pair", F.col("main.comp").alias("main"))
        if step < ROUNDS:
            # The centre is the most central member; later the most central one outside the largest component.
            outside = within.join(mixed, "pair").where("comp != main") if step else within.join(mixed.select("pair"), "pair", "left_semi")
            centres = outside.groupBy("pair").agg(F.max("c").alias("c")).select("pair", F.col("c.rep").alias("other"))
            meet = lists.join(centres, "pair").where("rep != other").select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b"))
        else:
            left = lists.join(mixed.select("pair"), "pair", "left_semi").groupBy("rep", "comp").agg(F.count("*").alias("n_mixed"))
            left = stage(left.where(F.col("n_mixed") >= IN_PREFIX).select("rep", "comp"), "near-mixed")
            if left.isEmpty():
                break
            sets = _full_sets(left.select("rep"), classes, rows, words, kind)
            rare = stage(_rare_posts(sets).join(left, "rep"), "near-rare")
            # Members outside the largest component of a shingle meet everyone of another component.
            held = rare.groupBy("shingle", "comp").agg(F.count("*").alias("k"))
            held = held.groupBy("shingle").agg(F.count("*").alias("comps"), F.max(F.struct("k", "comp")).alias("main")).where("comps > 1")
            rare = stage(rare.join(held.select("shingle", F.col("main.comp").alias("main")), "shingle"), "near-rare-mixed")
            few = rare.where("comp != main").select("shingle", *(F.col(c).alias(f"x_{c}") for c in ("rep", "comp", "size", "rest")))
            meet = few.join(rare, "shingle").where("comp != x_comp and (comp = main or x_comp < comp)")
            # A link needs common shingles for 4/9 of both sizes, and from the first common one on no more than the rest is there.
            meet = meet.where("5 * least(size, x_size) >= 4 * greatest(size, x_size) and 9 * least(rest, x_rest) >= 4 * (size + x_size)")
            meet = meet.select(F.least("x_rep", "rep").alias("a"), F.greatest("x_rep", "rep").alias("b"))
        pairs = meet.distinct()
        one, two = (sigs.select(F.col("rep").alias(c), F.col("sig").alias(f"s{c}"), F.col("n").alias(f"n{c}")) for c in "ab")
        counted = pairs.join(one, "a").join(two, "b").where("100 * least(na, nb) >= 80 * greatest(na, nb)")
        likely = stage(counted.where(_collisions("sa", "sb") >= MATCHES).select("a", "b"), "near-likely")
        if not likely.isEmpty():
            made = _full_sets(likely.select(F.col("a").alias("rep")).union(likely.select("b")), classes, rows, words, kind) if sets is None else sets
            one, two = (made.select(F.col("rep").alias(c), F.col("shingles").alias(f"set_{c}")) for c in "ab")
            new = stage(likely.join(one, "a").join(two, "b").where(_linked("set_a", "set_b")).select("a", "b"), "near-links")
            links = new if links is None else links.unionByName(new)
            comps = components(links)
    named = classes.select("rep", "digest", "least")
    if comps is not None:
        named = named.join(comps, named["rep"] == comps["node"], "left").withColumn("comp", F.coalesce("comp", "rep"))
    else:
        named = named.withColumn("comp", F.col("rep"))
    smallest = named.groupBy("comp").agg(F.min("least").alias("first"))
    final = named.join(smallest, "comp").select("digest", F.col("first.id").alias("component_id"), F.col("first.row").alias("first_row"))
    out = described.select("id", "n", "digest", "row").join(final, "digest", "left")
    alone = F.col("digest").isNull()
    component = F.when(alone, F.col("id")).otherwise(F.col("component_id"))
    kept = F.col("row") == F.col("first_row")
    if row_col is None:
        kept = kept | F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    columns = [F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), (alone | kept).alias("kept")]
    return out.select(*columns, *([] if row_col is None else [F.col("row").alias(row_col)]))


def _full_sets(reps: DataFrame, classes: DataFrame, rows: DataFrame, words: int, kind: str) -> DataFrame:
    """(rep, shingles): the sets of these representatives, made again from their texts."""
    wanted = classes.join(reps.distinct(), "rep", "left_semi").select("rep", F.col("id").alias("wid"), F.col("digest").alias("wdigest"))
    wanted = stage(wanted, "near-wanted")
    texts = rows.join(wanted.select("wid").distinct(), F.col("id").eqNullSafe(F.col("wid")), "left_semi")
    made = texts.mapInArrow(_describe(words, True), f"id {kind}, digest binary, shingles binary")
    # Equal digests are equal sets, so the digest alone says which class a set belongs to, and
    # sets are dealt out once, by digest, for the join and for dropping repeats alike.
    found = made.select("digest", "shingles").join(wanted.select("rep", F.col("wdigest").alias("digest")), "digest")
    return stage(found.groupBy("digest", "rep").agg(F.first("shingles").alias("shingles")).drop("digest"), "near-full-sets")


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rep, data in zip(batch.column(0), batch.column(1), strict=True):
            shingles = np.frombuffer(data.as_buffer(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(shingles), rep.as_py())), pa.array(shingles)], names=["rep", "shingle"])


def _rare_posts(sets: DataFrame) -> DataFrame:
    """(rep, size, rest, shingle): each set's rarest shingles and how many it has from there on.

    Sets are ordered by how many of these sets hold a shingle. A linked set has at least 4/5
    of this one, so it has one of the first ``size - ceil(4/5 size) + 1``; shingles that only
    one set holds come first and are not posted.
    """
    posted = sets.mapInArrow(_exploded, "rep long, shingle long")
    shared = stage(posted.groupBy("shingle").agg(F.count("*").alias("held")).where("held > 1"), "near-shared")
    ranked = posted.join(shared, "shingle").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("p"))
    sized = sets.select("rep", F.expr("octet_length(shingles) div 8").alias("size"))
    first = F.expr("cast(size(p) + 1 - (4 * size + 4) div 5 as int)")
    return (
        ranked.join(sized, "rep").withColumn("first", first).where("first > 0")
        .select("rep", "size", F.size("p").alias("n"), F.posexplode(F.slice("p", 1, F.col("first"))).alias("at", "p"))
        .select("rep", "size", (F.col("n") - F.col("at")).alias("rest"), F.col("p.shingle").alias("shingle"))
    )

"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set holds its distinct 5-word shingles as 64-bit hashes.  Prefixes
follow one order of all shingles: those of a sketch's frequent buckets last, by
hash otherwise.  Two sets of similarity 0.8 share at least l shingles of their
prefixes of n - ceil(0.8 n) + l; a document whose prefix looks costly takes the
longer one (larger l), and two that link share the smaller of their l.

Equal sets are one class from the start.  A large group of near copies must not
be compared pair by pair to become one component: each class is first compared
with the least one that holds a common prefix shingle.  What then lies in
different components must reach l with (class, component) counts before members
are looked at, by all but the l - 1 most frequent of the shingles counted; where
all links are asked for, pairs are counted themselves.  Every pair passes a bit sketch (an exact bound of the difference)
before its sets are fetched."""
from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newsops.llm import words as W
from newsops.llm.graph import components
from newsops.session import materialise

NGRAM = 5
PERCENT = 80
SHORT, LONG = 5, 15          # percent of the set: matches asked of a short and of a long prefix
SKETCH = 1 << 16
COSTLY = 0.05                # a prefix with this share of frequent-looking shingles, beyond twice what chance gives, is costly
BITS = 1024                  # of the sketch that bounds the difference of two sets
FOLDS = 4                    # numbers of 64 bits of its short form


def sets(column: pa.Array, ngram: int = NGRAM):
    """Per row: the sorted distinct shingle hashes."""
    for part in W.slices(column):
        w = part.words(W.BLANKS, True)
        h, _ = w.windows(ngram)
        for r in range(part.rows):
            a, b = w.bounds[r], w.bounds[r + 1]
            if b - a >= ngram:
                yield np.unique(h[a:b - ngram + 1])
            elif b > a:
                yield W.rolling(w.hash[a:b], int(b - a)) ^ np.uint64(b - a)
            else:
                yield np.zeros(0, np.uint64)


def parity(s: np.ndarray) -> bytes:
    """``BITS`` bits: how many shingles fall on each, modulo 2.  Two sets differ in
    at least as many shingles as their sketches differ in bits."""
    at = (s >> np.uint64(20) & np.uint64(BITS - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=BITS) & 1 == 1).tobytes()


def _facts(ngram: int):
    def scan(batches):
        """(doc_id, n, key, bits) of each row; at the end the task's sketch (bucket, seen)."""
        sketch = np.zeros(SKETCH, np.int64)
        names = ["doc_id", "n", "key", "bits", "bucket", "seen"]
        for batch in batches:
            n, keys, bits = [], [], []
            for s in sets(batch.column(1), ngram):
                n.append(len(s))
                keys.append(hashlib.md5(s.tobytes()).digest())
                bits.append(np.frombuffer(parity(s), np.int64))
                np.add.at(sketch, (s & np.uint64(SKETCH - 1)).astype(np.int64), 1) if len(s) < 64 else \
                    np.add(sketch, np.bincount((s & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH), out=sketch)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(bits, pa.list_(pa.int64())),
                pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.int64())], names=names)
        at = np.flatnonzero(sketch)
        yield pa.RecordBatch.from_arrays([
            pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.binary()),
            pa.nulls(len(at), pa.list_(pa.int64())), pa.array(at.astype(np.int32)), pa.array(sketch[at])], names=names)
    return scan


def matches(n: int, percent: int) -> int:
    return max(1, -(-n * percent // 100))


def prefix_size(n: int, asked: int) -> int:
    return n - -(-n * PERCENT // 100) + asked


def _prefixes(sketch, ngram: int):
    def scan(batches):
        """(doc_id, key, n, asked, tokens): prefix of each row that has a set."""
        often = sketch.value
        least = COSTLY + 2 * often.mean()
        for batch in batches:
            docs, ids = [], batch.column(0).to_pylist()
            for doc, s in zip(ids, sets(batch.column(1), ngram)):
                n = len(s)
                if not n or doc is None:
                    continue
                common = often[(s & np.uint64(SKETCH - 1)).astype(np.int64)]
                short = prefix_size(n, matches(n, SHORT))
                costly = max(0, short - n + int(common.sum())) > least * short
                asked = matches(n, LONG if costly else SHORT)
                order = np.concatenate([s[~common], s[common]])
                docs.append((doc, hashlib.md5(s.tobytes()).digest(), n, asked, order[:prefix_size(n, asked)].view(np.int64)))
            cols = list(zip(*docs)) or [()] * 5
            yield pa.RecordBatch.from_arrays([
                pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int64()),
                pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.list_(pa.int64()))],
                names=["doc_id", "key", "n", "asked", "tokens"])
    return scan


def _whole(ngram: int):
    def scan(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([s.view(np.int64) for s in sets(batch.column(1), ngram)], pa.list_(pa.int64()))],
                names=["doc", "whole"])
    return scan


def frequent(facts: DataFrame) -> np.ndarray:
    """Buckets of the sketch that stand out by more than four deviations: some
    shingle in them is frequent.  ``SKETCH`` sums reach the driver."""
    counts = np.zeros(SKETCH)
    for r in facts.where("bucket is not null").groupBy("bucket").agg(F.sum("seen").alias("n")).collect():
        counts[r["bucket"]] = r["n"]
    usual = np.median(counts)
    return counts > usual + 4 * np.sqrt(usual) + 8


def alike(n1, n2):
    """Sizes that allow a similarity of 0.8."""
    return 100 * F.least(n1, n2) >= PERCENT * F.greatest(n1, n2)


def apart(n1, n2):
    """Shingles that linked sets of these sizes differ in, at most."""
    return (100 - PERCENT) * (n1 + n2) / (100 + PERCENT) + 1e-6


def folded(classes: DataFrame, doc: str, name: str) -> DataFrame:
    """``doc`` of each class with its sketch's short form, ``name``0 and on: places
    that many bits share, modulo 2, which bounds the difference of two sets too."""
    fold = lambda j: reduce(lambda x, y: x.bitwiseXOR(y), [F.get("bits", F.lit(i)) for i in range(j, BITS // 64, FOLDS)])
    return classes.select(F.col("doc").alias(doc), *[fold(j).alias(f"{name}{j}") for j in range(FOLDS)])


def least_gap() -> Column:
    """Bits in which a class's short sketch (f0 and on) differs from those of all of a
    component's holders of a shingle (allf0, anyf0 and on: their bits' and, and or)."""
    return sum((F.bit_count(F.col(f"f{j}").bitwiseAND(F.bitwise_not(f"anyf{j}"))) + F.bit_count(
        F.bitwise_not(f"f{j}").bitwiseAND(F.col(f"allf{j}"))) for j in range(FOLDS)), F.lit(0))


def near(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``pairs`` (a, b) whose sketches allow a link, with ``gap``, the bits they differ in.
    Of sizes n and m, linked sets differ in (n + m) / 9 shingles at most."""
    side = lambda c: classes.select(F.col("doc").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"bits{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    gap = sum((F.bit_count(F.get("bitsa", F.lit(i)).bitwiseXOR(F.get("bitsb", F.lit(i)))) for i in range(BITS // 64)), F.lit(0))
    return both.where(alike(F.col("na"), F.col("nb"))).select("a", "b", gap.alias("gap"), apart(F.col("na"), F.col("nb")).alias("most")).where(
        "gap <= most").select("a", "b", "gap")


def verified(pairs: DataFrame, docs: DataFrame, ngram: int) -> DataFrame:
    """Those of ``pairs`` (a, b) that link: 100 * common >= 80 * all, on whole sets.
    Sets are built once for each document in a pair."""
    wanted = pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select("b")).distinct()
    whole = materialise(docs.join(wanted, "doc_id").select("doc_id", "text").mapInArrow(
        _whole(ngram), "doc long, whole array<bigint>"), "jaccard-sets")
    both = (pairs.join(whole.select(F.col("doc").alias("a"), F.col("whole").alias("x")), "a")
            .join(whole.select(F.col("doc").alias("b"), F.col("whole").alias("y")), "b"))
    common = F.size(F.array_intersect("x", "y"))
    return both.select("a", "b", common.alias("c"), (F.size("x") + F.size("y") - common).alias("u")).where(
        100 * F.col("c") >= PERCENT * F.col("u")).select("a", "b").distinct()


def postings(prefixes: DataFrame) -> DataFrame:
    """(token, doc, n, asked, hub, hub_n) of prefix shingles that several classes
    hold; hub is the least of them."""
    rows = prefixes.select(F.explode("tokens").alias("token"), "doc", "n", "asked")
    hubs = rows.groupBy("token").agg(F.min("doc").alias("hub"), F.min_by("n", "doc").alias("hub_n"), F.max("doc").alias("last")).where("hub <> last")
    return rows.join(hubs, "token").select("token", "doc", "n", "asked", "hub", "hub_n")


def seeds(held: DataFrame) -> DataFrame:
    """Each class with the least ones that share a prefix shingle."""
    return held.where((F.col("doc") != F.col("hub")) & alike(F.col("n"), F.col("hub_n"))).select(
        F.col("hub").alias("a"), F.col("doc").alias("b")).distinct()


def meetings(live: DataFrame) -> DataFrame:
    """Rows of ``live`` with each other component (to) that holds their shingle, has no
    fewer members, and by sizes and sketches may hold a class that links to theirs.

    A holder that links passes the bound at every shingle it shares: the rows that
    are left are enough to count those."""
    folds = [f"f{j}" for j in range(FOLDS)]
    into = live.groupBy("token", F.col("component").alias("to")).agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.min("asked").alias("least"), F.count("*").alias("df"),
        F.first("members").alias("to_members"), *[F.bit_and(f).alias(f"all{f}") for f in folds], *[F.bit_or(f).alias(f"any{f}") for f in folds])
    return live.join(into, "token").where(
        (F.struct("to_members", "to") > F.struct("members", "component"))
        & (100 * F.col("high") >= PERCENT * F.col("n")) & (100 * F.col("n") >= PERCENT * F.col("low"))
        & (least_gap() <= apart(F.col("n"), F.col("high"))))


def candidates(held: DataFrame, known: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of classes in different components of ``known`` (node, component) that
    share what their prefixes ask for.

    A class that links into a component shares as much with all its prefixes
    together, so (class, component) is counted first, from the smaller component's
    side; members are met only where that count is reached.  Near copies that just
    miss a link share shingles with one another, or with every member of a large
    component: the short sketches are compared in the joins themselves, first with
    what a component's holders of the shingle have in common, so that they make no
    row of such a pair."""
    sizes = known.groupBy("component").agg(F.count("*").alias("members"))
    named = known.join(sizes, "component").select(F.col("node").alias("doc"), "component", "members")
    rows = materialise(held.drop("hub", "hub_n").join(named, "doc", "left").withColumns({
        "component": F.coalesce("component", "doc"), "members": F.coalesce("members", F.lit(1).cast("long"))}), "jaccard-rows")
    mixed = rows.groupBy("token").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 <> c2").select("token")
    live = materialise(rows.join(mixed, "token", "left_semi").join(folded(classes, "doc", "f"), "doc"), "jaccard-live")
    folds = [f"f{j}" for j in range(FOLDS)]
    met = meetings(live)
    # Any partner inside shares ``must`` of these shingles: all but the must - 1 most
    # frequent ones are enough to meet it.
    must = F.least("asked", "least")
    enough = materialise(met.groupBy("doc", "n", "to", *folds).agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t"), F.min("least").alias("least"), F.min("asked").alias("asked"))
        .where(F.size("t") >= must)
        .select("doc", "n", "to", *folds, F.explode(F.slice("t", F.lit(1), (F.size("t") - must + 1).cast("int"))).alias("t"))
        .select("doc", "n", "to", *folds, "t.token"), "jaccard-enough")
    inside = live.select("token", F.col("component").alias("to"), F.col("doc").alias("y"), F.col("n").alias("m"),
                         *[F.col(f"f{j}").alias(f"g{j}") for j in range(FOLDS)])
    gap = sum((F.bit_count(F.col(f"f{j}").bitwiseXOR(F.col(f"g{j}"))) for j in range(FOLDS)), F.lit(0))
    return enough.join(inside, ["token", "to"]).where(alike(F.col("n"), F.col("m")) & (gap <= apart(F.col("n"), F.col("m")))).select(
        F.least("doc", "y").alias("a"), F.greatest("doc", "y").alias("b")).distinct()


def every_pair(held: DataFrame) -> DataFrame:
    """All pairs of classes that share what their prefixes ask for: as many rows at
    least as there are links."""
    other = held.select("token", F.col("doc").alias("y"), F.col("n").alias("m"), F.col("asked").alias("z"))
    return (held.join(other, "token").where((F.col("doc") < F.col("y")) & alike(F.col("n"), F.col("m")))
            .groupBy("doc", "y").agg(F.count("*").alias("c"), F.min("asked").alias("asked"), F.min("z").alias("z"))
            .where("c >= least(asked, z)").select(F.col("doc").alias("a"), F.col("y").alias("b")))


def join(docs: DataFrame, ngram: int = NGRAM, count_links: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text):
    component_id is the smallest doc_id reachable by links of similarity 0.8 or
    more.  With ``count_links`` also n_links, the number of other classes that
    the row's class links to; all links are then met one by one, which takes as
    long as there are links (a large group of near copies has the square of its size).

    Fewer words than five are one shingle; null and empty texts have an empty
    set, link to nothing and are their own component.  Rows of equal sets are one
    class, linked to each other.  Rows that share a doc_id are one document:
    they are in one component.  Rows without doc_id get component null."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    facts = materialise(docs.mapInArrow(
        _facts(ngram), "doc_id long, n long, key binary, bits array<bigint>, bucket int, seen long"), "jaccard-facts")
    rows = facts.where("bucket is null").select("doc_id", "n", "key", "bits")
    classes = materialise(rows.where("n > 0 and doc_id is not null").groupBy("key").agg(
        F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("bits").alias("bits")), "jaccard-classes")
    sketch = docs.sparkSession.sparkContext.broadcast(frequent(facts))
    chosen = classes.select("key", F.col("doc").alias("doc_id"))
    prefixes = materialise(docs.mapInArrow(_prefixes(sketch, ngram), "doc_id long, key binary, n long, asked long, tokens array<bigint>")
                           .join(chosen, ["key", "doc_id"])
                           .groupBy("key", "doc_id").agg(*[F.first(c).alias(c) for c in ("n", "asked", "tokens")])
                           .withColumnRenamed("doc_id", "doc"), "jaccard-prefixes")
    held = materialise(postings(prefixes), "jaccard-held")
    if count_links:
        links = materialise(verified(materialise(near(every_pair(held), classes), "jaccard-near"), docs, ngram), "jaccard-links")
    else:
        close = materialise(near(seeds(held), classes), "jaccard-near")
        # The closest hub first: it makes most components, others are asked where it didn't.
        closest = materialise(close.groupBy("b").agg(F.min_by("a", F.struct("gap", "a")).alias("a")).select("a", "b"), "jaccard-closest")
        first = materialise(verified(closest, docs, ngram), "jaccard-links")
        known = materialise(components(first), "jaccard-known")
        # A component without a link is its class alone.
        of = lambda c: known.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
        others = (close.select("a", "b").join(of("a"), "a", "left").join(of("b"), "b", "left")
                 .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b").join(closest, ["a", "b"], "left_anti"))
        second = materialise(verified(materialise(others, "jaccard-apart"), docs, ngram), "jaccard-links")
        known = materialise(components(first.unionAll(second)), "jaccard-known")
        more = near(candidates(held, known, classes), classes).select("a", "b")
        third = verified(materialise(more, "jaccard-candidates"), docs, ngram)
        links = materialise(first.unionAll(second).unionAll(third).distinct(), "jaccard-links")
    # A repeated doc_id ties the classes of its rows together.
    same = rows.where("n > 0").join(classes.select("key", "doc"), "key").where("doc_id <> doc").select(
        F.col("doc_id").alias("a"), F.col("doc").alias("b"))
    repeated = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("key").alias("k1"), F.max("key").alias("k2")).where("k1 <> k2")
    ties = same.join(repeated.select(F.col("doc_id").alias("a")), "a", "left_semi")
    found = materialise(components(links.unionAll(ties)), "jaccard-components")
    named = classes.join(found, classes["doc"] == found["node"], "left").select("key", "doc", F.coalesce("component", "doc").alias("component"))
    out = ["doc_id", F.col("n").alias("n_shingles"),
           F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")]
    if count_links:
        degree = links.select(F.col("a").alias("doc")).unionAll(links.select("b")).groupBy("doc").agg(F.count("*").alias("n_links"))
        named = named.join(degree, "doc", "left")
        out.append(F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return rows.join(materialise(named.drop("doc"), "jaccard-named"), "key", "left").select(*out)

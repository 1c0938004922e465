"""Quality by perplexity: an interpolated modified Kneser-Ney model of character
n-grams for each language, trained on trusted text, and language-specific
quantiles of the trusted documents' perplexity as thresholds.  A second model is
trained on trusted and rejected text together: a few bad words in clean prose
hardly raise a text's perplexity, but the second model tells such a text better
than the first, and clean text worse.

Every trusted document is counted: tasks add up their n-grams, Spark adds up the
tasks', and all orders' counts and discounts are joins and groupings of those
tables.  The model is a table of weights whose sum over the grams and contexts
at a place is the log probability there, so it may be cut anywhere: documents
are scored where they lie against one hash shard of ``SHARD_ROWS`` weights at a
time, and their sums over the shards add up.  The order is the same at every size."""
from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newsops.session import materialise

ORDER = 5
SHARD_ROWS = 4_000_000
#: Weights that come to the driver in one job.
PART_ROWS = 500_000
#: Labelled ids in one broadcast.
BLOCK_ROWS = 500_000
QUANTILE = 0.99
CHUNK_CHARS = 1 << 17
#: Slots for windows that a worker has looked up lately: 24 MB with two models.
RECENT_BITS = 20
START = "\x02"
#: Before a language's name: its model of trusted and rejected text.
MIXED = "\x03"
CONTEXT = np.uint64(0x5851F42D4C957F2D)
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                        0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)


def padded(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each after ``order`` - 1 start marks, and which
    places hold a character to be scored."""
    text = "".join(START * (order - 1) + t for t in texts)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    real = np.ones(len(points), bool)
    at = np.cumsum([0] + [len(t) + order - 1 for t in texts])[:-1]
    for k in range(order - 1):
        real[at + k] = False
    return points, real


def chunks(texts: list[str | None]):
    """Lists of row numbers with about CHUNK_CHARS characters of text."""
    rows, size = [], 0
    for i, t in enumerate(texts):
        if t:
            rows.append(i)
            size += len(t)
        if rows and (size >= CHUNK_CHARS or i == len(texts) - 1):
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def _count(order: int):
    def scan(batches):
        sums: Counter = Counter()
        for batch in batches:
            texts, kinds = batch.column(0).to_pylist(), list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            for kind in sorted(set(kinds)):
                own = [t for t, x in zip(texts, kinds) if x == kind]
                for rows in chunks(own):
                    points, real = padded([own[i] for i in rows], order)
                    ends = np.flatnonzero(real)
                    grams = np.lib.stride_tricks.sliding_window_view(points, order)[ends - order + 1]
                    # Grams as fixed-width rows of bytes, so that equal ones are counted at once.
                    key = np.ascontiguousarray(grams).view(f"V{4 * order}").ravel()
                    h = hashes(points, ends, order)
                    _, at, n = np.unique(h, return_index=True, return_counts=True)
                    for k, c in zip(key[at].tolist(), n.tolist()):
                        sums[kind, k] += c
        items = [(*kind, k.decode("utf-32-le", "surrogatepass"), n) for (kind, k), n in sums.items()]
        cols = list(zip(*items)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.string(), pa.bool_(), pa.string(), pa.int64()))],
                                         names=["lang", "good", "g", "c"])
    return scan


def hashes(points: np.ndarray, ends: np.ndarray, size: int, seed: np.ndarray | int = 0) -> np.ndarray:
    """Hash of the ``size`` code points that end at each place."""
    h = np.full(len(ends), size, np.uint64) ^ np.asarray(seed, np.uint64)
    for k in range(size):
        h = (h ^ points[ends - k].astype(np.uint64)) * MULTIPLIERS[k % len(MULTIPLIERS)]
        h ^= h >> np.uint64(29)
    return h


def discounts(grams: DataFrame) -> DataFrame:
    """Per language the three modified discounts, from counts of counts."""
    n = [F.count(F.when(F.col("c") == k, 1)).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1.0))
    d = lambda k: F.greatest(F.lit(0.05), F.least(F.lit(float(k)) - 0.05, F.when(
        F.col(f"n{k}") > 0, k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")).otherwise(0.5)))
    return grams.groupBy("lang").agg(*n).select("lang", d(1).alias("d1"), d(2).alias("d2"), d(3).alias("d3"))


def discounted(c: Column) -> Column:
    return F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))


def model(grams: DataFrame, order: int) -> DataFrame:
    """(lang, k, g, logp, logb, w): log probability of the last character of each
    seen gram after the others, and the log weight that a seen context ``g`` of
    length ``k`` leaves to shorter ones.

    ``w`` is what a row adds to a place where it occurs: a context its weight, a
    gram what it has beyond its context's weight and its suffix, the empty context
    the log probability of an unseen character.  Suffixes of seen grams are seen,
    so the sum of a place's rows is its log probability.

    Orders below the highest count distinct left neighbours."""
    tables = {order: grams}
    for k in range(order - 1, 0, -1):
        tables[k] = materialise(tables[k + 1].groupBy("lang", F.expr(f"substring(g, 2, {k})").alias("g")).agg(
            F.count("*").alias("c")), f"quality-grams{k}")
    base = tables[1].groupBy("lang").agg(F.log(1.0 / (F.count("*") + 1)).alias("lower"))
    lower, out = None, None
    for k in range(1, order + 1):
        t = tables[k].join(F.broadcast(discounts(tables[k])), "lang").withColumn("x", F.expr(f"substring(g, 1, {k - 1})"))
        ctx = t.groupBy("lang", "x").agg(F.sum("c").alias("total"), F.sum(discounted(F.col("c"))).alias("cut"))
        t = t.join(ctx, ["lang", "x"])
        t = t.join(base, "lang") if k == 1 else t.join(
            lower.select("lang", F.col("g").alias("s"), F.col("logp").alias("lower")),
            (t["lang"] == lower["lang"]) & (F.expr(f"substring(g, 2, {k - 1})") == F.col("s"))).drop(lower["lang"])
        p = (F.col("c") - discounted(F.col("c"))) / F.col("total") + F.col("cut") / F.col("total") * F.exp("lower")
        logb = F.log(F.col("cut") / F.col("total"))
        lower = materialise(t.select("lang", "g", F.log(p).alias("logp"), (F.log(p) - logb - F.col("lower")).alias("w")), f"quality-model{k}")
        backs = ctx if k > 1 else ctx.join(base, "lang")
        backs = backs.select("lang", F.lit(k - 1).alias("k"), F.col("x").alias("g"), F.lit(None).cast("double").alias("logp"),
                             logb.alias("logb"), (logb if k > 1 else logb + F.col("lower")).alias("w"))
        part = lower.select("lang", F.lit(k).alias("k"), "g", "logp", F.lit(None).cast("double").alias("logb"), "w").unionAll(backs)
        out = part if out is None else out.unionAll(part)
    return out


class Table:
    """Open table from hashes to values, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * max(len(keys), 1)).bit_length())
        self.keys, self.values = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.float32)
        todo = np.arange(len(keys))
        at = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(todo):
            free = self.values[at[todo]] == 0
            first = np.unique(at[todo][free], return_index=True)[1]
            take = todo[free][first]
            self.keys[at[take]], self.values[at[take]] = keys[take], values[take]
            todo = np.setdiff1d(todo, take, assume_unique=True)
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)

    def get(self, h: np.ndarray) -> np.ndarray:
        """Values, 0 where there is none."""
        out = np.zeros(len(h), np.float32)
        todo, at = np.arange(len(h)), (h >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(todo):
            value = self.values[at]
            same = self.keys[at] == h[todo]
            out[todo[same]] = value[same]
            on = ~same & (value != 0)
            todo, at = todo[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return out


class Recent:
    """Some numbers for each of the windows met lately, by hash: of those that share a
    slot, the one that came last."""

    def __init__(self, numbers: int, bits: int):
        self.shift, self.keys, self.values = np.uint64(64 - bits), np.zeros(1 << bits, np.uint64), np.zeros((numbers, 1 << bits))
        # No hash that falls on the first slot; 0 is none that falls on another.
        self.keys[0] = ~np.uint64(0)

    def get(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of each window, and which of them aren't known."""
        at = (h >> self.shift).astype(np.int64)
        return self.values[:, at], np.flatnonzero(self.keys[at] != h)

    def put(self, h: np.ndarray, values: np.ndarray) -> None:
        at, first = np.unique(h >> self.shift, return_index=True)
        self.keys[at], self.values[:, at] = h[first], values[:, first]


def seed(lang: str) -> int:
    return int.from_bytes(hashlib.md5(lang.encode("utf-8", "surrogatepass")).digest()[:8], "big")


def row_hashes(langs: list[str], sizes: np.ndarray, grams: list[str], contexts: np.ndarray) -> np.ndarray:
    """Keys of a model's rows, as Scorer asks for them; rows of size 0 get 0."""
    h = np.zeros(len(grams), np.uint64)
    seeds = {lang: seed(lang) for lang in set(langs)}
    own = np.array([seeds[x] for x in langs], np.uint64)
    for k in set(sizes.tolist()) - {0}:
        at = np.flatnonzero(sizes == k)
        points = np.frombuffer("".join(grams[i] for i in at).encode("utf-32-le", "surrogatepass"), np.uint32)
        h[at] = hashes(points, np.arange(1, len(at) + 1) * k - 1, k, own[at] ^ (contexts[at].astype(np.uint64) * CONTEXT))
    return h


def _keyed(batches):
    """(h, w) of a model's rows."""
    for batch in batches:
        langs, sizes, grams, contexts, w = batch.columns
        h = row_hashes(langs.to_pylist(), sizes.to_numpy(), grams.to_pylist(), contexts.to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), w], names=["h", "w"])


class Scorer:
    """Weights of a model, or of a shard of several languages' models, by hash."""

    def __init__(self, rows, order: int):
        """All rows (pandas) of one language's model."""
        langs = rows["lang"].tolist()
        h = row_hashes(langs, rows["k"].to_numpy(), rows["g"].tolist(), rows["logb"].notna().to_numpy())
        some = (rows["k"] > 0).to_numpy()
        self.fill(h[some], rows["w"].to_numpy()[some], order)
        self.seed, self.unseen = seed(langs[0]), float(rows["w"][~some].iloc[0])

    @classmethod
    def shard(cls, h: np.ndarray, w: np.ndarray, order: int, shard: int = 0, shards: int = 1) -> "Scorer":
        """Those of the weights whose hash falls to ``shard`` of ``shards``."""
        self = cls.__new__(cls)
        self.fill(h, w, order)
        self.part, self.parts = np.uint64(shard), np.uint64(shards)
        return self

    def fill(self, h, w, order):
        self.order, self.rows, self.made, self.seed, self.unseen = order, (h, w.astype(np.float32, copy=False)), None, 0, 0.0
        self.part, self.parts, self.recent = np.uint64(0), np.uint64(1), None

    @property
    def table(self) -> Table:
        """Made where it is first asked: half of its slots are empty, only the rows travel."""
        if self.made is None:
            self.made, self.rows = Table(*self.rows), None
        return self.made

    def get(self, h: np.ndarray) -> np.ndarray:
        if self.parts == 1:
            return self.table.get(h)
        out, mine = np.zeros(len(h), np.float32), np.flatnonzero(h % self.parts == self.part)
        out[mine] = self.table.get(h[mine])
        return out

    def log_probabilities(self, points: np.ndarray, ends: np.ndarray, seeds: np.ndarray | None = None) -> np.ndarray:
        """At each place, the sum of the weights here; log probabilities, if they are
        one language's, else less the unseen character's and other shards' part."""
        seeds = np.full(len(ends), self.seed, np.uint64) if seeds is None else seeds
        # Each window of the highest order is looked up once.
        _, at, where = np.unique(hashes(points, ends, self.order, seeds), return_index=True, return_inverse=True)
        ends, seeds = ends[at], seeds[at]
        out = np.full(len(ends), self.unseen)
        for k in range(1, self.order + 1):
            out += self.get(hashes(points, ends, k, seeds))
            if k > 1:
                out += self.get(hashes(points, ends - 1, k - 1, seeds ^ CONTEXT))
        return out[where]

    def remembered(self, points: np.ndarray, ends: np.ndarray, seeds: list[np.ndarray]) -> np.ndarray:
        """log_probabilities() for each of ``seeds``, which the same languages have in
        every call.  A window of the highest order that was met lately isn't looked
        up again."""
        if self.recent is None:
            self.recent = Recent(len(seeds), RECENT_BITS)
        h = hashes(points, ends, self.order, seeds[0])
        out, new = self.recent.get(h)
        if len(new):
            found = np.stack([self.log_probabilities(points, ends[new], own[new]) for own in seeds])
            out[:, new] = found
            self.recent.put(h[new], found)
        return out


def _score(known, kinds: list[str]):
    def scan(batches):
        scorer = known.value
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            results: list[list[float | None]] = [[None] * len(texts) for _ in kinds]
            for rows in chunks(texts):
                points, real = padded([texts[i] for i in rows], scorer.order)
                sizes, ends = np.array([len(texts[i]) for i in rows]), np.flatnonzero(real)
                names = {lang: i for i, lang in enumerate(sorted({langs[i] for i in rows}))}
                which = np.repeat(np.array([names[langs[i]] for i in rows]), sizes)
                seeds = [np.array([seed(kind + lang) for lang in names], np.uint64)[which] for kind in kinds]
                for result, each in zip(results, scorer.remembered(points, ends, seeds)):
                    sums = np.concatenate([[0.0], np.cumsum(each)])
                    for i, x in zip(rows, np.diff(sums[np.concatenate([[0], np.cumsum(sizes)])]).tolist()):
                        result[i] = x
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *[pa.array(r, pa.float64()) for r in results]],
                                             names=[*batch.schema.names[1:], *[f"total{k}" for k in range(len(kinds))]])
    return scan


def counted(taught: DataFrame, order: int) -> DataFrame:
    """(lang, g, good, c): the grams of ``taught`` (text, lang, good), how often trusted
    texts have each, and all of them.  One pass over the texts counts both."""
    return materialise(taught.where("text <> '' and good is not null").select("text", F.coalesce("lang", F.lit("")).alias("lang"), "good").mapInArrow(
        _count(order), "lang string, good boolean, g string, c long").groupBy("lang", "g").agg(
        F.coalesce(F.sum(F.when(F.col("good"), F.col("c"))), F.lit(0).cast("long")).alias("good"), F.sum("c").alias("c")), "quality-grams")


def gathered(keyed: DataFrame, part_rows: int = PART_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """All (h, w) of ``keyed``, a written table, as arrays.  They come to the driver
    some ``part_rows`` at a time, so that it holds little more than the arrays."""
    n = keyed.count()
    h, w, at, parts = np.empty(n, np.uint64), np.empty(n, np.float32), 0, max(1, -(-n // part_rows))
    for p in range(parts):
        rows = keyed.where(F.pmod(F.xxhash64("h"), F.lit(parts)) == p).select("h", F.col("w").cast("float").alias("w")).toArrow()
        h[at:at + len(rows)], w[at:at + len(rows)] = rows["h"].to_numpy().view(np.uint64), rows["w"].to_numpy()
        at += len(rows)
    return h, w


def score(docs: DataFrame, trusted: DataFrame, order: int = ORDER, shard_rows: int = SHARD_ROWS,
          rejected: DataFrame | None = None) -> DataFrame:
    """(doc_id, lang, perplexity) of every row of ``docs`` (doc_id, text, lang), by a
    model of ``trusted`` (text, lang); perplexity per character.  Null and empty
    texts, and languages without trusted text, have none.  Null lang is a
    language of its own (written '').  With ``rejected`` (text, lang) also mixed:
    perplexity by a model of both, null for languages without rejected text."""
    taught = trusted.select("text", "lang", F.lit(True).alias("good"))
    if rejected is not None:
        taught = taught.unionAll(rejected.select("text", "lang", F.lit(False)))
    return scored(docs, taught, order, shard_rows, rejected is not None)


def scored(docs: DataFrame, taught: DataFrame, order: int = ORDER, shard_rows: int = SHARD_ROWS, mixed: bool = True) -> DataFrame:
    """score() by ``taught`` (text, lang, good), trusted and rejected texts together.

    The driver holds one shard of ``shard_rows`` (hash, weight) at a time.  Every
    shard takes a pass over the documents; passes after the first cost time, and
    ``doc_id``, language and two numbers of each document on disk."""
    named, kinds = F.coalesce("lang", F.lit("")), ["", MIXED] if mixed else [""]
    counts = counted(taught, order)
    grams = counts.where("good > 0").select("lang", "g", F.col("good").alias("c"))
    if mixed:
        bad = materialise(counts.where("c > good").select("lang").distinct(), "quality-rejected")
        grams = grams.unionAll(counts.join(F.broadcast(bad), "lang").select(F.concat(F.lit(MIXED), "lang").alias("lang"), "g", "c"))
    full = model(grams, order)
    keyed = materialise(full.where("k > 0").select("lang", "k", "g", F.col("logb").isNotNull().alias("context"), "w").mapInArrow(
        _keyed, "h long, w double"), "quality-weights")
    unseen = materialise(full.where("k = 0").select(F.col("lang").alias("_model"), F.col("w").alias("_unseen")), "quality-unseen")
    shards = max(1, -(-keyed.count() // shard_rows))
    # pmod of the unsigned hash, as Scorer.get has it.
    which = F.expr(f"cast(pmod(cast(h as decimal(20)) + if(h < 0, 18446744073709551616BD, 0BD), {shards}) as int)")
    out = docs.select("text", named.alias("lang"), "doc_id", F.xxhash64("text").alias("h"), F.length("text").alias("chars"))
    totals = [f"total{k}" for k in range(len(kinds))]
    schema = f"lang string, doc_id {docs.schema['doc_id'].dataType.simpleString()}, h long, chars int, " + ", ".join(f"{t} double" for t in totals)
    sums = None
    for s in range(shards):
        scorer = Scorer.shard(*gathered(keyed if shards == 1 else keyed.where(which == s)), order, s, shards)
        known = docs.sparkSession.sparkContext.broadcast(scorer)
        part = out.mapInArrow(_score(known, kinds), schema)
        if shards > 1:
            part = materialise(part, "quality-sums")
            known.destroy()
        sums = part if sums is None else sums.unionAll(part)
    if shards > 1:
        # Rows alike in all of these have equal sums: as many come out as went in.
        sums = sums.groupBy("lang", "doc_id", "h", "chars").agg(
            *[(F.sum(t) / F.count("*") * shards).alias(t) for t in totals], F.count("*").alias("n")).select(
            "lang", "doc_id", "chars", *totals, F.explode(F.sequence(F.lit(1), (F.col("n") / shards).cast("int"))))
    for kind, total, name in zip(kinds, totals, ("perplexity", "mixed")):
        sums = sums.join(F.broadcast(unseen), F.concat(F.lit(kind), "lang") == F.col("_model"), "left").withColumn(name, F.when(
            F.col("chars") > 0, F.exp(-(F.col(total) / F.col("chars") + F.col("_unseen"))))).drop("_model", "_unseen")
    return sums.select("doc_id", "lang", *["perplexity", "mixed"][:len(kinds)])


def labelled(docs: DataFrame, known: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows of ``docs`` with what the written table ``known`` has of their doc_id.  Ids
    go to where the texts lie, in as many broadcast blocks as they need; each
    block after the first takes one more scan of ``docs``, and no text is shuffled."""
    blocks = max(1, -(-known.count() // block_rows))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(blocks))
    out = None
    for b in range(blocks):
        some = docs.join(F.broadcast(known if blocks == 1 else known.where(part == b)), "doc_id")
        out = some if out is None else out.unionAll(some)
    return out


def judged(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """classify()'s rows with gain, the log of perplexity over mixed, and its limit
    most_gain."""
    known = materialise(labels.where("doc_id is not null and (quality is not null or toxic is not null)").groupBy("doc_id").agg(
        F.min(F.coalesce(F.expr("quality = 1 and coalesce(toxic, 0) = 0"), F.lit(False))).alias("good")).withColumn(
        "apart", F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0), "quality-labels")
    taught = labelled(docs, materialise(known.where("not apart").select("doc_id", "good"), "quality-taught"))
    found = materialise(scored(docs, taught).withColumn(
        "gain", F.log(F.col("perplexity") / F.col("mixed"))).drop("mixed"), "quality-scores")
    limit = lambda x: F.percentile_approx(x, quantile, 10_000)
    limits = found.join(known.where("good"), "doc_id").where("perplexity is not null").groupBy("lang").agg(*[
        F.coalesce(limit(F.when(F.col("apart"), F.col(c))), limit(F.col(c))).alias(name)
        for c, name in (("perplexity", "threshold"), ("gain", "most_gain"))])
    return found.join(limits, "lang", "left").withColumn("keep", F.coalesce(
        (F.col("perplexity") <= F.col("threshold")) & F.coalesce(F.col("gain") <= F.col("most_gain"), F.lit(True)), F.lit(False)))


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """(doc_id, lang, perplexity, threshold, keep): trusted are the documents that
    ``labels`` calls of quality 1 and not toxic, rejected the other labelled ones.
    Four fifths of either (by a hash of doc_id) are counted; the trusted ones that
    no model has seen give each language's ``quantile`` of perplexity, the threshold,
    and of the gain of the model with rejected text, which a kept document may not
    exceed either.  A language whose trusted documents were all counted takes the
    quantiles of those.  Rows without perplexity or threshold aren't kept."""
    return judged(docs, labels, quantile).select("doc_id", "lang", "perplexity", "threshold", "keep")

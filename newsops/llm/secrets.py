"""Secret scans: fixed patterns, and character Markov models of random strings
and of ordinary identifiers compared by log-likelihood ratio.

DataFrame functions only.  The models are trained from labelled samples: values
that the fixed patterns found are random strings; ordinary are the words, dates,
numbers, paths and joined names of the other runs, digits included.  Training
reads a bounded sample (``train_docs`` different texts, the least by hash);
scanning reads every text whole."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from newsops.session import materialise

# The patterns of the base spans.
ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
          r"[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
          r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "markov"]
LEAST_VALUE = 6

#: A candidate of the models: a run that identifiers and random strings share.
RUN = r"[A-Za-z0-9+/_=-]{16,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
WIDE = len(ALPHABET)
TRAIN_DOCS = 2000
SAMPLE_FILES = 16
#: Weight, in pairs, of a character's own frequency in the pairs' probabilities.
BLEND = 20.0
#: Letters and digits mixed as in keys; names end in digits or have them by themselves.
MIXED = "[A-Za-z][0-9]+[A-Za-z]|[0-9][A-Za-z]+[0-9]"
#: Share of random runs that may fall below the threshold, where the classes allow it.
MISSED = 0.05


def shapes() -> list[str]:
    """Labelled ordinary runs with digits, capitals and joined words, for corpora
    that have few: dates, numbers, paths, versions, constants, camel case."""
    words = ("annual report article title user session handler value config index connection pool size max min count file name "
             "page image build release version test data model server client request response order item state error event "
             "key list table query result source target time date year month update delete create read write").split()
    at = lambda i: words[i * 7 % len(words)]
    out = []
    for i in range(240):
        a, b, c = at(i), at(i + 11), at(3 * i + 5)
        year, month, day, n = 1990 + i * 17 % 41, 1 + i * 5 % 12, 1 + i * 11 % 28, i * 7919 * 104_729 % 10 ** 9
        out += [f"{year}-{month:02}-{day:02}", f"{year}/{month:02}/{day:02}/{a}-{b}-{c}", f"{a}-{b}-{year}-q{1 + i % 4}",
                f"{a}_{b}_{c}_{n % 10 ** (1 + i % 6)}", f"{year}{month:02}{day:02}", f"{year}-{month:02}-{day:02}/{year}-{1 + i % 12:02}-{1 + i % 28:02}",
                f"{n:09}{n * 31 % 10 ** 7:07}", f"{a}_{b}_{c}".upper(), f"{a}_{b}_{i % 100}".upper(), f"{a}{b.title()}{c.title()}{i % 10}",
                f"{a}{b.title()}{c.title()}", f"{a.title()}{b.title()}", f"{a}-v{i % 12}-{i % 7}-{i % 10}", f"/{a}/{b}/{n % 10 ** (1 + i % 8)}",
                f"{n % 1000:03}-{n % 10_000:04}", f"{a}={n % 10 ** (1 + i % 5)}", f"{a}{i % 100}/{b}{i % 10}"]
    return out


def found(text: Column, pattern: str, kind: str) -> Column:
    """Matches in order: array of (first, kind, end, value), in code points.

    What lies between the matches gives their places: a piece, a match, a piece."""
    values = F.regexp_extract_all(text, F.lit(pattern), 0)
    step = "struct<at:int,spans:array<struct<first:int,kind:int,end:int,value:string>>>"
    # split() keeps the pieces before each match and the one after the last.
    pieces = F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.slice(pieces, 1, F.size(values)).alias("piece"), values.alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(
        "array<struct<first:int,kind:int,end:int,value:string>>").alias("spans")).cast(step)

    def add(state, x):
        first = state["at"] + F.length(x["piece"])
        end = first + F.length(x["value"])
        span = F.struct(first.alias("first"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"),
                        x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    none = F.array().cast("array<struct<first:int,kind:int,end:int,value:string>>")
    return F.when(F.regexp_like(text, F.lit(pattern)), F.aggregate(pairs, start, add, lambda s: s["spans"])).otherwise(none)


def base_spans(text: Column) -> Column:
    """Spans of the three fixed patterns; an assignment with a value of under six
    characters takes its place but is dropped."""
    value = lambda s: F.regexp_extract(s["value"], ASSIGN, 2)
    assign = F.filter(found(text, ASSIGN, "assign"), lambda s: F.length(value(s)) >= LEAST_VALUE)
    return F.concat(assign, found(text, ACCESS, "access"), found(text, HEX, "hex"))


def code(s: Column, i: Column) -> Column:
    """Index in ALPHABET of the character at ``i``, from 1."""
    return F.call_function("instr", F.lit(ALPHABET), F.substring(s, i, F.lit(1))) - 1


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple[list[float], float] | None:
    """Log-likelihood ratio random : ordinary of each pair of characters (row:
    the first), smoothed by how common the second is, and the mean ratio per
    character (nats) from which a run is random; ``train_docs`` hashes and at most
    2 * 66 * 66 counts reach the driver.

    A fifth of the runs (by hash) is not counted: the threshold lies halfway between
    the 99.9 % quantile of the ordinary ones and the MISSED quantile of the random
    ones, or at the former if that is above.
    None if either class has no sample."""
    hashed = docs.select("text", F.xxhash64("text").alias("h")).where("text is not null")
    # Only distinct hashes are ordered; of a text with copies one is taken.
    least = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(train_docs).collect()]
    if not least:
        return None
    some = hashed.where(F.col("h") <= least[-1]).groupBy("h").agg(F.first("text").alias("text"))
    spans = some.select("text", base_spans(F.col("text")).alias("spans"))
    secret = F.transform("spans", lambda s: F.when(s["kind"] == 0, F.regexp_extract(s["value"], ASSIGN, 2)).otherwise(s["value"]))
    # Ordinary: runs that no pattern found, digits or not.  Those that look like
    # keys (letters and digits mixed within a piece) may be secrets unfound.
    plain = F.filter(F.regexp_extract_all("text", F.lit(RUN.replace("16", "4")), 0),
                     lambda r: ~F.exists("spans", lambda s: F.contains(s["value"], r)) & ~r.rlike(MIXED))
    samples = spans.select(F.explode(F.concat(
        F.transform(secret, lambda v: F.struct(F.lit(1).alias("random"), F.regexp_replace(v, "[^A-Za-z0-9+/_=-]", "").alias("run"))),
        F.transform(plain, lambda v: F.struct(F.lit(0).alias("random"), v.alias("run"))),
        # Names in capitals are as ordinary as others.
        F.transform(plain, lambda v: F.struct(F.lit(0).alias("random"), F.upper(v).alias("run"))))).alias("x"))
    # Of a bounded number of texts: a file for each partition of the shuffle would be mostly empty ones.
    samples = materialise(samples.withColumn("apart", F.pmod(F.xxhash64(F.lower("x.run")), F.lit(5)) == 0).coalesce(SAMPLE_FILES), "secrets-samples")
    pairs = samples.where("not apart").select("x.random", F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.length("x.run") - 1, F.lit(1))),
        lambda i: F.struct(F.substring("x.run", i, F.lit(1)).alias("a"), F.substring("x.run", i + 1, F.lit(1)).alias("b")))).alias("p"))
    rows = pairs.where("length(p.b) = 1").groupBy("random", "p.a", "p.b").count().collect()
    counts = [[[0.0] * WIDE for _ in range(WIDE)] for _ in range(2)]
    for r in rows:
        counts[r["random"]][ALPHABET.index(r["a"])][ALPHABET.index(r["b"])] += r["count"]
    if {r["random"] for r in rows} != {0, 1}:
        return None
    held = []
    for i, run in enumerate(shapes()):
        if i // 17 % 5 == 0:
            held.append(run)
            continue
        for x, y in zip(run, run[1:]):
            counts[0][ALPHABET.index(x)][ALPHABET.index(y)] += 1.0
    single = [[1.0 + sum(row[b] for row in counts[k]) for b in range(WIDE)] for k in (0, 1)]
    chance = [[x / sum(line) for x in line] for line in single]
    logp = lambda k, a, b: math.log((counts[k][a][b] + BLEND * chance[k][b]) / (sum(counts[k][a]) + BLEND))
    ratio = [logp(1, a, b) - logp(0, a, b) for a in range(WIDE) for b in range(WIDE)]
    mean = lambda run: sum(ratio[ALPHABET.index(a) * WIDE + ALPHABET.index(b)] for a, b in zip(run, run[1:])) / (len(run) - 1)
    long = samples.where("apart and length(x.run) >= 16").select("x.random", mean_ratio(F.col("x.run"), ratio).alias("m"))
    seen = long.agg(F.percentile_approx(F.when(F.col("random") == 0, F.col("m")), 0.999).alias("plain"),
                    F.percentile_approx(F.when(F.col("random") == 1, F.col("m")), MISSED).alias("random")).first()
    plain = max([mean(r) for r in held if len(r) >= 16] + [x for x in [seen["plain"]] if x is not None])
    return ratio, plain + 1e-6 if seen["random"] is None else max(plain + 1e-6, (plain + seen["random"]) / 2)


def mean_ratio(run: Column, ratio: list[float]) -> Column:
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratio)), ",").cast("array<double>")
    pairs = F.sequence(F.lit(1), F.length(run) - 1)
    score = F.aggregate(pairs, F.lit(0.0), lambda a, i: a + F.get(table, code(run, i) * WIDE + code(run, i + 1)))
    return score / (F.length(run) - 1)


def markov_spans(text: Column, ratio: list[float], least: float) -> Column:
    """Runs whose mean ratio reaches ``least``."""
    return F.filter(found(text, RUN, "markov"), lambda s: mean_ratio(s["value"], ratio) >= least)


def scan(docs: DataFrame, train_docs: int = TRAIN_DOCS, least: float | None = None) -> DataFrame:
    """``docs`` with _spans: array of (first, kind, end, value), ordered, ends
    exclusive, in code points; kind indexes KINDS.

    Spans of different kinds may overlap; a model's span that touches one of the
    fixed patterns is dropped.  Null and empty texts have none.  Without samples
    of both classes there are no model spans.  ``least`` replaces the threshold
    learned from held-out runs.  An older _spans is replaced."""
    text = F.coalesce("text", F.lit(""))
    model = train(docs, train_docs)
    base = docs.withColumn("_spans", base_spans(text))
    if model is not None:
        more = F.filter(markov_spans(text, model[0], model[1] if least is None else least), lambda m: ~F.exists(
            "_spans", lambda s: (s["first"] < m["end"]) & (m["first"] < s["end"])))
        base = base.withColumn("_spans", F.concat("_spans", more))
    return base.withColumn("_spans", F.array_sort("_spans"))


def told(spans: Column) -> Column:
    """kind:first:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["first"].cast("string"), s["end"].cast("string"))), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """The contract's columns of scan()'s rows."""
    n = lambda k: F.size(F.filter("_spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("_spans", lambda s: s["kind"] < 3)
    return scanned.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                          F.sha2(told(base), 256).alias("base_sha256"), told(F.col("_spans")).alias("spans"))


def masked(scanned: DataFrame, mask: str = "<secret>") -> DataFrame:
    """The documents with each stretch of spans replaced by ``mask``; null texts
    stay null."""
    cut = F.aggregate("_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), lambda s, x: F.struct(
        F.greatest(s["at"], x["end"]).alias("at"),
        F.when(x["first"] < s["at"], s["out"]).otherwise(
            F.concat(s["out"], F.substring("text", s["at"] + 1, x["first"] - s["at"]), F.lit(mask))).alias("out")),
        lambda s: F.concat(s["out"], F.substring("text", s["at"] + 1, F.length("text"))))
    return scanned.withColumn("text", F.when(F.size("_spans") > 0, cut).otherwise(F.col("text"))).drop("_spans")

"""The operators of newsops.llm and the pipeline, against plain Python."""
import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from newsops.llm import (decontaminate as DC, graph, jaccard as JJ, langid as LI, mixture as MX, neighbours as NN,
                         passages as PS, quality as QL, queries as Q, secrets as SE, suffixes as SF, tokens as TK, words as W)
from tests.oracle_check import compare, connect

DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def odd(spark):
    """Nulls, blanks, repeats, ties, a long text, and columns whose names clash."""
    body = " ".join(f"word{i}é" for i in range(120))
    rows = [(1, body, "en", "a", 1), (2, body, "en", "a", 1), (2, body, "en", "a", 1), (3, None, None, None, None),
            (4, "", "en", None, 0), (None, body, "fr", "b", 1), (5, "  \n\t ", "fr", "b", 1), (6, "x " * 60_000, "fr", "b", 1),
            (7, body[:700] + " tail of its own", None, "a", 1), (8, "ends " + body[200:], "en", "c", 1), (9, "12 34 !!", "en", "c", 1)]
    df = spark.createDataFrame(rows, DOCS)
    for name in ("_hits", "_spans", "_times", "_lang", "doc", "rid", "runs", "n", "a", "key", "size", "spans", "h"):
        df = df.withColumn(name, F.lit("taken"))
    return df


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").cache()


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_equals_sql(spark, name):
    assert compare(Q.QUERIES[name](spark, DIR), connect(DIR), Q.SQL[name]) is None


@pytest.mark.parametrize("empty", [True, False])
def test_operators_take_odd_tables(spark, empty):
    df = odd(spark).where("1 = 0") if empty else odd(spark)
    n = df.count()
    bench = spark.createDataFrame([(1, "12 34"), (2, None), (3, ""), (None, "tail of its own")], "item_id long, text string")
    assert DC.digest(DC.decontaminate(df, bench)).count() == n
    assert SE.digest(SE.scan(df)).count() == n
    assert MX.mix(df).count() == n
    assert LI.identify(df, LI.fit(df)).count() == n
    assert PS.deduplicate(df).count() == n
    assert SF.deduplicate(df).count() == n
    assert JJ.join(df).count() == n
    assert QL.classify(df, df.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))).count() >= n
    assert (TK.suffix_sums(TK.lengths(df)).agg(F.sum("n_docs")).first()[0] or 0) == n


def targets(sizes, share=1.5, most=2.0):
    """Water filling, one full source at a time."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= most * sizes[s]}
        for s in full or set(open_):
            out[s] = most * sizes[s] if full else weight[s] * level
            left -= out[s] if full else 0
        open_ -= full or set(open_)
    return out


def test_mix_meets_targets(spark, docs):
    rows = MX.mix(docs).collect()
    sizes = Counter()
    for r in docs.collect():
        sizes[r["source"]] += len(words(r["text"]))
    want, taken = targets(sizes), Counter()
    for r in rows:
        assert r["taken"] <= 2 * r["size"] and abs(r["target"] - want[r["source"]]) < 1e-6
        taken[r["source"]] += r["taken"]
    for s in want:
        assert abs(taken[s] - want[s]) <= max(x["size"] for x in rows if x["source"] == s) / 2
    assert sorted(map(str, rows)) == sorted(map(str, MX.mix(docs.repartition(7)).collect()))


def test_pareto_draws_by_inclusion_odds(spark):
    df = spark.range(40_000).select("id", F.lit("g").alias("g"), F.lit(1).alias("size"),
                                    F.when(F.col("id") % 2 == 0, 1.2).otherwise(0.6).alias("copies"))
    got = {r[0]: r[1] for r in MX.pareto(df, "g", "size", "copies", "id", band=500).groupBy(F.col("id") % 2).agg(F.avg("_times")).collect()}
    assert abs(got[0] - 1.2) < 0.02 and abs(got[1] - 0.6) < 0.02


def test_secrets_base_spans(spark):
    texts = ["password=abc", "secret=token: abcdefgh", "PassWord : \"x/y+z=12\" api-key api_key=abcdef AKIA" + "Z9" * 9,
             "é token = 'ffffffffffffffffffffffff0' " + "0123456789abcdef" * 2, "AKIAshort deadbeef", "Zq3" * 9]
    found = SE.digest(SE.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()
    assign = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for r in found:
        t = texts[r["doc_id"]]
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if m.end() - m.start() >= 24]
        told = ",".join(f"{SE.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert r["base_sha256"] == sha(told)
        assert set(filter(None, told.split(","))) <= set(r["spans"].split(","))


def test_markov_model_tells_random_runs(spark):
    rng = np.random.default_rng(3)
    letters = list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
    key = lambda n: "".join(rng.choice(letters, n))
    name = lambda: "_".join(rng.choice(["user", "session", "handler", "config", "value", "total"], 4))
    texts = [f"token={key(30)} {name()} {name()} set" for _ in range(200)] + [f"{name()} then {key(32)}"]
    r = SE.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).where("doc_id = 200").first()
    assert [SE.KINDS[s["kind"]] for s in r["_spans"]] == ["markov"]
    assert r["_spans"][0]["value"] == texts[200].split()[-1]
    masked = SE.masked(SE.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).where("doc_id = 200").first()
    assert masked["text"] == texts[200].split()[0] + " then <secret>"


def test_identifiers_with_digits_are_no_secrets(spark, docs):
    names = ["annual-report-2024-q3", "2024/01/15/some-article-title", "user_session_handler_123456", "2024-01-15/2024-02-20",
             "MAX_CONNECTION_POOL_SIZE", "4465758382889437", "getUserSessionHandler2", "release-v2-10-3-candidate"]
    rng = np.random.default_rng(4)
    key = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), n))
    few = [f"token={key(30)} user_session_handler config_value_total set" for _ in range(200)]
    keys = [key(32) for _ in range(20)]
    found = []
    for other in (spark.createDataFrame([(x,) for x in few], "text string"), docs.select("text")):
        df = spark.createDataFrame([(i, x) for i, x in enumerate(names + keys)], "doc_id long, text string")
        spans = {r["doc_id"] for r in SE.digest(SE.scan(df.unionByName(other.withColumn("doc_id", F.lit(None).cast("long"))))).where(
            "doc_id is not null and spans <> ''").collect()}
        assert [names[i] for i in spans if i < len(names)] == []
        found.append(len(spans))
    assert found[0] >= 18


def test_secret_models_learn_from_different_texts(spark):
    rng = np.random.default_rng(6)
    key = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz0123456789"), n))
    df = spark.createDataFrame([(f"token={key(30)} user_session_handler config_value",) for _ in range(40)], "text string")
    # Copies, of the text with the least hash, that have no sample of random strings.
    first = min((r["h"], r["text"]) for r in spark.range(2000).select(F.concat(F.lit("plain words "), "id").alias("text")).select(
        "text", F.xxhash64("text").alias("h")).collect())[1]
    copies = spark.range(300).select(F.lit(first).alias("text"))
    assert SE.train(df.unionAll(copies), 60) is not None
    some, all_ = SE.train(df.unionAll(copies), 60), SE.train(df.unionAll(copies.limit(1)), 60)
    assert np.allclose(some[0], all_[0]) and abs(some[1] - all_[1]) < 1e-9


def test_secret_samples_are_few_files(spark, monkeypatch):
    written, real = [], SE.materialise
    monkeypatch.setattr(SE, "materialise", lambda df, name: written.append(df.rdd.getNumPartitions()) or real(df, name))
    docs = spark.range(300).select(F.concat(F.lit("user_session_handler token="), F.sha1(F.col("id").cast("string"))).alias("text"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "48")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert SE.train(docs) is not None
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert written == [SE.SAMPLE_FILES]


def test_language_spans_and_held_out_accuracy(spark, docs):
    df = docs.withColumn("held", LI.held_out("doc_id"))
    model = LI.fit(df.where("not held"))
    rows = LI.identify(df, model).where("held").select("lang", "_lang").collect()
    assert sum(a == b for a, b in rows) >= 0.9 * len(rows)
    two = {r["lang"]: r["text"] for r in docs.where("length(text) between 600 and 3000").collect()}
    mixed = spark.createDataFrame([(1, two["en"] + "\n" + two["de"])], "doc_id long, text string")
    spans = [s["lang"] for s in LI.identify(mixed, model).first()["_spans"]]
    assert spans[0] == "en" and spans[-1] == "de"


def test_long_texts_take_the_best_path_through_their_blocks():
    rng = np.random.default_rng(5)
    for langs, sizes in ((1, [3, 70]), (3, [0, 1, LI.BLOCK, LI.BLOCK + 1, 300]), (5, [2 * LI.BLOCK, 7, 0, 411])):
        bounds = np.cumsum([0, *sizes])
        scores = rng.normal(0, 3, (bounds[-1], langs))
        got = LI.viterbi(scores, bounds, 4.0)
        for first, end in zip(bounds, bounds[1:]):
            if first == end:
                continue
            value = [(x, [k]) for k, x in enumerate(scores[first])]
            for line in scores[first + 1:end]:
                value = [max((v - 4.0 * (path[-1] != k) + line[k], [*path, k]) for v, path in value) for k in range(langs)]
            assert got[first:end].tolist() == max(value)[1]


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    counts = [0, 1, 7, 4, 0, 9]
    bounds = np.cumsum([0] + counts)
    scores = rng.normal(0, 4, (bounds[-1], 3)).astype(np.float32)
    label = LI.viterbi(scores, bounds, 3.0)
    for a, b in zip(bounds, bounds[1:]):
        paths = np.stack(np.meshgrid(*[range(3)] * int(b - a), indexing="ij"), -1).reshape(-1, b - a) if b > a else np.zeros((1, 0), int)
        value = lambda p: scores[np.arange(a, b), p].sum() - 3.0 * (np.diff(p) != 0).sum()
        assert value(label[a:b]) >= max(map(value, paths)) - 1e-4


def test_token_histogram(spark, docs):
    import base64

    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(TK.VOCABULARY, "rb"))}
    enc = tiktoken.Encoding("t", pat_str=TK.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sizes = sorted(len(enc.encode_ordinary(r["text"])) for r in docs.collect())
    sums = TK.suffix_sums(TK.lengths(docs)).cache()
    for limit in (0, 1, 50, 333, 10**6):
        assert tuple(TK.at_limit(sums, limit).first()) == (sum(sizes), sum(min(s, limit) for s in sizes))
    assert TK.quantile(sums, 0.5).first()[0] == sizes[(len(sizes) + 1) // 2 - 1]


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(2)
    for text in (b"", b"a", b"banana" * 5, b"a" * 50, bytes(rng.integers(97, 99, 3000).astype(np.uint8)), b"abc" * 400 + b"abd" * 300):
        data = np.frombuffer(text, np.uint8)
        order = SF.suffix_array(data)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        shared = SF.common_prefixes(data, order, 40, lanes=7)
        for k in range(1, len(text)):
            x, y = text[order[k - 1]:][:40], text[order[k]:][:40]
            assert shared[k] == next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


@pytest.mark.parametrize("shard", [SF.SHARD_BYTES, 2000])
def test_suffix_dedup(spark, docs, shard):
    both = docs.select("doc_id", "text").unionAll(odd(spark).select(F.col("doc_id") + 10**6, "text"))
    both = both.unionAll(docs.where("length(text) > 900").select(F.col("doc_id") + 10**7, F.expr("substring(text, 100, 700)")))
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in both.collect()]
    seen = Counter(t[i:i + 400] for _, t in rows for i in range(len(t) - 399))
    want = Counter()
    for i, t in rows:
        gone = W.covered(np.array([k for k in range(len(t) - 399) if seen[t[k:k + 400]] > 1], np.int64), 400, len(t))
        want[i, len(t), int(gone.sum()), len(W.runs(gone)[0]), sha(np.frombuffer(t, np.uint8)[~gone].tobytes())] += 1
    got = SF.deduplicate(both, shard_bytes=shard).withColumn("k", F.coalesce(F.size("spans"), F.lit(0))).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["k"], r["kept_sha256"]) for r in got) == want


def test_passage_dedup_on_odd_rows(spark):
    rows = odd(spark).select("doc_id", "text").collect()
    first = {}
    for r in rows:
        w = words(r["text"])
        for i in range(len(w) - 49) if r["doc_id"] is not None else ():
            k = tuple(w[i:i + 50])
            first[k] = min(first.get(k, r["doc_id"]), r["doc_id"])
    want = Counter()
    for r in rows:
        w, d = words(r["text"]), r["doc_id"]
        hit = [i for i in range(len(w) - 49) if d is not None and first[tuple(w[i:i + 50])] < d]
        gone = W.covered(np.array(hit, np.int64), 50, len(w))
        want[d, len(w), int(gone.sum()), sha(" ".join(x for x, g in zip(w, gone) if not g))] += 1
    got = PS.deduplicate(odd(spark)).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == want


def test_times_from_the_boundaries_of_a_mix(spark, docs):
    rows = docs.select("doc_id", "source", "text").unionAll(odd(spark).where("doc_id is not null").select(F.col("doc_id") + 10**6, "source", "text"))
    rows = rows.unionAll(rows.where("source is not null").select(F.col("doc_id") + 10**7, F.lit(None).cast("string"), "text"))
    mixed = MX.mix(rows).cache()
    want = {(r["doc_id"]): r["t"] for r in mixed.groupBy("doc_id").agg(F.max("_times").alias("t")).collect()}
    got = MX.with_times(rows, MX.boundaries(mixed), "doc_id").collect()
    assert len(got) == rows.count() and all(r["times"] == want[r["doc_id"]] for r in got)
    assert {r["times"] for r in got} > {1}


def shingles(text):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_jaccard_components(spark, docs):
    rng = np.random.default_rng(5)
    base, near = [f"w{i}" for i in range(200)], []
    for i in range(150):  # near copies of one text, most of them linked only through others
        w = list(base)
        for j in rng.choice(200, int(rng.integers(0, 9)), replace=False):
            w[j] = f"x{i}"
        near.append((5000 + i, " ".join(w)))
    both = docs.select("doc_id", "text").unionAll(spark.createDataFrame(near, "doc_id long, text string"))
    rows = {r["doc_id"]: shingles(r["text"]) for r in both.collect()}
    root = {i: i for i in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids, degree = sorted(rows), {}
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            a, b = rows[i], rows[j]
            if a and b and 100 * min(len(a), len(b)) >= 80 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                i_, j_ = sorted((find(i), find(j)))
                root[j_] = i_
                degree.setdefault(a, set()).add(b)
                degree.setdefault(b, set()).add(a)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in JJ.join(both).collect()}
    assert got == {i: (len(rows[i]), find(i)) for i in ids}
    # Links between different sets, each counted.
    got = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in JJ.join(both, count_links=True).collect()}
    assert got == {i: (find(i), len(degree.get(rows[i], set()) - {rows[i]})) for i in ids}


def test_jaccard_near_misses_of_a_large_component_make_no_pairs(spark):
    rng = np.random.default_rng(3)
    far = lambda: [int(x) for x in rng.integers(-1 << 62, 1 << 62, JJ.FOLDS)] + [0] * (JJ.BITS // 64 - JJ.FOLDS)
    none = [0] * (JJ.BITS // 64)
    rows = [(d, none) for d in range(1, 41)] + [(d, far()) for d in range(101, 121)] + [(200, none)]
    classes = spark.createDataFrame([(d, 20, bits) for d, bits in rows], "doc long, n long, bits array<bigint>")
    held = spark.createDataFrame([(7, d, 20, 1, 1, 20) for d, _ in rows], "token long, doc long, n long, asked long, hub long, hub_n long")
    known = spark.createDataFrame([(d, 1) for d in range(1, 41)], "node long, component long")
    got = {(r["a"], r["b"]) for r in JJ.candidates(held, known, classes).collect()}
    assert got == {(d, 200) for d in range(1, 41)}


def test_jaccard_near_misses_of_each_other_make_no_rows(spark):
    """Classes that share shingles but whose sketches forbid a link, each alone, and a
    pair that may link into a component of two: only that comes out of the first join."""
    rng = np.random.default_rng(4)
    far = lambda: [int(x) for x in rng.integers(-1 << 62, 1 << 62, JJ.FOLDS)]
    base = far()
    rows = [(d, d, 1, far()) for d in range(1, 61)] + [(200, 200, 2, base), (201, 200, 2, [base[0] ^ 5, *base[1:]]), (202, 202, 1, [base[0] ^ 3, *base[1:]])]
    live = spark.createDataFrame([(t, d, 20, 2, c, m, *f) for d, c, m, f in rows for t in (7, 8)],
                                 "token long, doc long, n long, asked long, component long, members long, f0 long, f1 long, f2 long, f3 long")
    got = sorted((r["token"], r["doc"], r["to"]) for r in JJ.meetings(live).collect())
    assert got == [(7, 202, 200), (8, 202, 200)]


@pytest.mark.parametrize("words_of_all", [0, 40])
def test_jaccard_components_of_many_small_groups(spark, words_of_all):
    """Groups at and around the threshold, chained, some with a passage that all texts share."""
    rng = np.random.default_rng(9)
    common, rows = [f"c{i}" for i in range(words_of_all)], []
    for g in range(60):
        base = [f"g{g}w{i}" for i in range(int(rng.integers(3, 150)))]
        for _ in range(int(rng.integers(1, 6))):
            w = list(base)
            for j in rng.integers(0, len(w), int(rng.integers(0, 1 + len(w) // 30))):
                w[j] = f"y{len(rows)}"
            base = w if rng.random() < 0.5 else base
            rows.append((len(rows), " ".join(common + w)))
    sets = [shingles(t) for _, t in rows]
    links = {i: [j for j in range(len(rows)) if i != j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])] for i in range(len(rows))}
    want = {}
    for i in links:
        if i not in want:
            todo = [i]
            while todo:
                j = todo.pop()
                if j not in want:
                    want[j] = i
                    todo += links[j]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in JJ.join(df).collect()} == want


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    got = dict(graph.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 160)}


def test_neighbours_recall_ties_and_odd_vectors(spark):
    e = spark.read.parquet(f"{DIR}/embeddings.parquet").select("vec_id", "embedding")
    rows = {r[0]: np.array(r[1], float) for r in e.collect()}
    ids = np.array(sorted(rows))
    x = np.array([rows[i] / np.linalg.norm(rows[i]) for i in ids])
    got, hits, n = NN.search(e, e.where("vec_id % 50 = 0")).collect(), 0, 0
    for q in ids[ids % 50 == 0]:
        s = x @ (rows[q] / np.linalg.norm(rows[q]))
        best = [i for i in ids[np.lexsort((ids, -s))] if i != q][:5]
        mine = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == q)
        hits, n = hits + len(set(best) & {v for _, v in mine}), n + 5
    assert hits >= 0.9 * n
    odd_rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]),
                (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, []), (50, [2.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame(odd_rows, "vec_id long, embedding array<double>")
    got = NN.search(df, df.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 50), (50, 1, 0), (50, 2, 1), (50, 3, 2)]
    assert NN.search(df.where("1 = 0"), df.where("1 = 0")).count() == 0


def test_neighbours_score_only_what_may_be_best(monkeypatch):
    """Over many batches few of the pairs in shared buckets are scored, and the best come out as by brute force."""
    from types import SimpleNamespace

    import pyarrow as pa

    rng = np.random.default_rng(8)
    x = rng.normal(size=(6000, 16))
    x[:40] *= 1e-155  # squares lose digits
    rotations, scored, real = NN.Rotations(16, 16), [], NN.best
    block = SimpleNamespace(value=NN.Queries([(i, x[i].tolist()) for i in range(0, 6000, 100)], 16, rotations, 16))
    monkeypatch.setattr(NN, "best", lambda q, v, s, k: scored.append(len(q)) or real(q, v, s, k))
    batches = [pa.RecordBatch.from_arrays([pa.array(range(i, i + 1000)), pa.array(x[i:i + 1000].tolist())], names=["vec_id", "embedding"])
               for i in range(0, 6000, 1000)]
    (out,) = NN.searcher(block, rotations, 5)(batches)
    unit = x / np.abs(x).max(1)[:, None]
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    got = out.to_pandas()
    for q in range(100, 6000, 100):
        s = unit @ unit[q]
        s[q] = -2
        assert set(got[got["query_id"] == q]["vec_id"]) == set(np.argsort(-s)[:5])
    assert sum(scored) < 60 * 6000 // 5


def test_quality_drops_junk_and_sums_to_one(spark, docs):
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    rows = QL.classify(docs, labels).join(labels, "doc_id").collect()
    good = [r for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    bad = [r for r in rows if r["quality"] == 0]
    assert sum(r["keep"] for r in good) >= 0.9 * len(good) and sum(r["keep"] for r in bad) <= 0.3 * len(bad)
    grams = spark.createDataFrame([("l", g, c) for g, c in Counter("abracadabra"[i:i + 3] for i in range(9)).items()], "lang string, g string, c long")
    scorer = QL.Scorer(QL.model(grams, 3).toPandas(), 3)
    seen = sorted({g[-1] for g in Counter("abracadabra"[i:i + 3] for i in range(9))})
    for context in ("ab", "zz", "ra"):
        p = [np.exp(scorer.log_probabilities(np.array([ord(x) for x in context + c], np.uint32), np.array([2]))[0]) for c in seen + ["~"]]
        assert abs(sum(p) - 1) < 0.02


@pytest.mark.parametrize("given, most", [("10000", 1000), ("300", 300)])
def test_pipeline_sends_texts_in_small_batches(spark, docs, given, most):
    sizes = lambda batches: (b.select([]).from_pydict({"n": [b.num_rows]}) for b in batches)
    spark.conf.set(corpus_pipeline.BATCH, given)
    try:
        corpus_pipeline.language_id(spark, docs, DIR)
        got = spark.range(0, 2500, 1, 1).mapInArrow(sizes, "n long").collect()
        assert max(r["n"] for r in got) == most
    finally:
        spark.conf.unset(corpus_pipeline.BATCH)


def test_quality_labels_go_to_the_texts(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e"), (9, None)], "doc_id long, text string")
    known = spark.createDataFrame([(1, True), (2, False), (9, True), (4, True)], "doc_id long, good boolean")
    want = [(1, "a", True), (1, "b", True), (2, "c", False), (9, None, True)]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for many labels
    try:
        for block_rows in (10, 2, 1):
            got = QL.labelled(docs, known, block_rows)
            assert sorted(((r["doc_id"], r["text"], r["good"]) for r in got.collect()), key=str) == want
            assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("block_bytes", [DC.BLOCK_BYTES, 40])
def test_decontamination_holds_one_python_worker_a_task(spark, block_bytes):
    item = "one two three four five six seven eight nine ten"
    rows = [(1, f"É before, {item} after!", "x"), (2, item.upper(), "x"), (2, f"{item} ten {item}", "x"), (3, None, "x"), (4, "", "x"),
            (5, "??", None), (None, f"{item}; tail tail", "x"), (6, "tail tail", "x"), (6, "tail tail", "x"), (7, "short item of test", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _hits string").withColumn("more", F.array(F.lit(1.5)))
    bench = spark.createDataFrame([(1, item), (2, "short item"), (3, ""), (None, "tail")], "item_id long, text string")
    found = DC.decontaminate(docs, bench, block_bytes=block_bytes)
    hit = F.aggregate(DC.HITS, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["first"])
    want = DC.cut(found.where((hit < F.col(DC.COUNT)) | (F.size(DC.HITS) == 0)))
    got = DC.cleaned(docs, bench, block_bytes=block_bytes)
    assert got.schema == want.schema and got.count() == 6
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    workers = lambda df: df._jdf.queryExecution().executedPlan().toString().count("MapInArrow")
    assert workers(got) == workers(found)
    stage = corpus_pipeline.decontamination(spark, spark.read.parquet(f"{DIR}/documents.parquet"), DIR)
    assert workers(stage) == 1


def test_quality_counts_both_kinds_in_one_pass(spark):
    taught = spark.createDataFrame([("aab", "l", True), ("ab", "l", False), (None, "l", True), ("x", None, False)], "text string, lang string, good boolean")
    got = {(r["lang"], r["g"].replace(QL.START, "^")): (r["good"], r["c"]) for r in QL.counted(taught, 2).collect()}
    assert got == {("l", "^a"): (1, 2), ("l", "aa"): (1, 1), ("l", "ab"): (1, 2), ("", "^x"): (0, 1)}


def test_quality_keeps_its_order_at_every_size(spark, docs):
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    trusted = docs.join(labels.where("quality = 1"), "doc_id", "left_semi")
    some = docs.select("doc_id", "text", "lang").unionAll(spark.createDataFrame(
        [(None, "a b", "en"), (None, "a b", "en"), (-1, None, "en"), (-2, "", "en"), (-3, "a b", "xx")], "doc_id long, text string, lang string"))
    tell = lambda **k: sorted(((r["doc_id"] or 0, r["lang"], r["perplexity"] or 0) for r in QL.score(some, trusted, **k).collect()))
    one, many, short = tell(), tell(shard_rows=20_000), tell(order=4)
    assert len(one) == len(many) == some.count()
    assert all(a[:2] == b[:2] and abs(a[2] - b[2]) <= 1e-4 * a[2] for a, b in zip(one, many))
    assert sum(abs(a[2] - b[2]) > 1e-3 * a[2] for a, b in zip(one, short)) > 100


def test_quality_weights_travel_without_their_table(spark):
    import pickle

    rng = np.random.default_rng(5)
    h = rng.integers(1, 1 << 62, 50_000).astype(np.uint64)
    w = rng.normal(size=len(h)).astype(np.float32)
    keyed = spark.createDataFrame(list(zip(h.view(np.int64).tolist(), w.tolist())), "h long, w double")
    some, weights = QL.gathered(keyed, 7_000)
    assert sorted(zip(some.tolist(), weights.tolist())) == sorted(zip(h.tolist(), w.tolist()))
    scorer = QL.Scorer.shard(some, weights, 5)
    sent = pickle.dumps(scorer, 5)
    assert len(sent) < 13 * len(h)
    there = pickle.loads(sent)
    assert (there.get(h) == w).all() and (there.get(h + np.uint64(1)) == 0).all()
    none, _ = QL.gathered(keyed.where("1 = 0"))
    assert len(none) == 0


def test_quality_looks_a_window_up_once(monkeypatch):
    asked = []

    class Counting(QL.Scorer):
        def get(self, h):
            asked.append(len(h))
            return super().get(h)

    rng = np.random.default_rng(7)
    texts = ["".join(rng.choice(list("abcé \U0001F600"), 3_000)) for _ in range(4)]
    points, real = QL.padded(texts, 5)
    ends = np.flatnonzero(real)
    which = np.repeat([0, 1, 0, 1], 3_000)
    seeds = [np.array([QL.seed(kind + lang) for lang in ("de", "en")], np.uint64)[which] for kind in ("", QL.MIXED)]
    known = np.unique(np.concatenate([QL.hashes(points, ends, k, s) for k in (1, 2, 5) for s in seeds]))[::2]
    weights = rng.normal(size=len(known)).astype(np.float32)
    for bits in (16, 3):
        monkeypatch.setattr(QL, "RECENT_BITS", bits)
        scorer = Counting.shard(known, weights, 5)
        asked.clear()
        want = np.stack([scorer.log_probabilities(points, ends, s) for s in seeds])
        direct = sum(asked)
        for _ in range(3):
            asked.clear()
            assert (scorer.remembered(points, ends, seeds) == want).all()
        assert sum(asked) <= (direct / 10 if bits == 16 else direct)


def test_quality_drops_toxic_prose_it_has_not_seen(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    seen = F.pmod(F.xxhash64("doc_id"), F.lit(5)) != 0
    rows = QL.classify(docs.select("doc_id", "text", "lang"), labels).withColumn("seen", seen).join(labels, "doc_id").collect()
    unseen = lambda q, t: [r["keep"] for r in rows if not r["seen"] and (r["quality"], r["toxic"]) == (q, t)]
    assert sum(unseen(1, 1)) <= 0.3 * len(unseen(1, 1)) and sum(unseen(1, 0)) >= 0.85 * len(unseen(1, 0))
    toxic = [r["keep"] for r in rows if r["toxic"] == 1]
    assert sum(toxic) <= 0.1 * len(toxic)


def test_decontaminate_in_blocks_and_cut(spark, docs):
    bench = spark.read.parquet(f"{DIR}/benchmark.parquet")
    one = sorted(map(str, DC.digest(DC.decontaminate(docs, bench)).collect()))
    assert one == sorted(map(str, DC.digest(DC.decontaminate(docs, bench, block_bytes=2000)).collect()))
    left = DC.cut(DC.decontaminate(docs, bench))
    assert left.count() == docs.count()
    assert left.join(docs.select("doc_id", F.col("text").alias("t")), "doc_id").where("text <> t").count() == DC.digest(
        DC.decontaminate(docs, bench)).where("contaminated").count()


def test_pipeline_stages(spark, docs):
    rows = docs
    benchmark = spark.read.parquet(f"{DIR}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, rows = rows, stage(spark, rows, DIR).cache()
        if name != "mixing":
            assert rows.columns == corpus_pipeline.COLUMNS
        texts = [r["text"] for r in rows.select("text").collect()]
        if name == "language ID":
            assert rows.count() >= 0.98 * before.count()
        elif name == "near duplicates":
            assert rows.count() == JJ.join(before).select("component_id").distinct().count() == len(set(texts))
        elif name == "decontamination":
            assert not DC.digest(DC.decontaminate(rows, benchmark)).where("contaminated").count()
        elif name == "secret scan":
            assert not any(re.search("AKIA[A-Z0-9]{16}|[0-9a-f]{24}", t) for t in texts) and rows.count() == before.count()
    assert rows.where("times < 1").count() == 0 and set(rows.columns) == {*corpus_pipeline.COLUMNS, "times"}


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
@pytest.mark.parametrize("empty", [True, False])
def test_stages_take_odd_tables(spark, stage, empty):
    df = odd(spark).where("1 = 0") if empty else odd(spark)
    assert stage(spark, df, DIR).count() <= df.count()

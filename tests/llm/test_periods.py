"""Periodic runs against plain Python."""
import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsops.llm import periods as PE, queries as Q
from tests.llm.test_llm import DIR, odd, words


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def brute(w, least=12):
    """Every lag's maximal stretches, the least period of each stretch of words."""
    runs = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            k = i
            while k + q < len(w) and w[k] == w[k + q]:
                k += 1
            if k > i and k - i + q >= max(least, 2 * q):
                runs.setdefault((i, k - i + q), q)
            i = max(k, i) + 1
    return sorted((a, n, q) for (a, n), q in runs.items())


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


@pytest.mark.parametrize("least", [1, 2, 3, 5, 12, 13, 20])
def test_runs_of_small_alphabets(least):
    rng = np.random.default_rng(least)
    docs = [[], ["x"], ["x"] * 11, ["x"] * 12, ["x"] * 13, ["x"] * 300, list("ab") * 40 + list("abc") * 40, fibonacci(400),
            [str(bin(i).count("1") % 2) for i in range(300)], list("aab" * 5 + "aac" * 5) * 4]
    for size in (1, 2, 2, 2, 3, 4):
        for _ in range(12):
            w = [str(x) for x in rng.integers(0, size, int(rng.integers(0, 90)))]
            k = int(rng.integers(1, 30))
            docs.append(w + w[-k:] * int(rng.integers(0, 5)) + [str(x) for x in rng.integers(0, size, 7)])
    names = {}
    ids = np.array([names.setdefault(x, len(names)) for w in docs for x in w], np.int64)
    bounds = np.cumsum([0] + [len(w) for w in docs])
    got = [[] for _ in docs]
    for a, n, q in zip(*(x.tolist() for x in PE.find(ids, bounds, least))):
        d = int(np.searchsorted(bounds, a, "right")) - 1
        got[d].append((a - int(bounds[d]), n, q))
    assert got == [brute(w, least) for w in docs]


def test_pairs_in_small_blocks_change_nothing(monkeypatch):
    ids = np.array([int(x == "a") for x in fibonacci(900)] + [1] * 500, np.int64)
    bounds = np.array([0, 900, 1400])
    one = [x.tolist() for x in PE.find(ids, bounds)]
    monkeypatch.setattr(PE, "BLOCK_PAIRS", 7)
    assert [x.tolist() for x in PE.find(ids, bounds)] == one


def expected(doc_id, text, plant=True):
    w = words(text)
    n = len(w)
    if plant and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    gone = {i for a, m, q in runs for i in range(a + q, a + m)}
    top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    return (doc_id, len(runs), *(((*top, 1000 * top[1] // top[2])) if top else (None,) * 4),
            sha("".join(f"{a},{m},{q}\n" for a, m, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_query_equals_plain_python(spark):
    rows = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()
    got = Q.QUERIES["op13_periodic_runs"](spark, DIR)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = {r["doc_id"]: tuple(r) for r in got.collect()}
    rows = [r for r in rows if len(words(r["text"])) < 4000]
    assert sum(got[r["doc_id"]][1] > 0 for r in rows) >= 10
    assert all(got[r["doc_id"]] == expected(*r) for r in rows)


@pytest.mark.parametrize("plant", [True, False])
def test_odd_rows(spark, plant):
    df = odd(spark).where("doc_id is null or doc_id <> 6")
    some = df.withColumn("text", PE.planted(F.col("doc_id"), F.col("text"))) if plant else df
    got = sorted(map(tuple, PE.digest(PE.periodic_runs(some)).collect()), key=str)
    assert got == sorted((expected(r["doc_id"], r["text"], plant) for r in df.collect()), key=str)
    assert PE.digest(PE.periodic_runs(df.where("1 = 0"))).count() == 0
    long = PE.periodic_runs(odd(spark).where("doc_id = 6")).first()
    assert [tuple(r) for r in long["runs"]] == [(0, 60_000, 1)] and long["collapsed"] == "x"

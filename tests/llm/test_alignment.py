"""Alignment of two tokenizers against plain Python over byte ranges."""
import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsops.llm import alignment as AL, queries as Q
from tests.llm.test_llm import DIR, odd


@pytest.fixture(scope="module")
def both():
    with open(AL.A_MODEL, encoding="utf-8") as f, open(AL.B_MODEL, "rb") as g:
        return AL.Tokenizers(f.read(), g.read()).load()


def ranges(tokens):
    end, out = 0, []
    for t in tokens:
        out.append((end, end + len(t)))
        end += len(t)
    return out


def aligned(both, text):
    """(a ids, b ids, groups, links) by trying bytes one after the other."""
    if not text:
        return [], [], [], []
    a, b = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    a_text, b_text = [both.a_bytes[x] for x in a], [both.b_bytes[x] for x in b]
    if not b"".join(a_text) == b"".join(b_text) == (" " + text).encode():
        return [], [], [], []
    a_at = [k for k, t in enumerate(a_text) for _ in t]
    b_at = [k for k, t in enumerate(b_text) for _ in t]
    links = list(dict.fromkeys(zip(a_at, b_at)))
    a_ends, b_ends = [y for _, y in ranges(a_text)], [y for _, y in ranges(b_text)]
    groups, i, j = [], 0, 0
    for end in sorted(set(a_ends) & set(b_ends)):
        i2, j2 = a_ends.index(end) + 1, b_ends.index(end) + 1
        groups.append((a[i:i2], b[j:j2]))
        i, j = i2, j2
    return a, b, groups, [(a[x], b[y]) for x, y in links]


def expected(both, rows):
    every = [(r["doc_id"], *aligned(both, r["text"])) for r in rows]
    counts = Counter(x for *_, links in every for x in links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    told = lambda groups: ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
    return sorted(((d, len(a), len(b), len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(told(groups).encode()).hexdigest() if a else "") for d, a, b, groups, links in every), key=str)


def test_query_equals_plain_python(spark, both):
    got = Q.QUERIES["op12_token_alignment"](spark, DIR)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = spark.read.parquet(f"{DIR}/documents.parquet").collect()
    assert sorted(map(tuple, got.collect()), key=str) == expected(both, rows)


STRANGE = ["a▁b", "▁", " ", "  two  blanks ", "\n\n\t x", "日本語の文章 🙂 naïve café", "<|endoftext|> <s> </s> <unk> <0x0A>", "a\0b",
           "don't we'll", "x" * 500, " " * 500, "12,345.67", "ﬁ Ａ", "tail ", "é"]


@pytest.mark.parametrize("pairs, steps", [(AL.TABLE_PAIRS, 3), (500, 1), (0, 1 << 15)])
def test_odd_rows_in_small_pieces_and_tables(spark, both, pairs, steps):
    df = odd(spark).where("doc_id is null or doc_id <> 6").select("doc_id", "text", "n").unionAll(
        spark.createDataFrame([(100 + i, t) for i, t in enumerate(STRANGE)], "doc_id long, text string").withColumn("n", F.lit("x")))
    got = AL.digest(AL.align(df, steps=steps, notation=True), table_pairs=pairs)
    assert sorted(map(tuple, got.collect()), key=str) == expected(both, df.collect())
    groups = AL.align(df, steps=steps).withColumn("groups", AL.notation("groups"))
    assert sorted(map(tuple, AL.digest(groups).collect()), key=str) == sorted(map(tuple, got.collect()), key=str)
    assert AL.digest(AL.align(df.where("1 = 0"), steps=steps, notation=True), table_pairs=pairs).count() == 0


def test_pieces_of_any_size_give_the_same_merge():
    rng = np.random.default_rng(4)
    for _ in range(60):
        total = int(rng.integers(0, 120))
        a, b = (np.unique(np.append(rng.integers(1, total + 1, int(rng.integers(0, 60))), total)) if total else np.zeros(0, np.int64) for _ in range(2))
        one = [x.tolist() for x in AL.merge(a, b, 10**6)]
        ends = sorted({*a.tolist(), *b.tolist()})
        assert list(zip(*one[:2])) == [(int(np.searchsorted(a, e)), int(np.searchsorted(b, e))) for e in ends]
        for steps in (1, 2, 7):
            assert [x.tolist() for x in AL.merge(a, b, steps)] == one


def test_very_long_texts(spark, both):
    texts = ["x" * 10**6, " " * 10**6, "\n" * 10**6, "word " * 200_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in AL.digest(AL.align(df, notation=True)).collect()}
    for i, t in enumerate(texts):
        assert got[i]["n_a"] == len(both.a.encode(" " + t, add_special_tokens=False).ids) and got[i]["n_b"] == len(both.b.encode(t))

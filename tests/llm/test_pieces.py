"""Encoding by distinct chunks against the library on whole texts."""
import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsops.llm import pieces as PI, queries as Q
from tests.llm.test_llm import DIR, odd

STRANGE = ["", " ", "  ", "   x   y ", "▁", "a▁b ▁▁ c", "\n a\n\n b\t\tc", "<s> x </s> <unk> <0x0A>", "a\0b", "12 345,6",
           "日本語の 文章と中文", "🙂🙂 x🙂", "é é", "Ａﬁ", "==== ---- ....", "don't  stop", " x y", "� ", "x" * 3000,
           " " * 3000, "ab" * 1500 + "  " * 99]


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


@pytest.fixture(scope="module")
def sp():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=PI.MODEL)


def expected(sp, doc_id, text):
    ids = sp.encode(text or "", num_threads=1)
    return doc_id, len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids) if ids else "")


def test_query_equals_the_library(spark, sp):
    rows = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, Q.QUERIES["op11_pieces"](spark, DIR).collect()))
    assert got == sorted(expected(sp, *r) for r in rows)


def strange():
    rng = np.random.default_rng(8)
    some = list(" ▁abé\n.,1é日🙂") + [" the", "ing", "tion", "  "]
    return STRANGE + ["".join(rng.choice(some, int(rng.integers(0, 60)))) for _ in range(400)]


@pytest.mark.parametrize("limit", [{}, {"table_chunks": 300}, {"table_chunks": 0}, {"joined": True}, {"table_chunks": 300, "joined": True},
                                   {"table_bytes": 2500, "joined": True}])
def test_any_part_of_the_table_may_be_broadcast(spark, sp, limit):
    df = odd(spark).select("doc_id", "text", "n").unionAll(
        spark.createDataFrame([(100 + i, t) for i, t in enumerate(strange())], "doc_id long, text string").withColumn("n", F.lit("x")))
    got = sorted(map(tuple, PI.digest(PI.decode(PI.encode(df, **limit))).collect()), key=str)
    assert got == sorted((expected(sp, r["doc_id"], r["text"]) for r in df.collect()), key=str)
    assert PI.digest(PI.decode(PI.encode(df.where("1 = 0"), **limit))).count() == 0


def test_every_chunk_is_segmented_once(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("text")
    with open(PI.MODEL, "rb") as f:
        known = spark.sparkContext.broadcast(PI.Pieces(f.read()))
    table = PI.segmented(PI.counted(docs, known), known)
    pieces = known.value.load()
    chunks = [c for part in pieces.slices(pa.array([r["text"] for r in docs.collect()])) for c in part.text(np.arange(len(part.start)))]
    assert table.count() == table.select("chunk").distinct().count() == len(set(chunks))
    assert table.agg(F.sum("n")).first()[0] == len(chunks)


def test_chunks_that_share_a_hash_stay_apart(spark, sp, monkeypatch):
    monkeypatch.setattr(PI, "hashes", lambda points, start, end: np.zeros(len(start), np.uint64))
    texts = ["one two  three one", "two", "three one", None]
    pieces = PI.Pieces(open(PI.MODEL, "rb").read()).load()
    part = PI.Chunks(pieces, texts)
    names, n = part.counts()
    counted = {}
    for name, k in zip(names, n.tolist()):
        counted[name] = counted.get(name, 0) + k
    every = part.text(np.arange(len(part.start)))
    assert counted == {x: every.count(x) for x in every}


def test_very_long_texts(spark, sp):
    texts = ["x" * 10**6, " " * 10**6, "\n" * 10**6, "word " * 200_000, "é" * 300_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r) for r in PI.digest(PI.decode(PI.encode(df))).collect()}
    assert got == {i: expected(sp, i, t) for i, t in enumerate(texts)}

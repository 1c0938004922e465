"""Dictionaries as tables against plain Python and the literal forms."""
import random

import pytest
from pyspark.sql import functions as F

from newsops.functions import lexicon as X
from newsops.operators import dictionary as D
from workload import views as V

LIMITS = [{}, {"rows": 0}, {"chars": 40}]


@pytest.mark.parametrize("limit", LIMITS)
def test_terms_of_any_shape(spark, limit):
    rnd = random.Random(2)
    texts = [(i, " ".join("".join(rnd.choice("abcé🙂") for _ in range(rnd.randint(1, 9))) for _ in range(rnd.randint(0, 12)))) for i in range(120)]
    texts += [(900, None), (901, ""), (902, "  \n "), (903, "ABC\tcab\nabca"), (904, "ab" * 20_000), (905, "a" * 3 + "\n" + "b" * 3)]
    terms = {"".join(rnd.choice("abcé🙂 ") for _ in range(rnd.randint(1, 7))) for _ in range(400)} | {"a\nb", "a\tc", "c\nabca", "zzzz", "aa  bb"}
    df = spark.createDataFrame(texts, "id long, t string")
    table = spark.createDataFrame([(x,) for x in [*terms, *list(terms)[:20], None, " ", ""]], "term string")
    want = {(i, x) for i, t in texts if t for x in terms if x.strip() and x in t.lower()}
    got = [tuple(r) for r in D.occurrences(df, "id", "t", table, **limit).collect()]
    assert len(got) == len(set(got)) and set(got) == want and any(" " in x for _, x in got)
    assert D.occurrences(df, "id", "t", table.limit(0), **limit).count() == 0
    assert D.occurrences(df.limit(0), "id", "t", table, **limit).count() == 0


@pytest.mark.parametrize("limit", LIMITS)
def test_tables_equal_literals(spark, limit):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    names = make(list(V.COUNTRIES.items()), "term string, code string")
    exports = make([*V.EXPORTS, ("US", "that", "major")], "country string, product string, impact string")
    keywords = make([(p, w) for p, ws in V.PRODUCTS.items() for w in ws], "product string, term string")
    company, macro = (make([(w,) for w in ws], "term string") for ws in (V.COMPANY, V.MACRO))
    found = D.rule_codes(docs, "doc_id", "text", names, exports, keywords, company, macro, **limit)
    literal = X.rule_codes("text", V.COUNTRIES, [*V.EXPORTS, ("US", "that", "major")], V.PRODUCTS, V.COMPANY, V.MACRO)
    want = {r[0]: r[1] for r in docs.select("doc_id", F.array_sort(literal)).collect()}
    assert {r["doc_id"]: r["codes"] for r in found.collect()} == want and sum(map(bool, want.values())) > 20
    some = {r["doc_id"]: r["countries"] for r in D.detect_countries(docs, "doc_id", "text", names, **limit).collect()}
    assert some == {r[0]: r[1] for r in docs.select("doc_id", F.array_sort(X.detect_countries("text", V.COUNTRIES))).collect()}


def test_each_word_is_looked_up_once(spark):
    """An anchor is found by the gram that the fewest words have."""
    words = spark.createDataFrame([(f"the{i}xx",) for i in range(50)] + [("the7xxyy",)], "word string")
    anchors = spark.createDataFrame([("the7xx",), ("the",), ("qqqq",)], "anchor string")
    got = sorted(map(tuple, D.words_with(words, anchors).collect()))
    assert got == sorted([(f"the{i}xx", "the") for i in range(50)] + [("the7xxyy", "the"), ("the7xx", "the7xx"), ("the7xxyy", "the7xx")])


def test_ten_thousand_terms(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    words = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(
        F.explode(F.slice(F.split(F.lower("text"), " "), 1, 40)).alias("term")).where("length(term) >= 5").distinct().orderBy("term").limit(10_000)
    terms = [r[0] for r in words.collect()]
    assert len(terms) == 10_000
    low = {r["doc_id"]: r["text"].lower() for r in docs.collect() if r["text"]}
    got = {tuple(r) for r in D.occurrences(docs, "doc_id", "text", spark.createDataFrame([(t,) for t in terms], "term string")).collect()}
    assert got == {(i, t) for i, text in low.items() for t in terms if t in text}


def test_words_are_not_shuffled_where_terms_fit(spark, monkeypatch):
    """Found words are many more than terms: they are met where the texts lie."""
    texts = spark.createDataFrame([(i, f"x{i}abcd y{i}abcd the end") for i in range(60)] + [(60, "z" * 70 + "abcd" + "y" * 70), (61, "then d")], "id long, t string")
    terms = spark.createDataFrame([("abcd",), ("the ",), (" end",)], "term string")
    write, written = D.materialise, []
    monkeypatch.setattr(D, "materialise", lambda df, name: written.append(name) or write(df, name))
    found = D.occurrences(texts, "id", "t", terms, rows=10)
    assert {tuple(r) for r in found.collect()} == {(i, x) for i in range(60) for x in ("abcd", "the ", " end")} | {(60, "abcd")}
    assert "dictionary-vocabulary" not in written and "dictionary-words" not in written

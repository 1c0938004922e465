"""Text expressions against Python's own string methods."""
import hashlib
import re

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from newsops.functions import text as T

# Assigned code points that both Unicode tables agree on, spaces and quotes weighted in.
CHARS = st.one_of(
    st.sampled_from("aZéÀßñ 0_.,'\"\t\n\r\x1c\x85  -!?()$%#@&=+;:*~|€АяЖ中ء"),
    st.characters(min_codepoint=32, max_codepoint=0x24F, exclude_categories=["Cn", "Cs"]))
TEXTS = st.lists(st.text(CHARS, max_size=90), min_size=30, max_size=60)
LONG = st.lists(st.text(st.sampled_from("abcXYZ. \n"), min_size=400, max_size=700), min_size=8, max_size=16)
RUN = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def apply(spark, texts, expr):
    rows = [(i, t) for i, t in enumerate(texts)]
    out = spark.createDataFrame(rows, "i int, t string").select("i", expr(F.col("t")).alias("x")).collect()
    return [r["x"] for r in sorted(out, key=lambda r: r["i"])]


def python_hash(t):
    kept = "".join(c for c in t.lower().strip() if c.isalnum() or c.isspace())
    return hashlib.md5(kept.encode()).hexdigest()


def python_truncate(t, n=512):
    if len(t) <= n:
        return t
    cut = t[:n]
    if cut.rfind(".") > n * 0.8:
        return cut[: cut.rfind(".") + 1]
    if cut.rfind(" ") > n * 0.8:
        return cut[: cut.rfind(" ")]
    return cut


@RUN
@given(TEXTS)
def test_strip_upper_title(spark, texts):
    assert apply(spark, texts, T.strip) == [t.strip() for t in texts]
    assert apply(spark, texts, T.is_upper) == [t.isupper() for t in texts]
    simple = [re.sub("[^ -~À-ÿ]|[ßµÿª º]", "x", t) for t in texts]
    assert apply(spark, simple, T.py_title) == [t.title() for t in simple]


@RUN
@given(TEXTS)
def test_hash_and_suspicious(spark, texts):
    plain = [t.replace("İ", "i") for t in texts]
    assert apply(spark, plain, T.article_hash) == [python_hash(t) for t in plain]
    pattern = r"[^\w\s.,!?\"'\-():;%$+=&@#]"
    assert apply(spark, texts, T.has_suspicious) == [bool(re.search(pattern, t)) for t in texts]


@RUN
@given(LONG)
def test_truncate_and_clean(spark, texts):
    assert apply(spark, texts, T.smart_truncate) == [python_truncate(t) for t in texts]
    flat = [re.sub(r"\s+", " ", t) for t in texts]
    calm = [t.title() if t.isupper() and len(t) > 50 else t for t in flat]
    assert apply(spark, texts, T.clean_text) == [python_truncate(t).strip() for t in calm]


def test_clean_text_cases(spark):
    shout = "DON'T STOP: THE MARKET FELL 3RD DAY IN A ROW AS BANKS LOST GROUND"
    got = apply(spark, [None, "", 'a ""b""\r\n\tc', shout], T.clean_text)
    assert got == ["", "", 'a "b" c', shout.title()]


def test_fallbacks(spark):
    df = spark.createDataFrame([("", "b"), (None, ""), ("a", "b"), (None, None)], "x string, y string")
    got = [r[0] for r in df.select(T.first_non_empty("x", "y", default="FMP")).collect()]
    assert got == ["b", "", "a", "FMP"]

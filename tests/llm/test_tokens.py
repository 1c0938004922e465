"""Token counts of texts with long runs."""
import base64

import numpy as np
import pytest

from newsops.llm import tokens as TK


@pytest.fixture(scope="module")
def encoding():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(TK.VOCABULARY, "rb"))}
    return tiktoken.Encoding("t", pat_str=TK.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_runs_of_blanks_are_counted_as_in_the_whole_text(encoding):
    rng = np.random.default_rng(9)
    some = ["a", "word", "'s", "1", "-", " ", " ", " ", "  ", "\n", "\t", "\r\n", "\x85", "　", "\x1c", "é", "日本"]
    for _ in range(3000):
        text = "".join(rng.choice(some, int(rng.integers(0, 25))))
        for long in (1, 2, 3, 5):
            assert TK.token_count(encoding, text, long) == len(encoding.encode_ordinary(text)), repr(text)


def test_a_million_of_anything(spark, encoding):
    texts = [c * 10**6 for c in (" ", "\n", "x", "1", "-", "é", " \t")] + ["a" + " " * 10**6 + "b", "  word" * 200_000, None, ""]
    want = sorted([TK.token_count(encoding, t) for t in texts])
    assert want[:2] == [0, 0] and TK.token_count(encoding, " " * 10**6) == 10**6
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = sorted(r["n_tokens"] for r in TK.lengths(df).collect() for _ in range(r["n_docs"]))
    assert got == want

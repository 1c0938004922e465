"""Exact token counts: a histogram of encoded lengths, and suffix sums of it that
answer totals, quantiles and truncated totals for every context limit."""
from __future__ import annotations

import base64
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how that vocabulary cuts text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Runs of blanks from so many on are cut out: the pattern's backtracking fails on a million.
LONG_BLANKS = 10_000


def token_count(encoding, text: str | None, long_blanks: int = LONG_BLANKS) -> int:
    """Tokens of a text.  A token ends before every run of blanks, and a run is one
    piece to be merged, but for its last blank where something follows: so a long
    run is merged by itself, past the pattern, and the rest encoded around it."""
    if not text:
        return 0
    n, at = 0, 0
    for run in re.finditer(rf"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{long_blanks},}}", text):
        end = run.end() - (run.end() < len(text))
        n += len(encoding.encode_ordinary(text[at:run.start()]))
        n += len(encoding._encode_single_piece(text[run.start():end])) if end > run.start() else 0
        at = end
    return n + len(encoding.encode_ordinary(text[at:]))


def lengths(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(n_tokens, n_docs): how many texts have each encoded length.  Null and empty
    texts have length 0; a very long text is encoded whole, some 60 bytes a character,
    whatever runs it holds.  The vocabulary is read by the driver and broadcast
    (its size is the file's, under 2 MB); tasks add up before the shuffle."""
    with open(vocabulary, "rb") as f:
        known = docs.sparkSession.sparkContext.broadcast(f.read())

    def count(batches):
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, known.value.splitlines())}
        encoding = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        seen: Counter[int] = Counter()
        for batch in batches:
            seen.update(token_count(encoding, t) for t in batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["n_tokens", "n_docs"])

    parts = docs.select("text").mapInArrow(count, "n_tokens long, n_docs long")
    return parts.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Histogram with, for each length L: longer_docs (texts with more than L),
    share (texts with at most L, of all), tokens (of texts of length L), total
    (of all texts) and truncated (of all texts cut to L).

    One row per distinct length: at most as many as the longest text has tokens.
    An empty table gives no rows."""
    after = Window.orderBy("n_tokens").rowsBetween(1, Window.unboundedFollowing)
    everything = Window.partitionBy()
    tokens = F.col("n_tokens") * F.col("n_docs")
    longer = F.coalesce(F.sum("n_docs").over(after), F.lit(0))
    total = F.sum(tokens).over(everything)
    return histogram.select(
        "n_tokens", "n_docs", tokens.alias("tokens"), longer.alias("longer_docs"),
        (1 - longer / F.sum("n_docs").over(everything)).alias("share"), total.alias("total"),
        (total - F.coalesce(F.sum(tokens).over(after), F.lit(0)) + longer * F.col("n_tokens")).alias("truncated"))


def at_limit(sums: DataFrame, limit: int) -> DataFrame:
    """(total, truncated) for any limit: from the largest length not above it."""
    below = F.max(F.when(F.col("n_tokens") <= limit, F.struct("n_tokens", "truncated", "longer_docs")))
    found = sums.agg(F.max("total").alias("total"), F.sum("n_docs").alias("docs"), below.alias("b"))
    return found.select("total", F.coalesce(
        F.col("b.truncated") + F.col("b.longer_docs") * (limit - F.col("b.n_tokens")), F.col("docs") * limit).alias("truncated"))


def quantile(sums: DataFrame, q: float) -> DataFrame:
    """The least length that a share of ``q`` of the texts doesn't exceed."""
    return sums.where(F.col("share") >= q).agg(F.min("n_tokens").alias("n_tokens"))

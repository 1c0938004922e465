"""Label normalisation, encoding and validity."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from newsops import vocab
from newsops.functions.text import col, first_non_empty, not_blank, strip


def lookup(c: Column, mapping: dict) -> Column:
    """Literal map lookup; null when the key is absent."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.try_element_at(table, c)


def normalise(c, mapping: dict[str, str], default: str | None = None,
              unknown: str = "default") -> Column:
    """Lower and strip, then map.  Unknown values take ``default``; with
    ``unknown="keep"`` they stay as they are."""
    key = strip(F.lower(col(c)))
    other = key if unknown == "keep" else F.lit(default)
    return F.coalesce(lookup(key, mapping), other)


def normalise_sentiment(c) -> Column:
    return normalise(c, vocab.SENTIMENT_NORMAL, "neutral")


def normalise_importance(c) -> Column:
    return normalise(c, vocab.IMPORTANCE_NORMAL, "générale")


def model_label(c, mapping: dict[str, str], default: str) -> Column:
    """Normalise a model's output label (case-sensitive)."""
    return F.coalesce(lookup(col(c), mapping), F.lit(default))


def encode(c, mapping: dict[str, int], unknown: int | None = None) -> Column:
    ids = lookup(col(c), mapping)
    return ids if unknown is None else F.coalesce(ids, F.lit(unknown))


def decode(c, mapping: dict[str, int]) -> Column:
    return lookup(col(c), {v: k for k, v in mapping.items()})


def label_fallback(*cols) -> Column:
    """First non-empty of the candidate label columns, else the empty string."""
    return F.coalesce(first_non_empty(*cols), F.lit(""))


def valid_sentiment(c) -> Column:
    """Exactly one of the three labels, whatever the case; not stripped."""
    return F.coalesce(F.lower(col(c)).isin(vocab.SENTIMENTS), F.lit(False))


def valid_daily(text, label) -> Column:
    return not_blank(text) & valid_sentiment(label)


def needs_review(*confidences, threshold: float = 0.75) -> Column:
    """Any confidence below the threshold; a missing confidence never is."""
    flag = F.lit(False)
    for c in confidences:
        flag = flag | F.coalesce(col(c) < threshold, F.lit(False))
    return flag

"""Lexicon scoring.  Keywords match as substrings of the lowered text and each
keyword counts once, however often it occurs."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from newsops import vocab
from newsops.functions.text import col, let

# Beyond this many terms a generated sum outgrows what the JVM compiles well: a
# lambda over a literal array then measures about twice as fast.
INLINE_TERMS = 16


def hits(c: Column | str, words: Sequence[str], weights: Sequence[float] | None = None) -> Column:
    """Number of distinct keywords present (or the sum of their weights)."""
    return hits_lowered(F.lower(col(c)), words, weights)


def hits_lowered(low: Column, words, weights=None) -> Column:
    words = list(dict.fromkeys(words)) if weights is None else list(words)
    if not words:
        return F.lit(0)
    if len(words) <= INLINE_TERMS:
        total = None
        for i, w in enumerate(words):
            one = F.contains(low, F.lit(w)).cast("int")
            if weights is not None:
                one = one * F.lit(weights[i])
            total = one if total is None else total + one
        return total
    if weights is None:
        return let(low, lambda t: _count_in(t, words))
    table = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(float(x)).alias("x"))
                      for w, x in zip(words, weights)])
    return let(low, lambda t: F.aggregate(
        table, F.lit(0.0), lambda acc, e: acc + F.when(F.contains(t, e["w"]), e["x"]).otherwise(0.0)))


def _count_in(low: Column, words) -> Column:
    """Distinct terms found in a lowered text that is already bound."""
    table = F.array(*[F.lit(w) for w in dict.fromkeys(words)])
    return F.size(F.filter(table, lambda w: F.contains(low, w)))


def has_hit(c: Column | str, words: Sequence[str]) -> Column:
    return any_term(F.lower(col(c)), words)


def any_term(low: Column, words: Sequence[str]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | F.contains(low, F.lit(w))
    return found


def sentiment(c, positive=vocab.POSITIVE_WORDS, negative=vocab.NEGATIVE_WORDS) -> Column:
    """Majority of positive and negative hits; a tie is neutral."""
    low = F.lower(col(c))
    pos, neg = hits_lowered(low, positive), hits_lowered(low, negative)
    return F.when(pos > neg, "positive").when(neg > pos, "negative").otherwise("neutral")


def importance(c, high=None, medium=None, rule: str = "tiers") -> Column:
    """``tiers``: high >= 2 critique; high >= 1 or medium >= 3 importante; else
    générale.  ``daily``: any high critical; any medium important; else general."""
    low = F.coalesce(F.lower(col(c)), F.lit(""))
    if rule == "daily":
        high, medium = high or vocab.DAILY_HIGH, medium or vocab.DAILY_MEDIUM
        return (F.when(any_term(low, high), "critical")
                .when(any_term(low, medium), "important").otherwise("general"))
    high, medium = high or vocab.HIGH_TERMS, medium or vocab.MEDIUM_TERMS

    def tier(h, m):
        return (F.when(h >= 2, "critique").when((h >= 1) | (m >= 3), "importante")
                .otherwise("générale"))

    if len(high) + len(medium) <= INLINE_TERMS:
        return tier(hits_lowered(low, high), hits_lowered(low, medium))
    return let(let(low, lambda t: F.struct(_count_in(t, high).alias("h"), _count_in(t, medium).alias("m"))),
               lambda n: tier(n["h"], n["m"]))


def quality_score(title, text, source, correlations, sentiment_confidence=None,
                  importance_confidence=None, premium=vocab.PREMIUM_SOURCES,
                  high=vocab.HIGH_TERMS) -> Column:
    """Length, model confidence, premium source, high-impact terms and detected
    codes, capped at 100."""
    title, text = F.coalesce(col(title), F.lit("")), F.coalesce(col(text), F.lit(""))
    source = F.lower(F.coalesce(col(source), F.lit("")))
    score = (F.least(F.lit(20.0), F.length(title) / F.lit(5.0))
             + F.least(F.lit(30.0), F.length(text) / F.lit(100.0)))
    for conf in (sentiment_confidence, importance_confidence):
        if conf is not None:
            score = score + F.coalesce(col(conf), F.lit(0.0)) * 10
    score = (score + F.when(any_term(source, premium), 25).otherwise(0)
             + hits_lowered(F.lower(text), high) * 5
             + F.coalesce(F.array_size(col(correlations)), F.lit(0)) * 3)
    return F.least(F.lit(100.0), score.cast("double"))


def detect_countries(c, names: dict[str, str] = vocab.COUNTRY_NAMES) -> Column:
    """Distinct country codes whose name occurs, in dictionary order."""
    low = F.lower(col(c))
    return _present([F.when(F.contains(low, F.lit(name)), F.lit(code)) for name, code in names.items()])


def _present(options: list[Column]) -> Column:
    """The distinct non-null options, in order.  ``array_except`` is compiled with
    its inputs; a lambda would evaluate every ``lower(text)`` anew."""
    if not options:
        return F.array().cast("array<string>")
    return F.array_except(F.array(*options), F.array(F.lit(None).cast("string")))


def rule_codes(c, names=vocab.COUNTRY_NAMES, exports=vocab.COUNTRY_EXPORTS,
               products=vocab.PRODUCT_KEYWORDS, company=vocab.COMPANY_TERMS,
               macro=vocab.MACRO_TERMS, impacts=("pivot", "major")) -> Column:
    """Codes by rule: a macro article that is not a company article, a country
    named in it, and one of that country's export products mentioned.  The
    dictionaries are configuration, so the whole join folds into one
    expression and needs no shuffle."""
    low = F.lower(col(c))
    found = []
    for country, product, impact in exports:
        if impact not in impacts:
            continue
        aliases = [n for n, code in names.items() if code == country]
        words = products.get(product, [product.lower()])
        found.append(F.when(any_term(low, aliases) & any_term(low, words),
                            F.lit(f"{country}:{product}")))
    codes = _present(found)
    eligible = ~any_term(low, company) & any_term(low, macro)
    return F.when(eligible, codes).otherwise(F.array().cast("array<string>"))

"""Dictionaries as tables: which terms of a table occur in which texts.

A term occurs where the lowered text contains it, within words too.  The longest
part of a term that has no blank, its anchor, then lies within one word of the
text.  So words are matched with the anchors: both are cut into grams, an anchor is
looked up by the one of its grams that the fewest words have, and a hit is verified.
Terms that fit a broadcast meet the words where the texts lie, and nothing but what
is found is shuffled.  Beyond that the texts' distinct words are matched, each once
however often it is written, and the words found lead back to the texts, where
terms that have blanks are verified whole."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsops.functions.text import let
from newsops.session import materialise

GRAM = 4
#: Longer words are split into letters before they are cut: a place in a string is found by counting from its start.
LONG_WORD = 64
BLANK = r"\s+"
#: A table of terms or words is broadcast up to so many rows and characters, and shuffled beyond.
BROADCAST_ROWS, BROADCAST_CHARS = 200_000, 1 << 23


def anchor(term: str) -> Column:
    """The longest part of a term without a blank ('' for a blank term)."""
    parts = F.transform(F.split(term, BLANK), lambda p: F.struct(F.length(p).alias("n"), p.alias("p")))
    return F.array_max(parts)["p"]


def grams(word: str, size: int) -> Column:
    """The distinct grams of a word, in time linear in its length."""
    cut = let(F.split(word, ""), lambda letters: F.transform(
        F.sequence(F.lit(1), F.size(letters) - size + 1), lambda i: F.array_join(F.slice(letters, i, size), "")))
    return F.array_distinct(F.when(F.length(word) >= size, cut).otherwise(F.array().cast("array<string>")))


def each_gram(words: DataFrame, sizes: list[int]) -> DataFrame:
    """``words`` with ``gram``, a row for every gram of ``word`` at every place, in time linear in its length."""
    letters = F.when(F.length("word") > LONG_WORD, F.split("word", ""))
    places = words.where(F.length("word") > 0).withColumn("_letters", letters).select(
        "*", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("_at"))
    sized = places.select("*", F.explode(F.array(*map(F.lit, sizes))).alias("_n")).where(F.col("_at") + F.col("_n") - 1 <= F.length("word"))
    gram = F.when(F.col("_letters").isNull(), F.substring("word", F.col("_at"), F.col("_n"))).otherwise(
        F.array_join(F.slice("_letters", F.col("_at"), F.col("_n")), ""))
    return sized.select(*words.columns, gram.alias("gram"))


def _fits(df: DataFrame, columns: list[str], rows: int, chars: int) -> bool:
    size = df.agg(F.count("*").alias("n"), F.sum(sum(F.coalesce(F.length(c), F.lit(0)) for c in columns)).alias("c")).first()
    return size["n"] <= rows and (size["c"] or 0) <= chars


def words_with(words: DataFrame, anchors: DataFrame, rows: int = BROADCAST_ROWS, chars: int = BROADCAST_CHARS) -> DataFrame:
    """``words`` (word and more) with ``anchor``: which words contain which of distinct ``anchors``."""
    hint = F.broadcast if _fits(anchors, ["anchor"], rows, chars) else (lambda df: df)
    sizes = [r[0] for r in anchors.select(F.least(F.length("anchor"), F.lit(GRAM))).distinct().collect()]
    if not sizes:
        return words.crossJoin(anchors.limit(0)).select(*words.columns, "anchor")
    own = F.lit(None).cast("array<string>")
    for n in sizes:
        own = F.when(F.least(F.length("anchor"), F.lit(GRAM)) == n, grams("anchor", n)).otherwise(own)
    keys = materialise(anchors.select("anchor", F.explode(own).alias("gram")), "dictionary-grams")
    # Grams that no word has keep their anchors from being found at all.
    used = each_gram(words.select("word"), sizes).join(hint(keys.select("gram").distinct()), "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n"))
    rarest = keys.join(used, "gram", "left").groupBy("anchor").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("x")).where("x.n > 0").select("anchor", F.col("x.gram").alias("gram"))
    rarest = materialise(rarest, "dictionary-rarest")
    found = each_gram(words, sizes).join(hint(rarest), "gram").where(F.contains("word", "anchor")).select(*words.columns, "anchor")
    return found if len(words.columns) > 1 else found.distinct()


def occurrences(texts: DataFrame, key: str, text: str, terms: DataFrame, give=("term",), rows: int = BROADCAST_ROWS,
                chars: int = BROADCAST_CHARS) -> DataFrame:
    """(``key``, *``give``): the distinct ``give`` columns of the ``terms`` (term and
    those) that each text has; ``key`` is unique.  Blank and null terms are left
    out, a null text has none.  Texts are read twice.  They move only where terms are
    too many to broadcast, as are the words found, and terms have blanks: then those
    that may hold such a term."""
    give = list(give)
    low = texts.select(key, F.lower(text).alias("_low"))
    # A part between blanks is a whole word, one after or before a blank begins or ends a word.
    parts = F.split("term", BLANK)
    place = F.array_position(parts, F.col("anchor"))
    terms = terms.where(F.length(anchor("term")) > 0).select("term", *[c for c in give if c != "term"], anchor("term").alias("anchor")).distinct()
    terms = materialise(terms.withColumns({"begins": place > 1, "ends": place < F.size(parts)}), "dictionary-terms")
    split = F.explode(F.array_distinct(F.split("_low", BLANK))).alias("word")
    # A term that is its own anchor needs no more proof: only what it gives goes on.
    proof = F.when(F.col("anchor") != F.col("term"), F.col("term")).alias("proof")
    fits = (~F.col("begins") | F.startswith("word", "anchor")) & (~F.col("ends") | F.endswith("word", "anchor"))
    holds = F.col("proof").isNull() | F.contains("_low", "proof")
    anchors = terms.select("anchor").distinct()
    if _fits(terms, ["term", "anchor", *give], rows, chars):
        near = words_with(low.select(key, "_low", split), anchors, rows, chars)
        return near.join(F.broadcast(terms.withColumn("proof", proof)), "anchor").where(fits).where(holds).select(key, *give).distinct()
    words = materialise(low.select(split).distinct(), "dictionary-vocabulary")
    found = words_with(words, anchors, rows, chars)
    lead = materialise(found.join(terms, "anchor").where(fits).select("word", *give, proof).distinct(), "dictionary-words")
    if _fits(lead, ["word", *give], rows, chars):
        return low.select(key, "_low", split).join(F.broadcast(lead), "word").where(holds).select(key, *give).distinct()
    hit = low.select(key, split).join(lead, "word").select(key, *give, "proof").distinct()
    checked = low.join(hit.where("proof is not null"), key).where(holds)
    return hit.where("proof is null").select(key, *give).unionByName(checked.select(key, *give)).distinct()


def detect_countries(texts: DataFrame, key: str, text: str, names: DataFrame, **limits) -> DataFrame:
    """(``key``, countries): the distinct codes, sorted, of the ``names`` (term,
    code) that occur in each text."""
    found = occurrences(texts, key, text, names, ["code"], **limits)
    some = found.groupBy(key).agg(F.array_sort(F.collect_list("code")).alias("countries"))
    return texts.select(key).join(some, key, "left").withColumn("countries", F.coalesce("countries", F.array().cast("array<string>")))


def rule_codes(texts: DataFrame, key: str, text: str, names: DataFrame, exports: DataFrame, keywords: DataFrame,
               company: DataFrame, macro: DataFrame, impacts=("pivot", "major"), **limits) -> DataFrame:
    """(``key``, codes): a macro article that is no company article, a country named
    in it, and one of its export products mentioned; sorted.

    ``names`` (term, code), ``exports`` (country, product, impact), ``keywords``
    (product, term; a product without any is looked for by its own name),
    ``company`` and ``macro`` (term)."""
    exports = materialise(exports.select("country", "product", "impact").distinct(), "dictionary-exports")
    bare = exports.select("product").distinct().join(keywords, "product", "left_anti").select(F.lower("product").alias("term"), "product")
    kinds = (names.select("term", F.lit("country").alias("kind"), F.col("code").alias("value"))
             .unionByName(keywords.select("term", "product").unionByName(bare).select("term", F.lit("product").alias("kind"), F.col("product").alias("value")))
             .unionByName(company.select("term", F.lit("company").alias("kind"), F.lit(None).cast("string").alias("value")))
             .unionByName(macro.select("term", F.lit("macro").alias("kind"), F.lit(None).cast("string").alias("value")))).distinct()
    found = materialise(occurrences(texts, key, text, kinds, ["kind", "value"], **limits), "dictionary-found")
    # One row for each text from here on, so that nothing but these rows is shuffled.
    valued = lambda kind: F.collect_set(F.when(F.col("kind") == kind, F.col("value")))
    eligible = found.groupBy(key).agg(
        F.bool_or(F.col("kind") == "macro").alias("macro"), F.bool_or(F.col("kind") == "company").alias("company"),
        valued("country").alias("countries"), valued("product").alias("products")).where("macro and not company")
    sold = exports.where(F.col("impact").isin(*impacts)).groupBy("country").agg(F.collect_set("product").alias("sold"))
    named = eligible.select(key, "products", F.explode("countries").alias("country")).join(sold, "country")
    codes = named.select(key, "country", F.explode(F.array_intersect("sold", "products")).alias("product")).groupBy(key).agg(
        F.array_sort(F.collect_set(F.concat("country", F.lit(":"), "product"))).alias("codes"))
    return texts.select(key).join(codes, key, "left").withColumn("codes", F.coalesce("codes", F.array().cast("array<string>")))

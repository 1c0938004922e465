"""Commodity-code strings and multi-hot vectors."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsops.functions.text import col, let, strip


def country_of(c) -> Column:
    c = col(c)
    return F.when(F.contains(c, F.lit(":")), F.split_part(c, F.lit(":"), F.lit(1))).otherwise("")


def commodity_of(c) -> Column:
    c = col(c)
    return F.when(F.contains(c, F.lit(":")), F.split_part(c, F.lit(":"), F.lit(2))).otherwise(c)


def parse_codes(c) -> Column:
    """Split at ';' if there is one, else at ','; trim; drop blanks.  Null,
    blank and 'nan' give an empty array."""
    c = F.coalesce(col(c), F.lit(""))
    parts = F.when(F.contains(c, F.lit(";")), F.split(c, ";")).otherwise(F.split(c, ","))
    codes = F.filter(F.transform(parts, strip), lambda x: x != "")
    empty = F.array().cast("array<string>")
    return F.when(F.lower(strip(c)).isin("", "nan"), empty).otherwise(codes)


def join_codes(c, sep: str = ";") -> Column:
    return F.array_join(col(c), sep)


def whitelist(c, codes) -> Column:
    """Keep the listed codes, in order; an empty list keeps everything."""
    if not codes:
        return col(c)
    allowed = F.array(*[F.lit(x) for x in codes])
    return F.filter(col(c), lambda x: F.array_contains(allowed, x))


def multi_hot(c, codes) -> Column:
    """0/1 vector over the ordered code list; unknown codes are ignored."""
    table = F.array(*[F.lit(x) for x in codes])
    # The codes are bound first: inside the lambda they would be derived per code.
    return let(col(c), lambda mine: F.transform(
        table, lambda x: F.array_contains(mine, x).cast("double")))


def codes_from_scores(c, codes, threshold: float = 0.5) -> Column:
    """','-joined codes whose value is strictly above the threshold."""
    table = F.array(*[F.lit(x) for x in codes])
    picked = F.filter(
        F.zip_with(table, col(c), lambda code, v: F.when(v > threshold, code)),
        lambda x: x.isNotNull())
    return F.array_join(picked, ",")


def each_code(df: DataFrame, codes: str, *keep) -> DataFrame:
    """One row per code.  The outer form keeps Spark from inferring a size filter
    that would be pushed down and derive the codes a second time."""
    return df.select(*keep, F.explode_outer(codes).alias("code")).filter(F.col("code").isNotNull())

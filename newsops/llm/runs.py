"""Runs of windows that may repeat: the search common to both kinds of substring
deduplication.

A window's least gram (by hash) goes wherever the window goes.  So windows are
taken in runs that share their least gram, and a run whose gram (``a``) occurs
once holds no repeat.  Runs of equal content (``r``) are one class.  What is left
to compare window by window are classes that share a gram but not the content:
around edits, and where a shared passage begins and ends."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

RUN = "array<struct<a:bigint,r:bigint,first:int,n:int>>"
NO_ID = -(1 << 63)


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with doc (doc_id, or NO_ID) and rid, which together name a
    row: rows that share both are alike."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumns({
        "doc": F.coalesce("doc_id", F.lit(NO_ID)), "rid": F.xxhash64("doc_id", "text")})


def occurrences(facts: DataFrame) -> DataFrame:
    """One row per run of ``facts`` (doc, rid, runs)."""
    return facts.select("doc", "rid", F.explode("runs").alias("x")).select("doc", "rid", "x.*")


def shared(occ: DataFrame) -> DataFrame:
    """Classes (a, r) whose gram occurs more than once: doc (the smallest with the
    class), last (the largest), n_rows, rep (one of its places), and of the gram
    least_doc, most_doc, classes, rows_all."""
    per = occ.groupBy("a", "r").agg(F.min("doc").alias("doc"), F.max("doc").alias("last"), F.count("*").alias("n_rows"),
                                    F.min(F.struct("doc", "rid", "first")).alias("rep"))
    grams = per.groupBy("a").agg(F.min("doc").alias("least_doc"), F.max("last").alias("most_doc"),
                                 F.count("*").alias("classes"), F.sum("n_rows").alias("rows_all")).where("rows_all > 1")
    return per.join(grams, "a")

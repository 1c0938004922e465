"""Commodity correlations: dictionary joins, rarity-aware picks."""
from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from newsops import vocab
from newsops.functions import scores as S
from newsops.functions.codes import each_code
from newsops.functions.text import col
from newsops.session import materialise

#: Counts from here on shift a code's threshold alike.
SATURATED = 10


def exposure_table(spark: SparkSession, rows=vocab.EXPOSURES) -> DataFrame:
    """(code, category, exporters, direction), one row per code."""
    return spark.createDataFrame(
        rows, "code string, category string, exporters array<string>, direction string")


def with_category(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Inner join on ``code``.  Spark broadcasts the dictionary by its measured
    size, and shuffles it when a caller plugs in a large one."""
    return df.join(dictionary.select("code", "category"), "code")


def with_exporters(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """One row per code and pivot exporter."""
    return df.join(dictionary.select("code", F.explode("exporters").alias("exporter")), "code")


def with_direction(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    return df.join(dictionary.select("code", "direction"), "code")


def choose_codes(model_codes, rule_codes) -> Column:
    """Model first; rules when the model gives nothing."""
    return F.when(F.coalesce(F.size(col(model_codes)), F.lit(0)) > 0, col(model_codes)).otherwise(
        col(rule_codes))


def code_counts(df: DataFrame, codes: str = "correlations") -> DataFrame:
    """(code, n): the counts a later batch uses as its rarity table."""
    return each_code(df, codes).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def pick_labels(df: DataFrame, codes, scores: str = "scores", out: str = "correlations",
                max_labels: int = 3, top1: float = 0.40, rarity: str = "frozen",
                counts: DataFrame | None = None, session: str = "session", seq: str = "seq",
                low: float = 0.22, high: float = 0.55, block_rows: int = 4096) -> DataFrame:
    """Picks up to ``max_labels`` codes per row from its score vector.

    ``off``: no rarity shift.  ``frozen``: shifts from the counts of the batch
    before (one row per known code, at most ``len(codes)``, turned into a map).
    ``exact``: counts grow article by article within a session, as in one
    collection run.  A session of any length is cut into blocks of ``block_rows``
    that are picked side by side; ``seq`` must be unique within a session."""
    if rarity == "exact":
        return _pick_in_session(df, list(codes), scores, out, max_labels, top1, session, seq, low, high, block_rows)
    def pick(shift):
        return S.pick_codes(scores, codes, max_labels, top1, shift, low=low, high=high)

    if rarity == "off":
        return df.withColumn(out, pick(None))
    rare = F.lit(-0.02)  # a code without a count is rare
    if counts is None:
        return df.withColumn(out, pick(lambda label: rare))
    if not codes:
        raise ValueError("rarity counts need the code list that bounds them")
    table = counts.filter(F.col("code").isin(*codes)).agg(F.map_from_entries(F.collect_list(
        F.struct("code", S.rarity_shift(F.col("n"))))).alias("_shifts"))
    joined = df.crossJoin(F.broadcast(table))
    return joined.withColumn(out, pick(
        lambda label: F.coalesce(F.try_element_at(F.col("_shifts"), label), rare))).drop("_shifts")


def _pick_in_session(df, codes, scores, out, max_labels, top1, session, seq, low, high, block_rows):
    """Picks block by block, all blocks side by side.

    A count matters only up to ``SATURATED``, and a block of rows adds to it what it
    picks; so a block is a map from the counts at its entry to those at its exit.
    Every round walks the blocks whose entry counts were wrong the round before,
    adds up what blocks add (one narrow row for each block and code) and so finds
    new entry counts.  After round k the first k blocks of every session are right;
    when no block's entry changes, all are.  Saturated codes stop depending on what
    came before, so a few rounds are the rule."""
    limits = S.count_limits(scores, low=low, high=high)
    ready = df.withColumn("_limits", limits).withColumns({
        "_open": F.filter("_limits", lambda e: e["under"] > 0),
        "_spare": F.transform(F.filter(F.slice("_limits", 1, 1), lambda e: e["score"] >= top1), lambda e: e["label"])}).drop("_limits")
    # Sorted by range, so one session's rows lie in many tasks; a block is at most
    # ``block_rows`` rows of one task, and blocks are numbered in the rows' order.
    placed = materialise(ready.repartitionByRange(session, seq).sortWithinPartitions(session, seq).withColumn(
        "_row", F.monotonically_increasing_id()), "picks-rows").withColumn("_block", F.floor(F.col("_row") / block_rows))
    narrow = placed.select(F.col(session).alias("_session"), "_block", "_row", "_open", "_spare")
    names = codes or [r[0] for r in narrow.select(F.explode(F.concat(F.transform("_open", lambda e: e["label"]), "_spare")).alias("x"))
                      .distinct().where("x is not null").orderBy("x").collect()]
    place, walk = {name: k for k, name in enumerate(names)}, _walker(names, max_labels)
    zeros = F.array_repeat(F.lit(0), len(names))
    entry = narrow.groupBy("_session", "_block").agg(F.first(zeros).alias("counts"))
    same = lambda x, y: x["_session"].eqNullSafe(y["_session"]) & (x["_block"] == y["_block"])
    todo, added = entry, None
    while place:
        new = _joined(narrow, todo, same).groupBy("_session", "_block").applyInPandas(
            lambda pdf: _effect(pdf, walk, len(names)), _schema(narrow, "_session", "_block") + ", added array<int>")
        if added is not None:
            new = new.unionByName(added.join(todo, same(added, todo), "left_anti"))
        added = materialise(new, "picks-added")
        found = materialise(_entries(added, entry), "picks-entries")
        todo = found.where("wrong").select("_session", "_block", "counts")
        entry = found.drop("wrong")
        if todo.isEmpty():
            break
    picks = _joined(narrow, entry, same).groupBy("_session", "_block").applyInPandas(
        lambda pdf: _picked(pdf, walk), "_row long, _picks array<string>").withColumnRenamed("_picks", out)
    return placed.drop("_open", "_spare", "_block").join(picks, "_row").select(*df.columns, out)


def _schema(df: DataFrame, *names: str) -> str:
    return ", ".join(f"{n} {df.schema[n].dataType.simpleString()}" for n in names)


def _joined(narrow: DataFrame, entry: DataFrame, same) -> DataFrame:
    one = entry.withColumnsRenamed({"_session": "_s", "_block": "_b"})
    return narrow.join(one, narrow["_session"].eqNullSafe(one["_s"]) & (narrow["_block"] == one["_b"])).drop("_s", "_b")


def _entries(added: DataFrame, assumed: DataFrame) -> DataFrame:
    """Counts at each block's entry from what the session's earlier blocks add, and
    whether they differ from those assumed."""
    before = Window.partitionBy("_session", "k").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    long = added.select("_session", "_block", F.posexplode("added").alias("k", "n")).select(
        "_session", "_block", "k", F.least(F.coalesce(F.sum("n").over(before), F.lit(0)), F.lit(SATURATED)).cast("int").alias("c"))
    found = long.groupBy("_session", "_block").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "c"))), lambda e: e["c"]).alias("counts"))
    old = assumed.withColumnsRenamed({"_session": "_s", "_block": "_b", "counts": "old"})
    return found.join(old, found["_session"].eqNullSafe(old["_s"]) & (found["_block"] == old["_b"])).select(
        "_session", "_block", "counts", (F.col("counts") != F.col("old")).alias("wrong"))


def _walker(names: list[str], max_labels: int):
    """One pass over a block's rows in order, from the counts at its entry: yields
    each row's picks and the counts after it."""
    def walk(pdf):
        counts = Counter(dict(zip(names, pdf["counts"].iloc[0])))
        allowed = frozenset(names)
        for candidates, spare in zip(pdf["_open"], pdf["_spare"]):
            passing = [e["label"] for e in candidates if counts[e["label"]] < e["under"]]
            picks = [x for x in (passing or list(spare))[:max_labels] if x in allowed]
            counts.update(picks)
            yield picks, counts
    return walk


def _effect(pdf, walk, size: int):
    start, end = pdf["counts"].iloc[0], None
    for _, end in walk(pdf.sort_values("_row")):
        pass
    row = pdf.iloc[:1][["_session", "_block"]].copy()
    row["added"] = [[n - s for n, s in zip(list(end.values())[:size], start)]]
    return row


def _picked(pdf, walk):
    import pandas as pd

    pdf = pdf.sort_values("_row")
    return pd.DataFrame({"_row": pdf["_row"], "_picks": [picks for picks, _ in walk(pdf)]})

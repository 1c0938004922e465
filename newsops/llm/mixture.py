"""Mixing sources to target weights by Pareto order sampling.

Each source's words are brought to a target.  A document is taken a certain
number of whole times, and once more if it is drawn: documents are ranked by
random odds divided by inclusion odds, U/(1-U) : p/(1-p), and the lowest ranks
fill what is left of the target.  DataFrame functions only; texts never move.

No window sees a whole source: ranks fall into bands of about ``BAND`` documents,
sums per band say which band holds the boundary, and only that band is ordered."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsops.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
BAND = 2000
SEED = 17


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> DataFrame:
    """(source, source_size) with target: sources by code point, null last, weigh
    ``weights`` in turn and share ``share`` of all sizes; a target stops at
    ``most`` times its source and the excess is shared anew.

    A source is full when its limit per weight is at most what is left per weight
    once all sources that fill before it are full.  One row per source."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sizes.withColumn("w", F.get(turn, F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))))
    limit = F.col("source_size") * F.lit(most)
    fill = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").isNull(), "source")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    return (weighed.withColumn("limit", limit)
            .withColumn("left", F.sum("source_size").over(everything) * F.lit(share)
                        - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
            .withColumn("level", F.col("left") / F.sum("w").over(after))
            .withColumn("full", F.col("limit") / F.col("w") <= F.col("level"))
            # The first source that isn't full sets the level; behind it the figure only falls.
            .withColumn("level", F.max(F.when(~F.col("full"), F.col("level"))).over(everything))
            .select("source", "source_size",
                    F.when(F.col("full") | F.col("level").isNull(), F.col("limit"))
                    .otherwise(F.col("w") * F.col("level")).alias("target")))


def uniform(*key: Column, seed: int = SEED) -> Column:
    """In (0, 1), from a hash: the same in every run."""
    bits = F.shiftrightunsigned(F.xxhash64(*key, F.lit(seed)), 11)
    return (bits + F.lit(0.5)) / F.lit(float(1 << 53))


def odds(p: Column, key: Column) -> Column:
    """The rank: random odds divided by inclusion odds; null where nothing is left to chance."""
    u = uniform(key)
    return F.when(p > 0, u / (1 - u) * (1 - p) / p)


def pareto(rows: DataFrame, group: str, size: str, copies: str, key: str, band: int = BAND) -> DataFrame:
    """``rows`` with _times: how often each is taken, floor or ceiling of
    ``copies`` (expected, 0 or more).  In each group the sizes drawn come to what
    the fractions of ``copies`` promise, to within half a document at most.

    Null groups are one group; null sizes count 0; rows with the same key get
    the same random number, and ties go by key and size.  ``rows`` is read
    several times: pass a narrow table.  Older working columns are replaced."""
    p = F.col("_p")
    rows = rows.drop("_times", "_p", "_q", "_size", "_band", "_g", "_left", "_bands", "_first", "_cum", "_room")
    ranked = (rows.withColumn("_size", F.coalesce(F.col(size), F.lit(0)).cast("double"))
              .withColumn("_times", F.floor(copies)).withColumn("_p", F.col(copies) - F.floor(copies))
              .withColumn("_q", odds(p, F.col(key))))
    # _q / (1 + _q) lies in (0, 1), so equal steps of it are bands.
    asked = ranked.where("_p > 0").groupBy(F.col(group).alias("_g")).agg(
        F.sum(F.col("_p") * F.col("_size")).alias("_left"), F.ceil(F.count("*") / F.lit(band)).alias("_bands"))
    banded = ranked.join(asked, F.col(group).eqNullSafe(F.col("_g")), "left").withColumn(
        "_band", F.least(F.floor(F.col("_q") / (1 + F.col("_q")) * F.col("_bands")), F.col("_bands") - 1))
    sums = banded.where("_p > 0").groupBy("_g", "_band").agg(
        F.sum("_size").alias("_s"), F.first("_left").alias("_left"))
    up = Window.partitionBy("_g").orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    edges = (sums.withColumn("_first", F.coalesce(F.sum("_s").over(up), F.lit(0.0)))
             .where("_first + _s >= _left").groupBy("_g")
             .agg(F.min_by(F.struct(F.col("_band").alias("at"), (F.col("_left") - F.col("_first")).alias("room")), "_band").alias("_room")))
    edged = banded.join(edges.withColumnRenamed("_g", "_h"), F.col("_g").eqNullSafe(F.col("_h")), "left").drop("_h")
    whole = edged.where("_room is null or _band is null or _band <> _room.at").withColumn(
        "_times", F.col("_times") + F.when(F.col("_band") < F.col("_room.at"), 1).otherwise(0))
    inside, band_of = Window.partitionBy("_g").orderBy("_q", key, "_size"), Window.partitionBy("_g")
    drawn = F.col("_cum") - F.col("_size") / 2 <= F.col("_room.room")
    # What the last document drawn leaves open, one more fills if it comes closer.
    near = F.when(~F.col("_drawn") & (F.abs(F.col("_size") - F.col("_open")) < F.abs("_open")), F.abs(F.col("_size") - F.col("_open")))
    split = (edged.where("_band = _room.at")
             .withColumn("_cum", F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
             .withColumn("_drawn", drawn)
             .withColumn("_open", F.col("_room.room") - F.sum(F.when(F.col("_drawn"), F.col("_size")).otherwise(0.0)).over(band_of))
             .withColumn("_near", near)
             .withColumn("_turn", F.row_number().over(band_of.orderBy(F.col("_near").asc_nulls_last(), "_q", key)))
             .withColumn("_times", F.col("_times") + (F.col("_drawn") | (F.col("_near").isNotNull() & (F.col("_turn") == 1))).cast("int"))
             .drop("_cum", "_drawn", "_open", "_near", "_turn"))
    return whole.unionByName(split).select(*rows.columns, F.col("_times").cast("long").alias("_times"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, _times) of every row of
    ``docs``.  An empty table gives no rows; sources without words get target 0."""
    narrow = materialise(docs.select("doc_id", "source", size_of(F.col("text")).alias("size")), "mix-sizes")
    aims = targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    aimed = narrow.join(aims.withColumnRenamed("source", "_s"),
                        F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s").withColumn(
        "copies", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    return pareto(aimed, "source", "size", "copies", "doc_id").withColumn("taken", F.col("_times") * F.col("size"))


def _place(copies: str, key: str) -> Column:
    p = F.col(copies) - F.floor(copies)
    return F.struct(odds(p, F.col(key)).alias("q"), F.col(key).alias("k"))


def boundaries(mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per source of a mix: its copies, the first place left out of the draw
    (_out) and the last one in it (_in).  All places before _out are drawn; _in may
    lie behind it (the document that fills what the others leave open)."""
    drawn = F.col("_times") > F.floor("copies")
    return mixed.groupBy("source").agg(
        F.first("copies").alias("_copies"), F.min(F.when(~drawn, _place("copies", key))).alias("_out"),
        F.max(F.when(drawn, _place("copies", key))).alias("_in"))


def with_times(docs: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``times``, told from the boundaries of their mix: one row per
    source is joined, no text is shuffled while these are few.  Rows of one source with
    the same key have the same times: if one of them is drawn, all are."""
    joined = docs.join(edges.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    at = _place("_copies", key)
    drawn = (F.col("_copies") > F.floor("_copies")) & (
        F.coalesce(at < F.col("_out"), F.lit(True)) | F.coalesce(at == F.col("_in"), F.lit(False)))
    return joined.withColumn("times", (F.floor("_copies") + drawn.cast("int")).cast("long")).select(*docs.columns, "times")

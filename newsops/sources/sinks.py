"""Writers and persistent state."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsops.functions.codes import join_codes
from newsops.functions.text import non_empty
from newsops.sources.files import path_exists

CSV_COLUMNS = ["text", "label", "importance", "correlations"]
DAILY_COLUMNS = ["text", "label_sentiment", "label_importance", "url", "title", "source",
                 "published_at"]


def write_labelled_csv(df: DataFrame, path: str, quote_all: bool = False, mode: str = "overwrite",
                       partition_by=()) -> None:
    """The four-column dataset, codes joined with ';'.  Written in parallel, one
    file per task."""
    if "correlations" in df.columns and df.schema["correlations"].dataType.typeName() == "array":
        df = df.withColumn("correlations", join_codes("correlations"))
    cols = [*partition_by, *[c for c in CSV_COLUMNS if c in df.columns]]
    (df.select(*cols).write.mode(mode).partitionBy(*partition_by).option("header", True)
     .option("quoteAll", quote_all).option("escape", '"').option("emptyValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_daily(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Daily JSON lines, one folder per date; empty fields are left out.  Rows
    are first brought together by date; a large day is split over as many tasks as
    its size asks for."""
    have = [c for c in DAILY_COLUMNS if c in df.columns]
    rows = df.select(*[non_empty(F.col(c)).alias(c) for c in have], "date")
    (rows.hint("rebalance", F.col("date"))
     .write.mode(mode).partitionBy("date").json(path))


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    from newsops.sources.files import DAILY

    return spark.read.schema(DAILY.replace("date string", "date date")).json(path)


def load_seen(spark: SparkSession, path: str, use_cache: bool = True) -> DataFrame:
    """The seen-hash table; empty when absent or disabled."""
    if not use_cache or not path_exists(spark, path):
        return spark.createDataFrame([], "hash string")
    return spark.read.schema("hash string").parquet(path)


def append_seen(new_hashes: DataFrame, path: str) -> None:
    """Append only hashes that are not there yet, sorted by hash range so that
    later reads can skip row groups."""
    seen = load_seen(new_hashes.sparkSession, path)
    fresh = new_hashes.select("hash").distinct().join(seen, "hash", "left_anti")
    fresh.repartitionByRange("hash").sortWithinPartitions("hash").write.mode("append").parquet(path)


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def as_json(df: DataFrame) -> DataFrame:
    """Each row as one JSON document."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def write_issue_lines(lines: DataFrame, path: str, by: str) -> None:
    """Comment text, one folder per dataset, lines in order."""
    order = ["section", "pos", "phase", "line_number", "line"]
    ranged = lines.repartitionByRange(F.col(by), *order).sortWithinPartitions(by, *order)
    ranged.select(by, "line").write.mode("overwrite").partitionBy(by).text(path)


METRICS = "task string, ts timestamp, f1_macro double"


def load_metrics(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], METRICS)
    return spark.read.schema(METRICS).parquet(path)


def append_metric(current: DataFrame, path: str) -> None:
    current.select("task", "ts", "f1_macro").write.mode("append").parquet(path)

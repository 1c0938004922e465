"""Readers, dataset catalogue and file-name rules."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from newsops.functions.text import col, non_empty, not_blank
from newsops.sources import records

LABELLED = "text string, label string, importance string, correlations string"
DAILY = ("text string, label_sentiment string, label_importance string, url string, "
         "title string, source string, published_at string, date string, label string")
DATED_NAME = r"^news_[0-9]{8}\.csv$"


def spread(df: DataFrame) -> DataFrame:
    """Spread the rows of a scan that has fewer splits than the cluster has cores
    (one small file, one row group), so that text expressions use every core.  A
    large input has more splits than cores and is returned as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(cores) if splits < cores else df


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path or glob matches anything, on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def read_labelled_csv(spark: SparkSession, path, empty: str = "null", multiline: bool | str = True,
                      with_file: bool = False) -> DataFrame:
    """Two-, three- and four-column files as one dataset (their headers are
    prefixes of one schema; missing trailing columns are null).

    ``empty="string"`` turns empty cells into '' (what the validator sees),
    ``"null"`` leaves them null.  ``multiline=False`` lets Spark split large
    files; use it when no quoted cell holds a line break.  ``"split"`` splits large
    files whatever their cells hold, and reads them twice.  ``with_file`` adds
    ``file`` and the ``_block`` start needed for line numbers (``"split"``: the
    ``line_number`` itself)."""
    if multiline == "split":
        return _labelled_in_splits(spark, path, empty, with_file)
    rows = (spark.read.schema(LABELLED).option("header", True).option("multiLine", multiline)
            .option("escape", '"').option("enforceSchema", True).csv(path))
    data = ["text", "label", "importance", "correlations"]
    cells = [F.coalesce(c, F.lit("")).alias(c) if empty == "string" else F.col(c) for c in data]
    meta = [F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_block_start").alias("_block")] if with_file else []
    return rows.select(*cells, *meta)


def _labelled_in_splits(spark: SparkSession, path, empty: str, with_file: bool) -> DataFrame:
    rows, _ = records.cut(spark, path, records.Csv())
    cells = records_cells(rows.where("number > 1"), LABELLED)
    data = ["text", "label", "importance", "correlations"]
    meta = [file_name("file").alias("file"), F.col("number").alias("line_number")] if with_file else []
    return cells.select(*[F.coalesce(f"cells.{c}", F.lit("")).alias(c) if empty == "string" else F.col(f"cells.{c}") for c in data], *meta)


def records_cells(rows: DataFrame, schema: str) -> DataFrame:
    """``rows`` with the cells of each raw CSV record, as one struct."""
    options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    return rows.withColumn("cells", F.from_csv(F.regexp_replace("raw", "\r$", ""), schema, options))


def read_csv_as_is(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """One file under its own header, cells as strings (empty ones as ''), with
    ``file`` and ``line_number``; many tasks read a large one."""
    rows, _ = records.cut(spark, path, records.Csv())
    header = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path).columns
    cells = records_cells(rows.where("number > 1"), ", ".join(f"`{c}` string" for c in header))
    return cells.select(*[F.coalesce(F.col(f"cells.`{c}`"), F.lit("")).alias(c) for c in header],
                        file_name("file").alias("file"), F.col("number").alias("line_number")), header


def read_labelled_json(spark: SparkSession, path: str, split: bool = False) -> DataFrame:
    """A JSON array of {text, label}; any other suffix is an error.  With ``split``
    many tasks read a large file, twice."""
    if not str(path).lower().endswith(".json"):
        raise ValueError(f"Unsupported file type : {path}")
    if split:
        rows, _ = records.cut(spark, path, records.Json())
        return rows.select(F.from_json("raw", LABELLED).alias("r")).select("r.*")
    return spark.read.schema(LABELLED).option("multiLine", True).json(path)


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """CSV or JSON by suffix."""
    if str(path).lower().endswith(".csv"):
        return read_labelled_csv(spark, path)
    return read_labelled_json(spark, path)


def read_jsonl(spark: SparkSession, paths, schema: str = DAILY) -> DataFrame:
    """JSON lines; undecodable lines are skipped, missing paths read as empty."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    present = [p for p in paths if path_exists(spark, p)]
    if not present:
        return spark.createDataFrame([], schema)
    record = F.from_json("value", schema + ", _bad string",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = spark.read.text(present).select(record.alias("r")).filter(
        F.col("r").isNotNull() & F.col("r._bad").isNull())
    return rows.select("r.*").drop("_bad")


def project_task(df: DataFrame, task: str) -> DataFrame:
    """(text, label) for one task: ``label_<task>`` else ``label``; rows need a
    stripped text and a label."""
    from newsops.functions.text import strip

    has = set(df.columns)
    options = [c for c in (f"label_{task}", "label") if c in has]
    label = F.coalesce(*[non_empty(c) for c in options])
    return df.select(strip("text").alias("text"), label.alias("label")).filter(
        not_blank("text") & F.col("label").isNotNull())


def catalog(spark: SparkSession, directory: str, pattern: str = "news_*.csv") -> DataFrame:
    """(path, name, length, modified): only file status is read, no content."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
             .select("path", "length", F.col("modificationTime").alias("modified")))
    return files.select("path", file_name("path").alias("name"), "length", "modified")


def contents(rows: DataFrame, name: str, date: str, columns) -> DataFrame:
    """(name, rows, first_date, last_date, checksum) of each dataset in ``rows``: a
    manifest to keep beside the files.  The checksum is a sum over rows, so it
    doesn't depend on their order, and tells a dataset whose rows changed."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    mark = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return rows.groupBy(F.col(name).alias("name")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(date).alias("first_date"), F.max(date).alias("last_date"), F.sum(mark).alias("checksum"))


def within(rows: DataFrame, manifest: DataFrame, name: str, date: str, low, high) -> DataFrame:
    """Rows dated from ``low`` to ``high``.  ``name`` is the column the files are
    partitioned by: only datasets whose range meets the period are opened."""
    low, high = F.lit(low).cast("date"), F.lit(high).cast("date")
    names = manifest.where((F.col("first_date") <= high) & (F.col("last_date") >= low)).select(F.col("name").alias(name))
    # The names go through the driver as partition values: a few for each day of the period.
    wanted = [r[0] for r in names.distinct().collect()]
    return rows.where(F.col(name).isin(wanted) & F.col(date).between(low, high))


def file_name(path) -> Column:
    return F.substring_index(col(path), "/", -1)


def valid_filename(c) -> Column:
    return F.coalesce(file_name(c).rlike(DATED_NAME), F.lit(False))


def date_from_filename(c) -> Column:
    """The eight digits of ``...news_YYYYMMDD.csv`` (searched, not anchored)."""
    return non_empty(F.regexp_extract(file_name(c), r"news_([0-9]{8})\.csv$", 1))


def latest_dataset(cat: DataFrame, strict: bool = True) -> DataFrame:
    """The highest file name.  ``strict`` admits dated names only; otherwise a
    repaired file's name sorts above every date."""
    rows = cat.filter(valid_filename("name")) if strict else cat.filter(
        F.col("name").startswith("news_") & F.col("name").endswith(".csv"))
    return rows.agg(F.max("name").alias("name"))


def daily_date(c, run_date) -> Column:
    """``news_YYYYMMDD...`` gives that date; anything else the run date."""
    stem = F.regexp_replace(file_name(c), r"\.[^.]*$", "")
    parsed = F.when(stem.startswith("news_") & (F.length(stem) >= 13),
                    F.try_to_date(F.substring(stem, 6, 8), "yyyyMMdd"))
    return F.coalesce(parsed, F.lit(run_date).cast("date"))


def history_window(df: DataFrame, target, days_back: int = 30, max_files: int | None = 10,
                   file: str = "file", date: str = "date") -> DataFrame:
    """Rows of files dated within ``days_back`` days before ``target``, plus
    ``labeled_*`` files, from the newest ``max_files`` (a few) files.  On data written by
    ``write_daily`` the date test prunes partitions."""
    t = F.lit(target).cast("date")
    labelled = F.col(file).startswith("labeled_")
    window = (F.col(date) >= F.date_sub(t, days_back)) & (F.col(date) < t)
    rows = df.filter(F.coalesce(window, F.lit(False)) | labelled)
    if max_files is None:
        return rows
    files = (rows.select(file, date).distinct()
             .orderBy(F.desc_nulls_last(date), F.desc(file)).limit(max_files).select(file))
    return rows.join(F.broadcast(files), file, "left_semi")


def with_line_number(df: DataFrame, by: str = "file", seq: str | None = None) -> DataFrame:
    """Record line number (header is line 1).

    Rows as read (with ``_block``): the rows of a file block lie in one task, in
    order, so a row's number is its position in the block plus the rows of the
    file's earlier blocks.  The rows are written once with their places; only the
    table of blocks is aggregated, and a huge file is numbered by many tasks.  With ``seq`` (an
    integer order, unique per file) the bucketed rank is used."""
    from newsops.operators.ranking import rank_in_group
    from newsops.session import materialise

    if seq is not None:
        ranked = rank_in_group(df, by, seq, "_rank")
        return ranked.withColumn("line_number", F.col("_rank") + 1).drop("_rank")
    # Written once, so that positions and blocks are those of a single scan.
    placed = materialise(df.withColumn("_pos", F.monotonically_increasing_id()), "lines")
    counts = placed.groupBy(by, "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_start"))
    before = Window.partitionBy(by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = materialise(counts.select(
        F.col(by).alias("_file"), F.col("_block").alias("_b"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_start") + 2).alias("_shift")), "blocks")
    keep = [c for c in df.columns if c != "_block"]
    return placed.join(blocks, (F.col(by) == F.col("_file")) & (F.col("_block") == F.col("_b"))).select(
        *keep, (F.col("_pos") + F.col("_shift")).alias("line_number"))

"""The corpus pipeline: five operators of newsops.llm in turn, over ``documents``.

Each stage takes all that the one before it kept, and all but the last return
the columns of documents.  The last returns them with ``times``, how often the
mix takes the document (one row per document taken)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from newsops.llm import decontaminate as DC, jaccard as JJ, langid as LI, mixture as MX, secrets as SE
from newsops.session import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SCORE = 0.5
BATCH, USUAL_ROWS, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"


def counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def in_small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python and back: a tenth of Spark's usual rows at once.  A
    number of rows that the session has been given stays."""
    if spark.conf.get(BATCH, None) in (None, USUAL_ROWS):
        spark.conf.set(BATCH, BATCH_ROWS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that are null or have no letter, and those of which no language
    has half of the letters.  Without a single labelled document nothing is known
    and only the first kind goes.  A null lang becomes the one predicted."""
    in_small_batches(spark)
    docs = docs.select(*COLUMNS)
    model = LI.fit(docs.where(~LI.held_out("doc_id")))
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = LI.identify(docs, model).where((F.col("_lang") != LI.UNKNOWN) & (F.col("_score") >= LEAST_SCORE))
    return found.withColumn("lang", F.coalesce("lang", "_lang")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest doc_id (of rows
    that share it, the first by text, source and lang).  Rows without doc_id stay."""
    in_small_batches(spark)
    docs = docs.select(*COLUMNS)
    groups = materialise(JJ.join(docs), "pipeline-groups")
    # Ids alone are grouped; texts are shuffled only where a doc_id repeats.
    gone = materialise(groups.where("doc_id <> component_id").select("doc_id").distinct(), "pipeline-gone")
    repeated = materialise(groups.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "pipeline-repeated")
    stay = docs.join(gone, "doc_id", "left_anti")
    one = Window.partitionBy("doc_id").orderBy("text", "source", "lang", "n_chars")
    first = stay.join(repeated, "doc_id", "left_semi").withColumn("_row", F.row_number().over(one)).where("_row = 1")
    return stay.join(repeated, "doc_id", "left_anti").select(*COLUMNS).unionByName(first.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts; a text with no word left goes
    if it had any.  Others stay as they are."""
    in_small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return counted(DC.cleaned(docs.select(*COLUMNS), benchmark))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; every document stays."""
    return counted(SE.masked(SE.scan(docs.select(*COLUMNS))))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with ``times``."""
    keyed = docs.select(*COLUMNS).withColumn("_key", F.xxhash64(*COLUMNS))
    mixed = MX.mix(keyed.select(F.col("_key").alias("doc_id"), "source", "text"))
    edges = materialise(MX.boundaries(mixed), "pipeline-boundaries")
    return MX.with_times(keyed, edges, "_key").where("times > 0").select(*COLUMNS, "times")


STAGES = [("language ID", language_id), ("near duplicates", near_duplicates),
          ("decontamination", decontamination), ("secret scan", secrets), ("mixing", mixing)]

#: Models, components and random ranks have no SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs

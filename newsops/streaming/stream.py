"""The daily feed as a stream."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsops.functions.text import article_hash
from newsops.operators import correlate, dedup
from newsops.plans.datasets import Labelling, enrich
from newsops.session import materialise, work_dir
from newsops.sources import seen

ARTICLE = ("title string, text string, content string, site string, publisher string, "
           "url string, publishedDate string, source_type string, ts timestamp")


def article_stream(spark: SparkSession, directory: str, schema: str = ARTICLE, fmt: str = "json",
                   files_per_trigger: int = 100, pattern: str | None = None) -> DataFrame:
    """Files landing in a folder, a bounded number per micro-batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.format(fmt).load(directory)


def stream_dedup(df: DataFrame, ts: str = "ts", delay: str = "7 days", key: str = "title") -> DataFrame:
    """Bounded dedup: a fingerprint is remembered until the watermark passes it;
    older repeats may be admitted again.  ``exact_dedup`` never forgets."""
    return (df.withColumn("hash", article_hash(key)).withWatermark(ts, delay)
            .dropDuplicatesWithinWatermark(["hash"]))


def exact_dedup(df: DataFrame, out: str, known: str, checkpoint: str, seq: str = "seq",
                key: str = "title"):
    """Exact dedup: each micro-batch drops what the seen table holds, keeps the
    first of every fingerprint and adds the new ones.  State lives in storage.
    Both writes go to the batch's own folder, so a repeated batch replaces its
    earlier attempt."""
    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("hash", article_hash(key))
        earlier = read_batches(spark, known, "hash string").filter(F.col("batch_id") < batch_id)
        fresh = dedup.drop_seen(dedup.dedup_first(rows, "hash", seq), earlier, "hash")
        fresh.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        written = spark.read.parquet(f"{out}/batch_id={batch_id}")
        written.select("hash").write.mode("overwrite").parquet(f"{known}/batch_id={batch_id}")

    return df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)


def store_dedup(df: DataFrame, out: str, store: str, checkpoint: str, seq: str = "seq", key: str = "title"):
    """Exact dedup against a store by prefix: a micro-batch opens only the files
    that may hold one of its fingerprints, however much was ever seen.  A batch is
    a run of the store, so one that is repeated neither meets its own fingerprints
    nor adds them twice, and its rows replace those of its earlier attempt."""
    def step(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, f"batch-{batch_id}"
        rows = materialise(dedup.dedup_first(batch.withColumn("hash", article_hash(key)), "hash", seq), "stream-batch")
        seen.drop_seen(rows, store, "hash", without=run).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        seen.append(spark.read.parquet(f"{out}/batch_id={batch_id}").select("hash"), store, run, fresh=True)

    return df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    from newsops.sources.files import path_exists

    full = schema + ", batch_id bigint"
    if not path_exists(spark, f"{path}/batch_id=*"):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def period_counts(df: DataFrame, ts: str = "ts", label: str = "label", period: str = "7 days",
                  delay: str = "30 days") -> DataFrame:
    """Rows per tumbling period and label; state is one counter per pair and is
    dropped behind the watermark."""
    if df.isStreaming:
        df = df.withWatermark(ts, delay)
    return (df.groupBy(F.window(ts, period).alias("w"), F.col(label).alias("label"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("period_start"), "label", "n"))


def enrich_stream(df: DataFrame, cfg: Labelling = Labelling()) -> DataFrame:
    """Labelling is per row, so it runs unchanged on a stream."""
    return enrich(df, cfg)


def label_with_rarity(df: DataFrame, codes, out: str, counts: str, checkpoint: str,
                      scores: str = "scores", low: float = 0.22, high: float = 0.55):
    """Picks codes with rarity counts carried from batch to batch: each
    micro-batch uses the sum of the earlier ones."""
    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = (read_batches(spark, counts, "code string, n bigint")
                 .filter(F.col("batch_id") < batch_id).groupBy("code").agg(F.sum("n").alias("n")))
        picked = correlate.pick_labels(batch, codes, scores, counts=known, low=low, high=high)
        picked.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        written = spark.read.parquet(f"{out}/batch_id={batch_id}")
        correlate.code_counts(written).write.mode("overwrite").parquet(f"{counts}/batch_id={batch_id}")

    return df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)


def append_daily(df: DataFrame, path: str, checkpoint: str):
    """Append to one folder per date."""
    return (df.writeStream.format("json").partitionBy("date").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append"))


def run_available(writer) -> None:
    """Process everything that is there, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def drain(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a streaming frame over the available input and read back its result
    table.  ``complete`` results replace the table at every batch."""
    spark = df.sparkSession
    out, checkpoint = work_dir(spark, name), work_dir(spark, f"{name}-state")
    if mode == "append":
        run_available(df.writeStream.format("parquet").option("path", out)
                      .option("checkpointLocation", checkpoint))
    else:
        run_available(df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
                      .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(out)))
    return spark.read.schema(df.schema).parquet(out)

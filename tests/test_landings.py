"""A stream that stops, starts again and repeats a batch."""
import os

from newsops.functions.text import article_hash
from newsops.sources import seen
from newsops.streaming import stream
from pyspark.sql import functions as F


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    feed, out, store, state = (str(tmp_path / n) for n in ("feed", "out", "store", "state"))
    schema = "seq bigint, title string"

    def land(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(feed)

    def run():
        rows = stream.article_stream(spark, feed, schema, "parquet")
        stream.run_available(stream.store_dedup(rows, out, store, state))
        back = stream.read_batches(spark, out, "seq bigint, title string, hash string")
        return sorted((r["batch_id"], r["seq"]) for r in back.collect())

    want = []
    for k in range(4):
        land([(10 * k + i, f"title {(7 * k + i) % 23}") for i in range(10)])
        known = {f"title {(7 * j + i) % 23}" for j in range(k) for i in range(10)}
        want += [(k, 10 * k + i) for i in range(10) if f"title {(7 * k + i) % 23}" not in known]
        assert run() == want
    # The last batch's commit is lost: it runs again, against a store that has its hashes.
    os.remove(os.path.join(state, "commits", "3"))
    crc = os.path.join(state, "commits", ".3.crc")
    if os.path.exists(crc):
        os.remove(crc)
    size = seen.manifest(spark, store).agg(F.sum("n")).first()[0]
    assert run() == want and seen.manifest(spark, store).agg(F.sum("n")).first()[0] == size == len(want)
    titles = spark.createDataFrame([(f"title {i}",) for i in range(23)], "t string").select(article_hash("t").alias("hash"))
    assert seen.seen_among(titles, store).count() == 23

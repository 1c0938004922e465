"""Session defaults and the shared working folder."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "newsops") -> SparkSession:
    """Session for tests and benches.  On a cluster the session comes from
    spark-submit; only settings that change results or plans matter there:
    UTC, AQE with skew join, and a shuffle width sized to the cluster."""
    width = "8" if cores == "*" else str(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", width)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def on_one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for tables written between stages: under the shared
    folder named by ``spark.checkpoint.dir``; a temporary one only where that
    is unset and the master is local (single-machine tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not on_one_machine(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="newsops-")
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def materialise(df, name: str):
    """Write ``df`` to the shared folder and read it back: the result outlives
    lost executors and is computed once."""
    path = work_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

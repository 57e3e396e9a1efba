"""Session for local runs and tests. On a cluster, pass in your own session."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, app: str = "tamiz") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, prefix: str) -> str:
    """A new folder below the shared folder named in ``spark.checkpoint.dir``.

    Only a session without that setting (a local test) gets a folder in /tmp.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        return tempfile.mkdtemp(prefix=f"{prefix}-")
    return f"{shared.rstrip('/')}/{prefix}-{os.urandom(8).hex()}"


def written(df: DataFrame, prefix: str) -> DataFrame:
    """``df`` written once as Parquet below the shared scratch folder and read again."""
    path = f"{scratch_dir(df.sparkSession, prefix)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

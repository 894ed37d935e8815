"""Session set-up and durable intermediate results."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "cellsurvey", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine. A cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` of the session.

    Only a local session without the setting gets a temporary folder; a cluster without it is
    an error, because a folder of one machine does not outlive that machine.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cellsurvey-"))
        folder = sc.getCheckpointDir()
    return folder


_written: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for a written intermediate table."""
    path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    _written.append(path)
    return path


def drop_scratch(spark: SparkSession) -> None:
    """Remove the intermediate tables written so far, once the results that read them have been used."""
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Remove a table of ``durable`` early, once everything made of it is written and nothing reads it any more."""
    spark = df.sparkSession
    for folder in {os.path.dirname(file) for file in df.inputFiles()}:
        if any(folder.endswith(os.path.basename(path)) for path in _written):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once as a table in the shared folder and read it back.

    Compared with a checkpoint of the rows, the table is columnar (later steps read only the columns
    they need) and its true size is known to the planner, so small results are broadcast.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

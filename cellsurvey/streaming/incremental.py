"""Incremental forms of the stage work sets and of the growth counts.

Each stream runs with ``availableNow``: it takes what has landed since the last run and ends. Batches are
written under their batch id, so a batch repeated after a failure overwrites itself. Checkpoints and
sinks belong in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def landed(spark: SparkSession, folder: str, like: DataFrame, pattern: str | None = None, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """Stream over the files that land in a folder, with the schema of ``like``."""
    reader = spark.readStream.schema(like.schema).format(fmt)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def run_available(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Process everything that has landed and stop."""
    query = (
        stream.writeStream.outputMode(mode).foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _into(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def update_ledger(todo: DataFrame, done_path: str, sink: str, checkpoint: str, key: str = "id") -> None:
    """Append the ids of the to-do stream that are new and not done.

    No streaming state is kept: in every batch, the done table is listed and read anew and the ids of earlier batches
    are read back from the sink. A batch that is run again replaces its own folder, which it does not look at.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = batch.distinct().join(spark.read.parquet(done_path).select(key), key, "left_anti")
        if batch_id > 0:
            schema = f"`{key}` {batch.schema[key].dataType.simpleString()}, batch_id bigint"
            known = spark.read.schema(schema).parquet(sink).filter(F.col("batch_id") < batch_id)
            fresh = fresh.join(known.select(key), key, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    run_available(todo.select(key), write, checkpoint)


def read_ledger(spark: SparkSession, sink: str, key: str = "id") -> DataFrame:
    return spark.read.parquet(sink).select(key).distinct()


def update_growth(
    cells: DataFrame, time: str, by: str, sink: str, checkpoint: str, period: str = "1 day", lateness: str | None = None
) -> None:
    """Cells per (period, project) as they land; each batch writes the counts it changed.

    Without ``lateness`` no row is ever too late and the state holds one count per period and project.
    With it, periods older than the newest event less the lateness are closed.
    """
    events = cells.withWatermark(time, lateness) if lateness else cells
    counts = events.groupBy(F.window(time, period).alias("w"), F.col(by)).agg(F.count(F.lit(1)).alias("n"))
    run_available(counts.select(F.col("w.start").alias("period"), by, "n"), _into(sink), checkpoint, "update")


def read_growth(spark: SparkSession, sink: str, by: str) -> DataFrame:
    """Cells and projects per period: the newest count of every (period, project) is the valid one."""
    newest = spark.read.parquet(sink).groupBy("period", by).agg(F.max_by("n", "batch_id").alias("n"))
    return newest.groupBy("period").agg(F.sum("n").alias("n_cells"), F.count(F.lit(1)).alias("n_projects"))


def update_totals(counts: DataFrame, keys: list[str], value: Column, sink: str, checkpoint: str) -> None:
    """Totals per key as counts land: per-batch partial sums, added up when read."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy(*keys).agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n_rows")) \
            .write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    run_available(counts, write, checkpoint)


def read_totals(spark: SparkSession, sink: str, keys: list[str]) -> DataFrame:
    return spark.read.parquet(sink).groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("n_rows").alias("n_rows"))

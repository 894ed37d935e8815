"""Queries that run a stream over the landed table to its end and read the sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsurvey.plans.bindings import Tables
from cellsurvey.plans.registry import query
from cellsurvey.session import scratch_path
from cellsurvey.streaming import incremental


def _events(t: Tables) -> DataFrame:
    return incremental.landed(t.spark, t.folder, t.events, "events.parquet")


@query("stream_growth", "SELECT strftime(ts, '%Y-%m-%d') AS period, count(*) AS n_cells, count(DISTINCT user_id) AS n_projects FROM events GROUP BY 1")
def stream_growth(t: Tables) -> DataFrame:
    """Events as cells, users as projects."""
    sink, checkpoint = scratch_path(t.spark, "growth"), scratch_path(t.spark, "growth-state")
    incremental.update_growth(_events(t), "ts", "user_id", sink, checkpoint)
    return incremental.read_growth(t.spark, sink, "user_id").withColumn("period", F.date_format("period", "yyyy-MM-dd"))


@query("stream_ledger", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def stream_ledger(t: Tables) -> DataFrame:
    """Users seen in the event stream whose customer is not done yet."""
    sink, checkpoint = scratch_path(t.spark, "ledger"), scratch_path(t.spark, "ledger-state")
    done = scratch_path(t.spark, "done")
    t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("id")).write.parquet(done)
    incremental.update_ledger(_events(t).select(F.col("user_id").cast("string").alias("id")), done, sink, checkpoint)
    return incremental.read_ledger(t.spark, sink)


@query("stream_totals", "SELECT event_type, CAST(sum(event_id) AS BIGINT) AS total, count(*) AS n_rows FROM events GROUP BY 1")
def stream_totals(t: Tables) -> DataFrame:
    sink, checkpoint = scratch_path(t.spark, "totals"), scratch_path(t.spark, "totals-state")
    incremental.update_totals(_events(t), ["event_type"], F.col("event_id"), sink, checkpoint)
    return incremental.read_totals(t.spark, sink, ["event_type"])

"""Order statistics inside groups that may be far larger than one task.

A window over ``partitionBy(group)`` sends the whole group to one task. Here the rows are range
partitioned on (group, order) instead, so a group of any size is spread over many tasks; each
slice is summed on its own and the few slice totals are carried forward.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellsurvey.session import durable

_SLICE = "__slice"


def _orders(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def running_totals(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], sums: Sequence[str],
    suffix: str = "_before",
) -> DataFrame:
    """Add, for every column in ``sums``, its total over the earlier rows of the group.

    ``order`` has to be a total order inside the group. The slices are materialised, because the
    slice totals and the rows have to see the very same range boundaries.
    """
    order = _orders(order)
    sliced = durable(
        df.repartitionByRange(*[F.col(c) for c in group], *order)
        .withColumn(_SLICE, F.spark_partition_id())
    )
    inside = Window.partitionBy(_SLICE, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # one row per (group, slice): at most groups + slices rows in all
    slices = sliced.groupBy(_SLICE, *group).agg(*[F.sum(c).alias(c) for c in sums])
    carried = Window.partitionBy(*group).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = slices.select(
        _SLICE, *group, *[F.coalesce(F.sum(c).over(carried), F.lit(0)).alias(f"__carry_{c}") for c in sums]
    )
    local = sliced.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"__in_{c}") for c in sums])
    return local.join(carry, [_SLICE, *group]).select(
        *df.columns, *[(F.col(f"__in_{c}") + F.col(f"__carry_{c}")).alias(f"{c}{suffix}") for c in sums]
    )


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], name: str) -> DataFrame:
    """1-based position of each row in its group (``row_number`` without the one-task window)."""
    one = df.withColumn("__one", F.lit(1).cast("bigint"))
    return running_totals(one, group, order, ["__one"]).select(
        *df.columns, (F.col("__one_before") + 1).alias(name)
    )


def with_neighbours(
    df: DataFrame, group: Sequence[str], position: str, cols: Sequence[str], span: int = 65536
) -> DataFrame:
    """Add ``prev_<c>`` and ``next_<c>`` of the rows at position - 1 and position + 1.

    Rows are cut into spans of fixed length and the rows at the edges are copied to the span next
    door, so no task needs more than ``span`` + 2 rows.
    """
    at = lambda shift: F.floor((F.col(position) + shift) / F.lit(span))
    copied = df.withColumn("__span", F.explode(F.array_distinct(F.array(at(-1), at(0), at(1)))))
    w = Window.partitionBy(*group, "__span").orderBy(position)
    seen = copied.select(
        "*",
        *[F.lag(c).over(w).alias(f"prev_{c}") for c in cols],
        *[F.lead(c).over(w).alias(f"next_{c}") for c in cols],
    )
    return seen.filter(F.col("__span") == at(0)).drop("__span")


def tie_histogram(df: DataFrame, group: Sequence[str], value: str, extra: Sequence[Column] = ()) -> DataFrame:
    """(group, value) -> n, with the average-tie rank of the value in ``rank``.

    Equal values are merged before anything is ordered, so a value shared by a third of all rows
    is one row of the histogram.
    """
    hist = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"), *extra)
    ranked = running_totals(hist, group, [value], ["n"])
    return ranked.withColumn("rank", F.col("n_before") + (F.col("n") + 1) / 2).drop("n_before")


def average_rank(df: DataFrame, group: Sequence[str], value: str, name: str = "rank") -> DataFrame:
    """Rank with ties averaged, ascending, in groups of any size."""
    ranks = tie_histogram(df, group, value).select(*group, value, F.col("rank").alias(name))
    return df.join(ranks, [*group, value])


def average_rank_window(group: Sequence[str], value: str) -> Column:
    """The same rank as a window expression, for groups with a known small bound."""
    ordered = Window.partitionBy(*group).orderBy(value)
    tied = Window.partitionBy(*group, value)
    return F.rank().over(ordered) + (F.count(F.lit(1)).over(tied) - 1) / 2


def exact_median(df: DataFrame, group: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """Exact median per group: middle of the value histogram, found by running counts."""
    hist = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"))
    run = running_totals(hist, group, [value], ["n"])
    totals = durable(hist.groupBy(*group).agg(F.sum("n").alias("total")))  # of known size
    low, high = F.floor((F.col("total") + 1) / 2), F.floor((F.col("total") + 2) / 2)
    holds = lambda k: (F.col("n_before") < k) & (k <= F.col("n_before") + F.col("n"))
    return (
        run.join(totals, list(group))
        .filter(holds(low) | holds(high))
        .groupBy(*group)
        .agg(((F.min(value) + F.max(value)) / 2).alias(name))
    )

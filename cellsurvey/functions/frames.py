"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, names: DataFrame, col: str) -> DataFrame:
    """One copy of every row of ``df`` per value of ``names.col`` (gene list x projects).

    The values are read as one scalar array, so ``names`` has to be a dimension whose grid with
    ``df`` is the wanted result anyway.
    """
    values = names.agg(F.sort_array(F.collect_set(col)).alias("v")).scalar()
    return df.select("*", F.explode(values).alias(col))


def long_form(df: DataFrame, keys: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """Wide metric columns -> (keys, stat, value) rows; a narrow step."""
    return df.unpivot(list(keys), list(stats), "stat", "value")


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL where the denominator is 0."""
    return F.when(den != 0, num / den)

"""Numeric helpers that Spark has no built-in for."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.DoubleType())
def normal_upper_tail(z: pd.Series) -> pd.Series:
    """P(Z > z) of the standard normal. Used on one row per term."""
    return z.map(lambda x: None if x is None or math.isnan(x) else 0.5 * math.erfc(x / math.sqrt(2.0)))

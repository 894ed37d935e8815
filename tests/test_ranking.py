"""Distributed order statistics against pandas, with one group holding most rows and heavy ties."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellsurvey.functions import ranking


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": np.where(rng.random(5000) < 0.7, "hot", rng.choice(list("abc"), 5000)), "v": rng.integers(0, 40, 5000).astype(float)})
    pdf.loc[rng.random(5000) < 0.4, "v"] = 7.0
    pdf["id"] = np.arange(5000)
    pdf["w"] = rng.integers(0, 9, 5000)
    return pdf, spark.createDataFrame(pdf).repartition(5)


def test_running_totals_and_numbers(data):
    pdf, df = data
    got = ranking.running_totals(df, ["g"], [F.desc("v"), "id"], ["w"]).toPandas().sort_values("id")
    want = pdf.sort_values(["v", "id"], ascending=[False, True])
    want = (want.groupby("g")["w"].cumsum() - want["w"]).sort_index()
    assert (got["w_before"].to_numpy() == want.to_numpy()).all()
    pos = ranking.number_rows(df, ["g"], ["v", "id"], "p").toPandas().sort_values("id")
    want = pdf.sort_values(["v", "id"]).groupby("g").cumcount().sort_index() + 1
    assert (pos["p"].to_numpy() == want.to_numpy()).all()


def test_average_rank_and_median(data):
    pdf, df = data
    got = ranking.average_rank(df, ["g"], "v").toPandas().sort_values("id")
    assert np.allclose(got["rank"], pdf.groupby("g")["v"].rank())
    window = df.withColumn("r", ranking.average_rank_window(["g"], "v")).toPandas().sort_values("id")
    assert np.allclose(window["r"], pdf.groupby("g")["v"].rank())
    med = ranking.exact_median(df, ["g"], "v").toPandas().set_index("g")["median"]
    assert med.to_dict() == pdf.groupby("g")["v"].median().to_dict()


def test_neighbours_across_spans(spark):
    df = spark.range(1, 101).select(F.lit("a").alias("g"), F.col("id").alias("p"), (F.col("id") * 2).alias("x"))
    got = ranking.with_neighbours(df, ["g"], "p", ["x"], span=7).orderBy("p").collect()
    assert len(got) == 100
    assert [r.prev_x for r in got] == [None] + [2 * i for i in range(1, 100)]
    assert [r.next_x for r in got] == [2 * i for i in range(2, 101)] + [None]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-3, 3), min_size=1, max_size=30))
def test_rank_property(spark, values):
    df = spark.createDataFrame([("g", float(v), i) for i, v in enumerate(values)], "g string, v double, id int")
    got = ranking.average_rank(df, ["g"], "v").toPandas().sort_values("id")["rank"]
    assert np.allclose(got, pd.Series(values).rank())

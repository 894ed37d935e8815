"""Summaries, histograms and annotation on small cases."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellsurvey.functions.frames import long_form
from cellsurvey.operators import annotation, summary
from cellsurvey.streaming import incremental


def test_histogram_edges(spark):
    df = spark.createDataFrame([("P", float(v)) for v in (0, 1, 2, 3, 4, 5, 10)] + [("Q", 5.0), ("Q", None), ("Q", float("nan"))], "proj_id string, x double")
    long = long_form(df, ["proj_id"], ["x"])
    h = summary.histogram(long, summary.histogram_breaks(long), ["proj_id"], n_bins=5).toPandas()
    p = h[h.proj_id == "P"].sort_values("bin")
    assert p["n"].tolist() == np.histogram([0, 1, 2, 3, 4, 5, 10], 5)[0].tolist()
    assert np.allclose(p["density"], np.histogram([0, 1, 2, 3, 4, 5, 10], 5, density=True)[0])
    for _, g in h.groupby("proj_id"):
        assert math.isclose((g["density"] * (g["upper"] - g["lower"])).sum(), 1.0)
    assert h[h.proj_id == "Q"]["n"].sum() == 1


def test_equal_values_get_a_range(spark):
    df = spark.createDataFrame([("P", 2.0), ("P", 2.0)], "proj_id string, x double")
    b = summary.histogram_breaks(long_form(df, ["proj_id"], ["x"])).collect()[0]
    assert (b.lo, b.hi) == (1.5, 2.5)


def test_global_auroc_of_identical_projects(spark):
    df = spark.createDataFrame([(p, float(v)) for p in "PQ" for v in range(20)], "proj_id string, x double")
    h = summary.project_histograms(df, ["x"])
    a = summary.global_auroc(h, summary.global_heights(h))
    assert {r.auroc for r in a.collect()} == {0.5}
    assert {r.ranked_auroc for r in summary.rank_across_projects(a).collect()} == {0.75}


def test_header_box_and_attributes(spark):
    cells = spark.createDataFrame([("P", "r1", "e", "s1", "10xv2")] * 3 + [("P", "r2", "e", "s2", "smartseq")], "proj_id string, run_id string, exp_id string, samp_id string, tech string")
    runs = spark.createDataFrame([("P", "r1", "2021-01-01 00:00:00"), ("P", "r2", "2021-01-03 00:00:00"), ("P", "r3", "2030-01-01 00:00:00")], "proj_id string, run_id string, d string").withColumn("publish_date", F.to_timestamp("d")).drop("d")
    b = summary.header_box(cells, runs).collect()[0]
    assert (b.n_cells, b.n_runs, b.n_exps, b.n_samp, b.tech_count) == (4, 2, 1, 2, {"10xv2": 3, "smartseq": 1})
    assert str(b.publish_date) == "2021-01-02 00:00:00"
    samples = spark.createDataFrame([("P", "s1", {"a": "x", "source_name": "n"}), ("P", "s2", {"a": "y", "b": None})], "proj_id string, samp_id string, attributes map<string,string>")
    got = {(r.attribute, r.value): r.n_cells for r in summary.sample_attribute_counts(cells, samples).collect()}
    assert got == {("a", "x"): 3, ("source_name", "n"): 3}  # one cell only is left out
    assert [(r.source_name, r.n_cells) for r in summary.source_name_counts(cells, samples).collect()] == [("n", 3)]
    assert summary.project_technology(cells).collect()[0].tech == "mixture"


@pytest.fixture(scope="module")
def enrichment(spark):
    rng = np.random.default_rng(2)
    rows = [("P", i, f"t{j}", float(rng.integers(0, 4))) for i in range(9) for j in range(4)]  # many ties
    return rows, spark.createDataFrame(rows, "proj_id string, cell_id long, cell_type string, value double")


def test_pr_curve(enrichment):
    rows, df = enrichment
    ordered = sorted(rows, key=lambda r: (-r[3], r[1], r[2]))
    seen, tp = set(), []
    for r in ordered:
        seen.add(r[1])
        tp.append(len(seen))
    got = annotation.pr_curve(df).orderBy("P").collect()
    assert [g.TP for g in got] == tp and [g.P for g in got] == list(range(1, 37)) and got[-1].recall == 1.0
    x = np.r_[0, [g.recall for g in got], 1]
    y = np.r_[1, [g.precision for g in got], 0]
    area = float(((x[1:] - x[:-1]) * (y[1:] + y[:-1]) / 2).sum())
    assert math.isclose(annotation.auprc(df).collect()[0].auprc, area)


def test_assignment_rules(spark):
    s = spark.createDataFrame([("P", 1, "A", "A-1", 2.0), ("P", 1, "B", "B-1", 3.0), ("P", 2, "A", "A-1", 0.0), ("P", 2, "B", "B-1", 0.0), ("P", 3, "A", "A-2", 1.0), ("P", 3, "A", "A-1", 1.0)], "proj_id string, cell_id long, group string, cell_type string, score double")
    flat = {r.cell_id: r.predicted for r in annotation.assign_cells(s).collect()}
    assert flat == {1: "B-1", 2: "unassigned", 3: "A-1"}
    classes = spark.createDataFrame([("P", 1, "A"), ("P", 2, "A"), ("P", 3, "C")], "proj_id string, cell_id long, predicted string")
    hier = {r.cell_id: r.predicted for r in annotation.assign_cells(s, classes).collect()}
    assert hier == {1: "A-1", 2: "unassigned", 3: "unassigned"}


def test_streams_over_several_batches(spark, tmp_path):
    land, like = tmp_path / "land", None
    for i, rows in enumerate(([("2021-01-01 05:00:00", "a"), ("2021-01-01 06:00:00", "b")], [("2021-01-01 07:00:00", "a"), ("2021-01-02 00:00:00", "a")])):
        df = spark.createDataFrame(rows, "t string, id string").select(F.to_timestamp("t").alias("ts"), "id")
        df.coalesce(1).write.mode("append").parquet(str(land))
        like = df
        stream = incremental.landed(spark, str(land), like, files_per_batch=1)
        incremental.update_growth(stream, "ts", "id", str(tmp_path / "g"), str(tmp_path / "gc"))
        done = str(tmp_path / "done")
        spark.createDataFrame([("b",)], "id string").write.mode("overwrite").parquet(done)
        incremental.update_ledger(incremental.landed(spark, str(land), like).select("id"), done, str(tmp_path / "l"), str(tmp_path / "lc"))
    got = {str(r.period)[:10]: (r.n_cells, r.n_projects) for r in incremental.read_growth(spark, str(tmp_path / "g"), "id").collect()}
    assert got == {"2021-01-01": (3, 2), "2021-01-02": (1, 1)}
    assert [r.id for r in spark.read.parquet(str(tmp_path / "l")).collect()] == ["a"]  # once, though it came in both batches


def test_marker_statistics_rank_a_gene_in_one_task_or_many(spark, monkeypatch):
    """Ties, silent cells, types without hits and missing names; genes of groups of bounded size are moved once and not range partitioned."""
    rng = np.random.default_rng(3)
    labels = [(f"P{c % 2}", c, None if c == 39 else "all", None if c == 38 else f"t{c % 5 % 3}") for c in range(40)] + [("P2", 99, "all", "t0")]
    labels += [("P0", 0, "all", "t0"), ("P0", 2, "own", "t1"), ("P0", 4, "own", "t0")]  # listed twice; in two groups
    hits = [(f"P{c % 2}", c, g, float(rng.integers(1, 4)) * 100) for c in range(40) for g in range(6) if rng.random() < 0.4 or g == 5] + [("P1", 1, None, 7.0)]
    cpm = spark.createDataFrame(hits, "proj_id string, cell_id int, gene_id int, cpm double")
    cells = spark.createDataFrame(labels, "proj_id string, cell_id int, group string, cell_type string")
    order = ["proj_id", "group", "cell_type", "gene_id"]
    spread = annotation.marker_statistics(cpm, cells, most_cells=0).toPandas().sort_values(order, ignore_index=True)
    mixed = annotation.marker_statistics(cpm, cells, most_cells=15).toPandas().sort_values(order, ignore_index=True)

    def never(*args, **kwargs):
        raise AssertionError("range partitioned")

    monkeypatch.setattr(annotation, "running_totals", never)
    one = annotation.marker_statistics(cpm, cells)
    got = one.toPandas().sort_values(order, ignore_index=True)
    pd.testing.assert_frame_equal(got, spread, check_dtype=False)
    pd.testing.assert_frame_equal(got, mixed, check_dtype=False)
    value = {(p, c, g): x for p, c, g, x in hits}
    seen = 0
    for r in got[got.cell_type.notna()].itertuples():
        of = [(t, value.get((p, c, r.gene_id), 0.0)) for p, c, group, t in labels if (p, group) == (r.proj_id, r.group)]
        a, b = (np.array([x for t, x in of if (t == r.cell_type) is side]) for side in (True, False))
        auroc = np.mean((a[:, None] > b) + (a[:, None] == b) / 2)
        assert np.allclose([r.auroc, r.mean_in, r.mean_out, r.detection_in, r.detection_out], [auroc, a.mean(), b.mean(), (a > 0).mean(), (b > 0).mean()])
        seen += 1
    assert seen == 6 * (3 + 3) + len(got[got.group == "own"]) and got.gene_id.notna().all()
    assert "rangepartitioning" not in one._jdf.queryExecution().executedPlan().toString()

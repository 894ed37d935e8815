"""Cell metrics against dense recomputation, and the edge cases of the definitions."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellsurvey.operators import cellqc

N_CELLS, N_GENES = 12, 30


@pytest.fixture(scope="module")
def dense():
    rng = np.random.default_rng(3)
    x = rng.poisson(0.7, (N_CELLS, N_GENES)) * rng.integers(1, 4, (N_CELLS, N_GENES))
    x[0] = 0          # a cell without counts
    x[3, :] = 2       # a cell whose counts are all equal
    return x


@pytest.fixture(scope="module")
def frames(spark, dense):
    c, g = np.nonzero(dense)
    counts = spark.createDataFrame(pd.DataFrame({"proj_id": "P", "cell_id": c, "gene_id": g, "n": dense[c, g]}))
    cells = spark.createDataFrame(pd.DataFrame({"proj_id": "P", "cell_id": np.arange(N_CELLS)}))
    genes = spark.createDataFrame(pd.DataFrame({"proj_id": "P", "gene_id": np.arange(N_GENES)})).withColumns({
        "a": F.col("gene_id") < 5, "none": F.lit(False), "every": F.lit(True), "rest": F.col("gene_id") >= 5})
    return counts, cells, genes


def by_cell(df):
    return df.toPandas().sort_values("cell_id").reset_index(drop=True)


def test_metrics(frames, dense):
    counts, cells, genes = frames
    moments = cellqc.gene_moments(counts, genes, cells)
    m = moments.toPandas().sort_values("gene_id")
    assert np.allclose(m["mean"], dense.mean(0)) and np.allclose(m["variance"], dense.var(0, ddof=1))
    got = by_cell(cellqc.cell_metrics(counts, cells, moments, ["a", "none", "every", "rest"], top=(5, 50)))
    assert (got["total_counts"] == dense.sum(1)).all() and (got["n_genes_by_counts"] == (dense > 0).sum(1)).all()

    def gini(v):
        s = np.sort(v)
        return 0.0 if s.sum() == 0 else (N_GENES + 1 - 2 * np.cumsum(s).sum() / s.sum()) / N_GENES
    assert np.allclose(got["gini"], [gini(r) for r in dense])
    assert np.allclose(got["log1p_gini"], [gini(np.log1p(r)) for r in dense])

    ranks = pd.DataFrame(dense).rank(axis=1).to_numpy()
    auc = (ranks[:, :5].sum(1) / 5 - 3) / (N_GENES - 5)
    assert np.allclose(got["a"], auc) and got["a"][0] == 0.5
    assert np.allclose(got["a"] + got["rest"], 1.0)  # the complement
    assert got["none"].isna().all() and got["every"].isna().all()

    corr = [np.corrcoef(r, dense.mean(0))[0, 1] if r.std() > 0 else np.nan for r in dense]
    assert np.isnan(got["corr_to_mean"][0]) and np.isnan(got["corr_to_mean"][3])
    assert np.allclose(got["corr_to_mean"], corr, equal_nan=True)

    top = [np.sort(r)[::-1][:5].sum() * 100 / r.sum() if r.sum() else np.nan for r in dense]
    assert np.allclose(got["pct_counts_in_top_5_genes"], top, equal_nan=True)
    assert np.allclose(got["pct_counts_in_top_50_genes"][1:], 100.0)
    assert np.allclose(got["pct_counts_every"][1:], 100.0) and got["log1p_total_counts_none"].eq(0).all()


def test_many_sets_and_rows_that_go_to_their_cell_once(spark, frames):
    """More sets than flags of one number; the rows are merged by value where the cell lies, not before."""
    counts, cells = (frames[0], frames[1])
    genes = counts.select("proj_id", "gene_id").distinct()
    names = [f"s{i}" for i in range(130)]
    genes = genes.select("*", *[F.when(F.col("gene_id") % 7 != 3, F.col("gene_id") % (i + 2) == 0).alias(s) for i, s in enumerate(names)])
    found = cellqc.cell_metrics(counts, cells, genes, names, parts=("share",), top=())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan and not re.search(r"hashpartitioning\(proj_id#\d+\w*, cell_id#\d+\w*, v#", plan)
    sums = counts.join(genes, ["proj_id", "gene_id"]).groupBy("proj_id", "cell_id").agg(
        *[(F.coalesce(F.sum(F.when(F.col(s), F.col("n"))), F.lit(0)) * 100.0 / F.sum("n")).alias(s) for s in names])
    want = {(r.proj_id, r.cell_id): r for r in sums.collect()}
    got = [r for r in found.collect() if (r.proj_id, r.cell_id) in want]
    assert got and all(abs(r[f"pct_counts_{s}"] - want[r.proj_id, r.cell_id][s]) < 1e-9 for r in got for s in names)


def test_gini_is_scale_free(frames):
    counts, cells, genes = frames
    a = by_cell(cellqc.gini_per_cell(counts, cells, genes))
    b = by_cell(cellqc.gini_per_cell(counts.withColumn("n", F.col("n") * 1000), cells, genes))
    assert np.allclose(a["gini"], b["gini"]) and a["gini"].between(0, 1).all()


def test_top_genes_tie_rule_and_small_lists(frames):
    counts, _, genes = frames
    same = genes.select("proj_id", "gene_id", F.lit(9).alias("total_counts"))
    assert [r.gene_id for r in cellqc.top_genes(same, 3).orderBy("position").collect()] == [0, 1, 2]
    assert cellqc.top_gene_flags(same, (50,)).filter("top_50_gene").count() == N_GENES


def test_variable_genes(frames, dense):
    counts, cells, genes = frames
    counts, dense = counts.filter("gene_id <> 4"), dense.copy()
    dense[:, 4] = 0   # a silent gene
    got = cellqc.variable_genes(cellqc.gene_moments(counts, genes, cells)).toPandas().sort_values("gene_id").reset_index(drop=True)
    mean, var = dense.mean(0), dense.var(0, ddof=1)
    mean = np.where(mean == 0, 1e-12, mean)
    with np.errstate(divide="ignore"):
        disp = np.log(np.where(var / mean == 0, np.nan, var / mean))
    lm = np.log1p(mean)
    bins = np.clip(np.ceil((lm - lm.min()) / (lm.max() - lm.min()) * 20), 1, 20)
    s = pd.Series(disp).groupby(bins)
    mu, sd = s.transform("mean"), s.transform("std")
    norm = np.where(sd.isna(), np.where(np.isnan(disp), np.nan, 1.0), (disp - mu) / sd.replace(0, np.nan))
    assert np.allclose(got["dispersion_norm"].astype(float), norm, equal_nan=True)
    assert not got["highly_variable"][4] and np.isnan(got["log_dispersion"][4])


def test_one_cell_project_and_moments(spark):
    counts = spark.createDataFrame([("P", 1, 1, 5)], "proj_id string, cell_id long, gene_id long, n long")
    cells = spark.createDataFrame([("P", 1)], "proj_id string, cell_id long")
    genes = spark.createDataFrame([("P", 1), ("P", 2)], "proj_id string, gene_id long")
    m = cellqc.gene_moments(counts, genes, cells).orderBy("gene_id").collect()
    assert m[0].mean == 5 and m[0].variance is None and m[1].total_counts == 0
    assert cellqc.dataset_gini(cellqc.cell_totals(counts, cells)).collect()[0].gini == 0.0
    d = cellqc.dropout_density(cellqc.gene_totals(counts, genes), cells).collect()[0]
    assert (d.percent_dropout, d.density) == (50.0, 0.5)


def test_gene_flags_and_annotation(spark):
    genes = spark.createDataFrame([("P", "g1", "mt-A"), ("P", "g2", "Xist"), ("P", "g3", "z")], "proj_id string, gene_id string, symbol string")
    sets = spark.createDataFrame([("female", "Xist"), ("cell_cycle", "Xist")], "set_name string, symbol string")
    f = {r.gene_id: r for r in cellqc.gene_flags(genes, sets, ["female", "male"]).collect()}
    assert f["g2"].female and not f["g2"].male and not f["g1"].female
    ann = spark.createDataFrame([("g3", "rRNA")], "gene_id string, type_ string")
    a = {r.gene_id: r for r in cellqc.annotated_genes(genes, ann).collect()}
    assert a["g1"].mt and not a["g1"].ribo and a["g3"].ribo and not a["g3"].mt

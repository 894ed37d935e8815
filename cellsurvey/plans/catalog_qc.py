"""Queries on the count matrix: cell, gene and project statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsurvey.operators import cellqc
from cellsurvey.plans import bindings as b
from cellsurvey.plans import stages
from cellsurvey.plans.bindings import Tables
from cellsurvey.plans.oracle_views import BASE, CELL_TOTALS, FLAGS, HVG, MOMENTS, auroc_sql
from cellsurvey.plans.registry import query, rounded

_GINI = """
sorted AS (SELECT proj_id, cell_id, n, row_number() OVER (PARTITION BY proj_id, cell_id ORDER BY n) AS i, count(*) OVER (PARTITION BY proj_id, cell_id) AS k FROM counts),
size AS (SELECT proj_id, count(*) AS g FROM genes GROUP BY ALL)
"""


@query("cell_qc", f"WITH {CELL_TOTALS} SELECT * FROM totals")
def cell_qc(t: Tables) -> DataFrame:
    return cellqc.cell_totals(b.counts(t), b.cells(t))


@query("gene_qc", f"WITH {MOMENTS} SELECT proj_id, gene_id, total_counts, n_cells_by_counts, round(mean, 6) AS mean, round(variance, 6) AS variance FROM moments")
def gene_qc(t: Tables) -> DataFrame:
    m = cellqc.gene_moments(b.counts(t), b.genes(t), b.cells(t))
    return rounded(m.select("proj_id", "gene_id", "total_counts", "n_cells_by_counts", "mean", "variance"), "mean", "variance")


@query("gini_cell", f"""WITH {BASE}, {_GINI}
SELECT c.proj_id, c.cell_id, round(coalesce((g + 1 - 2 * s / t) / g, 0), 6) AS gini FROM cells c JOIN size USING (proj_id)
LEFT JOIN (SELECT proj_id, cell_id, CAST(sum(n * (k - i + 1)) AS DOUBLE) AS s, CAST(sum(n) AS DOUBLE) AS t FROM sorted GROUP BY ALL) USING (proj_id, cell_id)""")
def gini_cell(t: Tables) -> DataFrame:
    return rounded(cellqc.gini_per_cell(b.counts(t), b.cells(t), b.genes(t)), "gini")


@query("gini_log1p", f"""WITH {BASE}, {_GINI}
SELECT c.proj_id, c.cell_id, round(coalesce((g + 1 - 2 * s / t) / g, 0), 6) AS gini FROM cells c JOIN size USING (proj_id)
LEFT JOIN (SELECT proj_id, cell_id, sum(ln(1 + CAST(n AS DOUBLE)) * (k - i + 1)) AS s, sum(ln(1 + CAST(n AS DOUBLE))) AS t FROM sorted GROUP BY ALL) USING (proj_id, cell_id)""")
def gini_log1p(t: Tables) -> DataFrame:
    return rounded(cellqc.gini_per_cell(b.counts(t), b.cells(t), b.genes(t), log="log1p"), "gini")


@query("geneset_auroc", f"WITH {FLAGS}, {auroc_sql(b.SETS, 'flagged')}")
def geneset_auroc(t: Tables) -> DataFrame:
    return rounded(cellqc.geneset_auroc(b.counts(t), b.cells(t), b.flagged_genes(t), b.SETS), *b.SETS)


@query("geneset_auroc_all", f"WITH {HVG}, {auroc_sql(b.ALL_SETS, 'topped')}")
def geneset_auroc_all(t: Tables) -> DataFrame:
    counts, cells = b.counts(t), b.cells(t)
    table = stages.gene_table(counts, b.flagged_genes(t), cells)
    return rounded(cellqc.geneset_auroc(counts, cells, table, b.ALL_SETS), *b.ALL_SETS)


_CORR = f"""{MOMENTS},
dense AS (SELECT c.proj_id, c.cell_id, coalesce(n, 0) AS x, mean FROM cells c JOIN moments USING (proj_id) LEFT JOIN counts USING (proj_id, cell_id, gene_id))
"""


@query("corr_to_mean", f"WITH {_CORR} SELECT proj_id, cell_id, CASE WHEN stddev_pop(x) > 0 AND stddev_pop(mean) > 0 THEN round(corr(x, mean), 6) END AS corr_to_mean FROM dense GROUP BY ALL")
def corr_to_mean(t: Tables) -> DataFrame:
    counts, cells = b.counts(t), b.cells(t)
    means = cellqc.gene_moments(counts, b.genes(t), cells)
    return rounded(cellqc.corr_to_mean(counts, cells, means), "corr_to_mean")


_top = ", ".join(f"round(sum(n) FILTER (i <= {k}) * 100.0 / sum(n), 6) AS pct_counts_in_top_{k}_genes" for k in (50, 100, 200, 500))
_share = ", ".join(
    f"round(coalesce(sum(n) FILTER ({s}), 0) * 100.0 / sum(n), 6) AS pct_counts_{s}, round(ln(1 + CAST(coalesce(sum(n) FILTER ({s}), 0) AS DOUBLE)), 6) AS log1p_total_counts_{s}"
    for s in b.SETS)
_clusters = ", ".join(f"round(coalesce(sum(n) FILTER (brand = 'Brand#{i}'), 0) * 100.0 / sum(n), 6) AS pct_counts_cc_cluster_{i}" for i in range(1, 9))


@query("pct_top_genes", f"""WITH {BASE}, s AS (SELECT *, row_number() OVER (PARTITION BY proj_id, cell_id ORDER BY n DESC) AS i FROM counts),
p AS (SELECT proj_id, cell_id, {_top} FROM s GROUP BY proj_id, cell_id) SELECT c.proj_id, c.cell_id, p.* EXCLUDE (proj_id, cell_id) FROM cells c LEFT JOIN p USING (proj_id, cell_id)""")
def pct_top_genes(t: Tables) -> DataFrame:
    d = cellqc.cell_metrics(b.counts(t), b.cells(t), b.genes(t), [], parts=("share",))
    return rounded(d, *[c for c in d.columns if c.startswith("pct")])


@query("pct_geneset", f"""WITH {FLAGS}, p AS (SELECT proj_id, cell_id, {_share} FROM counts JOIN flagged USING (proj_id, gene_id) GROUP BY proj_id, cell_id)
SELECT c.proj_id, c.cell_id, p.* EXCLUDE (proj_id, cell_id) REPLACE ({", ".join(f"coalesce(log1p_total_counts_{s}, 0) AS log1p_total_counts_{s}" for s in b.SETS)}) FROM cells c LEFT JOIN p USING (proj_id, cell_id)""")
def pct_geneset(t: Tables) -> DataFrame:
    d = cellqc.cell_metrics(b.counts(t), b.cells(t), b.flagged_genes(t), b.SETS, parts=("share",), top=())
    return rounded(d, *d.columns[2:])


@query("pct_cell_cycle_clusters", f"""WITH {BASE}, p AS (SELECT proj_id, cell_id, {_clusters} FROM counts JOIN genes USING (proj_id, gene_id) GROUP BY proj_id, cell_id)
SELECT c.proj_id, c.cell_id, p.* EXCLUDE (proj_id, cell_id) FROM cells c LEFT JOIN p USING (proj_id, cell_id)""")
def pct_cell_cycle_clusters(t: Tables) -> DataFrame:
    d = cellqc.cell_metrics(b.counts(t), b.cells(t), b.clustered_genes(t), b.cluster_sets(), parts=("share",), top=())
    cols = [f"pct_counts_{s}" for s in b.cluster_sets()]
    return rounded(d.select("proj_id", "cell_id", *cols), *cols)


@query("top_genes", f"""WITH {MOMENTS}, r AS (SELECT proj_id, gene_id, total_counts, row_number() OVER (PARTITION BY proj_id ORDER BY total_counts DESC, gene_id) AS position FROM moments)
SELECT * FROM r WHERE position <= 500""")
def top_genes(t: Tables) -> DataFrame:
    totals = cellqc.gene_totals(b.counts(t), b.genes(t)).select("proj_id", "gene_id", "total_counts")
    return cellqc.top_genes(totals, 500).withColumn("position", F.col("position").cast("bigint"))


@query("gene_flags", f"""WITH {HVG} SELECT proj_id, gene_id, {", ".join(f"{s}" for s in b.ALL_SETS)} FROM topped""")
def gene_flags(t: Tables) -> DataFrame:
    return stages.gene_table(b.counts(t), b.flagged_genes(t), b.cells(t)).select("proj_id", "gene_id", *b.ALL_SETS)


@query("hvg", f"""WITH {HVG} SELECT proj_id, gene_id, round(log_mean, 6) AS log_mean, round(log_dispersion, 6) AS log_dispersion, mean_bin,
round(dispersion_norm, 6) AS dispersion_norm, highly_variable FROM hvg""")
def hvg(t: Tables) -> DataFrame:
    from cellsurvey.session import durable

    m = durable(cellqc.gene_moments(b.counts(t), b.genes(t), b.cells(t)))
    d = cellqc.variable_genes(m).select("proj_id", "gene_id", "log_mean", "log_dispersion", "mean_bin", "dispersion_norm", "highly_variable")
    return rounded(d, "log_mean", "log_dispersion", "dispersion_norm")


@query("dropout_density", f"""WITH {MOMENTS} SELECT proj_id, round(count(*) FILTER (n_cells_by_counts = 0) / count(*) * 100, 6) AS percent_dropout,
round(sum(n_cells_by_counts) / (count(*) * any_value(n_cells)), 6) AS density FROM moments GROUP BY proj_id""")
def dropout_density(t: Tables) -> DataFrame:
    d = cellqc.dropout_density(cellqc.gene_totals(b.counts(t), b.genes(t)), b.cells(t))
    return rounded(d, "percent_dropout", "density")


@query("dataset_gini", f"""WITH {CELL_TOTALS}, s AS (SELECT *, row_number() OVER (PARTITION BY proj_id ORDER BY total_counts) AS i, count(*) OVER (PARTITION BY proj_id) AS k FROM totals WHERE total_counts > 0),
m AS (SELECT proj_id, count(*) AS n FROM totals GROUP BY ALL)
SELECT proj_id, round((n + 1 - 2 * a / ta) / n, 6) AS gini, round((n + 1 - 2 * l / tl) / n, 6) AS log_gini FROM m JOIN
(SELECT proj_id, CAST(sum(total_counts * (k - i + 1)) AS DOUBLE) AS a, CAST(sum(total_counts) AS DOUBLE) AS ta,
  sum(ln(CAST(total_counts AS DOUBLE)) * (k - i + 1)) AS l, sum(ln(CAST(total_counts AS DOUBLE))) AS tl FROM s GROUP BY ALL) USING (proj_id)""")
def dataset_gini(t: Tables) -> DataFrame:
    return rounded(cellqc.dataset_gini(cellqc.cell_totals(b.counts(t), b.cells(t))), "gini", "log_gini")


@query("counts_per_million", f"WITH {BASE} SELECT proj_id, cell_id, gene_id, n, round(n / sum(n) OVER (PARTITION BY proj_id, cell_id) * 1e6, 6) AS cpm FROM counts")
def counts_per_million(t: Tables) -> DataFrame:
    return rounded(cellqc.counts_per_million(b.counts(t)), "cpm")


@query("log_counts", f"WITH {BASE} SELECT proj_id, cell_id, gene_id, n, round(ln(1 + CAST(n AS DOUBLE)), 6) AS log_n FROM counts")
def log_counts(t: Tables) -> DataFrame:
    return rounded(cellqc.log_counts(b.counts(t)), "log_n")


@query("common_genes", """WITH f AS (SELECT DISTINCT 'all' AS proj_id, CAST(l_linenumber AS VARCHAR) AS run_id, l_partkey AS gene_id FROM lineitem),
keep AS (SELECT gene_id FROM f GROUP BY gene_id HAVING count(*) = (SELECT count(DISTINCT run_id) FROM f)),
c AS (SELECT 'all' AS proj_id, CAST(l_linenumber AS VARCHAR) AS run_id, concat(l_linenumber, '-', l_suppkey) AS cell_id, l_partkey AS gene_id, CAST(sum(l_quantity) AS BIGINT) AS n FROM lineitem GROUP BY ALL)
SELECT c.* FROM c SEMI JOIN keep USING (gene_id)""")
def common_genes(t: Tables) -> DataFrame:
    """Line numbers act as runs, whose cells are named apart by the run."""
    rows = t.lineitem.select(
        F.lit("all").alias("proj_id"), F.col("l_linenumber").cast("string").alias("run_id"),
        F.concat_ws("-", F.col("l_linenumber").cast("string"), F.col("l_suppkey").cast("string")).alias("cell_id"),
        F.col("l_partkey").alias("gene_id"), "l_quantity",
    )
    counts = rows.groupBy("proj_id", "run_id", "cell_id", "gene_id").agg(F.sum("l_quantity").cast("bigint").alias("n"))
    return cellqc.common_genes(counts, rows.select("proj_id", "run_id", "gene_id"))


@query("profile_correlations", f"""WITH {BASE}, ty AS (SELECT proj_id, cell_id, concat('t', cell_id % 3) AS profile_id FROM cells),
prof AS (SELECT proj_id, profile_id, gene_id, CAST(sum(n) AS DOUBLE) AS y FROM counts JOIN ty USING (proj_id, cell_id) GROUP BY ALL),
grid AS (SELECT c.proj_id, c.cell_id, p.profile_id, g.gene_id FROM cells c JOIN (SELECT DISTINCT proj_id, profile_id FROM prof) p USING (proj_id) JOIN genes g USING (proj_id)),
d AS (SELECT proj_id, cell_id, profile_id, coalesce(n, 0) AS x, coalesce(y, 0) AS y FROM grid LEFT JOIN counts USING (proj_id, cell_id, gene_id) LEFT JOIN prof USING (proj_id, profile_id, gene_id))
SELECT proj_id, cell_id, profile_id, CASE WHEN stddev_pop(x) > 0 AND stddev_pop(y) > 0 THEN round(corr(x, y), 6) END AS correlation FROM d GROUP BY ALL""")
def profile_correlations(t: Tables) -> DataFrame:
    """Cells against the summed profile of each cell type."""
    counts = b.counts(t)
    types = b.cell_labels(t).select("proj_id", "cell_id", F.col("cell_type").alias("profile_id"))
    profiles = counts.join(types, ["proj_id", "cell_id"]).groupBy("proj_id", "profile_id", "gene_id").agg(F.sum("n").cast("double").alias("y"))
    return rounded(cellqc.profile_correlations(counts, b.cells(t), b.genes(t), profiles), "correlation")


@query("project_gene_totals", f"WITH {MOMENTS} SELECT gene_id, total_counts, n_cells_by_counts FROM moments WHERE proj_id = 'ASIA'")
def project_gene_totals(t: Tables) -> DataFrame:
    """One project only: the filter reaches the scans."""
    from cellsurvey.operators.metadata import of_projects

    totals = cellqc.gene_totals(of_projects(b.counts(t), "ASIA"), of_projects(b.genes(t), "ASIA"))
    return totals.select("gene_id", "total_counts", "n_cells_by_counts")


@query("cell_components")
def cell_components(t: Tables) -> DataFrame:
    """Components of the logged counts of the variable genes of every project; the operator is compared with numpy in the tests."""
    counts, cells = b.counts(t), b.cells(t)
    table = stages.gene_table(counts, b.genes(t), cells)
    return stages.cell_embedding(counts, cells, table)

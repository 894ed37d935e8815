"""Queries that summarise projects and compare them with all projects together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsurvey.operators import cellqc, summary
from cellsurvey.plans import bindings as b
from cellsurvey.plans.bindings import Tables
from cellsurvey.plans.oracle_views import CELL_TOTALS, META, MOMENTS
from cellsurvey.plans.registry import query, rounded

_LINES = META + """,
lines AS (SELECT r.proj_id, r.run_id, r.exp_id, r.samp_id, r.tech, r.publish_date, l_shipdate, l_returnflag AS class_label, concat(l_returnflag, l_linestatus) AS subclass_label FROM lineitem JOIN runs r ON l_orderkey = run_id),
bags AS (SELECT proj_id, samp_id, attributes AS segment, exp_id AS nation FROM samples)
"""


def _lines(t: Tables) -> DataFrame:
    """Line items as cells of the run they belong to."""
    r = b.runs(t).select("proj_id", "run_id", "exp_id", "samp_id", "tech", "publish_date")
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("run_id"), "l_shipdate", F.col("l_returnflag").alias("class_label"),
        F.concat("l_returnflag", "l_linestatus").alias("subclass_label"),
    )
    return lines.join(r, "run_id")


def _bags(t: Tables) -> DataFrame:
    return b.samples(t).select(
        "proj_id", "samp_id", F.create_map(F.lit("source_name"), "attributes", F.lit("nation"), "exp_id").alias("attributes")
    )


@query("header_box", f"""WITH {_LINES}, d AS (SELECT proj_id, avg(epoch_us(publish_date)) AS m FROM runs SEMI JOIN lines USING (run_id) GROUP BY ALL),
tc AS (SELECT proj_id, string_agg(concat(tech, '=', n), ',' ORDER BY tech) AS tech_count FROM (SELECT proj_id, tech, count(*) AS n FROM lines GROUP BY ALL) GROUP BY ALL)
SELECT proj_id, count(*) AS n_cells, count(DISTINCT run_id) AS n_runs, count(DISTINCT exp_id) AS n_exps, count(DISTINCT samp_id) AS n_samp, any_value(tech_count) AS tech_count,
strftime(make_timestamp(CAST(trunc(any_value(m)) AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS publish_date FROM lines JOIN d USING (proj_id) JOIN tc USING (proj_id) GROUP BY proj_id""")
def header_box(t: Tables) -> DataFrame:
    box = summary.header_box(_lines(t), b.runs(t).select("proj_id", "run_id", "publish_date"))
    return box.withColumns({
        "tech_count": F.array_join(F.transform(F.map_entries("tech_count"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ","),
        "publish_date": F.date_format("publish_date", "yyyy-MM-dd HH:mm:ss"),
    })


@query("mean_publish_date", f"WITH {META} SELECT proj_id, strftime(make_timestamp(CAST(trunc(avg(epoch_us(publish_date))) AS BIGINT)), '%Y-%m-%d %H:%M:%S.%f') AS mean_date FROM runs GROUP BY proj_id")
def mean_publish_date(t: Tables) -> DataFrame:
    return summary.mean_publish_date(b.runs(t)).select("proj_id", F.date_format("publish_date", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("mean_date"))


@query("used_samples", f"WITH {_LINES} SELECT DISTINCT proj_id, samp_id, attributes FROM samples SEMI JOIN lines USING (proj_id, samp_id)")
def used_samples(t: Tables) -> DataFrame:
    return summary.used(b.samples(t).select("proj_id", "samp_id", "attributes"), _lines(t), ["proj_id", "samp_id"])


@query("tech_counts", f"WITH {_LINES} SELECT proj_id, tech, count(*) AS n_cells FROM lines GROUP BY ALL")
def tech_counts(t: Tables) -> DataFrame:
    return summary.technology_counts(_lines(t))


@query("sample_attr_counts", f"""WITH {_LINES}, j AS (SELECT l.proj_id, segment, nation FROM lines l JOIN bags USING (proj_id, samp_id)),
c AS (SELECT proj_id, 'source_name' AS attribute, segment AS value, count(*) AS n_cells FROM j GROUP BY ALL UNION ALL SELECT proj_id, 'nation', nation, count(*) FROM j GROUP BY ALL) SELECT * FROM c WHERE n_cells > 1""")
def sample_attr_counts(t: Tables) -> DataFrame:
    return summary.sample_attribute_counts(_lines(t), _bags(t))


@query("source_name_counts", f"WITH {_LINES} SELECT l.proj_id, segment AS source_name, count(*) AS n_cells FROM lines l JOIN bags USING (proj_id, samp_id) GROUP BY ALL")
def source_name_counts(t: Tables) -> DataFrame:
    return summary.source_name_counts(_lines(t), _bags(t))


@query("discrete_counts", f"""WITH {_LINES} SELECT proj_id, 'tech' AS variable, tech AS value, count(*) AS n FROM lines GROUP BY ALL UNION ALL SELECT proj_id, 'class_label', class_label, count(*) FROM lines GROUP BY ALL
UNION ALL SELECT proj_id, 'subclass_label', subclass_label, count(*) FROM lines GROUP BY ALL""")
def discrete_counts(t: Tables) -> DataFrame:
    return summary.discrete_counts(_lines(t), ["tech", "class_label", "subclass_label"])


_regions = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query("tech_pivot", f"WITH {_LINES}, c AS (SELECT proj_id, tech AS statistic, count(*) AS n FROM lines GROUP BY ALL) SELECT statistic, " + ", ".join(f"any_value(n) FILTER (proj_id = '{r}') AS \"{r}\"" for r in _regions) + " FROM c GROUP BY statistic")
def tech_pivot(t: Tables) -> DataFrame:
    long = summary.technology_counts(_lines(t)).select("proj_id", F.col("tech").alias("statistic"), F.col("n_cells").alias("value"))
    return summary.statistics_side_by_side(long, _regions)


@query("tech_mixture", "SELECT o_custkey AS proj_id, CASE WHEN count(DISTINCT o_orderpriority) = 1 THEN min(o_orderpriority) ELSE 'mixture' END AS tech FROM orders GROUP BY o_custkey")
def tech_mixture(t: Tables) -> DataFrame:
    """Customers act as projects, so that both outcomes occur."""
    return summary.project_technology(t.orders.select(F.col("o_custkey").alias("proj_id"), F.col("o_orderpriority").alias("tech")))


@query("drop_projects", f"WITH {META} SELECT run_id, samp_id AS proj_id FROM runs WHERE samp_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def drop_projects(t: Tables) -> DataFrame:
    runs = b.runs(t).select("run_id", F.col("samp_id").alias("proj_id"))
    return summary.without_projects(runs, t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("proj_id")))


@query("cells_per_year", f"WITH {_LINES} SELECT CAST(year(publish_date) AS INT) AS year, count(*) AS n_cells, count(DISTINCT samp_id) AS n_projects FROM lines GROUP BY 1")
def cells_per_year(t: Tables) -> DataFrame:
    """Samples act as projects."""
    return summary.growth_by_year(_lines(t).select("publish_date", F.col("samp_id").alias("proj_id")))


@query("label_order", f"WITH {_LINES} SELECT subclass_label, count(*) AS n_cells FROM lines GROUP BY 1")
def label_order(t: Tables) -> DataFrame:
    return summary.label_order(_lines(t), "subclass_label")


@query("strip_chemistry", f"WITH {META} SELECT regexp_replace(tech, 'v[0-9]', '', 'g') AS tech, count(*) AS n FROM runs GROUP BY 1")
def strip_chemistry(t: Tables) -> DataFrame:
    return b.runs(t).groupBy(summary.strip_chemistry(F.col("tech")).alias("tech")).agg(F.count(F.lit(1)).alias("n"))


@query("regression_line", """SELECT l_returnflag AS proj_id, round(avg(l_quantity), 6) AS mean_x, round(median(l_quantity), 6) AS median_x, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem GROUP BY 1""")
def regression_line(t: Tables) -> DataFrame:
    d = summary.reference_lines(t.lineitem.select(F.col("l_returnflag").alias("proj_id"), "l_quantity", "l_extendedprice"), ["proj_id"], "l_quantity", "l_extendedprice")
    return rounded(rounded(d, "mean_x", "median_x", "slope"), "intercept", digits=4)


@query("median_line", f"WITH {META} SELECT proj_id, round(median(price), 6) AS median FROM runs GROUP BY 1")
def median_line(t: Tables) -> DataFrame:
    return rounded(summary.exact_median(b.runs(t), ["proj_id"], "price"), "median")


_MEANS = f"{CELL_TOTALS} SELECT proj_id, round(avg(total_counts), 6) AS total_counts, round(avg(n_genes_by_counts), 6) AS n_genes_by_counts FROM totals GROUP BY 1"
_SETSHARE = f"""WITH {MOMENTS}, p AS (SELECT proj_id, cell_id, coalesce(sum(n) FILTER (female), 0) * 100.0 / sum(n) AS f, coalesce(sum(n) FILTER (male), 0) * 100.0 / sum(n) AS m FROM counts JOIN flagged USING (proj_id, gene_id) GROUP BY ALL),
a AS (SELECT proj_id, avg(f) AS f, avg(m) AS m FROM p GROUP BY ALL) SELECT proj_id, round(f, 6) AS pct_counts_female, round(m, 6) AS pct_counts_male, round(f / (f + m), 6) AS prop_female, round(m / (f + m), 6) AS prop_male FROM a"""


@query("metric_means", _SETSHARE)
def metric_means(t: Tables) -> DataFrame:
    d = cellqc.cell_metrics(b.counts(t), b.cells(t), b.flagged_genes(t).select("proj_id", "gene_id", "female", "male"), ["female", "male"], parts=("share",), top=())
    m = summary.metric_means(d, ["pct_counts_female", "pct_counts_male"], "pct_counts_female", "pct_counts_male")
    return rounded(m, *m.columns[1:])


# ---------------------------------------------------------------- histograms

_METRICS = ["l_quantity", "l_extendedprice", "l_discount"]
_HIST = """
cellsx AS (SELECT concat(l_returnflag, l_linestatus) AS proj_id, CASE l_returnflag WHEN 'A' THEN '10xv2' WHEN 'N' THEN '10xv3' ELSE 'smartseq' END AS tech, ln(l_quantity) AS l_quantity, ln(l_extendedprice) AS l_extendedprice, l_discount FROM lineitem),
long AS (SELECT proj_id, tech, unnest(['l_quantity', 'l_extendedprice', 'l_discount']) AS stat, unnest([l_quantity, l_extendedprice, l_discount]) AS value FROM cellsx)
"""
_PROJECT_HIST = _HIST + """,
breaks AS (SELECT stat, min(value) AS lo, max(value) AS hi FROM long GROUP BY ALL),
hits AS (SELECT proj_id, stat, least(CAST(floor((value - lo) / (hi - lo) * 50) AS INT) + 1, 50) AS bin, count(*) AS n FROM long JOIN breaks USING (stat) GROUP BY ALL),
tot AS (SELECT proj_id, stat, sum(n) AS total FROM hits GROUP BY ALL),
grid AS (SELECT proj_id, stat, lo, hi, total, unnest(range(1, 51)) AS bin FROM tot JOIN breaks USING (stat)),
hist AS (SELECT g.proj_id, g.stat, CAST(g.bin AS INT) AS bin, coalesce(n, 0) AS n, CAST(coalesce(n, 0) AS DOUBLE) / CAST(total AS DOUBLE) / ((hi - lo) / 50) AS density FROM grid g LEFT JOIN hits h ON g.proj_id = h.proj_id AND g.stat = h.stat AND g.bin = h.bin),
heights AS (SELECT stat, bin, avg(density) AS height FROM hist GROUP BY ALL)
"""


def _metric_cells(t: Tables) -> DataFrame:
    """Line items as cells with three metrics, two of them logged."""
    tech = F.when(F.col("l_returnflag") == "A", "10xv2").when(F.col("l_returnflag") == "N", "10xv3").otherwise("smartseq")
    cells = t.lineitem.select(F.concat("l_returnflag", "l_linestatus").alias("proj_id"), tech.alias("tech"), *_METRICS)
    return summary.logged_metrics(cells, ["l_quantity", "l_extendedprice"])


@query("hist_project", f"WITH {_PROJECT_HIST} SELECT proj_id, stat, bin, n, round(density, 6) AS density FROM hist")
def hist_project(t: Tables) -> DataFrame:
    return rounded(summary.project_histograms(_metric_cells(t), _METRICS).select("proj_id", "stat", "bin", "n", "density"), "density")


@query("hist_global", f"WITH {_PROJECT_HIST} SELECT stat, bin, round(height, 6) AS height FROM heights")
def hist_global(t: Tables) -> DataFrame:
    return rounded(summary.global_heights(summary.project_histograms(_metric_cells(t), _METRICS)), "height")


@query("hist_population", f"""WITH {_HIST}, breaks AS (SELECT stat, min(value) AS lo, max(value) AS hi FROM long GROUP BY ALL),
hits AS (SELECT stat, least(CAST(floor((value - lo) / (hi - lo) * 50) AS INT) + 1, 50) AS bin, count(*) AS n FROM long JOIN breaks USING (stat) GROUP BY ALL),
grid AS (SELECT stat, lo, hi, CAST(unnest(range(1, 51)) AS INT) AS bin FROM breaks)
SELECT g.stat, g.bin, round(lo + (hi - lo) / 50 * (g.bin - 1), 6) AS lower, round(lo + (hi - lo) / 50 * g.bin, 6) AS upper, coalesce(n, 0) AS n FROM grid g LEFT JOIN hits h ON g.stat = h.stat AND g.bin = h.bin""")
def hist_population(t: Tables) -> DataFrame:
    """All cells together: counts and breaks."""
    from cellsurvey.functions.frames import long_form

    long = long_form(_metric_cells(t), ["proj_id"], _METRICS)
    return rounded(summary.histogram(long, summary.histogram_breaks(long)).drop("density"), "lower", "upper")


@query("hist_tech", f"""WITH {_HIST}, l2 AS (SELECT regexp_replace(tech, 'v[0-9]', '') AS tech, stat, value FROM long), breaks AS (SELECT tech, stat, min(value) AS lo, max(value) AS hi FROM l2 GROUP BY ALL),
hits AS (SELECT tech, stat, least(CAST(floor((value - lo) / (hi - lo) * 50) AS INT) + 1, 50) AS bin, count(*) AS n FROM l2 JOIN breaks USING (tech, stat) GROUP BY ALL),
tot AS (SELECT tech, stat, sum(n) AS total FROM hits GROUP BY ALL), grid AS (SELECT tech, stat, lo, hi, total, CAST(unnest(range(1, 51)) AS INT) AS bin FROM tot JOIN breaks USING (tech, stat))
SELECT g.tech, g.stat, g.bin, coalesce(n, 0) AS n, round(CAST(coalesce(n, 0) AS DOUBLE) / CAST(total AS DOUBLE) / ((hi - lo) / 50), 6) AS density FROM grid g LEFT JOIN hits h ON g.tech = h.tech AND g.stat = h.stat AND g.bin = h.bin""")
def hist_tech(t: Tables) -> DataFrame:
    return rounded(summary.technology_histograms(_metric_cells(t), _METRICS).select("tech", "stat", "bin", "n", "density"), "density")


_AUROC = _PROJECT_HIST + """,
own AS (SELECT proj_id, stat, round(sum(density) OVER (PARTITION BY proj_id, stat ORDER BY bin), 9) AS v, 1 AS own FROM hist),
world AS (SELECT stat, round(sum(height) OVER (PARTITION BY stat ORDER BY bin), 9) AS v, 0 AS own FROM heights),
pooled AS (SELECT * FROM own UNION ALL SELECT p.proj_id, w.stat, w.v, w.own FROM world w JOIN (SELECT DISTINCT proj_id, stat FROM hist) p USING (stat)),
pr AS (SELECT *, rank() OVER (PARTITION BY proj_id, stat ORDER BY v) + (count(*) OVER (PARTITION BY proj_id, stat, v) - 1) / 2 AS r FROM pooled),
auc AS (SELECT proj_id, stat, 1 - (sum(r) FILTER (own = 1) / 50 - 51 / 2) / 50 AS auroc FROM pr GROUP BY ALL)
"""


def _aurocs(t: Tables) -> DataFrame:
    from cellsurvey.session import durable

    hist = durable(summary.project_histograms(_metric_cells(t), _METRICS))  # projects x statistics x 50 rows
    return summary.global_auroc(hist, summary.global_heights(hist))


@query("global_auroc", f"WITH {_AUROC} SELECT proj_id, stat, round(auroc, 6) AS auroc FROM auc")
def global_auroc(t: Tables) -> DataFrame:
    return rounded(_aurocs(t), "auroc")


@query("global_auroc_rank", f"""WITH {_AUROC}, a9 AS (SELECT proj_id, stat, round(auroc, 9) AS a FROM auc)
SELECT proj_id, stat, round(a, 6) AS auroc, round((rank() OVER (PARTITION BY stat ORDER BY a) + (count(*) OVER (PARTITION BY stat, a) - 1) / 2) / count(*) OVER (PARTITION BY stat), 6) AS ranked_auroc FROM a9""")
def global_auroc_rank(t: Tables) -> DataFrame:
    return rounded(summary.rank_across_projects(_aurocs(t)), "auroc", "ranked_auroc")


@query("cell_hist", f"""WITH {CELL_TOTALS}, long AS (SELECT proj_id, unnest(['total_counts', 'n_genes_by_counts']) AS stat, unnest([ln(nullif(total_counts, 0)), ln(nullif(n_genes_by_counts, 0))]) AS value FROM totals),
v AS (SELECT * FROM long WHERE value IS NOT NULL), breaks AS (SELECT stat, min(value) AS lo, max(value) AS hi FROM v GROUP BY ALL)
SELECT proj_id, stat, least(CAST(floor((value - lo) / (hi - lo) * 50) AS INT) + 1, 50) AS bin, count(*) AS n FROM v JOIN breaks USING (stat) GROUP BY ALL""")
def cell_hist(t: Tables) -> DataFrame:
    """Histogram of the cells' own totals; filled bins only."""
    totals = summary.logged_metrics(cellqc.cell_totals(b.counts(t), b.cells(t)))
    return summary.project_histograms(totals, ["total_counts", "n_genes_by_counts"]).filter("n > 0").select("proj_id", "stat", "bin", "n")


# ---------------------------------------------------------------- published table

_PUBLISHED = f"""WITH {_LINES}, s AS (SELECT proj_id, count(*) AS n_cells, count(*) FILTER (tech = 'smartseq') AS n_smartseq, count(*) FILTER (tech = '10xv2') AS n_10xv2, count(*) FILTER (tech = '10xv3') AS n_10xv3, strftime(max(publish_date), '%Y-%m-%d') AS date FROM lines GROUP BY ALL)
SELECT proj_id, n_cells, n_smartseq, n_10xv2, n_10xv3, date, concat('https://img.example.org/', proj_id, '_umap.png') AS image, concat('https://report.example.org/?_inputs_&projid="', proj_id, '"') AS report_url FROM s"""


@query("dataset_table", _PUBLISHED)
def dataset_table(t: Tables) -> DataFrame:
    from cellsurvey.functions.fixed_values import DATASET_COLUMNS

    lines = _lines(t)
    techs = summary.technology_counts(lines).groupBy("proj_id").agg(
        F.map_from_entries(F.collect_list(F.struct("tech", "n_cells"))).alias("n_techs"), F.sum("n_cells").alias("n_cells"))
    dates = lines.groupBy("proj_id").agg(F.date_format(F.max("publish_date"), "yyyy-MM-dd").alias("date"))
    base = summary.join_summaries(techs, dates)
    missing = {c: F.lit(None).cast("double") for c in DATASET_COLUMNS.values() if c and c not in base.columns}
    table = summary.dataset_table(base.withColumns(missing), "https://img.example.org", "https://report.example.org/")
    return table.select("proj_id", "n_cells", "n_smartseq", "n_10xv2", "n_10xv3", "date", "image", "report_url")

"""Per-cell and per-gene statistics over the sparse count table.

``counts(proj_id, cell_id, gene_id, n)`` holds the non-zero counts, one row per (cell, gene);
zeros are never stored, they enter through closed forms.

Most cell metrics only depend on how often each count value occurs in the cell. So the counts are
first merged to (cell, value) rows, and everything after works on that histogram. A cell
with T reads has at most sqrt(2 T) different values (k different positive integers add up to at
least k (k + 1) / 2), so the window over one cell stays small however many genes the cell has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellsurvey.functions import fixed_values as fixed
from cellsurvey.functions.frames import ratio
from cellsurvey.session import durable

CELL = ["proj_id", "cell_id"]
GENE = ["proj_id", "gene_id"]
_FLAGS = 62  # gene sets to a number


# ---------------------------------------------------------------- totals and moments

def cell_totals(counts: DataFrame, cells: DataFrame) -> DataFrame:
    """Total count and number of expressed genes of every cell; 0 for cells without counts."""
    t = counts.groupBy(*CELL).agg(F.sum("n").alias("total_counts"), F.count(F.lit(1)).alias("n_genes_by_counts"))
    return cells.join(t, CELL, "left").na.fill(0, ["total_counts", "n_genes_by_counts"])


def gene_totals(counts: DataFrame, genes: DataFrame) -> DataFrame:
    """Total count and number of expressing cells of every gene; 0 for silent genes."""
    t = counts.groupBy(*GENE).agg(F.sum("n").alias("total_counts"), F.count(F.lit(1)).alias("n_cells_by_counts"))
    return genes.join(t, GENE, "left").na.fill(0, ["total_counts", "n_cells_by_counts"])


def gene_moments(counts: DataFrame, genes: DataFrame, cells: DataFrame) -> DataFrame:
    """Totals, mean and sample variance of every gene over all cells of its project."""
    n = F.col("n")
    t = counts.groupBy(*GENE).agg(
        F.sum("n").alias("total_counts"), F.count(F.lit(1)).alias("n_cells_by_counts"),
        F.sum(n * n).alias("sum_squares"),
    )
    n_cells = durable(cells.groupBy("proj_id").agg(F.count(F.lit(1)).alias("n_cells")))
    s, q, c = F.col("total_counts").cast("double"), F.col("sum_squares").cast("double"), F.col("n_cells")
    return (
        genes.join(t, GENE, "left").na.fill(0, ["total_counts", "n_cells_by_counts", "sum_squares"])
        .join(n_cells, "proj_id", "left")
        .withColumn("mean", ratio(s, c))
        .withColumn("variance", F.when(c > 1, (q - s * s / c) / (c - 1)))
        .drop("sum_squares")
    )


def log_counts(counts: DataFrame) -> DataFrame:
    """Natural log(1 + count); zeros stay absent."""
    return counts.withColumn("log_n", F.log1p("n"))


# ---------------------------------------------------------------- gene annotation

def top_genes(totals: DataFrame, k: int) -> DataFrame:
    """The k genes with the largest totals of each project (ties: smallest gene id)."""
    w = Window.partitionBy("proj_id").orderBy(F.desc("total_counts"), "gene_id")
    return totals.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= k)


def variable_genes(
    moments: DataFrame, min_mean: float = fixed.HVG_MIN_MEAN, max_mean: float = fixed.HVG_MAX_MEAN,
    min_disp: float = fixed.HVG_MIN_DISP, max_disp: float = fixed.HVG_MAX_DISP, n_bins: int = fixed.HVG_BINS,
) -> DataFrame:
    """Dispersion-based variable genes (our definition of the published method).

    dispersion = variance / mean of the raw counts, log scale, standardised among the genes of one
    of ``n_bins`` equal-width bins of log1p(mean). A bin with one gene gives 1. Silent genes take
    part in the bins with mean 0 and have no dispersion.
    """
    mean = F.when(F.col("mean") == 0, 1e-12).otherwise(F.col("mean"))
    raw = F.col("variance") / mean
    logged = moments.select(
        "*", F.log1p(mean).alias("log_mean"), F.when(raw > 0, F.ln(raw)).alias("log_dispersion")
    )
    span = logged.groupBy("proj_id").agg(F.min("log_mean").alias("lo"), F.max("log_mean").alias("hi"))
    place = F.ceil((F.col("log_mean") - F.col("lo")) / (F.col("hi") - F.col("lo")) * n_bins)
    binned = logged.join(span, "proj_id").withColumn(
        "mean_bin",
        F.when(F.col("hi") == F.col("lo"), F.lit(1).cast("bigint"))
        .otherwise(F.least(F.greatest(place, F.lit(1).cast("bigint")), F.lit(n_bins).cast("bigint"))),
    ).drop("lo", "hi")
    stats = binned.groupBy("proj_id", "mean_bin").agg(
        F.avg("log_dispersion").alias("bin_mean"), F.stddev_samp("log_dispersion").alias("bin_std")
    )
    norm = F.when(F.col("bin_std").isNull(), F.when(F.col("log_dispersion").isNotNull(), F.lit(1.0))).otherwise(
        ratio(F.col("log_dispersion") - F.col("bin_mean"), F.col("bin_std"))
    )
    flag = (
        (F.col("log_mean") > min_mean) & (F.col("log_mean") < max_mean)
        & (F.col("dispersion_norm") > min_disp) & (F.col("dispersion_norm") < max_disp)
    )
    return (
        binned.join(stats, ["proj_id", "mean_bin"])
        .withColumn("dispersion_norm", norm)
        .withColumn("highly_variable", F.coalesce(flag, F.lit(False)))
        .drop("bin_mean", "bin_std")
    )


def gene_flags(genes: DataFrame, gene_sets: DataFrame, names: Sequence[str]) -> DataFrame:
    """One boolean column per gene set, from the long table ``gene_sets(set_name, symbol)``."""
    member = gene_sets.groupBy("symbol").agg(
        *[F.bool_or(F.col("set_name") == s).alias(s) for s in names]
    )
    return genes.join(member, "symbol", "left").na.fill(False, list(names))


def annotated_genes(genes: DataFrame, annotation: DataFrame) -> DataFrame:
    """Gene type from the annotation; ``mt`` by symbol prefix, ``ribo`` by type."""
    return genes.join(annotation.select("gene_id", "type_"), "gene_id", "left").withColumns({
        "mt": F.coalesce(F.startswith("symbol", F.lit("mt-")), F.lit(False)),
        "ribo": F.coalesce(F.col("type_") == "rRNA", F.lit(False)),
    })


def top_gene_flags(totals: DataFrame, sizes: Sequence[int] = fixed.TOP_GENE_SIZES) -> DataFrame:
    """``top_<k>_gene`` columns; one ranking serves all sizes, cut at the largest."""
    ranked = top_genes(totals, max(sizes)).select(*GENE, "position")
    return totals.join(ranked, GENE, "left").select(
        *totals.columns, *[F.coalesce(F.col("position") <= k, F.lit(False)).alias(f"top_{k}_gene") for k in sizes]
    )


# ---------------------------------------------------------------- the value histogram of a cell

def value_histogram(counts: DataFrame, extra: Sequence[Column] = ()) -> DataFrame:
    """(cell, count value) -> genes with that count (``genes``) and further sums."""
    return counts.groupBy(*CELL, F.col("n").alias("v")).agg(F.count(F.lit(1)).alias("genes"), *extra)


def _below() -> Column:
    w = Window.partitionBy(*CELL).orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("genes").over(w), F.lit(0))


def _gini_sums(v: Column, total: str) -> Column:
    """sum_i x_i (k - i + 1) over the ascending values, from tie counts."""
    at_least = F.col(total) - F.col("below")
    return F.sum(v * (F.col("genes") * at_least - F.col("genes") * (F.col("genes") - 1) / 2))


def _gini(weighted: Column, total: Column, n: Column) -> Column:
    return F.when(total > 0, (n + 1 - 2 * weighted / total) / n).otherwise(F.lit(0.0))


def gini(values: DataFrame, group: Sequence[str], value: str, sizes: DataFrame, log: str | None = None) -> DataFrame:
    """Gini coefficient of the non-negative integers of each group; zeros may be left out.

    ``sizes(group, n_items)`` gives the number of items including zeros. ``log`` ('ln'/'log1p')
    measures the logged values instead. Equal values are merged first; different integers that
    sum to T number at most sqrt(2 T), which bounds the window.
    """
    hist = values.filter(F.col(value) > 0).groupBy(*group, F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("genes"))
    up = Window.partitionBy(*group).orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    x = {None: F.col("v").cast("double"), "ln": F.ln("v"), "log1p": F.log1p("v")}[log]
    sums = (
        hist.withColumn("below", F.coalesce(F.sum("genes").over(up), F.lit(0)))
        .withColumn("k", F.sum("genes").over(whole))
        .groupBy(*group)
        .agg(_gini_sums(x, "k").alias("weighted"), F.sum(x * F.col("genes")).alias("total"))
    )
    return sizes.join(sums, list(group), "left").select(
        *group, _gini(F.col("weighted"), F.col("total"), F.col("n_items")).alias("gini")
    )


def gini_per_cell(counts: DataFrame, cells: DataFrame, genes: DataFrame, log: str | None = None) -> DataFrame:
    n_genes = genes.groupBy("proj_id").agg(F.count(F.lit(1)).alias("n_items"))
    sizes = cells.join(n_genes, "proj_id").select(*CELL, "n_items")
    return gini(counts, CELL, "n", sizes, log)


def geneset_auroc(counts: DataFrame, cells: DataFrame, genes: DataFrame, sets: Sequence[str]) -> DataFrame:
    """AUROC of every gene set in every cell: do the genes of the set rank above the others?

    ``genes`` carries one boolean column per set. The genes without counts tie at the bottom and
    are added in closed form. NULL for a set with no gene, or all genes, of the project.
    """
    return cell_metrics(counts, cells, genes, sets, parts=("auroc",))


def corr_to_mean(counts: DataFrame, cells: DataFrame, genes: DataFrame) -> DataFrame:
    """Pearson correlation of every cell with the mean profile; ``genes`` carries ``mean``."""
    return cell_metrics(counts, cells, genes, [], parts=("corr",))


def profile_correlations(counts: DataFrame, cells: DataFrame, genes: DataFrame, profiles: DataFrame) -> DataFrame:
    """Pearson correlation of every cell with every given profile of its project.

    ``profiles(proj_id, profile_id, gene_id, y)`` are few sparse rows. The result is the full grid: a pair
    without a common gene still has a (negative) correlation. NULL where either side has no variance.
    """
    n_genes = genes.groupBy("proj_id").agg(F.count(F.lit(1)).alias("g"))
    x = F.col("n").cast("double")
    a = counts.groupBy(*CELL).agg(F.sum(x).alias("sx"), F.sum(x * x).alias("qx"))
    b = profiles.groupBy("proj_id", "profile_id").agg(F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("qy"))
    cross = counts.join(profiles, GENE).groupBy(*CELL, "profile_id").agg(F.sum(x * F.col("y")).alias("xy"))
    grid = cells.select(*CELL).join(b, "proj_id").join(n_genes, "proj_id").join(a, CELL, "left")
    g, sx, sy = F.col("g"), F.col("sx"), F.col("sy")
    spread = (g * F.col("qx") - sx * sx) * (g * F.col("qy") - sy * sy)
    return grid.join(cross, [*CELL, "profile_id"], "left").select(
        *CELL, "profile_id",
        F.when(spread > 0, (g * F.coalesce("xy", F.lit(0.0)) - sx * sy) / F.sqrt(spread)).alias("correlation"),
    )


def cell_metrics(
    counts: DataFrame, cells: DataFrame, genes: DataFrame, sets: Sequence[str],
    parts: Sequence[str] = ("totals", "gini", "auroc", "corr", "share"),
    top: Sequence[int] = fixed.TOP_GENE_SIZES,
) -> DataFrame:
    """All metrics of every cell from one pass over the counts.

    One join with the gene table and one shuffle by cell; the value histogram and the sums over it are made where the cell lies.
    ``parts`` picks the metrics:

    totals  total_counts, n_genes_by_counts
    gini    gini, log1p_gini
    auroc   one column per set
    corr    corr_to_mean (``genes.mean``)
    share   pct_counts_<set>, log1p_total_counts_<set>, pct_counts_in_top_<k>_genes
    """
    sets = list(sets)
    want = set(parts)
    means = ["mean"] if "corr" in want else []
    if means:
        genes = durable(genes.select(*GENE, *sets, *means))  # means are aggregates of the counts, and read twice
    source = counts.select(*GENE, "cell_id", "n")
    packed = [F.lit(0).cast("bigint")] * -(-len(sets) // _FLAGS)  # all sets of a gene in a few numbers
    for i, s in enumerate(sets):
        packed[i // _FLAGS] += F.when(F.col(s), F.lit(1 << i % _FLAGS).cast("bigint")).otherwise(0)
    if sets or means:
        source = source.join(genes.select(*GENE, *[p.alias(f"__flags{j}") for j, p in enumerate(packed)], *means), GENE)
    # rows go to their cell as they are: (cell, value) rarely repeats within a part of (cell, gene), so merging before would hold nearly all rows
    source = source.drop("gene_id").repartition(*CELL)
    member = lambda i: F.col(f"__flags{i // _FLAGS}").bitwiseAND(F.lit(1 << i % _FLAGS).cast("bigint")) != 0
    extra = [F.count(F.when(member(i), 1)).alias(f"in_{s}") for i, s in enumerate(sets)]
    if means:
        extra.append(F.sum("mean").alias("means"))
    hist = value_histogram(source, extra)

    v, c = F.col("v"), F.col("genes")
    whole = Window.partitionBy(*CELL)
    placed = hist.withColumn("below", _below()).withColumn("k", F.sum("genes").over(whole))
    aggs = [F.sum(v * c).alias("total"), F.sum(c).alias("k")]
    if "gini" in want:
        aggs += [
            _gini_sums(v.cast("double"), "k").alias("weighted"),
            _gini_sums(F.log1p("v"), "k").alias("log_weighted"), F.sum(F.log1p("v") * c).alias("log_total"),
        ]
    if "auroc" in want:
        rank = F.col("below") + (c + 1) / 2
        aggs += [F.sum(rank * F.col(f"in_{s}")).alias(f"rank_{s}") for s in sets]
    if sets:
        aggs += [F.sum(f"in_{s}").alias(f"hits_{s}") for s in sets]
    if "share" in want:
        aggs += [F.sum(v * F.col(f"in_{s}")).alias(f"reads_{s}") for s in sets]
        above = F.col("k") - F.col("below") - c
        aggs += [F.sum(v * F.greatest(F.lit(0), F.least(c, F.lit(t) - above))).alias(f"top_{t}") for t in top]
    if "corr" in want:
        aggs += [F.sum(v.cast("double") * v * c).alias("squares"), F.sum(v * F.col("means")).alias("cross")]
    per_cell = placed.groupBy(*CELL).agg(*aggs)

    # one row per project
    project = [F.count(F.lit(1)).alias("g")] + [F.count(F.when(F.col(s), 1)).alias(f"size_{s}") for s in sets]
    if "corr" in want:
        project += [F.sum("mean").alias("mean_sum"), F.sum(F.col("mean") * F.col("mean")).alias("mean_squares")]
    per_project = durable(genes.groupBy("proj_id").agg(*project))

    joined = cells.select(*CELL).join(per_project, "proj_id").join(per_cell, CELL, "left").na.fill(
        0, ["total", "k"] + [f"hits_{s}" for s in sets]
    )
    n, k, total = F.col("g"), F.col("k"), F.col("total")
    out: list[Column] = []
    if "totals" in want:
        out += [total.alias("total_counts"), k.alias("n_genes_by_counts")]
    if "gini" in want:
        out += [_gini(F.col("weighted"), total, n).alias("gini"),
                _gini(F.col("log_weighted"), F.col("log_total"), n).alias("log1p_gini")]
    if "auroc" in want:
        zeros = n - k
        for s in sets:
            size, hits = F.col(f"size_{s}"), F.col(f"hits_{s}")
            ranks = F.coalesce(F.col(f"rank_{s}"), F.lit(0)) + zeros * hits + (size - hits) * (zeros + 1) / 2
            out.append(F.when((size > 0) & (size < n), (ranks / size - (size + 1) / 2) / (n - size)).alias(s))
    if "corr" in want:
        x, xx, xm = total.cast("double"), F.col("squares"), F.col("cross")
        m, mm = F.col("mean_sum"), F.col("mean_squares")
        spread = (n * mm - m * m) * (n * xx - x * x)
        out.append(F.when(spread > 0, (n * xm - x * m) / F.sqrt(spread)).alias("corr_to_mean"))
    if "share" in want:
        for s in sets:
            reads = F.coalesce(F.col(f"reads_{s}"), F.lit(0))
            out += [ratio(reads * 100.0, total).alias(f"pct_counts_{s}"),
                    F.log1p(reads).alias(f"log1p_total_counts_{s}")]
        out += [ratio(F.col(f"top_{t}") * 100.0, total).alias(f"pct_counts_in_top_{t}_genes") for t in top]
    return joined.select(*CELL, *out)


# ---------------------------------------------------------------- normalisation and whole projects

def counts_per_million(counts: DataFrame) -> DataFrame:
    """count / total of the cell * 1e6, in ``cpm``."""
    totals = counts.groupBy(*CELL).agg(F.sum("n").alias("__total"))
    return counts.join(totals, CELL).withColumn("cpm", F.col("n").cast("double") / F.col("__total") * 1e6).drop("__total")


def dropout_density(gene_table: DataFrame, cells: DataFrame) -> DataFrame:
    """Per project: percentage of silent genes, and share of non-zero entries of the matrix."""
    n_cells = cells.groupBy("proj_id").agg(F.count(F.lit(1)).alias("n_cells"))
    per = gene_table.groupBy("proj_id").agg(
        F.count(F.lit(1)).alias("n_genes"), F.count(F.when(F.col("n_cells_by_counts") == 0, 1)).alias("silent"),
        F.sum("n_cells_by_counts").alias("entries"),
    )
    return per.join(n_cells, "proj_id").select(
        "proj_id", (F.col("silent") / F.col("n_genes") * 100).alias("percent_dropout"),
        ratio(F.col("entries"), F.col("n_genes") * F.col("n_cells")).alias("density"),
    )


def dataset_gini(totals: DataFrame) -> DataFrame:
    """Gini of the cells' totals of each project, plain and logged."""
    sizes = totals.groupBy("proj_id").agg(F.count(F.lit(1)).alias("n_items"))
    plain = gini(totals, ["proj_id"], "total_counts", sizes)
    logged = gini(totals, ["proj_id"], "total_counts", sizes, log="ln")
    return plain.join(logged.withColumnRenamed("gini", "log_gini"), "proj_id")


def common_genes(counts: DataFrame, features: DataFrame) -> DataFrame:
    """Counts of several runs of a project, kept for the genes listed by all of its runs.

    ``features(proj_id, run_id, gene_id)`` are the gene lists of the runs.
    """
    features = durable(features.select("proj_id", "run_id", "gene_id").distinct())  # read twice
    n_runs = features.select("proj_id", "run_id").distinct().groupBy("proj_id").agg(F.count(F.lit(1)).alias("n_runs"))
    shared = (
        features.groupBy("proj_id", "gene_id").agg(F.count(F.lit(1)).alias("n_lists"))
        .join(n_runs, "proj_id").filter(F.col("n_lists") == F.col("n_runs")).select("proj_id", "gene_id")
    )
    return counts.join(durable(shared), ["proj_id", "gene_id"], "left_semi")  # a list of genes: its size decides the join

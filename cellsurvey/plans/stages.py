"""Stages: operators put together the way the batch jobs run them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsurvey.functions import fixed_values as fixed
from cellsurvey.operators import annotation, cellqc, metadata, network, summary, technology
from cellsurvey.session import durable


def gene_table(counts: DataFrame, genes: DataFrame, cells: DataFrame, sizes: Sequence[int] = fixed.TOP_GENE_SIZES) -> DataFrame:
    """Gene table with moments, variable-gene and top-k flags.

    The counts are read once; what follows works on the materialised (project, gene) table, which
    several small aggregations read again.
    """
    moments = durable(cellqc.gene_moments(counts, genes, cells))
    return durable(cellqc.top_gene_flags(cellqc.variable_genes(moments), sizes))


def cell_table(
    counts: DataFrame, cells: DataFrame, genes: DataFrame, sets: Sequence[str],
    parts: Sequence[str] = ("totals", "gini", "auroc", "corr"),
) -> DataFrame:
    """Statistics stage: gene table, then every cell metric in one pass over the counts."""
    return cellqc.cell_metrics(counts, cells, gene_table(counts, genes, cells), sets, parts)


def cell_embedding(
    counts: DataFrame, cells: DataFrame, genes: DataFrame, k: int = fixed.N_COMPONENTS, tol: float = 1e-7
) -> DataFrame:
    """Components of the logged counts of the variable genes; at most one less than the cells of a project.

    ``genes`` carries ``highly_variable``. Columns: proj_id, cell_id, features array<double>.
    """
    variable = genes.filter("highly_variable").select("proj_id", "gene_id")
    values = durable(
        counts.join(variable, ["proj_id", "gene_id"], "left_semi")
        .select("proj_id", "cell_id", "gene_id", F.log1p("n").alias("x"))
    )
    n_cells = durable(cells.groupBy("proj_id").agg(F.count(F.lit(1)).alias("c")))  # of known size
    scores = network.components(values, k, tol)
    limit = F.least(F.lit(k).cast("bigint"), F.col("c") - 1).cast("int")
    empty = F.array_repeat(F.lit(0.0), limit)  # cells without a variable gene sit at the origin
    return cells.select("proj_id", "cell_id").join(n_cells, "proj_id").join(scores, ["proj_id", "cell_id"], "left").select(
        "proj_id", "cell_id", F.coalesce(F.slice("pc", F.lit(1), limit), empty).alias("features")
    )


def annotate(counts: DataFrame, cells: DataFrame, class_markers: DataFrame, subclass_markers: DataFrame) -> dict[str, DataFrame]:
    """Annotation stage: scores, enrichment and assignment for class, subclass, and subclass within class."""
    cpm = cellqc.counts_per_million(counts)
    classes = durable(annotation.marker_scores(cpm, cells, class_markers))
    subclasses = durable(annotation.marker_scores(cpm, cells, subclass_markers))
    assigned = annotation.assign_cells(classes)
    return {
        "class_scores": classes, "subclass_scores": subclasses,
        "class_enrichment": annotation.marker_enrichment(classes),
        "subclass_enrichment": annotation.marker_enrichment(subclasses),
        "class": assigned, "subclass": annotation.assign_cells(subclasses),
        "subclass_hier": annotation.assign_cells(subclasses, assigned),
    }


def annotation_quality(stage: dict[str, DataFrame]) -> DataFrame:
    """(proj_id, class_pr, subclass_pr, subclass_pr_hier): areas under the three curves."""
    area = lambda df, name: annotation.auprc(df).select("proj_id", F.col("auprc").alias(name))
    values = lambda name: stage[name].select("proj_id", "cell_id", "cell_type", F.col("enrichment").alias("value"))
    masked = annotation.mask_by_class(values("subclass_enrichment"), stage["class"])
    return summary.join_summaries(
        area(values("class_enrichment"), "class_pr"), area(values("subclass_enrichment"), "subclass_pr"), area(masked, "subclass_pr_hier")
    )


def infer_runs(experiments: DataFrame, runs: DataFrame, samples: DataFrame) -> DataFrame:
    """Inference stage: technology of the protocols, chemistry or manifest of the runs, batch, known ones only.

    ``runs`` carries ``nreads`` and ``read_lengths``; sample attributes come as strings.
    """
    tech = technology.classify_texts(experiments, "exp_id", "lcp")
    droplet = technology.chemistry(runs.join(tech.filter("tech = '10x'").select("exp_id"), "exp_id", "left_semi"))
    plate = technology.plate_manifest(runs, tech)
    return metadata.imputed_runs(droplet, plate, metadata.impute_batch(samples, runs), runs)


def project_summary(cell_table: DataFrame, totals: DataFrame, quality: DataFrame, stats: Sequence[str]) -> DataFrame:
    """Summary stage: metric means, dataset Gini and annotation quality of every project, side by side."""
    means = summary.metric_means(cell_table, stats)
    ginis = cellqc.dataset_gini(totals).withColumnRenamed("gini", "dataset_gini")
    n = totals.groupBy("proj_id").agg(F.count(F.lit(1)).alias("n_cells"))
    return summary.join_summaries(n, means, ginis, quality)

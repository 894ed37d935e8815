"""Cell types from marker sets, precision-recall of the annotation, and marker discovery."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellsurvey.functions import fixed_values as fixed
from cellsurvey.functions.frames import ratio
from cellsurvey.functions.ranking import average_rank_window, number_rows, running_totals, with_neighbours
from cellsurvey.functions.text import safe_name
from cellsurvey.session import durable

CELL = ["proj_id", "cell_id"]


def marker_scores(cpm: DataFrame, cells: DataFrame, markers: DataFrame, max_rank: int = fixed.MAX_MARKER_RANK) -> DataFrame:
    """Score of every cell for every type: mean log1p(cpm) over the markers of the type (our definition).

    Markers without counts add 0. The result is the full grid of cells and types; the types are
    read as one scalar array, never through a join of everything with everything.
    """
    used = markers.filter(F.col("rank") <= max_rank).withColumn("cell_type", safe_name(F.col("cell_type")))
    sizes = used.groupBy("cell_type", "group").agg(F.count(F.lit(1)).alias("n_markers"))
    types = sizes.agg(F.sort_array(F.collect_list(F.struct("cell_type", "group", "n_markers"))).alias("t")).scalar()
    sums = (
        cpm.select(*CELL, "gene_id", F.log1p("cpm").alias("e"))
        .join(used.select("cell_type", "gene_id"), "gene_id")
        .groupBy(*CELL, "cell_type").agg(F.sum("e").alias("e"))
    )
    grid = cells.select(*CELL, F.explode(types).alias("t")).select(*CELL, "t.*")
    return grid.join(sums, [*CELL, "cell_type"], "left").select(
        *CELL, "group", "cell_type", (F.coalesce("e", F.lit(0.0)) / F.col("n_markers")).alias("score")
    )


def marker_enrichment(scores: DataFrame) -> DataFrame:
    """Score relative to the mean score of the cell over the types of the same group (few rows for each cell)."""
    mean = F.avg("score").over(Window.partitionBy(*CELL, "group"))
    return scores.withColumn("enrichment", F.coalesce(ratio(F.col("score"), mean), F.lit(0.0)))


def assign_cells(scores: DataFrame, classes: DataFrame | None = None, digits: int = 9) -> DataFrame:
    """Best-scoring type of each cell (ties: smallest name), ``unassigned`` when nothing scores.

    With ``classes(proj_id, cell_id, predicted)`` only types of the cell's class compete.
    """
    s = scores.withColumn("score", F.round("score", digits))
    cells = s.select(*CELL).distinct()
    if classes is not None:
        s = s.join(classes.select(*CELL, F.col("predicted").alias("__class")), CELL) \
            .filter(F.col("group") == F.col("__class"))
    best = s.groupBy(*CELL).agg(
        F.min(F.struct((-F.col("score")).alias("neg"), F.col("cell_type").alias("t"))).alias("b")
    )
    return cells.join(best, CELL, "left").select(
        *CELL, F.when(F.col("b.neg") < 0, F.col("b.t")).otherwise("unassigned").alias("predicted"),
        F.coalesce(-F.col("b.neg"), F.lit(0.0)).alias("score"),
    )


def mask_by_class(enrichment: DataFrame, classes: DataFrame, value: str = "value") -> DataFrame:
    """Set the enrichment of types whose name does not hold the cell's predicted class to 0."""
    return enrichment.join(classes.select(*CELL, "predicted"), CELL, "left").withColumn(
        value, F.when(F.contains("cell_type", F.col("predicted")) | F.col("predicted").isNull(), F.col(value)).otherwise(0.0)
    ).drop("predicted")


def primary_label(assignments: DataFrame) -> DataFrame:
    """Most frequent prediction of each project (ties: smallest label)."""
    n = assignments.groupBy("proj_id", "predicted").agg(F.count(F.lit(1)).alias("n"))
    best = n.groupBy("proj_id").agg(F.min(F.struct((-F.col("n")).alias("neg"), "predicted")).alias("b"))
    return best.select("proj_id", F.col("b.predicted").alias("primary_label"), (-F.col("b.neg")).alias("n_cells"))


# ---------------------------------------------------------------- precision and recall

def _ranked_pairs(enrichment: DataFrame, value: str) -> DataFrame:
    """Pairs of a project from the largest value down, with pairs and cells seen before each.

    A cell is first seen at its best type. Ordering is over (value, cell, type), so ties of any
    size, such as masked zeros, spread over tasks.
    """
    by_cell = Window.partitionBy(*CELL).orderBy(F.desc("value"), "cell_type")  # one cell: its types
    first = enrichment.select(*CELL, "cell_type", F.col(value).alias("value")).withColumn(
        "first_seen", F.row_number().over(by_cell) == 1
    )
    flagged = first.withColumns({"one": F.lit(1).cast("bigint"), "new": F.col("first_seen").cast("bigint")})
    return running_totals(flagged, ["proj_id"], [F.desc("value"), "cell_id", "cell_type"], ["one", "new"])


def pr_curve(enrichment: DataFrame, value: str = "value") -> DataFrame:
    """Precision-recall curve of each project: position P, distinct cells TP, recall and precision."""
    n_cells = durable(enrichment.select(*CELL).distinct().groupBy("proj_id").agg(F.count(F.lit(1)).alias("n_cells")))
    tp, p = F.col("new_before") + F.col("new"), F.col("one_before") + 1
    return _ranked_pairs(enrichment, value).join(n_cells, "proj_id").select(
        *CELL, "cell_type", "value", "first_seen", tp.alias("TP"), p.alias("P"),
        (tp / F.col("n_cells")).alias("recall"), (tp / p).alias("precision"),
    )


def auprc(enrichment: DataFrame, value: str = "value") -> DataFrame:
    """Area under the curve with the end points (0, 1) and (1, 0).

    The area grows only where a new cell is seen, so it is a sum over the first hits.
    """
    hits = _ranked_pairs(enrichment, value).filter(F.col("first_seen"))
    j, k = F.col("new_before") + 1, F.col("one_before") + 1
    before = F.when(k == 1, 1.0).otherwise((j - 1) / (k - 1))
    return hits.groupBy("proj_id").agg(
        (F.sum((j / k + before) / 2) / F.count(F.lit(1))).alias("auprc"), F.count(F.lit(1)).alias("n_cells")
    )


def thin_curve(curve: DataFrame) -> DataFrame:
    """Drop curve points where the slope between both neighbours is 0 or infinite; ends stay."""
    seen = with_neighbours(curve, ["proj_id"], "P", ["precision", "recall"])
    rise = F.col("next_precision") - F.col("prev_precision")
    run = F.col("next_recall") - F.col("prev_recall")
    end = F.col("prev_precision").isNull() | F.col("next_precision").isNull()
    return seen.filter(end | ((run != 0) & (rise != 0))).select(*curve.columns)


def trapezoid(points: DataFrame, group: Sequence[str], x: str, y: str, order: Sequence[Column | str]) -> DataFrame:
    """Trapezoid area under (x, y) taken in ``order``."""
    placed = with_neighbours(number_rows(points, group, order, "__p"), group, "__p", [x, y])
    piece = (F.col(x) - F.col(f"prev_{x}")) * (F.col(y) + F.col(f"prev_{y}")) / 2
    return placed.groupBy(*group).agg(F.coalesce(F.sum(piece), F.lit(0.0)).alias("area"))


def thinned_auc(curve: DataFrame) -> DataFrame:
    """Area under the thinned curve, without end points."""
    return trapezoid(thin_curve(curve), ["proj_id"], "recall", "precision", ["recall", "P"])


# ---------------------------------------------------------------- marker discovery

_GENE = ["proj_id", "group", "gene_id"]


def _rank_sums(hits: DataFrame) -> DataFrame:
    """Hits, sum of their ranks and sum of their cpm for every (gene, cell type); a gene is ranked by one task."""
    rank = average_rank_window(_GENE, "cpm")
    return hits.select(*_GENE, "cell_type", "cpm", rank.alias("rank")).groupBy(*_GENE, "cell_type").agg(
        F.count(F.lit(1)).alias("hits"), F.sum("rank").alias("ranks"), F.sum("cpm").alias("sum_in"))


def _spread_rank_sums(hits: DataFrame) -> DataFrame:
    """The same for genes of any size: merged by value before the ranking, which is range partitioned."""
    hist = (
        hits.groupBy(*_GENE, "cpm", "cell_type").agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*_GENE, "cpm")  # one entry per cell type
        .agg(F.sum("n").alias("n"), F.collect_list(F.struct("cell_type", F.col("n").alias("hits"))).alias("types"))
    )
    ranked = running_totals(hist, _GENE, ["cpm"], ["n"])
    rank = F.col("n_before") + (F.col("n") + 1) / 2
    return ranked.select(*_GENE, "cpm", rank.alias("rank"), F.explode("types").alias("t")).groupBy(
        *_GENE, F.col("t.cell_type").alias("cell_type")
    ).agg(
        F.sum("t.hits").alias("hits"), F.sum(F.col("t.hits") * F.col("rank")).alias("ranks"),
        F.sum(F.col("t.hits") * F.col("cpm")).alias("sum_in"),
    )


def marker_statistics(cpm: DataFrame, labels: DataFrame, most_cells: int = 1 << 20, part_hits: int = 1 << 18) -> DataFrame:
    """One-against-rest statistics of every gene for every cell type within its group (our definition).

    ``labels(proj_id, cell_id, group, cell_type)``. For each (study, group, type, gene): AUROC of the
    expression with silent cells tied at the bottom, mean cpm inside and outside, log2 fold change
    with pseudo-count 1, and detection rates. Genes silent in the whole group give no row.
    A gene has no more hits than its group has cells: in groups of at most ``most_cells`` cells it is moved once and
    ranked by one task, which gets about ``part_hits`` hits; in larger ones its values are merged and ranked by range partitions.
    """
    sizes = labels.groupBy("proj_id", "group", "cell_type").agg(F.count(F.lit(1)).alias("n_in"))
    types = durable(sizes.withColumn("n_all", F.sum("n_in").over(Window.partitionBy("proj_id", "group"))))  # a row per type
    hits = durable(cpm.filter("gene_id is not null").join(labels.filter(F.col("group").isNotNull()), CELL).select(*_GENE, "cell_type", "cpm"))
    dealt = lambda rows: rows.repartition(max(1, math.ceil(hits.count() / part_hits)), *_GENE)
    large = types.filter(F.col("n_all") > most_cells).select("proj_id", "group").distinct()
    if large.isEmpty():
        inside = _rank_sums(dealt(hits))
    else:
        part = lambda how: hits.join(large, ["proj_id", "group"], how)
        inside = _rank_sums(dealt(part("left_anti"))).unionByName(_spread_rank_sums(part("left_semi")))
    # the types of a gene side by side; as in a join, a type without a name is equal to nothing
    named = F.col("cell_type").isNotNull()
    by_gene = inside.groupBy(*_GENE).agg(
        F.sum("hits").alias("hits_all"), F.sum("sum_in").alias("sum_all"),
        F.map_from_entries(F.collect_list(F.when(named, F.struct("cell_type", F.struct("hits", "ranks", "sum_in"))))).alias("by_type"))
    full = by_gene.join(types.filter(F.col("n_all") > F.col("n_in")), ["proj_id", "group"]).withColumn("t", F.col("by_type")[F.col("cell_type")]).select(
        *_GENE, "cell_type", "n_in", "n_all", "hits_all", "sum_all", "t.*").na.fill(0, ["hits", "ranks", "sum_in"])
    n_in, n_out = F.col("n_in"), F.col("n_all") - F.col("n_in")
    zeros = F.col("n_all") - F.col("hits_all")
    total = F.col("ranks") + zeros * F.col("hits") + (n_in - F.col("hits")) * (zeros + 1) / 2
    # a difference of sums can fall below 0 by rounding
    mean_in, mean_out = F.col("sum_in") / n_in, F.greatest(F.col("sum_all") - F.col("sum_in"), F.lit(0.0)) / n_out
    return full.select(
        "proj_id", "group", "cell_type", "gene_id",
        ((total / n_in - (n_in + 1) / 2) / n_out).alias("auroc"),
        mean_in.alias("mean_in"), mean_out.alias("mean_out"),
        F.log2((mean_in + 1) / (mean_out + 1)).alias("log2_fold_change"),
        (F.col("hits") / n_in).alias("detection_in"),
        ((F.col("hits_all") - F.col("hits")) / n_out).alias("detection_out"),
    )


def recurrent_markers(statistics: DataFrame, min_auroc: float = 0.5, digits: int = 10) -> DataFrame:
    """Combine studies: recurrence (studies with AUROC above the bound), mean statistics, rank per type.

    Rank orders genes of a (group, type) by recurrence, then mean AUROC, then gene id.
    """
    merged = statistics.groupBy("group", "cell_type", "gene_id").agg(
        F.count(F.when(F.col("auroc") > min_auroc, 1)).alias("recurrence"),
        F.count(F.lit(1)).alias("n_studies"),
        F.round(F.avg("auroc"), digits).alias("mean_auroc"),
        F.round(F.avg("log2_fold_change"), digits).alias("mean_log2_fold_change"),
    )
    return number_rows(
        merged, ["group", "cell_type"], [F.desc("recurrence"), F.desc("mean_auroc"), "gene_id"], "rank"
    )


def top_markers(markers: DataFrame, max_rank: int = fixed.MAX_MARKER_RANK) -> DataFrame:
    return markers.filter(F.col("rank") <= max_rank)


def study_labels(labels: DataFrame, column: str, renames: dict[str, str] | None = None, common: bool = False) -> DataFrame:
    """Labelled cells of several studies: no missing labels, renamed, and if asked only labels of all studies."""
    named = labels.filter(F.col(column).isNotNull() & (F.col(column) != "")).replace(renames or {}, subset=[column])
    if not common:
        return named
    n_studies = named.select("proj_id").distinct().agg(F.count(F.lit(1))).scalar()
    shared = (
        named.select("proj_id", column).distinct().groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") == n_studies).select(column)
    )
    return named.join(shared, column, "left_semi")

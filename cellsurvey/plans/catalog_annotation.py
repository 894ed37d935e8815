"""Queries on cell-type annotation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsurvey.operators import annotation, cellqc
from cellsurvey.plans import bindings as b
from cellsurvey.plans.bindings import Tables
from cellsurvey.plans.oracle_views import BASE
from cellsurvey.plans.registry import query, rounded

_CPM = f"""{BASE},
cpm AS (SELECT proj_id, cell_id, gene_id, n / sum(n) OVER (PARTITION BY proj_id, cell_id) * 1e6 AS cpm FROM counts),
class_markers AS (SELECT p_type AS cell_type, 'all' AS grp, p_partkey AS gene_id, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part),
sub_markers AS (SELECT concat(p_type, '-', p_size % 3) AS cell_type, p_type AS grp, p_partkey AS gene_id, row_number() OVER (PARTITION BY p_type, p_size % 3 ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part)
"""


def _scores_sql(markers: str, name: str) -> str:
    return f"""
{name}_sizes AS (SELECT cell_type, grp, count(*) AS m FROM {markers} WHERE rank <= 100 GROUP BY ALL),
{name}_sums AS (SELECT proj_id, cell_id, cell_type, sum(ln(1 + cpm)) AS e FROM cpm JOIN {markers} USING (gene_id) WHERE rank <= 100 GROUP BY ALL),
{name} AS (SELECT c.proj_id, c.cell_id, z.grp, z.cell_type, coalesce(e, 0) / m AS score FROM cells c JOIN {name}_sizes z ON true LEFT JOIN {name}_sums s ON s.proj_id = c.proj_id AND s.cell_id = c.cell_id AND s.cell_type = z.cell_type)
"""


_CLASS = f"{_CPM}, {_scores_sql('class_markers', 'cls')}"
_SUB = f"{_CLASS}, {_scores_sql('sub_markers', 'sub')}"
_ASSIGN_CLASS = """class_pred AS (SELECT proj_id, cell_id, CASE WHEN s > 0 THEN cell_type ELSE 'unassigned' END AS predicted, s AS score FROM
 (SELECT proj_id, cell_id, cell_type, round(score, 9) AS s, row_number() OVER (PARTITION BY proj_id, cell_id ORDER BY round(score, 9) DESC, cell_type) AS i FROM cls) WHERE i = 1)"""


def _class_scores(t: Tables) -> DataFrame:
    return annotation.marker_scores(cellqc.counts_per_million(b.counts(t)), b.cells(t), b.class_markers(t))


def _sub_scores(t: Tables) -> DataFrame:
    return annotation.marker_scores(cellqc.counts_per_million(b.counts(t)), b.cells(t), b.markers(t))


@query("marker_scores", f'WITH {_SUB} SELECT proj_id, cell_id, grp AS "group", cell_type, round(score, 6) AS score FROM sub')
def marker_scores(t: Tables) -> DataFrame:
    return rounded(_sub_scores(t), "score")


@query("marker_enrichment", f"""WITH {_SUB} SELECT proj_id, cell_id, cell_type, CASE WHEN avg(score) OVER w <> 0 THEN round(score / avg(score) OVER w, 6) ELSE 0 END AS enrichment FROM sub WINDOW w AS (PARTITION BY proj_id, cell_id, grp)""")
def marker_enrichment(t: Tables) -> DataFrame:
    e = annotation.marker_enrichment(_sub_scores(t))
    return rounded(e.select("proj_id", "cell_id", "cell_type", "enrichment"), "enrichment")


@query("assign_class", f"WITH {_CLASS}, {_ASSIGN_CLASS} SELECT proj_id, cell_id, predicted, round(score, 6) AS score FROM class_pred")
def assign_class(t: Tables) -> DataFrame:
    return rounded(annotation.assign_cells(_class_scores(t)), "score")


@query("assign_subclass", f"""WITH {_SUB} SELECT proj_id, cell_id, CASE WHEN s > 0 THEN cell_type ELSE 'unassigned' END AS predicted FROM
 (SELECT proj_id, cell_id, cell_type, round(score, 9) AS s, row_number() OVER (PARTITION BY proj_id, cell_id ORDER BY round(score, 9) DESC, cell_type) AS i FROM sub) WHERE i = 1""")
def assign_subclass(t: Tables) -> DataFrame:
    return annotation.assign_cells(_sub_scores(t)).select("proj_id", "cell_id", "predicted")


@query("assign_subclass_hier", f"""WITH {_SUB}, {_ASSIGN_CLASS}, f AS (SELECT s.proj_id, s.cell_id, cell_type, round(s.score, 9) AS s FROM sub s JOIN class_pred p ON s.proj_id = p.proj_id AND s.cell_id = p.cell_id AND s.grp = p.predicted),
r AS (SELECT *, row_number() OVER (PARTITION BY proj_id, cell_id ORDER BY s DESC, cell_type) AS i FROM f)
SELECT c.proj_id, c.cell_id, CASE WHEN s > 0 THEN cell_type ELSE 'unassigned' END AS predicted FROM cells c LEFT JOIN (SELECT * FROM r WHERE i = 1) USING (proj_id, cell_id)""")
def assign_subclass_hier(t: Tables) -> DataFrame:
    classes = annotation.assign_cells(_class_scores(t))
    return annotation.assign_cells(_sub_scores(t), classes).select("proj_id", "cell_id", "predicted")


@query("primary_class", f"""WITH {_CLASS}, {_ASSIGN_CLASS}, n AS (SELECT proj_id, predicted, count(*) AS n FROM class_pred GROUP BY ALL)
SELECT proj_id, predicted AS primary_label, n AS n_cells FROM (SELECT *, row_number() OVER (PARTITION BY proj_id ORDER BY n DESC, predicted) AS i FROM n) WHERE i = 1""")
def primary_class(t: Tables) -> DataFrame:
    return annotation.primary_label(annotation.assign_cells(_class_scores(t)))


# ---------------------------------------------------------------- precision and recall

_ENR = """
enr AS (SELECT concat('P', label % 3) AS proj_id, vec_id AS cell_id, concat('c', pos % 10, '_', pos) AS cell_type, CAST(v AS DOUBLE) AS value, concat('c', label, '_') AS predicted
  FROM (SELECT label, vec_id, unnest(embedding) AS v, unnest(range(0, len(embedding))) AS pos FROM embeddings)),
masked AS (SELECT proj_id, cell_id, cell_type, CASE WHEN contains(cell_type, predicted) THEN value ELSE 0 END AS value FROM enr)
"""


def _pr_sql(source: str) -> str:
    return f"""
f AS (SELECT *, row_number() OVER (PARTITION BY proj_id, cell_id ORDER BY value DESC, cell_type) = 1 AS first_seen FROM {source}),
pr AS (SELECT proj_id, cell_id, cell_type, value, first_seen, CAST(sum(CAST(first_seen AS INT)) OVER w AS BIGINT) AS TP, row_number() OVER w AS P, n_cells FROM f
  JOIN (SELECT proj_id, count(DISTINCT cell_id) AS n_cells FROM {source} GROUP BY ALL) USING (proj_id)
  WINDOW w AS (PARTITION BY proj_id ORDER BY value DESC, cell_id, cell_type ROWS UNBOUNDED PRECEDING)),
curve AS (SELECT *, TP / n_cells AS recall, TP / P AS precision FROM pr)
"""


_AREA = """pts AS (SELECT proj_id, P, recall, precision FROM curve UNION ALL SELECT DISTINCT proj_id, 0, 0.0, 1.0 FROM curve UNION ALL SELECT proj_id, max(P) + 1, 1.0, 0.0 FROM curve GROUP BY proj_id),
lagged AS (SELECT *, lag(recall) OVER w AS r0, lag(precision) OVER w AS p0 FROM pts WINDOW w AS (PARTITION BY proj_id ORDER BY P))
SELECT proj_id, round(sum((recall - r0) * (precision + p0) / 2), 6) AS auprc, (SELECT max(n_cells) FROM curve c WHERE c.proj_id = l.proj_id) AS n_cells FROM lagged l GROUP BY proj_id"""


@query("pr_curve", f"WITH {_ENR}, {_pr_sql('enr')} SELECT proj_id, cell_id, cell_type, first_seen, TP, P, recall, precision FROM curve")
def pr_curve(t: Tables) -> DataFrame:
    return annotation.pr_curve(b.enrichment(t)).drop("value")


@query("auprc", f"WITH {_ENR}, {_pr_sql('enr')}, {_AREA}")
def auprc(t: Tables) -> DataFrame:
    return rounded(annotation.auprc(b.enrichment(t)), "auprc")


@query("pr_hier", f"WITH {_ENR}, {_pr_sql('masked')} SELECT proj_id, cell_id, cell_type, first_seen, TP, P, recall, precision FROM curve")
def pr_hier(t: Tables) -> DataFrame:
    masked = annotation.mask_by_class(b.enrichment(t), b.predicted_classes(t))
    return annotation.pr_curve(masked).drop("value")


@query("auprc_hier", f"WITH {_ENR}, {_pr_sql('masked')}, {_AREA}")
def auprc_hier(t: Tables) -> DataFrame:
    return rounded(annotation.auprc(annotation.mask_by_class(b.enrichment(t), b.predicted_classes(t))), "auprc")


_THIN = """n AS (SELECT *, lag(precision) OVER w AS p0, lead(precision) OVER w AS p1, lag(recall) OVER w AS r0, lead(recall) OVER w AS r1 FROM curve WINDOW w AS (PARTITION BY proj_id ORDER BY P)),
thin AS (SELECT * FROM n WHERE p0 IS NULL OR p1 IS NULL OR (r1 <> r0 AND p1 <> p0))"""


@query("pr_thinned", f"WITH {_ENR}, {_pr_sql('enr')}, {_THIN} SELECT proj_id, P, TP, recall, precision FROM thin")
def pr_thinned(t: Tables) -> DataFrame:
    thin = annotation.thin_curve(annotation.pr_curve(b.enrichment(t)))
    return thin.select("proj_id", "P", "TP", "recall", "precision")


@query("pr_thinned_area", f"""WITH {_ENR}, {_pr_sql('enr')}, {_THIN}, l AS (SELECT proj_id, recall, precision, lag(recall) OVER w AS a, lag(precision) OVER w AS b FROM thin WINDOW w AS (PARTITION BY proj_id ORDER BY recall, P))
SELECT proj_id, round(coalesce(sum((recall - a) * (precision + b) / 2), 0), 6) AS area FROM l GROUP BY proj_id""")
def pr_thinned_area(t: Tables) -> DataFrame:
    return rounded(annotation.thinned_auc(annotation.pr_curve(b.enrichment(t))), "area")


# ---------------------------------------------------------------- marker discovery

_STATS = f"""{_CPM},
labels AS (SELECT proj_id, cell_id, 'all' AS grp, concat('t', cell_id % 3) AS cell_type FROM cells),
seen AS (SELECT DISTINCT proj_id, gene_id FROM counts),
dense AS (SELECT l.proj_id, l.grp, l.cell_type, s.gene_id, coalesce(cpm, 0) AS x FROM labels l JOIN seen s USING (proj_id) LEFT JOIN cpm USING (proj_id, cell_id, gene_id)),
rk AS (SELECT *, rank() OVER (PARTITION BY proj_id, grp, gene_id ORDER BY x) + (count(*) OVER (PARTITION BY proj_id, grp, gene_id, x) - 1) / 2 AS r FROM dense),
inn AS (SELECT proj_id, grp, cell_type, gene_id, sum(r) AS r, count(*) AS n, sum(x) AS sx, count(*) FILTER (x > 0) AS h FROM rk GROUP BY ALL),
alls AS (SELECT proj_id, grp, gene_id, count(*) AS n_all, sum(x) AS sa, count(*) FILTER (x > 0) AS ha FROM rk GROUP BY ALL),
st AS (SELECT i.proj_id, i.grp, i.cell_type, i.gene_id, (r / n - (n + 1) / 2) / (n_all - n) AS auroc, sx / n AS mean_in, (sa - sx) / (n_all - n) AS mean_out,
  log2((sx / n + 1) / ((sa - sx) / (n_all - n) + 1)) AS lfc, h / n AS detection_in, (ha - h) / (n_all - n) AS detection_out FROM inn i JOIN alls a USING (proj_id, grp, gene_id) WHERE n_all > n)
"""


def _statistics(t: Tables) -> DataFrame:
    return annotation.marker_statistics(cellqc.counts_per_million(b.counts(t)), b.cell_labels(t))


@query("marker_stats", f"""WITH {_STATS} SELECT proj_id, cell_type, gene_id, round(auroc, 6) AS auroc, round(mean_in, 3) AS mean_in, round(greatest(mean_out, 0), 3) AS mean_out, round(lfc, 5) AS log2_fold_change, round(detection_in, 6) AS detection_in, round(detection_out, 6) AS detection_out FROM st""")
def marker_stats(t: Tables) -> DataFrame:
    d = _statistics(t).drop("group")
    d = rounded(d, "auroc", "detection_in", "detection_out")
    return rounded(rounded(d, "mean_in", "mean_out", digits=3), "log2_fold_change", digits=5)


@query("recurrent_markers", f"""WITH {_STATS}, m AS (SELECT grp, cell_type, gene_id, count(*) FILTER (auroc > 0.5) AS recurrence, count(*) AS n_studies, round(avg(auroc), 10) AS mean_auroc FROM st GROUP BY ALL)
SELECT cell_type, gene_id, recurrence, n_studies, mean_auroc, row_number() OVER (PARTITION BY grp, cell_type ORDER BY recurrence DESC, mean_auroc DESC, gene_id) AS rank FROM m""")
def recurrent_markers(t: Tables) -> DataFrame:
    return annotation.recurrent_markers(_statistics(t)).select("cell_type", "gene_id", "recurrence", "n_studies", "mean_auroc", "rank")


@query("top_markers", f"""WITH {_CPM} SELECT cell_type, grp AS "group", gene_id, rank FROM sub_markers WHERE rank <= 100""")
def top_markers(t: Tables) -> DataFrame:
    return annotation.top_markers(b.markers(t)).withColumn("cell_type", annotation.safe_name(F.col("cell_type")))


@query("study_labels", """WITH l AS (SELECT lang AS proj_id, doc_id AS cell_id, CASE WHEN source = 'src19' THEN 'src18' ELSE source END AS tissue FROM documents WHERE source <> 'src7')
SELECT * FROM l WHERE tissue IN (SELECT tissue FROM l GROUP BY tissue HAVING count(DISTINCT proj_id) = (SELECT count(DISTINCT proj_id) FROM l))""")
def study_labels(t: Tables) -> DataFrame:
    labels = t.documents.select(F.col("lang").alias("proj_id"), F.col("doc_id").alias("cell_id"), F.when(F.col("source") != "src7", F.col("source")).otherwise("").alias("tissue"))
    return annotation.study_labels(labels, "tissue", {"src19": "src18"}, common=True)


# ---------------------------------------------------------------- whole stages

_QUALITY = f"""{_SUB}, {_ASSIGN_CLASS},
ce AS (SELECT proj_id, cell_id, cell_type, CASE WHEN avg(score) OVER w <> 0 THEN score / avg(score) OVER w ELSE 0 END AS v FROM cls WINDOW w AS (PARTITION BY proj_id, cell_id, grp)),
se AS (SELECT proj_id, cell_id, cell_type, CASE WHEN avg(score) OVER w <> 0 THEN score / avg(score) OVER w ELSE 0 END AS v FROM sub WINDOW w AS (PARTITION BY proj_id, cell_id, grp)),
allv AS (SELECT 'class_pr' AS k, * FROM ce UNION ALL SELECT 'subclass_pr', * FROM se UNION ALL SELECT 'subclass_pr_hier', proj_id, cell_id, cell_type, CASE WHEN contains(cell_type, predicted) THEN v ELSE 0 END FROM se JOIN class_pred USING (proj_id, cell_id)),
f AS (SELECT *, row_number() OVER (PARTITION BY k, proj_id, cell_id ORDER BY v DESC, cell_type) = 1 AS f FROM allv),
r AS (SELECT *, row_number() OVER w AS p, sum(CAST(f AS INT)) OVER w AS tp FROM f WINDOW w AS (PARTITION BY k, proj_id ORDER BY v DESC, cell_id, cell_type ROWS UNBOUNDED PRECEDING)),
a AS (SELECT k, proj_id, sum((tp / p + CASE WHEN p = 1 THEN 1 ELSE (tp - 1) / (p - 1) END) / 2) / count(*) AS area FROM r WHERE f GROUP BY ALL)
"""


@query("annotation_quality", f"""WITH {_QUALITY}SELECT proj_id, round(max(area) FILTER (k = 'class_pr'), 6) AS class_pr, round(max(area) FILTER (k = 'subclass_pr'), 6) AS subclass_pr, round(max(area) FILTER (k = 'subclass_pr_hier'), 6) AS subclass_pr_hier FROM a GROUP BY proj_id""")
def annotation_quality(t: Tables) -> DataFrame:
    """The annotation stage and the areas under its three curves."""
    from cellsurvey.plans import stages

    stage = stages.annotate(b.counts(t), b.cells(t), b.class_markers(t), b.markers(t))
    return rounded(stages.annotation_quality(stage), "class_pr", "subclass_pr", "subclass_pr_hier")


@query("project_summary", f"""WITH {_QUALITY}, t AS (SELECT c.proj_id, c.cell_id, coalesce(sum(n), 0) AS tc, count(n) AS ng FROM cells c LEFT JOIN counts USING (proj_id, cell_id) GROUP BY ALL),
s AS (SELECT *, row_number() OVER (PARTITION BY proj_id ORDER BY tc) AS i, count(*) OVER (PARTITION BY proj_id) AS k FROM t),
m AS (SELECT proj_id, count(*) AS n_cells, round(avg(tc), 6) AS total_counts, round(avg(ng), 6) AS n_genes_by_counts,
 round((count(*) + 1 - 2 * CAST(sum(tc * (k - i + 1)) AS DOUBLE) / CAST(sum(tc) AS DOUBLE)) / count(*), 6) AS dataset_gini FROM s GROUP BY proj_id),
q AS (SELECT proj_id, round(max(area) FILTER (k = 'class_pr'), 6) AS class_pr, round(max(area) FILTER (k = 'subclass_pr'), 6) AS subclass_pr, round(max(area) FILTER (k = 'subclass_pr_hier'), 6) AS subclass_pr_hier FROM a GROUP BY proj_id)
SELECT * FROM m LEFT JOIN q USING (proj_id)""")
def project_summary(t: Tables) -> DataFrame:
    """Means, Gini of the project and the areas under its three annotation curves."""
    from cellsurvey.plans import stages
    from cellsurvey.session import durable

    totals = durable(cellqc.cell_totals(b.counts(t), b.cells(t)))
    quality = stages.annotation_quality(stages.annotate(b.counts(t), b.cells(t), b.class_markers(t), b.markers(t)))
    d = stages.project_summary(totals, totals, quality, ["total_counts", "n_genes_by_counts"]).drop("log_gini")
    return rounded(d, "total_counts", "n_genes_by_counts", "dataset_gini", "class_pr", "subclass_pr", "subclass_pr_hier")

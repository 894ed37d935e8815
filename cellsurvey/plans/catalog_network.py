"""Queries on similarity networks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsurvey.operators import ledger, network
from cellsurvey.plans import bindings as b
from cellsurvey.plans.bindings import Tables
from cellsurvey.plans.oracle_views import BASE
from cellsurvey.plans.registry import query, rounded
from cellsurvey.session import durable

_PAIRS = """
vec AS (SELECT concat('P', label % 3) AS proj_id, vec_id AS node, CAST(embedding AS DOUBLE[]) AS f, label FROM embeddings),
pairs AS (SELECT a.proj_id, a.node AS src, b.node AS dst, CASE WHEN a.node = b.node THEN 0 ELSE list_distance(a.f, b.f) END AS d FROM vec a JOIN vec b USING (proj_id))
"""
_KNN = f"""{_PAIRS}, knn AS (SELECT * FROM (SELECT proj_id, src, dst, d, row_number() OVER (PARTITION BY proj_id, src ORDER BY round(d, 12), dst) AS rank FROM pairs WHERE src <> dst) WHERE rank <= 15)"""


@query("knn_exact", f"WITH {_KNN} SELECT src AS cell_id, dst AS neighbour, round(d, 6) AS distance, CAST(rank AS INT) AS rank FROM knn")
def knn_exact(t: Tables) -> DataFrame:
    return rounded(network.nearest_neighbours(b.vectors(t)).select("cell_id", "neighbour", "distance", "rank"), "distance")


@query("knn_recall", f"""WITH {_KNN}, sizes AS (SELECT proj_id, count(*) AS n FROM vec GROUP BY ALL)
SELECT proj_id, count(*) AS n_found, CAST(sum(CAST(rank AS BIGINT)) AS BIGINT) AS rank_sum, true AS recalled FROM knn JOIN sizes USING (proj_id) GROUP BY ALL""")
def knn_recall(t: Tables) -> DataFrame:
    """Approximate neighbours against the exact ones: as many rows with the same ranks, and nine of ten are the same cells."""
    v = b.vectors(t)
    exact = network.nearest_neighbours(v).select("proj_id", "cell_id", "neighbour", F.lit(1).alias("hit"))
    found = network.nearest_neighbours(v, method="lsh").join(exact, ["proj_id", "cell_id", "neighbour"], "left")
    return found.groupBy("proj_id").agg(
        F.count(F.lit(1)).alias("n_found"), F.sum("rank").cast("bigint").alias("rank_sum"), (F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("recalled"))


_SIM = f"""{_KNN}, mx AS (SELECT proj_id, max(d) AS m FROM knn GROUP BY ALL), e0 AS (SELECT proj_id, src, dst, 1 - d / m AS w FROM knn JOIN mx USING (proj_id)),
edges AS (SELECT proj_id, src, dst, max(w) AS w FROM (SELECT * FROM e0 UNION ALL SELECT proj_id, dst, src, w FROM e0) GROUP BY ALL)"""


@query("similarity_edges", f"WITH {_SIM} SELECT src, dst, round(w, 6) AS w FROM edges")
def similarity_edges(t: Tables) -> DataFrame:
    return rounded(network.symmetric_edges(network.nearest_neighbours(b.vectors(t))).drop("proj_id"), "w")


@query("similarity_weights", f"WITH {_KNN} SELECT src AS cell_id, dst AS neighbour, round(1 - d / max(d) OVER (PARTITION BY proj_id), 6) AS w FROM knn")
def similarity_weights(t: Tables) -> DataFrame:
    return rounded(network.similarity(network.nearest_neighbours(b.vectors(t))).select("cell_id", "neighbour", "w"), "w")


@query("rank_standardise", """WITH e AS (SELECT l_returnflag AS proj_id, l_orderkey, l_linenumber, l_partkey, CASE WHEN l_discount = 0 THEN NULL ELSE l_extendedprice END AS w FROM lineitem),
r AS (SELECT *, rank() OVER (PARTITION BY proj_id ORDER BY w) + (count(*) OVER (PARTITION BY proj_id, w) - 1) / 2 AS r FROM e WHERE w IS NOT NULL)
SELECT proj_id, l_orderkey, l_linenumber, l_partkey, round((r - 1) / (max(r) OVER (PARTITION BY proj_id) - 1), 6) AS standardised FROM r UNION ALL SELECT proj_id, l_orderkey, l_linenumber, l_partkey, 0.5 FROM e WHERE w IS NULL""")
def rank_standardise(t: Tables) -> DataFrame:
    """Line items as edges of three projects; undiscounted ones have no weight."""
    edges = t.lineitem.select(F.col("l_returnflag").alias("proj_id"), "l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_discount") != 0, F.col("l_extendedprice")).alias("w"))
    return rounded(network.rank_standardise(edges).drop("w"), "standardised")


_TERMS = f"""
raw AS (SELECT proj_id, vec_id AS node, concat(k, '=', v) AS term FROM (SELECT concat('P', label % 3) AS proj_id, vec_id, unnest(['label', 'copy', 'parity', 'all', 'single']) AS k,
   unnest([CAST(label AS VARCHAR), CAST(label AS VARCHAR), CAST(vec_id % 2 AS VARCHAR), '1', CAST(vec_id AS VARCHAR)]) AS v FROM embeddings)),
sig AS (SELECT proj_id, term, string_agg(CAST(node AS VARCHAR), ',' ORDER BY node) AS s, count(*) AS c FROM raw GROUP BY ALL),
uniq AS (SELECT proj_id, min(term) AS term, any_value(c) AS c FROM sig GROUP BY proj_id, s),
sizes AS (SELECT proj_id, count(DISTINCT node) AS n FROM raw GROUP BY ALL),
members AS (SELECT r.* FROM raw r JOIN uniq USING (proj_id, term) JOIN sizes USING (proj_id) WHERE c > 5 AND c < ceil(n * CAST(0.95 AS DOUBLE)))
"""


def _cells(t: Tables) -> DataFrame:
    """Embeddings with term columns: labels, an exact copy of them, parity, one term of all, one per cell."""
    return b.vectors(t).select("proj_id", "cell_id", "label", F.col("label").alias("copy"), (F.col("cell_id") % 2).alias("parity"), F.lit(1).alias("all"), F.col("cell_id").alias("single"))


_COLUMNS = ["label", "copy", "parity", "all", "single"]


def _members(t: Tables) -> DataFrame:
    cells = _cells(t)
    return network.sized_terms(network.membership(cells, _COLUMNS), cells)


@query("distinct_terms", f"WITH {_TERMS} SELECT proj_id, r.node, term FROM raw r JOIN uniq USING (proj_id, term)")
def distinct_terms(t: Tables) -> DataFrame:
    return ledger.distinct_terms(network.membership(_cells(t), _COLUMNS)).select("proj_id", "node", "term")


@query("term_membership", f"WITH {_TERMS} SELECT proj_id, node, term FROM members")
def term_membership(t: Tables) -> DataFrame:
    return _members(t).select("proj_id", "node", "term")


@query("term_folds", f"WITH {_TERMS} SELECT proj_id, node, term, CAST((row_number() OVER (PARTITION BY proj_id ORDER BY node, term) - 1) % 3 AS INT) AS fold FROM members")
def term_folds(t: Tables) -> DataFrame:
    return network.with_folds(_members(t), 3).select("proj_id", "node", "term", "fold")


def _voting_sql(weights: str) -> str:
    return f"""
folds AS (SELECT proj_id, node, term, CAST((row_number() OVER (PARTITION BY proj_id ORDER BY node, term) - 1) % 3 AS INT) AS fold FROM members),
w AS ({weights}),
deg AS (SELECT proj_id, dst AS node, round(sum(w), 10) AS degree FROM w GROUP BY ALL),
terms AS (SELECT DISTINCT proj_id, term FROM folds),
three AS (SELECT unnest([0, 1, 2]) AS fold),
votes AS (SELECT w.proj_id, w.dst AS node, f.term, g.fold, sum(CASE WHEN f.fold <> g.fold THEN w ELSE 0 END) AS s FROM w JOIN folds f ON w.src = f.node AND w.proj_id = f.proj_id, three g GROUP BY ALL),
cand AS (SELECT d.proj_id, d.node, t.term, g.fold, degree, o.fold AS own FROM deg d JOIN terms t USING (proj_id) CROSS JOIN three g LEFT JOIN folds o ON o.proj_id = d.proj_id AND o.node = d.node AND o.term = t.term WHERE o.fold IS NULL OR o.fold = g.fold),
sc AS (SELECT c.*, round(coalesce(s, 0) / degree, 10) AS score FROM cand c LEFT JOIN votes v ON v.proj_id = c.proj_id AND v.node = c.node AND v.term = c.term AND v.fold = c.fold),
rk AS (SELECT *, rank() OVER (PARTITION BY proj_id, term, fold ORDER BY score) + (count(*) OVER (PARTITION BY proj_id, term, fold, score) - 1) / 2 AS r FROM sc),
fa AS (SELECT proj_id, term, fold, count(*) FILTER (own IS NOT NULL) AS np, count(*) FILTER (own IS NULL) AS nn, sum(r) FILTER (own IS NOT NULL) AS rs FROM rk GROUP BY ALL),
fb AS (SELECT *, (rs / np - (np + 1) / 2) / nn AS auc FROM fa WHERE np > 0 AND nn > 0),
cv AS (SELECT proj_id, term, avg(auc) AS auc, sum(abs(auc * np * nn - np * nn / 2) / sqrt(np * nn * (np + nn + 1) / 12)) / sqrt(3) AS z FROM fb GROUP BY ALL),
dr AS (SELECT *, rank() OVER (PARTITION BY proj_id ORDER BY degree) + (count(*) OVER (PARTITION BY proj_id, degree) - 1) / 2 AS r, count(*) OVER (PARTITION BY proj_id) AS n FROM deg),
nul AS (SELECT proj_id, term, avg(degree) AS avg_node_degree, (sum(r) / count(*) - (count(*) + 1) / 2) / (any_value(n) - count(*)) AS degree_null_auc FROM folds JOIN dr USING (proj_id, node) GROUP BY proj_id, term)
SELECT proj_id, term, round(auc, 6) AS auc, round(avg_node_degree, 6) AS avg_node_degree, round(degree_null_auc, 6) AS degree_null_auc,
 round(list_sum(list_transform(range(0, 3001), lambda i: (CASE WHEN i = 0 OR i = 3000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * exp(-(z + i * CAST(0.005 AS DOUBLE)) * (z + i * CAST(0.005 AS DOUBLE)) / 2))) * CAST(0.005 AS DOUBLE) / 3 / sqrt(2 * pi()), 6) AS p_value
FROM cv JOIN nul USING (proj_id, term)"""


@query("neighbour_voting", f"WITH {_SIM}, {_TERMS}, {_voting_sql('SELECT proj_id, src, dst, w FROM edges WHERE src <> dst AND w > 0 UNION ALL SELECT proj_id, node, node, 1 FROM vec')}")
def neighbour_voting(t: Tables) -> DataFrame:
    """Neighbour voting on the kNN network."""
    v = b.vectors(t)
    edges = durable(network.symmetric_edges(network.nearest_neighbours(v)))
    nodes = v.select("proj_id", F.col("cell_id").alias("node"))
    return rounded(network.neighbour_voting(edges, nodes, _members(t)), "auc", "avg_node_degree", "degree_null_auc", "p_value")


@query("neighbour_voting_dense", f"WITH {_PAIRS}, {_TERMS}, {_voting_sql('SELECT proj_id, src, dst, 1 - d / max(d) OVER (PARTITION BY proj_id) AS w FROM pairs')}")
def neighbour_voting_dense(t: Tables) -> DataFrame:
    """Neighbour voting on the full distance network."""
    d = network.neighbour_voting_dense(b.vectors(t), _members(t))
    return rounded(d, "auc", "avg_node_degree", "degree_null_auc", "p_value")


@query("corr_minmax", f"""WITH {BASE}, g AS (SELECT proj_id, count(*) AS g FROM genes GROUP BY ALL),
m AS (SELECT proj_id, cell_id, any_value(g) AS g, sum(n) AS s, any_value(g) * sum(n * n) - sum(n) * sum(n) AS v FROM counts JOIN g USING (proj_id) GROUP BY ALL),
dots AS (SELECT a.proj_id, a.cell_id AS x, b.cell_id AS y, sum(a.n * b.n) AS d FROM counts a JOIN counts b USING (proj_id, gene_id) WHERE a.cell_id <> b.cell_id GROUP BY ALL),
r AS (SELECT a.proj_id, a.cell_id, (a.g * coalesce(d, 0) - a.s * b.s) / sqrt(CAST(a.v AS DOUBLE) * CAST(b.v AS DOUBLE)) AS r FROM m a JOIN m b ON a.proj_id = b.proj_id AND a.cell_id <> b.cell_id LEFT JOIN dots ON x = a.cell_id AND y = b.cell_id WHERE a.v > 0 AND b.v > 0)
SELECT m.proj_id, m.cell_id, round(min(r), 6) AS min_corr, round(max(r), 6) AS max_corr FROM m LEFT JOIN r USING (proj_id, cell_id) GROUP BY ALL""")
def corr_minmax(t: Tables) -> DataFrame:
    return rounded(network.correlation_extremes(b.counts(t), b.genes(t)), "min_corr", "max_corr")


@query("pca_svd")
def pca_svd(t: Tables) -> DataFrame:
    """Components of the embeddings read as a cell x gene matrix; the operator is checked against numpy in the tests."""
    values = t.embeddings.select(
        F.concat(F.lit("P"), (F.col("label") % 3).cast("string")).alias("proj_id"), F.col("vec_id").alias("cell_id"), F.posexplode("embedding").alias("gene_id", "x")
    ).withColumn("x", F.col("x").cast("double"))
    scores = network.components(values, k=10)
    return scores.select("proj_id", "cell_id", *[F.get("pc", F.lit(j)).alias(f"pc{j + 1}") for j in range(10)])


_GRAM = """WITH RECURSIVE v AS (SELECT concat('P', label % 3) AS proj_id, vec_id AS cell_id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
long AS (SELECT proj_id, cell_id, unnest(f) AS x, generate_subscripts(f, 1) AS i FROM v),
gram AS (SELECT proj_id, i, list(g ORDER BY j) AS row FROM (SELECT a.proj_id, a.i, b.i AS j, sum(a.x * b.x) AS g FROM long a JOIN long b USING (proj_id, cell_id) GROUP BY ALL) GROUP BY ALL),
g AS (SELECT proj_id, list(row ORDER BY i) AS m, max(i) AS n FROM gram GROUP BY ALL),
p(proj_id, m, steps) AS (
  SELECT proj_id, m, 0 FROM g UNION ALL
  SELECT proj_id, list_transform(m, lambda r: list_transform(m, lambda c: list_dot_product(r, c) / list_max(list_transform(m, lambda q: list_dot_product(q, q))))), steps + 1 FROM p WHERE steps < 16),
raw AS (SELECT p.proj_id, list_transform(p.m, lambda r: list_sum(r)) AS u FROM p WHERE steps = 16),
lead AS (SELECT proj_id, list_transform(u, lambda x: x / sqrt(list_dot_product(u, u)) * (CASE WHEN list_sum(u) < 0 THEN -1 ELSE 1 END)) AS u FROM raw)
"""


@query("leading_component", _GRAM + """SELECT proj_id, cell_id, round(list_dot_product(f, u), 4) AS pc1, round(sqrt(sum(list_dot_product(f, u) ** 2) OVER (PARTITION BY proj_id)), 4) AS s1 FROM v JOIN lead USING (proj_id)""")
def leading_component(t: Tables) -> DataFrame:
    """Score on the first component and its singular value; the SQL squares the Gram matrix until only the leading direction is left."""
    values = t.embeddings.select(
        F.concat(F.lit("P"), (F.col("label") % 3).cast("string")).alias("proj_id"), F.col("vec_id").alias("cell_id"), F.posexplode("embedding").alias("gene_id", "x"))
    scores, singular = network.components_with_basis(values, k=10)
    return rounded(scores.join(singular, "proj_id").select("proj_id", "cell_id", F.get("pc", F.lit(0)).alias("pc1"), F.get("s", F.lit(0)).alias("s1")), "pc1", "s1", digits=4)


@query("component_energy", "SELECT concat('P', label % 3) AS proj_id, vec_id AS cell_id, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 6) AS energy FROM embeddings")
def component_energy(t: Tables) -> DataFrame:
    """With as many components as genes nothing is lost: the squared scores of a cell add up to its squared counts."""
    values = t.embeddings.select(
        F.concat(F.lit("P"), (F.col("label") % 3).cast("string")).alias("proj_id"), F.col("vec_id").alias("cell_id"), F.posexplode("embedding").alias("gene_id", "x")
    ).withColumn("x", F.col("x").cast("double"))
    scores = network.components(values, k=64)
    square = F.aggregate("pc", F.lit(0.0), lambda acc, x: acc + x * x)
    return rounded(scores.select("proj_id", "cell_id", square.alias("energy")), "energy")

"""SQL of the bindings, shared by the oracle statements."""

from cellsurvey.plans.bindings import SET_RULES, SETS, TECHS

BASE = """
proj AS (SELECT n_nationkey, n_name AS nation, r_name AS proj_id FROM nation JOIN region ON n_regionkey = r_regionkey),
cells AS (SELECT proj_id, s_suppkey AS cell_id FROM supplier JOIN proj ON s_nationkey = n_nationkey),
counts AS (SELECT proj_id, cell_id, l_partkey AS gene_id, CAST(sum(l_quantity) AS BIGINT) AS n
           FROM lineitem JOIN cells ON l_suppkey = cell_id GROUP BY ALL),
genes AS (SELECT p.proj_id, p_partkey AS gene_id, p_name AS symbol, p_type AS type_, p_brand AS brand, p_size AS size
          FROM part, (SELECT DISTINCT proj_id FROM cells) p)
"""

_flags = ", ".join(f"({rule}) AS {name}" for name, rule in SET_RULES.items())
FLAGS = BASE + f", flagged AS (SELECT *, {_flags} FROM genes)"

MOMENTS = FLAGS + """,
n_cells AS (SELECT proj_id, count(*) AS n_cells FROM cells GROUP BY ALL),
per_gene AS (SELECT proj_id, gene_id, CAST(sum(n) AS BIGINT) AS s, CAST(sum(n * n) AS BIGINT) AS q, count(*) AS c FROM counts GROUP BY ALL),
moments AS (SELECT f.*, coalesce(s, 0) AS total_counts, coalesce(c, 0) AS n_cells_by_counts, n_cells,
    CAST(coalesce(s, 0) AS DOUBLE) / n_cells AS mean,
    CASE WHEN n_cells > 1 THEN (CAST(coalesce(q, 0) AS DOUBLE) - CAST(coalesce(s, 0) AS DOUBLE) * CAST(coalesce(s, 0) AS DOUBLE) / n_cells) / (n_cells - 1) END AS variance
  FROM flagged f LEFT JOIN per_gene USING (proj_id, gene_id) JOIN n_cells USING (proj_id))
"""

HVG = MOMENTS + """,
logged AS (SELECT *, ln(1 + CASE WHEN mean = 0 THEN CAST(1e-12 AS DOUBLE) ELSE mean END) AS log_mean,
    CASE WHEN variance > 0 THEN ln(variance / CASE WHEN mean = 0 THEN CAST(1e-12 AS DOUBLE) ELSE mean END) END AS log_dispersion FROM moments),
span AS (SELECT proj_id, min(log_mean) AS lo, max(log_mean) AS hi FROM logged GROUP BY ALL),
binned AS (SELECT l.*, CASE WHEN hi = lo THEN 1 ELSE least(greatest(CAST(ceil((log_mean - lo) / (hi - lo) * 20) AS BIGINT), 1), 20) END AS mean_bin
  FROM logged l JOIN span USING (proj_id)),
bin_stats AS (SELECT proj_id, mean_bin, avg(log_dispersion) AS bm, stddev_samp(log_dispersion) AS bs FROM binned GROUP BY ALL),
normed AS (SELECT b.*, CASE WHEN bs IS NULL THEN CASE WHEN log_dispersion IS NOT NULL THEN CAST(1 AS DOUBLE) END
    ELSE CASE WHEN bs <> 0 THEN (log_dispersion - bm) / bs END END AS dispersion_norm FROM binned b JOIN bin_stats USING (proj_id, mean_bin)),
hvg AS (SELECT *, coalesce(log_mean > 0.0125 AND log_mean < 3 AND dispersion_norm > 0.5 AND dispersion_norm < 1e8, false) AS highly_variable FROM normed),
ranked AS (SELECT *, row_number() OVER (PARTITION BY proj_id ORDER BY total_counts DESC, gene_id) AS position FROM hvg),
topped AS (SELECT *, position <= 50 AS top_50_gene, position <= 100 AS top_100_gene, position <= 200 AS top_200_gene, position <= 500 AS top_500_gene FROM ranked)
"""

CELL_TOTALS = BASE + """,
per_cell AS (SELECT proj_id, cell_id, CAST(sum(n) AS BIGINT) AS total, count(*) AS k FROM counts GROUP BY ALL),
totals AS (SELECT c.proj_id, c.cell_id, coalesce(total, 0) AS total_counts, coalesce(k, 0) AS n_genes_by_counts
  FROM cells c LEFT JOIN per_cell USING (proj_id, cell_id))
"""


def auroc_sql(sets, table: str) -> str:
    """Dense statement: every (cell, gene) pair ranked with average ties."""
    cols = ", ".join(
        f"CASE WHEN count(*) FILTER ({s}) BETWEEN 1 AND count(*) - 1 THEN "
        f"round((sum(r) FILTER ({s}) / count(*) FILTER ({s}) - (count(*) FILTER ({s}) + 1) / 2) / (count(*) - count(*) FILTER ({s})), 6) END AS {s}"
        for s in sets
    )
    return f"""
dense AS (SELECT c.proj_id, c.cell_id, g.* EXCLUDE (proj_id), coalesce(n, 0) AS x FROM cells c JOIN {table} g USING (proj_id)
  LEFT JOIN counts USING (proj_id, cell_id, gene_id)),
dense_rank AS (SELECT *, rank() OVER (PARTITION BY proj_id, cell_id ORDER BY x)
   + (count(*) OVER (PARTITION BY proj_id, cell_id, x) - 1) / 2 AS r FROM dense)
SELECT proj_id, cell_id, {cols} FROM dense_rank GROUP BY proj_id, cell_id"""


_case = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TECHS.items())
META = f"""
proj AS (SELECT n_nationkey, n_name AS nation, r_name AS proj_id FROM nation JOIN region ON n_regionkey = r_regionkey),
samples AS (SELECT proj_id, c_custkey AS samp_id, nation AS exp_id, c_mktsegment AS attributes FROM customer JOIN proj ON c_nationkey = n_nationkey),
runs AS (SELECT o_orderkey AS run_id, o_custkey AS samp_id, CASE o_orderpriority {_case} END AS tech, o_orderdate AS publish_date,
   o_totalprice AS price, o_orderstatus AS status, s.proj_id, s.exp_id FROM orders JOIN samples s ON o_custkey = samp_id)
"""

LENGTHS = """
lens AS (SELECT l_orderkey AS run_id, CAST(count(*) AS INT) AS nreads,
  list(CAST(l_quantity AS INT) ORDER BY l_linenumber, CAST(l_quantity AS INT), l_partkey) AS read_lengths FROM lineitem GROUP BY ALL)
"""

"""Queries that write landed files from the tables and read them with the engine's readers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsurvey.functions import fixed_values as fixed
from cellsurvey.functions.frames import spread
from cellsurvey.functions.ranking import number_rows
from cellsurvey.operators import cellqc, metadata
from cellsurvey.plans import bindings as b
from cellsurvey.plans.bindings import Tables
from cellsurvey.plans.oracle_views import META
from cellsurvey.plans.registry import query
from cellsurvey.session import scratch_path
from cellsurvey.sources import matrix, packages, reads, sinks, tables


_TSV = {"sep": "\t", "header": True, "quote": '"', "escape": '"'}


def _packages(t: Tables) -> DataFrame:
    """Orders as experiment packages of the project of their customer, written as archive XML and read back."""
    path = scratch_path(t.spark, "packages")
    key = F.col("run_id").cast("string")
    ids = lambda text, *ext: F.struct(text.alias("PRIMARY_ID"), F.array(*ext).alias("EXTERNAL_ID"))
    ext = lambda ns, text: F.struct(text.alias("_VALUE"), F.lit(ns).alias("_namespace"))
    exp, samp = F.concat(F.lit("X"), key), F.concat(F.lit("S"), F.col("samp_id").cast("string"))
    run = F.struct(
        key.alias("_accession"), F.lit(7).alias("_total_spots"), F.when(F.col("status") == "P", "true").alias("_unavailable"),
        F.date_format("publish_date", "yyyy-MM-dd HH:mm:ss").alias("_published"), ids(key, ext("n", key)).alias("IDENTIFIERS"), F.struct(exp.alias("_accession")).alias("EXPERIMENT_REF"),
        F.struct(F.array(F.struct(samp.alias("_accession"), F.lit(10090).alias("_tax_id"), F.lit("Mus musculus").alias("_organism"))).alias("Member")).alias("Pool"),
        F.struct(F.array(
            F.struct(F.lit("x.gz").alias("_filename"), F.lit("u").alias("_url"), F.lit(1).alias("_size"), F.array(F.struct(F.lit("v").alias("_url"))).alias("Alternatives")),
            F.struct(key.alias("_filename"), F.concat(F.lit("https://h/"), key).alias("_url"), F.col("run_id").alias("_size"), F.array(
                F.struct(F.concat(F.when(F.col("tech") == "smartseq", "https://a.amazonaws.com/").otherwise("gs://b/"), key).alias("_url")),
                F.struct(F.concat(F.lit("gs://c/"), key).alias("_url"))).alias("Alternatives")),
        ).alias("SRAFile")).alias("SRAFiles"),
        F.struct(F.lit("2").alias("_nreads")).alias("Statistics"),
        F.struct(F.array(F.struct(F.lit("A").alias("_value"), F.lit(3).alias("_count"))).alias("Base")).alias("Bases"),
    )
    rows = b.runs(t).withColumn("proj_id", F.concat(F.lit("P"), F.col("samp_id").cast("string"))).select(
        F.struct(exp.alias("_accession"), ids(exp, ext("GEO", exp)).alias("IDENTIFIERS"), F.struct(F.col("proj_id").alias("_accession")).alias("STUDY_REF"),
                 F.struct(F.struct(samp.alias("_accession")).alias("SAMPLE_DESCRIPTOR"), F.struct(F.col("status").alias("LIBRARY_STRATEGY"), F.col("tech").alias("LIBRARY_CONSTRUCTION_PROTOCOL")).alias("LIBRARY_DESCRIPTOR")).alias("DESIGN")).alias("EXPERIMENT"),
        F.struct(F.lit("A1").alias("_accession")).alias("SUBMISSION"),
        F.struct(ids(F.col("proj_id"), ext("GEO", F.col("proj_id"))).alias("IDENTIFIERS"), F.struct(F.lit("title").alias("STUDY_TITLE"), F.lit("text").alias("STUDY_ABSTRACT")).alias("DESCRIPTOR")).alias("STUDY"),
        F.struct(ids(samp, ext("GEO", samp)).alias("IDENTIFIERS"), F.struct(F.lit("10090").alias("TAXON_ID"), F.lit("Mus musculus").alias("SCIENTIFIC_NAME")).alias("SAMPLE_NAME"),
                 F.struct(F.array(F.struct(F.lit("nation").alias("TAG"), F.lit("old").alias("VALUE")), F.struct(F.lit("nation").alias("TAG"), F.col("exp_id").alias("VALUE"))).alias("SAMPLE_ATTRIBUTE")).alias("SAMPLE_ATTRIBUTES")).alias("SAMPLE"),
        F.struct(F.array(run).alias("RUN")).alias("RUN_SET"),
    )
    sinks.write_packages(rows, path)
    return packages.read_packages(t.spark, path)


@query("xml_runs", f"""WITH {META} SELECT CAST(run_id AS VARCHAR) AS run_id, concat('X', run_id) AS exp_id, concat('S', samp_id) AS samp_id, concat('P', samp_id) AS proj_id, 7::BIGINT AS tot_spots, 2::INT AS nreads, strftime(publish_date, '%Y-%m-%d') AS published,
 CASE WHEN tech = 'smartseq' THEN concat('https://a.amazonaws.com/', run_id) ELSE concat('https://h/', run_id) END AS file_url, run_id AS file_size FROM runs WHERE samp_id NOT IN (SELECT samp_id FROM runs WHERE status = 'P')""")
def xml_runs(t: Tables) -> DataFrame:
    runs = packages.runs(packages.available(_packages(t)))
    return runs.select("run_id", "exp_id", "samp_id", "proj_id", "tot_spots", "nreads", F.date_format("publish_date", "yyyy-MM-dd").alias("published"), "file_url", "file_size")


@query("xml_samples", f"WITH {META} SELECT DISTINCT concat('S', samp_id) AS samp_id, 10090::INT AS taxon, concat('S', samp_id) AS title, exp_id AS nation, concat('P', samp_id) AS proj_id FROM runs")
def xml_samples(t: Tables) -> DataFrame:
    """Without a title the sample id stands in; of a repeated attribute the last value counts."""
    return packages.samples(_packages(t)).select("samp_id", "taxon", "title", F.col("attributes")["nation"].alias("nation"), "proj_id")


@query("xml_experiments", f"WITH {META} SELECT concat('X', run_id) AS exp_id, status AS strategy, '' AS source, tech AS lcp, concat('S', samp_id) AS samp_id, concat('P', samp_id) AS proj_id FROM runs")
def xml_experiments(t: Tables) -> DataFrame:
    return packages.experiments(_packages(t)).select("exp_id", "strategy", "source", "lcp", "samp_id", "proj_id")


@query("xml_projects", f"WITH {META} SELECT DISTINCT concat('P', samp_id) AS proj_id, concat('P', samp_id) AS geo, 'title' AS title FROM runs WHERE samp_id NOT IN (SELECT samp_id FROM runs WHERE status = 'P')")
def xml_projects(t: Tables) -> DataFrame:
    rows = packages.projects(packages.available(_packages(t)))
    return rows.select("proj_id", F.col("ext_ids")["GEO"].alias("geo"), "title")


@query("xml_quarantine", f"WITH {META} SELECT concat('X', run_id) AS exp_id, concat('P', samp_id) AS proj_id, CAST(run_id AS VARCHAR) AS run_id FROM runs WHERE status = 'P'")
def xml_quarantine(t: Tables) -> DataFrame:
    return packages.quarantined(_packages(t))


@query("xml_pairs", f"WITH {META} SELECT DISTINCT concat('X', run_id) AS exp_id, concat('P', samp_id) AS proj_id FROM runs")
def xml_pairs(t: Tables) -> DataFrame:
    return packages.experiment_projects(_packages(t))


@query("metadata_scan", """SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderkey * 3 AS tot_spots, CASE WHEN o_orderstatus = 'F' THEN 2::INT END AS nreads, strftime(o_orderdate, '%Y-%m-%d') AS published, '' AS file_url, concat('a "', o_orderpriority, '"', chr(9), 'b', chr(10), 'c') AS organism FROM orders""")
def metadata_scan(t: Tables) -> DataFrame:
    """Runs written as tab-separated text with a row number, quotes, tabs and line feeds, read with types.

    The columns are written in another order than they are asked for.
    """
    path = scratch_path(t.spark, "runs-tsv")
    text = {c: F.lit(None).cast("string") for c in fixed.RUN_COLUMNS}
    text |= {"run_id": F.col("o_orderkey").cast("string"), "tot_spots": (F.col("o_orderkey") * 3).cast("string"), "nreads": F.when(F.col("o_orderstatus") == "F", "2").otherwise("x"),
             "publish_date": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), "organism": F.concat(F.lit('a "'), "o_orderpriority", F.lit('"\tb\nc'))}
    t.orders.select(F.lit("0").alias("row"), *[text[c].alias(c) for c in reversed(fixed.RUN_COLUMNS)]).write.options(**_TSV).csv(path)
    runs = tables.read_metadata(t.spark, path, fixed.RUN_COLUMNS)
    return runs.select("run_id", "tot_spots", "nreads", F.date_format("publish_date", "yyyy-MM-dd").alias("published"), "file_url", "organism")


@query("id_list_scan", "SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderstatus <> 'P'")
def id_list_scan(t: Tables) -> DataFrame:
    """Ids with trailing comments; the lines of one status are whole comments."""
    path = scratch_path(t.spark, "ids")
    key = F.col("o_orderkey").cast("string")
    t.orders.select(F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("# "), key)).otherwise(F.concat(F.lit(" "), key, F.lit("  # "), F.col("o_orderpriority")))).write.text(path)
    return tables.read_id_list(t.spark, path)


@query("id_list_sink", "SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS id FROM lineitem")
def id_list_sink(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "ids")
    sinks.write_id_list(t.lineitem.select(F.col("l_orderkey").cast("string").alias("id")), path)
    return tables.read_id_list(t.spark, path)


@query("pair_scan", "SELECT concat('X', o_orderkey) AS exp_id, concat('P', o_custkey) AS proj_id FROM orders")
def pair_scan(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "pairs")
    t.orders.select(F.concat(F.lit("X"), F.col("o_orderkey").cast("string"), F.lit("  P"), F.col("o_custkey").cast("string"))).write.text(path)
    return tables.read_pairs(t.spark, path)


@query("run_info_scan", "SELECT DISTINCT concat('R', o_orderkey) AS run_id, concat('X', o_custkey) AS exp_id FROM orders")
def run_info_scan(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "runinfo")
    t.orders.select(F.concat(F.lit("R"), F.col("o_orderkey").cast("string")).alias("Run"), F.concat(F.lit("X"), F.col("o_custkey").cast("string")).alias("Experiment"), "o_totalprice").write.option("header", True).csv(path)
    return tables.read_run_info(t.spark, path)


@query("search_page_scan", "SELECT CAST(l_partkey AS VARCHAR) AS uid FROM lineitem UNION SELECT CAST(l_suppkey AS VARCHAR) FROM lineitem")
def search_page_scan(t: Tables) -> DataFrame:
    """One result page per line item, with its part and supplier as found ids."""
    path = scratch_path(t.spark, "search")
    found = F.array(F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    t.lineitem.select(F.struct(F.lit("0").alias("retstart"), found.alias("idlist")).alias("esearchresult")).write.json(path)
    return tables.read_search_pages(t.spark, path, multi_line=False)


@query("gene_set_scan", "SELECT 'female' AS set_name, p_name AS symbol FROM part WHERE p_brand = 'Brand#1' UNION SELECT 'male', p_name FROM part WHERE p_brand = 'Brand#2'")
def gene_set_scan(t: Tables) -> DataFrame:
    paths = {}
    for name, brand in (("female", "Brand#1"), ("male", "Brand#2")):
        paths[name] = scratch_path(t.spark, name)
        t.part.filter(F.col("p_brand") == brand).select(F.col("p_name").alias("gene")).write.option("header", True).csv(paths[name])
    return matrix.read_gene_sets(t.spark, paths)


@query("results_by_project", f"WITH {META} SELECT run_id, tech FROM runs WHERE proj_id = 'ASIA'")
def results_by_project(t: Tables) -> DataFrame:
    """Results written by project; a filter on the project prunes folders."""
    root = scratch_path(t.spark, "results")
    sinks.write_results({"runs": b.runs(t).select("proj_id", "run_id", "tech")}, root)
    return metadata.of_projects(sinks.read_results(t.spark, root, "runs"), "ASIA").select("run_id", "tech")


@query("append_by_project", f"WITH {META} SELECT proj_id, count(*) * 2 AS n FROM runs GROUP BY proj_id")
def append_by_project(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "appended")
    rows = b.runs(t).select("proj_id", "run_id")
    sinks.append_by_project(rows, path)
    sinks.append_by_project(rows, path)
    return t.spark.read.parquet(path).groupBy("proj_id").agg(F.count(F.lit(1)).alias("n"))


@query("merged_table", "SELECT DISTINCT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE '' END AS note FROM orders")
def merged_table(t: Tables) -> DataFrame:
    """Open orders merged with finished ones that carry one more column."""
    path = scratch_path(t.spark, "merged")
    old = t.orders.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_orderstatus")
    new = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus", F.col("o_orderpriority").alias("note"))
    sinks.write_merged(old, new.unionByName(new), path)
    return t.spark.read.parquet(path)


@query("archive_manifest_scan", "SELECT DISTINCT concat('f', o_orderkey) AS file_id, CAST(o_custkey AS VARCHAR) AS sample_id FROM orders WHERE o_orderstatus <> 'P'")
def archive_manifest_scan(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "manifest")
    key = F.concat(F.lit("f"), F.col("o_orderkey").cast("string"))
    t.orders.select(key.alias("file_id"), F.when(F.col("o_orderstatus") != "P", F.md5(key.cast("binary"))).alias("md5"), F.lit("1").alias("size"), F.lit("u,v").alias("urls"), F.col("o_custkey").alias("sample_id")) \
        .write.option("sep", "\t").option("header", True).csv(path)
    return tables.read_archive_manifest(t.spark, path).select("file_id", "sample_id")


# ---------------------------------------------------------------- aligner results as files

def _by_result(lines: DataFrame, path: str) -> None:
    """Text lines (result, ord, value): one file per result, in order."""
    (lines.repartition("result").sortWithinPartitions("result", "ord").select("result", "value")
     .write.partitionBy("result").text(path))


def _result(nation: str) -> F.Column:
    return F.concat(F.lit("SRR"), F.col(nation).cast("string"), F.lit("_10xv2_Solo.out"))


def _matrices(t: Tables) -> dict[str, DataFrame]:
    """A matrix per nation: its suppliers as cells, the parts whose size is not its number as genes."""
    root = scratch_path(t.spark, "solo")
    listed = spread(t.part.select(F.col("p_partkey").alias("gene"), F.col("p_size").alias("size")), t.supplier.select("s_nationkey"), "s_nationkey")
    features = number_rows(listed.filter(F.col("size") != F.col("s_nationkey")), ["s_nationkey"], ["gene"], "g")
    barcodes = number_rows(t.supplier.select("s_nationkey", F.col("s_suppkey").alias("cell")), ["s_nationkey"], ["cell"], "c")
    counts = t.lineitem.groupBy(F.col("l_suppkey").alias("cell"), F.col("l_partkey").alias("gene")).agg(F.sum("l_quantity").cast("bigint").alias("n"))
    entries = counts.join(barcodes, "cell").join(features, ["s_nationkey", "gene"])
    line = lambda nation, ord_, *parts: [_result(nation).alias("result"), ord_.alias("ord"), F.concat_ws(" ", *parts).alias("value")]
    key = F.struct(F.lit(2).alias("k"), F.col("c"), F.col("g"))
    head = lambda k: F.struct(F.lit(k).alias("k"), F.lit(0).cast("bigint").alias("c"), F.lit(0).cast("bigint").alias("g"))
    sizes = entries.groupBy("s_nationkey").agg(F.max("g").alias("g"), F.max("c").alias("c"), F.count(F.lit(1)).alias("n"))
    _by_result(
        entries.select(*line("s_nationkey", key, "g", "c", "n"))
        .union(sizes.select(*line("s_nationkey", head(0), F.lit("%%MatrixMarket matrix coordinate integer general"))))
        .union(sizes.select(*line("s_nationkey", head(1), "g", "c", "n"))), f"{root}/matrix.mtx")
    gene = F.col("gene").cast("string")
    _by_result(features.select(_result("s_nationkey").alias("result"), F.col("g").alias("ord"), F.concat_ws("\t", gene, F.concat(F.lit("s"), gene), F.lit("Gene Expression")).alias("value")), f"{root}/features.tsv")
    _by_result(barcodes.select(_result("s_nationkey").alias("result"), F.col("c").alias("ord"), F.col("cell").cast("string").alias("value")), f"{root}/barcodes.tsv")
    return matrix.read_matrices(t.spark, root)


_SOLO = "lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey WHERE p_size <> s_nationkey"


@query("matrix_counts", f"""SELECT concat('SRR', s_nationkey, '_10xv2_Solo.out') AS dir, CAST(l_partkey AS VARCHAR) AS gene_id, CAST(l_suppkey AS VARCHAR) AS cell_id, CAST(sum(l_quantity) AS BIGINT) AS n
FROM {_SOLO} GROUP BY ALL""")
def matrix_counts(t: Tables) -> DataFrame:
    return _matrices(t)["counts"]


@query("project_counts", f"""SELECT 'P' AS proj_id, concat('SRR', s_nationkey) AS batch, '10xv2' AS tech, concat('SRR', s_nationkey) AS run_id, concat(l_suppkey, '-SRR', s_nationkey) AS cell_id,
CAST(l_partkey AS VARCHAR) AS gene_id, CAST(sum(l_quantity) AS BIGINT) AS n FROM {_SOLO} AND p_size NOT IN (SELECT s_nationkey FROM supplier) GROUP BY ALL""")
def project_counts(t: Tables) -> DataFrame:
    """The matrices of all nations as runs of one project, for the genes that every run lists."""
    return matrix.project_counts(_matrices(t), F.lit("P"))


@query("aligner_stats", """WITH l AS (SELECT concat('SRR', s_nationkey, '_10xv2') AS accession, l_quantity, l_returnflag FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
SELECT 'nExactMatch' AS stat, CAST(count(*) AS VARCHAR) AS value, 'barcode' AS stat_source, accession FROM l GROUP BY accession
UNION ALL SELECT 'nUnmapped', CAST(count(*) FILTER (l_returnflag = 'R') AS VARCHAR), 'feature', accession FROM l GROUP BY accession
UNION ALL SELECT 'Number of Reads', CAST(CAST(sum(l_quantity) AS BIGINT) AS VARCHAR), 'summary', accession FROM l GROUP BY accession""")
def aligner_stats(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "solo-stats")
    per = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("all"), F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("r"), F.sum("l_quantity").cast("bigint").alias("q"))
    for name, text in (("Barcodes.stats", F.concat(F.lit("   nExactMatch    "), F.col("all").cast("string"))), ("Gene/Features.stats", F.concat(F.lit("  nUnmapped  "), F.col("r").cast("string"))),
                       ("Gene/Summary.csv", F.concat(F.lit("Number of Reads,"), F.col("q").cast("string")))):
        _by_result(per.select(_result("s_nationkey").alias("result"), F.lit(0).alias("ord"), text.alias("value")), f"{root}/{name}")
    return matrix.read_aligner_stats(t.spark, root)


# ---------------------------------------------------------------- gene annotation, sets and markers as files

@query("gene_annotation", """SELECT CAST(p_partkey AS VARCHAR) AS gene_id, CASE WHEN p_brand = 'Brand#1' THEN concat('mt-', p_name) ELSE p_name END AS symbol, CASE WHEN p_type = 'ECONOMY' THEN 'rRNA' ELSE p_type END AS type_,
p_brand = 'Brand#1' AS mt, p_type = 'ECONOMY' AS ribo FROM part""")
def gene_annotation(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "gene-info")
    gene, symbol = F.col("p_partkey").cast("string"), F.when(F.col("p_brand") == "Brand#1", F.concat(F.lit("mt-"), "p_name")).otherwise(F.col("p_name"))
    kind = F.when(F.col("p_type") == "ECONOMY", "rRNA").otherwise(F.col("p_type"))
    t.part.agg(F.count(F.lit(1)).cast("string").alias("value")).union(t.part.select(F.concat_ws("\t", gene, symbol, kind))).write.text(path)
    genes = t.part.select(gene.alias("gene_id"), symbol.alias("symbol"))
    return cellqc.annotated_genes(genes, matrix.read_gene_annotation(t.spark, path)).select("gene_id", "symbol", "type_", "mt", "ribo")


_CLUSTERS = [f"cc_cluster_{i}" for i in (6, 7)]


@query("gene_set_flags", """WITH s AS (SELECT p_name, bool_or(p_brand = 'Brand#1') AS female, bool_or(p_brand = 'Brand#2') AS male, bool_or(p_brand IN ('Brand#6', 'Brand#7')) AS cell_cycle,
bool_or(p_brand = 'Brand#6') AS cc_cluster_6, bool_or(p_brand = 'Brand#7') AS cc_cluster_7 FROM part GROUP BY p_name)
SELECT p_partkey AS gene_id, p_name AS symbol, female, male, cell_cycle, cc_cluster_6, cc_cluster_7 FROM part JOIN s USING (p_name)""")
def gene_set_flags(t: Tables) -> DataFrame:
    """Sets and cell-cycle clusters read from files flag the gene list by symbol."""
    paths = {}
    for name, brand in (("female", "Brand#1"), ("male", "Brand#2")):
        paths[name] = scratch_path(t.spark, name)
        t.part.filter(F.col("p_brand") == brand).select(F.col("p_name").alias("gene")).write.option("header", True).csv(paths[name])
    cycle = scratch_path(t.spark, "cell-cycle")
    t.part.filter(F.col("p_brand").isin("Brand#6", "Brand#7")).select(F.substring("p_brand", 7, 2).alias("cluster"), F.col("p_name").alias("gene")).write.option("header", True).csv(cycle)
    sets = matrix.read_gene_sets(t.spark, paths).unionByName(matrix.read_cell_cycle(t.spark, cycle))
    genes = t.part.select(F.col("p_partkey").alias("gene_id"), F.col("p_name").alias("symbol"))
    names = ["female", "male", "cell_cycle", *_CLUSTERS]
    return cellqc.gene_flags(genes, sets, names).select("gene_id", "symbol", *names)


@query("marker_set_scan", """SELECT p_type AS cell_type, 'all' AS "group", CAST(p_partkey AS VARCHAR) AS gene_id, CAST(i AS INT) AS rank FROM (
SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) AS i FROM part) WHERE i <= 100""")
def marker_set_scan(t: Tables) -> DataFrame:
    """Marker sets written gzipped, read up to the last rank in use."""
    path = scratch_path(t.spark, "markers")
    b.class_markers(t).write.options(header=True, compression="gzip").csv(path)
    return matrix.read_markers(t.spark, path).select("cell_type", "group", "gene_id", "rank")


# ---------------------------------------------------------------- reads, manifests, pages, tables

@query("fastq_lengths", """WITH r AS (SELECT concat('SRR', s_nationkey) AS run_id, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS n, CAST(l_quantity AS INT) AS q,
 row_number() OVER (PARTITION BY s_nationkey, l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) AS i FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
SELECT run_id, CAST(count(*) AS INT) AS nreads, string_agg(CAST(q AS VARCHAR), ',' ORDER BY n) AS read_lengths FROM r WHERE i = 1 GROUP BY run_id""")
def fastq_lengths(t: Tables) -> DataFrame:
    """All lines written as reads, a FASTQ file per nation and flag."""
    path = scratch_path(t.spark, "fastq")
    n = F.when(F.col("l_returnflag") == "A", "1").when(F.col("l_returnflag") == "N", "2").otherwise("3")
    size = F.col("l_quantity").cast("int")
    rows = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.concat(F.lit("SRR"), F.col("s_nationkey").cast("string"), F.lit("_"), n, F.lit(".fastq")).alias("result"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("ord"),
        F.concat(F.lit("@r"), F.col("l_orderkey").cast("string"), F.lit("\n"), F.repeat(F.lit("A"), size), F.lit("\n+\n"), F.repeat(F.lit("@"), size)).alias("value"))
    _by_result(rows, path)
    found = reads.run_read_lengths(t.spark, path)
    return found.select("run_id", "nreads", F.array_join(F.col("read_lengths").cast("array<string>"), ",").alias("read_lengths"))


_READS = """r AS (SELECT concat('SRR', s_nationkey) AS run_id, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS n, CAST(l_quantity AS INT) AS q,
 row_number() OVER (PARTITION BY s_nationkey, l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) AS i FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""


def _archives(t: Tables) -> str:
    """All lines written as reads, a tar archive per nation with a gzipped FASTQ member per flag."""
    path = scratch_path(t.spark, "archives")
    n = F.when(F.col("l_returnflag") == "A", "1").when(F.col("l_returnflag") == "N", "2").otherwise("3")
    run, size = F.concat(F.lit("SRR"), F.col("s_nationkey").cast("string")), F.col("l_quantity").cast("int")
    sinks.write_archives(t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.concat(run, F.lit(".fastq.tar")).alias("archive"), F.concat(run, F.lit("_"), n, F.lit(".fastq.gz")).alias("member"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("ord"),
        F.concat(F.lit("@r"), F.col("l_orderkey").cast("string"), F.lit("\n"), F.repeat(F.lit("A"), size), F.lit("\n+\n"), F.repeat(F.lit("@"), size)).alias("value")), path)
    return f"{path}/*.tar"


@query("archive_fastq_lengths", f"""WITH {_READS}
SELECT run_id, CAST(count(*) AS INT) AS nreads, string_agg(CAST(q AS VARCHAR), ',' ORDER BY n) AS read_lengths FROM r WHERE i = 1 GROUP BY run_id""")
def archive_fastq_lengths(t: Tables) -> DataFrame:
    """Read lengths out of archives."""
    found = reads.archive_read_lengths(t.spark, _archives(t))
    return found.select("run_id", "nreads", F.array_join(F.col("read_lengths").cast("array<string>"), ",").alias("read_lengths"))


@query("archive_read_roles", f"""WITH {_READS}
SELECT concat(run_id, '.fastq.tar') AS archive, max(concat(run_id, '_', n, '.fastq.gz')) FILTER (q BETWEEN 24 AND 28) AS tech_read,
 max(concat(run_id, '_', n, '.fastq.gz')) FILTER (q > 30) AS bio_read FROM r WHERE i = 1 GROUP BY run_id""")
def archive_read_roles(t: Tables) -> DataFrame:
    """Which member of an archive holds barcodes and which the sequence."""
    return reads.paired_members(reads.archive_members(t.spark, _archives(t))).select(F.regexp_extract("archive", "([^/]+)$", 1).alias("archive"), "tech_read", "bio_read")


_NOTE = """concat('"', o_orderpriority, '"', chr(9), chr(10), 'x')"""


@query("download_manifest_scan", f"""SELECT concat('f', o_orderkey) AS file_id, md5(CAST(o_orderkey AS VARCHAR)) AS md5, '1' AS size, {_NOTE} AS urls, CAST(o_custkey AS VARCHAR) AS sample_id FROM orders""")
def download_manifest_scan(t: Tables) -> DataFrame:
    """Two manifests with their own order of columns, joined, written for the client and read back."""
    key, note = F.col("o_orderkey").cast("string"), F.concat(F.lit('"'), "o_orderpriority", F.lit('"\t\nx'))
    rows = t.orders.select(
        F.concat(F.lit("f"), key).alias("file_id"), F.md5(key.cast("binary")).alias("md5"), F.lit("1").alias("size"), note.alias("urls"),
        F.col("o_custkey").cast("string").alias("sample_id"), "o_orderstatus")
    paths = [scratch_path(t.spark, "manifest") for _ in range(3)]
    rows.filter("o_orderstatus = 'F'").write.options(**_TSV).csv(paths[0])
    rows.filter("o_orderstatus <> 'F'").select(*reversed(rows.columns)).write.options(**_TSV).csv(paths[1])
    sinks.write_download_manifest(tables.download_manifest(t.spark, paths[:2]), paths[2])
    return tables.download_manifest(t.spark, paths[2:])


@query("spreadsheet_scan", f"""SELECT {_NOTE} AS location FROM orders WHERE o_orderstatus <> 'P'""")
def spreadsheet_scan(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "sheet")
    place = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit('"'), "o_orderpriority", F.lit('"\t\nx')))
    t.orders.select(F.lit("m").alias("Organism"), place.alias("Data location")).write.options(**_TSV).csv(path)
    return tables.spreadsheet_locations(tables.read_spreadsheet(t.spark, path)).select(F.col("Data location").alias("location"))


@query("histogram_sink", "SELECT o_orderpriority AS stat, CAST(count(*) AS VARCHAR) AS height FROM orders GROUP BY o_orderpriority")
def histogram_sink(t: Tables) -> DataFrame:
    """Heights written as tab-separated text."""
    path = scratch_path(t.spark, "histogram")
    sinks.write_histograms(t.orders.groupBy(F.col("o_orderpriority").alias("stat")).agg(F.count(F.lit(1)).alias("height")), path, text=True)
    return t.spark.read.csv(path, sep="\t", header=True)


@query("dataset_sink", f"WITH {META} SELECT proj_id, count(*) AS n_runs FROM runs GROUP BY proj_id")
def dataset_sink(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "datasets")
    sinks.write_dataset_files(b.runs(t).groupBy("proj_id").agg(F.count(F.lit(1)).alias("n_runs")), path)
    return t.spark.read.parquet(path)

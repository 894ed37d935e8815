"""Views that bind the engine's tables to the driver's star-schema tables.

Suppliers act as cells, parts as genes, regions as projects; orders act as runs and customers as
samples. Everything is derived from whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellsurvey.functions.frames import spread


class Tables:
    """The driver's tables of one scale; one DataFrame per table, so equal shuffles can be reused."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        self.__dict__[name] = df
        return df


def projects(t: Tables) -> DataFrame:
    """(n_nationkey, nation, proj_id): the project a nation belongs to."""
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("n_name").alias("nation"), F.col("r_name").alias("proj_id")
    )


def cells(t: Tables) -> DataFrame:
    return t.supplier.join(projects(t), F.col("s_nationkey") == F.col("n_nationkey")).select(
        "proj_id", F.col("s_suppkey").alias("cell_id")
    )


def counts(t: Tables) -> DataFrame:
    """Reads per (cell, gene). Merged on the fact table first, the project joined after."""
    merged = t.lineitem.groupBy(F.col("l_suppkey").alias("cell_id"), F.col("l_partkey").alias("gene_id")).agg(
        F.sum("l_quantity").cast("bigint").alias("n")
    )
    return merged.filter(F.col("n") > 0).join(cells(t), "cell_id").select("proj_id", "cell_id", "gene_id", "n")


def genes(t: Tables) -> DataFrame:
    """The gene list of every project that has cells."""
    listed = t.part.select(
        F.col("p_partkey").alias("gene_id"), F.col("p_name").alias("symbol"),
        F.col("p_type").alias("type_"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"),
    )
    return spread(listed, cells(t), "proj_id")


# gene sets of the binding: name -> condition on the gene columns
SET_RULES = {
    "mt": "symbol LIKE 'red %'",
    "ribo": "type_ = 'ECONOMY'",
    "female": "brand = 'Brand#1'",
    "male": "brand = 'Brand#2'",
    "essential": "brand IN ('Brand#3', 'Brand#4', 'Brand#5')",
    "cell_cycle": "brand IN ('Brand#6', 'Brand#7')",
    "housekeeping": "brand = 'Brand#8'",
}
SETS = list(SET_RULES)
ALL_SETS = SETS + ["highly_variable"] + [f"top_{k}_gene" for k in (50, 100, 200, 500)]


def flagged_genes(t: Tables) -> DataFrame:
    """Genes with one boolean column per gene set."""
    return genes(t).select("*", *[F.expr(rule).alias(name) for name, rule in SET_RULES.items()])


def cluster_sets() -> list[str]:
    return [f"cc_cluster_{i}" for i in range(1, 9)]


def clustered_genes(t: Tables) -> DataFrame:
    """Eight cell-cycle clusters: brands 1-8."""
    return genes(t).select(
        "*", *[(F.col("brand") == f"Brand#{i}").alias(f"cc_cluster_{i}") for i in range(1, 9)]
    )


def markers(t: Tables) -> DataFrame:
    """(cell_type, group, gene_id, rank): subclasses within the class given by the part type."""
    from cellsurvey.functions.ranking import number_rows

    typed = t.part.select(
        F.concat("p_type", F.lit("/"), (F.col("p_size") % 3).cast("string")).alias("cell_type"),
        F.col("p_type").alias("group"), F.col("p_partkey").alias("gene_id"), F.col("p_retailprice").alias("price"),
    )
    return number_rows(typed, ["cell_type"], [F.desc("price"), "gene_id"], "rank").drop("price")


def class_markers(t: Tables) -> DataFrame:
    from cellsurvey.functions.ranking import number_rows

    typed = t.part.select(
        F.col("p_type").alias("cell_type"), F.lit("all").alias("group"), F.col("p_partkey").alias("gene_id"),
        F.col("p_retailprice").alias("price"),
    )
    return number_rows(typed, ["cell_type"], [F.desc("price"), "gene_id"], "rank").drop("price")


def cell_labels(t: Tables) -> DataFrame:
    """(proj_id, cell_id, group, cell_type): labelled cells for marker discovery."""
    return cells(t).select(
        "proj_id", "cell_id", F.lit("all").alias("group"),
        F.concat(F.lit("t"), (F.col("cell_id") % 3).cast("string")).alias("cell_type"),
    )


# ---------------------------------------------------------------- metadata tables

TECHS = {"1-URGENT": "smartseq", "2-HIGH": "10xv1", "3-MEDIUM": "10xv2", "4-NOT SPECIFIED": "10xv3", "5-LOW": "dropseq"}


def technology() -> F.Column:
    pairs = [F.lit(x) for kv in TECHS.items() for x in kv]
    return F.element_at(F.create_map(*pairs), F.col("o_orderpriority"))


def samples(t: Tables) -> DataFrame:
    """Customers as samples, attribute bag from the market segment."""
    return t.customer.join(projects(t), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "proj_id", F.col("c_custkey").alias("samp_id"), F.col("nation").alias("exp_id"),
        F.col("c_mktsegment").alias("attributes"),
    )


def runs(t: Tables) -> DataFrame:
    """Orders as runs of the sample that placed them."""
    s = samples(t).select("proj_id", "samp_id", "exp_id")
    orders = t.orders.select(
        F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("samp_id"), technology().alias("tech"),
        F.col("o_orderdate").alias("publish_date"), F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("status"),
    )
    return orders.join(s, "samp_id")


def reads(t: Tables) -> DataFrame:
    """(run_id, position, length): lines of an order as its reads."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("position"), F.col("l_quantity").cast("int").alias("length")
    )


def read_lengths(t: Tables) -> DataFrame:
    """(run_id, nreads, read_lengths): the lengths of all reads of a run in order of position, length and part.

    The list of a run is its result row; it holds what the run holds.
    """
    entry = F.struct("position", "length", "part")
    listed = t.lineitem.select(
        F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("position"),
        F.col("l_quantity").cast("int").alias("length"), F.col("l_partkey").alias("part"),
    ).groupBy("run_id").agg(F.sort_array(F.collect_list(entry)).alias("reads"))
    return listed.select("run_id", F.col("reads.length").alias("read_lengths"), F.size("reads").alias("nreads"))


def lanes(t: Tables) -> DataFrame:
    """Lines as lanes of a run: the line number is the lane digit."""
    key = F.col("l_orderkey").cast("string")
    lane = F.concat(key, F.lit("_L00"), F.col("l_linenumber").cast("string"))
    return t.lineitem.select(
        lane.alias("run_id"), F.when(F.col("l_returnflag") == "A", "10xv2").otherwise("10xv3").alias("tech_version"),
        F.concat(lane, F.lit("_1.fastq")).alias("read1"),
        F.when(F.col("l_quantity") < 5, "-").otherwise(F.concat(lane, F.lit("_2.fastq"))).alias("read2"),
    )


# ---------------------------------------------------------------- embeddings as enrichment and network

def vectors(t: Tables) -> DataFrame:
    """Cells with 64-dimensional vectors; labels split them into three projects."""
    return t.embeddings.select(
        F.concat(F.lit("P"), (F.col("label") % 3).cast("string")).alias("proj_id"), F.col("vec_id").alias("cell_id"),
        F.col("embedding").cast("array<double>").alias("features"), F.col("label"),
    )


def enrichment(t: Tables) -> DataFrame:
    """(proj_id, cell_id, cell_type, value): vector entries as enrichment of 64 types; labels split the projects."""
    return t.embeddings.select(
        F.concat(F.lit("P"), (F.col("label") % 3).cast("string")).alias("proj_id"), F.col("vec_id").alias("cell_id"),
        F.posexplode("embedding").alias("pos", "entry"),
    ).select(
        "proj_id", "cell_id",
        F.concat(F.lit("c"), (F.col("pos") % 10).cast("string"), F.lit("_"), F.col("pos").cast("string")).alias("cell_type"),
        F.col("entry").cast("double").alias("value"),
    )


def predicted_classes(t: Tables) -> DataFrame:
    return t.embeddings.select(
        F.concat(F.lit("P"), (F.col("label") % 3).cast("string")).alias("proj_id"), F.col("vec_id").alias("cell_id"),
        F.concat(F.lit("c"), F.col("label").cast("string"), F.lit("_")).alias("predicted"),
    )

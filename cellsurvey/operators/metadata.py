"""Operators over the project, sample, experiment and run tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsurvey.functions import fixed_values as fixed
from cellsurvey.functions.ranking import number_rows
from cellsurvey.functions.text import base_name, list_literal, strip_lane
from cellsurvey.session import durable


def of_projects(df: DataFrame, *proj_ids: str) -> DataFrame:
    """Rows of the given projects; prunes partitions of a table partitioned by project."""
    return df.filter(F.col("proj_id").isin(*proj_ids))


def batch_profile(samples: DataFrame, runs: DataFrame) -> DataFrame:
    """Per project the level that can serve as batch: 1 < distinct values < number of runs.

    Attribute bags come as strings. The candidate columns are unpivoted, so that both tables are read once; equal values are merged
    before they are counted, so a project holding much of the table is merged before it meets its own key. Rows without a
    project are profiled as one.
    """
    def values(df: DataFrame, **columns: str) -> DataFrame:
        pairs = [F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("value")) for kind, c in columns.items()]
        return df.select("proj_id", F.explode(F.array(*pairs)).alias("v")).select("proj_id", "v.*")

    merged = (
        values(samples, sample="samp_id", bag="attributes").union(values(runs, experiment="exp_id"))
        .groupBy("proj_id", "kind", "value").agg(F.count(F.lit(1)).alias("rows"))
    )
    distinct_of = lambda kind: F.count_if((F.col("kind") == kind) & F.col("value").isNotNull())
    joined = (
        merged.groupBy("proj_id").agg(
            distinct_of("sample").alias("n_samples"), distinct_of("bag").alias("n_bags"), distinct_of("experiment").alias("n_experiments"),
            F.coalesce(F.sum(F.when(F.col("kind") == "experiment", F.col("rows"))), F.lit(0)).alias("n_runs"),
            F.max(F.col("kind") == "sample").alias("sampled"))
        .filter("sampled").drop("sampled")
    )
    fits = lambda c: (F.col(c) > 1) & (F.col(c) < F.col("n_runs"))
    level = (
        F.when(fits("n_samples"), "sample").when(fits("n_bags"), "attributes")
        .when(fits("n_experiments"), "experiment").otherwise("none")
    )
    return joined.withColumn("level", level)


def impute_batch(samples: DataFrame, runs: DataFrame) -> DataFrame:
    """(run_id, proj_id, level, batch): the value of the chosen level, 0 where nothing separates runs.

    The batch is the value itself (sample id, attribute bag or experiment id); ``batch_codes``
    turns values into dense numbers. Batches are labels, so only equality matters.
    """
    bags = samples.select("proj_id", "samp_id", "attributes").dropDuplicates(["proj_id", "samp_id"])
    return (
        runs.select("run_id", "proj_id", "samp_id", "exp_id")
        .join(durable(batch_profile(samples, runs).select("proj_id", "level")), "proj_id", "left")
        .join(bags, ["proj_id", "samp_id"], "left")
        .select(
            "run_id", "proj_id", F.coalesce("level", F.lit("none")).alias("level"),
            F.when(F.col("level") == "sample", F.col("samp_id").cast("string"))
            .when(F.col("level") == "attributes", F.col("attributes"))
            .when(F.col("level") == "experiment", F.col("exp_id").cast("string"))
            .otherwise("0").alias("batch"),
        )
    )


def batch_codes(batches: DataFrame) -> DataFrame:
    """Dense integer code of every batch value of a project, 0-based in value order."""
    values = batches.select("proj_id", "batch").distinct()
    codes = number_rows(values, ["proj_id"], ["batch"], "position").select(
        "proj_id", "batch", (F.col("position") - 1).alias("batch_code")
    )
    return batches.join(codes, ["proj_id", "batch"], "left")


def imputed_runs(droplet: DataFrame, plate: DataFrame, batches: DataFrame, runs: DataFrame) -> DataFrame:
    """The run table of inference: chemistry and plate rows, batch joined, known technologies only."""
    source = runs.select("run_id", "data_source")
    rows = (
        droplet.select("run_id", "tech_version", "read1", "read2", "exp_id", "samp_id", "proj_id", "taxon")
        .unionByName(plate.select("run_id", "tech_version", "read1", "read2", "exp_id", "samp_id", "proj_id", "taxon"))
        .filter(F.col("tech_version").isin(fixed.KNOWN_TECHNOLOGIES))
    )
    return rows.join(batches.select("run_id", "batch"), "run_id").join(source, "run_id", "left").select(*fixed.IMPUTE_COLUMNS)


def fill_technology_from_url(impute: DataFrame, runs: DataFrame) -> DataFrame:
    """Composite left join of inferred rows with their runs; path technology where the path names one."""
    from cellsurvey.operators.technology import technology_of_url

    keys = ["run_id", "proj_id", "data_source", "taxon", "exp_id", "samp_id"]
    urls = runs.select(*keys, "file_url")
    return impute.join(urls, keys, "left").withColumn("tech_version", technology_of_url(F.col("file_url"))).drop("file_url")


def download_volume(runs: DataFrame) -> DataFrame:
    """Expected volume per project in GB; sizes are summed as integers."""
    return runs.groupBy("proj_id").agg(
        F.count(F.lit(1)).alias("n_files"), (F.sum("file_size") * 1e-9).alias("gigabytes")
    )


def projects_per_technology(impute: DataFrame) -> DataFrame:
    """Number of projects and runs per technology; distinct pairs first."""
    pairs = impute.groupBy("tech_version", "proj_id").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("tech_version").agg(
        F.count(F.lit(1)).alias("n_projects"), F.sum("n").alias("n_runs")
    )


def runs_per_project(runs: DataFrame) -> DataFrame:
    return runs.select("proj_id", "run_id").distinct().groupBy("proj_id").agg(F.count(F.lit(1)).alias("n_runs"))


def runs_of_projects(runs: DataFrame, projects: DataFrame) -> DataFrame:
    """Distinct runs of the listed projects."""
    return runs.join(projects.select("proj_id").distinct(), "proj_id", "left_semi").select("proj_id", "run_id").distinct()


def protocol_listing(runs: DataFrame, part_size: int = 1000) -> DataFrame:
    """One row per experiment with its runs, dates and taxa as arrays.

    An experiment with more runs than ``part_size`` continues in further rows (``part``), so no
    row has to hold an unbounded list and none is cut off.
    """
    numbered = number_rows(runs, ["proj_id", "exp_id"], ["run_id"], "position")
    return (
        numbered.withColumn("part", F.floor((F.col("position") - 1) / part_size))
        .groupBy("proj_id", "exp_id", "part")
        .agg(F.sort_array(F.collect_list(F.struct("position", "run_id", "publish_date", "taxon"))).alias("r"))
        .select("proj_id", "exp_id", "part", F.col("r.run_id").alias("runs"),
                F.col("r.publish_date").alias("dates"), F.col("r.taxon").alias("taxa"))
    )


def unwrap_listing(listing: DataFrame, literal_cols: Sequence[str]) -> DataFrame:
    """List-literal columns that run in step -> one row per element."""
    zipped = listing.withColumn("__z", F.explode(F.arrays_zip(*[list_literal(F.col(c)).alias(c) for c in literal_cols])))
    keep = [c for c in listing.columns if c not in literal_cols]
    return zipped.select(*keep, *[F.col("__z")[c].alias(c) for c in literal_cols])


def searched_experiments(experiments: DataFrame, searched: DataFrame) -> DataFrame:
    """Experiments that the search also found."""
    return experiments.join(searched.select("exp_id").distinct(), "exp_id", "left_semi")


def unprocessed_runs(manifest: DataFrame, processed: DataFrame) -> DataFrame:
    """Manifest rows of runs without a result yet; ``processed`` lists the barcodes (run ids) of results."""
    return manifest.join(processed.select(F.col("barcode").alias("run_id")), "run_id", "left_anti")


def project_backend(tables: DataFrame) -> DataFrame:
    """Data source of each project; the smallest when there are several."""
    return tables.groupBy("proj_id").agg(F.min("data_source").alias("data_source"))


def batch_directory(name: Column, proj_id: Column) -> tuple[Column, Column, Column]:
    """(id, tech, run_id) of a result directory name ``<id>_<tech>_Solo.out``.

    Grant projects hold ``_`` in their ids and are cut at the last one, archive ids at the first.
    An archive id is a run (RR) or a project (RP); project-level results carry no run id.
    """
    stem = F.replace(name, F.lit("_Solo.out"), F.lit(""))
    grant = F.contains(F.lower(proj_id), F.lit("u19_"))
    tech = F.substring_index(stem, "_", -1)
    wide = F.substring(stem, F.lit(1), F.length(stem) - F.length(tech) - 1)
    first = F.get(F.split(stem, "_"), F.lit(0))
    ident = F.when(grant, wide).otherwise(first)
    technology = F.when(grant, tech).otherwise(F.get(F.split(stem, "_"), F.lit(1)))
    run = F.when(grant | F.contains(ident, F.lit("RR")), ident)
    return ident, technology, run


def attach_runs(cells: DataFrame, impute: DataFrame) -> DataFrame:
    """Cells with missing run id take the cell id; run metadata is joined on the lane-less run id."""
    runs = impute.select(
        strip_lane(F.col("run_id")).alias("run_id"), "exp_id", "samp_id", "proj_id", "taxon"
    ).dropDuplicates()
    return cells.withColumn("run_id", F.coalesce("run_id", "cell_id")).join(runs, ["proj_id", "run_id"], "left")


def archive_entities(metadata: DataFrame, manifest: DataFrame) -> dict[str, DataFrame]:
    """Runs, experiments, samples and projects of the second archive from its metadata and manifest.

    Bulk and human samples are removed from all three; projects without runs are removed.
    """
    meta = metadata.dropDuplicates()
    project = F.replace(F.col("project_id"), F.lit(";"), F.lit("-"))
    bag = F.create_map(*[
        x for k in fixed.ARCHIVE_ATTRIBUTES for x in (F.lit(k), F.col(k))
    ])
    unwanted = meta.filter((F.col("sample_subspecimen_type") == "Bulk") | (F.col("sample_organism") == "Human")) \
        .select(F.col("sample_id").alias("samp_id")).distinct()
    samples = meta.select(
        F.col("sample_id").alias("samp_id"), F.lit("").alias("ext_ids"), F.lit(fixed.ARCHIVE_TAXON).alias("taxon"),
        F.lit(fixed.ARCHIVE_ORGANISM).alias("sciname"), F.col("study_full_name").alias("title"),
        bag.alias("attributes"), project.alias("proj_id"), F.col("project_grant").alias("submission_id"),
        F.lit(fixed.ARCHIVE_SOURCE).alias("data_source"),
    )
    experiments = meta.select(
        F.col("sample_id").alias("exp_id"), F.lit("").alias("ext_ids"), F.lit(fixed.ARCHIVE_STRATEGY).alias("strategy"),
        F.lit(fixed.ARCHIVE_LIBRARY).alias("source"), F.col("study_full_name").alias("lcp"),
        F.col("sample_id").alias("samp_id"), project.alias("proj_id"),
        F.col("project_grant").alias("submission_id"), F.lit(fixed.ARCHIVE_SOURCE).alias("data_source"),
    )
    files = manifest.filter(F.col("md5").isNotNull()).dropDuplicates()
    runs = files.join(
        samples.select("samp_id", "proj_id", "submission_id"), files["sample_id"] == F.col("samp_id"), "left"
    ).select(
        F.replace(F.col("file_id"), F.lit(".fastq.tar"), F.lit("")).alias("run_id"),
        F.get(F.split("urls", ","), F.lit(1)).alias("file_url"), F.col("size").alias("file_size"),
        F.col("sample_id").alias("exp_id"), F.col("sample_id").alias("samp_id"), "proj_id", "submission_id",
        F.lit(fixed.ARCHIVE_TAXON).alias("taxon"), F.lit(fixed.ARCHIVE_ORGANISM).alias("organism"), F.lit(fixed.ARCHIVE_SOURCE).alias("data_source"),
    )
    wanted = lambda df: df.join(unwanted, "samp_id", "left_anti")
    runs = wanted(runs)
    projects = meta.select(project.alias("proj_id"), F.col("project_grant").alias("submission_id")).distinct() \
        .join(runs.select("proj_id").distinct(), "proj_id", "left_semi") \
        .select("proj_id", F.lit("").alias("ext_ids"), F.lit("").alias("title"), F.lit("").alias("abstract"), "submission_id")
    return {"runs": runs, "experiments": wanted(experiments), "samples": wanted(samples), "projects": projects}


def manifest_paths(files: DataFrame, url_col: str = "srcurl") -> DataFrame:
    """File url -> (proj_id, run_id, tech, uid); plate runs take the project id as run id."""
    folder = F.regexp_replace(F.col(url_col), "/[^/]*$", "")
    for part in fixed.ARCHIVE_PATH_PARTS:
        folder = F.replace(folder, F.lit(part), F.lit(""))
    uid = F.replace(base_name(F.col(url_col)), F.lit(".fastq.tar"), F.lit(""))
    named = files.select(
        "*", F.replace(folder, F.lit("/"), F.lit("_")).alias("proj_id"), uid.alias("uid")
    )
    upper = F.upper("proj_id")
    tech = (
        F.when(F.contains(upper, F.lit("10X_V3")), "10x_v3")
        .when(F.contains(upper, F.lit("10X_V2")), "10x_v2").otherwise("SSv4")
    )
    return named.withColumn("tech", tech).withColumn(
        "run_id", F.when(F.col("tech") == "SSv4", F.col("proj_id")).otherwise(strip_lane(F.col("uid")))
    )


def spreadsheet_datasets(sheet: DataFrame, organism: str = "Mouse", measurement: str = "RNA-seq", tissue: str = "Brain") -> DataFrame:
    """Datasets of the wanted organism, measurement and tissue that say where their data are."""
    has = lambda c, word: F.coalesce(F.contains(F.col(c), F.lit(word)), F.lit(False))
    return sheet.filter(
        has("Organism", organism) & has("Measurement", measurement) & has("Tissue", tissue)
        & F.col("Data location").isNotNull()
    )


def location_families(locations: DataFrame, col: str) -> DataFrame:
    """Comma lists of accessions -> one row per accession with its family."""
    parts = locations.select("*", F.explode(F.split(F.col(col), ",")).alias("__p")).withColumn("accession", F.trim("__p"))
    families = F.array_compact(F.array(*[
        F.when(F.contains(F.col("accession"), F.lit(f)), F.lit(f)) for f in fixed.ACCESSION_FAMILIES
    ]))
    return parts.withColumn("family", F.explode(families)).drop("__p")


def runs_by_species(runs: DataFrame, species: Sequence[str]) -> DataFrame:
    return runs.filter(F.col("organism").isin(*species))


def relabel_source(df: DataFrame, condition: Column, label: str) -> DataFrame:
    return df.withColumn("data_source", F.when(condition, label).otherwise(F.col("data_source")))

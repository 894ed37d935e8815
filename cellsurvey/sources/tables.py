"""Readers for the text tables, lists and pages the jobs start from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellsurvey.functions.text import link_texts

_META_TYPES = {
    "tot_spots": T.LongType(), "tot_bases": T.LongType(), "run_size": T.LongType(), "file_size": T.LongType(),
    "nreads": T.IntegerType(), "taxon": T.IntegerType(), "publish_date": T.TimestampType(),
}


# the landed tables quote as spreadsheets do: quotes are doubled, and a quoted field may hold tabs and line feeds.
# A file with such fields cannot be split, so they are read once and kept as Parquet.
_QUOTED = {"quote": '"', "escape": '"', "multiLine": True}


def read_metadata(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], typed: bool = True) -> DataFrame:
    """Tab-separated metadata: columns are bound by the names in the header, ``#`` lines skipped.

    The unnamed row-number column and others not asked for are left out. Files of one path share a header. Everything
    is read as text, missing text becomes ''; with ``typed`` the numeric and date columns are cast, and what
    does not parse becomes NULL.
    """
    raw = None
    for one in [path] if isinstance(path, str) else path:
        part = spark.read.csv(one, sep="\t", header=True, comment="#", **_QUOTED).select(*columns)
        raw = part if raw is None else raw.unionByName(part)
    text = [c for c in columns if not (typed and c in _META_TYPES)]
    out = raw.na.fill("", text)
    if typed:
        out = out.withColumns({c: F.col(c).try_cast(t) for c, t in _META_TYPES.items() if c in columns})
    return out


def read_id_list(spark: SparkSession, *paths: str) -> DataFrame:
    """One id per line; whole-line and trailing ``#`` comments and blank lines are left out.

    Paths are patterns: one that matches nothing is an empty list.
    """
    schema = T.StructType([T.StructField("id", T.StringType())])
    present = [p for p in paths if _exists(spark, p)]
    if not present:
        return spark.createDataFrame([], schema)
    lines = spark.read.text(present)
    return lines.select(F.trim(F.regexp_replace("value", "#.*$", "")).alias("id")).filter(F.length("id") > 0)


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    return found is not None and len(found) > 0


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``experiment project`` -> (exp_id, proj_id)."""
    parts = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).filter(F.size(parts) >= 2).select(
        F.get(parts, F.lit(0)).alias("exp_id"), F.get(parts, F.lit(1)).alias("proj_id")
    )


def read_run_info(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Landed run-info CSV files -> distinct (run_id, exp_id); files repeat their header."""
    rows = spark.read.csv(path, header=True)
    return rows.filter(F.col("Run").isNotNull() & (F.col("Run") != "Run")).select(
        F.col("Run").alias("run_id"), F.col("Experiment").alias("exp_id")
    ).distinct()


def read_search_pages(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """Landed search-result pages (JSON) -> distinct ids.

    A page that spans lines makes its file unsplittable; pages of one line each read in parallel.
    """
    schema = "esearchresult struct<count: string, retstart: string, idlist: array<string>>"
    pages = spark.read.schema(schema).json(path, multiLine=multi_line)
    return pages.select(F.explode("esearchresult.idlist").alias("uid")).distinct()


def read_listing_links(spark: SparkSession, path: str, pattern: str = "/") -> DataFrame:
    """Links of landed directory-listing pages that hold ``pattern``, with the page they are on."""
    pages = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("page"), "value")
    return pages.select("page", F.explode(link_texts(F.col("value"))).alias("link")).filter(F.contains("link", F.lit(pattern)))


def read_archive_manifest(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Archive manifest: files with a checksum, each once."""
    return spark.read.csv(path, sep="\t", header=True, **_QUOTED).filter(F.col("md5").isNotNull()).dropDuplicates()


def download_manifest(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] = ("file_id", "md5", "size", "urls", "sample_id")) -> DataFrame:
    """The columns the download client needs, from several manifests."""
    out = None
    for path in paths:  # each with its own order of columns
        part = spark.read.csv(path, sep="\t", header=True, **_QUOTED).select(*columns)
        out = part if out is None else out.unionByName(part)
    return out


def read_spreadsheet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, **_QUOTED)


def spreadsheet_locations(sheet: DataFrame, column: str = "Data location") -> DataFrame:
    """Sorted locations that are given."""
    return sheet.filter(F.col(column).isNotNull()).select(column).orderBy(column)


def read_transfer_log(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Transferred bytes per day from landed transfer logs."""
    from cellsurvey.functions.text import transferred_bytes

    lines = spark.read.text(path).select(
        F.try_to_date(F.substring("value", 1, 10)).alias("day"), transferred_bytes(F.col("value")).alias("bytes")
    )
    return lines.filter(F.col("bytes").isNotNull()).groupBy("day").agg(F.sum("bytes").alias("bytes"))

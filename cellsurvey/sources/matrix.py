"""Readers for count matrices, aligner statistics, gene sets and marker sets."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellsurvey.operators.cellqc import common_genes
from cellsurvey.operators.metadata import batch_directory
from cellsurvey.session import durable
from cellsurvey.sources import files


def result_name(folder: Column) -> Column:
    """The ``<id>_<tech>_Solo.out`` part of a result path."""
    return F.regexp_extract(folder, r"([^/=]+_Solo\.out)", 1)


def _result(path: Column) -> Column:
    """What names the result a file belongs to: its result folder, else the folder it is in."""
    return F.coalesce(F.nullif(result_name(path), F.lit("")), F.regexp_replace(path, "/[^/]+$", ""))


def _result_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per result: its matrix, feature and barcode files, each in name order; small, whatever the matrices hold."""
    names = ("matrix.mtx", "features.tsv", "barcodes.tsv")
    found = None
    for name in names:
        part = files.listing(spark, f"{path}/{name}").select(_result(F.col("file")).alias("dir"), F.lit(name.split(".")[0]).alias("kind"), "file", "length")
        found = part if found is None else found.unionByName(part)
    of = lambda kind: F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("file", "length")))).alias(kind)
    return durable(found.groupBy("dir").agg(of("matrix"), of("features"), of("barcodes")))


def _lines(uris: Iterable[str]) -> Iterator[pa.Array]:
    """The lines of text files under each other, some at a time; a last line feed ends a line, it does not begin one."""
    for uri in uris:
        rest = b""
        with files.open_file(uri) as f:
            while data := f.read(1 << 24):
                whole, _, rest = (rest + data).rpartition(b"\n") if b"\n" in data else (None, None, rest + data)
                if whole is not None:
                    yield pa.array(whole.split(b"\n"), pa.binary()).cast(pa.string())
        if rest:
            yield pa.array([rest], pa.binary()).cast(pa.string())


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dir, files) -> (dir, idx, value): 1-based line numbers; a side file is read from front to back by one task, so nothing is sorted."""
    for batch in batches:
        for folder, uris in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            before = 0
            for lines in _lines(uris):
                for start in range(0, len(lines), 65_536):
                    part = lines[start : start + 65_536]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([folder] * len(part), pa.string()), pa.array(np.arange(before + 1, before + 1 + len(part))), part], names=["dir", "idx", "value"])
                    before += len(part)


def _column(uris: list[str], trim: bool) -> pa.Array:
    """First field of every line of a side file."""
    parts = [pc.list_element(pc.split_pattern(lines, "\t", max_splits=1), 0) for lines in _lines(uris)]
    whole = pa.chunked_array(parts, pa.string()).combine_chunks()
    return pc.utf8_trim_whitespace(whole) if trim else whole


def _header_end(f) -> int:
    """Where the entries begin: after the comments and the size line."""
    f.seek(0)
    data, at = f.read(1 << 16), 0
    while True:
        end = data.find(b"\n", at)
        if end < 0:
            more = f.read(1 << 16)
            if not more:
                return len(data)
            data += more
        elif data.startswith(b"%", at):
            at = end + 1
        else:
            return end + 1


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of parts of matrix files with the names their numbers stand for; the side files are read where they are used."""
    held, genes, cells = None, None, None
    for batch in batches:
        for row in batch.to_pylist():
            if held != row["dir"]:
                held, genes, cells = row["dir"], _column(row["features"], False), _column(row["barcodes"], True)
            with files.open_file(row["file"]) as f:
                start = max(row["start"], _header_end(f) if row["first"] else 0)
                if start > row["start"] or start == 0:
                    f.seek(start)
                else:  # the line that crosses the border belongs to the part before
                    f.seek(start - 1)
                    _next_line(f)
                while f.tell() < row["end"]:
                    data = f.read(min(1 << 22, row["end"] - f.tell()))
                    numbers = _integers(data + (b"" if data.endswith(b"\n") else _next_line(f)))
                    g, c, n = numbers.T
                    known = (g >= 1) & (g <= len(genes)) & (c >= 1) & (c <= len(cells))
                    g, c, n = g[known], c[known], n[known]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([held] * len(n), pa.string()), genes.take(pa.array(g - 1)), cells.take(pa.array(c - 1)), pa.array(n)],
                        names=["dir", "gene_id", "cell_id", "n"])


def _next_line(f) -> bytes:
    """From here to the end of the line; small reads, lines are short."""
    out = b""
    while data := f.read(256):
        end = data.find(b"\n")
        if end >= 0:
            f.seek(f.tell() - len(data) + end + 1)
            return out + data[: end + 1]
        out += data
    return out


def _integers(data: bytes) -> np.ndarray:
    """Three whole numbers a line, apart by any white space."""
    return np.array(data.split(), dtype=np.int64).reshape(-1, 3)


def read_matrices(spark: SparkSession, path: str, split: int = 64 << 20) -> dict[str, DataFrame]:
    """All MatrixMarket results under ``path`` (a pattern of matrix folders).

    Returns ``counts(dir, gene_id, cell_id, n)``, ``features(dir, idx, gene_id, symbol, source)`` and
    ``barcodes(dir, idx, cell_id)``. Matrix entries are 1-based (gene, cell, count); the comment lines
    and the size line are skipped. A task reads ``split`` bytes of a matrix and the two side files of its result, which are no
    larger than the lists of genes and cells of one run, and resolves the numbers there; entries are never exchanged.
    """
    results = _result_files(spark, path)
    side = lambda kind: files.one_per_task(results.select("dir", F.col(f"{kind}.file"))).mapInArrow(_numbered, "dir string, idx bigint, value string")
    features = side("features").withColumn("p", F.split("value", "\t")).select(
        "dir", "idx", F.get("p", F.lit(0)).alias("gene_id"), F.get("p", F.lit(1)).alias("symbol"), F.get("p", F.lit(2)).alias("source")
    )
    barcodes = side("barcodes").select("dir", "idx", F.trim("value").alias("cell_id"))
    parts = results.select("dir", F.posexplode("matrix").alias("i", "m"), F.col("features.file").alias("features"), F.col("barcodes.file").alias("barcodes")).select(
        "dir", "features", "barcodes", F.col("m.file").alias("file"), (F.col("i") == 0).alias("first"), F.col("m.length").alias("length"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("m.length") - 1, F.lit(0)), F.lit(split).cast("bigint"))).alias("start"))
    parts = parts.withColumn("end", F.least(F.col("start") + split, F.col("length")))
    counts = files.one_per_task(parts).mapInArrow(_entries, "dir string, gene_id string, cell_id string, n bigint")
    return {"counts": counts, "features": features, "barcodes": barcodes}


def project_counts(matrices: dict[str, DataFrame], proj_id: Column) -> DataFrame:
    """Counts of several runs under each other, for the genes that all runs of a project list.

    Cells are named apart by their result.
    """
    ident, tech, run = batch_directory(result_name(F.col("dir")), proj_id)
    counts = matrices["counts"].select(
        proj_id.alias("proj_id"), ident.alias("batch"), tech.alias("tech"),
        F.coalesce(run, F.col("cell_id")).alias("run_id"), F.concat_ws("-", "cell_id", ident).alias("cell_id"), "gene_id", "n",
    )
    listed = matrices["features"].select(proj_id.alias("proj_id"), F.col("dir").alias("run_id"), "gene_id")
    return common_genes(counts, listed)


def with_gene_info(features: DataFrame, annotation: DataFrame) -> DataFrame:
    """Feature list with the annotation's type; ``found`` says whether the gene is annotated."""
    info = annotation.select("gene_id", "type_").dropDuplicates(["gene_id"])
    return features.join(info, "gene_id", "left").withColumn("found", F.col("type_").isNotNull())


def read_aligner_stats(spark: SparkSession, path: str) -> DataFrame:
    """(stat, value, stat_source, accession) from the barcode, feature and summary files under ``path``."""
    def source(pattern: str, name: str, sep: str) -> DataFrame:
        folder = F.col("_metadata.file_path")
        lines = spark.read.text(f"{path}/{pattern}").select(folder.alias("f"), F.trim("value").alias("v")).filter("v <> ''")
        parts = F.split("v", sep, 2)
        return lines.select(
            F.trim(F.get(parts, F.lit(0))).alias("stat"), F.trim(F.get(parts, F.lit(1))).alias("value"),
            F.lit(name).alias("stat_source"), F.regexp_extract("f", r"([^/=]+)_Solo\.out", 1).alias("accession"),
        )
    return (
        source("Barcodes.stats", "barcode", r"\s+")
        .unionByName(source("Gene/Features.stats", "feature", r"\s+"))
        .unionByName(source("Gene/Summary.csv", "summary", ","))
    )


def read_gene_sets(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Gene-set files (column ``gene``) -> (set_name, symbol)."""
    out = None
    for name, path in paths.items():
        part = spark.read.csv(path, header=True).select(F.lit(name).alias("set_name"), F.col("gene").alias("symbol"))
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def read_cell_cycle(spark: SparkSession, path: str) -> DataFrame:
    """Cell-cycle file (cluster, gene) -> the whole set and one set per cluster."""
    rows = spark.read.csv(path, header=True)
    names = F.array(F.lit("cell_cycle"), F.concat(F.lit("cc_cluster_"), F.col("cluster")))
    return rows.select(F.explode(names).alias("set_name"), F.col("gene").alias("symbol")).distinct()


def read_gene_annotation(spark: SparkSession, path: str) -> DataFrame:
    """Gene annotation table; its first line is a count and carries no tab."""
    lines = spark.read.text(path).filter(F.contains("value", F.lit("\t")))
    parts = F.split("value", "\t")
    return lines.select(*[F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(("gene_id", "symbol", "type_"))])


def read_markers(spark: SparkSession, path: str, max_rank: int = 100) -> DataFrame:
    """Marker set (gz or plain CSV), best ranks only."""
    rows = spark.read.csv(path, header=True)
    return rows.withColumn("rank", F.col("rank").cast("int")).filter(F.col("rank") <= max_rank)

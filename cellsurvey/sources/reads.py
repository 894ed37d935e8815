"""Read lengths of landed FASTQ files, plain or inside archives."""

from __future__ import annotations

import gzip
import tarfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellsurvey.sources import files

_MEMBERS = "archive string, member string, at int, length int, problem string"


def _first_reads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The line after the first ``@`` line of every file; both are in the split at offset 0."""
    done, waiting = set(), None
    for batch in batches:
        files, lengths = [], []
        file, at, value = batch.columns
        if pc.any(pc.equal(at, 0)).as_py():
            for name, offset, line in zip(file.to_pylist(), at.to_pylist(), value.to_pylist()):
                if waiting == name:
                    files.append(name)
                    lengths.append(len(line))
                    done.add(name)
                    waiting = None
                elif offset == 0 and name not in done and line.startswith("@"):
                    waiting = name
        yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(lengths, pa.int32())], names=["file", "length"])


def read_lengths(spark: SparkSession, path: str) -> DataFrame:
    """(file, length): the length of the first read of every file, in one narrow scan."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")
    return lines.mapInArrow(_first_reads, "file string, length int")


def run_read_lengths(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, nreads, read_lengths) from files named ``<run>_<n>.fastq``."""
    return _per_run(read_lengths(spark, path))


def _per_run(found: DataFrame) -> DataFrame:
    named = found.select(
        F.regexp_extract("file", r"([^/=]+?)(?:_(\d+))?\.fastq", 1).alias("run_id"),
        F.coalesce(F.regexp_extract("file", r"_(\d+)\.fastq", 1).try_cast("int"), F.lit(1)).alias("n"), "length",
    )
    per_run = named.groupBy("run_id").agg(F.sort_array(F.collect_list(F.struct("n", "length"))).alias("r"))  # a few files
    return per_run.select("run_id", F.size("r").alias("nreads"), F.col("r.length").alias("read_lengths"))


def _first_read(content) -> int:
    """Length of the line after the first ``@`` line of a FASTQ file, gzipped or not; only its beginning is read."""
    magic = content.read(2)
    content.seek(0)
    text = gzip.GzipFile(fileobj=content) if magic == b"\x1f\x8b" else content
    while line := text.readline():
        if line.startswith(b"@"):
            read = text.readline()
            if not read:
                break
            return len(read.rstrip(b"\r\n"))
    raise ValueError("no read")


def _peek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of tar archives. A plain archive is read by its headers: the content of a member is skipped but for its first read.
    A gzipped one has to be unpacked as a stream. What cannot be read becomes a row with the problem."""
    for batch in batches:
        for uri in batch.column(0).to_pylist():
            out = []
            try:
                with files.open_file(uri) as f:
                    packed = f.read(2) == b"\x1f\x8b"
                    f.seek(0)
                    with tarfile.open(fileobj=gzip.GzipFile(fileobj=f) if packed else f, mode="r|" if packed else "r:") as tar:
                        for member in tar:
                            if not member.isfile():
                                continue
                            try:
                                content = tar.extractfile(member)
                                out.append((uri, member.name, len(out), _first_read(_Start(content)) if packed else _first_read(content), None))
                            except (ValueError, EOFError, OSError, zlib.error) as e:
                                out.append((uri, member.name, len(out), None, str(e)))
            except (tarfile.TarError, EOFError, OSError, zlib.error) as e:
                out.append((uri, None, None, None, str(e)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string()))],
                    names=["archive", "member", "at", "length", "problem"])


class _Start:
    """A stream that cannot go back, with its first bytes kept so that they can be looked at twice."""

    def __init__(self, stream, size: int = 1 << 16):
        self.stream, self.kept, self.at = stream, stream.read(size), 0

    def seek(self, at: int) -> None:
        self.at = at

    def read(self, n: int = -1) -> bytes:
        if self.at >= len(self.kept):
            return self.stream.read(n)
        out = self.kept[self.at :] if n < 0 else self.kept[self.at : self.at + n]
        self.at += len(out)
        return out + self.stream.read() if n < 0 else out

    def readline(self) -> bytes:
        end = self.kept.find(b"\n", self.at)
        if 0 <= end:
            return self.read(end + 1 - self.at)
        rest = self.kept[self.at :]
        self.at = len(self.kept)
        return rest + self.stream.readline()


def archive_members(spark: SparkSession, path: str) -> DataFrame:
    """(archive, member, at, length, problem): the FASTQ members of tar archives and the length of their first read.

    An archive is a task of its own; memory and reading do not depend on its size. ``at`` counts the members from 0. A member without a
    read has NULL as length and says why; an archive that breaks off has a row without a member after those found before.
    """
    return files.one_per_task(files.listing(spark, path).select("file")).mapInArrow(_peek, _MEMBERS)


def archive_read_lengths(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, nreads, read_lengths) of the members ``<run>_<n>.fastq`` or ``.fastq.gz`` of archives."""
    return _per_run(archive_members(spark, path).filter("length IS NOT NULL").select(F.col("member").alias("file"), "length"))


def paired_members(members: DataFrame) -> DataFrame:
    """(archive, tech_read, bio_read): by length, the member with the barcodes (24 to 28) and the one with the sequence (over 30).

    For archives of up to three members; of several that qualify the last one in the archive counts.
    """
    last = lambda condition: F.max_by("member", F.when(condition, F.col("at")))
    return members.filter("member IS NOT NULL").groupBy("archive").agg(
        F.count(F.lit(1)).alias("n"), last(F.col("length").between(24, 28)).alias("tech_read"), last(F.col("length") > 30).alias("bio_read"),
    ).filter("n < 4").drop("n")

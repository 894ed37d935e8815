"""Technology, chemistry and read roles of runs, from protocol texts, read lengths and paths."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellsurvey.functions import fixed_values as fixed
from cellsurvey.functions.text import lookup, mentions, strip_lane
from cellsurvey.session import durable


def technology_of_text(low: Column, phrases: Mapping[str, Sequence[str]] = fixed.TECHNOLOGY_PHRASES) -> Column:
    """The one technology a lower-cased protocol names; ``multiple`` for several, ``unknown`` for none."""
    named = F.array_compact(F.array(*[F.when(mentions(low, p), F.lit(t)) for t, p in phrases.items()]))
    return (
        F.when(F.size(named) > 1, "multiple")
        .when(F.size(named) == 1, F.get(named, F.lit(0)))
        .otherwise("unknown")
    )


def classify_texts(
    df: DataFrame, id_col: str, text_col: str,
    phrases: Mapping[str, Sequence[str]] = fixed.TECHNOLOGY_PHRASES, distinct_first: bool = False,
) -> DataFrame:
    """(id, tech) of every text.

    By default each text is scanned where it lies: a narrow step without any shuffle. With
    ``distinct_first`` equal texts are scanned once and joined back by digest, which pays when
    few protocols are shared by very many experiments; only digests are joined.
    """
    low = F.lower(F.coalesce(F.col(text_col), F.lit("None"))).alias("__low")
    texts = df.select(id_col, low)
    if not distinct_first:
        return texts.select(id_col, technology_of_text(F.col("__low"), phrases).alias("tech"))
    keyed = texts.withColumn("__digest", F.sha2("__low", 256))
    once = (
        keyed.groupBy("__digest").agg(F.min("__low").alias("__low"))
        .select("__digest", technology_of_text(F.col("__low"), phrases).alias("tech"))
    )
    return keyed.select(id_col, "__digest").join(once, "__digest").select(id_col, "tech")


def legacy_technology_of_text(low: Column) -> Column:
    """Older rule: of the keyword columns from ``smarter`` on, then 10x, then SS without 10x, the last hit."""
    hits = {name: mentions(low, phrases) for name, phrases in fixed.LEGACY_PHRASES.items()}
    names = list(hits)
    ordered = [(n, hits[n]) for n in names[names.index("smarter"):]]
    ordered += [("isSome10x", hits["is10x"]), ("isSS", hits["SS"] & ~hits["is10x"])]
    found = F.array_compact(F.array(*[F.when(hit, F.lit(name)) for name, hit in ordered]))
    return F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit("Unknown"))


def classify_texts_legacy(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, method) of every text by the older rule."""
    texts = df.select(id_col, F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("__low"))
    return texts.select(id_col, legacy_technology_of_text(F.col("__low")).alias("method"))


def unmatched_texts(
    df: DataFrame, id_col: str, text_col: str, phrases: Mapping[str, Sequence[str]] = fixed.LEGACY_PHRASES
) -> DataFrame:
    """Distinct texts that name no technology at all.

    Of each digest the smallest id is kept, so only ids and digests are grouped; the texts of the survivors are then taken
    from where they lie. Protocols are shared by many experiments, so the survivors are few.
    """
    every = [p for group in phrases.values() for p in group]
    digest = F.sha2(F.coalesce(text_col, F.lit("")).cast("binary"), 256).alias("__digest")
    open_ = df.select(id_col, text_col, digest).filter(~mentions(F.lower(text_col), every))
    once = durable(open_.groupBy("__digest").agg(F.min(id_col).alias(id_col)))
    return open_.join(once, ["__digest", id_col], "left_semi").select(text_col)


def known_technology(df: DataFrame, col: str = "tech_version") -> DataFrame:
    return df.filter(F.col(col).isin(fixed.KNOWN_TECHNOLOGIES))


def technology_of_url(url: Column) -> Column:
    """Technology from the path of a file url; '' when the path names none, NULL without a url."""
    return F.when(url.isNotNull(), lookup(F.parse_url(url, F.lit("PATH")), fixed.URL_TECHNOLOGIES, ""))


def chemistry(runs: DataFrame, lengths_col: str = "read_lengths") -> DataFrame:
    """Chemistry and read roles of 10x runs from the lengths of the reads of their first spot.

    The first read of length 24/26/28 is the technical read and sets the version; the first of
    the longest reads is the biological one. No such read, or both the same, gives plain 10x.
    Runs need more than one read.
    """
    lengths = F.col(lengths_col)
    known = F.array(*[F.lit(n) for n in fixed.CHEMISTRY_READ_LENGTHS])
    version = F.create_map(*[F.lit(x) for kv in fixed.CHEMISTRY_READ_LENGTHS.items() for x in kv])
    technical = F.get(F.filter(lengths, lambda x: F.array_contains(known, x)), F.lit(0))
    found = (
        runs.filter(F.col("nreads") > 1)
        .withColumn("__length", technical)
        .withColumn("__bio", F.array_position(lengths, F.array_max(lengths)))
        .withColumn("__tech", F.array_position(lengths, F.col("__length")))
    )
    usable = F.col("__length").isNotNull() & (F.col("__tech") != F.col("__bio"))
    file = lambda n: F.concat(F.col("run_id").cast("string"), F.lit("_"), n.cast("string"), F.lit(".fastq"))
    return found.select(
        *[c for c in runs.columns],
        F.when(usable, F.element_at(version, F.col("__length"))).otherwise("10x").alias("tech_version"),
        file(F.col("__bio")).alias("read1"),
        F.when(usable, file(F.col("__tech"))).otherwise("-").alias("read2"),
    )


def chemistry_of_reads(reads: DataFrame) -> DataFrame:
    """The same rule on ``reads(run_id, position, length)``: plain aggregates, no list per run.

    First means smallest position (then smallest length). ``position`` numbers the read files; reads are told
    apart by position and length.
    """
    known = F.col("length").isin(list(fixed.CHEMISTRY_READ_LENGTHS))
    version = F.create_map(*[F.lit(x) for kv in fixed.CHEMISTRY_READ_LENGTHS.items() for x in kv])
    found = reads.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("nreads"),
        F.min(F.when(known, F.struct("position", "length"))).alias("t"),
        F.min(F.struct((-F.col("length")).alias("short"), "position")).alias("b"),
    ).filter(F.col("nreads") > 1)
    same = (F.col("t.position") == F.col("b.position")) & (F.col("t.length") == -F.col("b.short"))
    usable = F.col("t").isNotNull() & ~same
    file = lambda n: F.concat(F.col("run_id").cast("string"), F.lit("_"), n.cast("string"), F.lit(".fastq"))
    return found.select(
        "run_id", "nreads", F.when(usable, F.element_at(version, F.col("t.length"))).otherwise("10x").alias("tech_version"),
        file(F.col("b.position")).alias("read1"), F.when(usable, file(F.col("t.position"))).otherwise("-").alias("read2"),
    )


def plate_manifest(runs: DataFrame, tech: DataFrame) -> DataFrame:
    """Read files of plate-based runs: two files when paired, one otherwise."""
    run = F.col("run_id").cast("string")
    paired = F.col("nreads") > 1
    single = F.col("nreads") == 1
    return (
        runs.join(tech.filter(F.col("tech") == "smartseq"), "exp_id")
        .withColumnRenamed("tech", "tech_version")
        .withColumn("read1", F.when(paired, F.concat(run, F.lit("_1.fastq"))).when(single, F.concat(run, F.lit(".fastq"))))
        .withColumn("read2", F.when(paired, F.concat(run, F.lit("_2.fastq"))).when(single, F.lit("-")))
    )


def read_role(length: Column) -> Column:
    """Technical reads have 24-28 bases, biological ones more than 30."""
    return F.when(length.between(24, 28), "technical").when(length > 30, "biological")


def read_roles(files: DataFrame) -> DataFrame:
    """(run_id, tech) -> technical and biological file, kept when the file count fits the technology.

    Of several files with one role the one with the greatest name is kept; a plate run takes its
    two files in name order.
    """
    role = read_role(F.col("length"))
    per_run = files.groupBy("run_id", "tech").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.max(F.when(role == "biological", F.col("file"))).alias("bio"),
        F.max(F.when(role == "technical", F.col("file"))).alias("tec"),
        F.min("file").alias("first"), F.max("file").alias("last"),
    )
    plate = (F.col("tech") == "smartseq") & (F.col("n_files") == 2)
    droplet = F.contains(F.col("tech"), F.lit("10x")) & (F.col("n_files") < 4)
    return per_run.select(
        "run_id", "tech", "n_files",
        F.when(plate, F.col("first")).when(droplet, F.coalesce("bio", F.lit(""))).otherwise("").alias("read1"),
        F.when(plate, F.col("last")).when(droplet, F.coalesce("tec", F.lit(""))).otherwise("").alias("read2"),
    )


def lane_merge(runs: DataFrame) -> DataFrame:
    """Runs that differ only in their lane become one row with comma lists of both reads.

    Rows repeated for one lane are merged first; what is left per prefix is one row for each of the
    ten lane digits and distinct file pair, so the collected lists stay short.
    """
    lanes = runs.select(strip_lane(F.col("run_id")).alias("prefix"), "tech_version", "run_id", "read1", "read2").distinct()
    merged = lanes.groupBy("prefix", "tech_version").agg(
        F.sort_array(F.collect_list(F.struct("run_id", "read1", "read2"))).alias("lanes"),
        F.count(F.when(~F.col("read1").isin("", "-"), 1)).alias("n_bio"),
        F.count(F.when(~F.col("read2").isin("", "-"), 1)).alias("n_tec"),
    )
    return merged.select(
        "prefix", "tech_version", F.size("lanes").alias("n_lanes"),
        F.array_join("lanes.read1", ",").alias("read1"), F.array_join("lanes.read2", ",").alias("read2"),
        (F.col("n_bio") == F.col("n_tec")).alias("matched"),
    )


def barcode_parts(reads: DataFrame) -> DataFrame:
    """Cut barcode and UMI out of technical reads by the layout of their chemistry."""
    def pick(i: int) -> Column:
        expr = None
        for tech, layout in fixed.CHEMISTRY_LAYOUT.items():
            cond = F.col("tech") == tech
            expr = F.when(cond, layout[i]) if expr is None else expr.when(cond, layout[i])
        return expr
    sized = reads.withColumns({"cb_len": pick(0), "umi_start": pick(1), "umi_len": pick(2)})
    return sized.withColumns({
        "barcode": F.substring(F.col("read"), F.lit(1), F.col("cb_len")),
        "umi": F.substring(F.col("read"), F.col("umi_start"), F.col("umi_len")),
    })


def whitelist_overlap(barcodes: DataFrame, whitelists: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct barcodes of each group found on each whitelist, and the whitelist with most of them."""
    hits = (
        barcodes.select(*keys, "barcode").distinct()
        .join(whitelists.select("whitelist", "barcode").distinct(), "barcode")
        .groupBy(*keys, "whitelist").agg(F.count(F.lit(1)).alias("n_hits"))
    )
    best = hits.groupBy(*keys).agg(
        F.min(F.struct((-F.col("n_hits")).alias("n"), F.col("whitelist").alias("w"))).alias("b")
    )
    return hits.join(best, list(keys)).select(
        *keys, "whitelist", "n_hits", (F.col("whitelist") == F.col("b.w")).alias("is_best")
    )


def mode_signature(runs: DataFrame, signature: str = "read_lengths") -> DataFrame:
    """The most frequent read-length signature of each project (ties: smallest text)."""
    counts = runs.groupBy("proj_id", signature).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("proj_id").agg(
        F.min_by(signature, F.struct((-F.col("n")).alias("n"), F.col(signature).alias("s"))).alias(signature),
        F.max("n").alias("n_runs"),
    )


def curated_override(
    tech: DataFrame, runs: DataFrame, plate_projects: DataFrame, droplet_projects: DataFrame
) -> DataFrame:
    """Replace the inferred technology of experiments of curated projects.

    Plate projects: experiments with a run of the project's most frequent read-length signature.
    Droplet projects (they win): experiments with a run whose signature holds 24, 26 or 28.
    """
    of_plate = runs.join(plate_projects.select("proj_id").distinct(), "proj_id", "left_semi")
    plate = (
        of_plate.join(mode_signature(of_plate).select("proj_id", "read_lengths"), ["proj_id", "read_lengths"], "left_semi")
        .select("exp_id").distinct().withColumn("__plate", F.lit("smartseq"))
    )
    droplet = (
        runs.join(droplet_projects.select("proj_id").distinct(), "proj_id", "left_semi")
        .filter(F.col("read_lengths").rlike("24,|, 24|26,|, 26|28,|, 28"))
        .select("exp_id").distinct().withColumn("__droplet", F.lit("10x"))
    )
    return tech.join(plate, "exp_id", "left").join(droplet, "exp_id", "left").select(
        "exp_id", F.coalesce("__droplet", "__plate", "tech").alias("tech")
    )

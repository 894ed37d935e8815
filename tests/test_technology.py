"""Inference rules on the cases the definitions name."""

import pytest
from pyspark.sql import functions as F

from cellsurvey.functions import text as tx
from cellsurvey.operators import ledger, metadata, technology


def test_text_rules(spark):
    texts = ["Chromium v2", "SMART-seq2 by Picelli", "SMARTer kit", "10X protocol and Drop-Seq", "nothing", None, "smartseq chromium"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "exp_id int, lcp string")
    want = {0: "10x", 1: "smartseq", 2: "smarter", 3: "multiple", 4: "unknown", 5: "unknown", 6: "multiple"}
    for distinct in (False, True):
        got = technology.classify_texts(df, "exp_id", "lcp", distinct_first=distinct).collect()
        assert {r.exp_id: r.tech for r in got} == want
    legacy = technology.classify_texts_legacy(df, "exp_id", "lcp").collect()
    assert {r.exp_id: r.method for r in legacy} == {0: "isSome10x", 1: "isSS", 2: "smarter", 3: "isSome10x", 4: "Unknown", 5: "Unknown", 6: "isSome10x"}
    assert {r.lcp for r in technology.unmatched_texts(df, "exp_id", "lcp").collect()} == {"nothing"}


@pytest.mark.parametrize("lengths,want", [
    ([26, 98], ("10xv2", "R_2.fastq", "R_1.fastq")),
    ([98, 28], ("10xv3", "R_1.fastq", "R_2.fastq")),
    ([24, 26, 98], ("10xv1", "R_3.fastq", "R_1.fastq")),
    ([8, 26, 150], ("10xv2", "R_3.fastq", "R_2.fastq")),
    ([50, 50], ("10x", "R_1.fastq", "-")),
    ([26, 10], ("10x", "R_1.fastq", "-")),          # the technical read is the longest one
    ([98, 98, 28], ("10xv3", "R_1.fastq", "R_3.fastq")),
])
def test_chemistry(spark, lengths, want):
    df = spark.createDataFrame([("R", len(lengths), lengths)], "run_id string, nreads int, read_lengths array<int>")
    r = technology.chemistry(df).collect()[0]
    assert (r.tech_version, r.read1, r.read2) == want


def test_single_read_runs_have_no_chemistry(spark):
    df = spark.createDataFrame([("R", 1, [98])], "run_id string, nreads int, read_lengths array<int>")
    assert technology.chemistry(df).count() == 0


def test_lanes(spark):
    df = spark.createDataFrame([
        ("a_L001", "10xv2", "a_L001_1", "a_L001_2"), ("a_L002", "10xv2", "a_L002_1", "a_L002_2"), ("a_L002", "10xv2", "a_L002_1", "a_L002_2"),
        ("b", "10xv3", "b_1", "-"),
    ], "run_id string, tech_version string, read1 string, read2 string")
    got = {r.prefix: r for r in technology.lane_merge(df).collect()}
    assert (got["a"].read1, got["a"].read2, got["a"].n_lanes, got["a"].matched) == ("a_L001_1,a_L002_1", "a_L001_2,a_L002_2", 2, True)
    assert not got["b"].matched


@pytest.mark.parametrize("samples,runs,want", [
    ([("s1", "x"), ("s2", "x")], [("r1", "s1", "e1"), ("r2", "s1", "e1"), ("r3", "s2", "e2")], {"r1": "s1", "r2": "s1", "r3": "s2"}),
    ([("s1", "x"), ("s2", "x"), ("s3", "y")], [("r1", "s1", "e1"), ("r2", "s2", "e1"), ("r3", "s3", "e1")], {"r1": "x", "r2": "x", "r3": "y"}),
    ([("s1", "x")], [("r1", "s1", "e1"), ("r2", "s1", "e2"), ("r3", "s1", "e2")], {"r1": "e1", "r2": "e2", "r3": "e2"}),
    ([("s1", "x")], [("r1", "s1", "e1"), ("r2", "s1", "e1")], {"r1": "0", "r2": "0"}),
])
def test_batch_levels(spark, samples, runs, want):
    s = spark.createDataFrame([("P", *x) for x in samples], "proj_id string, samp_id string, attributes string")
    r = spark.createDataFrame([("P", *x) for x in runs], "proj_id string, run_id string, samp_id string, exp_id string")
    b = metadata.batch_codes(metadata.impute_batch(s, r)).collect()
    assert {x.run_id: x.batch for x in b} == want
    assert len({x.batch_code for x in b}) == len(set(want.values()))


def test_imputed_runs(spark):
    runs = spark.createDataFrame([("R1", "E1", "S1", "P", "10090", "sra", 2, [26, 98]), ("R2", "E2", "S1", "P", "10090", "sra", 1, [50]), ("R3", "E3", "S1", "P", "10090", "sra", 2, [50, 50])],
                                 "run_id string, exp_id string, samp_id string, proj_id string, taxon string, data_source string, nreads int, read_lengths array<int>")
    tech = spark.createDataFrame([("E1", "10x"), ("E2", "smartseq"), ("E3", "10x")], "exp_id string, tech string")
    chem = technology.chemistry(runs.join(tech.filter("tech = '10x'"), "exp_id"))
    plate = technology.plate_manifest(runs, tech)
    batches = metadata.impute_batch(spark.createDataFrame([("P", "S1", "x")], "proj_id string, samp_id string, attributes string"), runs)
    got = {r.run_id: r for r in metadata.imputed_runs(chem, plate, batches, runs).collect()}
    assert set(got) == {"R1", "R2"}  # plain 10x is not a known technology
    assert (got["R1"].tech_version, got["R2"].read1, got["R2"].read2) == ("10xv2", "R2.fastq", "-")


def test_id_modulo_equals_big_integer(spark):
    ids = ["SRP320073", "a", "ERP114364", "é-long-identifier-0123456789"]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    for n in (1, 7, 1000, 2**40):
        got = {r.id: r.bucket for r in ledger.with_bucket(df, n).collect()}
        assert got == {i: int(i.encode().hex(), 16) % n for i in ids}


def test_text_helpers(spark):
    df = spark.createDataFrame([("['a', 'b']", "x/y/z_L003", {"b": "2", "a": "1"})], "lit string, path string, bag map<string,string>")
    r = df.select(tx.list_literal(F.col("lit")).alias("l"), tx.base_name(F.col("path")).alias("b"), tx.strip_lane(F.col("path")).alias("s"),
                  tx.text_bag(F.col("bag")).alias("t"), tx.safe_name(F.col("path")).alias("n"), tx.species_of(F.lit(9606)).alias("sp")).collect()[0]
    assert (r.l, r.b, r.s, r.t, r.n, r.sp) == (["a", "b"], "z_L003", "x/y/z", '{"a":"1","b":"2"}', "x-y-z_L003", "human")


def test_distinct_terms_keeps_first_of_equal_sets(spark):
    rows = [("P", t, n) for t, ns in {"b": [1, 2], "a": [2, 1], "c": [1, 2, 3], "d": [3]}.items() for n in ns]
    df = spark.createDataFrame(rows, "proj_id string, term string, node long")
    assert {r.term for r in ledger.distinct_terms(df).select("term").distinct().collect()} == {"a", "c", "d"}


def test_stage_outcome(spark):
    df = spark.createDataFrame([("A", True), ("A", True), ("B", True), ("B", False), ("C", False)], "proj_id string, ok boolean")
    got = {r.seen: (r.done, r.partial) for r in ledger.stage_outcome(df).collect()}
    assert got == {"A": ("A", None), "B": (None, "B"), "C": (None, None)}


def test_array_rule_and_read_rule_agree(spark):
    """On every run of the table, and no read is missing from the lists."""
    from cellsurvey.plans import bindings as b

    t = b.Tables(spark, "/root/testdata/sf0.01")
    lists = b.read_lengths(t)
    assert lists.agg(F.sum(F.size("read_lengths"))).first()[0] == t.lineitem.count()
    array = technology.chemistry(lists).select("run_id", "tech_version")
    reads = technology.chemistry_of_reads(b.reads(t)).select("run_id", F.col("tech_version").alias("other"))
    both = array.join(reads, "run_id", "full")
    assert both.count() == array.count() and both.filter("not tech_version <=> other").count() == 0

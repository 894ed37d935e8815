"""Readers and writers on small files made here."""

import gzip
import io
import tarfile
import json

import pytest
import pyarrow as pa
from pyspark.sql import functions as F

from cellsurvey.functions import fixed_values as fixed
from cellsurvey.sources import files, matrix, packages, reads, sinks, tables


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_metadata_scan(spark, tmp_path):
    cols = fixed.RUN_COLUMNS
    head = "\t" + "\t".join(cols)
    line = "0\tR1\t{}\t10\t20\t\t2021-05-18 17:22:26\t10090\tMus\tx\t{}\tu\t5\tE1\tS1\tP1\tA1\tsra"
    f = put(tmp_path / "runs.tsv", f"# note\n{head}\n{line}\n")
    r = tables.read_metadata(spark, f, cols).collect()[0]
    assert (r.run_id, r.tot_spots, r.run_size, r.nreads, r.taxon) == ("R1", 10, None, None, 10090)
    assert r.publish_date.year == 2021
    text = tables.read_metadata(spark, f, cols, typed=False).collect()[0]
    assert text.run_size == "" and text.tot_spots == "10"


def test_metadata_text(spark, tmp_path):
    """Quotes, tabs and line feeds in fields; columns in another order in the second file; fields not asked for."""
    a = put(tmp_path / "a.tsv", '\tproj_id\ttitle\tabstract\n0\tP1\t"a ""b"" c"\t"one\ttwo\nthree"\n1\tP2\t\t"x"\n')
    b = put(tmp_path / "b.tsv", "\tabstract\textra\ttitle\tproj_id\n0\tabs\te\tt\tP3\n")
    got = rows(tables.read_metadata(spark, [a, b], ["proj_id", "title", "abstract"]), "proj_id", "title", "abstract")
    assert got == [("P1", 'a "b" c', "one\ttwo\nthree"), ("P2", "", "x"), ("P3", "t", "abs")]


def test_withdrawn_run_rejects_its_project(spark, tmp_path):
    body = [PACKAGE.format(e=e, p=p, ext="", lib="", title="", runs=RUN.format(r="R" + e, e=e, alts="", more=more))
            for e, p, more in (("X1", "P1", ""), ("X2", "P1", 'unavailable="true"'), ("X3", "P2", ""))]
    f = put(tmp_path / "set.xml", "<EXPERIMENT_PACKAGE_SET>" + "\n".join(body) + "</EXPERIMENT_PACKAGE_SET>")
    found = packages.read_packages(spark, f)
    assert rows(packages.runs(packages.available(found)), "run_id") == [("RX3",)]
    assert rows(packages.runs(packages.available(found, level="package")), "run_id") == [("RX1",), ("RX3",)]


def test_id_list(spark, tmp_path):
    a = put(tmp_path / "a.txt", "# head\nERP000001   # trailing\n\n  SRP1\n")
    b = put(tmp_path / "b.txt", "SRP2\n")
    assert rows(tables.read_id_list(spark, a, b, str(tmp_path / "none.txt")), "id") == [("ERP000001",), ("SRP1",), ("SRP2",)]
    assert tables.read_id_list(spark, str(tmp_path / "none.txt")).count() == 0


def test_pairs_run_info_and_search_pages(spark, tmp_path):
    f = put(tmp_path / "pairs.txt", "SRX1 SRP1\nSRX2   SRP1\n\n")
    assert rows(tables.read_pairs(spark, f), "exp_id", "proj_id") == [("SRX1", "SRP1"), ("SRX2", "SRP1")]
    g = put(tmp_path / "info.csv", "Run,Experiment,x\nSRR1,SRX1,1\nSRR2,SRX1,2\nRun,Experiment,x\nSRR1,SRX1,1\n")
    assert rows(tables.read_run_info(spark, g), "run_id", "exp_id") == [("SRR1", "SRX1"), ("SRR2", "SRX1")]
    for i, ids in enumerate((["1", "2"], ["2", "3"])):
        put(tmp_path / "pages" / f"{i}.json", json.dumps({"esearchresult": {"count": "3", "idlist": ids}}, indent=1))
    assert rows(tables.read_search_pages(spark, str(tmp_path / "pages")), "uid") == [("1",), ("2",), ("3",)]


def test_listing_manifest_and_spreadsheet(spark, tmp_path):
    put(tmp_path / "html" / "i.html", '<html>\n<a href="a/">a/</a> <a href="b.txt">b.txt</a>\n<a href="c/">c/</a></html>')
    assert rows(tables.read_listing_links(spark, str(tmp_path / "html")), "link") == [("a/",), ("c/",)]
    head = "file_id\tmd5\tsize\turls\tsample_id\textra\n"
    m = put(tmp_path / "m1.tsv", head + "f1\tx\t1\tu\ts1\te\nf1\tx\t1\tu\ts1\te\nf2\t\t2\tu\ts2\te\n")
    assert rows(tables.read_archive_manifest(spark, m), "file_id") == [("f1",)]
    d = tables.download_manifest(spark, [m, put(tmp_path / "m2.tsv", head + "f3\ty\t1\tu\ts3\te\n")])
    assert d.columns == ["file_id", "md5", "size", "urls", "sample_id"] and d.count() == 4
    sinks.write_download_manifest(d, str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), sep="\t", header=True).count() == 4
    s = put(tmp_path / "s.tsv", "Organism\tData location\nMouse\tGSE2\nMouse\t\nHuman\tGSE1\n")
    assert [r[0] for r in tables.spreadsheet_locations(tables.read_spreadsheet(spark, s)).collect()] == ["GSE1", "GSE2"]


def test_transfer_log(spark, tmp_path):
    f = put(tmp_path / "log", '2020-02-03 04:05:06 URL:https://h/SRR1 [12345/12345] -> "SRR1.sra" [1]\nnoise\n2020-02-03 07:00:00 URL:x [5/5] -> "y" [1]\n')
    assert [r.bytes for r in tables.read_transfer_log(spark, f).collect()] == [12350]


PACKAGE = """<EXPERIMENT_PACKAGE>
<EXPERIMENT accession="{e}"><IDENTIFIERS><PRIMARY_ID>{e}</PRIMARY_ID>{ext}</IDENTIFIERS><STUDY_REF accession="{p}"/>
<DESIGN><SAMPLE_DESCRIPTOR accession="S{e}"/><LIBRARY_DESCRIPTOR>{lib}</LIBRARY_DESCRIPTOR></DESIGN></EXPERIMENT>
<SUBMISSION accession="A1"/>
<STUDY accession="{p}"><IDENTIFIERS><PRIMARY_ID>{p}</PRIMARY_ID><EXTERNAL_ID namespace="GEO">G1</EXTERNAL_ID><EXTERNAL_ID namespace="BioProject">B1</EXTERNAL_ID></IDENTIFIERS>
<DESCRIPTOR><STUDY_TITLE>T</STUDY_TITLE><STUDY_ABSTRACT>It's "quoted"</STUDY_ABSTRACT></DESCRIPTOR></STUDY>
<SAMPLE accession="S{e}"><IDENTIFIERS><PRIMARY_ID>S{e}</PRIMARY_ID></IDENTIFIERS>{title}<SAMPLE_NAME><TAXON_ID>10090</TAXON_ID><SCIENTIFIC_NAME>Mus musculus</SCIENTIFIC_NAME></SAMPLE_NAME>
<SAMPLE_ATTRIBUTES><SAMPLE_ATTRIBUTE><TAG>source_name</TAG><VALUE>a</VALUE></SAMPLE_ATTRIBUTE><SAMPLE_ATTRIBUTE><TAG>source_name</TAG><VALUE>b</VALUE></SAMPLE_ATTRIBUTE></SAMPLE_ATTRIBUTES></SAMPLE>
<RUN_SET>{runs}</RUN_SET></EXPERIMENT_PACKAGE>"""
RUN = """<RUN accession="{r}" total_spots="7" total_bases="70" size="9" published="2021-05-18 17:22:26" {more}><IDENTIFIERS><PRIMARY_ID>{r}</PRIMARY_ID></IDENTIFIERS>
<EXPERIMENT_REF accession="{e}"/><Pool><Member accession="S{e}" tax_id="10090" organism="Mus musculus"/></Pool>
<SRAFiles><SRAFile filename="x.gz" url="u0" size="1"/><SRAFile filename="{r}" url="u1" size="5">{alts}</SRAFile></SRAFiles>
<Statistics nreads="2"/><Bases><Base value="A" count="3"/><Base value="C" count="4"/></Bases></RUN>"""


@pytest.fixture(scope="module")
def package_set(spark, tmp_path_factory):
    aws = '<Alternatives url="https://a.s3.amazonaws.com/1"/><Alternatives url="gs://x"/><Alternatives url="https://b.s3.amazonaws.com/2"/>'
    full = "<LIBRARY_STRATEGY>RNA-Seq</LIBRARY_STRATEGY><LIBRARY_SOURCE>T</LIBRARY_SOURCE><LIBRARY_CONSTRUCTION_PROTOCOL> 10x Genomics </LIBRARY_CONSTRUCTION_PROTOCOL>"
    body = [
        PACKAGE.format(e="X1", p="P1", ext='<EXTERNAL_ID namespace="GEO">GSM1</EXTERNAL_ID>', lib=full, title="<TITLE>t1</TITLE>",
                       runs=RUN.format(r="R1", e="X1", alts=aws, more="") + RUN.format(r="R2", e="X1", alts='<Alternatives url="gs://y"/>', more="")),
        PACKAGE.format(e="X2", p="P1", ext="", lib="", title="", runs=RUN.format(r="R3", e="X2", alts="", more="")),
        PACKAGE.format(e="X3", p="P2", ext="", lib=full, title="", runs=RUN.format(r="R4", e="X3", alts="", more='unavailable="true"')),
    ]
    f = tmp_path_factory.mktemp("xml") / "set.xml"
    f.write_text("<EXPERIMENT_PACKAGE_SET>" + "\n".join(body) + "</EXPERIMENT_PACKAGE_SET>")
    return packages.read_packages(spark, str(f))


def test_packages(package_set):
    ok = packages.available(package_set)
    assert rows(packages.quarantined(package_set), "exp_id", "proj_id", "run_id") == [("X3", "P2", "R4")]
    p = packages.projects(ok).collect()
    assert len(p) == 1 and p[0].ext_ids == {"GEO": "G1", "BioProject": "B1"} and p[0].abstract == 'It\'s "quoted"'
    s = {r.samp_id: r for r in packages.samples(ok).collect()}
    assert s["SX1"].title == "t1" and s["SX2"].title == "SX2" and s["SX1"].attributes == {"source_name": "b"}
    e = {r.exp_id: r for r in packages.experiments(ok).collect()}
    assert e["X1"].lcp == "10x Genomics" and e["X1"].ext_ids == {"GEO": "GSM1"}
    assert (e["X2"].lcp, e["X2"].strategy, e["X2"].ext_ids) == ("", "", {})
    r = {x.run_id: x for x in packages.runs(ok).collect()}
    assert r["R1"].file_url == "https://b.s3.amazonaws.com/2" and r["R2"].file_url == "u1" and r["R3"].file_size == 5
    assert r["R1"].nreads == 2 and r["R1"].basecounts == {"A": 3, "C": 4} and r["R1"].samp_id == "SX1"
    assert [c for c in packages.runs(ok).columns] == fixed.RUN_COLUMNS
    assert rows(packages.experiment_projects(package_set), "exp_id", "proj_id") == [("X1", "P1"), ("X2", "P1"), ("X3", "P2")]


def test_package_files_are_read_in_parts(spark, tmp_path):
    """One file, many tasks; cuts anywhere; comments, CDATA and a declared prolog do no harm."""
    body = [PACKAGE.format(e=f"X{i}", p=f"P{i % 3}", ext="", lib="<LIBRARY_STRATEGY><![CDATA[a<b]]></LIBRARY_STRATEGY>", title="<!-- no title -->", runs=RUN.format(r=f"R{i}", e=f"X{i}", alts="", more="")) for i in range(40)]
    f = put(tmp_path / "set.xml", '<?xml version="1.0"?>\n<EXPERIMENT_PACKAGE_SET>' + "\n".join(body) + "</EXPERIMENT_PACKAGE_SET>\n")
    want = rows(packages.runs(packages.read_packages(spark, f, whole_files=True)), "run_id", "exp_id", "proj_id", "file_url")
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (997, 4096, 5003):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found = packages.read_packages(spark, f)
            assert found.rdd.getNumPartitions() > 5
            assert rows(packages.runs(found), "run_id", "exp_id", "proj_id", "file_url") == want and len(want) == 40
            assert {r.strategy for r in packages.experiments(found).collect()} == {"a<b"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", default)
    odd = put(tmp_path / "odd.xml", "<EXPERIMENT_PACKAGE_SET><!-- <EXPERIMENT_PACKAGE></EXPERIMENT_PACKAGE> -->" + body[0] + "</EXPERIMENT_PACKAGE_SET>")
    with pytest.raises(Exception, match="whole_files"):
        packages.read_packages(spark, odd).collect()
    assert len(packages.read_packages(spark, odd, whole_files=True).collect()) == 1


def test_matrix_market(spark, tmp_path):
    for run in ("SRR1_10xv2", "SRP9_smartseq"):
        d = tmp_path / f"{run}_Solo.out" / "Gene" / "filtered"
        put(d / "matrix.mtx", "%%MatrixMarket matrix coordinate integer general\n%\n3 2 3\n1 1 5\n3 1 2\n2 2 7\n")
        put(d / "features.tsv", "G1\ts1\tGene Expression\nG2\ts2\tGene Expression\nG3\ts3\tGene Expression\n")
        put(d / "barcodes.tsv", "AAA\nCCC\n")
    m = matrix.read_matrices(spark, str(tmp_path / "*_Solo.out" / "Gene" / "filtered"))
    one = m["counts"].filter(F.contains("dir", F.lit("SRR1")))
    assert rows(one, "cell_id", "gene_id", "n") == [("AAA", "G1", 5), ("AAA", "G3", 2), ("CCC", "G2", 7)]
    assert m["features"].count() == 6
    p = matrix.project_counts(m, F.lit("SRP9"))
    assert rows(p.filter("batch = 'SRP9'"), "tech", "run_id", "cell_id")[0] == ("smartseq", "AAA", "AAA-SRP9")
    assert rows(p.filter("batch = 'SRR1'"), "tech", "run_id", "cell_id")[0] == ("10xv2", "SRR1", "AAA-SRR1")
    ann = spark.createDataFrame([("G1", "rRNA")], "gene_id string, type_ string")
    assert rows(matrix.with_gene_info(m["features"], ann).filter("found"), "gene_id") == [("G1",), ("G1",)]


def test_aligner_stats(spark, tmp_path):
    d = tmp_path / "SRR1_10xv2_Solo.out"
    put(d / "Barcodes.stats", "   nNoAdapter    0\n   nExactMatch   12\n")
    put(d / "Gene" / "Features.stats", "  nUnmapped   3\n")
    put(d / "Gene" / "Summary.csv", "Number of Reads,100\nReads With Valid Barcodes,0.9\n")
    got = rows(matrix.read_aligner_stats(spark, str(d)), "stat_source", "stat", "value", "accession")
    assert ("barcode", "nExactMatch", "12", "SRR1_10xv2") in got and ("summary", "Number of Reads", "100", "SRR1_10xv2") in got
    assert len(got) == 5


def test_gene_tables(spark, tmp_path):
    sets = matrix.read_gene_sets(spark, {"female": put(tmp_path / "f.csv", "gene\nXist\n"), "male": put(tmp_path / "m.csv", "gene\nDdx3y\n")})
    assert rows(sets, "set_name", "symbol") == [("female", "Xist"), ("male", "Ddx3y")]
    cc = matrix.read_cell_cycle(spark, put(tmp_path / "cc.csv", "cluster,gene\n1,A\n2,B\n"))
    assert rows(cc, "set_name", "symbol") == [("cc_cluster_1", "A"), ("cc_cluster_2", "B"), ("cell_cycle", "A"), ("cell_cycle", "B")]
    ann = matrix.read_gene_annotation(spark, put(tmp_path / "g.tab", "2\nG1\tmt-A\trRNA\nG2\tB\tprotein\n"))
    assert rows(ann, "gene_id", "symbol", "type_") == [("G1", "mt-A", "rRNA"), ("G2", "B", "protein")]
    with gzip.open(tmp_path / "mk.csv.gz", "wt") as f:
        f.write("cell_type,group,gene,rank\nA,all,g,1\nA,all,h,101\n")
    assert rows(matrix.read_markers(spark, str(tmp_path / "mk.csv.gz")), "gene", "rank") == [("g", 1)]


def test_matrix_parts(spark, tmp_path):
    """Every border between parts, long comments, side files without a last line feed, numbers without a name."""
    d = tmp_path / "SRR7_10xv2_Solo.out"
    d.mkdir()
    entries = [(g, c, g * c) for c in range(1, 8) for g in range(1, 14, c)]
    put(d / "matrix.mtx", "%%MatrixMarket\n% " + "x" * 90 + f"\n13 7 {len(entries)}\n" + "".join(f"{g}{' ' * (1 + g % 2)}{c}\t{n}\n" for g, c, n in entries) + "99 1 5\n1 99 5")
    put(d / "features.tsv", "\n".join(f"G{i}\ts{i}\tx" for i in range(1, 14)))
    put(d / "barcodes.tsv", "".join(f"C{i}\n" for i in range(1, 8)))
    want = sorted((f"G{g}", f"C{c}", n) for g, c, n in entries)
    for split in (1, 7, 100, 1 << 20):
        m = matrix.read_matrices(spark, str(d), split)
        assert rows(m["counts"], "gene_id", "cell_id", "n") == want
        plan = m["counts"]._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Join" not in plan and plan.index("MapInArrow") < plan.index("Exchange")  # of parts, before they are read
    assert rows(m["features"], "idx", "gene_id")[-1] == (13, "G13") and m["barcodes"].count() == 7


def tar_of(path, members, mode="w"):
    with tarfile.open(path, mode) as tar:
        for name, data in members:
            about = tarfile.TarInfo(name)
            about.size = len(data)
            tar.addfile(about, io.BytesIO(data))


def test_archives(spark, tmp_path):
    fastq = lambda n, reads=1: "".join(f"@r{i}\n{'A' * n}\n+\n{'@' * n}\n" for i in range(reads)).encode()
    members = [("SRR1_2.fastq.gz", gzip.compress(fastq(98, 20_000))), ("SRR1_1.fastq", fastq(26)), ("SRR1_3.fastq.gz", gzip.compress(b""))]
    tar_of(tmp_path / "a.tar", members)
    tar_of(tmp_path / "b.tar.gz", [(n.replace("RR1", "RR2"), d) for n, d in members], "w:gz")
    tar_of(tmp_path / "c.tar", [])
    (tmp_path / "d.tar").write_bytes((tmp_path / "a.tar").read_bytes()[:700])
    (tmp_path / "e.tar").write_bytes(b"no archive")
    found = reads.archive_members(spark, str(tmp_path))
    by = {}
    for r in found.orderBy("archive", "at").collect():
        by.setdefault(r.archive[-5:].lstrip("/"), []).append((r.member, r.length, r.problem is None))
    assert by["a.tar"] == [("SRR1_2.fastq.gz", 98, True), ("SRR1_1.fastq", 26, True), ("SRR1_3.fastq.gz", None, False)]
    assert [x[1:] for x in by["ar.gz"]] == [x[1:] for x in by["a.tar"]]
    assert "c.tar" not in by and not any(x[2] for x in by["d.tar"] + by["e.tar"])
    lengths = {r.run_id: (r.nreads, r.read_lengths) for r in reads.archive_read_lengths(spark, str(tmp_path)).collect()}
    assert lengths == {"SRR1": (2, [26, 98]), "SRR2": (2, [26, 98])}
    roles = {r.archive[-5:]: (r.tech_read, r.bio_read) for r in reads.paired_members(found).collect()}
    assert roles["a.tar"] == roles["a.tar"] == ("SRR1_1.fastq", "SRR1_2.fastq.gz")


def test_archives_are_written_in_slices(spark, tmp_path):
    """Lines of one archive are sorted and packed by many tasks; their order and the members stay."""
    archive = F.when(F.col("id") % 10 == 0, "SRR2.tar").otherwise("SRR1.tar")
    member = F.concat(F.substring(archive, 1, 4), F.when(F.col("id") % 3 == 0, "_1.fastq.gz").otherwise("_2.fastq.gz"))
    lines = spark.range(5000).select(archive.alias("archive"), member.alias("member"), F.struct((-F.col("id")).alias("o")).alias("ord"),
                                     F.concat(F.lit("é"), F.col("id").cast("string")).alias("value"))
    written = sinks.write_archives(lines.union(lines.filter("ord.o > -30")), str(tmp_path / "a"), slice_rows=400)
    assert {tuple(r) for r in written.collect()} == {("SRR1.tar", 2), ("SRR2.tar", 2)}
    members = 0
    for name, own in (("SRR1", lambda i: i % 10), ("SRR2", lambda i: i % 10 == 0)):
        with tarfile.open(tmp_path / "a" / f"{name}.tar") as tar:
            assert tar.getnames() == [f"{name}_1.fastq.gz", f"{name}_2.fastq.gz"]
            for at, of in enumerate((lambda i: i % 3 == 0, lambda i: i % 3)):
                packed = tar.extractfile(f"{name}_{at + 1}.fastq.gz").read()
                members += packed.count(b"\x1f\x8b\x08\x00")
                got = gzip.decompress(packed).decode().splitlines()
                assert got == [f"é{i}" for i in range(4999, -1, -1) for _ in range(2 if i < 30 else 1) if own(i) and of(i)]
    assert members > 4  # gzip streams: no task held an archive, or a member, whole
    assert sinks.write_archives(lines.limit(0), str(tmp_path / "b")).count() == 0


def test_archive_skips_contents(tmp_path, monkeypatch):
    """Of a plain archive only headers and the beginning of each member are read."""
    import random
    big = gzip.compress(b"@r\nACGT\n+\nIIII\n" + random.Random(1).randbytes(3_000_000))
    tar_of(tmp_path / "big.tar", [(f"S_{i}.fastq.gz", big) for i in range(3)])
    seen = []
    real = files.open_file

    class Counting:
        def __init__(self, f):
            self.f = f

        def read(self, n=-1):
            data = self.f.read(n)
            seen.append(len(data))
            return data

        def __getattr__(self, name):
            return getattr(self.f, name)

        def __enter__(self):
            return self

        def __exit__(self, *a):
            self.f.close()

    monkeypatch.setattr(files, "open_file", lambda uri: Counting(real(uri)))
    out = list(reads._peek([pa.RecordBatch.from_pydict({"file": [str(tmp_path / "big.tar")]})]))
    assert out[0].column(3).to_pylist() == [4, 4, 4] and sum(seen) < 1_500_000 < 9_000_000


def test_fastq_lengths(spark, tmp_path):
    put(tmp_path / "SRR1_1.fastq", "@r1\nACGT\n+\nIIII\n@r2\nACGTACGT\n+\nIIIIIIII\n")
    put(tmp_path / "SRR1_2.fastq", "@r1\n" + "A" * 98 + "\n+\n" + "@" * 98 + "\n")
    got = reads.run_read_lengths(spark, str(tmp_path / "*.fastq")).collect()
    assert [(r.run_id, r.nreads, r.read_lengths) for r in got] == [("SRR1", 2, [4, 98])]


def test_sinks(spark, tmp_path):
    ids = spark.createDataFrame([("b",), ("a",), ("b",)], "id string")
    sinks.write_id_list(ids, str(tmp_path / "ids"))
    assert rows(tables.read_id_list(spark, str(tmp_path / "ids")), "id") == [("a",), ("b",)]
    old, new = spark.createDataFrame([("1", "x")], "k string, v string"), spark.createDataFrame([("1", "x", "n"), ("2", None, "n")], "k string, v string, w string")
    sinks.write_merged(old, new, str(tmp_path / "v2"))
    assert rows(spark.read.parquet(str(tmp_path / "v2")), "k", "v", "w") == [("1", "x", ""), ("1", "x", "n"), ("2", "", "n")]
    df = spark.createDataFrame([("P1", 1), ("P2", 2)], "proj_id string, v int")
    sinks.append_by_project(df, str(tmp_path / "bp"))
    sinks.append_by_project(df, str(tmp_path / "bp"))
    assert spark.read.parquet(str(tmp_path / "bp")).filter("proj_id = 'P1'").count() == 2
    sinks.write_results({"cells": df}, str(tmp_path / "res"))
    scan = sinks.read_results(spark, str(tmp_path / "res"), "cells").filter("proj_id = 'P2'")
    assert scan.count() == 1 and "PartitionFilters: [isnotnull(proj_id" in scan._jdf.queryExecution().toString()
    sinks.write_by_species(df.withColumn("organism", F.lit("mouse")), str(tmp_path / "sp"))
    assert spark.read.parquet(str(tmp_path / "sp")).filter("organism = 'mouse'").count() == 2
    sinks.write_histograms(df, str(tmp_path / "h"), text=True)
    assert spark.read.csv(str(tmp_path / "h"), sep="\t", header=True).count() == 2


def test_packages_are_written_compressed(spark, tmp_path):
    """Bounded compressed files, of which the reader makes the same rows as of plain text; null and repeated ids included."""
    ids = F.when(F.col("id") % 50 != 0, F.concat(F.lit("X"), (F.col("id") % 700).cast("string")))
    title = F.when(F.col("id") % 3 == 0, F.lit(" a <b> & \"c\"\n")).otherwise(F.lit("é" * 300))
    made = spark.range(0, 1000, 1, 2).select(
        F.struct(F.struct(ids.alias("PRIMARY_ID")).alias("IDENTIFIERS")).alias("EXPERIMENT"),
        F.struct(F.struct(F.col("id").cast("string").alias("PRIMARY_ID")).alias("IDENTIFIERS"), F.struct(title.alias("STUDY_TITLE")).alias("DESCRIPTOR")).alias("STUDY"))
    plain, small = str(tmp_path / "plain"), str(tmp_path / "small")
    made.write.format("xml").option("rootTag", "EXPERIMENT_PACKAGE_SET").option("rowTag", "EXPERIMENT_PACKAGE").save(plain)
    sinks.write_packages(made, small, file_rows=100)
    size = lambda folder: sum(r.length for r in files.listing(spark, folder).collect())
    assert size(small) < size(plain) / 4
    assert all(r.n <= 100 for r in packages.read_packages(spark, small).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect())
    text = lambda folder: sorted(r[0] for r in packages.read_packages(spark, folder).select(F.to_json(F.struct("*"))).collect())
    assert text(small) == text(plain) and len(text(small)) == 1000


@pytest.fixture(scope="module")
def order_tables(spark, tmp_path_factory):
    """A folder of the tables that make packages: 600 orders of 40 customers, a key repeated, one order without a key."""
    folder = tmp_path_factory.mktemp("orders")
    save = lambda df, name: df.coalesce(1).write.parquet(str(folder / f"{name}.parquet"))
    save(spark.sql("SELECT 0 AS r_regionkey, 'ASIA' AS r_name"), "region")
    save(spark.sql("SELECT 0 AS n_nationkey, 'JAPAN' AS n_name, 0 AS n_regionkey"), "nation")
    save(spark.range(40).selectExpr("id AS c_custkey", "0 AS c_nationkey", "'BUILDING' AS c_mktsegment"), "customer")
    save(spark.range(600).selectExpr(
        "CASE WHEN id = 599 THEN NULL ELSE id % 590 END AS o_orderkey", "id % 40 AS o_custkey", "DATE'1995-01-01' AS o_orderdate", "1.5D AS o_totalprice",
        "CASE WHEN id % 40 = 7 THEN 'P' ELSE 'F' END AS o_orderstatus", "'1-URGENT' AS o_orderpriority"), "orders")
    return str(folder)


@pytest.mark.parametrize("name", ["xml_experiments", "xml_pairs", "xml_samples", "xml_runs", "xml_quarantine", "xml_projects"])
def test_xml_queries_land_compressed_files(spark, order_tables, name):
    """What a query lands is smaller than the plain XML of its packages: 2.9 KB each."""
    from cellsurvey import session
    from cellsurvey.plans import catalog

    before = len(session._written)
    found = catalog.QUERIES[name](spark, order_tables)
    landed = [p for p in session._written[before:] if "packages-" in p]
    assert len(landed) == 1 and sum(r.length for r in files.listing(spark, *landed).collect()) < 600 * 500
    assert found.count() > 0

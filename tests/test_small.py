"""Readers and small operators that no query uses."""

import pytest
from pyspark.sql import functions as F

from strandloom.operators import annotate, filters, intervals, matrix, methylation, reads, sequence, sets, signal
from strandloom.sources import readers


def test_methylation_files(spark, tmp_path):
    (tmp_path / "a.cov").write_text("chr1\t5\t5\t75.0\t3\t1\nchr1\t9\t9\t0.0\t0\t2\n")
    (tmp_path / "a.cx").write_text("chr1\t5\t+\t3\t1\tCG\tCGA\n")
    assert [tuple(r) for r in readers.read_cov(spark, str(tmp_path / "a.cov")).collect()] == [("chr1", 5, 5, 75.0, 3, 1), ("chr1", 9, 9, 0.0, 0, 2)]
    assert tuple(readers.read_cx_report(spark, str(tmp_path / "a.cx")).first()) == ("chr1", 5, "+", 3, 1, "CG", "CGA")


def test_other_files(spark, tmp_path):
    (tmp_path / "s").write_text("chr1\t1000\n")
    (tmp_path / "b").write_text("chr1\t1\t5\tchr2\t7\t9\tn\t3\t+\t-\n")
    (tmp_path / "c.csv").write_text("Chromosome,Strand,ClusterStart,ClusterEnd,ClusterID,ReadCount,ConversionLocationCount,ConversionEventCount,Repeat\nchr1,+,10,20,k,30,2,5,\nchr1,-,0,9,l,30,2,5,L1\nchr1,-,1,9,m,1,2,5,\n")
    r = readers.read_chrom_sizes(spark, str(tmp_path / "s")).first()
    assert r.chrom == "chr1" and int(r.length) == 1000
    assert tuple(readers.read_bedpe(spark, str(tmp_path / "b")).select("chrom1", "start1", "end2", "strand2").first()) == ("chr1", 1, 9, "-")
    found = readers.read_cluster_csv(spark, str(tmp_path / "c.csv"), 1, 5, 10, drop_repeats=True).collect()
    assert [tuple(x) for x in found] == [("chr1", 9, 20, "k", 30.0, "+")]


def test_sorting_by_a_list_of_chromosomes(spark):
    df = spark.createDataFrame([("c1", 5, 6), ("c2", 1, 2), ("c1", 2, 3), ("c9", 0, 1)], "chrom string, start long, end long")
    assert [(r.chrom, r.start) for r in intervals.sort_genomic(df, ["c2", "c1"]).collect()] == [("c2", 1), ("c1", 2), ("c1", 5)]
    assert [r.chrom for r in intervals.sort_genomic(df).collect()] == ["c1", "c1", "c2", "c9"]
    assert {(r.chrom, r.start): r.number for r in intervals.genomic_number(df).collect()} == {("c1", 2): 1, ("c1", 5): 2, ("c2", 1): 3, ("c9", 0): 4}


def test_small_columns(spark):
    one = spark.createDataFrame([("r#ACG/1", "control", 2.0), ("r", "treat", None), ("r", "shared", 1.0)], "name string, label string, log2fc double")
    assert [r[0] for r in one.select(reads.umi_from_name(F.col("name"), 5)).collect()] == ["ACGNN", None, None]
    assert [r.log2fc for r in filters.one_sided_fold(one).collect()] == [-99.0, 99.0, 1.0]
    long = spark.createDataFrame([("g", "a", 1.0), ("g", "b", 2.0)], "id string, sample string, value double")
    design = spark.createDataFrame([("a", "x")], "sample string, factor string")
    assert [tuple(r) for r in matrix.attach_design(long, design).select("id", "sample", "factor").collect()] == [("g", "a", "x")]
    assert sets.pool([long, long]).count() == 4


def test_tracks_and_bases(spark):
    track = lambda v: spark.createDataFrame([("c", i, x) for i, x in enumerate(v)], "chrom string, start long, v double")
    r = signal.track_correlation(track([1.0, 2.0, 3.0]), track([2.0, 4.0, 6.5, 1.0]), "v").first()
    assert r.n == 3 and r.r == pytest.approx(0.9971, abs=1e-3)
    seqs = lambda s: spark.createDataFrame([("x", s)], "id string, seq string")
    got = {r.kmer: r.ratio for r in sequence.nucleotide_coverage(seqs("AAC"), seqs("ACGT")).collect()}
    assert got["A"] == pytest.approx((2 / 3) / (1 / 4)) and got["AC"] == pytest.approx((1 / 2) / (1 / 3)) and got["G"] is None
    cc = spark.createDataFrame([(0, 0.1), (50, 0.5), (100, 0.3)], "shift int, r double")
    s = reads.cross_correlation_summary(cc, 100).first()
    assert s.fragment == 50 and s.nsc == pytest.approx(5.0) and s.rsc == pytest.approx(2.0)


def test_calls_without_ends_and_overlaps(spark):
    rows = [("q", 1, "c", 10, "zZxhZz", "6M", "+"), ("q", 2, "c", 13, "ZZzzxX", "6M", "-"), ("r", 1, "c", 1, "zz", "2M", "+")]
    df = spark.createDataFrame(rows, "qname string, mate int, chrom string, pos long, xm string, cigar string, strand string")
    got = lambda **o: {(r.qname, r.mate, r.pos, r.call) for r in methylation.extract_calls(df, **o).collect()}
    plain = {(q, m, p + i, x) for q, m, _, p, xm, _, _ in rows for i, x in enumerate(xm)}
    assert got() == plain
    assert got(no_overlap=True) == {x for x in plain if not (x[:2] == ("q", 2) and 10 <= x[2] < 16)}
    assert got(ignore5=2, ignore3=1) == {("q", 1, 12, "x"), ("q", 1, 13, "h"), ("q", 1, 14, "Z"), ("q", 2, 14, "Z"), ("q", 2, 15, "z"), ("q", 2, 16, "z")}
    calls = spark.createDataFrame([("CG", 1, 0, True), ("CG", 2, 1, False)], "context string, mate int, read_pos long, meth boolean")
    assert {(r.mate, r.read_pos, r.coverage) for r in methylation.mbias(calls, ["context", "mate"]).collect()} == {(1, 0, 1), (2, 0, 0), (2, 1, 1)}


def test_overhang_walk(spark):
    rows = [("k", "a", "TSS", 5), ("k", "b", "overlay", 3), ("k", "c", "whole", 9), ("k", "d", "TTS", 9), ("l", "z", "TSS", -4)]
    got = {r.key: (r.transcript, r.kind) for r in annotate.best_overhang(spark.createDataFrame(rows, "key string, transcript string, kind string, overhang int"), ["key"]).collect()}
    assert got == {"k": ("c", "whole"), "l": ("z", "TSS")}

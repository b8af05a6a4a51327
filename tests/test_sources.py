import gzip

import pytest

from strandloom.operators import reads as R
from strandloom.sources import readers as S
from strandloom.streaming.counts import windowed_counts


@pytest.fixture
def put(tmp_path):
    def write(name, text):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        (gzip.open(p, "wt") if name.endswith(".gz") else open(p, "w")).write(text)
        return str(p)

    return write


def test_bed(spark, put):
    p = put("a.bed", "#h\nchr1\t5\t9\tx\t1.5\t+\nchr1\tbad\t9\tx\t1\t+\nchr2\t1\nchr1\t9\t5\ty\t1\t-\n")
    assert [tuple(r) for r in S.read_bed(spark, p).collect()] == [("chr1", 5, 9, "x", 1.5, "+")]
    assert S.count_bad_lines(spark, p) == 3


def test_bed12(spark, put):
    p = put("a.bed", "chr1\t10\t50\tg:n:t\t0\t-\t12\t40\t0\t2\t5,6,\t0,34,\nchr1\t10\t50\tg\t0\t-\t12\t40\t0\t2\t5,\t0,34,\n")
    r = S.split_name(S.read_bed12(spark, p), ["gene", "name2"]).collect()
    assert len(r) == 1 and [tuple(b) for b in r[0].blocks] == [(10, 15), (44, 50)] and r[0].name2 == "n"


def test_fasta_and_fastq(spark, put):
    fa = put("g.fa", ">chr1 d > e\nACG\nT\n>chrUn\nGG\n")
    assert [tuple(r) for r in S.read_fasta(spark, fa).orderBy("id").collect()] == [("chr1", "ACGT"), ("chrUn", "GG")]
    assert S.read_fasta(spark, fa, r"^chr\d+$").count() == 1
    fq = put("r.fq.gz", "".join(f"@r{i} x\nACGT\n+\n@@I{chr(33 + i)}\n" for i in range(20)) + "@cut\nAC\n")
    got = {r.id: (r.seq, r.qual) for r in S.read_fastq(spark, fq).collect()}
    assert len(got) == 20 and got["r7"] == ("ACGT", "@@I(")


def test_sam(spark, put):
    p = put("a.sam", "@HD\tx\nq1\t16\tchr1\t11\t60\t5M2D3M1I\t*\t0\t0\tACGTACGTA\tIIIIIIIII\tXM:Z:..z.\tNM:i:2\n")
    df = S.read_sam(spark, p)
    assert df.first().tags == {"XM": "..z.", "NM": "2"}
    assert [tuple(r) for r in R.alignments_to_bed(df).collect()] == [("chr1", 10, 20, "q1", 60, "-")]
    assert R.alignments_to_bed(df, five_prime=True).first().start == 19


def test_annotation_files(spark, put):
    gtf = put("a.gtf", 'chr1\tx\texon\t11\t20\t.\t+\t.\tgene_id "G1"; transcript_id "T1"; gene_name "N";\nchr1\tx\tCDS\t1\t2\t.\t+\t.\tgene_id "G";\n')
    r = S.read_gtf(spark, gtf).collect()
    assert len(r) == 1 and (r[0].start, r[0].end, r[0].gene_id, r[0].transcript_id, r[0].gene_type) == (10, 20, "G1", "T1", None)
    gff = put("m.gff3", "chr1\t.\tmiRNA_primary_transcript\t5\t9\t.\t-\t.\tID=MI1;Name=mir-1\nchr1\t.\tmiRNA\t6\t8\t.\t-\t.\tID=MA1;Name=miR-1;Derives_from=MI1\n")
    primary, mature = S.read_gff3_mirna(spark, gff), S.read_gff3_mirna(spark, gff, "mature")
    assert primary.first().name == "MI1:mir-1:NA:miRNA_primary_transcript"
    assert {(r.feature, r.gene_name) for r in S.mirna_to_gtf(mature, primary).collect()} == {(f, "mir-1") for f in ("gene", "transcript", "exon")}
    info = put("gene_info", "9606\t1\tA1BG\t-\tA1B|ABG\tMIM:1|Ensembl:ENSG01|X:2\t19\t19q\tdesc\tprotein\n9606\t2\tX\t-\t-\t-\t1\t1\t-\tncRNA\n")
    assert [r.gene_id for r in S.read_gene_info(spark, info).orderBy("symbol").collect()] == ["ENSG01", None]


def test_results_and_metrics(spark, put, tmp_path):
    put("res/a/s1.tsv", "id\tcount\ng1\t5\n")
    put("res/b/s2.tsv", "id\tcount\ng1\t7\n")
    put("res/b/skip.tsv", "id\tcount\ng1\t7\n")
    got = S.read_results_dir(spark, str(tmp_path / "res"), "*.tsv", drop="^skip").collect()
    assert sorted((r.sample, r["count"]) for r in got) == [("s1", "5"), ("s2", "7")]
    put("log/x.flagstat.txt", "2826233 + 0 in total (QC)\n10 + 0 duplicates\n20 + 0 mapped (1%)\n5 + 0 singletons (0.1%)\n")
    m = S.collect_tool_metrics(spark, str(tmp_path / "log"), "flagstat")
    assert {r.metric: r.value for r in m.collect()} == {"total": "2826233", "duplicates": "10", "mapped": "20", "singletons": "5"}
    assert S.merge_qc_summary(m, ["total", "mapped"]).first().mapped == "20"
    put("pbc/y.txt", "15000000 13712402 12906914 597438 0.914160 0.941258 21.603771\n")
    assert {r.metric: r.value for r in S.collect_tool_metrics(spark, str(tmp_path / "pbc"), "pbc").collect()}["pbc2"] == "21.603771"


def test_cycles_and_calls(spark, put):
    p = put("c.txt", "Segment\t1\tchr1\t10\t20\nSegment\t2\tchr1\t30\t40\nCycle=1;Copy_count=2.5;Segments=0+,1+,2-,0-\nCycle=2;Copy_count=2.5;Segments=0+,1+,2-,0-\n")
    seg, steps = S.read_cycles(spark, p)
    assert seg.count() == 2 and [(r.segment, r.strand) for r in steps.orderBy("ord").collect()] == [(1, "+"), (2, "-")]
    calls = put("calls", "version 1\nr1\t+\tchr1\t5\tZ\nr1\t-\tchr1\t6\tz\n")
    assert [r.meth for r in S.read_meth_calls(spark, calls).orderBy("pos").collect()] == [True, False]


def test_writers(spark, put, tmp_path):
    df = spark.createDataFrame([("1", 1, 2, 3.0), ("MT", 1, 2, 4.0)], "chrom string, start long, end long, v double")
    S.write_bedgraph(S.to_ucsc_names(df), str(tmp_path / "bg"), "v")
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "bg")).collect()) == ["chr1\t1\t2\t3.0", "chrM\t1\t2\t4.0"]
    S.write_fasta_by_chrom(spark.createDataFrame([("chr1", "AC"), ("other", "G")], "id string, seq string"), str(tmp_path / "fa"))
    assert S.read_fasta(spark, str(tmp_path / "fa")).count() == 1


def test_stream(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = windowed_counts(stream, "ts", ["event_type"]).writeStream.outputMode("complete").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("counts").selectExpr("sum(n)").first()[0] == events.count()

"""Cases made by hand from the stated rules, and loops over random rows."""

import random

import pytest
from pyspark.sql import functions as F

from strandloom.operators import matrix, methylation, reads, sets, signal, splicing, stats


def test_difference_of_levels_at_a_tie(spark):
    """(0.5 + 0.0) / 2 - (0.079 + 0) / 2 and the like: halves of a thousandth go away from zero."""
    rows = [([0.5, 0.0], [0.157, 0.0]), ([0.157, 0.0], [0.5, 0.0]), ([0.1, None], [0.1]), ([None], [0.1]), ([1.0, 0.0, 0.0], [0.0])]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>")
    got = [r[0] for r in df.select(splicing._difference(F.col("a"), F.col("b"))).collect()]
    assert got == [0.172, -0.172, 0.0, None, 0.333]


def test_colour_bands(spark):
    want = {0: "0,255,0", 5: "0,255,0", 6: "55,255,0", 8: "55,255,0", 15: "55,255,0", 16: "105,255,0", 25: "105,255,0", 26: "155,255,0", 45: "205,255,0", 46: "255,255,0", 55: "255,255,0", 56: "255,205,0", 75: "255,155,0", 76: "255,105,0", 95: "255,55,0", 96: "255,0,0", 100: "255,0,0"}
    df = spark.createDataFrame([(k,) for k in want], "pct int")
    assert dict(map(tuple, df.select("pct", methylation.rgb_by_percent(F.col("pct"))).collect())) == want


def test_read_classes(spark):
    rows = [("a", True, "CG")] * 9 + [("a", False, "CG")] + [("b", True, "CHH")] * 20 + [("b", False, "CG")] * 5 + [("c", True, "CG")] * 4 + [("d", True, "CG")] * 1 + [("d", False, "CG")] * 15
    df = spark.createDataFrame(rows, "read string, meth boolean, context string")
    got = {r.read: (r.calls, r.pct, r["class"]) for r in methylation.classify_reads(df).collect()}
    assert got == {"a": (10, 90.0, "all_meth"), "b": (5, 0.0, "all_unmeth"), "c": (4, 100.0, "discarded"), "d": (16, 6.3, "all_unmeth")}
    both = {r.read: r["class"] for r in methylation.classify_reads(df, 5, 90.0, 10.0).collect()}
    assert both["a"] == "all_unmeth"  # the lower bound comes first


def test_duplicates_by_last_base(spark):
    """Two truncated copies of one minus fragment, and two fragments that only begin at one place."""
    rows = [(1, "r1", 16, "c", 100, "50M"), (2, "r2", 16, "c", 110, "40M"), (3, "r3", 0, "c", 100, "50M"), (4, "r4", 0, "c", 100, "30M"), (5, "r5", 16, "c", 100, "20M5D20M"), (6, "r6", 16, "c", 100, "3S20M4I30M")]
    df = spark.createDataFrame(rows, "id long, qname string, flag int, rname string, pos long, cigar string")
    kept = reads.deduplicate(reads.duplicate_key(df), ["rname", "dup_strand", "dup_start"], ["id"])
    assert sorted(r.id for r in kept.collect()) == [1, 3, 5]
    four = df.withColumn("conversion", F.when(F.col("id") % 2 == 0, "CTOB").otherwise("OT"))
    assert reads.duplicate_key(four).select("dup_strand").distinct().count() == 2
    assert reads.deduplicate(reads.duplicate_key(four), ["rname", "dup_strand", "dup_start"], ["id"]).count() == 3  # OT at 100, CTOB at 100 and 110


def test_duplicate_pairs(spark):
    """Mates share a fragment: equal starts with other ends are no duplicates, whichever mate is asked first."""
    rows = []
    for i, (start, end, flip) in enumerate([(10, 200, 0), (10, 200, 0), (10, 230, 0), (10, 200, 1)]):
        left, right = (64, 128 + 16) if not flip else (128, 64 + 16)
        rows += [(2 * i, f"q{i}", 1 + left, "c", start, "50M"), (2 * i + 1, f"q{i}", 1 + right, "c", end - 49, "50M")]
    df = spark.createDataFrame(rows, "id long, qname string, flag int, rname string, pos long, cigar string")
    assert sorted(r.id for r in reads.deduplicate_pairs(df, "id").collect()) == [0, 1, 4, 5, 6, 7]


def test_p_histogram_and_bins(spark):
    df = spark.createDataFrame([(0.0, 2.0), (0.05, 2.0), (0.051, 2.0), (1.0, 5.0), (0.5, 1.0), (None, 9.0)], "p double, mean double")
    assert {r.bin: r.n for r in stats.p_histogram(df).collect()} == {0: 2, 1: 1, 19: 1}
    means = [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0]
    df = spark.createDataFrame([(0.01 if m == 7 else 0.5, m) for m in means] + [(None, 7.0)], "p double, mean double")
    got = {r.bin: (r.share, r.n) for r in stats.binned_small_p(df, "mean").collect()}
    assert sum(n for _, n in got.values()) == 8 and got[0] == (0.0, 1) and set(got) == set(range(7)) - {k for k in range(7) if k not in got}
    res = spark.createDataFrame([(1, 0.04, 0.05), (2, 0.01, 0.049), (3, 0.001, 0.049)], "id long, p double, padj double").withColumn("log2fc", F.lit(1.0))
    assert [r.id for r in stats.significant(res).collect()] == [3, 2]


def test_splicing_per_gene(spark):
    rows = [("g", "G", "SE", 0.0), ("g", "G", "SE", -0.3), ("g", "G", "SE", 0.3), ("h", "H", "RI", -0.1), ("h", "H", "RI", None)]
    out = {r.gene: r.asDict() for r in matrix.integrate_splicing(spark.createDataFrame(rows, "gene string, name string, kind string, diff double"), ["RI", "SE"]).collect()}
    assert out["g"] == {"gene": "g", "name": "G", "RI_up": 0, "RI_down": 0, "RI_top": 0.0, "SE_up": 2, "SE_down": 1, "SE_top": 0.3}
    assert out["h"]["RI_down"] == 1 and out["h"]["RI_up"] == 0 and out["h"]["RI_top"] == -0.1 and out["h"]["SE_top"] == 0.0


def _left_to_right(sites, distance, width):
    merged = []
    for a, b in sorted(sites):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    out, left = [], None
    for a, b in merged:
        if left and a - left[1] <= distance and (left[1] - left[0] < width or b - a < width):
            left = [left[0], b]
            continue
        if left:
            out.append(tuple(left))
        left = [a, b]
    return [x for x in [*out, *([tuple(left)] if left else [])] if x[1] - x[0] >= width]


@pytest.mark.parametrize("seed", range(4))
def test_hotspots_from_left_to_right(spark, monkeypatch, seed):
    from strandloom.operators import scans

    monkeypatch.setattr(scans.in_cells, "__defaults__", (*scans.in_cells.__defaults__[:-1], 37))
    r = random.Random(seed)
    sites = [(a := r.randrange(1500), a + r.choice([1, 2, 4, 9, 15, 30])) for _ in range(90)]
    df = spark.createDataFrame([("c", *x, 0.01) for x in sites] + [("c", 0, 3000, 0.9)], "chrom string, start long, end long, q double")
    got = sorted((x.start, x.end) for x in signal.hotspot_merge(df, 8, 12, "q", 0.05).collect())
    assert got == _left_to_right(sites, 8, 12)


def test_centromeres(spark):
    rows = [("a", 100, 200), ("a", 150, 400), ("a", 500, 600), ("b", 7, 9)]
    got = {x.chrom: (x.start, x.end) for x in sets.centromere_spans(spark.createDataFrame(rows, "chrom string, start long, end long"), 50).collect()}
    assert got == {"a": (100 - 100, 650), "b": (7, 9)}


def test_bad_spots_and_cuts(spark):
    counts = spark.createDataFrame([("c", 100, 8), ("c", 160, 2), ("d", 100, 9), ("d", 160, 1)], "chrom string, start long, n long")
    assert sorted((x.chrom, x.start) for x in signal.filter_bad_spots(counts).collect()) == [("c", 100), ("c", 160), ("d", 160)]  # 8 of 10.01 stays
    cuts = signal.read_cuts(spark.createDataFrame([("c", 5, 9, "+"), ("c", 5, 9, "-")], "chrom string, start long, end long, strand string"))
    assert sorted((x.start, x.end) for x in cuts.collect()) == [(5, 6), (9, 10)]


def test_mott_trim_by_hand(spark):
    # From the 3' end with cutoff 20: sums 0, -18, -28, -8, 12 are least behind the third letter.
    df = spark.createDataFrame([(1, "ACGTA", "II+#5"), (2, "ACG", "III"), (3, "NNA", "II#"), (4, "", ""), (5, None, None)], "id long, seq string, qual string")
    got = {x.id: x.seq for x in reads.mott_trim(df).collect()}
    assert got == {1: "AC", 2: "AC"}
    assert {x.id: x.seq for x in reads.mott_trim(df, cutoff=2).collect()} == {1: "ACGTA", 2: "ACG"}


def test_mott_trim_pairs(spark):
    one = spark.createDataFrame([(1, "ACG", "III"), (2, "ACG", "###"), (3, "ACG", "III"), (None, "ACG", "III")], "id long, seq string, qual string")
    two = spark.createDataFrame([(1, "TTT", "II#"), (2, "TTT", "III"), (4, "NNN", "III")], "id long, seq string, qual string")
    rows = lambda **k: sorted(((x.id, x.seq1, x.seq2) for x in reads.mott_trim_pairs(one, two, **k).collect()), key=str)
    assert rows() == [(1, "AC", "TT")]
    assert rows(singles=True) == [(1, "AC", "TT"), (2, None, "TT"), (3, "AC", None)]


def test_single_and_orphan_reads(spark):
    rows = [("a", 0, 30, 1), ("b", 0, 5, 1), ("c", 1, 30, 1), ("d", 4, 30, 1), ("e", 2, 30, 1), ("e", 16, 30, 9)]
    df = spark.createDataFrame([(q, f, "c", m, 0, n) for q, f, m, n in rows], "qname string, flag int, rname string, mapq int, tlen int, nm int")
    got = sorted((x.qname, x.flag, x.qc_flag) for x in reads.flag_read_pairs(df).collect())
    assert got == [("a", 0, 0), ("b", 0, 512), ("c", 1, 513), ("d", 4, 516), ("e", 2, 0), ("e", 16, 528)]


def test_fragments_across_chromosomes_and_nulls(spark):
    rows = [("a", 1, "c", 0, 5, "+"), ("a", 2, "c", 8, 12, "-"), ("b", 1, "c", 0, 5, "+"), ("b", 2, "d", 0, 5, "-"), ("s", None, "c", 0, 5, "-"), (None, 1, "c", 0, 5, "+")]
    df = spark.createDataFrame(rows, "qname string, mate int, chrom string, start long, end long, strand string")
    blocks = spark.createDataFrame([("x", "c", 0, 4, "+"), ("x", "c", 6, 20, "+"), ("y", "c", 11, 20, "-"), ("z", "e", 0, 9, "+")], "id string, chrom string, start long, end long, strand string")
    n = lambda **k: {x.id: x.n for x in reads.fragment_counts(df, blocks, **k).collect()}
    assert n() == {"x": 2, "y": 1, "z": 0}
    assert n(strand="same") == {"x": 1, "y": 0, "z": 0}
    assert n(strand="opposite") == {"x": 1, "y": 1, "z": 0}
    assert n(fractional=True) == {"x": 1.5, "y": 0.5, "z": 0}
    assert n(unique=True) == {"x": 1, "y": 0, "z": 0}

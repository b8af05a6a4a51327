"""Steps of table queries that were mended together: what their plans read and move, with small results by hand."""

def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _spans(spark, *rows):
    return spark.createDataFrame(rows, "id long, chrom string, start long, end long")


def test_bins_are_plain_arithmetic(spark):
    from strandloom.operators import intervals

    a = _spans(spark, (1, "c", 0, 9), (2, "c", 500, 9000), (3, "c", 8999, 70000))
    got = intervals.intersect(a, _spans(spark, (7, "c", 8, 600), (8, "c", 69999, 70001), (9, None, 0, 9)))
    assert sorted((r.id, r.b_id, r.start, r.end) for r in got.collect()) == [(1, 7, 8, 9), (2, 7, 500, 600), (3, 8, 69999, 70000)]
    bins = [x for x in _plan(got).splitlines() if "Generate explode" in x]
    assert len(bins) == 2 and not [x for x in bins if "lambda" in x]


def test_fractional_counts_join_once(spark):
    from strandloom.operators import reads

    genes = _spans(spark, (1, "c", 0, 10), (2, "c", 5, 20), (3, "d", 0, 9))
    got = reads.feature_counts(_spans(spark, (1, "c", 6, 8), (2, "c", 0, 2), (None, "c", 0, 2)), genes, True)
    assert {r.id: r.n for r in got.collect()} == {1: 1.5, 2: 0.5, 3: 0.0}
    assert _plan(got).count("Generate explode") == 2


def test_spliced_pieces_are_grouped_once(spark):
    from strandloom.operators import spliced

    seqs = spark.createDataFrame([("c", "ACGTTGCATTACAGGA")], "id string, seq string")
    rows = [(1, "c", "+", [(0, 6), (9, 12)]), (2, "c", "-", [(2, 5), (5, 5), (14, 16)]), (3, "c", "+", [(0, 2), (90, 95)]), (4, "d", "+", [(0, 2)]), (5, "c", "+", [])]
    got = spliced.extract_spliced(spark.createDataFrame(rows, "id long, chrom string, strand string, blocks array<struct<start: long, end: long>>"), seqs, size=4)
    assert {r.id: r.seq for r in got.collect()} == {1: "ACGTTGTAC", 2: "TCAAC", 3: None, 4: None, 5: None}
    assert _plan(got).count("Aggregate [") == 1


def test_mott_sums_are_arrays_of_numbers(spark):
    from strandloom.operators import reads

    rows = [(1, "ACGTA", "IIII#"), (2, "ACGTA", "#####"), (3, "NNN", "III"), (4, "", ""), (5, None, None), (6, "ACGT" * 30000, "I" * 100000 + "#" * 20000)]
    got = reads.mott_trim(spark.createDataFrame(rows, "id long, seq string, qual string"))
    assert sorted((r.id, len(r.seq), len(r.qual)) for r in got.collect()) == [(1, 4, 4), (6, 100000, 100000)]
    assert "lambda" not in _plan(got)


def test_edges_join_inside_genes_only(spark, monkeypatch):
    from strandloom.operators import intervals, pooling

    rows = [(f"{g}{k}", g, "c", s, [(10 * k, 10 * k + 15)]) for g in ("a", "b", None) for k in range(3) for s in ("+",)] + [("ax", "a", "c", "-", [(0, 99)]), ("ay", "a", "c", ".", [(0, 99)]), ("az", "a", "c", ".", [(0, 99)])]
    seen, join = [], intervals.overlap_join
    monkeypatch.setattr(intervals, "overlap_join", lambda *a, **k: seen.append(join(*a, **k)) or seen[-1])
    got = pooling.overlap_edges(spark.createDataFrame(rows, "id string, gene string, chrom string, strand string, blocks array<struct<start: long, end: long>>"))
    assert sorted(tuple(r) for r in got.collect()) == [("a0", "a1"), ("a1", "a2"), ("b0", "b1"), ("b1", "b2")]
    # Each peak with itself, and both ways with its neighbours of the same gene and strand.
    assert seen[0].count() == 7 + 8


def test_sites_are_grouped_once(spark):
    from strandloom.operators import sets

    rows = [(2, "c", 1, 2, "+", 5, "a", "x"), (1, "c", 1, 2, "+", 9, "b", "x"), (3, "c", 1, 2, "+", 7, "a", None), (4, "c", 1, 2, "-", 1, None, "y")]
    got = sets.integrate_sites(spark.createDataFrame(rows, "id long, chrom string, start long, end long, strand string, reads long, replicate string, kind string"))
    assert sorted((r.strand, r.reads, r.replicates, r.kinds, r.ids) for r in got.collect()) == [("+", 9, 2, "x", "1,2,3"), ("-", 1, 0, "y", "4")]
    assert _plan(got).count("Aggregate [") == 1 and "distinct" not in _plan(got) and got.schema["replicates"].dataType.simpleString() == "bigint"


def test_best_scores_move_pieces(spark):
    from strandloom.operators import sets

    rows = [("c", "+", 3, 1020, 1030), ("c", "+", 7, 1023, 1025), ("c", "+", 9, 5, 5), ("c", "-", 1, 0, 2), ("c", "+", 2, 1020, 1030)]
    got = sets.best_score_per_position(spark.createDataFrame(rows, "chrom string, strand string, score long, start long, end long"))
    want = {("+", p): 7 if p in (1023, 1024) else 3 for p in range(1020, 1030)} | {("-", 0): 1, ("-", 1): 1}
    assert sorted((r.strand, r.pos, r.score) for r in got.collect()) == sorted((*k, v) for k, v in want.items())


def test_unique_and_shared_peaks_join_twice(spark, monkeypatch):
    from strandloom.operators import intervals, sets

    seen, join = [], intervals.overlap_join
    monkeypatch.setattr(intervals, "overlap_join", lambda *a, **k: seen.append(1) or join(*a, **k))
    c, t = _spans(spark, (1, "c", 0, 10), (2, "c", 50, 60), (3, None, 0, 9)), _spans(spark, (4, "c", 1, 9), (5, "c", 80, 90))
    got = sets.unique_and_shared_peaks(c, t, _spans(spark, (6, "c", 0, 10), (7, "c", 51, 60), (8, "c", 80, 88), (9, "c", 84, 200)))
    assert sorted((r.label, r.id) for r in got.collect()) == [("control", 2), ("control", 3), ("shared", 6), ("shared", 9), ("treat", 5)]
    assert len(seen) == 2


def test_greedy_rounds_write_a_pair_once(spark, monkeypatch):
    from strandloom.operators import signal

    seen, written = [], signal.written
    monkeypatch.setattr(signal, "written", lambda df, label: seen.append((label, written(df, label))) or seen[-1][1])
    rows = [(k, "c", 10 * k, 10 * k + 15, s) for k, s in enumerate((5, 9, 4, 8, 8, 1))]
    got = signal.greedy_peaks(spark.createDataFrame(rows, "id long, chrom string, start long, end long, score long"))
    assert sorted(r.id for r in got.collect()) == [1, 3, 5]
    assert next(df for label, df in seen if label == "overlaps").count() == 5


def test_placement_reads_a_written_density(spark, sf):
    from strandloom.plans import circle_queries

    assert _plan(circle_queries._placed(spark, sf, True)).count("l_partkey") == 0

"""Steps that move rows once, seen in their plans."""

import re

import numpy as np
from pyspark.sql import functions as F

from strandloom.operators import circles, intervals, matrix, metagene, methylation, reads, scans, sequence, sets


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_short_sequences_are_one_join(spark):
    seqs = spark.createDataFrame([("c", "ACGT" * 40 + "GATTACA"), ("e", "")], "id string, seq string")
    sites = [("c", 0, 4, "+"), ("c", 2, 4, "-"), ("c", 160, 163, "+"), ("c", 165, 170, "+"), ("c", 156, 162, "+"), ("e", 0, 3, "+")]
    bed = spark.createDataFrame(sites, "chrom string, start long, end long, strand string")
    got = sequence.short_sequence(bed, seqs, 5, size=32)
    want = {(0, 4): "ACGT", (2, 4): "AC", (160, 163): "GAT", (165, 170): "CA", (156, 162): "ACGTG"}
    assert {(r.start, r.end): r.seq for r in got.collect()} == want
    kept = sequence.filter_bed_by_sequence(bed, seqs, "CA")
    assert [r.start for r in kept.collect()] == [165] and "Aggregate" not in _plan(kept) and _plan(kept).count("Join") == 1


def test_metagene_joins_hits_once(spark):
    hits = spark.createDataFrame([("s", 1, "b", 9, 3), ("s", 1, "a", 9, 2), ("s", 1, "a", 9, 1), ("s", 2, "b", 9, 1), ("s", 2, "a", 8, 1)], "sample string, peak long, b_id string, b_size long, overlap long")
    best = metagene.best_transcript(hits)
    assert sorted((r.peak, r.b_id, r.overlap) for r in best.collect()) == [(1, "a", 1), (1, "a", 2), (2, "b", 1)] and "Join" not in _plan(best)


def test_rollup_counts_a_peak_once_per_cycle(spark):
    segments = spark.createDataFrame([(1, "x", "c", 0, 50), (1, "x", "c", 0, 50), (1, "x", "c", 10, 40), (1, "x", "c", 20, 90), (1, "x", "c", 30, 60), (2, "x", "c", 35, 45)], "cycle long, class string, chrom string, start long, end long")
    peaks = spark.createDataFrame([(1, "f", "c", 36, 38), (2, "f", "c", 12, 30), (3, "f", "c", 55, 80), (4, "f", "c", 15, 70), (5, "f", "d", 0, 5)], "id long, factor string, chrom string, start long, end long")
    repeats = spark.createDataFrame([("k", "c", 37, 60), ("k", "c", 37, 38), ("l", "c", 0, 13), ("m", "d", 0, 9)], "kind string, chrom string, start long, end long")
    got = circles.factor_class_rollup(segments, peaks, repeats)
    assert sorted((r.repeat, r.cycles, r.bound, r.peaks, round(r.repeat_percent, 6)) for r in got.collect()) == [("k", 2, 2, 4, 75.0), ("l", 2, 2, 4, 25.0), ("m", 2, 2, 4, 0.0)]
    # No row per peak and cycle is moved: what is grouped by the cycle is counts.
    grouped = [x.split("Aggregate [")[1].split("]")[0] for x in _plan(got).splitlines() if "Aggregate [" in x]
    assert not [g for g in grouped if "cycle#" in g and any(k.strip().startswith("id#") for k in g.split(","))]


def test_wobble_scans_places_and_not_contacts(spark, monkeypatch):
    at = [(10, 3), (10, 3), (10, 3), (12, 3), (12, 40), (14, 5), (30, 3), (30, 6), (30, 9), (30, 14), (None, 3)]
    rows = [(k * len(at) + i, "a", x, c, y) for k in range(20) for i, (x, y) in enumerate(at) for c in ("b", "a")]
    rows = [(2 * i + (c == "a"), a, x, c, y) for i, a, x, c, y in rows]
    seen, islands = [], scans.islands
    monkeypatch.setattr(scans, "islands", lambda df, *args, **kw: seen.append(df.count()) or islands(df, *args, **kw))
    got = sets.contact_dedup(spark.createDataFrame(rows, "id long, chrom1 string, pos1 long, chrom2 string, pos2 long"), wobble=4)
    known = []
    for i, a, x, c, y in sorted(r for r in rows if r[2] is not None):
        p, q = sorted(((a, x), (c, y)))
        known.append((p[0], q[0], p[1], q[1], i))
    near = lambda values: {v: sum(b - a > 4 for a, b in zip(values, values[1:]) if b <= v) for v in values}
    groups = {}
    for pair in {k[:2] for k in known}:
        mine = [k for k in known if k[:2] == pair]
        one = near(sorted({k[2] for k in mine}))
        for g in set(one.values()):
            two = near(sorted({k[3] for k in mine if one[k[2]] == g}))
            for k in mine:
                if one[k[2]] == g:
                    groups.setdefault((pair, g, two[k[3]]), []).append(k[4])
    first = sorted(min(ids) for ids in groups.values())
    assert sorted(r.id for r in got.collect()) == first
    assert len(seen) == 2 and max(seen) < 20  # 400 contacts lie at a few places


def _moved(spark):
    """Records that shuffles of this session have written so far."""
    none = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
    stages = spark._jsparkSession.sparkContext().statusStore().stageList(None, False, False, none, None)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_features_move_once_per_part(spark, monkeypatch):
    monkeypatch.setattr(matrix, "BLOCK", 2)
    r = np.random.default_rng(5)
    values = {(i, s): float(r.normal()) for i in range(120) for s in range(6) if r.random() < 0.9}
    df = spark.createDataFrame([(i, f"s{s}", v) for (i, s), v in values.items()] + [(200, "s0", None), (None, "s0", 1.0)], "id long, sample string, value double")
    at = _moved(spark)
    got = matrix.coexpression(df, min_size=4).collect()
    assert _moved(spark) - at < 120 * 28  # a part is taken apart in its task, however small the blocks are
    want = {}
    for a in range(120):
        for b in range(a + 1, 120):
            both = [s for s in range(6) if (a, s) in values and (b, s) in values]
            if len(both) >= 4:
                x, y = [values[a, s] for s in both], [values[b, s] for s in both]
                want[a, b] = np.corrcoef(x, y)[0, 1], len(both), np.mean(x), np.mean(y)
    assert len(got) == len(want) and {(g.a, g.b) for g in got} == set(want)
    assert all(np.allclose((g.r, g.n, g.mean_a, g.mean_b), want[g.a, g.b]) for g in got)


def test_pieces_are_made_ready_before_they_explode(spark):
    r = np.random.default_rng(3)
    texts = {i: "".join(r.choice(list("ACGTNacx"), n, p=[0.25, 0.25, 0.25, 0.15, 0.04, 0.02, 0.02, 0.02])) for i, n in enumerate((0, 1, 2, 3, 15, 16, 17, 33, 64, 65, 4095, 4096, 4097, 8200))}
    seqs = spark.createDataFrame(list(texts.items()), "id long, seq string")
    cov = spark.createDataFrame([(13, 4097, 2, 1), (13, 4097, 5, 0), (5, 3, 1, 1)], "chrom long, pos long, meth long, unmeth long")
    out = methylation.cytosine_report(seqs, cov, upstream=True)
    want, pairs = [], str.maketrans("ACGT", "TGCA")
    for i, text in texts.items():
        padded = "NN" + text + "NN"
        for k, base in enumerate(text):
            own = padded[k : k + 5] if base == "C" else padded[k : k + 5].translate(pairs)[::-1]
            kind = "CG" if own[3] == "G" else "CHG" if own[3] in "ACT" and own[4] == "G" else "CHH" if own[3] in "ACT" and own[4] in "ACT" else None
            if base in "CG" and kind:
                counts = [x[2:] for x in ((13, 4097, 2, 1), (13, 4097, 5, 0), (5, 3, 1, 1)) if x[:2] == (i, k + 1)] or [(0, 0)]
                want += [(i, k + 1, "+" if base == "C" else "-", m, u, kind, own[2:], own[1]) for m, u in counts]
    assert sorted(tuple(x) for x in out.collect()) == sorted(want)
    above = _plan(out).split("Generate explode(sequence(")[0]
    assert "repeat(" not in above and "translate(" not in above


def test_fragments_are_ranked_and_not_joined(spark):
    """300 copies of one pair, three fragments elsewhere (the last with two barcodes), reads without a name or a contig."""
    places = {"q0300": (10, "d", 0), "q0301": (10, "c", 1), "q0302": (11, "c", 0)}
    rows = []
    for i in range(303):
        at, contig, shift = places.get(f"q{i:04}", (10, "c", 0))
        rows += [(2 * i + 5, f"q{i:04}", 65, contig, at, "50M", 0), (2 * i + 6, f"q{i:04}", 145, contig, at + 140 + shift, "3S46M2D2M1I", int(i >= 300))]
    rows += [(0, None, 65, "c", 10, "50M", 0), (1, "n", 65, None, 10, "50M", 0), (2, "q0299", 65, None, 7, "50M", 0)]
    df = spark.createDataFrame(rows[::-1], "id long, qname string, flag int, rname string, pos long, cigar string, barcode int")
    at = _moved(spark)
    got = reads.deduplicate_pairs(df, "id")
    assert sorted(r.id for r in got.collect()) == [5, 6, *range(605, 611)]
    assert _moved(spark) - at < 606 + 100  # once by name; copies that lose do not leave their task
    assert "Join" not in _plan(got)
    again = spark.createDataFrame([(900, "z", 65, "c", 10, "50M", 1), (901, "z", 145, "c", 150, "50M", 0)], df.schema)
    both = reads.deduplicate_pairs(df.unionByName(again), "id", ["barcode"])
    # z is the first of its place with barcode 1, so it stays with both its reads.
    assert sorted(r.id for r in both.collect()) == [5, 6, *range(605, 611), 900, 901]


def test_pairs_of_peaks_move_twice(spark, sf):
    """Lines by order, then fragments by place: neither the window of a name nor the result moves reads anew."""
    from strandloom.plans import catalog

    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    at = _moved(spark)
    catalog.queries()["deduplicate_pairs"](spark, sf).collect()
    assert _moved(spark) - at <= 2 * lines


def test_windows_count_without_a_join_of_intervals(spark):
    r = np.random.default_rng(3)
    sizes = [("c", 100), ("d", 7), ("e", 40), ("f", 0)]
    starts, lengths = r.integers(-15, 120, 200), r.integers(0, 45, 200)
    rows = [("cde"[i % 3], int(a), int(a + n), "+-"[i % 2]) for i, (a, n) in enumerate(zip(starts, lengths))]
    rows += [("c", -5, 10**15, "+"), ("g", 1, 9, "+"), (None, 1, 9, "-"), ("c", None, 9, "+"), ("c", 3, None, "-"), ("e", 39, 40, None), ("d", 9, 3, "+")]
    known = spark.createDataFrame(sizes, "chrom string, length long")
    hits = {"plus": F.col("strand") == "+", "minus": F.col("strand") == "-"}
    got = intervals.tile_hits(known, spark.createDataFrame(rows, "chrom string, start long, end long, strand string"), 10, hits)
    want = set()
    for chrom, length in sizes:
        for a in range(0, length, 10):
            b = min(a + 10, length)
            met = [s for c, x, y, s in rows if c == chrom and x is not None and y is not None and x < min(y, b) and y > a]
            want.add((chrom, a, b, met.count("+"), met.count("-")))
    assert {(x.chrom, x.start, x.end, x.plus, x.minus) for x in got.collect()} == want and got.count() == len(want) == 15


def test_jensen_shannon_derives_peaks_once(spark, sf):
    """Lines move once; hits and lengths move as counts and maxima of a task, not as starts and bins."""
    from strandloom.plans import catalog

    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    at = _moved(spark)
    assert catalog.queries()["jensen_shannon"](spark, sf).count() == 1
    assert _moved(spark) - at < 1.2 * lines


def test_short_rows_meet_short_chunks_of_one_table(spark):
    text = "".join("ACGT"[(i * i + i // 7) % 4] for i in range(1000))
    seqs = spark.createDataFrame([("c", text), ("d", "ACG")], "id string, seq string")
    at = [(c, s, s + n, "+") for c in "cd" for s in (0, 1, 250, 254, 255, 256, 257, 511, 995, 999, 1000) for n in (1, 2, 11, 20)]
    bed = spark.createDataFrame(at, "chrom string, start long, end long, strand string")
    for most in (2, 11, 17):
        got = sequence.short_sequence(bed, seqs, most)
        assert {(r.chrom, r.start, r.end, r.seq) for r in got.collect()} == {(c, s, e, {"c": text, "d": "ACG"}[c][s : min(e, s + most)]) for c, s, e, _ in at if s // 256 <= (len({"c": text, "d": "ACG"}[c]) - 1) // 256}
    tables = [[x for x in _plan(sequence.short_sequence(bed, seqs, most)).splitlines() if "regexp_extract_all" in x] for most in (2, 11)]
    strip = lambda lines: [re.sub(r"#\d+L?", "", x) for x in lines]
    assert strip(tables[0]) == strip(tables[1]) and "{1,256}" in tables[0][0]

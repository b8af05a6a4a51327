"""Carried scans with tiny cells and blocks, and the cost of interval joins, against plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

from strandloom.operators import intervals, scans, sets, signal, stats
from strandloom.plans.fixtures import genes, peaks


@pytest.fixture
def small(monkeypatch):
    for f in (scans.in_cells, scans.blocks):
        monkeypatch.setattr(f, "__defaults__", (*f.__defaults__[:-1], 7))


def _intervals(spark, n, seed):
    r = random.Random(seed)
    rows = [(i, r.choice(["c1", "c2"]), a := r.randint(0, 150), a + r.choice([0, 1, 3, 9, 40]), r.choice("+-")) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, chrom string, start long, end long, strand string")


def _islands(rows, distance, touching):
    out, n, reach, key = {}, 0, None, None
    for i, c, a, b, _ in sorted(rows, key=lambda x: (x[1], x[2], x[3])):
        if c != key or (a > reach + distance if touching else a >= reach):
            n, reach = n + 1, b
        key, reach = c, max(reach, b)
        out[i] = n
    return out


@pytest.mark.parametrize("distance,touching", [(0, True), (4, True), (0, False)])
def test_islands(spark, small, distance, touching):
    rows, df = _intervals(spark, 120, distance + touching)
    got = {r.id: (r.chrom, r.island) for r in scans.islands(df, ["chrom"], distance, touching).collect()}
    want = _islands(rows, distance, touching)
    pairs = lambda x: sorted(sorted(i for i in x if x[i] == v) for v in set(x.values()))
    assert pairs(got) == pairs(want)


def test_coverage_and_closest(spark, small):
    rows, df = _intervals(spark, 90, 5)
    depth = {}
    for _, c, a, b, _ in rows:
        for p in range(a, b):
            depth[c, p] = depth.get((c, p), 0) + 1
    got = {(r.chrom, p): r.depth for r in intervals.genome_coverage(df).collect() for p in range(r.start, r.end)}
    assert got == depth
    others, b = _intervals(spark, 15, 6)
    for r in intervals.closest(df, b).collect():
        left = [e for _, c, _, e, _ in others if c == r.chrom and e <= r.start]
        right = [s for _, c, s, _, _ in others if c == r.chrom and s >= r.end]
        assert (r.left_end, r.right_start) == (max(left, default=None), min(right, default=None))


def test_fragments(spark, small):
    rows, df = _intervals(spark, 60, 7)
    cuts, c = _intervals(spark, 20, 8)
    got = {r.id: r.fragment for r in sets.assign_fragment(df.select("id", "chrom", F.col("start").alias("pos")), c.select("chrom", F.col("start").alias("pos"))).collect()}
    assert got == {i: len({s for _, k, s, _, _ in cuts if k == ch and s <= a}) for i, ch, a, _, _ in rows}


def _once(v, mode, span):
    n, h, out = len(v), span // 2, []
    for i in range(n):
        if mode == "move":
            part = v[max(0, i - span + 1) : i + 1]
            out.append(sum(part) / len(part))
        elif i < h:
            out.append(sum(v[: 2 * i + 1]) / (2 * i + 1))
        elif i >= n - h:
            k = 2 * (n - i) - (n - i) % 2
            out.append(sum(v[n - k :]) / k)
        else:
            out.append(sum(v[i - h : i + h + 1]) / span)
    return out


@pytest.mark.parametrize("mode,span", [("average", 5), ("average", 4), ("move", 4), ("average", 1)])
def test_smooth(spark, small, mode, span):
    r = random.Random(span)
    series = {"a": [1, 5, 2, 8, 3, 9, 4, 7], "b": [r.randint(0, 9) for _ in range(40)]}
    df = spark.createDataFrame([(k, 3 * i, v) for k, vs in series.items() for i, v in enumerate(vs)], "k string, at long, v long")
    got = {(x.k, x.at): x.smoothed for x in signal.smooth(df, ["k"], "at", "v", span, mode).collect()}
    for k, v in series.items():
        want = _once(_once(v, mode, span)[::-1], mode, span)[::-1]
        assert [got[k, 3 * i] for i in range(len(v))] == pytest.approx(want)
    if (mode, span) == ("average", 5):
        assert [round(got["a", 3 * i], 2) for i in range(3)] == [1.0, 3.22, 3.61]


def test_summits(spark, small):
    r = random.Random(3)
    v = [r.randint(0, 3) for _ in range(60)]
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate(v)], "k string, at long, v long")
    want, up = [], True
    for i, x in enumerate(v):
        if i and v[i] != v[i - 1]:
            up = v[i] > v[i - 1]
        if up and (i + 1 == len(v) or v[i + 1] < x):
            want.append(i)
    assert sorted(x.at for x in signal.summits(df, ["k"], "at", "v").collect()) == want


def test_overlaps_of_all_lengths(spark):
    r = random.Random(1)
    make = lambda n: [(i, "c", a := r.randint(0, 3_000_000), a + r.choice([0, 1, 900, 5000, 70_000, 2_000_000])) for i in range(n)]
    a, b = make(150), make(150)
    frames = [spark.createDataFrame(x, "id long, chrom string, start long, end long") for x in (a, b)]
    got = [(x.id, x.b_id, x.overlap) for x in intervals.overlap_join(*frames, bin_width=512).collect()]
    assert sorted(got) == sorted((i, j, min(e, f) - max(s, t)) for i, _, s, e in a for j, _, t, f in b if min(e, f) > max(s, t) and s < e and t < f)


def _kernel_sides(a, b):
    width = intervals.BIN
    levels = intervals._kept(a, width, "_levels_a").join(intervals._kept(b, width, "_levels_b"), F.lit(True))
    return intervals._binned(a, width, 0, levels), intervals._binned(b, width, 1, levels).select("chrom", "_bin")


def test_copies_candidates_and_keys(spark):
    """Few copies, candidates in proportion to results, no key with a hundredth of the rows."""
    sf = "/root/testdata/sf0.01"
    a, b = peaks(spark, sf), genes(spark, sf)
    left, right = _kernel_sides(a, b)
    n = left.count()
    assert n < 2.5 * a.count() and right.count() < 2.5 * b.count()
    assert left.join(right, ["chrom", "_bin"]).count() < 20 * intervals.overlap_join(a, b).count()
    assert left.groupBy("chrom", "_bin").count().agg(F.max("count")).first()[0] < 0.01 * n


def test_few_long_intervals_cost_no_copies_of_starts(spark):
    r = random.Random(1)
    rows = [(i, "c", s := r.randrange(200_000_000), s + 100) for i in range(20_000)]
    long = [(i, "c", i * 1_000_000, i * 1_000_000 + 50_000) for i in range(5)]
    a, b = (spark.createDataFrame(x, "id long, chrom string, start long, end long") for x in (rows, rows[:5000] + long))
    left, right = _kernel_sides(a, b)
    assert left.count() < 2.5 * len(rows) and right.count() < 2.5 * 5005
    assert left.groupBy("_bin").count().agg(F.max("count")).first()[0] < 0.01 * len(rows)


@pytest.mark.parametrize("seed", range(3))
def test_joins_on_all_levels(spark, seed):
    r = random.Random(seed)

    def made(n, lengths):
        return [(i, r.choice(["c1", "c2"]), s := r.randint(-20, 900), s + r.choice(lengths), r.choice("+-")) for i in range(n)]

    x, y = made(150, [0, 1, 5, 40, 700]), made(150, [[1, 3], [2, 9, 90, 800], [900]][seed])
    x.append((900, None, 1, 5, "+"))
    a, b = (spark.createDataFrame(z, "id long, chrom string, start long, end long, strand string") for z in (x, y))
    want = {(i, j): min(e, f) - max(s, t) for i, c, s, e, _ in x for j, d, t, f, _ in y if c == d and s < f and t < e and s < e and t < f}
    got = [((h.id, h.b_id), h.overlap) for h in intervals.overlap_join(a, b, bin_width=4).collect()]
    assert len(got) == len(want) and dict(got) == want
    cover = {i: {p for j, d, t, f, _ in y if d == c for p in range(t, f)} for i, c, *_ in x}
    left = {}
    for h in intervals.subtract(a, b).collect():
        assert h.id not in left or h.start > max(left[h.id]) + 1
        left.setdefault(h.id, set()).update(range(h.start, h.end))
    assert left == {i: set(range(s, e)) - (cover[i] if c else set()) for i, c, s, e, _ in x if s >= e or c is None or set(range(s, e)) - cover[i]}


def test_a_pile_of_reads_is_not_one_task(spark):
    """All rows at two places: the scan sees two rows, not the pile."""
    df = spark.range(5000).selectExpr("id", "'chrM' AS chrom", "id % 2 * 10 AS start", "id % 2 * 10 + 5 + id % 3 AS end")
    assert [tuple(r) for r in intervals.merge_intervals(df).orderBy("start").collect()] == [("chrM", 0, 7, 2500), ("chrM", 10, 17, 2500)]
    near = intervals.closest(df, df).select("start", "left_end", "right_start").distinct().orderBy("start").collect()
    assert [tuple(r) for r in near] == [(0, None, 10), (10, 7, None)]


@pytest.mark.parametrize("size", [3, 7])
def test_places_of_cut_sequences(spark, monkeypatch, size):
    from strandloom.operators import sequence

    monkeypatch.setattr(sequence, "CHUNK", 11)
    r = random.Random(size)
    texts = {i: "".join(r.choice("ACGTN") for _ in range(n)) for i, n in enumerate([0, 1, 2, 5, 11, 12, 23, 100])}
    df = spark.createDataFrame(list(texts.items()), "id long, seq string")
    for k in (1, 3, 5):
        want = sorted((i, p, t[p : p + k]) for i, t in texts.items() for p in range(len(t) - k + 1) if "N" not in t[p : p + k])
        assert sorted(map(tuple, sequence.kmers(df, k, size=size).collect())) == want
    want = sorted((i, p, b, f"..{t}.."[p : p + 5]) for i, t in texts.items() for p, b in enumerate(t) if b in "CG")
    assert sorted(map(tuple, sequence.base_rows(df, "CG", size=size, pad=".").collect())) == want


def test_equal_values_are_not_one_task(spark):
    """All values equal, or all in a narrow range: ranges of rows stay small."""
    df = spark.range(4000).selectExpr("id", "1.0 AS signal", "CASE WHEN id < 3000 THEN 1.0 ELSE id / 1e6 END AS p")
    ranks = signal.rank_peaks(df, "signal")
    assert [tuple(r) for r in ranks.select("id", "rank").orderBy("id").limit(3).collect()] == [(0, 1), (1, 2), (2, 3)] and ranks.select("rank").distinct().count() == 4000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows become one range
    cells = scans.in_ranges(df, [], [F.col("signal"), F.col("id")]).groupBy("_cell").count()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert cells.agg(F.max("count")).first()[0] < 0.5 * 4000
    got = {r.id: r.padj for r in stats.bh_adjust(df).collect()}
    p = {r.id: r.p for r in df.collect()}
    order, least, want = sorted(p, key=p.get), 1.0, {}
    for k in range(len(order), 0, -1):
        least = want[order[k - 1]] = min(least, p[order[k - 1]] * len(p) / k)
    assert all(abs(got[i] - want[i]) < 1e-12 for i in p)


@pytest.mark.parametrize("slope", [False, True])
def test_greedy_peaks_in_one_island(spark, slope):
    """One island of the whole chromosome, with random strengths or as one slope."""
    r = random.Random(3)
    rows = [(i, "c", 5 * i + r.randint(0, 3), 5 * i + r.randint(8, 40), i if slope else r.randint(0, 200)) for i in range(400)]
    rows += [(1000 + i, "c", a, b, s) for i, (_, _, a, b, s) in enumerate(rows[:50])]
    got = sorted(x.id for x in signal.greedy_peaks(spark.createDataFrame(rows, "id long, chrom string, start long, end long, score long")).collect())
    kept = []
    for i, _, a, b, s in sorted(rows, key=lambda x: (-x[4], x[0])):
        if all(b <= c or d <= a for _, c, d in kept):
            kept.append((i, a, b))
    assert got == sorted(k[0] for k in kept)


def test_rank_sum_of_millions(spark):
    """The product of three counts is beyond the longs."""
    rows = spark.range(4_400_000).selectExpr("CAST(id % 2 AS string) AS g", "(id DIV 2) % 1000 + id % 2 AS v")
    n = 2_200_000
    u = 2200 * 2200 * sum(x + (0.5 if x < 1000 else 0) for x in range(1, 1001))
    got = stats.rank_sum(rows, "g", "v", "1", "0").first()
    assert (got.n1, got.n2) == (n, n) and got.u == u and abs(got.z - (u - n * n / 2) / math.sqrt(n * n * (2 * n + 1) / 12)) < 1e-6

"""Placement of peaks in hotspots against loops that go from left to right."""

import random

import pytest

from strandloom.operators import placement

HALF = 75


def _disjoint(r, n):
    out, at = [], r.randint(0, 90)
    for i in range(n):
        size = r.choice([20, 40, 60, 100, 149, 150, 151, 300, 700])
        out.append((at, at + size))
        at += size + r.choice([0, 1, 10, 30, 60, 150, 400])
    return out, at + 10


def _free(spots, size, k):
    return (spots[k - 1][1] if k else None), (spots[k + 1][0] if k + 1 < len(spots) else size)


def _fit(centre, low, high):
    if low > centre - HALF:
        return low, low + 2 * HALF
    if high < centre + HALF:
        return high - 2 * HALF, high
    return centre - HALF, centre + HALF


def _loop(spots, size, summits, steps):
    peaks, last = [], None
    for k, (a, b) in enumerate(spots):
        left, right = _free(spots, size, k)
        for s, e, v in sorted(x for x in summits if a <= x[0] and x[1] <= b):
            edge = max(last or 0, left or 0)
            if b - max(a, edge) >= 2 * HALF:
                p = _fit((s + e) // 2, max(a, edge), b)
            elif right - edge >= 2 * HALF:
                p = _fit((a + b) // 2, edge, right)
            else:
                p = (edge, right)
            if p[0] >= p[1]:
                last = edge
                continue
            peaks.append((*p, v))
            last = p[1]
    calls, last = [], None
    for a, b in spots:
        if not peaks or any(x < b and a < y for x, y, _ in peaks):
            continue
        left = max((y for _, y, _ in peaks if y <= a), default=None)
        right = min((x for x, _, _ in peaks if x >= b), default=size)
        v, s = min(((-v, s) for s, e, v in steps if s < b and a < e), default=(0, None))
        at = a if s is None else s + 10
        edge = 0 if left is None else max(left, last or 0)
        if edge >= b:
            last = edge
            continue
        if b - max(a, edge) >= 2 * HALF:
            p = _fit(at, max(a, edge), b)
        elif right - edge >= 2 * HALF:
            p = _fit((a + b) // 2, edge, right)
        else:
            p = (edge, right)
        calls.append((*p, -v))
        last = p[1]
    return peaks, calls


def _case(spark, seed):
    r = random.Random(seed)
    spots, sizes, summits, steps = {}, {}, {}, {}
    for c in ("c1", "c2", "c3"):
        spots[c], sizes[c] = _disjoint(r, 60)
        steps[c] = [(s, s + 20, r.randint(1, 9)) for s in range(0, sizes[c], 20) if r.random() < 0.8]
        summits[c] = [x for x in steps[c] if r.random() < (0 if c == "c3" else 0.12)]
    rows = lambda d: [(c, *x) for c in d for x in d[c]]
    frames = (
        spark.createDataFrame(rows(summits), "chrom string, start long, end long, score long"),
        spark.createDataFrame([(i, *x) for i, x in enumerate(rows(spots))], "id long, chrom string, start long, end long"),
        spark.createDataFrame(rows(steps), "chrom string, start long, end long, density long"),
    )
    return spots, sizes, summits, steps, frames


@pytest.mark.parametrize("seed,cell", [(1, 300), (2, 1 << 16)])
def test_in_hotspots(spark, seed, cell):
    spots, sizes, summits, steps, (a, b, d) = _case(spark, seed)
    lengths = spark.createDataFrame(list(sizes.items()), "chrom string, length long")
    got = sorted((x.chrom, x.start, x.end, x.score, x.forced) for x in placement.place_in_hotspots(a, b, d, lengths, HALF, cell).collect())
    want = []
    for c in spots:
        peaks, calls = _loop(spots[c], sizes[c], summits[c], steps[c])
        want += [(c, *x, False) for x in peaks] + [(c, *x, True) for x in calls]
        assert all(x[1] <= y[0] for x, y in zip(sorted(peaks), sorted(peaks)[1:]))
    assert got == sorted(want)
    assert any(x[4] for x in got) and not any(x[0] == "c3" for x in got)


def test_every_hotspot_with_room_has_a_peak(spark):
    spots = spark.createDataFrame([(1, "c", 1000, 1300), (2, "c", 2000, 2400), (3, "c", 3000, 3100)], "id long, chrom string, start long, end long")
    top = spark.createDataFrame([("c", 1040, 1060, 5)], "chrom string, start long, end long, score long")
    steps = spark.createDataFrame([("c", 2380, 2400, 7), ("c", 2000, 2020, 3)], "chrom string, start long, end long, density long")
    length = spark.createDataFrame([("c", 9000)], "chrom string, length long")
    got = sorted(tuple(x) for x in placement.place_in_hotspots(top, spots, steps, length).collect())
    assert got == [("c", 1000, 1150, 5.0, False), ("c", 2250, 2400, 7.0, True), ("c", 2975, 3125, 0.0, True)]


def test_on_summits(spark):
    spots = spark.createDataFrame([(1, "c", 100, 112), (2, "c", 116, 400), (3, "c", 1000, 1100)], "id long, chrom string, start long, end long")
    top = spark.createDataFrame([("c", 100, 120, 2), ("c", 380, 400, 9), ("c", 390, 410, 1), ("c", 105, 125, 4)], "chrom string, start long, end long, score long")
    steps = spark.createDataFrame([("c", 1080, 1100, 7)], "chrom string, start long, end long, density long")
    got = sorted((x.start, x.end, x.score, x.forced) for x in placement.place_on_summits(top, spots, steps).collect())
    # 105-125 lies between both spots and is nearer to 117 than to 112 by 2 to 3; 100-120 stays; 390-410 and 100-120 lose to stronger ones
    assert got == [(42, 192, 4.0, False), (315, 465, 9.0, False), (1015, 1165, 7.0, True)]


def test_empty(spark):
    spots = spark.createDataFrame([], "id long, chrom string, start long, end long")
    top = spark.createDataFrame([(None, 1, 2, None)], "chrom string, start long, end long, score long")
    steps = spark.createDataFrame([], "chrom string, start long, end long, density long")
    length = spark.createDataFrame([], "chrom string, length long")
    assert placement.place_in_hotspots(top, spots, steps, length).collect() == []
    assert placement.place_on_summits(top, spots, steps).collect() == []

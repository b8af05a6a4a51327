"""Fixed-width peaks inside hotspots: shifted so that they do not overlap, and called where a hotspot has no summit.

Where a peak stands depends on where the one before it ended. A cell of the genome is therefore summed up as a
function, from the end that comes in to the end that goes out; only a few ends around the cell's first hotspot
make a difference, so the function is a short array, mostly one number. Functions are composed along the
chromosome (a row per cell), and then every cell places its peaks by itself.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import intervals as I
from . import scans
from . import signal as S
from .stored import written

_ORDER = ["lo", "at", "score"]
_ITEM = ["chrom", "lo", "hi", "at", "mid", "left", "right", "score"]


def _step(row, p, half: int, forced: bool):
    """Start, end and whether there is a peak for each possible end ``p`` of the peak before, and the end handed on.

    A peak stands around ``at`` inside the free part of its hotspot if that is wide enough, else around the hotspot's centre
    between its neighbours, else it fills the gap between them.
    """
    width = 2 * half
    left = np.maximum(p, row.left) if row.left >= 0 else (np.zeros_like(p) if forced else p)
    lo = np.maximum(row.lo, left)
    inside, between = row.hi - lo >= width, row.right - left >= width
    start = np.where(inside, np.minimum(np.maximum(row.at - half, lo), row.hi - width), np.where(between, np.minimum(np.maximum(row.mid - half, left), row.right - width), left))
    end = np.where(inside | between, start + width, row.right)
    called = (left < row.hi) if forced else (start < end)
    return start, end, called, np.where(called, end, left)


def _effects(half: int, forced: bool):
    def effects(pdf):
        rows = pdf.sort_values(_ORDER)
        first = int(rows["lo"].iat[0]) - 2 * half
        p = np.arange(first, first + 4 * half + 1)
        for row in rows.itertuples():
            p = _step(row, p, half, forced)[3]
            if len(p) > 1 and p.min() == p.max():
                p = p[:1]
        return pd.DataFrame({"chrom": rows["chrom"].iloc[:1], "_cell": rows["_cell"].iloc[:1], "first": first, "out": [p.tolist()]})

    return effects


def _composed(pdf):
    """The end that comes into each cell of one chromosome; at most one row per cell of the genome."""
    rows, p, came = pdf.sort_values("_cell"), 0, []
    for row in rows.itertuples():
        came.append(p)
        p = int(row.out[min(max(p - row.first, 0), len(row.out) - 1)])
    return pd.DataFrame({"chrom": rows["chrom"], "_cell": rows["_cell"], "p": came})


def _placer(half: int, forced: bool):
    def place(pdf):
        out, p = [], np.array([pdf["p"].iat[0]])
        for row in pdf.sort_values(_ORDER).itertuples():
            start, end, called, p = _step(row, p, half, forced)
            if called[0]:
                out.append((row.chrom, int(start[0]), int(end[0]), row.score, forced))
        return pd.DataFrame(out, columns=["chrom", "start", "end", "score", "forced"])

    return place


def _placed(items: DataFrame, half: int, forced: bool, cell: int) -> DataFrame:
    kind = items.schema["chrom"].dataType.simpleString()
    items = items.withColumn("_cell", F.floor(F.col("lo") / cell))
    effects = items.groupBy("chrom", "_cell").applyInPandas(_effects(half, forced), f"chrom {kind}, _cell long, first long, out array<long>")
    came = effects.groupBy("chrom").applyInPandas(_composed, f"chrom {kind}, _cell long, p long")
    return items.join(came, ["chrom", "_cell"]).groupBy("chrom", "_cell").applyInPandas(_placer(half, forced), f"chrom {kind}, start long, end long, score double, forced boolean")


def _between(targets: DataFrame, marks: DataFrame) -> DataFrame:
    """``targets`` with ``_left``, the largest end of the marks before each, and ``_right``, the smallest start of those after it."""
    rows = targets.select("id", "chrom", "start", "end", F.lit(0).alias("_mark"))
    others = marks.select(F.lit(None).cast(rows.schema["id"].dataType).alias("id"), "chrom", "start", "end", F.lit(1).alias("_mark"))
    both = scans.in_cells(rows.unionByName(others))
    end, start = (F.when(F.col("_mark") == 1, F.col(c)) for c in ("end", "start"))
    both = scans.carried(both, ["chrom"], {"_le": (F.max, end)})
    both = scans.carried(both, ["chrom"], {"_re": (F.min, start)}, later=True)
    before, after = (scans.inside(["chrom"], o).rangeBetween(*f) for o, f in (("start", (-scans.CELL * 4, -1)), ("start", (1, scans.CELL * 4))))
    both = both.withColumns({"_left": F.coalesce(F.max(end).over(before), F.col("_le")), "_right": F.coalesce(F.min(start).over(after), F.col("_re"))})
    return both.filter("_mark = 0").select("id", "chrom", "start", "end", "_left", "_right")


def _items(rows: DataFrame, at, sizes: DataFrame) -> DataFrame:
    """``rows`` (chrom, start and end of a hotspot, score, _left, _right) as items of the scan; no left neighbour is -1."""
    rows = rows.join(sizes.select("chrom", "length"), "chrom")
    return rows.select(
        "chrom", F.col("start").alias("lo"), F.col("end").alias("hi"), at.alias("at"), F.floor((F.col("start") + F.col("end")) / 2).alias("mid"),
        F.coalesce("_left", F.lit(-1)).cast("long").alias("left"), F.coalesce("_right", "length").cast("long").alias("right"), F.col("score").cast("double").alias("score"),
    ).select(*_ITEM)


def _open(hotspots: DataFrame, peaks: DataFrame, density: DataFrame) -> DataFrame:
    """Hotspots that meet no peak, on chromosomes with peaks, with the middle (``at``) and the score of their densest step.

    Of equal steps the first counts; without any step the hotspot's start stands in, with score 0.
    """
    free = I.overlap_anti(hotspots.join(peaks.select("chrom").distinct(), "chrom", "left_semi"), peaks.select("chrom", "start", "end"))
    hits = I.overlap_join(free.select("id", "chrom", "start", "end"), density.select("chrom", "start", "end", "density"))
    best = hits.groupBy("id").agg(F.max(F.struct(F.col("b_density").cast("double").alias("v"), (-F.col("b_start")).alias("s"), F.col("b_end").alias("e"))).alias("_b"))
    return free.join(best, "id", "left").select("id", "chrom", "start", "end", F.coalesce(F.floor((F.col("_b.e") - F.col("_b.s")) / 2), F.col("start")).alias("at"), F.coalesce("_b.v", F.lit(0.0)).alias("score"))


def _hotspots(hotspots: DataFrame) -> DataFrame:
    return hotspots.select("id", "chrom", "start", "end").dropna().filter("start < end")


def place_in_hotspots(summits: DataFrame, hotspots: DataFrame, density: DataFrame, sizes: DataFrame, half: int = 75, cell: int = scans.CELL) -> DataFrame:
    """Peaks of ``2 * half`` bases (chrom, start, end, score, forced), none overlapping another of its kind.

    ``summits``: chrom, start, end, score, of which those inside a hotspot count; ``hotspots``: id, chrom, start, end, disjoint;
    ``density``: chrom, start, end, density; ``sizes``: chrom, length. From left to right a peak is centred on its summit, moved
    into its hotspot and behind the peak before it; in a hotspot too narrow for that it is centred on the hotspot between the neighbouring
    hotspots, or fills what lies between them, or is left out if nothing does. Then every hotspot without a peak gets one
    around its densest step (``forced``) between the neighbouring peaks, unless a forced one before it covers the hotspot.

    As surveyed, a chromosome without any summit in a hotspot has no forced calls, and a forced call left of all peaks
    does not look at the forced one before it, so these can overlap. Rows with nulls are left out, equal summits are
    placed one after the other, empty tables give no rows.
    """
    spots = written(_between(_hotspots(hotspots), _hotspots(hotspots)), "hotspots")
    hits = I.overlap_join(summits.select("chrom", "start", "end", "score").dropna(), spots, contained=True)
    hits = hits.select("chrom", F.col("b_start").alias("start"), F.col("b_end").alias("end"), F.floor((F.col("start") + F.col("end")) / 2).alias("at"), "score", F.col("b__left").alias("_left"), F.col("b__right").alias("_right"))
    peaks = written(_placed(written(_items(hits, F.col("at"), sizes), "summits"), half, False, cell), "peaks")
    free = written(_open(spots, peaks, density), "open-hotspots")
    near = _between(free.select("id", "chrom", "start", "end"), peaks.select("chrom", "start", "end")).select("id", "_left", "_right")
    calls = _placed(written(_items(free.join(near, "id"), F.col("at"), sizes), "forced"), half, True, cell)
    return peaks.unionByName(calls)


def place_on_summits(summits: DataFrame, hotspots: DataFrame, density: DataFrame, half: int = 75) -> DataFrame:
    """Peaks (id, chrom, start, end, score, forced) around summits that meet hotspots, and around the densest step of the others; overlaps go to the stronger.

    A summit outside its hotspot is moved to its nearer edge; one between two hotspots to the nearer of them, of equal distances to the left one. Tables as in
    ``place_in_hotspots``; ``id`` is the place's name. Starts can lie below 0, as surveyed; rows with nulls are left out.
    """
    spots = written(_hotspots(hotspots), "hotspots")
    hits = I.overlap_join(written(summits.select("chrom", "start", "end", "score").dropna(), "summits"), spots.select("chrom", "start", "end"))
    per = hits.groupBy("chrom", "start", "end", F.col("score").cast("double").alias("score")).agg(F.array_sort(F.collect_list(F.struct(F.col("b_start").alias("s"), F.col("b_end").alias("e")))).alias("h"))
    at = F.floor((F.col("start") + F.col("end")) / 2)
    lo, hi = F.col("h")[0]["s"] + 1, F.col("h")[0]["e"]
    next_ = F.get("h", F.lit(1))["s"] + 1
    two = F.when((at >= next_) | (at <= hi), at).when(next_ - at < at - hi, next_).otherwise(hi)
    clamp = lambda x: F.greatest(F.least(x, hi), lo)
    around = lambda x: (x - half, x + half)
    start, end = around(F.when(F.size("h") == 2, two).otherwise(clamp(at)))
    peaks = written(per.select("chrom", start.alias("start"), end.alias("end"), "score", F.lit(False).alias("forced")), "peaks")
    start, end = around(F.greatest(F.least(F.col("at"), F.col("end")), F.col("start") + 1))
    calls = _open(spots, peaks, density).select("chrom", start.alias("start"), end.alias("end"), "score", F.lit(True).alias("forced"))
    both = peaks.unionByName(calls).withColumn("id", F.concat_ws(":", "chrom", "start", "end", F.col("score").cast("string"), F.col("forced").cast("string"))).dropDuplicates(["id"])
    return S.greedy_peaks(both.select("id", "chrom", "start", "end", "score", "forced"))

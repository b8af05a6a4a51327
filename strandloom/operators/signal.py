"""Signal along the genome: cut counts, density, smoothing, summits, hotspots, quality scores."""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import intervals as I
from . import scans
from .stored import written


def read_cuts(reads: DataFrame) -> DataFrame:
    """``reads`` as the base at which each was cut: the first one of reads on plus, the one behind the end of reads on minus."""
    at = F.when(F.col("strand") == "-", F.col("end")).otherwise(F.col("start"))
    return reads.withColumns({"start": at, "end": at + 1})


def cut_counts(cuts: DataFrame) -> DataFrame:
    """Cuts per position: chrom, start, n."""
    return cuts.groupBy("chrom", "start").agg(F.count("*").alias("n"))


def filter_bad_spots(counts: DataFrame, near: int = 25, far: int = 125, least: int = 5, share: float = 0.8) -> DataFrame:
    """Positions without those whose near window holds too large a share of the far window, which counts as 0.01 larger.

    Frames are ranges over positions of a chromosome cut into overlapping stretches, so that a stretch,
    not a chromosome, is one group.
    """
    size = 1 << 20
    here = F.floor(F.col("start") / size)
    copies = F.array_distinct(F.array(here, F.floor((F.col("start") - far) / size), F.floor((F.col("start") + far) / size)))
    spread = counts.withColumns({"_home": here, "_part": F.explode(copies)})
    w = W.partitionBy("chrom", "_part").orderBy("start")
    total = lambda r: F.sum("n").over(w.rangeBetween(-r, r))
    out = spread.withColumns({"_near": total(near), "_far": total(far)}).filter("_home = _part")
    return out.filter(~((F.col("_near") >= least) & (F.col("_near") / (F.col("_far") + 0.01) >= share))).select(*counts.columns)


def normalized_density(windows: DataFrame, value: str = "hits", per: float = 1e6, exclude=("chrM", "chrC")) -> DataFrame:
    """Window counts per ``per`` of all counts outside the excluded chromosomes."""
    kept = windows.filter(~F.col("chrom").isin(list(exclude)))
    total = kept.agg(F.sum(value).alias("_t"))  # one row
    return kept.join(F.broadcast(total), F.lit(True)).withColumn("density", F.try_divide(F.col(value) * per, "_t")).drop("_t")


def tag_density(cuts: DataFrame, sizes: DataFrame, window: int = 150, step: int = 20, counted: bool = False) -> DataFrame:
    """Cuts in a window around each step of the genome: chrom, start, end (the step), density; ``counted`` cuts are rows of ``cut_counts``.

    Each cut adds to the few steps whose windows hold it; no tile joins are needed.
    """
    half = (window - step) // 2
    first = F.greatest(F.ceil((F.col("start") - half - step + 1) / step), F.lit(0))
    last = F.floor((F.col("start") + half) / step)
    per = (cuts if counted else cut_counts(cuts)).select("chrom", "n", F.explode(F.sequence(first, F.greatest(last, first))).alias("i")).groupBy("chrom", "i").agg(F.sum("n").alias("density"))
    out = per.join(sizes, "chrom").withColumn("start", F.col("i") * step).filter("start < length")
    return out.select("chrom", "start", F.least(F.col("start") + step, F.col("length")).alias("end"), "density")


def spot_score(cuts: DataFrame, hotspots: DataFrame, id: str = "id") -> DataFrame:
    """Share of cuts inside hotspots."""
    inside = I.overlap_semi(cuts, hotspots, id).agg(F.count("*").alias("inside"))
    return inside.join(cuts.agg(F.count("*").alias("total")), F.lit(True)).withColumn("spot", F.try_divide("inside", "total"))


def breadth_of_coverage(depth: DataFrame, sizes: DataFrame, least: int = 5) -> DataFrame:
    """Percent of the genome with at least ``least`` depth."""
    covered = depth.filter(F.col("depth") >= least).agg(F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0)).alias("covered"))
    return covered.join(sizes.agg(F.sum("length").alias("genome")), F.lit(True)).withColumn("percent", F.try_divide(F.col("covered") * 100.0, "genome"))


def smooth(df: DataFrame, keys: list[str], order: str, value: str, span: int, mode: str = "average") -> DataFrame:
    """``df`` with ``smoothed``: a moving average of each key's series, run forward and then over the reversed result.

    ``average`` is centred: it sums ``span // 2`` values on each side and divides by ``span``; near the start
    the window shrinks to 2i + 1 values, near the end to twice the values left (one less for an odd
    number). ``move`` averages the last ``span`` values, fewer at the start. Null values count as 0, rows
    without a key or an order are left out.
    """
    half = span // 2
    if mode == "average" and half == 0:
        return df.withColumn("smoothed", F.coalesce(F.col(value).cast("double"), F.lit(0.0)))
    rows = scans.blocks(scans.numbered(df, keys, order), span if mode == "move" else 2 * half)
    part = W.partitionBy(*keys, "_block")

    def passed(d: DataFrame, v: str, out: str, w) -> DataFrame:
        if mode == "move":
            return d.withColumn(out, F.avg(v).over(w.rowsBetween(-(span - 1), 0)))
        d = d.withColumns({"_l": F.collect_list(v).over(w.rowsBetween(-half, half)), "_a": F.count(v).over(w.rowsBetween(-half, -1)), "_z": F.count(v).over(w.rowsBetween(1, half)) + 1})
        total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, y: s + y)
        head, tail = (2 * F.col("_a") + 1).cast("int"), (2 * F.col("_z") - F.col("_z") % 2).cast("int")
        first = total(F.slice("_l", F.lit(1), head)) / head
        last = total(F.slice("_l", F.greatest(F.size("_l") - tail + 1, F.lit(1)), tail)) / tail
        return d.withColumn(out, F.when(F.col("_a") < half, first).when(F.col("_z") <= half, last).otherwise(total(F.col("_l")) / span)).drop("_l", "_a", "_z")

    rows = passed(rows.withColumn("_v", F.coalesce(F.col(value).cast("double"), F.lit(0.0))), "_v", "_once", part.orderBy("_idx"))
    return passed(rows, "_once", "smoothed", part.orderBy(F.desc("_idx"))).filter("_home = _block").select(*df.columns, "smoothed")


def summits(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Local maxima: rows after which the series falls and before which it last rose; the end closes a rise.

    The direction of the last change is carried over from cell to cell. Rows without a key or an order are left out.
    """
    rows = scans.blocks(scans.numbered(df, keys, order), 1)
    w = W.partitionBy(*keys, "_block").orderBy("_idx")
    change = F.signum(F.col(value) - F.lag(value).over(w))
    rows = rows.withColumns({"_c": F.when(change != 0, change), "_n": F.lead(value).over(w)}).filter("_home = _block")
    rows = scans.carried(rows.withColumn("_cell", F.col("_block")), keys, {"_last": (F.max, F.when(F.col("_c").isNotNull(), F.struct("_idx", "_c")))})
    way = F.coalesce(F.last("_c", ignorenulls=True).over(scans.inside(keys, "_idx").rowsBetween(W.unboundedPreceding, 0)), F.col("_last._c"), F.lit(1.0))
    return rows.withColumn("_d", way).filter((F.col("_d") > 0) & (F.col("_n").isNull() | (F.col("_n") < F.col(value)))).select(*df.columns)


def hotspot_score(hotspots: DataFrame, sites: DataFrame, fdr: str = "fdr", id: str = "id") -> DataFrame:
    """Smallest FDR of the sites in each hotspot as -log10 (at most 100) and a score of ten times it."""
    hits = I.overlap_join(hotspots.select(id, "chrom", "start", "end"), sites.select("chrom", "start", "end", F.col(fdr).alias("f")))
    best = hits.groupBy(id).agg(F.min("b_f").alias("least"))
    level = F.when(F.col("least") <= 0, 100.0).otherwise(F.least(F.lit(100.0), -F.log10("least")))
    return hotspots.join(best, id, "left").withColumn("log_fdr", level).withColumn("score", F.floor(F.col("log_fdr") * 10 + 0.5)).drop("least")


def place_peaks(summits_: DataFrame, half: int = 75) -> DataFrame:
    """Fixed-width windows around summits, clipped at 0."""
    return summits_.withColumns({"start": F.greatest(F.col("start") - half, F.lit(0)), "end": F.col("start") + half + 1})


def greedy_peaks(peaks: DataFrame, score: str = "score", id: str = "id") -> DataFrame:
    """Strongest peaks first, dropping those that overlap a kept one; of equal scores the smaller id is the stronger.

    In rounds: a peak that is stronger than all it overlaps stays, whatever it overlaps goes, and so on with what is left; that
    is what going through the peaks by strength gives. Of equal intervals only the strongest takes part. Rounds end when they
    decide less than an eighth of what is left, as on a long slope of ever stronger peaks; the rest is then taken in order, each
    island of it in one group of narrow rows.
    """
    strength = F.struct((-F.col(score)).alias("s"), F.col(id).alias("i"))
    best = peaks.filter("start < end").groupBy("chrom", "start", "end").agg(F.min(strength).alias("o"))
    left = written(best.select("chrom", "start", "end", "o", F.col("o.i").alias("i")), "open-peaks")
    kept, n = None, left.count()
    while n:
        # A pair matters from its weaker side only: that one is beaten, and what stays drops weaker ones alone.
        hits = written(I.overlap_join(left, left).filter(F.col("b_o") < F.col("o")).select("i", "b_i"), "overlaps")
        stay = written(left.join(hits.select("i"), "i", "left_anti"), "kept-peaks")
        gone = hits.join(stay.select(F.col("i").alias("b_i")), "b_i", "left_semi").select("i").distinct()
        left = written(left.join(hits.select("i").distinct(), "i", "left_semi").join(gone, "i", "left_anti"), "open-peaks")
        kept = stay if kept is None else kept.unionByName(stay)
        before, n = n, left.count()
        if 8 * n > 7 * before:
            kept = kept.unionByName(_greedy_rest(left))
            break
    ids = kept.select(F.col("i").alias(id)) if kept is not None else peaks.select(id).limit(0)
    return peaks.join(ids, id, "left_semi")


def _greedy_rest(peaks: DataFrame) -> DataFrame:
    """Greedy over (chrom, start, end, o, i), an island in one group of these narrow rows."""
    islands = I.overlap_groups(peaks)
    alone, crowded = (islands.filter(f"group_size {c} 1") for c in ("=", ">"))

    def keep(pdf):
        starts, ends, rows = [], [], []
        order = pdf["o"].map(lambda o: (o["s"], o["i"])).sort_values()
        for i in order.index:
            a, b = pdf.at[i, "start"], pdf.at[i, "end"]
            k = bisect.bisect_right(starts, a)
            if (k == 0 or ends[k - 1] <= a) and (k == len(starts) or starts[k] >= b):
                starts.insert(k, a)
                ends.insert(k, b)
                rows.append(i)
        return pdf.loc[rows]

    done = crowded.groupBy("chrom", "island").applyInPandas(keep, crowded.schema)
    return alone.unionByName(done).select(*peaks.columns)


def fingerprint(windows: DataFrame, value: str = "hits", bins: int = 20) -> DataFrame:
    """Share of all counts in the least covered windows: cumulative share per bin of equal window numbers.

    Windows are grouped by count before they are ordered, so the order is over distinct counts.
    """
    per = windows.groupBy(F.col(value).alias("v")).agg(F.count("*").alias("k"))
    w = W.orderBy("v").rowsBetween(W.unboundedPreceding, 0)
    per = per.withColumns({"rank": F.sum("k").over(w), "mass": F.sum(F.col("v") * F.col("k")).over(w)})
    total = per.agg(F.max("rank").alias("n"), F.max("mass").alias("m"))
    out = per.join(F.broadcast(total), F.lit(True))
    return out.groupBy(F.ceil(F.col("rank") * bins / F.col("n")).alias("bin")).agg(F.max(F.try_divide("mass", "m")).alias("share"))


def jensen_shannon(a: DataFrame, b: DataFrame, value: str = "hits") -> DataFrame:
    """Jensen-Shannon distance (base 2, 0 to 1) of two samples' window counts: jsd, and the windows of each.

    Windows are grouped by count first; what is compared is the share of windows of every count, so the join has a row per
    distinct count. Null without windows in a sample.
    """
    one = lambda d, n: d.groupBy(F.col(value).alias("v")).agg(F.count("*").alias(n))
    both = one(a, "x").join(one(b, "y"), "v", "full").fillna(0, ["x", "y"])
    total = both.agg(F.coalesce(F.sum("x"), F.lit(0)).alias("n_a"), F.coalesce(F.sum("y"), F.lit(0)).alias("n_b"))
    both = both.join(F.broadcast(total), F.lit(True)).select("n_a", "n_b", F.try_divide("x", "n_a").alias("p"), F.try_divide("y", "n_b").alias("q"))
    m = (F.col("p") + F.col("q")) / 2
    part = lambda c: F.when(F.col(c) > 0, F.col(c) * F.log2(F.col(c) / m)).otherwise(0.0)
    out = both.agg(F.sum(part("p") + part("q")).alias("s"), F.max("n_a").alias("n_a"), F.max("n_b").alias("n_b"))
    return out.select(F.when((F.col("n_a") > 0) & (F.col("n_b") > 0), F.sqrt(F.greatest(F.col("s") / 2, F.lit(0.0)))).alias("jsd"), "n_a", "n_b")


def strand_coverage(reads: DataFrame, unique: bool = False, hits: str = "hits") -> DataFrame:
    """Depth runs per strand with reads per million of the strand-independent total; ``unique``: of reads with one hit (``hits``) only."""
    reads = reads.filter(F.col(hits) == 1) if unique else reads
    plus, minus = (I.genome_coverage(reads.filter(F.col("strand") == s)).withColumn("strand", F.lit(s)) for s in "+-")
    n = reads.agg(F.count("*").alias("_n"))
    return plus.unionByName(minus).join(F.broadcast(n), F.lit(True)).withColumn("rpm", F.col("depth") * 1e6 / F.col("_n")).drop("_n")


def hotspot_merge(sites: DataFrame, distance: int, min_width: int, fdr: str | None = None, max_fdr: float = 1.0) -> DataFrame:
    """Hotspots: sites (of at most ``max_fdr`` in the column ``fdr``) merged from left to right: chrom, start, end, n.

    Overlapping and touching sites are one. Of two neighbours at most ``distance`` apart, the left one as merged so far, both
    join if either is narrower than ``min_width``; two wide ones stay apart. Results narrower than ``min_width`` are dropped.

    In a chain of near neighbours the left side, once wide, stays wide, and it is narrow only while everything from the
    chain's start on has been joined. So it is wide exactly if the end before it lies ``min_width`` behind the chain's
    start, and a wide site starts a new hotspot exactly then: running values, no state from row to row.
    """
    if fdr:
        sites = sites.filter(F.col(fdr) <= max_fdr)
    joined = I.merge_intervals(sites)
    w, so_far = scans.inside(["chrom"], "start"), (W.unboundedPreceding, 0)
    rows = scans.carried(scans.in_cells(written(joined, "sites")), ["chrom"], {"_before": (F.max, "end")})
    rows = rows.withColumn("_last", F.coalesce(F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1)), "_before")).drop("_before")
    first = F.col("_last").isNull() | (F.col("start") - F.col("_last") > distance)
    rows = scans.carried(rows.withColumn("_chain", F.when(first, F.col("start"))), ["chrom"], {"_from0": (F.max, "_chain")})
    rows = rows.withColumn("_from", F.coalesce(F.max("_chain").over(w.rowsBetween(*so_far)), "_from0"))
    new = F.col("_chain").isNotNull() | ((F.col("end") - F.col("start") >= min_width) & (F.col("_last") - F.col("_from") >= min_width))
    rows = scans.carried(written(rows.withColumn("_new", new.cast("int")), "chains"), ["chrom"], {"_seen": (F.sum, "_new")})
    number = F.coalesce("_seen", F.lit(0)) + F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0))
    out = rows.withColumn("_hot", number).groupBy("chrom", "_hot").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n"))
    return out.filter(F.col("end") - F.col("start") >= min_width).drop("_hot")


def track_correlation(a: DataFrame, b: DataFrame, value: str) -> DataFrame:
    """Pearson correlation of two tracks on the same windows."""
    one, two = a.select("chrom", "start", F.col(value).alias("x")), b.select("chrom", "start", F.col(value).alias("y"))
    return one.join(two, ["chrom", "start"]).agg(F.corr("x", "y").alias("r"), F.count("*").alias("n"))


def rank_peaks(df: DataFrame, by: str = "pvalue", id: str = "id") -> DataFrame:
    """``df`` with ``rank``, from 1: by ascending signal, or by descending p or q value; ties by ``id``.

    Rows without the value are left out.
    """
    order = [F.col(by).asc() if by == "signal" else F.col(by).desc(), F.col(id).asc()]
    return scans.placed(df.dropna(subset=[by]), [], order).withColumn("rank", F.col("_idx") + 1).drop("_idx")


def center_sites(sizes: DataFrame, mappable: DataFrame, half: int = 100) -> DataFrame:
    """Stretches (chrom, start, end) of sites with more than ``half`` mappable bases within ``half`` bases on each side.

    Sites nearer than ``half`` to an end of the chromosome are left out. The number of mappable bases around a
    site changes by at most one from site to site, so two carried scans over the ends of the mappable regions
    give it as straight pieces; no row per base is made.
    """
    m = I.merge_intervals(mappable).select("chrom", "start", "end")
    turn = lambda at, by: F.struct(at.alias("start"), F.lit(by).alias("d"))
    s, e = F.col("start"), F.col("end")
    turns = m.select("chrom", F.explode(F.array(turn(s - half, 1), turn(e - half, -1), turn(s + half + 1, -1), turn(e + half + 1, 1))).alias("t"))
    turns = turns.groupBy("chrom", F.col("t.start").alias("start")).agg(F.sum("t.d").alias("d"))
    pieces = scans.runs(turns, ["chrom"], "slope").filter(F.col("end").isNotNull())
    steps = scans.carried(scans.in_cells(pieces).withColumn("_add", F.col("slope") * (e - s)), ["chrom"], {"_seen": (F.sum, "_add")})
    before = F.coalesce("_seen", F.lit(0)) + F.coalesce(F.sum("_add").over(scans.inside(["chrom"], "start").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # A piece has before + slope * (site - start + 1) mappable bases around each of its sites.
    steps = steps.select("chrom", "start", "end", "slope", before.alias("before"))
    lack = F.lit(half + 1) - F.col("before")
    first = F.when(F.col("slope") > 0, F.greatest(s, s - 1 + F.ceil(lack / F.col("slope")))).otherwise(s)
    last = F.when(F.col("slope") < 0, F.least(e, s + F.floor(lack / F.col("slope")))).otherwise(e)
    steps = steps.filter((F.col("slope") != 0) | (lack <= 0)).select("chrom", first.alias("start"), last.alias("end"))
    clipped = steps.join(sizes, "chrom").select("chrom", F.greatest(s, F.lit(half)).alias("start"), F.least(e, F.col("length") - half).alias("end")).filter("start < end")
    return I.merge_intervals(clipped).select("chrom", "start", "end")


def copy_profile(counts: DataFrame, least_mappable: float = 0.75, strata: int = 100) -> DataFrame:
    """Windows (chrom, start, reads, gc, mappability) with ``depth``: reads by mappability, then by the median of windows of like GC.

    Windows below ``least_mappable`` have a null depth and do not count. A window's depth is its reads over its
    mappability, times the median of all windows over that of its GC stratum.
    """
    depth = F.when(F.col("mappability") >= least_mappable, F.col("reads") / F.col("mappability"))
    rows = counts.withColumns({"_d": depth, "_s": F.round(F.col("gc") * strata)})
    per = rows.groupBy("_s").agg(F.median("_d").alias("_m"))
    every = rows.agg(F.median("_d").alias("_all"))  # one row
    out = rows.join(per.filter(F.col("_s").isNotNull()), "_s", "left").join(F.broadcast(every), F.lit(True))
    return out.withColumn("depth", F.try_divide(F.col("_d") * F.col("_all"), F.col("_m"))).select(*counts.columns, "depth")

"""Genomic interval algebra on DataFrames with columns chrom, start, end (0-based, half-open) and strand.

All interval joins use one kernel, an equality join on bins. Two intervals share a base if one of them
holds the other's start, so an interval meets the *starts* of the other side. A start is one point and lies
in one bin; an interval lies in the bins of its level, the finest one whose bins are at least as long as
it. The key says which side is the interval, and a pair is emitted by one side only, in one bin, so no
distinct is needed. A start is put on those levels alone that the other side has: one aggregate of its
lengths tells which, and a level with few intervals is left out, these then lie in many bins of the level below. So
a row has about two copies, and long bins are not filled with points for a handful of long intervals.
Equality keys let Spark choose broadcast or sort-merge joins and split skewed bins.

Rows without chromosome, start or end, and empty intervals, overlap nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import scans

BIN = 512
FAN = 8
LEVELS = 7


def _level(width: int) -> Column:
    """The finest level whose bins are at least as long as the interval."""
    own = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        own = F.when(F.col("end") - F.col("start") <= width * FAN**k, k).otherwise(own)
    return own


def _kept(df: DataFrame, width: int, name: str) -> DataFrame:
    """One row: the levels of ``df`` that are worth a copy of the other side's starts, as bits.

    Level 0 is. Another one is if its intervals, cut into bins of the last level that is kept below it, made
    more than a quarter as many copies as there are rows.
    """
    of_level = lambda k: F.coalesce(F.sum(F.when(_level(width) == k, F.col("end") - F.col("start"))), F.lit(0)).alias(f"l{k}")
    stats = df.filter("start < end").agg(F.count("*").alias("n"), *map(of_level, range(1, LEVELS)))
    lengths = F.array(*(F.col(f"l{k}") for k in range(1, LEVELS)))

    def step(kept: Column, k: Column) -> Column:
        last = F.pow(F.lit(float(FAN)), F.array_max(kept))
        return F.when(F.get(lengths, k - 1) > F.col("n") / 4 * width * last, F.array_append(kept, k)).otherwise(kept)

    kept = F.aggregate(F.sequence(F.lit(1), F.lit(LEVELS - 1)), F.array(F.lit(0)), step)
    return stats.select(F.aggregate(kept, F.lit(0), lambda bits, k: bits + F.pow(F.lit(2.0), k).cast("int")).alias(name))


def _binned(df: DataFrame, width: int, owner: int, levels: DataFrame) -> DataFrame:
    """``df`` with rows ``_bin``: as an interval in the bins of its level, as a start on each level of the other side.

    ``_bin`` is made of the bin, the level and the side (0 or 1) whose intervals meet starts there. Levels come as bits, and
    a start has a null on those it does not need, so that all of it is plain arithmetic of one generated stage.
    """
    own, other = ("_levels_a", "_levels_b") if owner == 0 else ("_levels_b", "_levels_a")
    has = lambda bits, k: F.col(bits).bitwiseAND(F.lit(1 << k)) != 0
    widths = F.array(*(F.lit(width * FAN**k).cast("long") for k in range(LEVELS)))
    at = lambda pos, w: F.floor(pos / w)
    name = lambda b, k, side: b * (2 * LEVELS) + 2 * k + side
    df = df.filter("start < end").join(F.broadcast(levels), F.lit(True))  # one row
    longer = lambda k: F.col("end") - F.col("start") > width * FAN ** (k - 1)
    df = df.withColumn("_own", F.coalesce(*(F.when(has(own, k) & longer(k), k) for k in range(LEVELS - 1, 0, -1)), F.lit(0)))
    df = df.withColumn("_width", F.get(widths, F.col("_own")))
    first, last = (name(at(p, F.col("_width")), F.col("_own"), owner) for p in (F.col("start"), F.col("end") - 1))
    spans = F.sequence(first, last, F.lit(2 * LEVELS).cast("long"))
    starts = F.array(*(F.when(has(other, k), name(at(F.col("start"), F.lit(width * FAN**k)), k, 1 - owner)) for k in range(LEVELS)))
    return df.withColumn("_bin", F.explode(F.concat(spans, starts))).filter("_bin IS NOT NULL").drop("_own", "_width", "_levels_a", "_levels_b")


def overlap_bp(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Shared length of two intervals, 0 if they do not meet."""
    return F.greatest(F.lit(0), F.least(a1, b1) - F.greatest(a0, b0))


def strand_rule(mode: str | None, a: Column, b: Column) -> Column:
    """``same``, ``opposite`` or no condition (None) on two strands; '.' has no strand and never fits."""
    if mode is None:
        return F.lit(True)
    if mode == "same":
        return (a == b) & (a != ".")
    if mode == "opposite":
        return (a != b) & (a != ".") & (b != ".")
    raise ValueError(f"strand mode {mode!r}")


def overlap_join(a: DataFrame, b: DataFrame, strand: str | None = None, frac_a: float = 0.0, frac_b: float = 0.0, either: bool = False, contained: bool = False, bin_width: int = BIN) -> DataFrame:
    """Pairs of rows that share at least one base: columns of ``a``, columns of ``b`` as ``b_*``, overlap.

    ``frac_a`` and ``frac_b`` ask for a least share of either length (both, or with ``either`` one of
    them); equal values are the reciprocal rule. ``contained``: ``a`` lies inside ``b``.
    """
    levels = _kept(a, bin_width, "_levels_a").join(F.broadcast(_kept(b, bin_width, "_levels_b")), F.lit(True))
    right = _binned(b, bin_width, 1, levels)
    right = right.select(*(F.col(c).alias(f"b_{c}") for c in b.columns), F.col("_bin").alias("_b"))
    left = _binned(a, bin_width, 0, levels)
    both = left.join(right, (F.col("chrom") == F.col("b_chrom")) & (F.col("_bin") == F.col("_b")))
    bp = overlap_bp(F.col("start"), F.col("end"), F.col("b_start"), F.col("b_end"))
    in_a = (F.col("b_start") >= F.col("start")) & (F.col("b_start") < F.col("end"))
    in_b = (F.col("start") > F.col("b_start")) & (F.col("start") < F.col("b_end"))
    meets = F.when(F.pmod("_bin", F.lit(2)) == 0, in_a).otherwise(in_b)
    share_a = bp >= F.lit(frac_a) * (F.col("end") - F.col("start"))
    share_b = bp >= F.lit(frac_b) * (F.col("b_end") - F.col("b_start"))
    meets = meets & ((share_a | share_b) if either else (share_a & share_b))
    if strand:
        meets = meets & strand_rule(strand, F.col("strand"), F.col("b_strand"))
    if contained:
        meets = meets & (F.col("start") >= F.col("b_start")) & (F.col("end") <= F.col("b_end"))
    return both.filter(meets).select(*a.columns, *(f"b_{c}" for c in b.columns), bp.alias("overlap"))


def intersect(a: DataFrame, b: DataFrame, **options) -> DataFrame:
    """The common segment of every overlapping pair; other columns as in ``overlap_join``."""
    hits = overlap_join(a, b, **options)
    start, end = F.greatest("start", "b_start"), F.least("end", "b_end")
    return hits.select(*(start.alias(c) if c == "start" else end.alias(c) if c == "end" else F.col(c) for c in hits.columns))


def overlap_semi(a: DataFrame, b: DataFrame, id: str = "id", **options) -> DataFrame:
    """Rows of ``a`` with any hit in ``b``; ``id`` names a unique column of ``a``."""
    hits = overlap_join(a.select(id, "chrom", "start", "end", *(["strand"] if "strand" in a.columns else [])), _slim(b), **options)
    return a.join(hits.select(id).distinct(), id, "left_semi")


def overlap_anti(a: DataFrame, b: DataFrame, id: str = "id", **options) -> DataFrame:
    """Rows of ``a`` without a hit in ``b``, e.g. outside a blacklist."""
    hits = overlap_join(a.select(id, "chrom", "start", "end", *(["strand"] if "strand" in a.columns else [])), _slim(b), **options)
    return a.join(hits.select(id).distinct(), id, "left_anti")


def overlap_count(a: DataFrame, b: DataFrame, id: str = "id", **options) -> DataFrame:
    """``a`` with ``hits``, the number of rows of ``b`` that each row meets (0 included)."""
    hits = overlap_join(a.select(id, "chrom", "start", "end", *(["strand"] if "strand" in a.columns else [])), _slim(b), **options)
    n = hits.groupBy(id).agg(F.count("*").alias("hits"))
    return a.join(n, id, "left").withColumn("hits", F.coalesce("hits", F.lit(0)).cast("long"))


def _slim(b: DataFrame) -> DataFrame:
    return b.select("chrom", "start", "end", *(["strand"] if "strand" in b.columns else []))


def nway_intersect(sets: list[DataFrame]) -> DataFrame:
    """Common segments of several sets (chrom, start, end), folded pair by pair."""
    slim = [s.select("chrom", "start", "end") for s in sets]
    return reduce(lambda x, y: intersect(x, y).select("chrom", "start", "end").distinct(), slim)


def block_overlap(a: DataFrame, b: DataFrame, id: str = "id", **options) -> DataFrame:
    """Block-aware overlap of rows with ``blocks``: pairs of ids and the shared bases of their blocks."""
    flat = lambda d: d.select(id, "chrom", "strand", F.explode("blocks").alias("_b")).select(id, "chrom", "strand", F.col("_b.start").alias("start"), F.col("_b.end").alias("end"))
    hits = overlap_join(flat(a), flat(b), **options)
    return hits.groupBy(id, f"b_{id}").agg(F.sum("overlap").alias("overlap"))


def merge_intervals(df: DataFrame, distance: int = 0, strand: bool = False, aggs: list[Column] | None = None) -> DataFrame:
    """Union of intervals that overlap or lie at most ``distance`` apart: chrom[, strand], start, end, n, aggs.

    Islands are numbered by a carried scan (``scans``) over distinct starts, each with its furthest end, so neither a
    chromosome, an island nor a pile of reads at one place is one task. Rows without chromosome (strand), start or end
    are left out.
    """
    keys = ["chrom", "strand"] if strand else ["chrom"]
    rows = df.dropna(subset=[*keys, "start", "end"])
    starts = rows.groupBy(*keys, "start").agg(F.max("end").alias("end"), F.count("*").alias("n"))
    found = scans.islands(starts, keys, distance)
    if not aggs:
        return found.groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n")).drop("island")
    found = rows.join(found.select(*keys, "start", "island"), [*keys, "start"])
    return found.groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n"), *aggs).drop("island")


def genome_coverage(df: DataFrame) -> DataFrame:
    """Depth as runs: chrom, start, end, depth (>0). Events are summed per position before a carried scan orders them."""
    edges = F.array(F.struct(F.col("start").alias("pos"), F.lit(1).alias("d")), F.struct(F.col("end").alias("pos"), F.lit(-1).alias("d")))
    events = df.filter("start < end").select("chrom", F.explode(edges).alias("e")).groupBy("chrom", F.col("e.pos").alias("start")).agg(F.sum("e.d").alias("d")).filter("d != 0")
    return scans.runs(events, ["chrom"], "depth").filter("depth > 0")


def subtract(a: DataFrame, b: DataFrame, id: str = "id", **options) -> DataFrame:
    """Parts of ``a`` that no row of ``b`` covers: columns of ``a`` with new start and end.

    Rows that can meet nothing (no chromosome, start or end, or empty) stay as they are.
    """
    slim = a.select(id, "chrom", "start", "end", *(["strand"] if "strand" in a.columns else []))
    hits = overlap_join(slim, _slim(b), **options).select(id, F.greatest("start", "b_start").alias("s"), F.least("end", "b_end").alias("e"), F.col("start").alias("a0"))
    # A last entry at each row's own end: gaps lie before entries, so a row without hits is one gap.
    ends = a.filter("start < end AND chrom IS NOT NULL").select(id, F.col("end").alias("s"), F.col("end").alias("e"), F.col("start").alias("a0"))
    before = W.partitionBy(id).orderBy("s", "e").rowsBetween(W.unboundedPreceding, -1)
    gaps = hits.unionByName(ends).withColumn("g0", F.coalesce(F.max("e").over(before), F.col("a0"))).filter("s > g0")
    cut = a.join(gaps.select(id, "g0", F.col("s").alias("g1")), id).select(*(F.col("g0").alias(c) if c == "start" else F.col("g1").alias(c) if c == "end" else F.col(c) for c in a.columns))
    return cut.unionByName(a.filter(~F.coalesce(F.col("start") < F.col("end"), F.lit(False)) | F.col("chrom").isNull()))


def closest(a: DataFrame, b: DataFrame, id: str = "id") -> DataFrame:
    """For each row of ``a`` the nearest non-overlapping end on the left and start on the right among ``b``.

    Adds left_end, left_distance, right_start, right_distance (null if there is none). An as-of join of distinct
    positions, both ways in one scan: the right side is the left side of mirrored positions. Order is kept inside cells, the
    nearest value is carried over from cell to cell; no pairs. Rows of ``a`` need a chromosome, a start and an end; ``id`` is unique.
    """
    both = lambda left, right: F.explode(F.array(F.struct(F.lit(0).alias("side"), left.alias("pos")), F.struct(F.lit(1).alias("side"), (-right).alias("pos"))))
    ask = a.select("chrom", both(F.col("start"), F.col("end")).alias("x")).select("chrom", "x.*", F.lit(1).alias("kind"))
    have = b.select("chrom", both(F.col("end"), F.col("start")).alias("x")).select("chrom", "x.*", F.lit(0).alias("kind"))
    rows = ask.unionByName(have).groupBy("chrom", "side", "pos").agg(F.min("kind").alias("least"), F.max("kind").alias("kind"))
    rows = scans.in_cells(rows.withColumn("v", F.when(F.col("least") == 0, F.col("pos"))), "pos", ["chrom", "side"])
    w = scans.inside(["chrom", "side"], "pos").rowsBetween(W.unboundedPreceding, 0)
    near = scans.carried(rows, ["chrom", "side"], {"_v": (F.max, "v")}).withColumn("near", F.coalesce(F.max("v").over(w), "_v")).filter("kind = 1 AND near IS NOT NULL")
    left = near.filter("side = 0").select("chrom", F.col("pos").alias("start"), F.col("near").alias("left_end"))
    right = near.filter("side = 1").select("chrom", (-F.col("pos")).alias("end"), (-F.col("near")).alias("right_start"))
    out = a.dropna(subset=["chrom", "start", "end"]).join(left, ["chrom", "start"], "left").join(right, ["chrom", "end"], "left").select(*a.columns, "left_end", "right_start")
    return out.withColumns({"left_distance": F.col("start") - F.col("left_end"), "right_distance": F.col("right_start") - F.col("end")})


def element_of(a: DataFrame, b: DataFrame, id: str = "id", min_bp: int | None = None, min_frac: float | None = None, negate: bool = False) -> DataFrame:
    """Rows of ``a`` with at least ``min_bp`` bases, or ``min_frac`` of their length, in one row of ``b``."""
    hits = overlap_join(a.select(id, "chrom", "start", "end"), b.select("chrom", "start", "end"), frac_a=min_frac or 0.0)
    if min_bp:
        hits = hits.filter(F.col("overlap") >= min_bp)
    return a.join(hits.select(id).distinct(), id, "left_anti" if negate else "left_semi")


def window_aggregate(sites: DataFrame, signal: DataFrame, value: str, reach: int = 0, id: str = "id") -> DataFrame:
    """Signal within ``reach`` bases of each site: n, total, least, most and the position of the most."""
    wide = sites.select(id, "chrom", F.greatest(F.col("start") - reach, F.lit(0)).alias("start"), (F.col("end") + reach).alias("end"))
    hits = overlap_join(wide, signal.select("chrom", "start", "end", F.col(value).alias("v")))
    per = hits.groupBy(id).agg(
        F.count("*").alias("n"), F.sum("b_v").alias("total"), F.min("b_v").alias("least"), F.max("b_v").alias("most"),
        F.max(F.struct("b_v", (-F.col("b_start")).alias("s")))["s"].alias("_at"),
    )
    out = sites.join(per, id, "left")
    return out.withColumns({"n": F.coalesce("n", F.lit(0)), "total": F.coalesce("total", F.lit(0)), "most_at": -F.col("_at")}).drop("_at")


def tile(sizes: DataFrame, width: int, step: int | None = None) -> DataFrame:
    """Windows of ``width`` every ``step`` bases over (chrom, length); the last ones are clipped."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(step or width).cast("long")))
    out = sizes.filter("length > 0").select("chrom", "length", starts.alias("start"))
    return out.select("chrom", "start", F.least(F.col("start") + width, F.col("length")).alias("end"))


def tile_hits(sizes: DataFrame, b: DataFrame, width: int, hits: dict[str, Column] | None = None) -> DataFrame:
    """``tile(sizes, width)`` with ``hits``, the number of rows of ``b`` that each window meets (0 included); one row of ``sizes`` per chromosome.

    ``hits``: name -> condition, counts of several kinds of rows in one pass. An interval meets the windows from that of its first base
    to that of its last one, so windows are named by arithmetic, and rows move once as counts; no intervals are joined.
    """
    kinds = hits or {"hits": F.lit(True)}
    known = b.filter("start < end").join(F.broadcast(sizes.select("chrom", "length")), "chrom")
    at = lambda pos: (F.floor(pos / width) * width).cast("long")
    first, last = F.greatest(F.col("start"), F.lit(0)), F.least(F.col("end"), F.col("length")) - 1
    meets = F.explode(F.when(first <= last, F.sequence(at(first), at(last), F.lit(width).cast("long"))))
    met = known.select("chrom", meets.alias("start"), F.lit(None).cast("long").alias("end"), *(F.when(c, 1).otherwise(0).cast("long").alias(k) for k, c in kinds.items()))
    rows = tile(sizes, width).select("chrom", "start", "end", *(F.lit(0).cast("long").alias(k) for k in kinds)).unionByName(met)
    return rows.groupBy("chrom", "start").agg(F.max("end").alias("end"), *(F.sum(k).alias(k) for k in kinds))


def chop(df: DataFrame, width: int, step: int | None = None) -> DataFrame:
    """Intervals cut into windows of ``width`` every ``step`` bases from their start; the last ones end with the interval."""
    starts = F.explode(F.sequence(F.col("start").cast("long"), F.col("end") - 1, F.lit(step or width).cast("long")))
    out = df.filter("start < end").withColumn("_s", starts)
    return out.withColumns({"end": F.least(F.col("_s") + width, F.col("end")), "start": F.col("_s")}).drop("_s")


def slop(df: DataFrame, left: int, right: int, stranded: bool = False, sizes: DataFrame | None = None) -> DataFrame:
    """Extend intervals; with ``stranded`` left is upstream. Clipped at 0 and, given sizes, at the ends."""
    minus = (F.col("strand") == "-") if stranded else F.lit(False)
    start = F.greatest(F.col("start") - F.when(minus, right).otherwise(left), F.lit(0))
    end = F.col("end") + F.when(minus, left).otherwise(right)
    out = df.withColumns({"start": start, "end": end})
    return clip_to_chrom(out, sizes) if sizes is not None else out


def shift(df: DataFrame, plus: int, minus: int) -> DataFrame:
    """Move intervals by strand; starts stop at 0."""
    by = F.when(F.col("strand") == "-", minus).otherwise(plus)
    return df.withColumns({"start": F.greatest(F.col("start") + by, F.lit(0)), "end": F.greatest(F.col("end") + by, F.lit(1))})


def clip_to_chrom(df: DataFrame, sizes: DataFrame) -> DataFrame:
    """Clip to [0, length) and drop what lies outside or on unknown chromosomes."""
    out = df.join(sizes.select("chrom", "length"), "chrom")
    out = out.withColumns({"start": F.greatest("start", F.lit(0)), "end": F.least("end", "length")})
    return out.filter("start < end").select(*df.columns)


def tss(df: DataFrame) -> DataFrame:
    """The first base of each interval, by strand."""
    at = F.when(F.col("strand") == "-", F.col("end") - 1).otherwise(F.col("start"))
    return df.withColumns({"start": at, "end": at + 1})


def tts(df: DataFrame) -> DataFrame:
    """The last base of each interval, by strand."""
    at = F.when(F.col("strand") == "-", F.col("start")).otherwise(F.col("end") - 1)
    return df.withColumns({"start": at, "end": at + 1})


def bed12_to_bed6(df: DataFrame) -> DataFrame:
    """A row per block, with its number from 0."""
    out = df.select(*(c for c in df.columns if c not in ("start", "end", "blocks")), F.posexplode("blocks").alias("block", "_b"))
    return out.withColumns({"start": F.col("_b.start"), "end": F.col("_b.end")}).drop("_b")


def exons_to_bed12(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the same keys as one row with ordered ``blocks``."""
    blocks = F.array_sort(F.collect_list(F.struct("start", "end")))
    return df.groupBy(*keys).agg(F.min("start").alias("start"), F.max("end").alias("end"), blocks.alias("blocks"))


def widen_short(df: DataFrame, span: int) -> DataFrame:
    """Intervals shorter than ``span`` grow to it around their centre; others stay."""
    grow = span - (F.col("end") - F.col("start"))
    left = F.floor(grow / 2)
    start = F.when(grow > 0, F.greatest(F.col("start") - left, F.lit(0))).otherwise(F.col("start"))
    end = F.when(grow > 0, F.col("end") + (grow - left)).otherwise(F.col("end"))
    return df.withColumns({"start": start, "end": end})


def extend_short(df: DataFrame, span: int, up: int, down: int, sizes: DataFrame | None = None) -> DataFrame:
    """Intervals shorter than ``span`` become their centre base with ``up`` and ``down`` bases on its sides by strand; others stay."""
    short = F.col("end") - F.col("start") < span
    mid = F.floor((F.col("start") + F.col("end")) / 2)
    grown = slop(df.filter(short).withColumns({"start": mid, "end": mid + 1}), up, down, stranded=True, sizes=sizes)
    return df.filter(~short).unionByName(grown)


def overlap_type(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Where ``b`` lies on ``a``: whole, left, right or overlay; null if they do not meet."""
    meets = F.least(a1, b1) > F.greatest(a0, b0)
    return F.when(~meets, None).when((b0 >= a0) & (b1 <= a1), "whole").when((b0 < a0) & (b1 > a1), "overlay").when(b0 < a0, "left").otherwise("right")


def distance_to(df: DataFrame, center: Column, anchor: str = "start") -> Column:
    """Signed distance of a position from a gene end: negative upstream of it, by strand."""
    at = {"start": F.when(F.col("b_strand") == "-", F.col("b_end") - 1).otherwise(F.col("b_start")), "end": F.when(F.col("b_strand") == "-", F.col("b_start")).otherwise(F.col("b_end") - 1)}[anchor]
    return F.when(F.col("b_strand") == "-", at - center).otherwise(center - at)


def distance_class(d: Column, up_kb: list[int], down_kb: list[int] = (), name: str = "TSS") -> Column:
    """``TSS (<=1kb)``, ``TSS (1-2kb)``, ... by absolute distance, else ``intergenic``; the first class wins.

    The limits upstream and downstream make one list of classes for both sides.
    """
    out, low = None, 0
    for k in sorted({*up_kb, *down_kb}):
        label = f"{name} (<={k}kb)" if low == 0 else f"{name} ({low}-{k}kb)"
        hit = F.abs(d) <= k * 1000
        out = F.when(hit, label) if out is None else out.when(hit, label)
        low = k
    return F.lit("intergenic") if out is None else out.otherwise("intergenic")


def sort_genomic(df: DataFrame, chroms: list[str] | None = None) -> DataFrame:
    """Rows by chromosome, start and end; with ``chroms`` in that order of chromosomes, others dropped."""
    if chroms is None:
        return df.orderBy("chrom", "start", "end")
    return df.filter(F.col("chrom").isin(chroms)).orderBy(F.array_position(F.array(*map(F.lit, chroms)), F.col("chrom")), "start", "end")


def genomic_number(df: DataFrame, ties: list[str] = ("end",)) -> DataFrame:
    """``df`` with ``number``, the place of each row by chromosome, start and ``ties``, from 1, over all chromosomes."""
    before = df.groupBy("chrom").agg(F.count("*").alias("_n")).withColumn("_n", F.sum("_n").over(W.orderBy("chrom").rowsBetween(W.unboundedPreceding, -1)))  # a row per chromosome
    out = scans.numbered(df, ["chrom"], "start", list(ties)).join(before, "chrom")
    return out.withColumn("number", F.col("_idx") + F.coalesce("_n", F.lit(0)) + 1).drop("_idx", "_n")


def jaccard(a: DataFrame, b: DataFrame) -> DataFrame:
    """Shared bases over united bases of two sets, each merged first."""
    x, y = (merge_intervals(d).select("chrom", "start", "end") for d in (a, b))
    both = intersect(x, y).agg(F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0)).alias("shared"))
    total = x.unionByName(y).agg(F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0)).alias("total"))
    return both.join(total, F.lit(True)).select("shared", (F.col("total") - F.col("shared")).alias("united"), F.try_divide("shared", F.col("total") - F.col("shared")).alias("jaccard"))


def overlap_groups(df: DataFrame, strand: bool = False) -> DataFrame:
    """``df`` with ``island`` and ``group_size``: rows in the same island of overlapping intervals (1: overlaps nothing)."""
    keys = ["chrom", "strand"] if strand else ["chrom"]
    found = scans.islands(df, keys, touching=False).drop("_cell")
    return found.join(found.groupBy(*keys, "island").agg(F.count("*").alias("group_size")), [*keys, "island"])

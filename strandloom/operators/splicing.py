"""Splicing events: inclusion levels, differences, and the isoforms behind an event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import filters as X
from .sets import psi
from .stats import bh_adjust


def _mean(levels):
    known = F.filter(levels, lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, x: a + x), F.size(known))


def _difference(first, second):
    """Difference of the means of two arrays of levels, to three digits, half away from zero.

    Levels are counted in whole thousandths, so the difference is a fraction of whole numbers and a tie is a tie.
    """
    known = lambda x: F.filter(x, lambda v: v.isNotNull())
    total = lambda x: F.aggregate(known(x), F.lit(0).cast("long"), lambda a, v: a + F.round(v * 1000).cast("long"))
    n1, n2 = F.size(known(first)).cast("long"), F.size(known(second)).cast("long")
    top, low = total(first) * n2 - total(second) * n1, n1 * n2
    twice = 2 * F.abs(top) + low
    size = (twice - twice % (2 * low)) / (2 * low)
    return F.when(low > 0, F.signum(top) * size / 1000)


def splicing_stats(events: DataFrame) -> DataFrame:
    """``events`` (inc1, skp1, inc2, skp2, inc_len, skp_len, p) with level1, level2 (arrays), diff and fdr.

    Levels have three digits and are null without reads; the difference of their means too, and it is null if a
    group has no level. Events whose counts are all zero in a group are dropped before p values are adjusted.
    """
    valid = X.valid_event_counts(events, [("inc1", "skp1"), ("inc2", "skp2")])
    level = lambda k: psi(F.col(f"inc{k}"), F.col(f"skp{k}"), F.col("inc_len"), F.col("skp_len"), 3)
    out = valid.withColumns({"level1": level(1), "level2": level(2)})
    out = out.withColumn("diff", _difference(F.col("level1"), F.col("level2")))
    return bh_adjust(out, "p").withColumnRenamed("padj", "fdr")


def splicing_to_transcripts(events: DataFrame, exons: DataFrame, p: float = 0.05, fdr: float = 0.05, diff: float = 0.0) -> DataFrame:
    """Significant skipped-exon events with mean counts and levels, exon lengths and the isoforms that hold or skip the exon.

    ``events``: event, chrom, strand, exon_start, exon_end, up_start, up_end, down_start, down_end, the columns of
    ``splicing_stats``; ``exons``: id, chrom, start, end. Events with a null level, p, fdr or difference go. On the
    minus strand the flanks change places. Events that no isoform holds or skips say ``unknown``.
    """
    full = lambda c: F.forall(c, lambda x: x.isNotNull())
    kept = X.filter_events(events, p, fdr, diff).filter(full("level1") & full("level2") & (F.size("level1") > 0) & (F.size("level2") > 0))
    ids = X.exon_isoforms(kept, exons)
    up, down, own = F.col("up_end") - F.col("up_start"), F.col("down_end") - F.col("down_start"), F.col("exon_end") - F.col("exon_start")
    minus = F.col("strand") == "-"
    known = lambda c: F.when(F.col(c) == "", "unknown").otherwise(F.col(c)).alias(c)
    means = [_mean(F.col(c)).alias(f"{c}_mean") for c in ("inc1", "skp1", "inc2", "skp2", "level1", "level2")]
    return kept.join(ids, "event").select(
        "event", *means, own.alias("exon_length"), F.when(minus, down).otherwise(up).alias("up_length"), F.when(minus, up).otherwise(down).alias("down_length"),
        (up + down + own).alias("inclusion_length"), (up + down).alias("skipping_length"), known("inclusion"), known("skipping"),
    )

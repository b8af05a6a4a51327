"""Row filters with the cutoffs of the peak, splicing, site and expression tables, and small lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .matrix import first_by


def filter_peaks(df: DataFrame, min_signal: float = 2.0, min_pval: float = 4.0) -> DataFrame:
    """Peaks by fold and -log10 p."""
    return df.filter((F.col("signal") >= min_signal) & (F.col("pvalue") >= min_pval))


def filter_cnv(df: DataFrame, gain: float = 5.0, size: int = 50_000) -> DataFrame:
    return df.filter((F.col("cn") >= gain) & (F.col("end") - F.col("start") >= size))


def keep_chroms(df: DataFrame, chroms: list[str] | None = None, pattern: str | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """Rows on listed or matching chromosomes, without dropped ones."""
    keep = F.lit(True)
    if chroms is not None:
        keep = keep & F.col("chrom").isin(chroms)
    if pattern:
        keep = keep & F.col("chrom").rlike(pattern)
    return df.filter(keep & ~F.col("chrom").isin(list(drop))) if drop else df.filter(keep)


def filter_events(df: DataFrame, p: float = 0.05, fdr: float = 0.05, diff: float = 0.0) -> DataFrame:
    """Splicing events by p, FDR and |inclusion difference|; null differences fail."""
    return df.filter((F.col("p") <= p) & (F.col("fdr") <= fdr) & (F.abs("diff") >= diff))


def valid_event_counts(df: DataFrame, groups: list[tuple[str, str]]) -> DataFrame:
    """Events whose counts (pairs of array columns: inclusion, skipping) are not all zero in any group."""
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0)))
    keep = F.lit(True)
    for inc, skp in groups:
        keep = keep & (total(inc) + total(skp) > 0)
    return df.filter(keep)


def motif_offset_sites(df: DataFrame, index: int, offset: int, within: int = 0) -> DataFrame:
    """Sites whose motif index is ``index`` (or at most ``within`` away), moved by ``offset`` along the strand."""
    by = F.when(F.col("strand") == "-", -offset).otherwise(offset)
    out = df.filter(F.abs(F.col("motif_index") - index) <= within)
    return out.withColumns({"start": F.greatest(F.col("start") + by, F.lit(0)), "end": F.greatest(F.col("end") + by, F.lit(1))})


def significant_peaks(df: DataFrame, min_count: float, p: float, padj: float, fc: float) -> DataFrame:
    """Peaks by mean, p, padj and log2 fold change; any null fails."""
    return df.filter((F.col("mean") >= min_count) & (F.col("p") <= p) & (F.col("padj") <= padj) & (F.col("log2fc") >= fc))


def one_sided_fold(df: DataFrame, control: str = "control", treat: str = "treat") -> DataFrame:
    """log2fc set to -99 where a peak is in the control only and to 99 where it is in the treatment only."""
    return df.withColumn("log2fc", F.when(F.col("label") == control, -99.0).when(F.col("label") == treat, 99.0).otherwise(F.col("log2fc")))


def clean_id(col: Column) -> Column:
    """Without quotes and version suffix."""
    return F.regexp_replace(F.regexp_replace(col, '"', ""), r"\.\d+$", "")


def id_convert(df: DataFrame, lookup: DataFrame, column: str, source: str, target: str) -> DataFrame:
    """``df`` with the target id of each version-stripped id; the first mapping counts, unmatched are null."""
    one = first_by(lookup, [source], [F.col(target)]).select(F.col(source).alias("_k"), F.col(target).alias(target))
    return df.withColumn("_k", clean_id(F.col(column).cast("string"))).join(one, "_k", "left").drop("_k")


def join_expression_clinical(expr: DataFrame, clinical: DataFrame, pattern: str) -> DataFrame:
    """Expression of matching samples with their clinical columns."""
    return expr.filter(F.col("sample").rlike(pattern)).join(clinical, "sample")


def survival_groups(expr: DataFrame, low: float = 0.25, high: float = 0.75) -> DataFrame:
    """Samples above the upper or below the lower quantile of each gene: gene, sample, group."""
    cut = expr.groupBy("gene").agg(F.percentile("value", F.array(F.lit(low), F.lit(high))).alias("q"))
    out = expr.join(cut, "gene")
    group = F.when(F.col("value") >= F.get("q", F.lit(1)), "high").when(F.col("value") <= F.get("q", F.lit(0)), "low")
    return out.withColumn("group", group).filter(F.col("group").isNotNull()).select("gene", "sample", "group")


def exon_position(blocks: DataFrame) -> DataFrame:
    """Each block with its place in the transcript: single, first, internal or last, by strand."""
    n = F.size("blocks")
    out = blocks.select("id", "chrom", "strand", n.alias("n"), F.posexplode("blocks").alias("i", "b"))
    at = F.when(F.col("strand") == "-", F.col("n") - 1 - F.col("i")).otherwise(F.col("i"))
    kind = F.when(F.col("n") == 1, "single").when(at == 0, "first").when(at == F.col("n") - 1, "last").otherwise("internal")
    return out.select("id", "chrom", "strand", F.col("b.start").alias("start"), F.col("b.end").alias("end"), kind.alias("place"))


def exon_length_class(exons: DataFrame) -> DataFrame:
    """short, median or long by the global quartiles of length."""
    q = exons.agg(F.percentile(F.col("end") - F.col("start"), F.array(F.lit(0.25), F.lit(0.75))).alias("_q"))  # one row
    size = F.col("end") - F.col("start")
    kind = F.when(size < F.get("_q", F.lit(0)), "short").when(size > F.get("_q", F.lit(1)), "long").otherwise("median")
    return exons.join(F.broadcast(q), F.lit(True)).withColumn("size_class", kind).drop("_q")


def exon_isoforms(events: DataFrame, exons: DataFrame) -> DataFrame:
    """Isoforms that hold an event's exon and its flanks, and those with the flanks only.

    ``events``: event, chrom, exon_start, exon_end, up_end, down_start; ``exons``: id, chrom, start, end.
    """
    have = lambda on: events.join(exons, on).groupBy("event").agg(F.collect_set("id").alias("ids"))
    same = events["chrom"] == exons["chrom"]
    exact = have(same & (events["exon_start"] == exons["start"]) & (events["exon_end"] == exons["end"])).withColumnRenamed("ids", "e")
    up = have(same & (events["up_end"] == exons["end"])).withColumnRenamed("ids", "u")
    down = have(same & (events["down_start"] == exons["start"])).withColumnRenamed("ids", "d")
    none = F.array().cast("array<string>")
    out = events.select("event").join(exact, "event", "left").join(up, "event", "left").join(down, "event", "left")
    e, flank = F.coalesce("e", none), F.array_intersect(F.coalesce("u", none), F.coalesce("d", none))
    return out.select("event", F.array_join(F.array_sort(F.array_intersect(e, flank)), ",").alias("inclusion"), F.array_join(F.array_sort(F.array_except(flank, e)), ",").alias("skipping"))

"""Chains of the operators that a whole assay needs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import filters as X
from . import intervals as I
from . import methylation as ME
from . import placement
from . import sequence as Q
from . import sets as T
from . import signal as S
from .stats import bh_adjust, fisher_exact
from .stored import written


def overlap_fisher(a: DataFrame, b: DataFrame, sizes: DataFrame) -> DataFrame:
    """Overlap of two interval sets as a contingency table, with odds ratio and p.

    The number of possible places is the genome over the sum of both mean lengths, as in the usual tool.
    """
    hits = I.overlap_join(a.select("chrom", "start", "end"), b.select("chrom", "start", "end")).agg(F.count("*").alias("both"))
    side = lambda d, k: d.agg(F.count("*").alias(f"n_{k}"), F.avg(F.col("end") - F.col("start")).alias(f"w_{k}"))
    t = hits.join(side(a, "a"), F.lit(True)).join(side(b, "b"), F.lit(True)).join(sizes.agg(F.sum("length").alias("genome")), F.lit(True))
    places = F.greatest(F.floor(F.col("genome") / (F.col("w_a") + F.col("w_b"))), F.col("n_a") + F.col("n_b"))
    t = t.withColumns({"only_a": F.greatest(F.col("n_a") - F.col("both"), F.lit(0)), "only_b": F.greatest(F.col("n_b") - F.col("both"), F.lit(0))})
    t = t.withColumn("neither", F.greatest(places - F.col("both") - F.col("only_a") - F.col("only_b"), F.lit(0)))
    ratio = F.try_divide(F.col("both") * F.col("neither") * 1.0, F.col("only_a") * F.col("only_b"))
    return t.select("both", "only_a", "only_b", "neither", ratio.alias("odds"), fisher_exact("both", "only_a", "only_b", "neither").alias("p"))


def replicate_overlap(a: DataFrame, b: DataFrame, blacklist: DataFrame, sizes: DataFrame) -> DataFrame:
    """Common segments of two replicates outside a blacklist: rows, bases, and the Fisher figures."""
    x, y = (I.overlap_anti(d, blacklist) for d in (a, b))
    shared = I.intersect(x, y).agg(F.count("*").alias("segments"), F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0)).alias("bases"))
    return shared.join(overlap_fisher(x, y, sizes), F.lit(True))


def methylation_pipeline(reads: DataFrame, genome: DataFrame) -> DataFrame:
    """Reads (qname, chrom, pos, strand, cigar, xm) to bedMethyl rows of every cytosine that was called."""
    from .reads import deduplicate, duplicate_key

    # One read is left of each place, and its calls lie where the place is.
    place = ["chrom", "dup_strand", "dup_start"]
    calls = ME.extract_calls(deduplicate(duplicate_key(reads), place, ["qname"]), keep=place[1:])
    cov = ME.site_methylation(calls, read=place).select("chrom", "_c", "pos", "meth", "unmeth")
    return ME.bedmethyl(ME.cytosine_report(genome, cov, threshold=1))


def hotspot_density(cuts: DataFrame, sizes: DataFrame, hotspots: DataFrame) -> DataFrame:
    """Per hotspot: highest density of the cuts that are left after bad spots are gone, and where, as a fixed-width peak."""
    density = S.tag_density(S.filter_bad_spots(S.cut_counts(cuts)), sizes, counted=True)
    top = I.window_aggregate(hotspots, density, "density").select("id", "chrom", F.col("most").alias("density"), F.col("most_at").alias("start"))
    return S.place_peaks(top.filter("start IS NOT NULL"))


def hotspot_chain(reads: DataFrame, sites: DataFrame, sizes: DataFrame, max_fdr: float = 0.05, min_width: int = 50, distance: int = 150) -> dict[str, DataFrame]:
    """Reads and tested sites to hotspots, density, peaks and the share of cuts in hotspots.

    ``reads``: chrom, start, end, strand; ``sites``: chrom, start, end, fdr. Cuts lose bad spots and are summed per window; sites up to ``max_fdr`` are
    merged to ``hotspots`` (id, chrom, start, end); peaks stand on the summits of the ``density`` in hotspots, or on its largest step where a
    hotspot has none; ``spot`` has one row: inside, total, spot. Without sites there are no hotspots and no peaks.
    """
    counts = written(S.filter_bad_spots(S.cut_counts(S.read_cuts(reads.dropna(subset=["chrom", "start", "end"])))), "cuts")
    hot = S.hotspot_merge(sites, distance, min_width, "fdr", max_fdr).select(F.concat_ws(":", "chrom", "start").alias("id"), "chrom", "start", "end")
    hot = written(hot, "hotspots")
    density = written(S.tag_density(counts, sizes, counted=True), "density")
    top = S.summits(density, ["chrom"], "start", "density").withColumn("score", F.col("density"))
    at = counts.select("chrom", "start", (F.col("start") + 1).alias("end"), "n")
    inside = I.overlap_join(at, hot.select("chrom", "start", "end")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("inside"))  # hotspots are disjoint
    spot = inside.join(counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total")), F.lit(True)).withColumn("spot", F.try_divide("inside", "total"))
    return {"hotspots": hot, "density": density, "peaks": placement.place_in_hotspots(top, hot, density, sizes), "spot": spot}


def non_peak_regions(peaks: DataFrame, exons: DataFrame, halo: int) -> DataFrame:
    """Exon space without peaks and a halo around them."""
    space = I.merge_intervals(exons, strand=True).select("chrom", "strand", "start", "end").withColumn("id", F.concat_ws(":", "chrom", "strand", "start"))
    return I.subtract(space, I.slop(peaks.select("chrom", "start", "end", "strand"), halo, halo), strand="same")


def pool_two_sets(a: DataFrame, b: DataFrame, mode: str = "merge", min_len: int = 1, max_len: int = 10**9) -> DataFrame:
    """Overlapping peaks of two sets of the same gene and strand as one, by union or intersection.

    Inputs: id, gene, chrom, start, end, strand. Peaks without a partner stay; lengths outside the limits
    are dropped after pooling.
    """
    hits = I.overlap_join(a, b, strand="same").filter(F.col("gene") == F.col("b_gene"))
    lo, hi = (F.least("start", "b_start"), F.greatest("end", "b_end")) if mode == "merge" else (F.greatest("start", "b_start"), F.least("end", "b_end"))
    both = hits.select("gene", "chrom", lo.alias("start"), hi.alias("end"), "strand", F.lit("a,b").alias("labels"))
    alone = lambda d, col, label: d.join(hits.select(F.col(col).alias("id")).distinct(), "id", "left_anti").select("gene", "chrom", "start", "end", "strand", F.lit(label).alias("labels"))
    out = both.distinct().unionByName(alone(a, "id", "a")).unionByName(alone(b, "b_id", "b"))
    return out.filter(F.col("end") - F.col("start") >= min_len).filter(F.col("end") - F.col("start") <= max_len)


def gc_bias(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Per percent of GC: windows, reads, and mean coverage over the overall mean. windows: id, gc; counts: id, hits."""
    x = windows.filter(F.col("gc").isNotNull()).join(counts.select("id", "hits"), "id", "left").fillna(0, ["hits"])
    mean = x.agg(F.avg("hits").alias("_m"))
    per = x.groupBy(F.round(F.col("gc") * 100).cast("int").alias("gc")).agg(F.count("*").alias("windows"), F.sum("hits").alias("reads"), F.avg("hits").alias("_h"))
    return per.join(F.broadcast(mean), F.lit(True)).select("gc", "windows", "reads", F.try_divide("_h", "_m").alias("normalized"))


def peak_profile(peaks: DataFrame, genes: DataFrame, reach: int, step: int) -> DataFrame:
    """Peak centres around gene starts, by offset in steps along the gene's strand."""
    ends = I.slop(I.tss(genes.select("chrom", "start", "end", "strand", F.col("start").alias("g0"), F.col("end").alias("g1"))), reach, reach)
    mid = F.floor((F.col("start") + F.col("end")) / 2)
    hits = I.overlap_join(peaks.withColumns({"start": mid, "end": mid + 1}), ends).withColumns({"b_start": F.col("b_g0"), "b_end": F.col("b_g1")})
    return hits.groupBy((F.floor(I.distance_to(hits, F.col("start")) / step) * step).alias("offset")).agg(F.count("*").alias("n"))


def pca(long: DataFrame, samples: list[str], k: int = 2) -> DataFrame:
    """Principal components of samples over features: signed weights of the samples, and the share of variance of each.

    A component has no sign of its own; here its largest weight (of equal ones that of the first sample) is positive.
    """
    from pyspark.ml.feature import PCA, VectorAssembler

    wide = long.groupBy("id").pivot("sample", samples).agg(F.first("value")).fillna(0.0, samples)
    mean = F.lit(0.0)
    for s in samples:
        mean = mean + F.col(s)
    centred = wide.select("id", *((F.col(s) - mean / len(samples)).alias(s) for s in samples))
    model = PCA(k=k, inputCol="v", outputCol="pc").fit(VectorAssembler(inputCols=samples, outputCol="v").transform(centred))
    load = model.pc.toArray().copy()  # samples x k numbers
    for i in range(k):
        top = max(range(len(samples)), key=lambda j: (round(abs(load[j, i]), 9), -j))
        load[:, i] *= -1 if load[top, i] < 0 else 1
    rows = [(s, i + 1, float(load[j, i]), float(model.explainedVariance[i])) for j, s in enumerate(samples) for i in range(k)]
    return long.sparkSession.createDataFrame(rows, "sample string, component int, weight double, variance double")


def clip_sites(mutations: DataFrame, truncations: DataFrame, genome: DataFrame, motif: str, base: str = "A", reach: int = 5, min_ratio: float = 0.1, min_mutations: int = 2) -> DataFrame:
    """Sites of two kinds moved to the base before them, kept where that is ``base``, pooled, with ``has_motif``.

    ``mutations``: id, chrom, start, end, strand, m, k, those with enough of m / k and of m count; ``truncations``:
    id, chrom, start, end, strand, m. ``has_motif``: the motif stands within ``reach`` bases on the site's strand.
    ``genome``: id (the chromosome), seq.
    """
    columns = ["chrom", "start", "end", "strand", F.col("m").alias("reads")]
    one, two = (I.shift(d.select(*columns), -1, 1) for d in (T.enriched_sites(mutations, min_ratio, min_mutations=min_mutations), truncations))
    one, two = (Q.filter_bed_by_sequence(d, genome, base).drop("seq") for d in (one, two))
    # A kept site has as many letters as ``base``, unless it ends behind its chromosome; what is behind has no letters.
    pooled = T.combine_sites(one, two).withColumn("site", F.struct("start", "end"))
    around = I.slop(pooled, reach, reach).withColumn("end", F.least("end", F.col("site.start") + len(base) + reach))
    around = Q.short_sequence(around, genome, len(base) + 2 * reach)
    return around.select("chrom", "site.start", "site.end", "strand", "kind", "reads", F.col("seq").rlike(Q.iupac_regex(motif)).alias("has_motif"))


def differential_peaks(peaks: DataFrame, counts: DataFrame, expression: DataFrame | None = None, changes: DataFrame | None = None) -> DataFrame:
    """Peaks with fold change, p, adjusted p, and what is known of their genes.

    ``peaks``: id, gene, label (control, treat or shared); ``counts``: id, cell (ip_treat, in_treat, ip_control,
    in_control), value, one row per replicate; ``expression``: gene, control, treat; ``changes``: gene, log2fc, p. The
    fold change comes from mean counts and is -99 or 99 for peaks of one condition, p from Fisher's test of
    the rounded means. Genes without a change have 0 and 1; peaks without counts have nulls.
    """
    wide = counts.groupBy("id").pivot("cell", ["ip_treat", "in_treat", "ip_control", "in_control"]).agg(F.avg("value"))
    cells = [F.round(c).cast("long") for c in ("ip_treat", "in_treat", "ip_control", "in_control")]
    tested = wide.select("id", fisher_exact(*cells).alias("p"))
    out = peaks.join(T.enrichment_log2fc(counts), "id", "left").join(tested, "id", "left")
    out = bh_adjust(X.one_sided_fold(out), "p")
    if expression is not None:
        out = out.join(expression.select("gene", F.col("control").alias("gene_control"), F.col("treat").alias("gene_treat")), "gene", "left")
    if changes is not None:
        out = out.join(changes.select("gene", F.col("log2fc").alias("gene_log2fc"), F.col("p").alias("gene_p")), "gene", "left").fillna({"gene_log2fc": 0.0, "gene_p": 1.0})
    return out

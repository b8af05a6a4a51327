"""Peak sets, mutation sites, contacts and amplicon cycles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import intervals as I
from . import scans
from .stored import written


#: Bases whose scores are compared in one task.
CELL = 1024


def unique_and_shared_peaks(control: DataFrame, treat: DataFrame, pool: DataFrame, share: float = 0.8) -> DataFrame:
    """Peaks of one set only (no partner with ``share`` of either length), then pooled ones in neither; labelled.

    The rule is the same from both sides, so one join of the two sets gives the partners of both, and one join of the pool with
    what is left of them the rest. Joins read narrow written tables, not the inputs again.
    """
    opts = {"frac_a": share, "frac_b": share, "either": True}
    slim = lambda d, label: written(d.select("id", "chrom", "start", "end"), label)
    c, t, p = slim(control, "control"), slim(treat, "treat"), slim(pool, "pool")
    side = lambda k, name: F.struct(F.lit(k).alias("side"), F.col(name).alias("id"))
    met = written(I.overlap_join(c, t, **opts).select(F.explode(F.array(side(0, "id"), side(1, "b_id"))).alias("x")).select("x.*").distinct(), "partners")
    of = lambda k: met.filter(F.col("side") == k).select("id")
    lone = written(c.join(of(0), "id", "left_anti").unionByName(t.join(of(1), "id", "left_anti")).drop("id"), "lone-peaks")
    gone = I.overlap_join(p, lone, **opts).select("id").distinct()
    parts = {"control": (control, of(0)), "treat": (treat, of(1)), "shared": (pool, gone)}
    return reduce(DataFrame.unionByName, [d.join(ids, "id", "left_anti").withColumn("label", F.lit(label)) for label, (d, ids) in parts.items()])


def collapse_duplicate_peaks(df: DataFrame, label: str = "label") -> DataFrame:
    """Equal coordinates as one row with the sorted distinct labels."""
    return df.groupBy("chrom", "start", "end", "strand").agg(F.array_join(F.array_sort(F.collect_set(label)), ",").alias("labels"), F.count("*").alias("n"))


def integrate_sites(sites: DataFrame) -> DataFrame:
    """Per site: largest reads, distinct replicates, the joined distinct types and, where sites have an ``id``, all ids in order."""
    ids = [F.array_join(F.array_sort(F.collect_list("id")), ",").alias("ids")] if "id" in sites.columns else []
    return sites.groupBy("chrom", "start", "end", "strand").agg(F.max("reads").alias("reads"), F.size(F.collect_set("replicate")).cast("long").alias("replicates"), F.array_join(F.array_sort(F.collect_set("kind")), "|").alias("kinds"), *ids)


def combine_sites(a: DataFrame, b: DataFrame, names=("CIMS", "CITS"), by_id: bool = False) -> DataFrame:
    """Union of two site sets; sites in both get both names and the sum of their counts.

    ``by_id`` joins the ids of a site's rows, those of ``a`` first, instead of the names: ``id``.
    """
    if by_id:
        both = a.withColumn("_o", F.lit(0)).unionByName(b.withColumn("_o", F.lit(1)))
        ids = F.transform(F.array_sort(F.collect_list(F.struct("_o", F.col("id").cast("string").alias("id")))), lambda x: x["id"])
        return both.groupBy("chrom", "start", "end", "strand").agg(F.array_join(ids, "=").alias("id"), F.sum("reads").alias("reads"))
    both = a.withColumn("kind", F.lit(names[0])).unionByName(b.withColumn("kind", F.lit(names[1])))
    return both.groupBy("chrom", "start", "end", "strand").agg(F.array_join(F.array_sort(F.collect_set("kind")), "|").alias("kind"), F.sum("reads").alias("reads"))


def enriched_sites(sites: DataFrame, min_ratio: float, max_ratio: float = 1.0, min_mutations: int = 1) -> DataFrame:
    """Sites with mutations / coverage inside bounds, with their order by ratio and mutations."""
    out = sites.withColumn("mk", F.try_divide("m", "k")).filter((F.col("mk") >= min_ratio) & (F.col("mk") <= max_ratio) & (F.col("m") >= min_mutations))
    return out.orderBy(F.col("mk").desc(), F.col("m").desc(), F.col("k"))


def idr_filter(df: DataFrame, least: float) -> DataFrame:
    """Distinct peaks with -log10 IDR of at least ``least``, numbered in genomic order; scores capped at 1000."""
    out = df.filter(F.col("log_idr") >= least).distinct().withColumn("score", F.least("score", F.lit(1000)))
    return I.genomic_number(out, [c for c in ("end", "score", "log_idr") if c in df.columns])


def best_score_per_position(hits: DataFrame) -> DataFrame:
    """Highest motif score of each base covered by hits; empty hits cover none.

    Hits are cut at cells of ``CELL`` bases and equal pieces become one row before they move to the task of their cell, where
    their bases explode: what is moved is pieces and not bases, and a pile of hits at one place is a few rows.
    """
    cell = lambda at: F.floor(at / CELL)
    cut = hits.filter("start < end").select("chrom", "strand", "score", "start", "end", F.explode(F.sequence(cell(F.col("start")), cell(F.col("end") - 1))).alias("_cell"))
    start, end = F.greatest("start", F.col("_cell") * CELL).alias("start"), F.least("end", (F.col("_cell") + 1) * CELL).alias("end")
    pieces = cut.select("chrom", "strand", "_cell", "score", start, end).groupBy("chrom", "strand", "_cell", "start", "end").agg(F.max("score").alias("score"))
    pieces = pieces.repartition(int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions")), "chrom", "strand", "_cell")
    each = pieces.select("chrom", "strand", "_cell", "score", F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("pos"))
    return each.groupBy("chrom", "strand", "_cell", "pos").agg(F.max("score").alias("score")).drop("_cell")


def read_start_regions(reads: DataFrame, reach: int) -> DataFrame:
    """Distinct read starts, widened and merged per strand."""
    starts = I.tss(reads).select("chrom", "start", "end", "strand").distinct()
    return I.merge_intervals(I.slop(starts, reach, reach), strand=True)


def best_peak_per_gene(peaks: DataFrame) -> DataFrame:
    """The peak with the largest absolute fold change of each gene; ties by id."""
    w = W.partitionBy("gene").orderBy(F.abs("log2fc").desc_nulls_last(), "id")
    return peaks.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def cnv_seeds(segments: DataFrame, gain: float, min_size: int) -> DataFrame:
    """Segments whose copy number 2^(log2 + 1) and length pass."""
    out = segments.withColumn("cn", F.pow(F.lit(2.0), F.col("log2") + 1))
    return out.filter((F.col("cn") >= gain) & (F.col("end") - F.col("start") >= min_size))


def centromere_spans(bed: DataFrame, pad: int = 20000) -> DataFrame:
    """One span per chromosome. Each further row, in order of start and end, widens the span and then pads it on both sides.

    So the first row is padded as often as there are further rows, a later one as often as rows follow it, itself
    included. Spans do not stop at 0.
    """
    rows = scans.numbered(bed.select("chrom", "start", "end"), ["chrom"], "start", ["end"])
    rows = rows.join(rows.groupBy("chrom").agg(F.count("*").alias("_n")), "chrom")
    by = (F.col("_n") - F.greatest("_idx", F.lit(1))) * pad
    return rows.groupBy("chrom").agg(F.min(F.col("start") - by).alias("start"), F.max(F.col("end") + by).alias("end"))


def canonical_contacts(pairs: DataFrame) -> DataFrame:
    """Contacts (chrom1, pos1, chrom2, pos2) with the smaller end first."""
    a, b = F.struct(F.col("chrom1").alias("c"), F.col("pos1").alias("p")), F.struct(F.col("chrom2").alias("c"), F.col("pos2").alias("p"))
    lo, hi = F.least(a, b), F.greatest(a, b)
    return pairs.withColumns({"_lo": lo, "_hi": hi}).withColumns({"chrom1": F.col("_lo.c"), "pos1": F.col("_lo.p"), "chrom2": F.col("_hi.c"), "pos2": F.col("_hi.p")}).drop("_lo", "_hi")


def contact_dedup(pairs: DataFrame, order: str = "id", wobble: int = 0) -> DataFrame:
    """One contact, the first by ``order``, of each group of the same canonical ends.

    With ``wobble`` contacts are one group if their first ends are linked by steps of at most so many bases and
    the second ends within that stretch too. Equal ends are one row from the start, so the scans see distinct
    positions and a hot locus is no single task.
    """
    p = canonical_contacts(pairs)
    keys = ["chrom1", "pos1", "chrom2", "pos2"]
    first = p.groupBy(*keys).agg(F.min(order).alias(order))
    if wobble:
        first = written(first, "contacts")
        for near, pos, by in (("_near1", "pos1", ["chrom1", "chrom2"]), ("_near2", "pos2", ["chrom1", "chrom2", "_near1"])):
            places = first.select(*by, pos, F.col(pos).alias("start"), F.col(pos).alias("end")).distinct()
            linked = scans.islands(places, by, wobble).select(*by, pos, F.col("island").alias(near))
            keys = [*by, near, *(["pos2"] if pos == "pos1" else [])]
            first = written(first.join(linked, [*by, pos]).groupBy(*keys).agg(F.min(order).alias(order)), "contacts")
    return p.join(first.select(order), order, "left_semi")


def contact_matrix(pairs: DataFrame, resolution: int, min_mapq: int = 0) -> DataFrame:
    """Counts of contacts per pair of bins."""
    p = canonical_contacts(pairs.filter(F.col("mapq") >= min_mapq))
    bin_ = lambda c: F.floor(F.col(c) / resolution)
    return p.groupBy("chrom1", bin_("pos1").alias("bin1"), "chrom2", bin_("pos2").alias("bin2")).agg(F.count("*").alias("n"))


def assign_fragment(ends: DataFrame, cuts: DataFrame) -> DataFrame:
    """Fragment of each position: the number of cut sites at or before it on its chromosome.

    Cuts of earlier cells are carried over as one number; only a cell's own cuts are ordered with its
    positions. Rows without a chromosome or position are left out, repeated cuts count once.
    """
    cut = cuts.select(F.lit(None).cast(ends.schema["id"].dataType).alias("id"), "chrom", "pos", F.lit(0).alias("kind")).distinct()
    both = scans.in_cells(ends.select("id", "chrom", "pos", F.lit(1).alias("kind")).unionByName(cut), "pos")
    both = scans.carried(both.withColumn("_cut", 1 - F.col("kind")), ["chrom"], {"_before": (F.sum, "_cut")})
    w = scans.inside(["chrom"], "pos", "kind").rowsBetween(W.unboundedPreceding, 0)
    return both.withColumn("fragment", F.coalesce("_before", F.lit(0)) + F.sum("_cut").over(w)).filter("kind = 1").select("id", "chrom", "pos", "fragment")


def circular_coordinates(steps: DataFrame) -> DataFrame:
    """Ordered segments of cycles laid end to end: offset of each on its circle, and the circle's length."""
    size = F.col("end") - F.col("start")
    w = W.partitionBy("cycle").orderBy("ord")
    return steps.withColumns({"offset": F.coalesce(F.sum(size).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)), "circle": F.sum(size).over(W.partitionBy("cycle"))})


def classify_cycles(steps: DataFrame, near: int = 1000) -> DataFrame:
    """Structure of each cycle from its ordered segments.

    single; translocation for several chromosomes; foldback when neighbours of both strands overlap;
    inversion for both strands; tandem when a segment repeats; deletion for small gaps; else jump.
    """
    w = W.partitionBy("cycle").orderBy("ord")
    prev = {c: F.lag(c).over(w) for c in ("start", "end", "strand", "chrom")}
    gap = F.greatest("start", "_start") - F.least("end", "_end")
    each = steps.withColumns({f"_{c}": v for c, v in prev.items()})
    meets = (F.col("chrom") == F.col("_chrom")) & (gap < 0)
    agg = each.groupBy("cycle").agg(
        F.count("*").alias("segments"), F.countDistinct("chrom").alias("chroms"), F.countDistinct("strand").alias("strands"),
        F.countDistinct("chrom", "start", "end").alias("distinct_segments"), F.max(F.coalesce((meets & (F.col("strand") != F.col("_strand"))).cast("int"), F.lit(0))).alias("fold"), F.max(gap).alias("gap"),
    )
    kind = (
        F.when(F.col("segments") == 1, "single").when(F.col("chroms") > 1, "translocation").when(F.col("fold") == 1, "foldback").when(F.col("strands") > 1, "inversion")
        .when(F.col("distinct_segments") < F.col("segments"), "tandem").when(F.col("gap") <= near, "deletion").otherwise("jump")
    )
    return agg.withColumn("kind", kind).select("cycle", "segments", "chroms", "kind")


def cycle_stats(steps: DataFrame) -> DataFrame:
    """Per class of cycles: cycles, mean length, mean segments."""
    per = steps.groupBy("cycle").agg(F.sum(F.col("end") - F.col("start")).alias("length"), F.count("*").alias("segments"))
    return per.join(classify_cycles(steps).select("cycle", "kind"), "cycle").groupBy("kind").agg(F.count("*").alias("cycles"), F.avg("length").alias("mean_length"), F.avg("segments").alias("mean_segments"))


def element_coverage_percent(segments: DataFrame, elements: DataFrame) -> DataFrame:
    """Percent of the merged segments that merged elements cover."""
    seg, el = (I.merge_intervals(x).select("chrom", "start", "end") for x in (segments, elements))
    size = lambda d: d.agg(F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0)).alias("b"))
    return size(I.intersect(seg, el)).withColumnRenamed("b", "covered").join(size(seg).withColumnRenamed("b", "total"), F.lit(True)).withColumn("percent", F.try_divide(F.col("covered") * 100.0, "total"))


def extend_segments_unique(segments: DataFrame, sizes: DataFrame, reach: int, min_len: int) -> DataFrame:
    """Unique segments with their sorted ids, extended and clipped."""
    one = segments.filter(F.col("end") - F.col("start") >= min_len).groupBy("chrom", "start", "end").agg(F.array_join(F.array_sort(F.collect_set(F.col("id").cast("string"))), ",").alias("ids"))
    return I.slop(one, reach, reach, sizes=sizes)


def enrichment_log2fc(counts: DataFrame, constant: float = 1.0) -> DataFrame:
    """log2 of (IPt + c)(INc + c) / ((INt + c)(IPc + c)) from mean counts per id, role and condition; null if one is missing."""
    wide = counts.groupBy("id").pivot("cell", ["ip_treat", "in_treat", "ip_control", "in_control"]).agg(F.avg("value"))
    c = F.lit(constant)
    return wide.select("id", F.log2((F.col("ip_treat") + c) / (F.col("in_treat") + c) * (F.col("in_control") + c) / (F.col("ip_control") + c)).alias("log2fc"))


def psi(inc, skp, inc_len, skp_len, digits: int | None = None):
    """Inclusion level of each replicate: arrays of counts with effective lengths; null for no reads."""
    one = lambda a, b: F.try_divide(a / inc_len, a / inc_len + b / skp_len)
    return F.zip_with(inc, skp, one if digits is None else lambda a, b: F.round(one(a, b), digits))


def pool(sets: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, sets)


def _draw(seed: int, key: str):
    """60 bits of a seeded hash of the key."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), 1, 15), 16, 10).cast("long")


def shuffle_apart(df: DataFrame, sizes: DataFrame, seed: int) -> DataFrame:
    """Each interval at a seeded random place of its own chromosome, no two overlapping: ``df`` with new start and end.

    The free bases of a chromosome are dealt by order statistics: every interval draws how many of them lie before it, and stands
    there behind the intervals with smaller draws. So there is nothing to reject, and the result is the same for every
    partitioning. Where intervals are longer than their chromosome together, start and end are null.
    """
    rows = df.join(sizes.select("chrom", "length"), "chrom").withColumn("_w", F.col("end") - F.col("start"))
    room = rows.groupBy("chrom").agg((F.max("length") - F.sum("_w")).alias("_free"))
    rows = rows.join(room, "chrom").withColumn("_u", F.pmod(_draw(seed, "id"), F.greatest("_free", F.lit(0)) + 1))
    order = [F.col("_u").asc(), F.col("id").asc()]
    rows = scans.carried(scans.in_ranges(rows, ["chrom"], order), ["chrom"], {"_seen": (F.sum, "_w")})
    inside = W.partitionBy("chrom", "_cell").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    at = F.when(F.col("_free") >= 0, F.col("_u") + F.coalesce("_seen", F.lit(0)) + F.coalesce(F.sum("_w").over(inside), F.lit(0)))
    return rows.withColumns({"start": at, "end": at + F.col("_w")}).select(*df.columns)


def shuffle_intervals(df: DataFrame, sizes: DataFrame, seed: int) -> DataFrame:
    """Each interval at a seeded random start of its chromosome; results may overlap."""
    room = F.greatest(F.col("length") - (F.col("end") - F.col("start")), F.lit(1))
    at = F.pmod(_draw(seed, "id"), room)
    return df.join(sizes, "chrom").withColumn("_s", at).withColumns({"end": F.col("_s") + F.col("end") - F.col("start"), "start": F.col("_s")}).select(*df.columns)


def bedpe_to_bed(df: DataFrame, prefix: str, id: str = "id") -> DataFrame:
    """Two named BED rows per pair: ``prefix|id|1`` and ``prefix|id|2``."""
    side = lambda k: F.struct(F.col(f"chrom{k}").alias("chrom"), F.col(f"start{k}").alias("start"), F.col(f"end{k}").alias("end"), F.concat_ws("|", F.lit(prefix), F.col(id).cast("string"), F.lit(str(k))).alias("name"))
    return df.select(F.explode(F.array(side(1), side(2))).alias("r")).select("r.*")


def mutations_in_tags(mutations: DataFrame, tags: DataFrame, key: str = "tag") -> DataFrame:
    """Mutations whose tag occurs once."""
    return mutations.join(tags.groupBy(key).agg(F.count("*").alias("_n")).filter("_n = 1").select(key), key, "left_semi")


def mean_fragment_length(qc: DataFrame, column: str = "fragment", default: float = 147 / 2) -> DataFrame:
    """Mean of the estimated lengths, the default where there are none."""
    return qc.agg(F.coalesce(F.avg(column), F.lit(default)).alias("fragment"))


def split_reads(df: DataFrame, n: int, key: str = "qname", seed: int = 0) -> DataFrame:
    """``df`` with ``chunk`` 0 .. n - 1 by name, so mates share a chunk."""
    return df.withColumn("chunk", F.pmod(_draw(seed, key), F.lit(n)).cast("int"))


def circle_features(steps: DataFrame, genes: DataFrame) -> DataFrame:
    """Genes wholly inside a segment, in coordinates of the segment's circle; reversed segments flip them."""
    placed = circular_coordinates(steps)
    hits = I.overlap_join(genes, placed, contained=True)
    minus = F.col("b_strand") == "-"
    start = F.col("b_offset") + F.when(minus, F.col("b_end") - F.col("end")).otherwise(F.col("start") - F.col("b_start"))
    flip = F.when(minus, F.when(F.col("strand") == "-", "+").when(F.col("strand") == "+", "-").otherwise(F.col("strand"))).otherwise(F.col("strand"))
    return hits.select(F.col("b_cycle").alias("cycle"), F.col("b_ord").alias("ord"), "id", start.alias("start"), (start + F.col("end") - F.col("start")).alias("end"), flip.alias("strand"))


def cycle_segments(steps: DataFrame, min_length: float = 1.0, min_lost: float = 500.0) -> DataFrame:
    """Segment rows of the cycles that are kept: ids, lengths, number of segments and the cycle's class.

    ``steps``: sample, amplicon, cycle, ord, segment, chrom, start, end, strand, copy_count, cyclic, cycle_class,
    caller_length; segment '0' is an open end, no piece of the genome. An ``Invalid`` cycle becomes ``Circular``
    if it is cyclic and at least ``min_length`` long, ``No_fSCNA`` if it is not cyclic and at least ``min_lost``
    long, and goes otherwise. Cycles without segments have no rows.
    """
    invalid = F.col("cycle_class") == "Invalid"
    kept = F.when(~invalid, F.col("cycle_class")).when(F.col("cyclic") & (F.col("caller_length") >= min_length), "Circular").when(~F.col("cyclic") & (F.col("caller_length") >= min_lost), "No_fSCNA")
    real = steps.withColumn("class", kept).filter(F.col("class").isNotNull() & (F.col("segment") != "0"))
    cycle = W.partitionBy("sample", "amplicon", "cycle")
    size = F.col("end") - F.col("start")
    name = F.concat_ws("|", "sample", "amplicon", F.concat(F.lit("cycle-"), F.col("cycle").cast("string")))
    place = F.row_number().over(cycle.orderBy("ord"))
    return real.select(
        "chrom", "start", "end", F.concat_ws("|", name, F.concat(F.lit("seg-"), place.cast("string"))).alias("id"), "copy_count", "strand", "sample", name.alias("cycle_id"),
        F.sum(size).over(cycle).alias("cycle_length"), F.concat(F.lit("seg-"), F.col("segment")).alias("segment"), size.alias("length"), F.count("*").over(cycle).alias("segments"), "class",
    )


def cycle_factor_stats(steps: DataFrame, peaks: DataFrame, repeats: DataFrame) -> DataFrame:
    """Per cycle and factor: peaks inside its segments, peaks per kb, and the share of them that meet a repeat.

    ``steps``: cycle, chrom, start, end; ``peaks``: id, factor, chrom, start, end; ``repeats``: chrom, start, end.
    A peak counts once per cycle, and only where it lies inside a segment. Cycles without peaks have no rows.
    """
    inside = I.overlap_join(peaks.select("id", "factor", "chrom", "start", "end"), steps.select("cycle", "chrom", "start", "end"), contained=True)
    hits = inside.select(F.col("b_cycle").alias("cycle"), "id", "factor").distinct()
    met = I.overlap_semi(peaks.select("id", "chrom", "start", "end"), repeats).select("id", F.lit(1).alias("met"))
    per = hits.join(met, "id", "left").groupBy("cycle", "factor").agg(F.count("*").alias("peaks"), F.count("met").alias("in_repeats"))
    size = steps.groupBy("cycle").agg(F.sum(F.col("end") - F.col("start")).alias("size"))
    return per.join(size, "cycle").select("cycle", "factor", "peaks", F.try_divide(F.col("peaks") * 1000.0, "size").alias("per_kb"), (F.col("in_repeats") * 100.0 / F.col("peaks")).alias("repeat_percent"))


def resolve_elements(extra: DataFrame, main: DataFrame, priority: list[str], beside=("intergenic", "miRNA", "snoRNA", "rRNA")) -> DataFrame:
    """Elements of segments that stay beside the genes: the columns of ``extra``.

    ``extra``: segment, id, class, kind ('repeat' or other), type, start, end, overlap; ``main``: segment, start,
    end of the kept genes. Elements of other classes than ``beside`` that meet a gene of their segment go. The
    rest is taken by start and end: a repeat that meets an earlier kept repeat replaces it if its type comes
    earlier in ``priority`` or, for equal types, its overlap is larger, and goes otherwise; only the first such
    repeat is looked at. A segment's repeats are resolved together in one sweep (their number is bounded by its length); an element without
    start or end meets nothing.
    """
    keyed = lambda d: d.withColumn("chrom", F.col("segment"))
    # Whether an element meets any gene is asked of the merged genes, so piles of genes make no pairs.
    covered = I.merge_intervals(keyed(main).select("chrom", "start", "end").filter("start < end"))
    free = extra.filter(F.col("class").isin(list(beside))).unionByName(I.overlap_anti(keyed(extra.filter(~F.col("class").isin(list(beside)))), covered).select(*extra.columns))
    rank = {t: i for i, t in enumerate(priority)}

    def fold(pdf):
        pdf = pdf.sort_values(["start", "end", "id"], kind="stable")
        kind, overlap, starts, ends = (pdf[c].to_list() for c in ("type", "overlap", "start", "end"))
        kind = [rank.get(t, len(rank)) for t in kind]
        kept, at = [], 0  # kept repeats before ``at`` end before all that come
        for i, (start, end) in enumerate(zip(starts, ends)):
            while at < len(kept) and not ends[kept[at]] > start:
                at += 1
            if at == len(kept) or not end > start:
                kept.append(i)
            elif kind[i] < kind[kept[at]] or kind[i] == kind[kept[at]] and overlap[i] > overlap[kept[at]]:
                kept[at] = i
        return pdf.iloc[kept]

    # Only repeats replace each other.
    repeat = F.coalesce(F.col("kind") == "repeat", F.lit(False)) & F.col("start").isNotNull() & F.col("end").isNotNull()
    return free.filter(~repeat).unionByName(free.filter(repeat).groupBy("segment").applyInPandas(fold, extra.schema))

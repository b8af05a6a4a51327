"""Peak and segment annotation: many-to-many hits reduced to one best row per key by stated priorities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import intervals as I

#: Default order of transcript features, best first.
FEATURES = ("start_codon", "stop_codon", "5utr", "3utr", "cds", "exon", "intron", "tss", "tts")


def rank_of(col: Column, order: list[str]) -> Column:
    """Position of a value in a priority list; unknown values come last."""
    pos = F.array_position(F.array(*map(F.lit, order)), col)
    return F.when(pos > 0, pos).otherwise(len(order) + 1)


def best_row(hits: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    w = W.partitionBy(*keys).orderBy(*order)
    return hits.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def best_transcript(hits: DataFrame, features: list[str], mode: str = "rna", peak: str = "id", gene: str = "gene") -> DataFrame:
    """Per peak and gene: the feature of best rank, then the largest overlap (rna) or least distance (dna)."""
    second = F.col("overlap").desc() if mode == "rna" else F.abs("distance").asc()
    return best_row(hits, [peak, gene], [rank_of(F.col("feature"), features), second, F.col("b_id")])


def best_gene(hits: DataFrame, classes: list[str], mode: str = "rna", peak: str = "id", gene: str = "gene") -> DataFrame:
    """Per peak: class rank then overlap (rna), or least distance then class rank (dna); ties by gene."""
    rank = rank_of(F.col("class"), classes)
    order = [rank, F.col("overlap").desc()] if mode == "rna" else [F.abs("distance").asc(), rank]
    return best_row(hits, [peak], [*order, F.col(gene), F.col("b_id")])


def best_extra(hits: DataFrame, types: list[str], mode: str = "rna", peak: str = "id", name: str = "gene") -> DataFrame:
    """Element annotation: the last hit of each name first, then the best type (rna) or distance (dna)."""
    last = best_row(hits, [peak, name], [F.col("b_start").desc(), F.col("b_id").desc()])
    rank = rank_of(F.col("class"), types)
    order = [rank, F.col("overlap").desc()] if mode == "rna" else [F.abs("distance").asc(), rank]
    return best_row(last, [peak], [*order, F.col(name), F.col("b_id")])


def annotate_peaks(peaks: DataFrame, genes: DataFrame, classes: list[str], mode: str = "rna", up: int = 1000, down: int = 1000, limits_kb=(1, 2, 3)) -> DataFrame:
    """Every peak with its best gene: id, gene, class, overlap, distance, place; nulls where there is none.

    rna: genes on the peak's strand that it overlaps. dna: genes whose TSS window (``up`` bases before to
    ``down`` bases after) or body it overlaps; the place is the distance class of the TSS.
    """
    center = F.floor((F.col("start") + F.col("end")) / 2)
    keep = [F.col(c).alias(f"g_{c}") for c in ("start", "end")]
    if mode == "rna":
        hits = I.overlap_join(peaks, genes, strand="same")
    else:
        window = I.slop(I.tss(genes.select("*", *keep)), up, down, stranded=True)
        body = genes.select("*", *keep)
        hits = I.overlap_join(peaks, window.unionByName(body))
        hits = hits.withColumns({"b_start": F.col("b_g_start"), "b_end": F.col("b_g_end")})
    hits = hits.withColumns({"gene": F.col("b_gene"), "class": F.col("b_class")})
    hits = hits.withColumn("distance", I.distance_to(hits, center))
    hits = hits.withColumn("overlap", I.overlap_bp(F.col("start"), F.col("end"), F.col("b_start"), F.col("b_end")))
    best = best_gene(hits, classes, mode).select("id", F.col("b_id").alias("gene_id"), "gene", "class", "overlap", "distance")
    out = peaks.select("id").join(best, "id", "left")
    return out.withColumn("place", F.when(F.col("gene").isNotNull(), I.distance_class(F.col("distance"), list(limits_kb))).otherwise("intergenic"))


def to_report(df: DataFrame, sentinels: dict[str, object]) -> DataFrame:
    """Final projection: null becomes a column's stated text or number."""
    return df.select(*(F.coalesce(F.col(c).cast("string"), F.lit(str(sentinels[c]))).alias(c) if c in sentinels else F.col(c) for c in df.columns))


def feature_stats(anno: DataFrame, category: str = "class", none: str = "intergenic") -> DataFrame:
    """Rows and percent per category, unannotated rows as ``none``."""
    counts = anno.groupBy(F.coalesce(category, F.lit(none)).alias("category")).agg(F.count("*").alias("n"))
    return counts.withColumn("percent", 100 * F.col("n") / F.sum("n").over(W.partitionBy()))  # a row per category


def gene_span(tx: DataFrame, gene: str = "gene") -> DataFrame:
    """Extent of each gene on a chromosome and strand, and its number of transcripts."""
    return tx.groupBy(gene, "chrom", "strand").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_tx"))


def longest_isoform(tx: DataFrame, gene: str = "gene", rule: str = "full") -> DataFrame:
    """One transcript per gene, by span (full) or summed blocks (exon); ties by id."""
    size = F.col("end") - F.col("start")
    if rule == "exon":
        size = F.aggregate("blocks", F.lit(0).cast("long"), lambda a, b: a + b["end"] - b["start"])
    return best_row(tx.withColumn("size", size), [gene], [F.col("size").desc(), F.col("id")])


def decode_transcript(tx: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Features of transcripts with blocks and thick ends: id, feature, number, start, end.

    Exons and introns, and for coding ones 5utr, cds and 3utr by the thick bounds, numbered in transcript
    order (from the 5' end of the strand). ``keep``: more columns of the transcript that its features get.
    """
    n = F.size("blocks")
    introns = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.struct(F.element_at("blocks", i)["end"].alias("start"), F.get(F.col("blocks"), i)["start"].alias("end")))
    introns = F.when(n > 1, introns).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))
    clip = lambda lo, hi: F.filter(F.transform("blocks", lambda b: F.struct(F.greatest(b["start"], lo).alias("start"), F.least(b["end"], hi).alias("end"))), lambda b: b["start"] < b["end"])
    left, cds, right = clip(F.lit(0), F.col("thick_start")), clip(F.col("thick_start"), F.col("thick_end")), clip(F.col("thick_end"), F.lit(1 << 60))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    coding, minus = F.col("thick_end") > F.col("thick_start"), F.col("strand") == "-"
    parts = {"exon": F.col("blocks"), "intron": introns, "cds": F.when(coding, cds).otherwise(none), "5utr": F.when(coding, F.when(minus, right).otherwise(left)).otherwise(none), "3utr": F.when(coding, F.when(minus, left).otherwise(right)).otherwise(none)}
    kind = "array<struct<start:bigint,end:bigint>>"
    flat = [F.transform(F.when(minus, F.reverse(p)).otherwise(p).cast(kind), _numbered(name)) for name, p in parts.items()]
    return tx.select("id", "chrom", "strand", *keep, F.explode(F.concat(*flat)).alias("f")).select("id", "chrom", "strand", *keep, "f.*")


def _numbered(name: str):
    return lambda b, i: F.struct(F.lit(name).alias("feature"), (i + 1).alias("number"), b["start"].alias("start"), b["end"].alias("end"))


def append_gene_annotation(df: DataFrame, genes: DataFrame, id_col: str = "id", key: str = "gene_id", position: int = 1) -> DataFrame:
    """A matrix with the gene columns put in at a position; ids lose a version suffix for the lookup."""
    clean = F.regexp_replace(F.col(id_col).cast("string"), r"\.\d+$", "")
    cols = [c for c in genes.columns if c != key]
    out = df.withColumn("_k", clean).join(genes.withColumnRenamed(key, "_k"), "_k", "left")
    order = [*df.columns[:position], *cols, *df.columns[position:]]
    return out.select(*order)


def recenter(df: DataFrame, extend: int) -> DataFrame:
    """Intervals around their centre; with ``blocks`` the centre is that of the spliced length."""
    half = F.floor(F.aggregate("blocks", F.lit(0).cast("long"), lambda a, b: a + b["end"] - b["start"]) / 2)
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("at"))
    step = lambda a, b: F.struct((a["seen"] + b["end"] - b["start"]).alias("seen"), F.when(a["at"].isNull() & (a["seen"] + b["end"] - b["start"] > half), b["start"] + half - a["seen"]).otherwise(a["at"]).alias("at"))
    at = F.aggregate("blocks", start, step)["at"]
    return df.withColumns({"center": at, "start": F.greatest(at - extend, F.lit(0)), "end": at + extend + 1})


def metagene_bins(hits: DataFrame, bins: int) -> DataFrame:
    """Hits on features (b_start, b_end, b_strand) spread over ``bins`` of relative position, by strand.

    A hit covers a run of bins; it is expanded per bin, not per base.
    """
    size = F.col("b_end") - F.col("b_start")
    lo, hi = F.greatest("start", "b_start") - F.col("b_start"), F.least("end", "b_end") - F.col("b_start")
    minus = F.col("b_strand") == "-"
    a, b = F.when(minus, size - hi).otherwise(lo), F.when(minus, size - lo).otherwise(hi)
    first, last = F.floor(a * bins / size), F.least(F.floor((b - 1) * bins / size), F.lit(bins - 1))
    return hits.select("*", F.explode(F.sequence(first, last)).alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))


def segment_genes(segments: DataFrame, genes: DataFrame) -> DataFrame:
    """Genes on segments with overlap type, overhangs on both sides and the share of the gene covered."""
    hits = I.overlap_join(segments, genes)
    kind = I.overlap_type(F.col("start"), F.col("end"), F.col("b_start"), F.col("b_end"))
    return hits.withColumns({
        "kind": kind, "left_over": F.greatest(F.col("start") - F.col("b_start"), F.lit(0)),
        "right_over": F.greatest(F.col("b_end") - F.col("end"), F.lit(0)), "fraction": F.col("overlap") / (F.col("b_end") - F.col("b_start")),
    })


OVERHANGS = ("whole", "TTS", "TSS", "overlay")


def best_overhang(hits: DataFrame, keys: list[str]) -> DataFrame:
    """One transcript per key (columns transcript, kind, overhang): the survivor of a walk over them by name.

    The next transcript takes the place of the kept one if its kind comes earlier in ``OVERHANGS`` or else if its
    absolute overhang is smaller. The rule is not transitive, so it is a fold and no order.
    """
    item = F.struct("transcript", F.array_position(F.array(*map(F.lit, OVERHANGS)), F.col("kind")).alias("rank"), F.abs("overhang").alias("size"), "kind", "overhang")
    per = hits.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("x"))
    step = lambda a, b: F.when((b["rank"] < a["rank"]) | (b["size"] < a["size"]), b).otherwise(a)
    return per.select(*keys, F.aggregate(F.slice("x", 2, F.greatest(F.size("x") - 1, F.lit(0))), F.get("x", F.lit(0)), step).alias("b")).select(*keys, "b.transcript", "b.kind", "b.overhang")

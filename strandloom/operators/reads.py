"""Alignment tables: filters, pair rules, duplicates, library metrics, trimming, strand correlation."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import scans


def cigar_ref_length(cigar: Column) -> Column:
    """Reference bases of a CIGAR: the sum of its M, D, N, = and X lengths."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1)), F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def has_flag(flag: Column, bits: int) -> Column:
    return flag.bitwiseAND(F.lit(bits)) == bits


def filter_alignments(df: DataFrame, mapq: int = 0, required: int = 0, excluded: int = 0) -> DataFrame:
    """Rows with at least ``mapq``, all ``required`` and none of the ``excluded`` flag bits."""
    flag = F.col("flag")
    return df.filter((F.col("mapq") >= mapq) & has_flag(flag, required) & (flag.bitwiseAND(F.lit(excluded)) == 0))


def alignments_to_bed(df: DataFrame, five_prime: bool = False, first_only: bool = False) -> DataFrame:
    """Mapped reads as BED6 (0-based), or their 5' bases; ``first_only`` keeps unpaired reads and mate 1."""
    rows = df.filter(~has_flag(F.col("flag"), 4))
    if first_only:
        rows = rows.filter(~has_flag(F.col("flag"), 1) | has_flag(F.col("flag"), 64))
    start = F.col("pos") - 1
    end = start + cigar_ref_length(F.col("cigar"))
    minus = has_flag(F.col("flag"), 16)
    if five_prime:
        start, end = F.when(minus, end - 1).otherwise(start), F.when(minus, end).otherwise(start + 1)
    return rows.select(F.col("rname").alias("chrom"), start.alias("start"), end.alias("end"), F.col("qname").alias("name"), F.col("mapq").alias("score"), F.when(minus, "-").otherwise("+").alias("strand"))


def flag_read_pairs(df: DataFrame, min_mapq: int = 10, max_nm: int = 2, max_insert: int = 750) -> DataFrame:
    """``df`` with ``qc_flag``: bit 0x200 set on failing reads, bit 0x2 set on good pairs.

    A pair is good if both mates pass quality and mismatches, lie on one contig and opposite strands, and
    have insert sizes that are not 0, cancel each other and stay within the limit. Paired reads without exactly
    one mate row fail. Reads that are not paired fail by quality and mismatches alone, and are no good pair.
    """
    paired = has_flag(F.col("flag"), 1)
    w = W.partitionBy("qname", paired)
    ok = (F.col("mapq") >= min_mapq) & (F.coalesce("nm", F.lit(0)) <= max_nm) & ~has_flag(F.col("flag"), 4)
    minus = has_flag(F.col("flag"), 16).cast("int")
    good = (
        paired & (F.count("*").over(w) == 2) & (F.min(ok.cast("int")).over(w) == 1) & (F.min("rname").over(w) == F.max("rname").over(w))
        & (F.sum(minus).over(w) == 1) & (F.sum("tlen").over(w) == 0) & (F.col("tlen") != 0) & (F.abs("tlen") <= max_insert)
    )
    base = F.col("flag").bitwiseAND(F.lit(~0x202))
    return df.withColumn("qc_flag", F.when(good, base.bitwiseOR(F.lit(0x2))).when(~paired & ok, base).otherwise(base.bitwiseOR(F.lit(0x200))))


def duplicate_key(df: DataFrame, paired: bool = False) -> DataFrame:
    """``df`` with dup_strand, dup_start and dup_end, the place by which reads are duplicates of each other.

    ``dup_strand`` is the column ``conversion`` (OT, CTOT, CTOB, OB) if there is one, else the strand. A read on
    the forward strand (OT, CTOB) is known by its leftmost base, one on the reverse strand (CTOT, OB) by its last base, which the
    CIGAR gives: clips and insertions do not move it, deletions and skips do. ``paired``: all reads of a name on one
    contig share first and last base of the fragment, and the strand of mate 1.
    """
    contig = "rname" if "rname" in df.columns else "chrom"
    plain = F.when(has_flag(F.col("flag"), 16), "-").otherwise("+") if "flag" in df.columns else F.col("strand")
    name = F.col("conversion") if "conversion" in df.columns else plain
    last = F.col("pos") + cigar_ref_length(F.col("cigar")) - 1
    if not paired:
        return df.withColumns({"dup_strand": name, "dup_start": F.when(name.isin("-", "CTOT", "OB"), last).otherwise(F.col("pos"))}).withColumn("dup_end", F.col("dup_start"))
    w = W.partitionBy("qname", contig)
    mate1 = F.min(F.when(has_flag(F.col("flag"), 64), name)).over(w)
    return df.withColumns({"dup_strand": mate1, "dup_start": F.min("pos").over(w), "dup_end": F.max(last).over(w)})


def deduplicate_pairs(df: DataFrame, order: str, more: list[str] = ()) -> DataFrame:
    """All reads of the first fragment, by the least ``order`` of its reads, of every fragment place (and barcode, in ``more``).

    Reads without a name or a contig are left out. Reads go on themselves, in two windows: the reads of a fragment share their rank
    among those of its place, so none are joined again, and a task sends on only the best fragment it has of a place.
    """
    contig = "rname" if "rname" in df.columns else "chrom"
    rows = duplicate_key(df.dropna(subset=["qname", contig]), paired=True)
    rows = rows.withColumn("_first", F.min(order).over(W.partitionBy("qname", contig, *more)))
    place = W.partitionBy("dup_start", "dup_end", contig, "dup_strand", *more).orderBy("_first", "qname")  # sorts compare the many-valued numbers first
    rows = rows.withColumn("_rank", F.rank().over(place))
    if more:  # a fragment stays as a whole, with all its barcodes
        rows = rows.withColumn("_rank", F.min("_rank").over(W.partitionBy("qname", contig)))
    return rows.filter("_rank = 1").select(*df.columns)


def deduplicate(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first read in input order of every key; for duplicates the columns of ``duplicate_key``, and a barcode in tagged libraries."""
    w = W.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def duplication_report(df: DataFrame, key: list[str]) -> DataFrame:
    """total, unique, duplicates, percent, positions with duplicates."""
    per = df.groupBy(*key).agg(F.count("*").alias("n"))
    out = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("unique"), F.count(F.when(F.col("n") > 1, 1)).alias("positions"))
    dup = F.col("total") - F.col("unique")
    return out.select("total", "unique", dup.alias("duplicates"), F.try_divide(dup * 100.0, "total").alias("percent"), "positions")


def library_complexity(df: DataFrame, key: list[str]) -> DataFrame:
    """mt, m0, m1, m2 (reads, positions, positions met once, twice), NRF, PBC1, PBC2; null for a zero divisor."""
    per = df.groupBy(*key).agg(F.count("*").alias("n"))
    at = lambda k: F.count(F.when(F.col("n") == k, 1))
    out = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("mt"), F.count("*").alias("m0"), at(1).alias("m1"), at(2).alias("m2"))
    return out.withColumns({"nrf": F.try_divide("m0", "mt"), "pbc1": F.try_divide("m1", "m0"), "pbc2": F.try_divide("m1", "m2")})


def flagstat(df: DataFrame) -> DataFrame:
    """Counts of reads by flag, in one pass."""
    f = F.col("flag")
    n = lambda c: F.count(F.when(c, 1))
    paired = has_flag(f, 1)
    return df.agg(
        F.count("*").alias("total"), n(has_flag(f, 1024)).alias("duplicates"), n(~has_flag(f, 4)).alias("mapped"), n(paired).alias("paired"),
        n(paired & has_flag(f, 64)).alias("read1"), n(paired & has_flag(f, 128)).alias("read2"), n(paired & has_flag(f, 2) & ~has_flag(f, 4)).alias("proper"),
        n(paired & ~has_flag(f, 4) & has_flag(f, 8)).alias("singletons"), n(has_flag(f, 256)).alias("secondary"), n(has_flag(f, 2048)).alias("supplementary"),
    )


def length_distribution(df: DataFrame, length: Column) -> DataFrame:
    return df.groupBy(length.alias("length")).agg(F.count("*").alias("n"))


def umi_from_name(name: Column, size: int = 8) -> Column:
    """Barcode after ``#`` in a read name, padded with N; null without one."""
    umi = F.regexp_extract(name, r"#([ACGTN]+)", 1)
    return F.when(umi != "", F.rpad(umi, size, "N"))


def umi_into_name(header: Column) -> Column:
    """A read header with its barcode (behind the first ``+``, empty without one) put behind its name and ``#``."""
    name, rest = F.substring_index(header, " ", 1), F.regexp_extract(header, r"^[^ ]*( .*)$", 1)
    return F.concat(name, F.lit("#"), F.regexp_extract(header, r"\+(.*)$", 1), rest)


def _mott_kept(qual: str, cutoff: int, offset: int) -> int:
    """How many bases of one read stay."""
    sums = np.cumsum(np.frombuffer(qual.encode("utf-32-le"), "<u4")[::-1].astype(np.int64) - (offset + cutoff))
    if not len(sums):
        return 0
    least = int(sums.argmin())  # the first of equal ones
    return len(sums) if sums[least] > cutoff else len(sums) - least - 1


def mott_trim(df: DataFrame, cutoff: int = 20, offset: int = 33, min_len: int = 1) -> DataFrame:
    """3' quality trim: the running sum of quality - ``cutoff`` from the 3' end is least behind the bases that go.

    Of equal sums the one nearest to the end counts; a read whose least sum is above ``cutoff`` stays whole. Reads that end up
    shorter than ``min_len`` or all N are dropped, as are empty and null ones.
    """

    @F.pandas_udf("int")
    def kept(quals: pd.Series) -> pd.Series:
        return quals.map(lambda q: None if q is None else _mott_kept(q, cutoff, offset)).astype("Int32")

    out = df.withColumn("_end", kept("qual"))
    out = out.withColumns({"seq": F.substring("seq", F.lit(1), F.col("_end")), "qual": F.substring("qual", F.lit(1), F.col("_end"))}).drop("_end")
    return out.filter((F.length("seq") >= min_len) & ~F.col("seq").rlike("^[Nn]*$"))


def mott_trim_pairs(first: DataFrame, second: DataFrame, key: str = "id", singles: bool = False, **options) -> DataFrame:
    """Both mates trimmed as by ``mott_trim``: key, seq1, qual1, seq2, qual2 of the pairs of which both stay.

    With ``singles`` mates that stay alone have rows too, null on the other side. Keys are unique on each side; a key on one side only
    has no mate. Rows without a key are left out.
    """
    one = lambda d, k: mott_trim(d, **options).dropna(subset=[key]).select(key, F.col("seq").alias(f"seq{k}"), F.col("qual").alias(f"qual{k}"))
    return one(first, 1).join(one(second, 2), key, "full" if singles else "inner")


def trim_fixed(df: DataFrame, n: int, five_prime: int = 0) -> DataFrame:
    """Bases ``five_prime`` .. ``five_prime + n`` of every read; shorter reads are dropped."""
    out = df.filter(F.length("seq") >= five_prime + n)
    return out.withColumns({c: F.substring(c, five_prime + 1, n) for c in ("seq", "qual") if c in df.columns})


def collapse_reads(df: DataFrame, barcode: int = 0) -> DataFrame:
    """Exact duplicates as one row: seq without its barcode, umi, copies, the best id."""
    out = df.groupBy("seq").agg(F.count("*").alias("copies"), F.min("id").alias("id"))
    return out.select("id", F.substring("seq", 1, barcode).alias("umi"), F.expr(f"substring(seq, {barcode + 1})").alias("seq"), "copies")


def cross_correlation(reads: DataFrame, shifts: list[int]) -> DataFrame:
    """Pearson correlation of plus-strand and shifted minus-strand 5' counts for each shift.

    Counts per position and strand are joined on position + shift; with the sums over all occupied
    positions of a genome of ``n`` bases this is the correlation over every base.
    """
    at = F.when(F.col("strand") == "-", F.col("end") - 1).otherwise(F.col("start"))
    per = reads.groupBy("chrom", "strand", at.alias("pos")).agg(F.count("*").alias("c"))
    plus = per.filter("strand = '+'").select("chrom", "pos", F.col("c").alias("p"))
    minus = per.filter("strand = '-'").select("chrom", F.col("pos").alias("mpos"), F.col("c").alias("m"), F.explode(F.array(*map(F.lit, shifts))).alias("shift"))
    cross = minus.withColumn("pos", F.col("mpos") - F.col("shift")).join(plus, ["chrom", "pos"]).groupBy("shift").agg(F.sum(F.col("p") * F.col("m")).alias("sxy"))
    size = per.groupBy("chrom").agg((F.max("pos") + 1).alias("l")).agg(F.sum("l").alias("n"))  # one row
    side = lambda d, c, k: d.agg(F.sum(c).alias(f"s{k}"), F.sum(F.col(c) * F.col(c)).alias(f"s{k}{k}"))
    m1 = per.filter("strand = '-'").select(F.col("c").alias("m"))
    sums = side(plus, "p", "x").join(side(m1, "m", "y"), F.lit(True)).join(size, F.lit(True))
    every = reads.sparkSession.createDataFrame([(s,) for s in shifts], "shift int").join(cross, "shift", "left").fillna(0, ["sxy"])
    out = every.join(F.broadcast(sums), F.lit(True))
    n = F.col("n").cast("double")
    r = (n * F.col("sxy") - F.col("sx") * F.col("sy")) / F.sqrt((n * F.col("sxx") - F.col("sx") ** 2) * (n * F.col("syy") - F.col("sy") ** 2))
    return out.select("shift", r.alias("r"))


def cross_correlation_summary(cc: DataFrame, read_length: int) -> DataFrame:
    """Fragment length (best shift), NSC (best over least), RSC (best against the read-length shift) and its quality tag."""
    best = F.max(F.struct("r", (-F.col("shift")).alias("s")))
    phantom = F.max(F.when(F.abs(F.col("shift") - read_length) <= 2, F.col("r")))
    out = cc.agg((-best["s"]).alias("fragment"), best["r"].alias("top"), F.min("r").alias("low"), phantom.alias("phantom"))
    rsc = F.try_divide(F.col("top") - F.col("low"), F.col("phantom") - F.col("low"))
    return out.select("fragment", F.try_divide("top", "low").alias("nsc"), rsc.alias("rsc"), quality_tag(rsc).alias("quality"))


def quality_tag(rsc: Column) -> Column:
    """-2 to 2 by the relative strand correlation, in steps at 0.25, 0.5, 1 and 1.5; null below 0."""
    return F.when(rsc < 0, None).when(rsc < 0.25, -2).when(rsc < 0.5, -1).when(rsc < 1, 0).when(rsc < 1.5, 1).when(rsc >= 1.5, 2)


def _shuffle_order(seed: int, key: str) -> Column:
    """60 bits of a seeded hash of the key."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), 1, 15), 16, 10).cast("long")


def pseudo_replicates(df: DataFrame, seed: int, key: str = "qname") -> DataFrame:
    """``df`` with ``replicate`` 1 or 2: halves of the names in a seeded order, so mates stay together.

    The first half has one name more if their number is odd. Rows without a name are left out.
    """
    names = df.select(key).dropna().distinct().withColumn("_o", _shuffle_order(seed, key))
    placed = scans.numbered(names, [], "_o", [key], 1 << 50)
    n = names.agg(F.count("*").alias("_n"))  # one row
    half = placed.join(F.broadcast(n), F.lit(True)).select(key, F.when(F.col("_idx") < F.floor((F.col("_n") + 1) / 2), 1).otherwise(2).alias("replicate"))
    return df.join(half, key)


def sample_reads(df: DataFrame, n: int, seed: int, key: str = "qname") -> DataFrame:
    """The ``n`` rows that come first in a seeded order."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)


def pair_by_name(df: DataFrame) -> DataFrame:
    """Mates of a read side by side: qname, first_*, second_* positions."""
    one = df.filter(has_flag(F.col("flag"), 64)).select("qname", F.col("rname").alias("first_chrom"), F.col("pos").alias("first_pos"))
    two = df.filter(has_flag(F.col("flag"), 128)).select("qname", F.col("rname").alias("second_chrom"), F.col("pos").alias("second_pos"))
    return one.join(two, "qname")


def feature_counts(reads: DataFrame, features: DataFrame, fractional: bool = False) -> DataFrame:
    """Reads per feature; with ``fractional`` a read of k features counts 1/k for each."""
    from .intervals import overlap_join

    hits = overlap_join(reads.select("id", "chrom", "start", "end"), features.select(F.col("id"), "chrom", "start", "end"))
    if fractional:
        hits = hits.dropna(subset=["id"]).select("id", "b_id").withColumn("weight", F.lit(1.0) / F.count("*").over(W.partitionBy("id")))
    else:
        hits = hits.withColumn("weight", F.lit(1.0))
    n = hits.groupBy(F.col("b_id").alias("id")).agg(F.sum("weight").alias("n"))
    return features.select("id").join(n, "id", "left").fillna(0.0, ["n"])


def fragment_counts(reads: DataFrame, features: DataFrame, strand: str | None = None, fractional: bool = False, unique: bool = False, extend: int = 0) -> DataFrame:
    """Fragments per feature: id, n.

    ``reads``: qname, mate (1, 2, or null for single reads), chrom, start, end, strand; ``features``: id, chrom, start, end, strand, any number of rows (blocks) an id.
    A fragment counts once for a feature that any of its reads meets. ``strand`` ``same``: single reads and mate 1 lie on the feature's strand and
    mate 2 on the other; ``opposite``: the other way round. Fragments on several chromosomes are left out. One that meets k features counts
    for each, 1/k with ``fractional``, and not at all with ``unique`` unless k is 1. ``extend`` lengthens single reads at their 3' end.
    Features without fragments have 0; reads without a name or a place are left out.
    """
    from .intervals import overlap_join, strand_rule

    known = reads.dropna(subset=["qname", "chrom", "start", "end"])
    alone, minus = F.col("mate").isNull(), F.col("strand") == "-"
    if extend:
        start = F.when(alone & minus, F.greatest(F.col("start") - extend, F.lit(0))).otherwise(F.col("start"))
        known = known.withColumns({"end": F.when(alone & ~minus, F.col("end") + extend).otherwise(F.col("end")), "start": start})
    hits = overlap_join(known.select("qname", "mate", "chrom", "start", "end", "strand"), features.select("id", "chrom", "start", "end", "strand"))
    if strand:
        turned = F.when((F.col("mate") == 2) & F.col("strand").isin("+", "-"), F.translate("strand", "+-", "-+")).otherwise(F.col("strand"))
        hits = hits.filter(strand_rule(strand, turned, F.col("b_strand")))
    apart = known.groupBy("qname").agg(F.min("chrom").alias("_a"), F.max("chrom").alias("_b")).filter("_a <> _b").select("qname")
    once = hits.select("qname", F.col("b_id").alias("id")).distinct().join(apart, "qname", "left_anti")
    if fractional or unique:
        k = once.groupBy("qname").agg(F.count("*").alias("k"))
        once = once.join(k.filter("k = 1") if unique else k, "qname")
    n = once.groupBy("id").agg((F.sum(F.lit(1.0) / F.col("k")) if fractional else F.count("*").cast("double")).alias("n"))
    return features.select("id").distinct().join(n, "id", "left").fillna(0.0, ["n"])

"""Methylation tables: calls per read and base, counts per site, contexts, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequence import SHORT, base_rows, chunks, cytosines
from .stored import written


def percent(m: Column, u: Column) -> Column:
    return F.try_divide(m * F.lit(100.0), m + u)


def _chunk(pos: Column) -> Column:
    """The chunk of ``SHORT`` letters that a position (1-based) lies in."""
    return F.floor((pos - 1) / SHORT)


def _letters(sequences: DataFrame, name: Column) -> DataFrame:
    """chrom (``name``), _c and _part: the letters of each chunk with two more on both sides, N beyond the ends."""
    parts = chunks(sequences.select(name.alias("id"), "seq"), SHORT, 2, 2)
    return parts.select(F.col("id").alias("chrom"), F.floor(F.col("offset") / SHORT).alias("_c"), F.concat(F.repeat(F.lit("N"), 2 - F.col("lead")), "seq", F.lit("NN")).alias("_part"))


def _around(rows: DataFrame, at: Column) -> DataFrame:
    """``rows`` (with _part) with ``_a``, the five letters from place ``at`` on, and ``own``, these on the strand on which the one in the middle is a C; null for other bases.

    ``_a`` is exploded from an array of one, so that it is made once and not for each of its uses.
    """
    kept = [c for c in rows.columns if c != "_part"]
    rows = rows.select(*kept, F.explode(F.array(F.substring("_part", at, F.lit(5)))).alias("_a"))
    base = F.substring("_a", 3, 1)
    return rows.withColumn("own", F.when(base == "C", F.col("_a")).when(base == "G", _other_strand(F.col("_a"))))


def _context_in(around: Column) -> Column:
    """``_context`` of the C or G in the middle of five letters, on its own strand, letter by letter."""
    at = lambda k: F.substring(around, k, 1)
    return F.when(at(3) == "C", _context(at(4), at(5))).when(at(3) == "G", _context(at(2), at(1), "C", "TGA"))


def site_methylation(calls: DataFrame, min_cov: int = 1, read: list[str] | None = None) -> DataFrame:
    """chrom, pos, meth, unmeth, pct of every position with enough calls.

    Where calls have their letter (``call``), those that contradict ``meth`` are rejected: methylated calls are upper case
    (Z, X, H, U), others lower case, and other letters are no calls. ``read``: columns that name a read and by which its
    calls lie together; these then move as one list per chunk of the sequence (``_c``, one more column), by which ``cytosine_report``
    joins letters to the sites where they are. Calls without a position or a state are then left out.
    """
    if "call" in calls.columns:
        calls = calls.filter(F.when(F.col("meth"), F.col("call").isin(*"ZXHU")).otherwise(F.col("call").isin(*"zxhu")))
    by = ["chrom", "pos"]
    if read:
        by = ["chrom", "_c", "pos"]
        place = F.pmod(F.col("pos") - 1, F.lit(SHORT)) * 2 + F.col("meth").cast("int")
        near = [c for c in read if c != "chrom"]
        lists = calls.filter("pos IS NOT NULL AND meth IS NOT NULL").groupBy("chrom", *near, _chunk(F.col("pos")).alias("_c")).agg(F.collect_list(place.cast("short")).alias("_p"))
        calls = written(lists.select("chrom", "_c", "_p"), "read-calls").repartition("chrom", "_c").select("chrom", "_c", F.explode("_p").alias("_p"))
        calls = calls.select("chrom", "_c", (F.col("_c") * SHORT + F.floor(F.col("_p") / 2) + 1).alias("pos"), (F.col("_p") % 2 == 1).alias("meth"))
    out = calls.groupBy(*by).agg(F.count(F.when(F.col("meth"), 1)).alias("meth"), F.count(F.when(~F.col("meth"), 1)).alias("unmeth"))
    out = out.filter(F.col("meth") + F.col("unmeth") >= min_cov)
    return out.withColumn("pct", percent(F.col("meth"), F.col("unmeth")))


def splitting_report(calls: DataFrame, contexts=("CG", "CHG", "CHH")) -> DataFrame:
    """One row: methylated and unmethylated calls and percent of each context."""
    cols = []
    for c in contexts:
        m, u = (F.count(F.when((F.col("context") == c) & cond, 1)) for cond in (F.col("meth"), ~F.col("meth")))
        cols += [m.alias(f"meth_{c}"), u.alias(f"unmeth_{c}"), percent(m, u).alias(f"pct_{c}")]
    return calls.agg(F.count("*").alias("total"), *cols)


def mbias(calls: DataFrame, by: list[str] = ("context",)) -> DataFrame:
    """Per context (and, with ``by``, mate) and read position: meth, unmeth, pct, coverage; positions without calls have zeros."""
    keys = list(by)
    per = calls.groupBy(*keys, "read_pos").agg(F.count(F.when(F.col("meth"), 1)).alias("meth"), F.count(F.when(~F.col("meth"), 1)).alias("unmeth"))
    span = per.groupBy(*keys).agg(F.max("read_pos").alias("top"))
    every = span.select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), "top")).alias("read_pos"))
    out = every.join(per, [*keys, "read_pos"], "left").fillna(0, ["meth", "unmeth"])
    return out.withColumns({"pct": percent(F.col("meth"), F.col("unmeth")), "coverage": F.col("meth") + F.col("unmeth")})


def context_summary(cx: DataFrame) -> DataFrame:
    """Counts and percent per context and trinucleotide of a cytosine report, and per base before the C where it has ``before``."""
    keys = ["context", "tri", *(["before"] if "before" in cx.columns else [])]
    out = cx.groupBy(*keys).agg(F.sum("meth").alias("meth"), F.sum("unmeth").alias("unmeth"))
    return out.withColumn("pct", percent(F.col("meth"), F.col("unmeth")))


def classify_reads(calls: DataFrame, min_count: int = 5, lower: float = 10.0, upper: float = 90.0) -> DataFrame:
    """read, calls, pct, class of each read, mates together: all_unmeth, all_meth, mixed, or discarded with too few calls.

    Only CpG calls count (``context`` CG); pct has one digit, halves away from zero, and the lower bound is asked first.
    """
    cpg = F.col("context") == "CG"
    per = calls.groupBy("read").agg(F.count(F.when(cpg & F.col("meth"), 1)).alias("m"), F.count(F.when(cpg, 1)).alias("calls"))
    twice = F.col("m") * 2000 + F.col("calls")
    pct = F.try_divide(twice - F.try_mod(twice, F.col("calls") * 2), F.col("calls") * 2) / 10
    kind = F.when((F.col("calls") < min_count) | (F.col("calls") == 0), "discarded").when(pct <= lower, "all_unmeth").when(pct >= upper, "all_meth").otherwise("mixed")
    return per.select("read", "calls", pct.alias("pct"), kind.alias("class"))


def nonconversion_calls(xm: Column) -> Column:
    """Number of methylated non-CpG calls (H, X, U) in a call string."""
    return F.length(xm) - F.length(F.translate(xm, "HXU", ""))


def consecutive_calls(xm: Column) -> Column:
    """Longest run of methylated non-CpG calls that no unmethylated non-CpG call interrupts."""
    runs = F.split(F.regexp_replace(xm, "[^HXUhxu]", ""), "[hxu]")
    return F.array_max(F.transform(runs, lambda r: F.length(r)))


def filter_nonconversion(reads: DataFrame, threshold: int = 3, consecutive: bool = False, pct: float | None = None, min_count: int = 5) -> DataFrame:
    """Reads (qname, xm) whose fragment shows no incomplete conversion; one failing mate removes both."""
    xm = F.col("xm")
    if pct is not None:
        total = F.length(F.regexp_replace(xm, "[^HXUhxu]", ""))
        bad = (total >= min_count) & (nonconversion_calls(xm) * 100.0 >= pct * total)
    else:
        bad = (consecutive_calls(xm) if consecutive else nonconversion_calls(xm)) >= threshold
    failing = reads.filter(bad).select("qname").distinct()
    return reads.join(failing, "qname", "left_anti")


def _cpg_pairs(cx: DataFrame, discordance: float | None) -> DataFrame:
    """chrom, pos, counts of both strands (m1, u1, m2, u2) and whether their percents differ by more than ``discordance``."""
    top = cx.filter("strand = '+'").select("chrom", "pos", F.col("meth").alias("m1"), F.col("unmeth").alias("u1"))
    low = cx.filter("strand = '-'").select("chrom", (F.col("pos") - 1).alias("pos"), F.col("meth").alias("m2"), F.col("unmeth").alias("u2"))
    gap = F.abs(percent(F.col("m1"), F.col("u1")) - percent(F.col("m2"), F.col("u2")))
    apart = F.lit(False) if discordance is None else F.coalesce(gap > discordance, F.lit(False))
    return top.join(low, ["chrom", "pos"]).withColumn("apart", apart)


def merge_cpg_strands(cx: DataFrame, discordance: float | None = None) -> DataFrame:
    """CpG counts of both strands pooled at the top strand's position; discordant pairs left out if asked.

    A pair is + at pos and - at pos + 1; ``discordant_cpgs`` returns those left out.
    """
    both = _cpg_pairs(cx, discordance).filter(~F.col("apart"))
    out = both.select("chrom", "pos", (F.col("m1") + F.col("m2")).alias("meth"), (F.col("u1") + F.col("u2")).alias("unmeth"))
    return out.withColumn("pct", percent(F.col("meth"), F.col("unmeth")))


def discordant_cpgs(cx: DataFrame, discordance: float) -> DataFrame:
    """The strands of CpGs that differ by more than ``discordance`` percent, a row per strand: chrom, pos, strand, meth, unmeth, pct."""
    side = lambda strand, by, m, u: F.struct((F.col("pos") + by).alias("pos"), F.lit(strand).alias("strand"), F.col(m).alias("meth"), F.col(u).alias("unmeth"))
    rows = _cpg_pairs(cx, discordance).filter("apart").select("chrom", F.explode(F.array(side("+", 0, "m1", "u1"), side("-", 1, "m2", "u2"))).alias("s")).select("chrom", "s.*")
    return rows.withColumn("pct", percent(F.col("meth"), F.col("unmeth")))


def sequence_context(tri: Column) -> Column:
    """CG, CHG or CHH of a cytosine's trinucleotide; null with unknown bases."""
    return F.when(tri.rlike("^CG"), "CG").when(tri.rlike("^C[ACT]G"), "CHG").when(tri.rlike("^C[ACT][ACT]"), "CHH")


def _context(second: Column, third: Column, g: str = "G", h: str = "ACT") -> Column:
    """``sequence_context`` of a C by the two bases behind it; ``g`` and ``h``: how G and the others are written."""
    other = second.isin(*h)
    return F.when(second == g, "CG").when(other & (third == g), "CHG").when(other & third.isin(*h), "CHH")


def _other_strand(around: Column) -> Column:
    return F.reverse(F.translate(around, "ACGT", "TGCA"))


def cytosine_report(sequences: DataFrame, cov: DataFrame, contexts=("CG", "CHG", "CHH"), threshold: int = 0, upstream: bool = False, zero_based: bool = False) -> DataFrame:
    """Every C of both strands with its counts (0 when uncovered): chrom, pos, strand, meth, unmeth, context, tri.

    ``sequences``: id, seq; ``cov``: chrom (the id), pos (1-based), meth, unmeth. ``upstream`` adds ``before``,
    the base before the C on its strand; ``zero_based`` counts ``pos`` from 0. Where only covered C are asked for (``threshold``), their
    letters are joined to them by chunk; else every C of the sequences is a row.
    """
    if threshold >= 1:
        return _covered_cytosines(sequences, cov, contexts, threshold, upstream, zero_based)
    cs = cytosines(sequences).select(
        F.col("id").alias("chrom"), (F.col("at") + 1).alias("pos"), F.when(F.col("base") == "C", "+").otherwise("-").alias("strand"), F.substring("own", 3, 3).alias("tri"),
        _context(F.substring("own", 4, 1), F.substring("own", 5, 1)).alias("context"), *([F.substring("own", 2, 1).alias("before")] if upstream else []),
    ).filter(F.col("context").isin(list(contexts)))
    out = cs.join(cov.select("chrom", "pos", "meth", "unmeth"), ["chrom", "pos"], "left").fillna(0, ["meth", "unmeth"])
    out = out.filter(F.col("meth") + F.col("unmeth") >= threshold).select("chrom", "pos", "strand", "meth", "unmeth", "context", "tri", *(["before"] if upstream else []))
    return out.withColumn("pos", F.col("pos") - 1) if zero_based else out


def _covered_cytosines(sequences: DataFrame, cov: DataFrame, contexts, threshold: int, upstream: bool, zero_based: bool) -> DataFrame:
    sites = cov if "_c" in cov.columns else cov.withColumn("_c", _chunk(F.col("pos")))
    sites = sites.select("chrom", "_c", F.col("pos").cast("int").alias("pos"), F.coalesce("meth", F.lit(0)).alias("meth"), F.coalesce("unmeth", F.lit(0)).alias("unmeth"))
    rows = _letters(sequences, F.col("id")).join(sites.filter(F.col("meth") + F.col("unmeth") >= threshold), ["chrom", "_c"])
    rows = _around(rows, (F.col("pos") - F.col("_c") * SHORT).cast("int"))
    rows = rows.select(
        "chrom", "pos", F.when(F.substring("_a", 3, 1) == "C", "+").otherwise("-").alias("strand"), "meth", "unmeth", _context_in(F.col("_a")).alias("context"),
        F.substring("own", 3, 3).alias("tri"), *([F.substring("own", 2, 1).alias("before")] if upstream else []),
    ).filter(F.col("context").isin(list(contexts)))
    return rows.withColumn("pos", F.col("pos") - 1) if zero_based else rows


def drach_report(sequences: DataFrame, cov: DataFrame, threshold: int = 1) -> DataFrame:
    """Covered C of DRACH motifs of both strands: chrom, pos (1-based), strand, meth, unmeth, drach, tri, percent.

    D is any base but C, R is A or G, then A and C, and H is any base but G. The motif and the two bases behind the C
    lie inside the sequence. ``threshold``: least number of calls.
    """
    rows = base_rows(sequences, "CG", reach=3, pad=".")
    strand = F.when(F.col("base") == "C", F.lit("+")).otherwise(F.lit("-"))
    own = F.when(F.col("base") == "C", F.col("around")).otherwise(_other_strand(F.col("around")))
    rows = rows.select(F.col("id").alias("chrom"), (F.col("at") + 1).alias("pos"), strand.alias("strand"), own.alias("own"))
    rows = rows.filter(F.col("own").rlike(r"^[^C.][AG]AC[^G.][^.]"))
    out = rows.join(cov.select("chrom", "pos", "meth", "unmeth"), ["chrom", "pos"]).filter(F.col("meth") + F.col("unmeth") >= max(threshold, 1))
    return out.select("chrom", "pos", "strand", "meth", "unmeth", F.substring("own", 1, 5).alias("drach"), F.substring("own", 4, 3).alias("tri"), percent(F.col("meth"), F.col("unmeth")).alias("percent"))


def nome_read_summary(calls: DataFrame, sequences: DataFrame) -> DataFrame:
    """Per read the calls of CpGs behind A or T and of GpCs that are no CpG: read, chrom, start, end, meth_cg, unmeth_cg, meth_gc, unmeth_gc.

    ``calls``: read, chrom, pos (1-based), start, end (of the read, start > end on the reverse strand), call (a
    letter of the call string) and meth; ``sequences``: id, seq. A call counts if its letter agrees with the
    context that the sequence has there. Reads without two bases of sequence on each side are left out.

    A read's calls move as one list per chunk of the sequence, to the letters of the chunk; no base of a sequence becomes a row.
    """
    lo, hi = F.least("start", "end"), F.greatest("start", "end")
    key = ["read", "chrom", "start", "end"]
    # Place in the chunk, letter (Z, X or H) and state of a call that can count, in one number of two bytes.
    kind = F.array_position(F.array(*map(F.lit, "ZXH")), F.upper("call")) - 1
    can = F.col("pos").between(lo, hi) & (kind >= 0) & F.col("meth").isNotNull() & F.col("read").isNotNull() & F.col("end").isNotNull()
    rows = calls.select(*key, F.when(can, (F.pmod(F.col("pos") - 1, F.lit(SHORT)) * 8 + kind * 2 + F.col("meth").cast("int")).cast("short")).alias("_code"), _chunk(F.col("start")).alias("_at"), F.when(can, _chunk(F.col("pos"))).alias("_own"))
    # A read has a row in the chunk of its start, with or without calls there.
    place = lambda c, code: F.struct(c.alias("c"), code.alias("code"))
    here, none = place(F.col("_at"), F.col("_code")), place(F.col("_at"), F.lit(None).cast("short"))
    apart = F.when(F.coalesce(F.col("_own") != F.col("_at"), F.lit(False)), F.array(none, place(F.col("_own"), F.col("_code")))).otherwise(F.array(here))
    rows = rows.select(*key, F.explode(apart).alias("p")).groupBy(*key, F.col("p.c").alias("_c")).agg(F.collect_list("p.code").alias("_codes"))
    rows = written(rows, "read-calls")
    parts = _letters(sequences, F.struct("id", F.length("seq").alias("size"))).select(F.col("chrom.id").alias("chrom"), "_c", F.col("chrom.size").alias("size"), "_part")
    # The rule is stated for the read's start, which is its end for reverse reads.
    room = (F.col("start") - 2 > 1) & (F.col("size") >= F.col("start") + (hi - lo + 1) + 2)
    found = rows.join(parts, ["chrom", "_c"]).withColumn("_room", (room & (_chunk(F.col("start")) == F.col("_c"))).cast("int"))
    found = found.select(*key, "_c", "_room", "_part", F.posexplode_outer("_codes").alias("_k", "_code"))
    found = _around(found, (F.floor(F.col("_code") / 8) + 1).cast("int"))
    context, before = _context_in(F.col("_a")), F.substring("own", 2, 1)
    fits = context == F.get(F.array(*map(F.lit, ("CG", "CHG", "CHH"))), F.pmod(F.floor(F.col("_code") / 2), F.lit(4)).cast("int"))
    found = found.select(*key, F.when(F.coalesce("_k", F.lit(0)) == 0, F.col("_room")).alias("_room"), (F.col("_code") % 2 == 1).alias("meth"), F.when(fits, context).alias("context"), before.alias("before"))
    cg, gc = (F.col("context") == "CG") & F.col("before").isin("A", "T"), (F.col("context") != "CG") & (F.col("before") == "G")
    count = lambda what, meth, name: F.count(F.when(what & meth, 1)).alias(name)
    yes, no = F.col("meth"), ~F.col("meth")
    out = found.groupBy(*key).agg(count(cg, yes, "meth_cg"), count(cg, no, "unmeth_cg"), count(gc, yes, "meth_gc"), count(gc, no, "unmeth_gc"), F.sum("_room").cast("int").alias("_room"))
    out = out.filter("_room > 0").withColumn("_room", F.explode(F.sequence(F.lit(1), F.col("_room"))))  # once for each sequence of its name
    return out.select("read", "chrom", lo.alias("start"), hi.alias("end"), "meth_cg", "unmeth_cg", "meth_gc", "unmeth_gc")


def nome_filter(cx: DataFrame) -> DataFrame:
    """CpG positions preceded by A or T only (``before``: the base upstream on the strand)."""
    return cx.filter((F.col("context") == "CG") & F.col("before").isin("A", "T"))


def bedmethyl(cx: DataFrame) -> DataFrame:
    """bedMethyl rows: score capped at 1000, percent and its colour band."""
    depth = F.col("meth") + F.col("unmeth")
    pct = F.round(percent(F.col("meth"), F.col("unmeth"))).cast("int")
    return cx.filter(depth > 0).select("chrom", (F.col("pos") - 1).alias("start"), F.col("pos").alias("end"), F.least(depth, F.lit(1000)).alias("score"), "strand", rgb_by_percent(pct).alias("rgb"), depth.alias("read_count"), pct.alias("percent_meth"))


def rgb_by_percent(pct: Column) -> Column:
    """Green at 0 over yellow at 50 to red at 100, in eleven bands around the tens: 0-5, 6-15, ... 86-95, 96-100."""
    band = F.greatest(F.ceil((pct - 5) / 10), F.lit(0)).cast("int")
    # The shares of red from 0 up, and of green from 100 down.
    shares = F.array(*map(F.lit, (0, 55, 105, 155, 205, 255)))
    share = lambda k: F.get(shares, F.least(k, F.lit(5)))
    return F.concat_ws(",", share(band), share(10 - band), F.lit(0))


def replicate_correlation(a: DataFrame, b: DataFrame, min_reads: int = 10) -> DataFrame:
    """Pearson correlation of percent at sites with enough reads in both, and their number; 0 if undefined."""
    one = a.filter(F.col("meth") + F.col("unmeth") >= min_reads).select("chrom", "pos", F.col("pct").alias("x"))
    two = b.filter(F.col("meth") + F.col("unmeth") >= min_reads).select("chrom", "pos", F.col("pct").alias("y"))
    return one.join(two, ["chrom", "pos"]).agg(F.coalesce(F.corr("x", "y"), F.lit(0.0)).alias("r"), F.count("*").alias("n"))


def call_methylation(read: Column, ref: Column) -> Column:
    """Call string of an aligned read against its reference, which has two more bases on the right.

    Z/z CpG, X/x CHG, H/h CHH, U/u unknown context; upper case methylated (C stays C), lower case not
    (C read as T), '.' elsewhere.
    """

    context = F.regexp_replace(ref, "[^ACGT]", "N")
    for pattern, letter in (("C(?=G)", "Z"), ("C(?=[ATZ]G)", "X"), ("C(?=[ACTZX][ACTZX])", "H"), ("C", "U"), ("[ACGTN]", ".")):
        context = F.regexp_replace(context, pattern, letter)

    def one(letter, got):
        return F.when(letter.isNull() | (letter == ""), ".").when(got == "C", letter).when(got == "T", F.lower(letter)).otherwise(".")

    calls = F.zip_with(F.split(F.substring(context, F.lit(1), F.length(read)), ""), F.split(read, ""), one)
    return F.when(F.length(read) == 0, "").otherwise(F.array_join(calls, ""))


def call_methylation_ga(read: Column, ref: Column) -> Column:
    """Call string of a read in which G was converted to A; its reference has two more bases on the left.

    The calls of the other strand: a G is a cytosine there, its context lies before it.
    """
    return F.reverse(call_methylation(_other_strand(read), _other_strand(ref)))


def extract_calls(reads: DataFrame, ignore5: int = 0, ignore3: int = 0, no_overlap: bool = False, keep: list[str] = ()) -> DataFrame:
    """Calls of aligned reads (qname, chrom, pos 1-based, xm, cigar): one row per call letter.

    CIGAR operations place the letters: matches advance both, deletions and skips the reference only,
    insertions and soft clips the read only. ``ignore5`` and ``ignore3`` leave out so many letters at the read's own
    ends (by ``strand``, where reads have it). ``no_overlap`` leaves out calls of a second mate (``mate`` 2) inside the stretch
    of its first. A column ``mate`` is kept, and those of ``keep``.
    """
    if ignore5 or ignore3:
        back = (F.col("strand") == "-") if "strand" in reads.columns else F.lit(False)
        left, right = F.when(back, ignore3).otherwise(ignore5), F.when(back, ignore5).otherwise(ignore3)
        n = F.length("xm")
        kept = F.substring("xm", left + 1, F.greatest(n - left - right, F.lit(0)))
        reads = reads.withColumn("xm", F.concat(F.repeat(F.lit("."), F.least(left, n)), kept, F.repeat(F.lit("."), F.least(right, F.greatest(n - left, F.lit(0))))))
    mate = [*(["mate"] if "mate" in reads.columns else []), *keep]
    ops = F.transform(F.regexp_extract_all("cigar", F.lit(r"(\d+[MIDNSX=])"), F.lit(1)), lambda o: F.struct(F.regexp_extract(o, r"(\d+)", 1).cast("int").alias("n"), F.substring(o, -1, 1).alias("op")))
    zero = F.struct(F.lit(0).alias("q"), F.lit(0).alias("r"), F.array().cast("array<struct<q:int,r:int,n:int>>").alias("runs"))

    def step(a, o):
        match = o["op"].isin("M", "=", "X")
        reads_on, ref_on = match | o["op"].isin("I", "S"), match | o["op"].isin("D", "N")
        runs = F.when(match, F.concat(a["runs"], F.array(F.struct(a["q"].alias("q"), a["r"].alias("r"), o["n"].alias("n"))))).otherwise(a["runs"])
        return F.struct((a["q"] + F.when(reads_on, o["n"]).otherwise(0)).alias("q"), (a["r"] + F.when(ref_on, o["n"]).otherwise(0)).alias("r"), runs.alias("runs"))

    runs = reads.withColumn("run", F.explode(F.aggregate(ops, zero, step)["runs"]))
    each = runs.select("qname", *mate, "chrom", "pos", "run", F.posexplode(F.split(F.substring("xm", F.col("run.q") + 1, F.col("run.n")), "")).alias("i", "call"))
    each = each.filter(F.col("call").rlike("^[ZzXxHhUu]$"))
    out = each.select("qname", *mate, "chrom", (F.col("pos") + F.col("run.r") + F.col("i")).alias("pos"), "call", (F.col("call") == F.upper("call")).alias("meth"))
    if no_overlap:
        size = F.aggregate(F.filter(ops, lambda o: o["op"].isin("M", "=", "X", "D", "N")), F.lit(0), lambda a, o: a + o["n"])
        first = reads.filter("mate = 1").select("qname", "chrom", F.col("pos").alias("_a"), (F.col("pos") + size).alias("_b"))
        covered = (F.col("mate") == 2) & F.coalesce((F.col("pos") >= F.col("_a")) & (F.col("pos") < F.col("_b")), F.lit(False))
        out = out.join(first, ["qname", "chrom"], "left").filter(~covered).drop("_a", "_b")
    return out


def gpc_report(sequences: DataFrame, cov: DataFrame) -> DataFrame:
    """Every GpC cytosine of both strands with its counts: chrom, pos, strand, meth, unmeth."""
    rows = base_rows(sequences, "CG")
    plus = (F.col("base") == "C") & (F.substring("around", 2, 1) == "G")
    minus = (F.col("base") == "G") & (F.substring("around", 4, 1) == "C")
    cs = rows.filter(plus | minus).select(F.col("id").alias("chrom"), (F.col("at") + 1).alias("pos"), F.when(F.col("base") == "C", "+").otherwise("-").alias("strand"))
    return cs.join(cov.select("chrom", "pos", "meth", "unmeth"), ["chrom", "pos"], "left").fillna(0, ["meth", "unmeth"])

"""Sequence work on (id, seq) tables. Long sequences are cut into chunks with a halo before bases explode."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 4096
#: Bases explode from pieces of so many letters: a substring inside a piece costs little, and so does carrying it.
PIECE = 16
#: A row of a join finds its letters by walking from the start of its chunk, so chunks for short rows are short.
SHORT = 256
#: IUPAC codes.
IUPAC = {"R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}


def iupac_regex(motif: str) -> str:
    """Regular expression of a motif with degenerate letters; U counts as T."""
    return "".join(f"[{IUPAC[c]}]" if c in IUPAC else re.escape(c) for c in motif.upper().replace("U", "T"))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTNacgtn", "TGCANtgcan"))


def chunks(seqs: DataFrame, size: int = CHUNK, left: int = 0, right: int = 0) -> DataFrame:
    """id, offset (0-based start of the chunk's core), core (its length), seq with halos, lead (left halo).

    One regular expression cuts the whole sequence in one pass (a substring per chunk would walk from the
    start each time); halos, at most ``size`` long, come from the neighbouring pieces. No sequence: no row.
    """
    if max(left, right) > size:
        raise ValueError("a halo is at most a chunk long")
    cut = seqs.select("id", F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{size}}}"), F.lit(0)).alias("_p"))

    def chunk(x, i):
        before = F.substring(F.coalesce(F.get("_p", i - 1), F.lit("")), size - left + 1, left) if left else F.lit("")
        after = F.substring(F.coalesce(F.get("_p", i + 1), F.lit("")), 1, right) if right else F.lit("")
        return F.struct((i * size).alias("offset"), F.length(x).alias("core"), F.concat(before, x, after).alias("seq"), F.length(before).alias("lead"))

    return cut.select("id", F.inline(F.transform("_p", chunk)))


def _places(seqs: DataFrame, left: int, right: int, size: int, pad: str = "", back: bool = False) -> DataFrame:
    """id, at (0-based), _i, padded: every place of each sequence inside a short piece, ``left`` + ``right`` + 1 letters from _i + 1 on.

    What is the same for all places of a piece is made before they explode. ``back`` adds the other strand of the piece, on which
    the letters of a place start at _n - _i.

    Sequences are cut twice. Chunks of ``CHUNK`` letters are dealt over the tasks, so that a chromosome in one
    row, or a file of one row group, is not one task; that moves each letter once, far less than the rows that
    its places make. Pieces of ``size`` letters then keep the substrings short.
    """
    size = max(size, left, right)
    big = chunks(seqs, max(CHUNK, size), left, right)
    big = big.repartition(int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id", "offset")
    c = chunks(big.select(F.struct("id", "offset", "core", "lead").alias("id"), "seq"), size, left, right)
    padded = F.concat(F.repeat(F.lit(pad), F.lit(left) - F.col("lead")), "seq", F.lit(pad * right)) if pad else F.col("seq")
    own = [F.reverse(F.translate("padded", "ACGT", "TGCA")).alias("_back"), (F.length("padded") - left - right).alias("_n")] if back else []
    # Of the letters of a piece those of the chunk's halos go.
    low, high = F.greatest(F.col("id.lead") - F.col("offset"), F.lit(0)), F.least(F.col("id.lead") + F.col("id.core") - F.col("offset"), F.col("core")) - 1
    c = c.select(F.col("id.id").alias("id"), (F.col("id.offset") - F.col("id.lead") + F.col("offset")).alias("_at"), padded.alias("padded"), low.cast("int").alias("_low"), high.cast("int").alias("_high"))
    c = c.filter("_low <= _high").select("id", "_at", "padded", "_low", "_high", *own)
    rows = c.select(*(x for x in c.columns if x not in ("_low", "_high")), F.explode(F.sequence("_low", "_high")).alias("_i"))
    return rows.select("id", (F.col("_at") + F.col("_i")).alias("at"), "_i", "padded", *(["_back", "_n"] if back else []))


def base_rows(seqs: DataFrame, letters: str, size: int = PIECE, reach: int = 2, pad: str = "N") -> DataFrame:
    """id, at (0-based), base, around (``reach`` bases on each side, ``pad`` beyond the ends) of the stated letters.

    Positions explode from short pieces and are filtered in the same generated stage; only bases asked for leave it.
    """
    base = F.substring("padded", F.col("_i") + reach + 1, F.lit(1))
    rows = _places(seqs, reach, reach, size, pad).filter(base.isin(*letters))
    return rows.select("id", "at", base.alias("base"), F.substring("padded", F.col("_i") + 1, F.lit(2 * reach + 1)).alias("around"))


def cytosines(seqs: DataFrame, size: int = PIECE, reach: int = 2, pad: str = "N") -> DataFrame:
    """id, at (0-based), base (C or G), own: the bases around the C on the strand that has it."""
    places = _places(seqs, reach, reach, size, pad, back=True)
    base = F.substring("padded", F.col("_i") + reach + 1, F.lit(1))
    rows = places.withColumn("base", base).filter(F.col("base").isin("C", "G"))
    own = F.when(F.col("base") == "C", F.substring("padded", F.col("_i") + 1, F.lit(2 * reach + 1))).otherwise(F.substring("_back", F.col("_n") - F.col("_i"), F.lit(2 * reach + 1)))
    return rows.select("id", "at", "base", own.alias("own"))


def kmers(seqs: DataFrame, k: int, drop_n: bool = True, size: int = PIECE) -> DataFrame:
    """Every k-mer with its position; k-mers with N are dropped if asked."""
    out = _places(seqs, 0, k - 1, max(size, k)).select("id", "at", F.substring("padded", F.col("_i") + 1, F.lit(k)).alias("kmer")).filter(F.length("kmer") == k)
    return out.filter(~F.col("kmer").contains("N")) if drop_n else out


def kmer_counts(seqs: DataFrame, k: int) -> DataFrame:
    return kmers(seqs, k).groupBy("kmer").agg(F.count("*").alias("n"))


def nucleotide_frequencies(seqs: DataFrame) -> DataFrame:
    """Mono- and dinucleotide counts and shares (within their length), without N."""
    from pyspark.sql import Window as W

    both = kmer_counts(seqs, 1).unionByName(kmer_counts(seqs, 2))
    return both.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(F.length("kmer"))))  # 20 rows


def nucleotide_coverage(reads: DataFrame, genome: DataFrame) -> DataFrame:
    """Counts in reads against the genome, with the ratio of their shares."""
    a = nucleotide_frequencies(reads).select("kmer", F.col("n").alias("n_reads"), F.col("share").alias("share_reads"))
    b = nucleotide_frequencies(genome).select("kmer", F.col("n").alias("n_genome"), F.col("share").alias("share_genome"))
    return b.join(a, "kmer", "left").withColumn("ratio", F.try_divide("share_reads", "share_genome"))


def find_motif(seqs: DataFrame, motif: str, both_strands: bool = False) -> DataFrame:
    """All starts of an IUPAC motif, overlapping ones too: id, at (0-based), strand, word."""
    k = len(motif)
    words = kmers(seqs, k)
    plus = words.filter(F.col("kmer").rlike(f"^{iupac_regex(motif)}$")).select("id", "at", F.lit("+").alias("strand"), F.col("kmer").alias("word"))
    if not both_strands:
        return plus
    rc = reverse_complement(F.col("kmer"))
    minus = words.filter(rc.rlike(f"^{iupac_regex(motif)}$")).select("id", "at", F.lit("-").alias("strand"), rc.alias("word"))
    return plus.unionByName(minus)


def chunk_pieces(bed: DataFrame, seqs: DataFrame, size: int = CHUNK) -> DataFrame:
    """``bed`` (chrom, start, end) with a row per chunk that it meets: its ``offset`` and ``piece``, the letters of the row in it."""
    parts = chunks(seqs, size).select(F.col("id").alias("chrom"), F.col("offset"), F.col("seq").alias("_part"))
    first, last = F.floor(F.col("start") / size), F.floor((F.greatest(F.col("end"), F.col("start") + 1) - 1) / size)
    need = bed.withColumn("_c", F.explode(F.sequence(first, last))).withColumn("offset", F.col("_c") * size)
    lo = F.greatest(F.col("start") - F.col("offset"), F.lit(0))
    piece = F.substring("_part", (lo + 1).cast("int"), (F.least(F.col("end") - F.col("offset"), F.lit(size)) - lo).cast("int"))
    return need.join(parts, ["chrom", "offset"]).select(*bed.columns, "offset", piece.alias("piece"))


def extract_sequence(bed: DataFrame, seqs: DataFrame, stranded: bool = True, size: int = CHUNK) -> DataFrame:
    """``bed`` (id, chrom, start, end, strand) with ``seq``: joined to sequence chunks by chunk number."""
    hit = chunk_pieces(bed.select("id", "chrom", "start", "end"), seqs, size)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", F.col("piece").alias("p")))), lambda x: x["p"]), "")
    out = bed.join(hit.groupBy("id").agg(joined.alias("seq")), "id", "left")
    return out.withColumn("seq", F.when(F.col("strand") == "-", reverse_complement(F.col("seq"))).otherwise(F.col("seq"))) if stranded else out


def short_sequence(bed: DataFrame, seqs: DataFrame, most: int, size: int = SHORT) -> DataFrame:
    """``bed`` with ``seq``, at most its first ``most`` letters, on its strand; rows without a sequence are left out.

    Chunks carry at least ``most`` letters more, so a row meets one chunk and is neither grouped nor joined back. Their numbers
    are round, so that joins of different lengths share one table of chunks.
    """
    halo = -(-most // PIECE) * PIECE
    size = max(size, halo)
    parts = chunks(seqs, size, 0, halo).select(F.col("id").alias("chrom"), F.floor(F.col("offset") / size).alias("_c"), F.col("seq").alias("_part"))
    first = F.greatest(F.col("start"), F.lit(0))
    hit = bed.withColumn("_c", F.floor(first / size)).join(parts, ["chrom", "_c"])
    seq = F.substring("_part", (first - F.col("_c") * size + 1).cast("int"), F.greatest(F.least(F.col("end") - first, F.lit(most)), F.lit(0)).cast("int"))
    return hit.select(*bed.columns, F.when(F.col("strand") == "-", reverse_complement(seq)).otherwise(seq).alias("seq"))


def filter_bed_by_sequence(bed: DataFrame, seqs: DataFrame, wanted: str) -> DataFrame:
    """Rows whose sequence is ``wanted``; one letter more than it has tells longer sequences apart."""
    return short_sequence(bed, seqs, len(wanted) + 1).filter(F.col("seq") == wanted)


def trim_to_center(seqs: DataFrame, reference: DataFrame) -> DataFrame:
    """Sequences cut to the mean reference length around their centre; shorter ones stay."""
    mean = reference.agg(F.floor(F.avg(F.length("seq")) / 2).cast("int").alias("half"))  # one row
    out = seqs.join(F.broadcast(mean), F.lit(True))
    mid = F.floor(F.length("seq") / 2).cast("int")
    start = F.greatest(mid - F.col("half"), F.lit(0))
    return out.withColumn("seq", F.substring("seq", start + 1, F.col("half") * 2)).drop("half")


def bisulfite_convert(seqs: DataFrame) -> DataFrame:
    """The C-to-T and G-to-A copies of each sequence."""
    return seqs.select("id", F.translate("seq", "Cc", "Tt").alias("ct"), F.translate("seq", "Gg", "Aa").alias("ga"))


def gc_windows(seqs: DataFrame, width: int) -> DataFrame:
    """GC share of each window without counting N; null for windows of N only."""
    c = chunks(seqs, width)
    gc = F.length("seq") - F.length(F.translate("seq", "GC", ""))
    acgt = F.length("seq") - F.length(F.translate("seq", "ACGT", ""))
    return c.select("id", F.col("offset").alias("start"), F.try_divide(gc, acgt).alias("gc"))


def mappability_windows(seqs: DataFrame, reads: int, width: int) -> DataFrame:
    """Per window of each sequence: the share of starts whose word of ``reads`` letters is found once, and the GC share of these words.

    Words count on both strands, over all sequences; words with N are not counted. They are compared by 128-bit hashes of the
    smaller of a word and its reverse complement. gc is null for windows without such a word, mappability 0.
    """
    words = kmers(seqs, reads)
    both = F.least("kmer", reverse_complement(F.col("kmer")))
    gc = F.length("kmer") - F.length(F.translate("kmer", "GC", ""))
    once = words.select(F.unhex(F.md5(both)).alias("h"), "id", "at", gc.alias("gc")).groupBy("h").agg(F.count("*").alias("c"), F.min(F.struct("id", "at", "gc")).alias("x")).filter("c = 1")
    per = once.groupBy(F.col("x.id").alias("id"), (F.floor(F.col("x.at") / width) * width).alias("start")).agg(F.count("*").alias("n"), F.sum("x.gc").alias("gc"))
    n = F.length("seq")
    grid = seqs.filter(n > 0).select("id", F.explode(F.sequence(F.lit(0).cast("long"), (n - 1).cast("long"), F.lit(width).cast("long"))).alias("start"))
    out = grid.join(per, ["id", "start"], "left")
    return out.select("id", "start", (F.coalesce("n", F.lit(0)) / width).alias("mappability"), (F.col("gc") / (F.col("n") * reads)).alias("gc"))


def select_mutations(df: DataFrame, source: str, target: str) -> DataFrame:
    """Substitutions of one kind; on the minus strand both letters are complemented."""
    comp = lambda c: F.when(F.col("strand") == "-", F.translate(c, "ACGT", "TGCA")).otherwise(F.col(c))
    return df.withColumns({"from": comp("from"), "to": comp("to")}).filter((F.col("from") == source) & (F.col("to") == target))


def mutation_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("from", "to").agg(F.count("*").alias("n"))


def select_mutation_type(df: DataFrame, kind: str, source: str | None = None, target: str | None = None) -> DataFrame:
    """Rows of one kind of mutation: ``del``, ``ins``, ``sub``, ``t2c`` or ``c2t``; ``sub`` can ask for both letters.

    ``df``: strand, from, type ('-', '+' or '>') and to. Substituted bases are read on the mutation's own strand. Rows of no known type are left out.
    """
    marks = {"del": "-", "ins": "+", "sub": ">", "t2c": ">", "c2t": ">"}
    if kind not in marks:
        raise ValueError(f"mutation type {kind!r}")
    if len(kind) == 3 and "2" in kind:
        source, target = kind[0].upper(), kind[2].upper()
    rows = df.filter(F.col("type") == marks[kind])
    if kind not in ("del", "ins") and source and target:
        rows = rows.filter((_own_strand("from") == source.upper()) & (_own_strand("to") == target.upper()))
    return rows


def _own_strand(column: str):
    return F.when(F.col("strand") == "-", F.upper(reverse_complement(F.upper(column)))).otherwise(F.col(column))


def mutation_type_summary(df: DataFrame) -> DataFrame:
    """Counts of deletions, insertions and substitutions (also 0), and of each substitution on its own strand: kind, n.

    Kinds are ``Deletion``, ``Insertion``, ``Substitution`` and pairs of letters such as ``T-C``.
    """
    at = lambda mark: F.count(F.when(F.col("type") == mark, 1))
    all_ = df.agg(at("-").alias("Deletion"), at("+").alias("Insertion"), at(">").alias("Substitution"))  # one row
    pairs = df.filter("type = '>'").groupBy(F.concat_ws("-", _own_strand("from"), _own_strand("to")).alias("kind")).agg(F.count("*").alias("n"))
    return all_.unpivot([], ["Deletion", "Insertion", "Substitution"], "kind", "n").unionByName(pairs)

"""Registered queries of the read, methylation and sequence operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import methylation as ME
from ..operators import reads as R
from ..operators import sequence as Q
from .fixtures import CALLS, GENES, PEAKS, SEQUENCES, calls, genes, peaks, sequences

_P = f"WITH {PEAKS}"


def _reads(s, d):
    p = peaks(s, d)
    i = F.col("id")
    bit = lambda c, v: F.when(c, v).otherwise(0)
    flag = F.lit(1) + bit(i % 7 == 0, 4) + bit(F.col("strand") == "-", 16) + F.when(i % 2 == 1, 64).otherwise(128) + bit(i % 5 == 0, 1024) + bit(i % 3 == 0, 2) + bit(i % 11 == 0, 8) + bit(i % 13 == 0, 256)
    size = F.col("end") - F.col("start")
    cigar = F.when(i % 4 == 0, F.concat(F.lit("3S"), size.cast("string"), F.lit("M2D4M1I"))).otherwise(F.concat(size.cast("string"), F.lit("M")))
    return p.select("id", "qname", flag.cast("int").alias("flag"), F.col("chrom").alias("rname"), (F.col("start") + 1).alias("pos"), (i % 60).cast("int").alias("mapq"), cigar.alias("cigar"), F.when(i % 2 == 1, F.col("qname") % 900).otherwise(-(F.col("qname") % 900)).alias("tlen"), (i % 4).cast("int").alias("nm"), "chrom", "start", "end", "strand")


_READS = f"""{PEAKS}, reads AS (SELECT id, qname, 1 + CASE WHEN id % 7 = 0 THEN 4 ELSE 0 END + CASE WHEN strand = '-' THEN 16 ELSE 0 END + CASE WHEN id % 2 = 1 THEN 64 ELSE 128 END
    + CASE WHEN id % 5 = 0 THEN 1024 ELSE 0 END + CASE WHEN id % 3 = 0 THEN 2 ELSE 0 END + CASE WHEN id % 11 = 0 THEN 8 ELSE 0 END + CASE WHEN id % 13 = 0 THEN 256 ELSE 0 END AS flag, chrom AS rname, start + 1 AS pos, id % 60 AS mapq,
    CASE WHEN id % 4 = 0 THEN '3S' || CAST("end" - start AS VARCHAR) || 'M2D4M1I' ELSE CAST("end" - start AS VARCHAR) || 'M' END AS cigar, "end" - start + CASE WHEN id % 4 = 0 THEN 6 ELSE 0 END AS ref_len,
    CASE WHEN id % 2 = 1 THEN qname % 900 ELSE -(qname % 900) END AS tlen, id % 4 AS nm, chrom, start, "end", strand FROM peaks)"""
_R = f"WITH {_READS}"
#: The base by which a read is known among duplicates.
_FIVE = "CASE WHEN flag & 16 > 0 THEN pos + ref_len - 1 ELSE pos END"


def _sites(s, d):
    return ME.site_methylation(calls(s, d))


_SITES = f"{CALLS}, sites AS (SELECT chrom, pos, count(*) FILTER (meth) AS meth, count(*) FILTER (NOT meth) AS unmeth, 100.0::DOUBLE * count(*) FILTER (meth) / count(*) AS pct FROM calls GROUP BY ALL)"
_CX = f"{CALLS}, cx AS (SELECT chrom, pos, strand, count(*) FILTER (meth) AS meth, count(*) FILTER (NOT meth) AS unmeth FROM calls GROUP BY ALL)"
_KMER = lambda k: f'(SELECT id, i - 1 AS "at", substr(seq, i, {k}) AS kmer FROM (SELECT id, seq, unnest(range(1, length(seq) - {k - 1} + 1)) AS i FROM sequences WHERE length(seq) >= {k}))'


def _cx(s, d):
    return calls(s, d).groupBy("chrom", "pos", "strand").agg(F.count(F.when(F.col("meth"), 1)).alias("meth"), F.count(F.when(~F.col("meth"), 1)).alias("unmeth"))


def _fastq(s, d):
    return sequences(s, d).withColumn("qual", F.translate("seq", "ACGTN", "I;5/#"))


#: Length of the reads that sequences are cut into.
READ = 60


def _whole_reads(s, d):
    """Consecutive reads that cover each whole sequence: qname, id, chrom, pos (1-based), xm, cigar.

    Sequences whose ids agree modulo 700 are mates, offset by offset.
    """
    c = Q.chunks(sequences(s, d), READ)
    cigar = F.when(F.col("core") > 38, F.concat(F.lit("10M2D5M3I20M5N"), (F.col("core") - 38).cast("string"), F.lit("M"))).otherwise(F.concat(F.col("core").cast("string"), F.lit("M")))
    return c.select(F.concat_ws(":", F.col("id") % 700, "offset").alias("qname"), "id", F.col("id").alias("chrom"), (F.col("offset") + 1).alias("pos"), F.translate("seq", "ACGTN", "hZ.Hx").alias("xm"), cigar.alias("cigar"))


#: The reads of ``_whole_reads``.
_READS = f"""{SEQUENCES}, cut AS (SELECT id, seq, unnest(range(0, length(seq), {READ})) AS off FROM sequences),
    xm AS (SELECT CAST(id % 700 AS VARCHAR) || ':' || CAST(off AS VARCHAR) AS qname, id, off + 1 AS pos, translate(substr(seq, off + 1, {READ}), 'ACGTN', 'hZ.Hx') AS xm FROM cut)"""


def _genome_cov(s, d):
    return sequences(s, d).select(F.col("id").alias("chrom"), F.lit(5).cast("long").alias("pos"), F.lit(3).cast("long").alias("meth"), F.lit(1).cast("long").alias("unmeth"))


QUERIES = {
    "filter_alignments": (
        lambda s, d: R.filter_alignments(_reads(s, d), 20, 2, 1804).select("id"),
        f"{_R} SELECT id FROM reads WHERE mapq >= 20 AND flag & 2 = 2 AND flag & 1804 = 0",
    ),
    "alignments_to_bed": (
        lambda s, d: R.alignments_to_bed(_reads(s, d)),
        f"""{_R} SELECT rname AS chrom, pos - 1 AS start, pos - 1 + ref_len AS "end", qname AS name, mapq AS score, CASE WHEN flag & 16 = 16 THEN '-' ELSE '+' END AS strand FROM reads WHERE flag & 4 = 0""",
    ),
    "five_prime_cuts": (
        lambda s, d: R.alignments_to_bed(_reads(s, d), five_prime=True, first_only=True).groupBy("chrom", "start", "strand").agg(F.count("*").alias("n")),
        f"""{_R} SELECT rname AS chrom, CASE WHEN flag & 16 = 16 THEN pos - 2 + ref_len ELSE pos - 1 END AS start, CASE WHEN flag & 16 = 16 THEN '-' ELSE '+' END AS strand, count(*) AS n FROM reads WHERE flag & 4 = 0 AND flag & 64 = 64 GROUP BY ALL""",
    ),
    "flag_read_pairs": (
        lambda s, d: R.flag_read_pairs(_reads(s, d)).select("id", "qc_flag"),
        f"""{_R}, w AS (SELECT *, count(*) OVER q AS k, min(CAST(mapq >= 10 AND nm <= 2 AND flag & 4 = 0 AS INT)) OVER q AS ok, min(rname) OVER q AS r0, max(rname) OVER q AS r1, sum(CAST(flag & 16 = 16 AS INT)) OVER q AS minus, sum(tlen) OVER q AS t FROM reads WINDOW q AS (PARTITION BY qname))
        SELECT id, (flag & (4095 - 514)) | CASE WHEN k = 2 AND ok = 1 AND r0 = r1 AND minus = 1 AND t = 0 AND tlen <> 0 AND abs(tlen) <= 750 THEN 2 ELSE 512 END AS qc_flag FROM w""",
    ),
    "deduplicate_reads": (
        lambda s, d: R.deduplicate(R.duplicate_key(_reads(s, d)), ["rname", "dup_strand", "dup_start"], ["id"]).select("id"),
        f"{_R} SELECT id FROM reads QUALIFY row_number() OVER (PARTITION BY rname, strand, {_FIVE} ORDER BY id) = 1",
    ),
    "deduplicate_pairs": (
        lambda s, d: R.deduplicate_pairs(_reads(s, d), "id").select("id"),
        f"""{_R}, f AS (SELECT qname, rname, min(pos) AS a, max(pos + ref_len - 1) AS b, min(CASE WHEN flag & 64 > 0 THEN strand END) AS st, min(id) AS first FROM reads GROUP BY qname, rname),
        k AS (SELECT qname, rname FROM f QUALIFY row_number() OVER (PARTITION BY rname, st, a, b ORDER BY first, qname) = 1) SELECT id FROM reads JOIN k USING (qname, rname)""",
    ),
    "deduplicate_barcoded": (
        lambda s, d: R.deduplicate(R.duplicate_key(_reads(s, d)).withColumn("barcode", F.col("id") % 3), ["rname", "dup_strand", "dup_start", "barcode"], ["id"]).select("id"),
        f"{_R} SELECT id FROM reads QUALIFY row_number() OVER (PARTITION BY rname, strand, {_FIVE}, id % 3 ORDER BY id) = 1",
    ),
    "duplication_report": (
        lambda s, d: R.duplication_report(R.duplicate_key(_reads(s, d)), ["rname", "dup_strand", "dup_start"]),
        f"{_R}, k AS (SELECT count(*) AS n FROM reads GROUP BY rname, strand, {_FIVE}), t AS (SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS u, count(*) FILTER (n > 1) AS positions FROM k) SELECT total, u AS unique, total - u AS duplicates, (total - u) * 100.0::DOUBLE / total AS percent, positions FROM t",
    ),
    "library_complexity": (
        lambda s, d: R.library_complexity(_reads(s, d), ["rname", "pos", "strand"]),
        f"{_R}, k AS (SELECT count(*) AS n FROM reads GROUP BY rname, pos, strand), t AS (SELECT CAST(sum(n) AS BIGINT) AS mt, count(*) AS m0, count(*) FILTER (n = 1) AS m1, count(*) FILTER (n = 2) AS m2 FROM k) SELECT *, m0 / CAST(mt AS DOUBLE) AS nrf, m1 / CAST(m0 AS DOUBLE) AS pbc1, m1 / CAST(nullif(m2, 0) AS DOUBLE) AS pbc2 FROM t",
    ),
    "flagstat": (
        lambda s, d: R.flagstat(_reads(s, d)),
        f"""{_R} SELECT count(*) AS total, count(*) FILTER (flag & 1024 > 0) AS duplicates, count(*) FILTER (flag & 4 = 0) AS mapped, count(*) AS paired, count(*) FILTER (flag & 64 > 0) AS read1, count(*) FILTER (flag & 128 > 0) AS read2,
        count(*) FILTER (flag & 2 > 0 AND flag & 4 = 0) AS proper, count(*) FILTER (flag & 4 = 0 AND flag & 8 > 0) AS singletons, count(*) FILTER (flag & 256 > 0) AS secondary, count(*) FILTER (flag & 2048 > 0) AS supplementary FROM reads""",
    ),
    "read_length_distribution": (lambda s, d: R.length_distribution(_reads(s, d), R.cigar_ref_length(F.col("cigar"))), f"{_R} SELECT ref_len AS length, count(*) AS n FROM reads GROUP BY 1"),
    "pair_by_name": (
        lambda s, d: R.pair_by_name(_reads(s, d)),
        f"{_R} SELECT a.qname, a.rname AS first_chrom, a.pos AS first_pos, b.rname AS second_chrom, b.pos AS second_pos FROM reads a JOIN reads b ON a.qname = b.qname AND a.flag & 64 > 0 AND b.flag & 128 > 0",
    ),
    "feature_counts": (
        lambda s, d: R.feature_counts(peaks(s, d), genes(s, d)),
        f"""{_P}, {GENES} SELECT g.id, CAST(count(p.id) AS DOUBLE) AS n FROM genes g LEFT JOIN peaks p ON p.chrom = g.chrom AND p.start < g."end" AND g.start < p."end" GROUP BY g.id""",
    ),
    "feature_counts_fractional": (
        lambda s, d: R.feature_counts(peaks(s, d), genes(s, d), True).select("id", F.round("n", 6).alias("n")),
        f"""{_P}, {GENES}, h AS (SELECT p.id, g.id AS gid FROM genes g JOIN peaks p ON p.chrom = g.chrom AND p.start < g."end" AND g.start < p."end"), w AS (SELECT gid, 1.0::DOUBLE / count(*) OVER (PARTITION BY id) AS w FROM h)
        SELECT g.id, round(coalesce(sum(w), 0), 6) AS n FROM genes g LEFT JOIN w ON g.id = w.gid GROUP BY g.id""",
    ),
    "cross_correlation": (
        lambda s, d: R.cross_correlation(peaks(s, d), [0, 10, 37, 50, 100]).select("shift", F.round("r", 8).alias("r")),
        f"""{_P}, c AS (SELECT chrom, strand, CASE WHEN strand = '-' THEN "end" - 1 ELSE start END AS pos, count(*) AS c FROM peaks GROUP BY ALL), t AS (SELECT unnest([0, 10, 37, 50, 100]) AS shift),
        n AS (SELECT CAST(sum(l) AS DOUBLE) AS n FROM (SELECT max(pos) + 1 AS l FROM c GROUP BY chrom)), x AS (SELECT CAST(sum(c) FILTER (strand = '+') AS DOUBLE) AS sx, CAST(sum(c * c) FILTER (strand = '+') AS DOUBLE) AS sxx, CAST(sum(c) FILTER (strand = '-') AS DOUBLE) AS sy, CAST(sum(c * c) FILTER (strand = '-') AS DOUBLE) AS syy FROM c),
        k AS (SELECT shift, CAST(coalesce(sum(p.c * m.c), 0) AS DOUBLE) AS sxy FROM t LEFT JOIN c m ON m.strand = '-' LEFT JOIN c p ON p.strand = '+' AND p.chrom = m.chrom AND p.pos = m.pos - shift GROUP BY shift)
        SELECT shift, round((n * sxy - sx * sy) / sqrt((n * sxx - sx ^ 2) * (n * syy - sy ^ 2)), 8) AS r FROM k, x, n""",
    ),
    "sample_reads": (
        lambda s, d: R.sample_reads(peaks(s, d).filter("chrom <> 'chr4'"), 500, 11, "id").select("id"),
        f"{_P} SELECT id FROM peaks WHERE chrom <> 'chr4' ORDER BY md5('11:' || CAST(id AS VARCHAR)), id LIMIT 500",
    ),
    "mott_trim": (lambda s, d: R.mott_trim(_fastq(s, d)).select("id", F.length("seq").alias("kept")), None),
    "trim_fixed": (
        lambda s, d: R.trim_fixed(_fastq(s, d), 36, 4).select("id", "seq"),
        f"WITH {SEQUENCES} SELECT id, substr(seq, 5, 36) AS seq FROM sequences WHERE length(seq) >= 40",
    ),
    "collapse_reads": (
        lambda s, d: R.collapse_reads(_fastq(s, d), 6),
        f"WITH {SEQUENCES} SELECT id, substr(f, 1, 6) AS umi, substr(f, 7) AS seq, copies FROM (SELECT seq AS f, min(id) AS id, count(*) AS copies FROM sequences GROUP BY seq)",
    ),
    "site_methylation": (lambda s, d: ME.site_methylation(calls(s, d), 3), f"WITH {_SITES} SELECT * FROM sites WHERE meth + unmeth >= 3"),
    "splitting_report": (
        lambda s, d: ME.splitting_report(calls(s, d)),
        f"WITH {CALLS} SELECT count(*) AS total, " + ", ".join(f"count(*) FILTER (context = '{c}' AND meth) AS meth_{c}, count(*) FILTER (context = '{c}' AND NOT meth) AS unmeth_{c}, 100.0::DOUBLE * count(*) FILTER (context = '{c}' AND meth) / count(*) FILTER (context = '{c}') AS pct_{c}" for c in ("CG", "CHG", "CHH")) + " FROM calls",
    ),
    "mbias": (
        lambda s, d: ME.mbias(calls(s, d)),
        f"""WITH {CALLS}, p AS (SELECT context, read_pos, count(*) FILTER (meth) AS meth, count(*) FILTER (NOT meth) AS unmeth FROM calls GROUP BY ALL), e AS (SELECT context, unnest(range(0, max(read_pos) + 1)) AS read_pos FROM p GROUP BY context)
        SELECT context, read_pos, coalesce(meth, 0) AS meth, coalesce(unmeth, 0) AS unmeth, 100.0::DOUBLE * meth / (meth + unmeth) AS pct, coalesce(meth + unmeth, 0) AS coverage FROM e LEFT JOIN p USING (context, read_pos)""",
    ),
    "classify_read_methylation": (
        lambda s, d: ME.classify_reads(calls(s, d), 3, 30, 36),
        f"WITH {CALLS}, p AS (SELECT read, count(*) FILTER (context = 'CG') AS calls, count(*) FILTER (context = 'CG' AND meth) AS m FROM calls GROUP BY read), q AS (SELECT read, calls, CASE WHEN calls > 0 THEN (m * 2000 + calls) // (2 * calls) / 10.0::DOUBLE END AS pct FROM p) SELECT *, CASE WHEN calls < 3 THEN 'discarded' WHEN pct <= 30 THEN 'all_unmeth' WHEN pct >= 36 THEN 'all_meth' ELSE 'mixed' END AS class FROM q",
    ),
    "filter_nonconversion": (
        lambda s, d: ME.filter_nonconversion(_whole_reads(s, d), threshold=9).select("id", "pos"),
        f"WITH {_READS} SELECT id, pos FROM xm WHERE qname NOT IN (SELECT qname FROM xm WHERE length(xm) - length(translate(xm, 'HXU', '')) >= 9)",
    ),
    "filter_nonconversion_consecutive": (
        lambda s, d: ME.filter_nonconversion(_whole_reads(s, d), threshold=3, consecutive=True).select("id", "pos"),
        f"WITH {_READS} SELECT id, pos FROM xm WHERE qname NOT IN (SELECT qname FROM xm WHERE regexp_matches(regexp_replace(xm, '[^HXUhxu]', '', 'g'), '[HXU]{{3}}'))",
    ),
    "filter_nonconversion_percent": (
        lambda s, d: ME.filter_nonconversion(_whole_reads(s, d), pct=40, min_count=5).select("id", "pos"),
        f"""WITH {_READS}, n AS (SELECT qname, length(regexp_replace(xm, '[^HXUhxu]', '', 'g')) AS calls, length(xm) - length(translate(xm, 'HXU', '')) AS bad FROM xm)
        SELECT id, pos FROM xm WHERE qname NOT IN (SELECT qname FROM n WHERE calls >= 5 AND bad * 100.0 >= 40 * calls)""",
    ),
    "discordant_cpgs": (
        lambda s, d: ME.discordant_cpgs(_cx(s, d), 60.0),
        f"""WITH {_CX}, b AS (SELECT a.chrom, a.pos, a.meth AS m1, a.unmeth AS u1, c.meth AS m2, c.unmeth AS u2 FROM cx a JOIN cx c ON a.chrom = c.chrom AND a.strand = '+' AND c.strand = '-' AND c.pos = a.pos + 1 WHERE abs(100.0::DOUBLE * a.meth / (a.meth + a.unmeth) - 100.0::DOUBLE * c.meth / (c.meth + c.unmeth)) > 60)
        SELECT chrom, pos, '+' AS strand, m1 AS meth, u1 AS unmeth, 100.0::DOUBLE * m1 / (m1 + u1) AS pct FROM b UNION ALL SELECT chrom, pos + 1, '-', m2, u2, 100.0::DOUBLE * m2 / (m2 + u2) FROM b""",
    ),
    "merge_cpg_strands": (
        lambda s, d: ME.merge_cpg_strands(_cx(s, d), 60.0),
        f"""WITH {_CX}, b AS (SELECT a.chrom, a.pos, a.meth AS m1, a.unmeth AS u1, c.meth AS m2, c.unmeth AS u2 FROM cx a JOIN cx c ON a.chrom = c.chrom AND a.strand = '+' AND c.strand = '-' AND c.pos = a.pos + 1)
        SELECT chrom, pos, m1 + m2 AS meth, u1 + u2 AS unmeth, 100.0::DOUBLE * (m1 + m2) / (m1 + m2 + u1 + u2) AS pct FROM b WHERE abs(100.0::DOUBLE * m1 / (m1 + u1) - 100.0::DOUBLE * m2 / (m2 + u2)) <= 60""",
    ),
    "replicate_methylation_correlation": (
        lambda s, d: ME.replicate_correlation(ME.site_methylation(calls(s, d).filter("read % 2 = 0")), ME.site_methylation(calls(s, d).filter("read % 2 = 1")), 1).select(F.round("r", 6).alias("r"), "n"),
        f"""WITH {CALLS}, a AS (SELECT chrom, pos, 100.0::DOUBLE * count(*) FILTER (meth) / count(*) AS x FROM calls WHERE read % 2 = 0 GROUP BY ALL), b AS (SELECT chrom, pos, 100.0::DOUBLE * count(*) FILTER (meth) / count(*) AS y FROM calls WHERE read % 2 = 1 GROUP BY ALL)
        SELECT round(coalesce(corr(x, y), 0), 6) AS r, count(*) AS n FROM a JOIN b USING (chrom, pos)""",
    ),
    "bedmethyl": (
        lambda s, d: ME.bedmethyl(_cx(s, d)),
        f"""WITH {_CX}, b AS (SELECT *, CAST(round(100.0::DOUBLE * meth / (meth + unmeth)) AS INT) AS pct FROM cx), r AS (SELECT *, CASE WHEN pct <= 5 THEN '0,255,0' WHEN pct <= 15 THEN '55,255,0' WHEN pct <= 25 THEN '105,255,0' WHEN pct <= 35 THEN '155,255,0' WHEN pct <= 45 THEN '205,255,0' WHEN pct <= 55 THEN '255,255,0'
            WHEN pct <= 65 THEN '255,205,0' WHEN pct <= 75 THEN '255,155,0' WHEN pct <= 85 THEN '255,105,0' WHEN pct <= 95 THEN '255,55,0' ELSE '255,0,0' END AS rgb FROM b)
        SELECT chrom, pos - 1 AS start, pos AS "end", least(meth + unmeth, 1000) AS score, strand, rgb,
        meth + unmeth AS read_count, pct AS percent_meth FROM r""",
    ),
    "cytosine_report": (
        lambda s, d: ME.cytosine_report(sequences(s, d), _genome_cov(s, d)),
        f"""WITH {SEQUENCES}, b AS (SELECT id, seq, unnest(range(1, length(seq) + 1)) AS i FROM sequences), c AS (SELECT id AS chrom, i AS pos, substr(seq, i, 1) AS base, substr(seq, i, 3) AS f, reverse(translate(CASE WHEN i = 1 THEN substr(seq, 1, 1) WHEN i = 2 THEN substr(seq, 1, 2) ELSE substr(seq, i - 2, 3) END, 'ACGT', 'TGCA')) AS r FROM b),
        t AS (SELECT chrom, pos, CASE WHEN base = 'C' THEN '+' ELSE '-' END AS strand, rpad(CASE WHEN base = 'C' THEN f ELSE r END, 3, 'N') AS tri FROM c WHERE base IN ('C', 'G')),
        k AS (SELECT *, CASE WHEN regexp_matches(tri, '^CG') THEN 'CG' WHEN regexp_matches(tri, '^C[ACT]G') THEN 'CHG' WHEN regexp_matches(tri, '^C[ACT][ACT]') THEN 'CHH' END AS context FROM t)
        SELECT chrom, pos, strand, CASE WHEN pos = 5 THEN 3 ELSE 0 END AS meth, CASE WHEN pos = 5 THEN 1 ELSE 0 END AS unmeth, context, tri FROM k WHERE context IS NOT NULL""",
    ),
    "kmer_counts": (lambda s, d: Q.kmer_counts(sequences(s, d), 4), f"WITH {SEQUENCES} SELECT kmer, count(*) AS n FROM {_KMER(4)} WHERE NOT contains(kmer, 'N') GROUP BY kmer"),
    "nucleotide_frequencies": (
        lambda s, d: Q.nucleotide_frequencies(sequences(s, d)),
        f"WITH {SEQUENCES}, k AS (SELECT kmer, count(*) AS n FROM (SELECT * FROM {_KMER(1)} UNION ALL SELECT * FROM {_KMER(2)}) WHERE NOT contains(kmer, 'N') GROUP BY kmer) SELECT kmer, n, n / CAST(sum(n) OVER (PARTITION BY length(kmer)) AS DOUBLE) AS share FROM k",
    ),
    "find_motif": (
        lambda s, d: Q.find_motif(sequences(s, d), "DRACH"),
        f"""WITH {SEQUENCES} SELECT id, "at", '+' AS strand, kmer AS word FROM {_KMER(5)} WHERE regexp_matches(kmer, '^[AGT][AG]AC[ACT]$')""",
    ),
    "find_motif_both_strands": (
        lambda s, d: Q.find_motif(sequences(s, d), "GGATCY", both_strands=True).groupBy("strand", "word").agg(F.count("*").alias("n")),
        f"WITH {SEQUENCES}, k AS {_KMER(6)}, r AS (SELECT '+' AS strand, kmer AS word FROM k UNION ALL SELECT '-', reverse(translate(kmer, 'ACGT', 'TGCA')) FROM k) SELECT strand, word, count(*) AS n FROM r WHERE regexp_matches(word, '^GGATC[CT]$') GROUP BY ALL",
    ),
    "extract_sequence": (
        lambda s, d: Q.extract_sequence(_loci(s, d), sequences(s, d), size=512).select("id", "seq"),
        f"""WITH {SEQUENCES} SELECT id, CASE WHEN id % 3 = 0 THEN reverse(translate(substr(seq, length(seq) // 3 + 1, length(seq) // 2), 'ACGTN', 'TGCAN')) ELSE substr(seq, length(seq) // 3 + 1, length(seq) // 2) END AS seq FROM sequences WHERE length(seq) > 0""",
    ),
    "trim_to_center": (
        lambda s, d: Q.trim_to_center(sequences(s, d), sequences(s, d).filter("id % 2 = 0")).select("id", "seq"),
        f"WITH {SEQUENCES}, m AS (SELECT CAST(floor(avg(length(seq)) / 2) AS BIGINT) AS half FROM sequences WHERE id % 2 = 0) SELECT id, substr(seq, CAST(greatest(length(seq) // 2 - half, 0) + 1 AS BIGINT), half * 2) AS seq FROM sequences, m",
    ),
    "bisulfite_convert": (lambda s, d: Q.bisulfite_convert(sequences(s, d)), f"WITH {SEQUENCES} SELECT id, translate(seq, 'Cc', 'Tt') AS ct, translate(seq, 'Gg', 'Aa') AS ga FROM sequences"),
    "gc_windows": (
        lambda s, d: Q.gc_windows(sequences(s, d), 200),
        f"""WITH {SEQUENCES}, w AS (SELECT id, start, substr(seq, start + 1, 200) AS p FROM (SELECT id, seq, unnest(range(0, length(seq), 200)) AS start FROM sequences WHERE length(seq) > 0)) SELECT id, CAST(start AS INT) AS start,
        (length(p) - length(translate(p, 'GC', ''))) / CAST(nullif(length(p) - length(translate(p, 'ACGT', '')), 0) AS DOUBLE) AS gc FROM w""",
    ),
    "mappability_windows": (
        lambda s, d: Q.mappability_windows(sequences(s, d), 16, 200).select("id", "start", F.round(F.col("mappability") * 200).cast("long").alias("unique"), F.round(F.col("gc") * F.col("mappability") * 3200).cast("long").alias("gc")),
        f"""WITH {SEQUENCES}, k AS (SELECT id, "at", kmer, least(kmer, reverse(translate(kmer, 'ACGT', 'TGCA'))) AS w FROM {_KMER(16)} WHERE NOT contains(kmer, 'N')), u AS (SELECT any_value(id) AS id, any_value("at") AS pos, any_value(length(kmer) - length(translate(kmer, 'GC', ''))) AS gc FROM k GROUP BY w HAVING count(*) = 1),
        g AS (SELECT id, unnest(range(0, length(seq), 200)) AS start FROM sequences WHERE length(seq) > 0), c AS (SELECT id, pos // 200 * 200 AS start, count(*) AS n, CAST(sum(gc) AS BIGINT) AS gc FROM u GROUP BY ALL)
        SELECT id, start, coalesce(n, 0) AS unique, gc FROM g LEFT JOIN c USING (id, start)""",
    ),
    "extract_calls": (
        lambda s, d: ME.extract_calls(_whole_reads(s, d)).groupBy("pos", "call").agg(F.count("*").alias("n")),
        f"""WITH {_READS}, b AS (SELECT pos, length(xm) AS n, xm, unnest(range(1, length(xm) + 1)) AS i FROM xm),
        c AS (SELECT pos + i - 1 + CASE WHEN n <= 38 OR i <= 10 THEN 0 WHEN i <= 15 THEN 2 WHEN i <= 18 THEN NULL WHEN i <= 38 THEN -1 ELSE 4 END AS pos, substr(xm, i, 1) AS call FROM b)
        SELECT CAST(pos AS INT) AS pos, call, count(*) AS n FROM c WHERE pos IS NOT NULL AND call IN ('Z', 'z', 'X', 'x', 'H', 'h', 'U', 'u') GROUP BY ALL""",
    ),
    "call_methylation": (
        lambda s, d: _called(s, d),
        f"""WITH {SEQUENCES}, b AS (SELECT id, seq, unnest(range(1, length(seq) + 1)) AS i FROM sequences), t AS (SELECT id, i, substr(seq, i, 3) AS tri FROM b),
        l AS (SELECT id, i, CASE WHEN tri[1] <> 'C' THEN '.' WHEN tri[2] = 'G' THEN 'z' WHEN regexp_matches(tri, '^C[ACT]G$') THEN 'x' WHEN regexp_matches(tri, '^C[ACT][ACT]$') THEN 'h' ELSE 'u' END AS letter FROM t)
        SELECT id, (i - 1) // 80 * 80 + 1 AS pos, string_agg(letter, '' ORDER BY i) AS xm FROM l GROUP BY id, (i - 1) // 80""",
    ),
    "mutation_summary": (
        lambda s, d: Q.mutation_summary(Q.select_mutations(_mutations(s, d), "T", "C").withColumn("from", F.col("strand"))),
        f"WITH {PEAKS} SELECT strand AS \"from\", 'C' AS \"to\", count(*) AS n FROM peaks WHERE (strand = '+' AND id % 4 = 3 AND id % 3 = 1) OR (strand = '-' AND id % 4 = 0 AND id % 3 = 2) GROUP BY strand",
    ),
}


def _loci(s, d):
    q = sequences(s, d).filter(F.length("seq") > 0)
    n = F.length("seq")
    start = F.floor(n / 3)
    return q.select("id", F.col("id").alias("chrom"), start.alias("start"), (start + F.floor(n / 2)).alias("end"), F.when(F.col("id") % 3 == 0, "-").otherwise("+").alias("strand"))


def _called(s, d):
    """Consecutive reads of each whole sequence against two more reference bases: id, pos (1-based), xm."""
    c = Q.chunks(sequences(s, d), 80, 0, 2)
    read = F.translate(F.substring("seq", F.lit(1), F.col("core")), "C", "T")
    return c.select("id", (F.col("offset") + 1).alias("pos"), ME.call_methylation(read, F.col("seq")).alias("xm"))


def _mutations(s, d):
    p = peaks(s, d)
    return p.select("id", "strand", F.element_at(F.array(*map(F.lit, "ACGT")), (F.col("id") % 4 + 1).cast("int")).alias("from"), F.element_at(F.array(*map(F.lit, "ACG")), (F.col("id") % 3 + 1).cast("int")).alias("to"))

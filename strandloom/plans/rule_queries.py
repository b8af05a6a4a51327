"""Registered queries of rules for single reads, fragments, mutations, slices and the other conversion strand."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import matrix as M
from ..operators import methylation as ME
from ..operators import reads as R
from ..operators import sequence as Q
from . import read_queries
from .fixtures import GENES, MATRIX, PEAKS, SEQUENCES, genes, matrix, peaks, sequences

_P, _AB = f"WITH {PEAKS}", f"WITH {PEAKS}, {GENES}"


def _mixed(s, d):
    """Reads of which every third name is not paired."""
    i, q = F.col("id"), F.col("qname")
    flag = F.when(q % 3 == 0, 0).otherwise(1) + F.when(F.col("strand") == "-", 16).otherwise(0) + F.when(i % 7 == 0, 4).otherwise(0) + F.when(i % 5 == 0, 2).otherwise(0)
    return peaks(s, d).select("id", "qname", flag.cast("int").alias("flag"), F.col("chrom").alias("rname"), (i % 60).cast("int").alias("mapq"), F.when(i % 2 == 1, q % 900).otherwise(-(q % 900)).alias("tlen"), (i % 4).cast("int").alias("nm"))


def _fragments(s, d):
    """Orders as fragments: their peaks are reads of mates 1 and 2, or single reads, mostly on one chromosome."""
    q = F.col("qname")
    mate = F.when(q % 4 == 0, None).otherwise(F.col("id") % 2 + 1).cast("int")
    return peaks(s, d).select("qname", mate.alias("mate"), F.when(q % 5 == 0, F.col("chrom")).otherwise(F.concat(F.lit("chr"), (q % 5).cast("string"))).alias("chrom"), "start", "end", "strand")


def _blocks(s, d):
    return genes(s, d).withColumn("id", F.col("id") % 700)


_FRAGMENTS = """fr AS (SELECT qname, CASE WHEN qname % 4 <> 0 THEN id % 2 + 1 END AS mate, CASE WHEN qname % 5 = 0 THEN chrom ELSE 'chr' || (qname % 5) END AS chrom, start, "end", strand FROM peaks),
    one AS (SELECT qname FROM fr GROUP BY qname HAVING count(DISTINCT chrom) = 1), ft AS (SELECT id % 700 AS id, chrom, start, "end", strand FROM genes)"""


def _counted(reads, rule):
    return f"""{_AB}, {_FRAGMENTS}, rd AS ({reads}), h AS (SELECT DISTINCT qname, ft.id FROM rd JOIN ft ON rd.chrom = ft.chrom AND rd.start < ft."end" AND ft.start < rd."end" AND rd.start < rd."end" AND ft.start < ft."end" WHERE qname IN (SELECT qname FROM one) AND {rule}),
    k AS (SELECT qname, count(*) AS k FROM h GROUP BY qname)"""


_TYPES = """mu AS (SELECT id, strand, ['A', 'C', 'G', 'T'][CAST(id % 4 + 1 AS INT)] AS f, CASE WHEN qname % 5 = 0 THEN '-' WHEN qname % 5 = 1 THEN '+' ELSE '>' END AS type, ['C', 'G', 'T'][CAST(id % 3 + 1 AS INT)] AS t FROM peaks),
    own AS (SELECT id, type, CASE WHEN strand = '-' THEN translate(f, 'ACGT', 'TGCA') ELSE f END AS f, CASE WHEN strand = '-' THEN translate(t, 'ACGT', 'TGCA') ELSE t END AS t FROM mu)"""


def _types(s, d):
    i, q = F.col("id"), F.col("qname")
    letter = lambda w, n: F.substring(F.lit(w), (i % n + 1).cast("int"), F.lit(1))
    return peaks(s, d).select("id", "strand", letter("ACGT", 4).alias("from"), F.when(q % 5 == 0, "-").when(q % 5 == 1, "+").otherwise(">").alias("type"), letter("CGT", 3).alias("to"))


def _quality(s, d):
    return R.cross_correlation_summary(R.cross_correlation(peaks(s, d), [0, 10, 37, 50, 100]), 37)


#: The SQL of ``cross_correlation`` with all its digits.
_CC = read_queries.QUERIES["cross_correlation"][1].replace("round((n", "((n").replace(", 8) AS r", ") AS r")

QUERIES = {
    "flag_read_pairs_single": (
        lambda s, d: R.flag_read_pairs(_mixed(s, d)).select("id", "qc_flag"),
        f"""{_P}, r AS (SELECT id, qname, CASE WHEN qname % 3 = 0 THEN 0 ELSE 1 END + CASE WHEN strand = '-' THEN 16 ELSE 0 END + CASE WHEN id % 7 = 0 THEN 4 ELSE 0 END + CASE WHEN id % 5 = 0 THEN 2 ELSE 0 END AS flag, chrom, CASE WHEN id % 2 = 1 THEN qname % 900 ELSE -(qname % 900) END AS tlen,
        CAST(id % 60 >= 10 AND id % 4 <= 2 AND id % 7 <> 0 AS INT) AS ok FROM peaks), w AS (SELECT *, count(*) OVER q AS k, min(ok) OVER q AS o, min(chrom) OVER q AS c0, max(chrom) OVER q AS c1, sum(CAST(flag & 16 = 16 AS INT)) OVER q AS m, sum(tlen) OVER q AS t FROM r WINDOW q AS (PARTITION BY qname))
        SELECT id, (flag & (4095 - 514)) | CASE WHEN flag & 1 = 0 THEN CASE WHEN ok = 1 THEN 0 ELSE 512 END WHEN k = 2 AND o = 1 AND c0 = c1 AND m = 1 AND t = 0 AND tlen <> 0 AND abs(tlen) <= 750 THEN 2 ELSE 512 END AS qc_flag FROM w""",
    ),
    "fragment_counts_same": (
        lambda s, d: R.fragment_counts(_fragments(s, d), _blocks(s, d), "same"),
        _counted("SELECT * FROM fr", "CASE WHEN mate = 2 THEN rd.strand <> ft.strand ELSE rd.strand = ft.strand END") + " SELECT ft.id, CAST(count(DISTINCT qname) AS DOUBLE) AS n FROM (SELECT DISTINCT id FROM ft) ft LEFT JOIN h USING (id) GROUP BY ft.id",
    ),
    "fragment_counts_unique": (
        lambda s, d: R.fragment_counts(_fragments(s, d), _blocks(s, d), "opposite", unique=True),
        _counted("SELECT * FROM fr", "CASE WHEN mate = 2 THEN rd.strand = ft.strand ELSE rd.strand <> ft.strand END") + " SELECT ft.id, CAST(count(DISTINCT u.qname) AS DOUBLE) AS n FROM (SELECT DISTINCT id FROM ft) ft LEFT JOIN (SELECT h.* FROM h JOIN k USING (qname) WHERE k = 1) u USING (id) GROUP BY ft.id",
    ),
    "fragment_counts_extended": (
        lambda s, d: R.fragment_counts(_fragments(s, d).withColumn("mate", F.lit(None).cast("int")), _blocks(s, d), fractional=True, extend=60).withColumn("n", F.round("n", 6)),
        _counted("""SELECT qname, chrom, strand, CASE WHEN strand = '-' THEN greatest(start - 60, 0) ELSE start END AS start, CASE WHEN strand = '-' THEN "end" ELSE "end" + 60 END AS "end" FROM fr""", "true")
        + " SELECT ft.id, round(coalesce(sum(1.0::DOUBLE / k), 0), 6) AS n FROM (SELECT DISTINCT id FROM ft) ft LEFT JOIN (SELECT h.*, k.k FROM h JOIN k USING (qname)) u USING (id) GROUP BY ft.id",
    ),
    "cross_correlation_quality": (
        lambda s, d: _quality(s, d).select("fragment", F.round("nsc", 6).alias("nsc"), F.round("rsc", 6).alias("rsc"), "quality"),
        f"""WITH cc AS ({_CC}), t AS (SELECT arg_max(shift, (r, -shift)) AS fragment, max(r) AS top, min(r) AS low, max(r) FILTER (abs(shift - 37) <= 2) AS phantom FROM cc), q AS (SELECT fragment, top / low AS nsc, (top - low) / (phantom - low) AS rsc FROM t)
        SELECT fragment, round(nsc, 6) AS nsc, round(rsc, 6) AS rsc, CASE WHEN rsc >= 1.5 THEN 2 WHEN rsc >= 1 THEN 1 WHEN rsc >= 0.5 THEN 0 WHEN rsc >= 0.25 THEN -1 WHEN rsc >= 0 THEN -2 END AS quality FROM q""",
    ),
    "mutation_types": (
        lambda s, d: Q.select_mutation_type(_types(s, d), "t2c").select("id", "type").unionByName(Q.select_mutation_type(_types(s, d), "del").select("id", "type")).unionByName(Q.select_mutation_type(_types(s, d), "sub", "a", "g").select("id", "type")),
        f"{_P}, {_TYPES} SELECT id, type FROM own WHERE (type = '>' AND f = 'T' AND t = 'C') OR type = '-' OR (type = '>' AND f = 'A' AND t = 'G')",
    ),
    "mutation_type_summary": (
        lambda s, d: Q.mutation_type_summary(_types(s, d)),
        f"""{_P}, {_TYPES} SELECT CASE type WHEN '-' THEN 'Deletion' WHEN '+' THEN 'Insertion' ELSE 'Substitution' END AS kind, count(*) AS n FROM own GROUP BY 1 UNION ALL SELECT f || '-' || t, count(*) FROM own WHERE type = '>' GROUP BY 1""",
    ),
    "slice_rows": (
        lambda s, d: M.transpose(M.slice_rows(matrix(s, d), 10, -1)).select("id", "sample", "value"),
        f"WITH {MATRIX}, o AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT id FROM matrix)) SELECT sample AS id, CAST(id AS VARCHAR) AS sample, value FROM matrix JOIN o USING (id) WHERE i >= 10 AND i < n - 1",
    ),
    "call_methylation_ga": (
        lambda s, d: sequences(s, d).filter(F.length("seq") > 0).select("id", ME.call_methylation_ga(F.when(F.col("id") % 2 == 1, F.translate("seq", "G", "A")).otherwise(F.col("seq")), F.concat(F.lit("NN"), "seq")).alias("xm")),
        f"""WITH {SEQUENCES}, b AS (SELECT id, seq, unnest(range(1, length(seq) + 1)) AS i FROM sequences), t AS (SELECT id, i, substr('NN' || seq, i, 3) AS tri FROM b),
        l AS (SELECT id, i, CASE WHEN tri[3] <> 'G' THEN '.' WHEN tri[2] = 'C' THEN 'Z' WHEN regexp_matches(tri, '^C[AGT]G$') THEN 'X' WHEN regexp_matches(tri, '^[AGT][AGT]G$') THEN 'H' ELSE 'U' END AS letter FROM t)
        SELECT id, string_agg(CASE WHEN id % 2 = 1 THEN lower(letter) ELSE letter END, '' ORDER BY i) AS xm FROM l GROUP BY id""",
    ),
}

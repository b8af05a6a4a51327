"""Registered queries of choices that operators offer beside their first form."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals as I
from ..operators import matrix as M
from ..operators import methylation as ME
from ..operators import reads as R
from ..operators import sets as T
from ..operators import signal as S
from ..operators.stored import written
from .fixtures import CALLS, GENES, MATRIX, PEAKS, SIZES, calls, genes, matrix, peaks, sizes, windows

_AB = f"WITH {PEAKS}, {GENES}"
_KINDS = ["click", "error", "purchase", "signup", "view"]


def _by_strand(s, d):
    """Windows with their hits on either strand, each as a sample."""
    w = written(windows(s, d, 300, {k: F.col("strand") == k for k in "+-"}), "windows")
    return (w.select("chrom", "start", F.col(k).alias("hits")) for k in "+-")


_COUNTED = """SELECT count(p.id) AS v FROM t LEFT JOIN (SELECT * FROM peaks WHERE strand = '{0}') p ON p.chrom = t.chrom AND p.start < t."end" AND t.start < p."end" GROUP BY t.chrom, t.start"""

QUERIES = {
    "chop": (
        lambda s, d: I.chop(peaks(s, d), 20, 15).select("id", "chrom", "start", "end"),
        f"""WITH {PEAKS} SELECT id, chrom, s AS start, least(s + 20, "end") AS "end" FROM (SELECT *, unnest(range(start, "end", 15)) AS s FROM peaks WHERE start < "end")""",
    ),
    "extend_short": (
        lambda s, d: I.extend_short(peaks(s, d), 25, 30, 10, sizes(s, d)).select("id", "start", "end"),
        f"""{_AB}, {SIZES}, k AS (SELECT p.*, length, (start + "end") // 2 AS mid FROM peaks p JOIN sizes USING (chrom)) SELECT id, CASE WHEN "end" - start >= 25 THEN start ELSE greatest(mid - CASE WHEN strand = '-' THEN 10 ELSE 30 END, 0) END AS start,
        CASE WHEN "end" - start >= 25 THEN "end" ELSE least(mid + 1 + CASE WHEN strand = '-' THEN 30 ELSE 10 END, length) END AS "end" FROM k""",
    ),
    "distance_class_two_sided": (
        lambda s, d: peaks(s, d).select("id", I.distance_class(F.col("score") - 50000, [1, 5, 20], [2, 5, 40]).alias("class")),
        f"""WITH {PEAKS} SELECT id, CASE WHEN d <= 1000 THEN 'TSS (<=1kb)' WHEN d <= 2000 THEN 'TSS (1-2kb)' WHEN d <= 5000 THEN 'TSS (2-5kb)' WHEN d <= 20000 THEN 'TSS (5-20kb)' WHEN d <= 40000 THEN 'TSS (20-40kb)' ELSE 'intergenic' END AS class FROM (SELECT id, abs(score - 50000) AS d FROM peaks)""",
    ),
    "expression_matrix_cqv": (
        lambda s, d: M.expression_matrix(matrix(s, d), _KINDS, "value", "count"),
        f"WITH {MATRIX} SELECT id, " + ", ".join(f"max(CASE WHEN sample = '{k}' THEN value END) AS {k}" for k in _KINDS) + ", " + ", ".join(f'max(CASE WHEN sample = \'{k}\' THEN count END) AS "{k}_CQV"' for k in _KINDS) + " FROM matrix GROUP BY id",
    ),
    "integrate_sites_ids": (
        lambda s, d: T.integrate_sites(peaks(s, d).select("id", "chrom", F.col("start").alias("start"), (F.col("start") + 1).alias("end"), "strand", F.col("score").alias("reads"), F.col("status").alias("replicate"), F.col("status").alias("kind"))),
        f"""WITH {PEAKS} SELECT chrom, start, start + 1 AS "end", strand, max(score) AS reads, count(DISTINCT status) AS replicates, string_agg(DISTINCT status, '|' ORDER BY status) AS kinds, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids FROM peaks GROUP BY chrom, start, strand""",
    ),
    "combine_sites_by_id": (
        lambda s, d: T.combine_sites(*(peaks(s, d).filter(F.col("status") == x).select("id", "chrom", "start", (F.col("start") + 1).alias("end"), "strand", F.col("score").alias("reads")) for x in "FO"), by_id=True),
        f"""WITH {PEAKS} SELECT chrom, start, start + 1 AS "end", strand, string_agg(CAST(id AS VARCHAR), '=' ORDER BY status, CAST(id AS VARCHAR)) AS id, CAST(sum(score) AS BIGINT) AS reads FROM peaks GROUP BY chrom, start, strand""",
    ),
    "site_methylation_checked": (
        lambda s, d: ME.site_methylation(calls(s, d).withColumn("call", F.element_at(F.array(*map(F.lit, "ZzXxHhU.")), (F.col("read_pos") % 8 + 1).cast("int")))).select("chrom", "pos", "meth", "unmeth"),
        f"""WITH {CALLS}, k AS (SELECT *, substr('ZzXxHhU.', CAST(read_pos % 8 + 1 AS INT), 1) AS call FROM calls) SELECT chrom, pos, count(*) FILTER (meth) AS meth, count(*) FILTER (NOT meth) AS unmeth FROM k WHERE CASE WHEN meth THEN call IN ('Z', 'X', 'H', 'U') ELSE call IN ('z', 'x', 'h', 'u') END GROUP BY ALL""",
    ),
    "strand_coverage_unique": (
        lambda s, d: S.strand_coverage(peaks(s, d).withColumn("hits", F.col("qname") % 3 + 1), unique=True).groupBy("strand", "depth").agg(F.sum(F.col("end") - F.col("start")).alias("bases")),
        f"""WITH {PEAKS}, u AS (SELECT * FROM peaks WHERE qname % 3 = 0), e AS (SELECT strand, chrom, pos, sum(d) AS d FROM (SELECT strand, chrom, start AS pos, 1 AS d FROM u UNION ALL SELECT strand, chrom, "end", -1 FROM u) GROUP BY ALL),
        r AS (SELECT strand, lead(pos) OVER w - pos AS bases, CAST(sum(d) OVER (PARTITION BY strand, chrom ORDER BY pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth FROM e WINDOW w AS (PARTITION BY strand, chrom ORDER BY pos)) SELECT strand, depth, CAST(sum(bases) AS BIGINT) AS bases FROM r WHERE depth > 0 GROUP BY ALL""",
    ),
    "jensen_shannon": (
        lambda s, d: S.jensen_shannon(*_by_strand(s, d)).select(F.round("jsd", 6).alias("jsd"), "n_a", "n_b"),
        f"""{_AB}, {SIZES}, t AS (SELECT chrom, start, least(start + 300, length) AS "end" FROM (SELECT chrom, length, unnest(range(0, length, 300)) AS start FROM sizes)), a AS ({_COUNTED.format('+')}), b AS ({_COUNTED.format('-')}),
        x AS (SELECT v, count(*) AS x FROM a GROUP BY v), y AS (SELECT v, count(*) AS y FROM b GROUP BY v), n AS (SELECT (SELECT count(*) FROM a) AS n_a, (SELECT count(*) FROM b) AS n_b),
        k AS (SELECT coalesce(x, 0) / CAST(n_a AS DOUBLE) AS p, coalesce(y, 0) / CAST(n_b AS DOUBLE) AS q, n_a, n_b FROM x FULL JOIN y USING (v), n)
        SELECT round(sqrt(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2), 6) AS jsd, max(n_a) AS n_a, max(n_b) AS n_b FROM k""",
    ),
    "umi_into_name": (
        lambda s, d: peaks(s, d).select("id", R.umi_into_name(F.when(F.col("id") % 4 == 0, F.concat(F.lit("@r"), "id")).otherwise(F.concat(F.lit("@r"), "id", F.lit(" 1:N:0:ACGT+GG"), F.col("id") % 10))).alias("name")),
        f"""WITH {PEAKS} SELECT id, CASE WHEN id % 4 = 0 THEN '@r' || id || '#' ELSE '@r' || id || '#GG' || (id % 10) || ' 1:N:0:ACGT+GG' || (id % 10) END AS name FROM peaks""",
    ),
}

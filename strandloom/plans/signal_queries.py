"""Registered queries of the signal, peak-set, contact and cycle operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals as I
from ..operators import sets as T
from ..operators import signal as S
from .fixtures import GENES, PEAKS, SIZES, genes, peaks, sizes, table, windows
from .interval_queries import _MERGE

_P, _AB = f"WITH {PEAKS}", f"WITH {PEAKS}, {GENES}"
_CUTS = """cuts AS (SELECT id, chrom, CASE WHEN strand = '-' THEN "end" ELSE start END AS start, CASE WHEN strand = '-' THEN "end" ELSE start END + 1 AS "end" FROM peaks), counts AS (SELECT chrom, start, count(*) AS n FROM cuts GROUP BY ALL)"""
_COV = """e AS (SELECT chrom, pos AS start, sum(d) AS d FROM (SELECT chrom, start AS pos, 1 AS d FROM peaks UNION ALL SELECT chrom, "end", -1 FROM peaks) GROUP BY ALL HAVING sum(d) <> 0),
    cov AS (SELECT * FROM (SELECT chrom, start, lead(start) OVER w AS "end", CAST(sum(d) OVER (PARTITION BY chrom ORDER BY start ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth FROM e WINDOW w AS (PARTITION BY chrom ORDER BY start)) WHERE depth > 0)"""


def _cuts(s, d):
    return S.read_cuts(peaks(s, d)).select("id", "chrom", "start", "end")


def _half(s, d, k):
    return peaks(s, d).filter(F.col("id") % 2 == k)


def _steps(s, d):
    p = peaks(s, d)
    return p.select(F.col("qname").alias("cycle"), F.col("id").alias("ord"), F.concat(F.lit("chr"), (F.col("start") % 2).cast("string")).alias("chrom"), (F.floor(F.col("start") / 4000) * 50).alias("start"), (F.floor(F.col("start") / 4000) * 50 + F.col("end") - F.col("start")).alias("end"), "strand")


_STEPS = f"""{PEAKS}, steps AS (SELECT qname AS cycle, id AS ord, 'chr' || CAST(start % 2 AS VARCHAR) AS chrom, start // 4000 * 50 AS start, start // 4000 * 50 + "end" - start AS "end", strand FROM peaks)"""


def _pairs(s, d):
    p = peaks(s, d)
    return p.select("id", F.col("chrom").alias("chrom1"), (F.floor(F.col("start") / 50) * 50).alias("pos1"), F.concat(F.lit("chr"), (F.col("id") % 5).cast("string")).alias("chrom2"), (F.floor(F.col("end") / 80) * 50).alias("pos2"), (F.col("id") % 60).alias("mapq"))


_PAIRS = f"""{PEAKS}, raw AS (SELECT id, chrom AS c1, start // 50 * 50 AS p1, 'chr' || CAST(id % 5 AS VARCHAR) AS c2, "end" // 80 * 50 AS p2, id % 60 AS mapq FROM peaks),
    pairs AS (SELECT id, mapq, CASE WHEN (c1, p1) <= (c2, p2) THEN c1 ELSE c2 END AS chrom1, CASE WHEN (c1, p1) <= (c2, p2) THEN p1 ELSE p2 END AS pos1, CASE WHEN (c1, p1) <= (c2, p2) THEN c2 ELSE c1 END AS chrom2, CASE WHEN (c1, p1) <= (c2, p2) THEN p2 ELSE p1 END AS pos2 FROM raw)"""


def _sites(s, d):
    p = peaks(s, d)
    pos = F.floor(F.col("start") / 100) * 100
    return p.select("chrom", pos.alias("start"), (pos + 1).alias("end"), "strand", (F.col("id") % 50).alias("reads"), (F.col("qname") % 3).alias("replicate"), F.when(F.col("id") % 2 == 0, "DEL").otherwise("SUB").alias("kind"))


_SITES = f"""{PEAKS}, sites AS (SELECT chrom, start // 100 * 100 AS start, start // 100 * 100 + 1 AS "end", strand, id % 50 AS reads, qname % 3 AS replicate, CASE WHEN id % 2 = 0 THEN 'DEL' ELSE 'SUB' END AS kind FROM peaks)"""

QUERIES = {
    "cut_counts": (lambda s, d: S.cut_counts(_cuts(s, d)), f"{_P}, {_CUTS} SELECT * FROM counts"),
    "filter_bad_spots": (
        lambda s, d: S.filter_bad_spots(S.cut_counts(_cuts(s, d)), 5, 25, 6, 0.5),
        f"""{_P}, {_CUTS}, w AS (SELECT *, sum(n) OVER (PARTITION BY chrom ORDER BY start RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS a, sum(n) OVER (PARTITION BY chrom ORDER BY start RANGE BETWEEN 25 PRECEDING AND 25 FOLLOWING) AS b FROM counts)
        SELECT chrom, start, n FROM w WHERE a < 6 OR a / (b + 0.01::DOUBLE) < 0.5""",
    ),
    "kept_cuts": (
        lambda s, d: S.filter_bad_spots(S.cut_counts(_cuts(s, d)), 5, 25, 6, 0.5).agg(F.sum("n").alias("cuts"), F.count("*").alias("positions")),
        f"""{_P}, {_CUTS}, w AS (SELECT *, sum(n) OVER (PARTITION BY chrom ORDER BY start RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS a, sum(n) OVER (PARTITION BY chrom ORDER BY start RANGE BETWEEN 25 PRECEDING AND 25 FOLLOWING) AS b FROM counts)
        SELECT CAST(sum(n) AS BIGINT) AS cuts, count(*) AS positions FROM w WHERE a < 6 OR a / (b + 0.01::DOUBLE) < 0.5""",
    ),
    "tag_density": (
        lambda s, d: S.tag_density(_cuts(s, d), sizes(s, d)),
        f"""{_AB}, {SIZES}, {_CUTS}, i AS (SELECT chrom, n, unnest(range(CAST(greatest(ceil((start - 65 - 19) / 20.0::DOUBLE), 0) AS BIGINT), CAST(floor((start + 65) / 20.0::DOUBLE) AS BIGINT) + 1)) AS i FROM counts)
        SELECT chrom, i * 20 AS start, least(i * 20 + 20, length) AS "end", CAST(sum(n) AS BIGINT) AS density FROM i JOIN sizes USING (chrom) WHERE i * 20 < length GROUP BY chrom, i, length""",
    ),
    "normalized_density": (
        lambda s, d: S.normalized_density(S.tag_density(_cuts(s, d), sizes(s, d)), "density", exclude=("chr4",)).select("chrom", "start", F.round("density", 6).alias("density")),
        f"""{_AB}, {SIZES}, {_CUTS}, i AS (SELECT chrom, n, unnest(range(CAST(greatest(ceil((start - 65 - 19) / 20.0::DOUBLE), 0) AS BIGINT), CAST(floor((start + 65) / 20.0::DOUBLE) AS BIGINT) + 1)) AS i FROM counts WHERE chrom <> 'chr4'),
        t AS (SELECT chrom, i * 20 AS start, sum(n) AS density FROM i JOIN sizes USING (chrom) WHERE i * 20 < length GROUP BY chrom, i) SELECT chrom, start, round(density * 1e6 / sum(density) OVER (), 6) AS density FROM t""",
    ),
    "spot_score": (
        lambda s, d: S.spot_score(_cuts(s, d), genes(s, d)),
        f"""{_AB}, {_CUTS}, t AS (SELECT count(*) AS total, count(*) FILTER (EXISTS (SELECT 1 FROM genes g WHERE g.chrom = c.chrom AND g.start < c."end" AND c.start < g."end")) AS inside FROM cuts c) SELECT inside, total, inside / CAST(total AS DOUBLE) AS spot FROM t""",
    ),
    "breadth_of_coverage": (
        lambda s, d: S.breadth_of_coverage(I.genome_coverage(peaks(s, d)), sizes(s, d), 5),
        f"""{_AB}, {SIZES}, {_COV}, c AS (SELECT CAST(coalesce(sum("end" - start), 0) AS BIGINT) AS covered FROM cov WHERE depth >= 5), g AS (SELECT CAST(sum(length) AS BIGINT) AS genome FROM sizes) SELECT covered, genome, covered * 100.0::DOUBLE / genome AS percent FROM c, g""",
    ),
    "smooth_average": (
        lambda s, d: S.smooth(S.cut_counts(_cuts(s, d)), ["chrom"], "start", "n", 5).select("chrom", "start", F.round("smoothed", 6).alias("smoothed")),
        f"""{_P}, {_CUTS}, i AS (SELECT chrom, start, n, row_number() OVER (PARTITION BY chrom ORDER BY start) - 1 AS i, count(*) OVER (PARTITION BY chrom) AS n_rows FROM counts),
        f AS (SELECT chrom, i, n_rows, start, CASE
            WHEN i < 2 THEN (SELECT sum(x.n) FROM i x WHERE x.chrom = y.chrom AND x.i BETWEEN 0 AND 2 * y.i) / (2 * i + 1)
            WHEN i = n_rows - 2 THEN (sum(n) OVER e3 + lead(n) OVER o) / 4.0 WHEN i = n_rows - 1 THEN n ELSE (sum(n) OVER c) / 5.0 END AS v
            FROM i y WINDOW o AS (PARTITION BY chrom ORDER BY i), e3 AS (PARTITION BY chrom ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), c AS (PARTITION BY chrom ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)),
        b AS (SELECT chrom, start, v, n_rows - 1 - i AS i, n_rows FROM f)
        SELECT chrom, start, round(CASE
            WHEN i < 2 THEN (SELECT sum(x.v) FROM b x WHERE x.chrom = y.chrom AND x.i BETWEEN 0 AND 2 * y.i) / (2 * i + 1)
            WHEN i = n_rows - 2 THEN (sum(v) OVER e3 + lead(v) OVER o) / 4.0 WHEN i = n_rows - 1 THEN v ELSE (sum(v) OVER c) / 5.0 END, 6) AS smoothed
            FROM b y WINDOW o AS (PARTITION BY chrom ORDER BY i), e3 AS (PARTITION BY chrom ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), c AS (PARTITION BY chrom ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)""",
    ),
    "smooth_move": (
        lambda s, d: S.smooth(S.cut_counts(_cuts(s, d)), ["chrom"], "start", "n", 4, "move").select("chrom", "start", F.round("smoothed", 6).alias("smoothed")),
        f"""{_P}, {_CUTS}, f AS (SELECT chrom, start, avg(n) OVER (PARTITION BY chrom ORDER BY start ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS f FROM counts)
        SELECT chrom, start, round(avg(f) OVER (PARTITION BY chrom ORDER BY start DESC ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 6) AS smoothed FROM f""",
    ),
    "summits": (
        lambda s, d: S.summits(S.cut_counts(_cuts(s, d)), ["chrom"], "start", "n").select("chrom", "start", "n"),
        f"""{_P}, {_CUTS}, a AS (SELECT *, sign(n - lag(n) OVER w) AS c, lead(n) OVER w AS nx FROM counts WINDOW w AS (PARTITION BY chrom ORDER BY start)),
        b AS (SELECT *, coalesce(last_value(nullif(c, 0) IGNORE NULLS) OVER (PARTITION BY chrom ORDER BY start ROWS UNBOUNDED PRECEDING), 1) AS d FROM a) SELECT chrom, start, n FROM b WHERE d > 0 AND (nx IS NULL OR nx < n)""",
    ),
    "hotspot_score": (
        lambda s, d: S.hotspot_score(genes(s, d), peaks(s, d).withColumn("fdr", (F.col("id") % 1000 + 1) / 1000.0)).select("id", F.round("log_fdr", 6).alias("log_fdr"), "score"),
        f"""{_AB}, m AS (SELECT g.id, min((p.id % 1000 + 1) / 1000.0::DOUBLE) AS f FROM genes g LEFT JOIN peaks p ON p.chrom = g.chrom AND p.start < g."end" AND g.start < p."end" GROUP BY g.id) SELECT id, round(least(100.0, -log10(f)), 6) AS log_fdr, CAST(floor(least(100.0, -log10(f)) * 10 + 0.5) AS BIGINT) AS score FROM m""",
    ),
    "hotspot_merge": (
        lambda s, d: S.hotspot_merge(peaks(s, d).withColumn("fdr", 1 - F.col("score") / 100000), 30, 60, "fdr", 0.45).select("chrom", "start", "end"),
        f"""{_P}, hot AS (SELECT * FROM peaks WHERE 1 - score / 100000.0::DOUBLE <= 0.45), m AS {_MERGE('hot')}, k AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY start) AS k FROM m),
        g AS (SELECT chrom, k, start, "end", CAST(NULL AS BIGINT) AS out_start, CAST(NULL AS BIGINT) AS out_end FROM k WHERE k = 1
            UNION ALL SELECT k.chrom, k.k, CASE WHEN k.start - g."end" <= 30 AND least(g."end" - g.start, k."end" - k.start) < 60 THEN g.start ELSE k.start END, k."end",
            CASE WHEN k.start - g."end" <= 30 AND least(g."end" - g.start, k."end" - k.start) < 60 THEN NULL ELSE g.start END, CASE WHEN k.start - g."end" <= 30 AND least(g."end" - g.start, k."end" - k.start) < 60 THEN NULL ELSE g."end" END
            FROM g JOIN k ON k.chrom = g.chrom AND k.k = g.k + 1)
        SELECT chrom, start, "end" FROM (SELECT chrom, out_start AS start, out_end AS "end" FROM g WHERE out_start IS NOT NULL UNION ALL SELECT chrom, start, "end" FROM g QUALIFY row_number() OVER (PARTITION BY chrom ORDER BY k DESC) = 1) WHERE "end" - start >= 60""".replace("WITH ", "WITH RECURSIVE ", 1),
    ),
    "greedy_peaks": (lambda s, d: S.greedy_peaks(peaks(s, d)).select("id", "chrom", "start", "end"), None),
    "fingerprint": (
        lambda s, d: S.fingerprint(windows(s, d, 500), bins=10).select("bin", F.round("share", 6).alias("share")),
        f"""{_AB}, {SIZES}, t AS (SELECT chrom, start, least(start + 500, length) AS "end" FROM (SELECT chrom, length, unnest(range(0, length, 500)) AS start FROM sizes)), h AS (SELECT g.chrom, g.start, count(p.id) AS v FROM t g LEFT JOIN peaks p ON p.chrom = g.chrom AND p.start < g."end" AND g.start < p."end" GROUP BY ALL),
        k AS (SELECT v, count(*) AS k FROM h GROUP BY v), c AS (SELECT v, sum(k) OVER (ORDER BY v) AS r, sum(v * k) OVER (ORDER BY v) AS m FROM k) SELECT CAST(ceil(r * 10 / CAST((SELECT max(r) FROM c) AS DOUBLE)) AS BIGINT) AS bin, round(max(m / CAST((SELECT max(m) FROM c) AS DOUBLE)), 6) AS share FROM c GROUP BY 1""",
    ),
    "strand_coverage": (
        lambda s, d: S.strand_coverage(peaks(s, d)).groupBy("strand", "depth").agg(F.sum(F.col("end") - F.col("start")).alias("bases")),
        f"""{_P}, e AS (SELECT strand, chrom, pos, sum(d) AS d FROM (SELECT strand, chrom, start AS pos, 1 AS d FROM peaks UNION ALL SELECT strand, chrom, "end", -1 FROM peaks) GROUP BY ALL), r AS (SELECT strand, lead(pos) OVER w - pos AS bases, CAST(sum(d) OVER (PARTITION BY strand, chrom ORDER BY pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth FROM e WINDOW w AS (PARTITION BY strand, chrom ORDER BY pos))
        SELECT strand, depth, CAST(sum(bases) AS BIGINT) AS bases FROM r WHERE depth > 0 GROUP BY ALL""",
    ),
    "unique_and_shared_peaks": (
        lambda s, d: T.unique_and_shared_peaks(_half(s, d, 0), _half(s, d, 1), peaks(s, d)).groupBy("label").agg(F.count("*").alias("n")),
        f"""{_P}, c AS (SELECT * FROM peaks WHERE id % 2 = 0), t AS (SELECT * FROM peaks WHERE id % 2 = 1), """
        + ", ".join(f"""{n} AS (SELECT * FROM {a} a WHERE NOT EXISTS (SELECT 1 FROM {b} b WHERE a.chrom = b.chrom AND a.start < b."end" AND b.start < a."end" AND (least(a."end", b."end") - greatest(a.start, b.start) >= 0.8 * (a."end" - a.start) OR least(a."end", b."end") - greatest(a.start, b.start) >= 0.8 * (b."end" - b.start))))""" for n, a, b in (("oc", "c", "t"), ("ot", "t", "c"), ("x", "peaks", "oc"), ("y", "x", "ot")))
        + " SELECT 'control' AS label, count(*) AS n FROM oc UNION ALL SELECT 'treat', count(*) FROM ot UNION ALL SELECT 'shared', count(*) FROM y",
    ),
    "collapse_duplicate_peaks": (
        lambda s, d: T.collapse_duplicate_peaks(peaks(s, d).withColumn("label", F.concat(F.lit("s"), (F.col("id") % 4).cast("string")))),
        f"""{_P} SELECT chrom, start, "end", strand, string_agg(DISTINCT 's' || CAST(id % 4 AS VARCHAR), ',' ORDER BY 's' || CAST(id % 4 AS VARCHAR)) AS labels, count(*) AS n FROM peaks GROUP BY ALL""",
    ),
    "integrate_sites": (
        lambda s, d: T.integrate_sites(_sites(s, d)),
        f"""WITH {_SITES} SELECT chrom, start, "end", strand, max(reads) AS reads, count(DISTINCT replicate) AS replicates, string_agg(DISTINCT kind, '|' ORDER BY kind) AS kinds FROM sites GROUP BY ALL""",
    ),
    "combine_sites": (
        lambda s, d: T.combine_sites(_sites(s, d).filter("kind = 'DEL'").drop("kind"), _sites(s, d).filter("kind = 'SUB'").drop("kind")),
        f"""WITH {_SITES} SELECT chrom, start, "end", strand, string_agg(DISTINCT CASE WHEN kind = 'DEL' THEN 'CIMS' ELSE 'CITS' END, '|' ORDER BY CASE WHEN kind = 'DEL' THEN 'CIMS' ELSE 'CITS' END) AS kind, CAST(sum(reads) AS BIGINT) AS reads FROM sites GROUP BY ALL""",
    ),
    "enriched_sites": (
        lambda s, d: T.enriched_sites(peaks(s, d).select("id", (F.col("id") % 17).alias("m"), (F.col("id") % 50 + 17).alias("k")), 0.1, 0.5, 3).select("id", "m", "k", "mk"),
        f"{_P} SELECT id, id % 17 AS m, id % 50 + 17 AS k, (id % 17) / CAST(id % 50 + 17 AS DOUBLE) AS mk FROM peaks WHERE (id % 17) / CAST(id % 50 + 17 AS DOUBLE) BETWEEN 0.1 AND 0.5 AND id % 17 >= 3",
    ),
    "best_score_per_position": (
        lambda s, d: T.best_score_per_position(peaks(s, d)),
        f"""{_P} SELECT chrom, strand, pos, max(score) AS score FROM (SELECT chrom, strand, score, unnest(range(start, "end")) AS pos FROM peaks) GROUP BY ALL""",
    ),
    "read_start_regions": (
        lambda s, d: T.read_start_regions(peaks(s, d), 6).select("chrom", "strand", "start", "end"),
        f"""{_P}, z AS (SELECT DISTINCT chrom, strand, greatest(CASE WHEN strand = '-' THEN "end" - 1 ELSE start END - 6, 0) AS start, CASE WHEN strand = '-' THEN "end" ELSE start + 1 END + 6 AS "end" FROM peaks) SELECT chrom, strand, start, "end" FROM {_MERGE('z', 0, 'chrom, strand')}""",
    ),
    "best_peak_per_gene": (
        lambda s, d: T.best_peak_per_gene(peaks(s, d).select("id", (F.col("qname") % 100).alias("gene"), (F.col("score") % 997 - 400).alias("log2fc"))),
        f"{_P} SELECT id, qname % 100 AS gene, score % 997 - 400 AS log2fc FROM peaks QUALIFY row_number() OVER (PARTITION BY qname % 100 ORDER BY abs(score % 997 - 400) DESC, id) = 1",
    ),
    "cnv_seeds": (
        lambda s, d: T.cnv_seeds(genes(s, d).withColumn("log2", (F.col("id") % 7) / 2.0), 5.0, 100).select("id", F.round("cn", 6).alias("cn")),
        f"""{_AB} SELECT id, round(pow(2, (id % 7) / 2.0::DOUBLE + 1), 6) AS cn FROM genes WHERE pow(2, (id % 7) / 2.0::DOUBLE + 1) >= 5 AND "end" - start >= 100""",
    ),
    "centromere_spans": (
        lambda s, d: T.centromere_spans(genes(s, d), 500),
        f"""{_AB}, k AS (SELECT chrom, start, "end", row_number() OVER (PARTITION BY chrom ORDER BY start, "end") - 1 AS i, count(*) OVER (PARTITION BY chrom) AS n FROM genes)
        SELECT chrom, min(start - 500 * (n - greatest(i, 1))) AS start, max("end" + 500 * (n - greatest(i, 1))) AS "end" FROM k GROUP BY chrom""",
    ),
    "contact_dedup": (
        lambda s, d: T.contact_dedup(_pairs(s, d)).select("id", "chrom1", "pos1", "chrom2", "pos2"),
        f"WITH {_PAIRS} SELECT id, chrom1, pos1, chrom2, pos2 FROM pairs QUALIFY row_number() OVER (PARTITION BY chrom1, pos1, chrom2, pos2 ORDER BY id) = 1",
    ),
    "contact_matrix": (
        lambda s, d: T.contact_matrix(_pairs(s, d), 5000, 30),
        f"WITH {_PAIRS} SELECT chrom1, pos1 // 5000 AS bin1, chrom2, pos2 // 5000 AS bin2, count(*) AS n FROM pairs WHERE mapq >= 30 GROUP BY ALL",
    ),
    "assign_fragment": (
        lambda s, d: T.assign_fragment(peaks(s, d).select("id", "chrom", F.col("start").alias("pos")), genes(s, d).select("chrom", F.col("start").alias("pos"))).select("id", "fragment"),
        f"""{_AB}, c AS (SELECT chrom, start AS pos, row_number() OVER (PARTITION BY chrom ORDER BY start) AS k FROM (SELECT DISTINCT chrom, start FROM genes)) SELECT p.id, coalesce(c.k, 0) AS fragment FROM peaks p ASOF LEFT JOIN c ON p.chrom = c.chrom AND p.start >= c.pos""",
    ),
    "circular_coordinates": (
        lambda s, d: T.circular_coordinates(_steps(s, d)).select("cycle", "ord", "offset", "circle"),
        f"""WITH {_STEPS} SELECT cycle, ord, CAST(coalesce(sum("end" - start) OVER (PARTITION BY cycle ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset", CAST(sum("end" - start) OVER (PARTITION BY cycle) AS BIGINT) AS circle FROM steps""",
    ),
    "classify_cycles": (
        lambda s, d: T.classify_cycles(_steps(s, d)),
        f"""WITH {_STEPS}, l AS (SELECT *, lag(start) OVER w AS s0, lag("end") OVER w AS e0, lag(strand) OVER w AS t0, lag(chrom) OVER w AS c0 FROM steps WINDOW w AS (PARTITION BY cycle ORDER BY ord)),
        a AS (SELECT cycle, count(*) AS segments, count(DISTINCT chrom) AS chroms, count(DISTINCT strand) AS strands, count(DISTINCT (chrom, start, "end")) AS ds, max(CASE WHEN s0 IS NOT NULL AND chrom = c0 AND strand <> t0 AND greatest(start, s0) < least("end", e0) THEN 1 ELSE 0 END) AS fold, max(CASE WHEN s0 IS NOT NULL THEN greatest(start, s0) - least("end", e0) END) AS gap FROM l GROUP BY cycle)
        SELECT cycle, segments, chroms, CASE WHEN segments = 1 THEN 'single' WHEN chroms > 1 THEN 'translocation' WHEN fold = 1 THEN 'foldback' WHEN strands > 1 THEN 'inversion' WHEN ds < segments THEN 'tandem' WHEN gap <= 1000 THEN 'deletion' ELSE 'jump' END AS kind FROM a""",
    ),
    "element_coverage_percent": (
        lambda s, d: T.element_coverage_percent(genes(s, d), peaks(s, d)),
        f"""{_AB}, x AS {_MERGE('genes')}, y AS {_MERGE('peaks')}, c AS (SELECT CAST(sum(least(a."end", b."end") - greatest(a.start, b.start)) AS BIGINT) AS covered FROM x a JOIN y b ON a.chrom = b.chrom AND a.start < b."end" AND b.start < a."end"), t AS (SELECT CAST(sum("end" - start) AS BIGINT) AS total FROM x) SELECT covered, total, covered * 100.0::DOUBLE / total AS percent FROM c, t""",
    ),
    "extend_segments_unique": (
        lambda s, d: T.extend_segments_unique(peaks(s, d), sizes(s, d), 30, 20),
        f"""{_AB}, {SIZES}, u AS (SELECT chrom, start, "end", string_agg(DISTINCT CAST(id AS VARCHAR), ',' ORDER BY CAST(id AS VARCHAR)) AS ids FROM peaks WHERE "end" - start >= 20 GROUP BY ALL) SELECT chrom, greatest(start - 30, 0) AS start, least("end" + 30, length) AS "end", ids FROM u JOIN sizes USING (chrom)""",
    ),
    "enrichment_log2fc": (
        lambda s, d: T.enrichment_log2fc(peaks(s, d).select((F.col("qname") % 200).alias("id"), F.element_at(F.array(*map(F.lit, ("ip_treat", "in_treat", "ip_control", "in_control"))), (F.col("id") % 4 + 1).cast("int")).alias("cell"), (F.col("score") % 50).alias("value"))).select("id", F.round("log2fc", 6).alias("log2fc")),
        f"""{_P}, m AS (SELECT qname % 200 AS id, avg(score % 50) FILTER (id % 4 = 0) AS a, avg(score % 50) FILTER (id % 4 = 1) AS b, avg(score % 50) FILTER (id % 4 = 2) AS c, avg(score % 50) FILTER (id % 4 = 3) AS d FROM peaks GROUP BY 1) SELECT id, round(log2((a + 1) / (b + 1) * (d + 1) / (c + 1)), 6) AS log2fc FROM m""",
    ),
    "psi": (
        lambda s, d: table(s, d, "lineitem").groupBy(F.col("l_partkey").alias("event")).agg(F.array_sort(F.collect_list(F.col("l_linenumber").cast("long"))).alias("x")).select("event", F.round(F.aggregate(T.psi(F.col("x"), F.reverse("x"), F.lit(2.0), F.lit(1.0)), F.lit(0.0), lambda a, b: a + b), 6).alias("total")),
        "WITH g AS (SELECT l_partkey AS event, list_sort(list(l_linenumber)) AS x FROM lineitem GROUP BY 1), u AS (SELECT event, x[i] AS a, x[len(x) + 1 - i] AS b FROM (SELECT event, x, unnest(range(1, len(x) + 1)) AS i FROM g)) SELECT event, round(sum((a / 2.0::DOUBLE) / (a / 2.0::DOUBLE + b)), 6) AS total FROM u GROUP BY event",
    ),
    "bedpe_to_bed": (
        lambda s, d: T.bedpe_to_bed(_pairs(s, d).select("id", "chrom1", F.col("pos1").alias("start1"), (F.col("pos1") + 50).alias("end1"), "chrom2", F.col("pos2").alias("start2"), (F.col("pos2") + 50).alias("end2")), "loop"),
        f"""WITH {_PAIRS} SELECT c1 AS chrom, p1 AS start, p1 + 50 AS "end", 'loop|' || CAST(id AS VARCHAR) || '|1' AS name FROM raw UNION ALL SELECT c2, p2, p2 + 50, 'loop|' || CAST(id AS VARCHAR) || '|2' FROM raw""",
    ),
}

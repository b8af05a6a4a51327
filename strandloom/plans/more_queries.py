"""Registered queries of the filters and the assay chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters as X
from ..operators import intervals as I
from ..operators import methylation as ME
from ..operators import pipelines as C
from ..operators import sequence as Q
from ..operators import sets as T
from .fixtures import GENES, MATRIX, PEAKS, SEQUENCES, TRANSCRIPTS, genes, matrix, peaks, sequences, sizes, table, transcripts

_P, _AB = f"WITH {PEAKS}", f"WITH {PEAKS}, {GENES}"


def _events(s, d):
    t = transcripts(s, d).filter(F.size("blocks") >= 3)
    at = lambda i: F.element_at("blocks", i)
    return t.select(F.col("id").alias("event"), "chrom", at(2)["start"].alias("exon_start"), at(2)["end"].alias("exon_end"), at(1)["end"].alias("up_end"), at(3)["start"].alias("down_start"))


def _exons(s, d):
    return transcripts(s, d).select("id", "chrom", F.explode("blocks").alias("b")).select("id", "chrom", "b.start", "b.end")


QUERIES = {
    "filter_peaks": (
        lambda s, d: X.filter_peaks(peaks(s, d).select("id", (F.col("score") / 10000).alias("signal"), (F.col("id") % 9).alias("pvalue"))).select("id"),
        f"{_P} SELECT id FROM peaks WHERE score / 10000.0 >= 2 AND id % 9 >= 4",
    ),
    "filter_cnv": (
        lambda s, d: X.filter_cnv(genes(s, d).withColumn("cn", F.col("id") % 9), 5, 100).select("id"),
        f'{_AB} SELECT id FROM genes WHERE id % 9 >= 5 AND "end" - start >= 100',
    ),
    "keep_chroms": (
        lambda s, d: X.keep_chroms(peaks(s, d), pattern=r"^chr\d+$", drop=("chr3",)).groupBy("chrom").agg(F.count("*").alias("n")),
        f"{_P} SELECT chrom, count(*) AS n FROM peaks WHERE chrom <> 'chr3' GROUP BY chrom",
    ),
    "filter_events": (
        lambda s, d: X.filter_events(peaks(s, d).select("id", (F.col("id") % 100 / 100.0).alias("p"), (F.col("id") % 77 / 77.0).alias("fdr"), F.when(F.col("id") % 5 > 0, (F.col("id") % 40 - 20) / 20.0).alias("diff")), 0.5, 0.5, 0.4).select("id"),
        f"{_P} SELECT id FROM peaks WHERE id % 100 / 100.0::DOUBLE <= 0.5 AND id % 77 / 77.0::DOUBLE <= 0.5 AND id % 5 > 0 AND abs((id % 40 - 20) / 20.0::DOUBLE) >= 0.4",
    ),
    "valid_event_counts": (
        lambda s, d: X.valid_event_counts(peaks(s, d).select("id", F.array(F.col("id") % 3, F.col("id") % 2).alias("i"), F.array(F.col("id") % 5).alias("k")), [("i", "k")]).select("id"),
        f"{_P} SELECT id FROM peaks WHERE id % 3 + id % 2 + id % 5 > 0",
    ),
    "motif_offset_sites": (
        lambda s, d: X.motif_offset_sites(peaks(s, d).withColumn("motif_index", F.col("id") % 12), 7, 2, 1).select("id", "start", "end"),
        f"""{_P} SELECT id, greatest(start + CASE WHEN strand = '-' THEN -2 ELSE 2 END, 0) AS start, greatest("end" + CASE WHEN strand = '-' THEN -2 ELSE 2 END, 1) AS "end" FROM peaks WHERE abs(id % 12 - 7) <= 1""",
    ),
    "significant_peaks": (
        lambda s, d: X.significant_peaks(peaks(s, d).select("id", F.col("score").alias("mean"), (F.col("id") % 10 / 10.0).alias("p"), F.when(F.col("id") % 7 > 0, F.col("id") % 10 / 10.0).alias("padj"), (F.col("id") % 6).alias("log2fc")), 20000, 0.3, 0.3, 2).select("id"),
        f"{_P} SELECT id FROM peaks WHERE score >= 20000 AND id % 10 <= 3 AND id % 7 > 0 AND id % 6 >= 2",
    ),
    "id_convert": (
        lambda s, d: X.id_convert(table(s, d, "orders").select("o_orderkey", F.concat(F.lit('"'), F.col("o_custkey").cast("string"), F.lit('.2"')).alias("raw")), table(s, d, "customer").select((F.col("c_custkey") % 800).cast("string").alias("gene"), "c_name"), "raw", "gene", "c_name").select("o_orderkey", "c_name"),
        "SELECT o_orderkey, c_name FROM orders LEFT JOIN (SELECT c_custkey % 800 AS k, min(c_name) AS c_name FROM customer GROUP BY 1) ON k = o_custkey",
    ),
    "join_expression_clinical": (
        lambda s, d: X.join_expression_clinical(matrix(s, d).select("id", F.col("sample"), "value"), table(s, d, "events").groupBy(F.col("event_type").alias("sample")).agg(F.count("*").alias("days")), "^(click|view)"),
        f"WITH {MATRIX} SELECT id, sample, value, days FROM matrix JOIN (SELECT event_type AS sample, count(*) AS days FROM events GROUP BY 1) USING (sample) WHERE sample IN ('click', 'view')",
    ),
    "survival_groups": (
        lambda s, d: X.survival_groups(matrix(s, d).select(F.col("sample").alias("gene"), F.col("id").alias("sample"), F.col("count").alias("value"))),
        f"WITH {MATRIX}, q AS (SELECT sample, quantile_cont(count, 0.25) AS lo, quantile_cont(count, 0.75) AS hi FROM matrix GROUP BY sample) SELECT sample AS gene, id AS sample, CASE WHEN count >= hi THEN 'high' ELSE 'low' END AS \"group\" FROM matrix JOIN q USING (sample) WHERE count >= hi OR count <= lo",
    ),
    "exon_position": (
        lambda s, d: X.exon_position(transcripts(s, d)).select("id", "start", "end", "place"),
        f"""WITH {PEAKS}, {TRANSCRIPTS}, e AS (SELECT id, strand, blocks, len(blocks) AS n, unnest(range(1, len(blocks) + 1)) AS i FROM transcripts), a AS (SELECT *, CASE WHEN strand = '-' THEN n + 1 - i ELSE i END AS k FROM e)
        SELECT id, blocks[i].start AS start, blocks[i]."end" AS "end", CASE WHEN n = 1 THEN 'single' WHEN k = 1 THEN 'first' WHEN k = n THEN 'last' ELSE 'internal' END AS place FROM a""",
    ),
    "exon_length_class": (
        lambda s, d: X.exon_length_class(_exons(s, d)).groupBy("size_class").agg(F.count("*").alias("n")),
        f"""WITH {PEAKS}, {TRANSCRIPTS}, e AS (SELECT id, unnest(blocks) AS b FROM transcripts), z AS (SELECT b."end" - b.start AS size FROM e), q AS (SELECT quantile_cont(size, 0.25) AS lo, quantile_cont(size, 0.75) AS hi FROM z)
        SELECT CASE WHEN size < lo THEN 'short' WHEN size > hi THEN 'long' ELSE 'median' END AS size_class, count(*) AS n FROM z, q GROUP BY 1""",
    ),
    "exon_isoforms": (
        lambda s, d: X.exon_isoforms(_events(s, d), _exons(s, d)),
        f"""WITH {PEAKS}, {TRANSCRIPTS}, ev AS (SELECT id AS event, chrom, blocks[2].start AS es, blocks[2]."end" AS ee, blocks[1]."end" AS ue, blocks[3].start AS ds FROM transcripts WHERE len(blocks) >= 3), x AS (SELECT id, chrom, unnest(blocks) AS b FROM transcripts),
        e AS (SELECT DISTINCT event, id FROM ev JOIN x ON ev.chrom = x.chrom AND b.start = es AND b."end" = ee), f AS (SELECT DISTINCT event, id FROM ev JOIN x ON ev.chrom = x.chrom AND b."end" = ue INTERSECT SELECT DISTINCT event, id FROM ev JOIN x ON ev.chrom = x.chrom AND b.start = ds)
        SELECT event, coalesce((SELECT string_agg(id, ',' ORDER BY id) FROM f WHERE f.event = ev.event AND EXISTS (SELECT 1 FROM e WHERE e.event = f.event AND e.id = f.id)), '') AS inclusion, coalesce((SELECT string_agg(id, ',' ORDER BY id) FROM f WHERE f.event = ev.event AND NOT EXISTS (SELECT 1 FROM e WHERE e.event = f.event AND e.id = f.id)), '') AS skipping FROM ev""",
    ),
    "pool_two_sets": (
        lambda s, d: C.pool_two_sets(*(peaks(s, d).filter(F.col("id") % 2 == k).withColumn("gene", F.floor(F.col("start") / 3000)) for k in (0, 1)), mode="intersect", min_len=5),
        f"""{_P}, a AS (SELECT *, start // 3000 AS gene FROM peaks WHERE id % 2 = 0), b AS (SELECT *, start // 3000 AS gene FROM peaks WHERE id % 2 = 1), h AS (SELECT a.id, b.id AS bid, a.gene, a.chrom, greatest(a.start, b.start) AS start, least(a."end", b."end") AS "end", a.strand FROM a JOIN b ON a.chrom = b.chrom AND a.strand = b.strand AND a.gene = b.gene AND a.start < b."end" AND b.start < a."end"),
        u AS (SELECT DISTINCT gene, chrom, start, "end", strand, 'a,b' AS labels FROM h UNION ALL SELECT gene, chrom, start, "end", strand, 'a' FROM a WHERE id NOT IN (SELECT id FROM h) UNION ALL SELECT gene, chrom, start, "end", strand, 'b' FROM b WHERE id NOT IN (SELECT bid FROM h)) SELECT * FROM u WHERE "end" - start >= 5""",
    ),
    "peak_profile": (
        lambda s, d: C.peak_profile(peaks(s, d), genes(s, d), 300, 50),
        f"""{_AB}, t AS (SELECT chrom, strand, CASE WHEN strand = '-' THEN "end" - 1 ELSE start END AS t FROM genes), h AS (SELECT CASE WHEN t.strand = '-' THEN t - (p.start + p."end") // 2 ELSE (p.start + p."end") // 2 - t END AS d FROM peaks p JOIN t ON p.chrom = t.chrom AND (p.start + p."end") // 2 BETWEEN greatest(t - 300, 0) AND t + 300)
        SELECT CAST(floor(d / 50.0::DOUBLE) * 50 AS BIGINT) AS "offset", count(*) AS n FROM h GROUP BY 1""",
    ),
    "methylation_pipeline": (
        lambda s, d: _methylation(s, d),
        f"""WITH {SEQUENCES}, b AS (SELECT id, i, substr(seq, i, 1) AS base, substr(seq, i, 3) AS f, reverse(translate(substr(seq, CAST(greatest(i - 2, 1) AS BIGINT), CAST(least(i, 3) AS BIGINT)), 'ACGT', 'TGCA')) AS r FROM (SELECT id, seq, unnest(range(1, length(seq) + 1)) AS i FROM sequences)),
        t AS (SELECT id, i, base, CASE WHEN base = 'C' THEN f ELSE r END AS tri FROM b WHERE base IN ('C', 'G'))
        SELECT id AS chrom, i - 1 AS start, i AS "end", 1 AS score, CASE WHEN base = 'C' THEN '+' ELSE '-' END AS strand, CASE WHEN base = 'C' THEN '255,0,0' ELSE '0,255,0' END AS rgb, 1 AS read_count, CASE WHEN base = 'C' THEN 100 ELSE 0 END AS percent_meth
        FROM t WHERE regexp_matches(tri, '^(CG|C[ACT]G|C[ACT][ACT])')""",
    ),
    "mutations_in_tags": (
        lambda s, d: T.mutations_in_tags(peaks(s, d).select("id", F.col("qname").alias("tag")), table(s, d, "lineitem").select((F.col("l_orderkey") * 2).alias("tag"))).select("id"),
        f"{_P} SELECT id FROM peaks WHERE qname IN (SELECT l_orderkey * 2 FROM lineitem GROUP BY 1 HAVING count(*) = 1)",
    ),
    "mean_fragment_length": (
        lambda s, d: T.mean_fragment_length(peaks(s, d).select((F.col("end") - F.col("start")).alias("fragment"))),
        f'{_P} SELECT coalesce(avg("end" - start), 73.5) AS fragment FROM peaks',
    ),
    "circle_features": (
        lambda s, d: T.circle_features(_segments(s, d), genes(s, d)),
        f"""{_AB}, st AS (SELECT qname AS cycle, id AS ord, chrom, strand, start, "end" + 100 AS "end" FROM peaks), c AS (SELECT *, CAST(coalesce(sum("end" - start) OVER (PARTITION BY cycle ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS o FROM st),
        h AS (SELECT c.cycle, c.ord, g.id, c.strand AS cs, g.strand AS gs, o + CASE WHEN c.strand = '-' THEN c."end" - g."end" ELSE g.start - c.start END AS start, g."end" - g.start AS w FROM genes g JOIN c ON g.chrom = c.chrom AND g.start >= c.start AND g."end" <= c."end" AND g.start < c."end" AND c.start < g."end" AND g.start < g."end")
        SELECT cycle, ord, id, start, start + w AS "end", CASE WHEN cs = '-' THEN CASE WHEN gs = '-' THEN '+' ELSE '-' END ELSE gs END AS strand FROM h""",
    ),
    "gpc_report": (
        lambda s, d: ME.gpc_report(sequences(s, d), sequences(s, d).select(F.col("id").alias("chrom"), F.lit(7).cast("long").alias("pos"), F.lit(2).cast("long").alias("meth"), F.lit(1).cast("long").alias("unmeth"))),
        f"""WITH {SEQUENCES}, b AS (SELECT id, seq, unnest(range(1, length(seq) + 1)) AS i FROM sequences), k AS (SELECT id AS chrom, i AS pos, CASE WHEN substr(seq, i, 1) = 'C' AND i > 1 AND substr(seq, i - 1, 1) = 'G' THEN '+' WHEN substr(seq, i, 2) = 'GC' THEN '-' END AS strand FROM b)
        SELECT chrom, pos, strand, CASE WHEN pos = 7 THEN 2 ELSE 0 END AS meth, CASE WHEN pos = 7 THEN 1 ELSE 0 END AS unmeth FROM k WHERE strand IS NOT NULL""",
    ),
    "pca": (lambda s, d: C.pca(matrix(s, d), ["click", "error", "purchase", "signup", "view"]), None),
}


def _segments(s, d):
    return peaks(s, d).select(F.col("qname").alias("cycle"), F.col("id").alias("ord"), "chrom", "strand", "start", (F.col("end") + 100).alias("end"))


def _methylation(s, d):
    q = sequences(s, d)
    c = Q.chunks(q, 60)
    reads = c.select(F.concat_ws(":", "id", "offset").alias("qname"), F.col("id").alias("chrom"), (F.col("offset") + 1).cast("long").alias("pos"), F.lit("+").alias("strand"), F.concat(F.col("core").cast("string"), F.lit("M")).alias("cigar"), F.translate("seq", "CGATN", "Zz...").alias("xm"))
    return C.methylation_pipeline(reads, q)

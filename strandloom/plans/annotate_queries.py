"""Registered queries of the annotation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import annotate as A
from ..operators import intervals as I
from .fixtures import GENES, PEAKS, TRANSCRIPTS, genes, peaks, transcripts

_AB = f"WITH {PEAKS}, {GENES}"
CLASSES = ["STANDARD", "SMALL", "MEDIUM", "LARGE", "ECONOMY", "PROMO"]
_RANK = lambda c, order: "CASE " + " ".join(f"WHEN {c} = '{v}' THEN {i + 1}" for i, v in enumerate(order)) + f" ELSE {len(order) + 1} END"
_PAIRS = 'p.chrom = g.chrom AND p.start < g."end" AND g.start < p."end"'
_BP = 'greatest(0, least(p."end", g."end") - greatest(p.start, g.start))'
_CENTER = '((p.start + p."end") // 2)'
_DIST = f"CASE WHEN g.strand = '-' THEN g.\"end\" - 1 - {_CENTER} ELSE {_CENTER} - g.start END"
_PLACE = "CASE WHEN gene IS NULL THEN 'intergenic' WHEN abs(distance) <= 1000 THEN 'TSS (<=1kb)' WHEN abs(distance) <= 2000 THEN 'TSS (1-2kb)' WHEN abs(distance) <= 3000 THEN 'TSS (2-3kb)' ELSE 'intergenic' END"


def _anno_sql(hits, order):
    return f"""{_AB}, h AS ({hits}), b AS (SELECT id, gene_id, gene, class, overlap, distance FROM h QUALIFY row_number() OVER (PARTITION BY id ORDER BY {order}, gene, gene_id) = 1),
    anno AS (SELECT p.id, gene_id, gene, class, overlap, distance, {_PLACE} AS place FROM peaks p LEFT JOIN b USING (id))"""


_HIT = f"SELECT p.id, g.id AS gene_id, g.gene, g.class, {_BP} AS overlap, {_DIST} AS distance FROM peaks p JOIN genes g ON"
_RNA = _anno_sql(f"{_HIT} {_PAIRS} AND p.strand = g.strand", f"{_RANK('class', CLASSES)}, overlap DESC")
_W0 = "greatest(CASE WHEN g.strand = '-' THEN g.\"end\" - 1 - 30 ELSE g.start - 60 END, 0)"
_W1 = "CASE WHEN g.strand = '-' THEN g.\"end\" + 60 ELSE g.start + 1 + 30 END"
_DNA = _anno_sql(f'{_HIT} p.chrom = g.chrom AND ((p.start < g."end" AND g.start < p."end") OR (p.start < {_W1} AND {_W0} < p."end"))', f"abs(distance), {_RANK('class', CLASSES)}")


def _rna(s, d):
    return A.annotate_peaks(peaks(s, d), genes(s, d), CLASSES, "rna")


def _dna(s, d):
    return A.annotate_peaks(peaks(s, d), genes(s, d), CLASSES, "dna", up=60, down=30)


def _hits(s, d):
    h = I.overlap_join(peaks(s, d), genes(s, d))
    return h.withColumns({"gene": F.col("b_gene"), "class": F.col("b_class"), "feature": F.col("b_class"), "distance": I.distance_to(h, F.floor((F.col("start") + F.col("end")) / 2))})


def _thick(s, d, known=None):
    t = transcripts(s, d, known)
    quarter = F.floor((F.col("end") - F.col("start")) / 4)
    return t.withColumns({"thick_start": F.col("start") + quarter, "thick_end": F.col("end") - quarter})


_THICK = f"""{PEAKS}, {TRANSCRIPTS}, t AS (SELECT *, start + ("end" - start) // 4 AS a, "end" - ("end" - start) // 4 AS b FROM transcripts)"""

QUERIES = {
    "annotate_peaks_rna": (_rna, f"{_RNA} SELECT * FROM anno"),
    "annotate_peaks_dna": (_dna, f"{_DNA} SELECT * FROM anno"),
    "feature_stats": (
        lambda s, d: A.feature_stats(_rna(s, d)),
        f"{_RNA} SELECT coalesce(class, 'intergenic') AS category, count(*) AS n, 100 * count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS percent FROM anno GROUP BY 1",
    ),
    "place_stats": (
        lambda s, d: A.feature_stats(_dna(s, d), "place"),
        f"{_DNA} SELECT place AS category, count(*) AS n, 100 * count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS percent FROM anno GROUP BY 1",
    ),
    "annotation_report": (
        lambda s, d: A.to_report(_rna(s, d).select("id", "gene", "overlap"), {"gene": "na", "overlap": -1}),
        f"{_RNA} SELECT id, coalesce(gene, 'na') AS gene, coalesce(CAST(overlap AS VARCHAR), '-1') AS overlap FROM anno",
    ),
    "best_transcript": (
        lambda s, d: A.best_transcript(_hits(s, d), CLASSES).select("id", "gene", "b_id", "overlap"),
        f"{_AB} SELECT p.id, g.gene, g.id AS b_id, {_BP} AS overlap FROM peaks p JOIN genes g ON {_PAIRS} QUALIFY row_number() OVER (PARTITION BY p.id, g.gene ORDER BY {_RANK('g.class', CLASSES)}, {_BP} DESC, g.id) = 1",
    ),
    "best_gene_dna": (
        lambda s, d: A.best_gene(_hits(s, d), CLASSES, "dna").select("id", "gene", "b_id", "distance"),
        f"{_AB} SELECT p.id, g.gene, g.id AS b_id, {_DIST} AS distance FROM peaks p JOIN genes g ON {_PAIRS} QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY abs({_DIST}), {_RANK('g.class', CLASSES)}, g.gene, g.id) = 1",
    ),
    "best_extra": (
        lambda s, d: A.best_extra(_hits(s, d), CLASSES).select("id", "gene", "b_id"),
        f"""{_AB}, l AS (SELECT p.id, g.gene, g.class, g.id AS b_id, {_BP} AS bp FROM peaks p JOIN genes g ON {_PAIRS} QUALIFY row_number() OVER (PARTITION BY p.id, g.gene ORDER BY g.start DESC, g.id DESC) = 1)
        SELECT id, gene, b_id FROM l QUALIFY row_number() OVER (PARTITION BY id ORDER BY {_RANK('class', CLASSES)}, bp DESC, gene, b_id) = 1""",
    ),
    "gene_span": (
        lambda s, d: A.gene_span(genes(s, d)),
        f'WITH {GENES} SELECT gene, chrom, strand, min(start) AS start, max("end") AS "end", count(*) AS n_tx FROM genes GROUP BY ALL',
    ),
    "longest_isoform": (
        lambda s, d: A.longest_isoform(transcripts(s, d), "qname", "exon").select("qname", "id", "size"),
        f"""WITH {PEAKS}, {TRANSCRIPTS}, k AS (SELECT qname, id, unnest(blocks) AS b FROM transcripts), z AS (SELECT qname, id, CAST(sum(b."end" - b.start) AS BIGINT) AS size FROM k GROUP BY ALL)
        SELECT qname, id, size FROM z QUALIFY row_number() OVER (PARTITION BY qname ORDER BY size DESC, id) = 1""",
    ),
    "decode_transcript": (
        lambda s, d: A.decode_transcript(_thick(s, d)).select("id", "feature", "number", "start", "end"),
        f"""WITH {_THICK}, e AS (SELECT id, strand, a, b, blocks, unnest(range(1, len(blocks) + 1)) AS i FROM t), x AS (SELECT id, strand, a, b, i, len(blocks) AS n, blocks[i].start AS s, blocks[i]."end" AS e, blocks[i + 1].start AS nxt FROM e),
        f AS (SELECT id, strand, 'exon' AS feature, i, s AS start, e AS "end" FROM x UNION ALL SELECT id, strand, 'intron', i, e, nxt FROM x WHERE i < n
        UNION ALL SELECT id, strand, 'cds', i, greatest(s, a), least(e, b) FROM x WHERE b > a AND greatest(s, a) < least(e, b)
        UNION ALL SELECT id, strand, CASE WHEN strand = '-' THEN '3utr' ELSE '5utr' END, i, s, least(e, a) FROM x WHERE b > a AND s < least(e, a)
        UNION ALL SELECT id, strand, CASE WHEN strand = '-' THEN '5utr' ELSE '3utr' END, i, greatest(s, b), e FROM x WHERE b > a AND greatest(s, b) < e)
        SELECT id, feature, CAST(row_number() OVER (PARTITION BY id, feature ORDER BY CASE WHEN strand = '-' THEN -i ELSE i END) AS INT) AS number, start, "end" FROM f""",
    ),
    "append_gene_annotation": (
        lambda s, d: A.append_gene_annotation(peaks(s, d).select((F.col("id") % 2500).alias("id"), "score"), genes(s, d).select(F.col("id").cast("string").alias("gene_id"), "gene", "class")),
        f"{_AB} SELECT p.id % 2500 AS id, gene, class, score FROM peaks p LEFT JOIN genes g ON g.id = p.id % 2500",
    ),
    "recenter": (
        lambda s, d: A.recenter(transcripts(s, d), 25).select("id", "center", "start", "end"),
        f"""WITH {PEAKS}, {TRANSCRIPTS}, e AS (SELECT id, blocks, unnest(range(1, len(blocks) + 1)) AS i FROM transcripts), x AS (SELECT id, i, blocks[i].start AS s, blocks[i]."end" AS e FROM e),
        y AS (SELECT *, sum(e - s) OVER (PARTITION BY id) // 2 AS half, coalesce(sum(e - s) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen FROM x),
        z AS (SELECT id, CAST(s + half - seen AS BIGINT) AS center FROM y WHERE half >= seen AND half < seen + e - s) SELECT id, center, greatest(center - 25, 0) AS start, center + 26 AS "end" FROM z""",
    ),
    "metagene_bins": (
        lambda s, d: A.metagene_bins(I.overlap_join(peaks(s, d), genes(s, d)), 10),
        f"""{_AB}, h AS (SELECT g."end" - g.start AS size, greatest(p.start, g.start) - g.start AS lo, least(p."end", g."end") - g.start AS hi, g.strand FROM peaks p JOIN genes g ON {_PAIRS}),
        k AS (SELECT size, CASE WHEN strand = '-' THEN size - hi ELSE lo END AS a, CASE WHEN strand = '-' THEN size - lo ELSE hi END AS b FROM h)
        SELECT bin, count(*) AS n FROM (SELECT unnest(range(a * 10 // size, least((b - 1) * 10 // size, 9) + 1)) AS bin FROM k) GROUP BY bin""",
    ),
    "segment_genes": (
        lambda s, d: A.segment_genes(I.merge_intervals(peaks(s, d), strand=True).withColumn("id", F.concat_ws(":", "chrom", "strand", "start")), genes(s, d)).select("id", "b_id", "kind", "left_over", "right_over", "fraction"),
        f"""{_AB}, f AS (SELECT *, CASE WHEN start <= max("end") OVER (PARTITION BY chrom, strand ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM peaks),
        i AS (SELECT *, sum(fresh) OVER (PARTITION BY chrom, strand ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM f), m AS (SELECT chrom, strand, min(start) AS start, max("end") AS "end" FROM i GROUP BY chrom, strand, island)
        SELECT p.chrom || ':' || p.strand || ':' || CAST(p.start AS VARCHAR) AS id, g.id AS b_id, CASE WHEN g.start >= p.start AND g."end" <= p."end" THEN 'whole' WHEN g.start < p.start AND g."end" > p."end" THEN 'overlay' WHEN g.start < p.start THEN 'left' ELSE 'right' END AS kind,
        greatest(p.start - g.start, 0) AS left_over, greatest(g."end" - p."end", 0) AS right_over, {_BP} / CAST(g."end" - g.start AS DOUBLE) AS fraction FROM m p JOIN genes g ON {_PAIRS}""",
    ),
}

"""Registered queries of the interval operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals as I
from .fixtures import GENES, PEAKS, SIZES, TRANSCRIPTS, genes, peaks, sizes, transcripts, windows

_AB = f"WITH {PEAKS}, {GENES}"
_PAIRS = 'p.chrom = g.chrom AND p.start < g."end" AND g.start < p."end"'
_BP = 'least(p."end", g."end") - greatest(p.start, g.start)'
_MERGE = lambda src, d=0, part="chrom": f"""(SELECT {part}, min(start) AS start, max("end") AS "end", count(*) AS n FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY {part} ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM (
    SELECT *, CASE WHEN start <= max("end") OVER (PARTITION BY {part} ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {d} THEN 0 ELSE 1 END AS fresh FROM {src})) GROUP BY {part}, island)"""  # noqa: E731


def _ab(f):
    return lambda spark, d: f(peaks(spark, d), genes(spark, d))


QUERIES = {
    "overlap_join": (
        _ab(lambda a, b: I.overlap_join(a, b).select("id", "b_id", "overlap")),
        f"{_AB} SELECT p.id, g.id AS b_id, {_BP} AS overlap FROM peaks p JOIN genes g ON {_PAIRS}",
    ),
    "overlap_join_reciprocal": (
        _ab(lambda a, b: I.overlap_join(a, b, frac_a=0.25, frac_b=0.25).select("id", "b_id")),
        f'{_AB} SELECT p.id, g.id AS b_id FROM peaks p JOIN genes g ON {_PAIRS} AND {_BP} >= 0.25 * (p."end" - p.start) AND {_BP} >= 0.25 * (g."end" - g.start)',
    ),
    "overlap_join_either": (
        _ab(lambda a, b: I.overlap_join(a, b, frac_a=0.5, frac_b=0.5, either=True).select("id", "b_id")),
        f'{_AB} SELECT p.id, g.id AS b_id FROM peaks p JOIN genes g ON {_PAIRS} AND ({_BP} >= 0.5 * (p."end" - p.start) OR {_BP} >= 0.5 * (g."end" - g.start))',
    ),
    "overlap_join_same_strand": (
        _ab(lambda a, b: I.overlap_join(a, b, strand="same").select("id", "b_id")),
        f"{_AB} SELECT p.id, g.id AS b_id FROM peaks p JOIN genes g ON {_PAIRS} AND p.strand = g.strand",
    ),
    "overlap_join_opposite_strand": (
        _ab(lambda a, b: I.overlap_join(a, b, strand="opposite").select("id", "b_id")),
        f"{_AB} SELECT p.id, g.id AS b_id FROM peaks p JOIN genes g ON {_PAIRS} AND p.strand <> g.strand",
    ),
    "intersect": (
        _ab(lambda a, b: I.intersect(a, b).select("id", "b_id", "chrom", "start", "end")),
        f'{_AB} SELECT p.id, g.id AS b_id, p.chrom, greatest(p.start, g.start) AS start, least(p."end", g."end") AS "end" FROM peaks p JOIN genes g ON {_PAIRS}',
    ),
    "overlap_semi": (
        _ab(lambda a, b: I.overlap_semi(a, b).select("id", "chrom", "start", "end")),
        f'{_AB} SELECT id, chrom, start, "end" FROM peaks p WHERE EXISTS (SELECT 1 FROM genes g WHERE {_PAIRS})',
    ),
    "overlap_anti": (
        _ab(lambda a, b: I.overlap_anti(a, b).select("id", "chrom", "start", "end")),
        f'{_AB} SELECT id, chrom, start, "end" FROM peaks p WHERE NOT EXISTS (SELECT 1 FROM genes g WHERE {_PAIRS})',
    ),
    "overlap_count": (
        _ab(lambda a, b: I.overlap_count(a, b).select("id", "hits")),
        f"{_AB} SELECT p.id, count(g.id) AS hits FROM peaks p LEFT JOIN genes g ON {_PAIRS} GROUP BY p.id",
    ),
    "element_of": (
        _ab(lambda a, b: I.element_of(a, b, min_frac=1.0).select("id")),
        f'{_AB} SELECT DISTINCT p.id FROM peaks p JOIN genes g ON {_PAIRS} AND {_BP} >= p."end" - p.start',
    ),
    "not_element_of": (
        _ab(lambda a, b: I.element_of(a, b, min_bp=10, negate=True).select("id")),
        f"{_AB} SELECT id FROM peaks p WHERE NOT EXISTS (SELECT 1 FROM genes g WHERE {_PAIRS} AND {_BP} >= 10)",
    ),
    "contained_join": (
        _ab(lambda a, b: I.overlap_join(a, b, contained=True).select("id", "b_id")),
        f'{_AB} SELECT p.id, g.id AS b_id FROM peaks p JOIN genes g ON {_PAIRS} AND p.start >= g.start AND p."end" <= g."end"',
    ),
    "nway_intersect": (
        lambda s, d: I.nway_intersect([peaks(s, d).filter("strand = '-'"), genes(s, d), genes(s, d).filter("strand = '+'")]),
        f"""{_AB}, x AS (SELECT DISTINCT p.chrom, greatest(p.start, g.start) AS start, least(p."end", g."end") AS "end" FROM peaks p JOIN genes g ON {_PAIRS} WHERE p.strand = '-')
        SELECT DISTINCT p.chrom, greatest(p.start, g.start) AS start, least(p."end", g."end") AS "end" FROM x p JOIN genes g ON {_PAIRS} WHERE g.strand = '+'""",
    ),
    "merge_intervals": (
        lambda s, d: I.merge_intervals(peaks(s, d), aggs=[F.max("score").alias("top")]),
        f"WITH {PEAKS} SELECT m.*, t.top FROM {_MERGE('peaks')} m JOIN (SELECT m.chrom, m.start, max(p.score) AS top FROM {_MERGE('peaks')} m JOIN peaks p ON p.chrom = m.chrom AND p.start >= m.start AND p.\"end\" <= m.\"end\" GROUP BY ALL) t USING (chrom, start)",
    ),
    "merge_intervals_stranded": (
        lambda s, d: I.merge_intervals(genes(s, d), distance=20, strand=True),
        f"WITH {GENES} SELECT * FROM {_MERGE('genes', 20, 'chrom, strand')}",
    ),
    "genome_coverage": (
        lambda s, d: I.genome_coverage(peaks(s, d)),
        f"""WITH {PEAKS}, e AS (SELECT chrom, pos AS start, sum(d) AS d FROM (SELECT chrom, start AS pos, 1 AS d FROM peaks UNION ALL SELECT chrom, "end", -1 FROM peaks) GROUP BY ALL HAVING sum(d) <> 0)
        SELECT * FROM (SELECT chrom, start, lead(start) OVER w AS "end", CAST(sum(d) OVER (PARTITION BY chrom ORDER BY start ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth FROM e WINDOW w AS (PARTITION BY chrom ORDER BY start)) WHERE depth > 0""",
    ),
    "subtract": (
        lambda s, d: I.subtract(genes(s, d), peaks(s, d)).select("id", "chrom", "start", "end"),
        f"""{_AB}, m AS {_MERGE('peaks')}, h AS (SELECT p.id, p.chrom, p.start AS a0, p."end" AS a1, greatest(p.start, g.start) AS s, least(p."end", g."end") AS e FROM genes p JOIN m g ON {_PAIRS}),
        k AS (SELECT *, coalesce(lag(e) OVER (PARTITION BY id ORDER BY s), a0) AS g0, lead(s) OVER (PARTITION BY id ORDER BY s) AS nxt FROM h)
        SELECT id, chrom, g0 AS start, s AS "end" FROM k WHERE s > g0 UNION ALL SELECT id, chrom, e, a1 FROM k WHERE nxt IS NULL AND e < a1
        UNION ALL SELECT id, chrom, start, "end" FROM genes WHERE id NOT IN (SELECT id FROM h)""",
    ),
    "closest": (
        lambda s, d: I.closest(genes(s, d), peaks(s, d)).select("id", "left_end", "left_distance", "right_start", "right_distance"),
        f"""{_AB}, l AS (SELECT chrom, "end" AS v FROM peaks GROUP BY ALL), r AS (SELECT chrom, start AS v FROM peaks GROUP BY ALL)
        SELECT x.id, x.v AS left_end, x.start - x.v AS left_distance, y.v AS right_start, y.v - x."end" AS right_distance FROM
        (SELECT g.id, g.start, g."end", l.v FROM genes g ASOF LEFT JOIN l ON g.chrom = l.chrom AND g.start >= l.v) x JOIN
        (SELECT g.id, r.v FROM genes g ASOF LEFT JOIN r ON g.chrom = r.chrom AND g."end" <= r.v) y USING (id)""",
    ),
    "window_aggregate": (
        lambda s, d: I.window_aggregate(genes(s, d), peaks(s, d), "score", reach=50).select("id", "n", "total", "least", "most", "most_at"),
        f"""{_AB} SELECT g.id, count(p.id) AS n, CAST(coalesce(sum(p.score), 0) AS BIGINT) AS total, min(p.score) AS least, max(p.score) AS most, arg_max(p.start, struct_pack(a := p.score, b := -p.start)) AS most_at
        FROM genes g LEFT JOIN peaks p ON p.chrom = g.chrom AND p.start < g."end" + 50 AND greatest(g.start - 50, 0) < p."end" GROUP BY g.id""",
    ),
    "tile": (
        lambda s, d: I.tile(sizes(s, d), 150, 100),
        f"""{_AB}, {SIZES} SELECT chrom, start, least(start + 150, length) AS "end" FROM (SELECT chrom, length, unnest(range(0, length, 100)) AS start FROM sizes)""",
    ),
    "tile_counts": (
        lambda s, d: windows(s, d, 500).select("chrom", "start", "hits"),
        f"""{_AB}, {SIZES}, t AS (SELECT chrom, start, least(start + 500, length) AS "end" FROM (SELECT chrom, length, unnest(range(0, length, 500)) AS start FROM sizes))
        SELECT g.chrom, g.start, count(p.id) AS hits FROM t g LEFT JOIN peaks p ON {_PAIRS} GROUP BY ALL""",
    ),
    "slop_stranded": (
        lambda s, d: I.slop(peaks(s, d), 2000, 500, stranded=True, sizes=sizes(s, d)).select("id", "start", "end"),
        f"""{_AB}, {SIZES} SELECT id, greatest(start - CASE WHEN strand = '-' THEN 500 ELSE 2000 END, 0) AS start, least("end" + CASE WHEN strand = '-' THEN 2000 ELSE 500 END, length) AS "end" FROM peaks JOIN sizes USING (chrom)""",
    ),
    "shift": (
        lambda s, d: I.shift(peaks(s, d), 4, -5).select("id", "start", "end"),
        f"""WITH {PEAKS} SELECT id, greatest(start + CASE WHEN strand = '-' THEN -5 ELSE 4 END, 0) AS start, greatest("end" + CASE WHEN strand = '-' THEN -5 ELSE 4 END, 1) AS "end" FROM peaks""",
    ),
    "gene_ends": (
        lambda s, d: I.tss(genes(s, d)).select("id", F.col("start").alias("tss")).join(I.tts(genes(s, d)).select("id", F.col("start").alias("tts")), "id"),
        f"""WITH {GENES} SELECT id, CASE WHEN strand = '-' THEN "end" - 1 ELSE start END AS tss, CASE WHEN strand = '-' THEN start ELSE "end" - 1 END AS tts FROM genes""",
    ),
    "bed12_to_bed6": (
        lambda s, d: I.bed12_to_bed6(transcripts(s, d)).select("id", "block", "start", "end"),
        f"""WITH {PEAKS}, {TRANSCRIPTS} SELECT id, CAST(i - 1 AS INT) AS block, blocks[i].start AS start, blocks[i]."end" AS "end" FROM (SELECT id, blocks, unnest(range(1, len(blocks) + 1)) AS i FROM transcripts)""",
    ),
    "exons_to_bed12": (
        lambda s, d: I.exons_to_bed12(peaks(s, d), ["qname", "chrom"]).select("qname", "chrom", "start", "end", F.size("blocks").alias("n"), F.array_join(F.transform("blocks", lambda b: (b["end"] - b["start"]).cast("string")), ",").alias("sizes")),
        f"""WITH {PEAKS} SELECT qname, chrom, min(start) AS start, max("end") AS "end", CAST(count(*) AS INT) AS n, string_agg(CAST("end" - start AS VARCHAR), ',' ORDER BY start, "end") AS sizes FROM peaks GROUP BY ALL""",
    ),
    "block_overlap": (
        lambda s, d: I.block_overlap(transcripts(s, d), genes(s, d).withColumn("id", F.col("id").cast("string")).withColumn("blocks", F.array(F.struct("start", "end")))),
        f"""{_AB}, {TRANSCRIPTS}, x AS (SELECT id, chrom, unnest(blocks) AS k FROM transcripts), p AS (SELECT id, chrom, k.start AS start, k."end" AS "end" FROM x)
        SELECT p.id, CAST(g.id AS VARCHAR) AS b_id, CAST(sum({_BP}) AS BIGINT) AS overlap FROM p JOIN genes g ON {_PAIRS} GROUP BY ALL""",
    ),
    "widen_short": (
        lambda s, d: I.widen_short(peaks(s, d), 31).select("id", "start", "end"),
        f"""WITH {PEAKS} SELECT id, CASE WHEN "end" - start < 31 THEN greatest(start - (31 - ("end" - start)) // 2, 0) ELSE start END AS start,
        CASE WHEN "end" - start < 31 THEN "end" + (31 - ("end" - start)) - (31 - ("end" - start)) // 2 ELSE "end" END AS "end" FROM peaks""",
    ),
    "overlap_type": (
        _ab(lambda a, b: I.overlap_join(a, b).select("id", "b_id", I.overlap_type(F.col("b_start"), F.col("b_end"), F.col("start"), F.col("end")).alias("kind"))),
        f"""{_AB} SELECT p.id, g.id AS b_id, CASE WHEN p.start >= g.start AND p."end" <= g."end" THEN 'whole' WHEN p.start < g.start AND p."end" > g."end" THEN 'overlay' WHEN p.start < g.start THEN 'left' ELSE 'right' END AS kind FROM peaks p JOIN genes g ON {_PAIRS}""",
    ),
    "distance_class": (
        _ab(lambda a, b: _distances(a, b)),
        f"""{_AB}, x AS (SELECT p.id, g.id AS b_id, (p.start + p."end") // 2 AS c, CASE WHEN g.strand = '-' THEN g."end" - 1 - (p.start + p."end") // 2 ELSE (p.start + p."end") // 2 - g.start END AS d
        FROM peaks p JOIN (SELECT id, chrom, strand, start AS start, "end", greatest(CASE WHEN strand = '-' THEN "end" - 1 ELSE start END - 100, 0) AS w0, CASE WHEN strand = '-' THEN "end" - 1 ELSE start END + 101 AS w1 FROM genes) g ON p.chrom = g.chrom AND p.start < w1 AND w0 < p."end")
        SELECT id, b_id, d AS distance, CASE WHEN abs(d) <= 1000 THEN 'TSS (<=1kb)' ELSE 'intergenic' END AS class FROM x""",
    ),
    "jaccard": (
        _ab(lambda a, b: I.jaccard(a, b)),
        f"""{_AB}, x AS {_MERGE('peaks')}, y AS {_MERGE('genes')}, s AS (SELECT CAST(sum({_BP}) AS BIGINT) AS shared FROM x p JOIN y g ON {_PAIRS}),
        t AS (SELECT CAST(sum("end" - start) AS BIGINT) AS total FROM (SELECT start, "end" FROM x UNION ALL SELECT start, "end" FROM y)) SELECT shared, total - shared AS united, shared / CAST(total - shared AS DOUBLE) AS jaccard FROM s, t""",
    ),
    "overlap_groups": (
        lambda s, d: I.overlap_groups(genes(s, d)).select("id", "group_size"),
        f"""WITH {GENES}, f AS (SELECT *, CASE WHEN start < max("end") OVER (PARTITION BY chrom ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM genes),
        i AS (SELECT *, sum(fresh) OVER (PARTITION BY chrom ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM f) SELECT id, count(*) OVER (PARTITION BY chrom, island) AS group_size FROM i""",
    ),
}


def _distances(a, b):
    ends = I.slop(I.tss(b.select("id", "chrom", "start", "end", "strand", F.col("start").alias("g0"), F.col("end").alias("g1"))), 100, 100)
    hits = I.overlap_join(a, ends).withColumns({"b_start": F.col("b_g0"), "b_end": F.col("b_g1"), "center": F.floor((F.col("start") + F.col("end")) / 2)})
    d = I.distance_to(hits, F.col("center"))
    return hits.select("id", "b_id", d.alias("distance"), I.distance_class(d, [1]).alias("class"))

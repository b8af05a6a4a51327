"""Registered queries of peak placement and of rearranged cycles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import circles as C
from ..operators import intervals as I
from ..operators import pipelines as L
from ..operators import placement as P
from ..operators import signal as S
from ..operators.stored import written
from .fixtures import GENES, PEAKS, SIZES, genes, peaks, sizes
from .interval_queries import _MERGE

_CLASSES = ["circular", "linear", "rearranged"]


def _steps(s, d):
    """Orders as cycles, their peaks as steps over three segments on one chromosome (even cycles) or several; some first steps are open ends."""
    segment = F.floor(F.col("start") / 37) % 3 + 1
    p = peaks(s, d).withColumn("seg", F.when((F.col("id") % 10 == 1) & (F.col("qname") % 5 == 0), 0).otherwise(F.when(F.col("qname") % 3 == 0, F.col("id") % 10).otherwise(segment)))
    chrom = F.when(F.col("qname") % 2 == 0, F.lit("c1")).otherwise(F.concat(F.lit("c"), (F.col("seg") % 4).cast("string")))
    return p.select(F.col("qname").alias("cycle"), F.col("id").alias("ord"), F.col("seg").cast("string").alias("segment"), chrom.alias("chrom"), "strand", (F.col("qname") % 11 == 0).alias("cyclic"))


_STEPS = f"""{PEAKS}, st AS (SELECT qname AS cycle, id AS ord, strand, qname % 11 = 0 AS cyclic, CASE WHEN id % 10 = 1 AND qname % 5 = 0 THEN 0 WHEN qname % 3 = 0 THEN id % 10 ELSE start // 37 % 3 + 1 END AS seg FROM peaks),
    steps AS (SELECT *, CASE WHEN cycle % 2 = 0 THEN 'c1' ELSE 'c' || (seg % 4) END AS chrom FROM st)"""


def _segments(s, d, known=None):
    """Orders as cycles of a sample and a class, their peaks widened to segments; ``known`` are the peaks if they are there already."""
    kind = F.element_at(F.array(*map(F.lit, _CLASSES)), (F.col("qname") % 3 + 1).cast("int"))
    return (peaks(s, d) if known is None else known).select(
        F.concat(F.lit("s"), (F.col("qname") % 7).cast("string")).alias("sample"), F.col("qname").alias("cycle"), F.col("id").alias("ord"), kind.alias("class"), "chrom", "start", (F.col("end") + 100).alias("end"), F.col("id").alias("gene"),
    )


_SEGMENTS = f"""{PEAKS}, {GENES}, seg AS (SELECT 's' || (qname % 7) AS sample, qname AS cycle, id AS ord, ['circular', 'linear', 'rearranged'][CAST(qname % 3 + 1 AS INT)] AS class, chrom, start, "end" + 100 AS "end", id FROM peaks)"""


def _letters(s, d):
    return _segments(s, d).withColumn("seq", F.repeat(F.concat(F.lit("ACGT"), F.col("ord").cast("string")), 3))


def _hotspots(s, d):
    return I.merge_intervals(genes(s, d).select("chrom", "start", "end")).select("chrom", "start", "end").withColumn("id", F.concat_ws(":", "chrom", "start"))


def _placed(s, d, centred=False):
    density = written(S.tag_density(S.read_cuts(peaks(s, d)).select("chrom", "start"), sizes(s, d)), "density")
    top = S.summits(density, ["chrom"], "start", "density").withColumn("score", F.col("density"))
    if centred:
        return P.place_on_summits(top, _hotspots(s, d), density)
    return P.place_in_hotspots(top, _hotspots(s, d), density, sizes(s, d))


_IN = "p.chrom = s.chrom AND p.start >= s.start AND p.\"end\" <= s.\"end\" AND p.start < p.\"end\""
_ROLL = f"""{_SEGMENTS}, cy AS (SELECT sample, class, cycle, sum("end" - start) AS length FROM seg GROUP BY ALL), h AS MATERIALIZED (SELECT DISTINCT s.cycle, p.id, p.strand AS factor FROM peaks p JOIN seg s ON {_IN}),
    g AS (SELECT *, 'k' || (id % 3) AS kind FROM genes), met AS MATERIALIZED (SELECT DISTINCT p.id, g.kind AS repeat FROM peaks p JOIN g ON p.chrom = g.chrom AND p.start < g."end" AND g.start < p."end" AND p.start < p."end" AND g.start < g."end"),
    per AS MATERIALIZED (SELECT factor, class, cycle, any_value(length) AS length, count(*) AS n FROM h JOIN cy USING (cycle) GROUP BY ALL), a AS MATERIALIZED (SELECT factor, class, count(*) AS bound, CAST(sum(n) AS BIGINT) AS peaks, sum(length) AS bp FROM per GROUP BY ALL),
    m AS MATERIALIZED (SELECT factor, class, repeat, count(*) AS met FROM h JOIN cy USING (cycle) JOIN met USING (id) GROUP BY ALL), t AS MATERIALIZED (SELECT class, count(*) AS cycles FROM cy GROUP BY class),
    roll AS (SELECT factor, class, repeat, cycles, bound, bound * 100.0::DOUBLE / cycles AS bound_percent, peaks, coalesce(met, 0) * 100.0::DOUBLE / peaks AS repeat_percent, peaks * 1000.0::DOUBLE / bp * bound / cycles AS density
    FROM a JOIN t USING (class) JOIN (SELECT DISTINCT kind AS repeat FROM g) ON true LEFT JOIN m USING (factor, class, repeat))"""
_DIGITS = lambda *names: {c: F.round(c, 6) for c in names}


def _rolled(s, d):
    p = written(peaks(s, d).select("id", "chrom", "start", "end", "strand", "qname"), "peaks")
    return C.factor_class_rollup(_segments(s, d, p), p.withColumn("factor", F.col("strand")), genes(s, d).withColumn("kind", F.concat(F.lit("k"), (F.col("id") % 3).cast("string"))))


def _chain(s, d):
    """Peaks as reads, genes as sites whose FDR comes from their number."""
    sites = genes(s, d).select("chrom", "start", "end", (F.col("id") % 10 / 100).alias("fdr"))
    return L.hotspot_chain(peaks(s, d).select("chrom", "start", "end", "strand"), sites, sizes(s, d), 0.05, 50, 30)


def _good(at):
    """SQL of the cut counts at ``at`` without bad spots."""
    return f"""c AS (SELECT chrom, {at} AS start, count(*) AS n FROM peaks GROUP BY ALL), w AS (SELECT *, sum(n) OVER (PARTITION BY chrom ORDER BY start RANGE BETWEEN 25 PRECEDING AND 25 FOLLOWING) AS a, sum(n) OVER (PARTITION BY chrom ORDER BY start RANGE BETWEEN 125 PRECEDING AND 125 FOLLOWING) AS b FROM c),
    good AS (SELECT chrom, start, n FROM w WHERE NOT (a >= 5 AND a / (b + 0.01::DOUBLE) >= 0.8)), i AS (SELECT chrom, n, unnest(range(CAST(greatest(ceil((start - 84) / 20.0::DOUBLE), 0) AS BIGINT), CAST(floor((start + 65) / 20.0::DOUBLE) AS BIGINT) + 1)) AS i FROM good),
    den AS (SELECT chrom, i * 20 AS start, least(i * 20 + 20, length) AS "end", CAST(sum(n) AS BIGINT) AS density FROM i JOIN sizes USING (chrom) WHERE i * 20 < length GROUP BY chrom, i, length)"""


_CUT = """CASE WHEN strand = '-' THEN "end" ELSE start END"""
_FIVE = """CASE WHEN strand = '-' THEN "end" - 1 ELSE start END"""

QUERIES = {
    "hotspot_density": (
        lambda s, d: L.hotspot_density(I.tss(peaks(s, d)), sizes(s, d), genes(s, d)),
        f"""WITH {PEAKS}, {GENES}, {SIZES}, {_good(_FIVE)}, h AS (SELECT g.id, g.chrom, d.density, d.start AS p0, row_number() OVER (PARTITION BY g.id ORDER BY d.density DESC, d.start) AS k FROM genes g JOIN den d ON g.chrom = d.chrom AND g.start < d."end" AND d.start < g."end" AND g.start < g."end")
        SELECT id, chrom, density, greatest(p0 - 75, 0) AS start, p0 + 76 AS "end" FROM h WHERE k = 1""",
    ),
    "hotspot_chain": (lambda s, d: _chain(s, d)["peaks"], None),
    "hotspot_chain_density": (lambda s, d: _chain(s, d)["density"], f"WITH {PEAKS}, {GENES}, {SIZES}, {_good(_CUT)} SELECT * FROM den"),
    "hotspot_chain_spot": (
        lambda s, d: _chain(s, d)["spot"].withColumn("spot", F.round("spot", 6)),
        f"""WITH RECURSIVE {PEAKS}, {GENES}, {SIZES}, {_good(_CUT)}, hot AS (SELECT * FROM genes WHERE id % 10 <= 5), m AS {_MERGE('hot')}, k AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY start) AS k FROM m),
        g AS (SELECT chrom, k, start, "end", CAST(NULL AS BIGINT) AS x0, CAST(NULL AS BIGINT) AS x1 FROM k WHERE k = 1
            UNION ALL SELECT k.chrom, k.k, CASE WHEN k.start - g."end" <= 30 AND least(g."end" - g.start, k."end" - k.start) < 50 THEN g.start ELSE k.start END, k."end",
            CASE WHEN k.start - g."end" <= 30 AND least(g."end" - g.start, k."end" - k.start) < 50 THEN NULL ELSE g.start END, CASE WHEN k.start - g."end" <= 30 AND least(g."end" - g.start, k."end" - k.start) < 50 THEN NULL ELSE g."end" END
            FROM g JOIN k ON k.chrom = g.chrom AND k.k = g.k + 1),
        z AS (SELECT chrom, x0 AS start, x1 AS "end" FROM g WHERE x1 - x0 >= 50 UNION ALL SELECT chrom, arg_max(start, k), arg_max("end", k) FROM g GROUP BY chrom HAVING arg_max("end", k) - arg_max(start, k) >= 50),
        t AS (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total, CAST(coalesce(sum(n) FILTER (EXISTS (SELECT 1 FROM z WHERE z.chrom = good.chrom AND z.start <= good.start AND good.start < z."end")), 0) AS BIGINT) AS inside FROM good)
        SELECT inside, total, round(inside / CAST(total AS DOUBLE), 6) AS spot FROM t""",
    ),
    "place_in_hotspots": (lambda s, d: _placed(s, d), None),
    "place_on_summits": (lambda s, d: _placed(s, d, True).drop("id"), None),
    "cycle_structures": (
        lambda s, d: C.cycle_structures(_steps(s, d)),
        f"""WITH {_STEPS}, o AS (SELECT *, row_number() OVER (PARTITION BY cycle ORDER BY ord) AS pos FROM steps), t AS (SELECT *, pos - lag(pos) OVER (PARTITION BY cycle, seg ORDER BY pos) AS gap FROM o WHERE seg <> 0),
        z AS (SELECT cycle, seg, count(*) AS n, count(*) FILTER (gap = 1) AS l, count(*) FILTER (gap > 1) AS k, count(DISTINCT strand) AS st FROM t GROUP BY ALL),
        x AS (SELECT cycle, count(*) FILTER (n > 1 AND l > 0 AND k = 0 AND st = 1) AS a, count(*) FILTER (n > 1 AND l > 0 AND k = 0 AND st > 1) AS b, count(*) FILTER (n > 1 AND k > 0 AND st = 1) AS c, count(*) FILTER (n > 1 AND k > 0 AND st > 1) AS d FROM z GROUP BY cycle),
        y AS (SELECT cycle, count(*) AS n, count(DISTINCT seg) AS u, count(DISTINCT chrom) AS c, count(DISTINCT strand) AS st, bool_or(cyclic) AS cyc, list(seg ORDER BY pos) AS ids, list(strand ORDER BY pos) AS ss FROM t GROUP BY cycle)
        SELECT cycle, n AS segments, u AS distinct_segments, y.c AS chroms, CASE WHEN cyc THEN 'circular' WHEN n = 1 THEN 'single' WHEN y.c > 2 AND st > 1 THEN 'chromoplexy_inversion' WHEN y.c > 2 THEN 'chromoplexy'
        WHEN n = u AND y.c > 1 THEN 'translocation' WHEN n = u AND st = 1 THEN 'deletion' WHEN n = u AND u = 3 AND ss[1] = ss[3] THEN 'reciprocal_inversion' WHEN n = u AND u < 5 THEN 'inversion' WHEN n = u THEN 'chromothripsis'
        WHEN y.c = 1 AND u = 2 AND n = 3 AND ids[1] = ids[3] AND ids[1] <> ids[2] AND ss[1] <> ss[3] THEN 'foldback_inversion' WHEN y.c = 1 AND u = 1 AND n = 2 THEN 'self_inversion'
        WHEN y.c = 1 AND (a, b, x.c, d) = (1, 0, 0, 0) THEN 'tandem_duplication' WHEN (a, b, x.c, d) = (0, 0, 1, 0) THEN 'local_distant_cluster' WHEN y.c > 1 THEN 'complexity' WHEN x.c > 1 THEN 'local_n_jump'
        WHEN a = 0 AND b = 0 AND x.c = 0 AND d > 0 THEN 'jump_inversion' WHEN a = 0 AND b > 0 AND x.c = 0 AND d = 0 THEN 'tandem_duplication_inversion' ELSE 'other' END AS structure FROM y JOIN x USING (cycle)""",
    ),
    "cycle_junctions": (
        lambda s, d: C.cycle_junctions(_letters(s, d), 5),
        f"""WITH {_SEGMENTS}, q AS (SELECT *, repeat('ACGT' || ord, 3) AS seq, row_number() OVER w AS k, count(*) OVER (PARTITION BY cycle) AS n, CAST(sum("end" - start) OVER w AS BIGINT) AS upto FROM seg WINDOW w AS (PARTITION BY cycle ORDER BY ord)),
        b AS (SELECT q.*, q.class || '|' || q.cycle || '|' AS pre, x.seq AS next, f.seq AS last FROM q LEFT JOIN q x ON q.cycle = x.cycle AND x.k = q.k + 1 JOIN q f ON q.cycle = f.cycle AND f.k = f.n)
        SELECT cycle, upto AS start, upto + 1 AS "end", pre || k || '|' || (k + 1) AS name, CASE WHEN k < n THEN right(seq, 5) END AS upstream, left(next, 5) AS downstream FROM b WHERE n > 1 AND (class <> 'circular' OR k < n)
        UNION ALL SELECT cycle, 0, 1, pre || '0|-1', right(last, 5), left(seq, 5) FROM b WHERE class = 'circular' AND k = 1 UNION ALL SELECT cycle, upto - 1, upto, pre || '-1|0', NULL, NULL FROM b WHERE class = 'circular' AND k = n AND n > 1""",
    ),
    "on_circle": (
        lambda s, d: C.on_circle(peaks(s, d).select(F.col("qname").alias("cycle"), "id", (F.col("start") - 5000).alias("start"), (F.col("end") - 5000).alias("end")), _segments(s, d).groupBy("cycle").agg(F.sum(F.col("end") - F.col("start")).alias("circle"))),
        f"""WITH {_SEGMENTS}, c AS (SELECT cycle, CAST(sum("end" - start) AS BIGINT) AS l FROM seg GROUP BY cycle), f AS (SELECT qname AS cycle, id, ((start - 5000) % l + l) % l AS a, least("end" - start, l) AS w, l FROM peaks JOIN c ON qname = cycle WHERE start < "end")
        SELECT cycle, id, a AS start, least(a + w, l) AS "end", 1 AS piece FROM f UNION ALL SELECT cycle, id, 0, a + w - l, 2 FROM f WHERE a + w > l""",
    ),
    "cycle_rollup": (
        lambda s, d: C.cycle_rollup(_segments(s, d), peaks(s, d).select(F.col("qname").alias("cycle"), (F.col("start") % 50).alias("gene"))),
        f"""WITH {_SEGMENTS}, c AS (SELECT sample, class, cycle, sum("end" - start) AS length, count(*) AS n FROM seg GROUP BY ALL), own AS (SELECT DISTINCT sample, class, qname, start % 50 AS gene FROM peaks JOIN c ON qname = cycle),
        a AS (SELECT sample, class, count(*) AS cycles, round(sum(length)::DOUBLE / count(*), 1) / 1000 AS mean_kb, round(sum(n)::DOUBLE / count(*), 1) AS mean_segments FROM c GROUP BY GROUPING SETS ((sample, class), (sample), (class), ())),
        g AS (SELECT sample, class, count(DISTINCT gene) AS genes FROM own GROUP BY GROUPING SETS ((sample, class), (sample), (class), ()))
        SELECT a.*, coalesce(genes, 0) AS genes FROM a LEFT JOIN g ON a.sample IS NOT DISTINCT FROM g.sample AND a.class IS NOT DISTINCT FROM g.class
        UNION ALL SELECT x.sample, y.class, 0, 0, 0, 0 FROM (SELECT DISTINCT sample FROM c) x, (SELECT DISTINCT class FROM c) y WHERE (x.sample, y.class) NOT IN (SELECT (sample, class) FROM c)""",
    ),
    "cycle_element_rollup": (
        lambda s, d: C.cycle_element_rollup(_segments(s, d), genes(s, d).withColumn("element", F.concat(F.lit("k"), (F.col("id") % 3).cast("string")))),
        f"""WITH {_SEGMENTS}, cy AS (SELECT sample, class, cycle, CAST(sum("end" - start) AS BIGINT) AS length FROM seg GROUP BY ALL), p AS (SELECT s.cycle, 'k' || (g.id % 3) AS element, s.chrom, greatest(g.start, s.start) AS a, least(g."end", s."end") AS b FROM genes g JOIN seg s ON g.chrom = s.chrom AND g.start < s."end" AND s.start < g."end"),
        o AS (SELECT *, max(b) OVER (PARTITION BY cycle, element, chrom ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM p), e AS (SELECT cycle, element, CAST(sum(greatest(0, b - greatest(a, coalesce(seen, a)))) AS BIGINT) AS covered FROM o GROUP BY ALL),
        x AS (SELECT sample, class, cycle, element, covered, length FROM cy JOIN e USING (cycle)), t AS (SELECT sample, class, NULL AS cycle, element, CAST(sum(covered) AS BIGINT) AS covered, any_value(l) AS length FROM x JOIN (SELECT sample, class, CAST(sum(length) AS BIGINT) AS l FROM cy GROUP BY ALL) USING (sample, class) GROUP BY ALL)
        SELECT *, round(covered * 100.0::DOUBLE / length, 3) AS percent FROM (SELECT * FROM x UNION ALL SELECT sample, class, cycle, element, covered, length FROM t)""",
    ),
    "factor_class_rollup": (
        lambda s, d: _rolled(s, d).withColumns(_DIGITS("bound_percent", "repeat_percent", "density")),
        f"WITH {_ROLL} SELECT * REPLACE (round(bound_percent, 6) AS bound_percent, round(repeat_percent, 6) AS repeat_percent, round(density, 6) AS density) FROM roll",
    ),
    "factor_repeat_filter": (
        lambda s, d: C.factor_repeat_filter(_rolled(s, d), "circular", ["linear", "rearranged"], 25, 1, 0.5).withColumns(_DIGITS("bound_percent", "repeat_percent", "other_percent")),
        f"""WITH {_ROLL}, o AS (SELECT factor, repeat, max(repeat_percent) AS other FROM roll WHERE class <> 'circular' GROUP BY ALL)
        SELECT factor, repeat, round(bound_percent, 6) AS bound_percent, peaks, round(repeat_percent, 6) AS repeat_percent, round(coalesce(other, 0), 6) AS other_percent FROM roll r LEFT JOIN o USING (factor, repeat)
        WHERE class = 'circular' AND bound_percent >= 25 AND peaks >= cycles AND repeat_percent >= 1 AND repeat_percent >= 0.5 * coalesce(other, 0) AND NOT EXISTS (SELECT 1 FROM roll q WHERE q.class = 'circular' AND q.factor = r.factor AND q.repeat_percent > r.repeat_percent)""",
    ),
}

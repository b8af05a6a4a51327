"""Registered queries of ranks, halves, mappable sites, motif and read reports, splicing and cycle tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import annotate as A
from ..operators import methylation as ME
from ..operators import pipelines as C
from ..operators import reads as R
from ..operators import sequence as Q
from ..operators import sets as T
from ..operators import signal as S
from ..operators import splicing as L
from .fixtures import GENES, PEAKS, SEQUENCES, SIZES, genes, peaks, sequences, sizes, windows
from .interval_queries import _MERGE
from .matrix_queries import _RES, _enriched, _fisher
from .signal_queries import _STEPS, _steps

_P, _AB = f"WITH {PEAKS}", f"WITH {PEAKS}, {GENES}"


def _contacts(s, d):
    p = peaks(s, d)
    return p.select("id", F.col("chrom").alias("chrom1"), F.col("start").alias("pos1"), F.concat(F.lit("chr"), (F.col("id") % 5).cast("string")).alias("chrom2"), (F.col("score") % 997).alias("pos2"))


_CONTACTS = f"""{PEAKS}, raw AS (SELECT id, chrom AS c1, start AS p1, 'chr' || CAST(id % 5 AS VARCHAR) AS c2, score % 997 AS p2 FROM peaks),
    pairs AS (SELECT id, CASE WHEN (c1, p1) <= (c2, p2) THEN c1 ELSE c2 END AS chrom1, CASE WHEN (c1, p1) <= (c2, p2) THEN p1 ELSE p2 END AS pos1,
    CASE WHEN (c1, p1) <= (c2, p2) THEN c2 ELSE c1 END AS chrom2, CASE WHEN (c1, p1) <= (c2, p2) THEN p2 ELSE p1 END AS pos2 FROM raw)"""


def _covered(s, d):
    """Counts at every fourth base of the sequences, by their place."""
    c = Q.base_rows(sequences(s, d), "CG").filter("at % 4 = 1")
    return c.select(F.col("id").alias("chrom"), (F.col("at") + 1).alias("pos"), (F.col("at") % 7).alias("meth"), (F.col("at") % 3).alias("unmeth"))


#: Bases with their neighbours; the base and its surroundings of the other strand for G.
_BASES = f"""{SEQUENCES}, raw AS (SELECT id, length(seq) AS size, '...' || seq || '...' AS seq, unnest(range(0, length(seq))) AS k0 FROM sequences),
    bases AS (SELECT id, size, k0, substr(seq, k0 + 4, 1) AS base, CASE WHEN substr(seq, k0 + 4, 1) = 'C' THEN substr(seq, k0 + 1, 7)
    ELSE reverse(translate(substr(seq, k0 + 1, 7), 'ACGT', 'TGCA')) END AS own FROM raw WHERE substr(seq, k0 + 4, 1) IN ('C', 'G'))"""


def _nome_calls(s, d):
    """Reads of 60 bases that cover each whole sequence from its fifth base on, with a call at every third base."""
    c = Q.base_rows(sequences(s, d), "CG").filter("at >= 4 AND at % 3 = 0").withColumn("piece", F.floor((F.col("at") - 4) / 60))
    low, high = F.col("piece") * 60 + 5, F.col("piece") * 60 + 64
    letter = F.element_at(F.array(*map(F.lit, "ZzXxHh")), (F.col("at") % 6 + 1).cast("int"))
    back = F.col("id") % 2 == 1
    return c.select(F.concat_ws(":", "id", "piece").alias("read"), F.col("id").alias("chrom"), (F.col("at") + 1).alias("pos"), F.when(back, high).otherwise(low).alias("start"), F.when(back, low).otherwise(high).alias("end"), letter.alias("call"), (letter == F.upper(letter)).alias("meth"))


def _windows(s, d):
    c = windows(s, d, 500).select("chrom", "start", F.col("hits").alias("reads"))
    return c.withColumns({"gc": F.col("start") % 30 / 100.0, "mappability": (F.col("start") / 500) % 10 / 10.0 + 0.1})


def _splicing(s, d):
    """An event per gene: counts of two samples in two groups, and its exons."""
    g = F.col("id")
    one = lambda k, m: F.array(g % k, g % m)
    return genes(s, d).select(
        F.col("id").alias("event"), "chrom", "strand", one(5, 7).alias("inc1"), one(3, 4).alias("skp1"), one(6, 11).alias("inc2"), one(2, 9).alias("skp2"),
        F.lit(2.0).alias("inc_len"), F.lit(1.0).alias("skp_len"), ((g * 37 % 1000) / 1000.0).alias("p"),
        F.col("start").alias("up_start"), (F.col("start") + 10).alias("up_end"), (F.col("start") + 20).alias("exon_start"), (F.col("start") + 31).alias("exon_end"), (F.col("start") + 40).alias("down_start"), (F.col("start") + 57).alias("down_end"),
    )


_SPLICING = f"""{GENES}, ev AS (SELECT id AS event, chrom, strand, start, [id % 5, id % 7] AS inc1, [id % 3, id % 4] AS skp1, [id % 6, id % 11] AS inc2, [id % 2, id % 9] AS skp2, (id * 37 % 1000) / 1000.0::DOUBLE AS p FROM genes),
    ok AS (SELECT * FROM ev WHERE list_sum(inc1) + list_sum(skp1) > 0 AND list_sum(inc2) + list_sum(skp2) > 0),
    lv AS (SELECT *, [CASE WHEN inc1[i] + skp1[i] > 0 THEN round(inc1[i] / 2.0::DOUBLE / (inc1[i] / 2.0::DOUBLE + skp1[i]), 3) END FOR i IN [1, 2]] AS level1,
    [CASE WHEN inc2[i] + skp2[i] > 0 THEN round(inc2[i] / 2.0::DOUBLE / (inc2[i] / 2.0::DOUBLE + skp2[i]), 3) END FOR i IN [1, 2]] AS level2 FROM ok),
    th AS (SELECT *, list_sum([CAST(round(x * 1000) AS BIGINT) FOR x IN level1 IF x IS NOT NULL]) * len([x FOR x IN level2 IF x IS NOT NULL]) - list_sum([CAST(round(x * 1000) AS BIGINT) FOR x IN level2 IF x IS NOT NULL]) * len([x FOR x IN level1 IF x IS NOT NULL]) AS top,
    len([x FOR x IN level1 IF x IS NOT NULL]) * len([x FOR x IN level2 IF x IS NOT NULL]) AS low FROM lv),
    df AS (SELECT *, CASE WHEN low > 0 THEN sign(top) * ((2 * abs(top) + low) // (2 * low)) / 1000.0::DOUBLE END AS diff, row_number() OVER (ORDER BY p) AS k, count(*) OVER () AS n FROM th),
    st AS (SELECT *, least(min(p * n / k) OVER (ORDER BY p DESC, k DESC ROWS UNBOUNDED PRECEDING), 1.0) AS fdr FROM df)"""


def _room(s, d):
    """Chromosomes three times as long as their genes."""
    return genes(s, d).groupBy("chrom").agg((F.sum(F.col("end") - F.col("start")) * 3).alias("length"))


def _isoforms(s, d):
    """Two isoforms per gene: one with all three exons of its event, one without the middle; genes of odd id have the first only."""
    e = _splicing(s, d)
    parts = lambda *names: F.array(*(F.struct(F.col(f"{x}_start").alias("start"), F.col(f"{x}_end").alias("end")) for x in names))
    name = lambda x: F.concat(F.col("event").cast("string"), F.lit(x))
    first = e.select(name("a").alias("id"), "chrom", F.explode(parts("up", "exon", "down")).alias("b"))
    second = e.filter("event % 2 = 0").select(name("b").alias("id"), "chrom", F.explode(parts("up", "down")).alias("b"))
    return first.unionByName(second).select("id", "chrom", "b.start", "b.end")


def _cycle_steps(s, d):
    """Orders as cycles, their peaks as segments; every ninth segment is an open end."""
    q = F.col("qname")
    kind = F.element_at(F.array(*map(F.lit, ("Invalid", "Rearranged", "Linear"))), (q % 3 + 1).cast("int"))
    return peaks(s, d).select(
        F.concat(F.lit("s"), (q % 4).cast("string")).alias("sample"), F.concat(F.lit("a"), (q % 6).cast("string")).alias("amplicon"), q.alias("cycle"), F.col("id").alias("ord"),
        F.when(F.col("id") % 9 == 0, "0").otherwise(F.col("id").cast("string")).alias("segment"), "chrom", "start", "end", "strand", (F.col("score") % 40).alias("copy_count"),
        (q % 2 == 0).alias("cyclic"), kind.alias("cycle_class"), (q % 1000).alias("caller_length"),
    )


_CYCLE = f"""{PEAKS}, st AS (SELECT 's' || CAST(qname % 4 AS VARCHAR) AS sample, 'a' || CAST(qname % 6 AS VARCHAR) AS amplicon, qname AS cycle, id AS ord, chrom, start, "end", strand, score % 40 AS copy_count,
    qname % 2 = 0 AS cyclic, ['Invalid', 'Rearranged', 'Linear'][CAST(qname % 3 + 1 AS INT)] AS cycle_class, qname % 1000 AS caller_length FROM peaks WHERE id % 9 <> 0)"""


def _elements(s, d):
    p = peaks(s, d)
    pick = lambda names, k: F.element_at(F.array(*map(F.lit, names)), (F.col("id") % k + 1).cast("int"))
    return p.select(
        F.concat(F.lit("seg"), (F.col("qname") % 500).cast("string")).alias("segment"), "id", pick(["miRNA", "repeat", "repeat", "CpG"], 4).alias("class"),
        pick(["other", "repeat", "repeat"], 3).alias("kind"), pick(["SINE", "LINE", "LTR"], 3).alias("type"), (F.col("start") % 3000).alias("start"), (F.col("start") % 3000 + F.col("end") - F.col("start")).alias("end"), (F.col("end") - F.col("start")).alias("overlap"),
    )


def _segment_genes(s, d):
    g = genes(s, d)
    return g.select(F.concat(F.lit("seg"), (F.col("id") % 500).cast("string")).alias("segment"), (F.col("start") % 3000).alias("start"), (F.col("start") % 3000 + F.col("end") - F.col("start")).alias("end"))


def _sites(s, d, letters, step):
    """Sites at every so many G or T, on both strands."""
    b = Q.base_rows(sequences(s, d), letters).filter(F.col("at") % step == 0)
    at = F.col("at").cast("long")
    return b.select(F.concat_ws(":", "id", "at").alias("id"), F.col("id").alias("chrom"), at.alias("start"), (at + 1).alias("end"), F.when(F.col("at") % 2 == 0, "+").otherwise("-").alias("strand"), (F.col("at") % 7).alias("m"), (F.col("at") % 11 + 5).alias("k"))


_SITES = lambda letters, step: f"""SELECT id AS chrom, seq, length(seq) AS size, i AS start, CASE WHEN i % 2 = 0 THEN '+' ELSE '-' END AS strand, i % 7 AS m, i % 11 + 5 AS k
    FROM (SELECT id, seq, unnest(range(0, length(seq))) AS i FROM sequences) WHERE i % {step} = 0 AND substr(seq, i + 1, 1) IN ({letters})"""  # noqa: E731


def _peak_counts(s, d):
    """Four cells of two replicates per gene."""
    g = F.col("id")
    cell = lambda name, k: F.struct(F.lit(name).alias("cell"), (g % k).alias("value"))
    cells = F.array(*(cell(n, k) for n, a, b in (("ip_treat", 23, 29), ("in_treat", 7, 11), ("ip_control", 13, 17), ("in_control", 5, 9)) for k in (a, b)))
    return genes(s, d).select("id", F.explode(cells).alias("c")).select("id", "c.*")


def _transcript_hits(s, d):
    kinds = F.element_at(F.array(*map(F.lit, A.OVERHANGS)), (F.col("id") % 4 + 1).cast("int"))
    return peaks(s, d).select("qname", F.col("id").cast("string").alias("transcript"), kinds.alias("kind"), (F.col("score") % 700 - 350).alias("overhang"))


_CHOOSE = lambda n, k: f"(lgamma({n} + 1.0) - lgamma({k} + 1.0) - lgamma({n} - {k} + 1.0))"


def _terms(source, keep):
    """SQL of log terms of the tables (a, b, c, d) in ``source``: keep, x (log of the term), o (log of the observed one)."""
    log_p = lambda k: f"{_CHOOSE('(a + c)', k)} + {_CHOOSE('(b + d)', f'(a + b - {k})')} - {_CHOOSE('(a + b + c + d)', '(a + b)')}"
    return f"""(SELECT {keep}, {log_p('k')} AS x, {log_p('a')} AS o FROM (SELECT *, unnest(range(CAST(greatest(0, a - d) AS BIGINT), CAST(least(a + b, a + c) + 1 AS BIGINT))) AS k FROM {source}))"""


def _overlap_table(a, b, sizes_):
    """SQL of the contingency table of two interval sets and its figures."""
    return f"""h AS (SELECT count(*) AS hits FROM {a} p JOIN {b} g ON p.chrom = g.chrom AND p.start < g."end" AND g.start < p."end"),
        f AS (SELECT hits, (SELECT count(*) FROM {a}) AS na, (SELECT count(*) FROM {b}) AS nb, greatest(CAST(floor((SELECT sum(length) FROM {sizes_}) / ((SELECT avg("end" - start) FROM {a}) + (SELECT avg("end" - start) FROM {b}))) AS BIGINT), (SELECT count(*) FROM {a}) + (SELECT count(*) FROM {b})) AS places FROM h),
        t AS (SELECT hits AS a, greatest(na - hits, 0) AS b, greatest(nb - hits, 0) AS c, greatest(places - hits - greatest(na - hits, 0) - greatest(nb - hits, 0), 0) AS d FROM f),
        pv AS (SELECT least(1.0, sum(CASE WHEN x <= o + 1e-7 THEN exp(x) ELSE 0 END)) AS p FROM {_terms('t', 'a')})"""


_FIGURES = 't.a AS "both", t.b AS only_a, t.c AS only_b, t.d AS neither, round(CASE WHEN t.b * t.c <> 0 THEN t.a * t.d * 1.0::DOUBLE / (t.b * t.c) END, 6) AS odds, round(p, 9) AS p'
_ROUND = lambda df: df.withColumns({"odds": F.round("odds", 6), "p": F.round("p", 9)})

QUERIES = {
    "fisher_exact": (
        lambda s, d: _fisher(s, d),
        f"""WITH {_RES}, t AS (SELECT cust, count(*) FILTER (p < 0.5 AND log2fc > 0) AS a, count(*) FILTER (p < 0.5 AND log2fc <= 0) AS b, count(*) FILTER (p >= 0.5 AND log2fc > 0) AS c, count(*) FILTER (p >= 0.5 AND log2fc <= 0) AS d FROM res GROUP BY cust),
        v AS (SELECT cust, least(1.0, sum(CASE WHEN x <= o + 1e-7 THEN exp(x) ELSE 0 END)) AS pvalue FROM {_terms('t', 'cust')} GROUP BY cust) SELECT cust, a, b, c, d, round(pvalue, 9) AS pvalue FROM t JOIN v USING (cust)""",
    ),
    "over_representation": (
        lambda s, d: _enriched(s, d).withColumns({"p": F.round("p", 9), "padj": F.round("padj", 9)}),
        f"""WITH m AS (SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS set, c_custkey AS gene FROM customer), ch AS (SELECT DISTINCT o_custkey AS gene FROM orders WHERE o_totalprice > 250000 AND o_custkey IN (SELECT gene FROM m)),
        g AS (SELECT set, count(ch.gene) AS k, count(*) AS size FROM m LEFT JOIN ch USING (gene) GROUP BY set HAVING count(ch.gene) > 0), n AS (SELECT (SELECT count(DISTINCT gene) FROM m) AS n, (SELECT count(*) FROM ch) AS r),
        j AS (SELECT set, k, size, n, r, unnest(range(k, least(size, r) + 1)) AS j FROM g, n), pv AS (SELECT set, k, size, least(1.0, sum(exp({_CHOOSE('size', 'j')} + {_CHOOSE('(n - size)', '(r - j)')} - {_CHOOSE('n', 'r')}))) AS p FROM j WHERE r - j <= n - size GROUP BY set, k, size),
        o AS (SELECT *, row_number() OVER (ORDER BY p) AS i, count(*) OVER () AS n FROM pv) SELECT set, k, size, round(p, 9) AS p, round(least(1.0, min(p * n / i) OVER (ORDER BY p DESC, i DESC ROWS UNBOUNDED PRECEDING)), 9) AS padj FROM o""",
    ),
    "overlap_fisher": (
        lambda s, d: _ROUND(C.overlap_fisher(peaks(s, d), genes(s, d), sizes(s, d))),
        f"{_AB}, {SIZES}, {_overlap_table('peaks', 'genes', 'sizes')} SELECT {_FIGURES} FROM t, pv",
    ),
    "replicate_overlap": (
        lambda s, d: _ROUND(C.replicate_overlap(peaks(s, d).filter("id % 2 = 0"), peaks(s, d).filter("id % 2 = 1"), genes(s, d), sizes(s, d))),
        f"""{_AB}, {SIZES}, fr AS (SELECT * FROM peaks p WHERE NOT EXISTS (SELECT 1 FROM genes g WHERE p.chrom = g.chrom AND p.start < g."end" AND g.start < p."end")), r1 AS (SELECT * FROM fr WHERE id % 2 = 0), r2 AS (SELECT * FROM fr WHERE id % 2 = 1),
        {_overlap_table('r1', 'r2', 'sizes')}, i AS (SELECT count(*) AS segments, CAST(coalesce(sum(least(p."end", g."end") - greatest(p.start, g.start)), 0) AS BIGINT) AS bases FROM r1 p JOIN r2 g ON p.chrom = g.chrom AND p.start < g."end" AND g.start < p."end")
        SELECT segments, bases, {_FIGURES} FROM t, pv, i""",
    ),
    "context_summary": (
        lambda s, d: ME.context_summary(ME.cytosine_report(sequences(s, d), _covered(s, d), upstream=True)).withColumn("pct", F.round("pct", 6)),
        f"""WITH {_BASES}, k AS (SELECT CASE WHEN k0 % 4 = 1 THEN k0 % 7 ELSE 0 END AS m, CASE WHEN k0 % 4 = 1 THEN k0 % 3 ELSE 0 END AS u, replace(substr(own, 4, 3), '.', 'N') AS tri, replace(substr(own, 3, 1), '.', 'N') AS before FROM bases),
        c AS (SELECT *, CASE WHEN regexp_matches(tri, '^CG') THEN 'CG' WHEN regexp_matches(tri, '^C[ACT]G') THEN 'CHG' WHEN regexp_matches(tri, '^C[ACT][ACT]') THEN 'CHH' END AS context FROM k)
        SELECT context, tri, before, CAST(sum(m) AS BIGINT) AS meth, CAST(sum(u) AS BIGINT) AS unmeth, round(CASE WHEN sum(m) + sum(u) > 0 THEN 100.0::DOUBLE * sum(m) / (sum(m) + sum(u)) END, 6) AS pct FROM c WHERE context IS NOT NULL GROUP BY context, tri, before""",
    ),
    "filter_bed_by_sequence": (
        lambda s, d: Q.filter_bed_by_sequence(Q.find_motif(sequences(s, d), "GGNC").select(F.concat_ws(":", "id", "at").alias("id"), F.col("id").alias("chrom"), F.col("at").alias("start"), (F.col("at") + 4).alias("end"), "strand"), sequences(s, d), "GGAC").groupBy("chrom").agg(F.count("*").alias("n")),
        f"WITH {SEQUENCES} SELECT id AS chrom, (length(seq) - length(replace(seq, 'GGAC', ''))) // 4 AS n FROM sequences WHERE contains(seq, 'GGAC')",
    ),
    "split_reads": (
        lambda s, d: T.split_reads(peaks(s, d), 4).select("id", "chunk"),
        f"{_P} SELECT id, CAST(CAST('0x' || substr(md5('0:' || CAST(qname AS VARCHAR)), 1, 15) AS BIGINT) % 4 AS INT) AS chunk FROM peaks",
    ),
    "shuffle_apart": (
        lambda s, d: T.shuffle_apart(genes(s, d), _room(s, d), 5).select("id", "chrom", "start", "end"),
        f"""WITH {GENES}, room AS (SELECT chrom, sum("end" - start) * 3 AS length FROM genes GROUP BY chrom), k AS (SELECT g.id, g.chrom, "end" - start AS w, CAST('0x' || substr(md5('5:' || CAST(g.id AS VARCHAR)), 1, 15) AS BIGINT) % CAST(length - sum("end" - start) OVER (PARTITION BY g.chrom) + 1 AS BIGINT) AS u FROM genes g JOIN room USING (chrom)),
        p AS (SELECT *, CAST(u + coalesce(sum(w) OVER (PARTITION BY chrom ORDER BY u, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM k) SELECT id, chrom, start, start + w AS "end" FROM p""",
    ),
    "shuffle_intervals": (
        lambda s, d: T.shuffle_intervals(peaks(s, d), sizes(s, d), 3).select("id", "chrom", "start", "end"),
        f"""{_AB}, {SIZES}, k AS (SELECT id, chrom, "end" - start AS w, CAST('0x' || substr(md5('3:' || CAST(id AS VARCHAR)), 1, 15) AS BIGINT) % greatest(length - ("end" - start), 1) AS start FROM peaks JOIN sizes USING (chrom)) SELECT id, chrom, start, start + w AS "end" FROM k""",
    ),
    "cycle_stats": (
        lambda s, d: T.cycle_stats(_steps(s, d)).withColumns({"mean_length": F.round("mean_length", 6), "mean_segments": F.round("mean_segments", 6)}),
        f"""WITH {_STEPS}, l AS (SELECT *, lag(start) OVER w AS s0, lag("end") OVER w AS e0, lag(strand) OVER w AS t0, lag(chrom) OVER w AS c0 FROM steps WINDOW w AS (PARTITION BY cycle ORDER BY ord)),
        a AS (SELECT cycle, sum("end" - start) AS length, count(*) AS segments, count(DISTINCT chrom) AS chroms, count(DISTINCT strand) AS strands, count(DISTINCT (chrom, start, "end")) AS ds, max(CASE WHEN s0 IS NOT NULL AND chrom = c0 AND strand <> t0 AND greatest(start, s0) < least("end", e0) THEN 1 ELSE 0 END) AS fold,
        max(CASE WHEN s0 IS NOT NULL THEN greatest(start, s0) - least("end", e0) END) AS gap FROM l GROUP BY cycle)
        SELECT CASE WHEN segments = 1 THEN 'single' WHEN chroms > 1 THEN 'translocation' WHEN fold = 1 THEN 'foldback' WHEN strands > 1 THEN 'inversion' WHEN ds < segments THEN 'tandem' WHEN gap <= 1000 THEN 'deletion' ELSE 'jump' END AS kind,
        count(*) AS cycles, round(avg(length), 6) AS mean_length, round(avg(segments), 6) AS mean_segments FROM a GROUP BY 1""",
    ),
    "gc_bias": (
        lambda s, d: C.gc_bias(*(Q.gc_windows(sequences(s, d), 200).select(F.concat_ws(":", "id", "start").alias("id"), *c) for c in (["gc"], [(F.col("start") % 7).alias("hits")]))).withColumn("normalized", F.round("normalized", 6)),
        f"""WITH {SEQUENCES}, w AS (SELECT seq, unnest(range(0, length(seq), 200)) AS start FROM sequences), v AS (SELECT start % 7 AS hits, substr(seq, start + 1, 200) AS p FROM w),
        g AS (SELECT hits, (length(p) - length(translate(p, 'GC', ''))) / CAST(length(translate(p, 'N', '')) AS DOUBLE) AS gc FROM v WHERE length(translate(p, 'N', '')) > 0)
        SELECT CAST(round(gc * 100) AS INT) AS gc, count(*) AS windows, CAST(sum(hits) AS BIGINT) AS reads, round(avg(hits) / (SELECT avg(hits) FROM g), 6) AS normalized FROM g GROUP BY 1""",
    ),
    "non_peak_regions": (
        lambda s, d: C.non_peak_regions(peaks(s, d).filter("score > 90000"), genes(s, d), 5).select("chrom", "strand", "start", "end"),
        f"""{_AB}, sp AS {_MERGE('genes', 0, 'chrom, strand')}, wide AS (SELECT chrom, strand, greatest(start - 5, 0) AS start, "end" + 5 AS "end" FROM peaks WHERE score > 90000), m AS {_MERGE('wide', 0, 'chrom, strand')},
        h AS (SELECT s.chrom, s.strand, s.start AS a0, s."end" AS a1, greatest(s.start, m.start) AS b0, least(s."end", m."end") AS b1 FROM sp s JOIN m ON s.chrom = m.chrom AND s.strand = m.strand AND s.start < m."end" AND m.start < s."end"),
        k AS (SELECT *, coalesce(lag(b1) OVER w, a0) AS g0, lead(b0) OVER w AS nxt FROM h WINDOW w AS (PARTITION BY chrom, strand, a0 ORDER BY b0))
        SELECT chrom, strand, g0 AS start, b0 AS "end" FROM k WHERE b0 > g0 UNION ALL SELECT chrom, strand, b1, a1 FROM k WHERE nxt IS NULL AND b1 < a1
        UNION ALL SELECT s.chrom, s.strand, s.start, s."end" FROM sp s WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.chrom = s.chrom AND h.strand = s.strand AND h.a0 = s.start)""",
    ),
    "clip_sites": (
        lambda s, d: C.clip_sites(_sites(s, d, "CG", 3), _sites(s, d, "GT", 5), sequences(s, d), "DRACH"),
        f"""WITH {SEQUENCES}, a AS ({_SITES("'C', 'G'", 3)}), b AS ({_SITES("'G', 'T'", 5)}), u AS (SELECT *, 'CIMS' AS kind FROM a WHERE m >= 2 AND m / CAST(k AS DOUBLE) >= 0.1 AND m <= k UNION ALL SELECT *, 'CITS' FROM b),
        v AS (SELECT chrom, seq, size, strand, m, kind, greatest(start + CASE WHEN strand = '-' THEN 1 ELSE -1 END, 0) AS start FROM u),
        w AS (SELECT * FROM v WHERE substr(seq, start + 1, 1) = CASE WHEN strand = '-' THEN 'T' ELSE 'A' END),
        x AS (SELECT chrom, start, strand, any_value(seq) AS seq, any_value(size) AS size, string_agg(DISTINCT kind, '|' ORDER BY kind) AS kind, CAST(sum(m) AS BIGINT) AS reads FROM w GROUP BY chrom, start, strand),
        y AS (SELECT *, substr(seq, CAST(greatest(start - 5, 0) AS BIGINT) + 1, CAST(least(start + 6, size) - greatest(start - 5, 0) AS BIGINT)) AS near FROM x)
        SELECT chrom, start, start + 1 AS "end", strand, kind, reads, regexp_matches(CASE WHEN strand = '-' THEN reverse(translate(near, 'ACGT', 'TGCA')) ELSE near END, '[AGT][AG]AC[ACT]') AS has_motif FROM y""",
    ),
    "differential_peaks": (
        lambda s, d: C.differential_peaks(
            genes(s, d).select("id", "gene", F.element_at(F.array(*map(F.lit, ("control", "treat", "shared", "shared"))), (F.col("id") % 4 + 1).cast("int")).alias("label")), _peak_counts(s, d),
            genes(s, d).groupBy("gene").agg(F.min("start").alias("control"), F.max("start").alias("treat")), genes(s, d).filter("gene < 'Brand#33'").groupBy("gene").agg((F.count("*") / 8.0).alias("log2fc"), F.lit(0.25).alias("p")),
        ).select("id", "gene", F.round("log2fc", 6).alias("log2fc"), F.round("p", 9).alias("p"), F.round("padj", 9).alias("padj"), "gene_control", "gene_treat", "gene_log2fc", "gene_p"),
        f"""WITH {GENES}, c AS (SELECT id, (id % 23 + id % 29) / 2.0::DOUBLE AS x1, (id % 7 + id % 11) / 2.0::DOUBLE AS x2, (id % 13 + id % 17) / 2.0::DOUBLE AS x3, (id % 5 + id % 9) / 2.0::DOUBLE AS x4 FROM genes),
        t AS (SELECT id, CAST(round(x1) AS BIGINT) AS a, CAST(round(x2) AS BIGINT) AS b, CAST(round(x3) AS BIGINT) AS c, CAST(round(x4) AS BIGINT) AS d FROM c),
        v AS (SELECT id, least(1.0, sum(CASE WHEN x <= o + 1e-7 THEN exp(x) ELSE 0 END)) AS p FROM {_terms('t', 'id')} GROUP BY id),
        q AS (SELECT *, row_number() OVER (ORDER BY p) AS i, count(*) OVER () AS n FROM v), h AS (SELECT id, p, least(1.0, min(p * n / i) OVER (ORDER BY p DESC, i DESC ROWS UNBOUNDED PRECEDING)) AS padj FROM q),
        e AS (SELECT gene, min(start) AS lo, max(start) AS hi, count(*) / 8.0::DOUBLE AS f FROM genes GROUP BY gene)
        SELECT g.id, g.gene, round(CASE g.id % 4 WHEN 0 THEN -99.0 WHEN 1 THEN 99.0 ELSE log2((x1 + 1) * (x4 + 1) / ((x2 + 1) * (x3 + 1))) END, 6) AS log2fc, round(p, 9) AS p, round(padj, 9) AS padj, lo AS gene_control, hi AS gene_treat,
        CASE WHEN g.gene < 'Brand#33' THEN f ELSE 0 END AS gene_log2fc, CASE WHEN g.gene < 'Brand#33' THEN 0.25 ELSE 1 END AS gene_p FROM genes g JOIN c USING (id) JOIN h USING (id) JOIN e ON g.gene = e.gene""",
    ),
    "rank_peaks": (
        lambda s, d: S.rank_peaks(peaks(s, d), "score").select("id", "rank"),
        f"{_P} SELECT id, row_number() OVER (ORDER BY score DESC, id) AS rank FROM peaks",
    ),
    "rank_peaks_by_signal": (
        lambda s, d: S.rank_peaks(peaks(s, d).withColumn("signal", F.col("score") / 100.0), "signal").select("id", "rank"),
        f"{_P} SELECT id, row_number() OVER (ORDER BY score / 100.0, id) AS rank FROM peaks",
    ),
    "pseudo_replicates": (
        lambda s, d: R.pseudo_replicates(peaks(s, d), 5).select("id", "replicate"),
        f"""{_P}, n AS (SELECT DISTINCT qname, substr(md5('5:' || CAST(qname AS VARCHAR)), 1, 15) AS o FROM peaks), k AS (SELECT qname, row_number() OVER (ORDER BY o, qname) AS k, count(*) OVER () AS n FROM n)
        SELECT id, CASE WHEN k <= (n + 1) // 2 THEN 1 ELSE 2 END AS replicate FROM peaks JOIN k USING (qname)""",
    ),
    "idr_filter": (
        lambda s, d: T.idr_filter(peaks(s, d).select("chrom", "start", "end", (F.col("score") % 1500).alias("score"), (F.col("id") % 4).alias("log_idr")), 2),
        f"""{_P}, k AS (SELECT DISTINCT chrom, start, "end", score % 1500 AS score, id % 4 AS log_idr FROM peaks WHERE id % 4 >= 2)
        SELECT chrom, start, "end", least(score, 1000) AS score, log_idr, row_number() OVER (ORDER BY chrom, start, "end", least(score, 1000), log_idr) AS number FROM k""",
    ),
    "contact_dedup_wobble": (
        lambda s, d: T.contact_dedup(_contacts(s, d), wobble=4).select("id", "chrom1", "pos1", "chrom2", "pos2"),
        f"""WITH {_CONTACTS}, a AS (SELECT *, CASE WHEN pos1 <= lag(pos1) OVER w + 4 THEN 0 ELSE 1 END AS fresh FROM pairs WINDOW w AS (PARTITION BY chrom1, chrom2 ORDER BY pos1, id)),
        b AS (SELECT * EXCLUDE fresh, sum(fresh) OVER (PARTITION BY chrom1, chrom2 ORDER BY pos1, id ROWS UNBOUNDED PRECEDING) AS g FROM a),
        c AS (SELECT *, CASE WHEN pos2 <= lag(pos2) OVER w + 4 THEN 0 ELSE 1 END AS fresh FROM b WINDOW w AS (PARTITION BY chrom1, chrom2, g ORDER BY pos2, id)),
        e AS (SELECT *, sum(fresh) OVER (PARTITION BY chrom1, chrom2, g ORDER BY pos2, id ROWS UNBOUNDED PRECEDING) AS h FROM c)
        SELECT id, chrom1, pos1, chrom2, pos2 FROM e QUALIFY row_number() OVER (PARTITION BY chrom1, chrom2, g, h ORDER BY id) = 1""",
    ),
    "center_sites": (
        lambda s, d: S.center_sites(sizes(s, d), genes(s, d), 100),
        f"""{_AB}, {SIZES}, m AS {_MERGE('genes')}, on_ AS (SELECT chrom, unnest(range(start, "end")) AS pos FROM m), all_ AS (SELECT chrom, length, unnest(range(0, length)) AS pos FROM sizes),
        c AS (SELECT a.chrom, a.pos, length, sum(CASE WHEN o.pos IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY a.chrom ORDER BY a.pos ROWS BETWEEN 100 PRECEDING AND 100 FOLLOWING) AS n FROM all_ a LEFT JOIN on_ o ON a.chrom = o.chrom AND a.pos = o.pos),
        k AS (SELECT chrom, pos, pos - row_number() OVER (PARTITION BY chrom ORDER BY pos) AS g FROM c WHERE n >= 101 AND pos >= 100 AND pos < length - 100)
        SELECT chrom, min(pos) AS start, max(pos) + 1 AS "end" FROM k GROUP BY chrom, g""",
    ),
    "copy_profile": (
        lambda s, d: S.copy_profile(_windows(s, d)).select("chrom", "start", F.round("depth", 6).alias("depth")),
        f"""{_AB}, {SIZES}, t AS (SELECT chrom, start, least(start + 500, length) AS "end" FROM (SELECT chrom, length, unnest(range(0, length, 500)) AS start FROM sizes)),
        w AS (SELECT g.chrom, g.start, count(p.id) AS reads FROM t g LEFT JOIN peaks p ON p.chrom = g.chrom AND p.start < g."end" AND g.start < p."end" GROUP BY ALL),
        v AS (SELECT chrom, start, start % 30 AS stratum, CASE WHEN (start // 500) % 10 / 10.0::DOUBLE + 0.1 >= 0.75 THEN reads / ((start // 500) % 10 / 10.0::DOUBLE + 0.1) END AS depth FROM w),
        m AS (SELECT stratum, median(depth) AS m FROM v GROUP BY stratum), a AS (SELECT median(depth) AS a FROM v)
        SELECT chrom, start, round(CASE WHEN m <> 0 THEN depth * a / m END, 6) AS depth FROM v JOIN m USING (stratum), a""",
    ),
    "drach_report": (
        lambda s, d: ME.drach_report(sequences(s, d), _covered(s, d)).withColumn("percent", F.round("percent", 6)),
        f"""WITH {_BASES} SELECT id AS chrom, k0 + 1 AS pos, CASE WHEN base = 'C' THEN '+' ELSE '-' END AS strand, k0 % 7 AS meth, k0 % 3 AS unmeth, substr(own, 1, 5) AS drach, substr(own, 4, 3) AS tri,
        round(100.0::DOUBLE * (k0 % 7) / (k0 % 7 + k0 % 3), 6) AS percent FROM bases
        WHERE substr(own, 1, 1) NOT IN ('C', '.') AND substr(own, 2, 1) IN ('A', 'G') AND substr(own, 3, 2) = 'AC' AND substr(own, 5, 1) NOT IN ('G', '.') AND substr(own, 6, 1) <> '.' AND k0 % 4 = 1 AND k0 % 7 + k0 % 3 >= 1""",
    ),
    "nome_filter": (
        lambda s, d: ME.nome_filter(ME.cytosine_report(sequences(s, d), _covered(s, d), contexts=("CG",), threshold=1, upstream=True)).select("chrom", "pos", "strand", "meth", "unmeth", "before"),
        f"""WITH {_BASES} SELECT id AS chrom, k0 + 1 AS pos, CASE WHEN base = 'C' THEN '+' ELSE '-' END AS strand, k0 % 7 AS meth, k0 % 3 AS unmeth, substr(own, 3, 1) AS before FROM bases
        WHERE substr(own, 4, 2) = 'CG' AND substr(own, 3, 1) IN ('A', 'T') AND k0 % 4 = 1 AND k0 % 7 + k0 % 3 >= 1""",
    ),
    "nome_read_summary": (
        lambda s, d: ME.nome_read_summary(_nome_calls(s, d), sequences(s, d)),
        f"""WITH {_BASES}, c AS (SELECT *, (k0 - 4) // 60 AS piece, (k0 - 4) // 60 * 60 + CASE WHEN id % 2 = 1 THEN 64 ELSE 5 END AS start, ['Z', 'z', 'X', 'x', 'H', 'h'][k0 % 6 + 1] AS call FROM bases WHERE k0 >= 4 AND k0 % 3 = 0),
        k AS (SELECT *, substr(own, 3, 1) AS b, CASE WHEN substr(own, 5, 1) = 'G' AND regexp_matches(own, '^...CG') THEN 'Z' WHEN regexp_matches(own, '^...C[ACT]G') THEN 'X' WHEN regexp_matches(own, '^...C[ACT][ACT]') THEN 'H' END AS want FROM c WHERE size >= start + 62),
        f AS (SELECT id, piece, want = upper(call) AND want = 'Z' AND b IN ('A', 'T') AS cg, want = upper(call) AND want <> 'Z' AND b = 'G' AS gc, call = upper(call) AS m FROM k)
        SELECT CAST(id AS VARCHAR) || ':' || CAST(piece AS VARCHAR) AS read, id AS chrom, piece * 60 + 5 AS start, piece * 60 + 64 AS "end", count(*) FILTER (cg AND m) AS meth_cg, count(*) FILTER (cg AND NOT m) AS unmeth_cg, count(*) FILTER (gc AND m) AS meth_gc, count(*) FILTER (gc AND NOT m) AS unmeth_gc FROM f GROUP BY id, piece""",
    ),
    "splicing_stats": (
        lambda s, d: L.splicing_stats(_splicing(s, d)).select("event", F.array_join(F.transform("level1", lambda x: x.cast("decimal(9,3)").cast("string")), ",", "NA").alias("level1"), F.round(F.col("diff") * 1000).cast("long").alias("diff"), F.round("fdr", 6).alias("fdr")),
        f"""WITH {_SPLICING} SELECT event, array_to_string([coalesce(CAST(CAST(x AS DECIMAL(9,3)) AS VARCHAR), 'NA') FOR x IN level1], ',') AS level1, CAST(round(diff * 1000) AS BIGINT) AS diff, round(fdr, 6) AS fdr FROM st""",
    ),
    "splicing_to_transcripts": (
        lambda s, d: L.splicing_to_transcripts(L.splicing_stats(_splicing(s, d)), _isoforms(s, d), 0.6, 1.0, 0.05).select("event", "inc1_mean", "skp2_mean", "exon_length", "up_length", "down_length", "inclusion_length", "skipping_length", "inclusion", "skipping"),
        f"""WITH {_SPLICING} SELECT event, list_avg(inc1) AS inc1_mean, list_avg(skp2) AS skp2_mean, 11 AS exon_length, CASE WHEN strand = '-' THEN 17 ELSE 10 END AS up_length, CASE WHEN strand = '-' THEN 10 ELSE 17 END AS down_length, 38 AS inclusion_length, 27 AS skipping_length,
        CAST(event AS VARCHAR) || 'a' AS inclusion, CASE WHEN event % 2 = 0 THEN CAST(event AS VARCHAR) || 'b' ELSE 'unknown' END AS skipping FROM st
        WHERE p <= 0.6 AND fdr <= 1.0 AND abs(diff) >= 0.05 AND level1[1] IS NOT NULL AND level1[2] IS NOT NULL AND level2[1] IS NOT NULL AND level2[2] IS NOT NULL""",
    ),
    "cycle_segments": (
        lambda s, d: T.cycle_segments(_cycle_steps(s, d)).select("id", "cycle_id", "cycle_length", "length", "segments", "class", "copy_count"),
        f"""WITH {_CYCLE}, k AS (SELECT *, CASE WHEN cycle_class <> 'Invalid' THEN cycle_class WHEN cyclic AND caller_length >= 1 THEN 'Circular' WHEN NOT cyclic AND caller_length >= 500 THEN 'No_fSCNA' END AS class FROM st),
        r AS (SELECT *, sample || '|' || amplicon || '|cycle-' || CAST(cycle AS VARCHAR) AS cycle_id FROM k WHERE class IS NOT NULL)
        SELECT cycle_id || '|seg-' || CAST(row_number() OVER (PARTITION BY cycle ORDER BY ord) AS VARCHAR) AS id, cycle_id, CAST(sum("end" - start) OVER (PARTITION BY cycle) AS BIGINT) AS cycle_length, "end" - start AS length, count(*) OVER (PARTITION BY cycle) AS segments, class, copy_count FROM r""",
    ),
    "cycle_factor_stats": (
        lambda s, d: T.cycle_factor_stats(genes(s, d).select((F.col("id") % 300).alias("cycle"), "chrom", "start", "end"), peaks(s, d).withColumn("factor", F.col("strand")), genes(s, d).filter("strand = '-'"))
        .select("cycle", "factor", "peaks", F.round("per_kb", 6).alias("per_kb"), F.round("repeat_percent", 6).alias("repeat_percent")),
        f"""{_AB}, z AS (SELECT id % 300 AS cycle, sum("end" - start) AS size FROM genes GROUP BY 1), h AS (SELECT DISTINCT g.id % 300 AS cycle, p.id, p.strand AS factor FROM peaks p JOIN genes g ON p.chrom = g.chrom AND p.start < g."end" AND g.start < p."end" AND p.start >= g.start AND p."end" <= g."end"),
        m AS (SELECT DISTINCT p.id FROM peaks p JOIN genes g ON p.chrom = g.chrom AND p.start < g."end" AND g.start < p."end" WHERE g.strand = '-')
        SELECT cycle, factor, count(*) AS peaks, round(count(*) * 1000.0::DOUBLE / max(size), 6) AS per_kb, round(count(m.id) * 100.0::DOUBLE / count(*), 6) AS repeat_percent FROM h JOIN z USING (cycle) LEFT JOIN m ON h.id = m.id GROUP BY cycle, factor""",
    ),
    "resolve_elements": (lambda s, d: T.resolve_elements(_elements(s, d), _segment_genes(s, d), ["SINE", "LINE", "LTR"]).select("segment", "id"), None),
    "best_overhang": (
        lambda s, d: A.best_overhang(_transcript_hits(s, d), ["qname"]),
        f"""{_P}, h AS (SELECT qname, CAST(id AS VARCHAR) AS transcript, CAST(id % 4 AS INT) AS rank, abs(score % 700 - 350) AS size, score % 700 - 350 AS overhang FROM peaks),
        l AS (SELECT qname, list({{'t': transcript, 'r': rank, 's': size, 'o': overhang}} ORDER BY transcript) AS x FROM h GROUP BY qname),
        b AS (SELECT qname, list_reduce(x, lambda a, b: CASE WHEN b.r < a.r OR b.s < a.s THEN b ELSE a END) AS b FROM l)
        SELECT qname, b.t AS transcript, ['whole', 'TTS', 'TSS', 'overlay'][b.r + 1] AS kind, b.o AS overhang FROM b""",
    ),
}

"""Registered queries of pooling: chains of blocks are the peaks of an order and line status on one chromosome and strand."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import pooling as P
from ..operators.stored import written
from .fixtures import PEAKS, peaks
from .interval_queries import _MERGE

#: Orders are dealt to so many genes.
GENES = 40


def _chains(s, d, status=None):
    p = peaks(s, d) if status is None else peaks(s, d).filter(F.col("status") == status)
    raw = p.groupBy("qname", "status", "chrom", "strand").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("blocks"))
    name = F.concat_ws(":", F.col("qname").cast("string"), "status", "chrom", "strand")
    gene = F.concat(F.lit("g"), (F.col("qname") % GENES).cast("string"))
    return raw.select(name.alias("id"), gene.alias("gene"), "chrom", "strand", P.union_blocks(F.col("blocks"), F.array().cast(P.BLOCKS)).alias("blocks"), F.array("status").alias("labels"), F.when(F.col("status") == "F", 0).otherwise(1).alias("rank"))


_NAME = "CAST(qname AS VARCHAR) || ':' || status || ':' || chrom || ':' || strand"
_CHAINS = f"""{PEAKS}, b AS MATERIALIZED (SELECT {_NAME} AS id, 'g' || CAST(qname % {GENES} AS VARCHAR) AS gene, status, chrom, strand, start, "end" FROM {_MERGE('peaks', 0, 'qname, status, chrom, strand')}),
    hit AS MATERIALIZED (SELECT DISTINCT x.id, y.id AS b_id, x.gene = y.gene AS same, x.status AS s1, y.status AS s2 FROM b x JOIN b y ON x.chrom = y.chrom AND x.strand = y.strand AND x.start < y."end" AND y.start < x."end" AND x.id <> y.id)"""
_REACH = """reach AS (SELECT id, b_id AS other FROM edge UNION SELECT b_id, id FROM edge UNION SELECT r.id, e.other FROM reach r JOIN (SELECT id, b_id AS other FROM edge UNION ALL SELECT b_id, id FROM edge) e ON e.id = r.other)"""
_WITH = f"WITH RECURSIVE {_CHAINS}"
_TEXT = "string_agg(CAST(start AS VARCHAR) || '-' || CAST(\"end\" AS VARCHAR), ',' ORDER BY start) AS blocks"
_MAX = 150


def _shown(df):
    text = F.array_join(F.transform("blocks", lambda b: F.concat(b["start"].cast("string"), F.lit("-"), b["end"].cast("string"))), ",")
    return df.withColumn("blocks", text)


def _two(mode):
    def run(s, d):
        chains = written(_chains(s, d), "chains")
        return _shown(P.pool_groups(*(chains.filter(F.col("labels")[0] == x) for x in "FO"), mode, 5, _MAX if mode == "mergeGroup" else 10**9))

    return run


def _many(chains):
    sets = [chains.filter((F.col("labels")[0] == x) & (F.col("strand") == y)).withColumn("strand", F.lit("+")) for x, y in (("F", "+"), ("O", "+"), ("F", "-"))]
    return _shown(P.pool_many_sets(sets, 5, 300)).select("gene", "chrom", "strand", "blocks", "rank")


_PAIRED = f"""{_WITH}, edge AS MATERIALIZED (SELECT id, b_id FROM hit WHERE same AND s1 = 'F' AND s2 = 'O'), {_REACH}, grp AS MATERIALIZED (SELECT id, least(id, min(other)) AS g FROM reach GROUP BY id),
    lone AS (SELECT b.id, gene, chrom, strand, lower(replace(replace(status, 'F', 'a'), 'O', 'b')) AS labels, start, "end" FROM b WHERE id NOT IN (SELECT id FROM hit WHERE s1 <> s2)),
    alone AS (SELECT gene, chrom, strand, labels, {_TEXT}, sum("end" - start) AS n FROM lone GROUP BY id, gene, chrom, strand, labels)"""
_OUT = "SELECT gene, chrom, strand, blocks, labels FROM (SELECT gene, chrom, strand, blocks, labels, n FROM pooled UNION ALL SELECT gene, chrom, strand, blocks, labels, n FROM alone) WHERE n >= 5"

QUERIES = {
    "overlap_edge_groups": (
        lambda s, d: P.separate_overlapping(_chains(s, d)).select("id", "group"),
        f"""{_WITH}, edge AS MATERIALIZED (SELECT id, b_id FROM hit WHERE same AND id < b_id), {_REACH}, grp AS (SELECT id, least(id, min(other)) AS "group" FROM reach GROUP BY id)
        SELECT c.id, "group" FROM (SELECT DISTINCT id FROM b) c LEFT JOIN grp USING (id)""",
    ),
    "pool_merge_groups": (
        _two("mergeGroup"),
        f"""{_PAIRED}, gb AS (SELECT grp.g, gene, chrom, strand, start, "end" FROM grp JOIN b USING (id)), gm AS {_MERGE('gb', 0, 'g, gene, chrom, strand')}, whole AS (SELECT g, gene, chrom, strand, {_TEXT}, sum("end" - start) AS n FROM gm GROUP BY g, gene, chrom, strand),
        pb AS (SELECT e.id || '+' || e.b_id AS pair, gene, chrom, strand, start, "end" FROM edge e JOIN grp ON grp.id = e.id JOIN b ON b.id IN (e.id, e.b_id) WHERE grp.g IN (SELECT g FROM whole WHERE n > {_MAX})), pm AS {_MERGE('pb', 0, 'pair, gene, chrom, strand')},
        pairs AS (SELECT gene, chrom, strand, {_TEXT}, sum("end" - start) AS n FROM pm GROUP BY pair, gene, chrom, strand),
        pooled AS (SELECT gene, chrom, strand, blocks, 'a,b' AS labels, n FROM whole WHERE n <= {_MAX} UNION ALL SELECT gene, chrom, strand, blocks, 'a,b', n FROM pairs) {_OUT} AND n <= {_MAX}""",
    ),
    "pool_intersect_groups": (
        _two("intersectGroup"),
        f"""{_PAIRED}, ib AS (SELECT grp.g, x.gene, x.chrom, x.strand, greatest(x.start, y.start) AS start, least(x."end", y."end") AS "end" FROM edge e JOIN grp ON grp.id = e.id JOIN b x ON x.id = e.id JOIN b y ON y.id = e.b_id WHERE x.start < y."end" AND y.start < x."end"),
        im AS {_MERGE('ib', 0, 'g, gene, chrom, strand')}, pooled AS (SELECT gene, chrom, strand, {_TEXT}, 'a,b' AS labels, sum("end" - start) AS n FROM im GROUP BY g, gene, chrom, strand) {_OUT}""",
    ),
    # The next two depend on an order inside a peak; tests/test_pooling.py has plain loops.
    "pool_peaks": (lambda s, d: _shown(P.pool_peaks(_chains(s, d, "F"), _chains(s, d, "O"), 5, 300)).select("gene", "chrom", "strand", "blocks", F.array_join("labels", ",").alias("labels"), "rank"), None),
    "pool_many_sets": (
        lambda s, d: _many(written(_chains(s, d), "chains")),  # read for every set
        None,
    ),
}

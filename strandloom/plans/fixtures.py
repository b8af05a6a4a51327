"""Genomic tables derived from the given tables by arithmetic that SQL repeats word for word."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.intervals import tile_hits
from ..operators.stored import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peaks: id, chrom, start, end, strand, score, pvalue, qname.

    Lines are dealt by their order: that serves the window below and whatever groups peaks by qname, so neither moves them again.
    """
    li = table(spark, sf_dir, "lineitem").repartition("l_orderkey")
    w = W.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    one = li.withColumn("rn", F.row_number().over(w)).filter("rn = 1")
    start = F.col("l_partkey") * 37 + F.col("l_linenumber") * 11
    return one.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.concat(F.lit("chr"), (F.col("l_suppkey") % 5).cast("string")).alias("chrom"),
        start.alias("start"),
        (start + F.col("l_quantity").cast("long")).alias("end"),
        F.when(F.col("l_returnflag") == "R", "-").otherwise("+").alias("strand"),
        F.round("l_extendedprice").cast("long").alias("score"),
        F.col("l_discount").alias("pvalue"),
        F.col("l_orderkey").alias("qname"),
        F.col("l_linestatus").alias("status"),
    )


PEAKS = """peaks AS (SELECT l_orderkey * 10 + l_linenumber AS id, 'chr' || CAST(l_suppkey % 5 AS VARCHAR) AS chrom,
    l_partkey * 37 + l_linenumber * 11 AS start, l_partkey * 37 + l_linenumber * 11 + CAST(l_quantity AS BIGINT) AS "end",
    CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS strand, CAST(round(l_extendedprice) AS BIGINT) AS score, l_discount AS pvalue, l_orderkey AS qname, l_linestatus AS status
    FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice, l_shipdate) = 1)"""


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes: id, chrom, start, end, strand, gene, class."""
    p = table(spark, sf_dir, "part")
    start = F.col("p_partkey") * 41
    return p.select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("chr"), (F.col("p_partkey") % 5).cast("string")).alias("chrom"),
        start.alias("start"),
        (start + F.col("p_size") * 5).alias("end"),
        F.when(F.col("p_size") % 3 == 0, "-").otherwise("+").alias("strand"),
        F.col("p_brand").alias("gene"),
        F.col("p_type").alias("class"),
    )


GENES = """genes AS (SELECT p_partkey AS id, 'chr' || CAST(p_partkey % 5 AS VARCHAR) AS chrom, p_partkey * 41 AS start,
    p_partkey * 41 + p_size * 5 AS "end", CASE WHEN p_size % 3 = 0 THEN '-' ELSE '+' END AS strand, p_brand AS gene, p_type AS class FROM part)"""


def sizes(spark: SparkSession, sf_dir: str, known: DataFrame | None = None) -> DataFrame:
    """Chromosome lengths: one row per chromosome; ``known`` are the peaks if they are there already."""
    both = (peaks(spark, sf_dir) if known is None else known).select("chrom", "end").unionByName(genes(spark, sf_dir).select("chrom", "end"))
    return both.groupBy("chrom").agg((F.max("end") + 1000).alias("length"))


SIZES = """sizes AS (SELECT chrom, max("end") + 1000 AS length FROM (SELECT chrom, "end" FROM peaks UNION ALL SELECT chrom, "end" FROM genes) GROUP BY chrom)"""


def windows(spark: SparkSession, sf_dir: str, width: int, hits: dict | None = None) -> DataFrame:
    """Windows over the chromosomes with the peaks they meet, as ``tile_hits``; lengths and counts share peaks that are derived once."""
    p = written(peaks(spark, sf_dir).select("chrom", "start", "end", "strand"), "peaks")
    return tile_hits(sizes(spark, sf_dir, p), p, width, hits)


def transcripts(spark: SparkSession, sf_dir: str, known: DataFrame | None = None) -> DataFrame:
    """Transcripts with blocks: the merged peaks of an order on one chromosome and strand; ``known`` are the peaks if they are there already."""
    p = peaks(spark, sf_dir) if known is None else known
    block = F.array_sort(F.collect_set(F.struct("start", "end")))
    out = p.groupBy("qname", "chrom", "strand").agg(F.min("start").alias("start"), F.max("end").alias("end"), block.alias("blocks"))
    return out.withColumn("id", F.concat_ws(":", F.col("qname").cast("string"), "chrom", "strand"))


TRANSCRIPTS = """transcripts AS (SELECT CAST(qname AS VARCHAR) || ':' || chrom || ':' || strand AS id, qname, chrom, strand, min(start) AS start, max("end") AS "end",
    list_sort(list_distinct(list({'start': start, 'end': "end"}))) AS blocks FROM peaks GROUP BY qname, chrom, strand)"""


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long matrix: id (user), sample (event type), value (mean)."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("user_id").alias("id"), F.col("event_type").alias("sample")).agg((F.sum(F.round(F.col("value") * 100).cast("long")) / F.count("*") / 100).alias("value"), F.count("*").alias("count"))


MATRIX = "matrix AS (SELECT user_id AS id, event_type AS sample, sum(CAST(round(value * 100) AS BIGINT)) / CAST(count(*) AS DOUBLE) / 100 AS value, count(*) AS count FROM events GROUP BY ALL)"


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Methylation calls: read, chrom, pos (1-based), strand, meth, context."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("read"),
        F.concat(F.lit("chr"), (F.col("event_id") % 3).cast("string")).alias("chrom"),
        (F.col("event_id") % 997 + 1).alias("pos"),
        F.when(F.col("event_id") % 2 == 0, "+").otherwise("-").alias("strand"),
        (F.col("event_id") % 3 == 0).alias("meth"),
        F.element_at(F.array(*map(F.lit, ("CG", "CHG", "CHH"))), (F.col("event_id") % 7 % 3 + 1).cast("int")).alias("context"),
        F.floor(F.col("value")).cast("long").alias("read_pos"),
    )


CALLS = """calls AS (SELECT user_id AS read, 'chr' || CAST(event_id % 3 AS VARCHAR) AS chrom, event_id % 997 + 1 AS pos,
    CASE WHEN event_id % 2 = 0 THEN '+' ELSE '-' END AS strand, event_id % 3 = 0 AS meth, ['CG', 'CHG', 'CHH'][CAST(event_id % 7 % 3 + 1 AS INT)] AS context,
    CAST(floor(value) AS BIGINT) AS read_pos FROM events)"""


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences: id, seq over ACGTN, from the whole texts."""
    d = table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    letters = "abcdefghijklmnopqrstuvwxyz"
    plain = F.regexp_replace(F.translate(F.lower("text"), letters, ("ACGT" * 7)[:26]), "[^ACGT]", "N")
    return d.select(F.col("doc_id").alias("id"), plain.alias("seq"))


SEQUENCES = """sequences AS (SELECT doc_id AS id, regexp_replace(translate(lower(text), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC'), '[^ACGT]', 'N', 'g') AS seq
    FROM documents WHERE text IS NOT NULL)"""

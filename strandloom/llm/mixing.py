"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Every document, in a seeded shuffle of its source, gets a virtual finish time: the source's words up to
and including it, divided by the source's target. The global order by finish time is the mix; it is cut
where the words so far reach the total budget. A second pass over a source continues its queue, so a
document can be taken twice.

Running sums never put a source, or everything, into one task: a source is cut into about sqrt(n) ranges
of the shuffle key, the mix into about sqrt(n) ranges of the finish time; sums per range are carried
over as a small table and only rows inside a range are ordered together.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import free_name, table, words, written

SEED = "mix-1"
WEIGHTS = (5, 2, 1)
PERCENT = 150
REPEATS = 2


def shuffle_key(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """32 hex digits that order documents at random, the same in every run; texts of one id are spread too."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))


def source_targets(sizes: DataFrame, weights=WEIGHTS, percent: int = PERCENT, repeats: int = REPEATS) -> DataFrame:
    """One row per source: source, weight, source_size, target, total.

    Sources by code point (null last) take the weights in turn and share ``percent`` of all sizes by
    weight; a target stops at ``repeats`` times its source's size and the excess goes to the others by
    weight until none is above. The table has a row per source: a dimension, not a table that grows with
    the documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("long"))
    per = per.withColumn("cap", F.col("source_size") * repeats)
    all_ = W.partitionBy()
    per = per.withColumns({"total": F.sum("source_size").over(all_), "all_weight": F.sum("weight").over(all_)})
    # Sources fill up in the order of cap / weight. Level that the others would get after the first k fill up:
    by_ratio = W.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    per = per.withColumns(
        {
            "before": F.coalesce(F.sum("cap").over(by_ratio), F.lit(0)),
            "left_weight": F.col("all_weight") - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0)),
        }
    )
    budget = F.col("total") * F.lit(percent) / F.lit(100)
    per = per.withColumn("full", F.col("cap") * F.col("left_weight") <= (budget - F.col("before")) * F.col("weight"))
    per = per.withColumns(
        {
            "full_cap": F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(all_),
            "full_weight": F.sum(F.when(F.col("full"), F.col("weight")).otherwise(0)).over(all_),
        }
    )
    share = F.try_divide((budget - F.col("full_cap")) * F.col("weight"), F.col("all_weight") - F.col("full_weight"))
    return per.select("source", "weight", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share).alias("target"), "total")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", size: Column | None = None, weights=WEIGHTS, percent: int = PERCENT, repeats: int = REPEATS, seed: str = SEED, keep=()) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken, finish; and ``keep``.

    ``size`` is the number of words unless given (null text: 0). ``copies`` says how often the document
    is in the mix (0 to ``repeats``), ``taken`` is copies times size, ``finish`` the virtual finish time
    of its first copy. Documents of size 0 are never taken. Null sources are a source of their own, the
    last. Rows that repeat a doc_id queue as documents of their own; rows that are equal in id and text
    are interchangeable. An empty table gives an empty result. Columns in ``keep`` must not have a
    result column's name.
    """
    n = docs.count()
    pieces = max(1, math.isqrt(max(n, 1)))
    if size is None:
        size = F.size(words(F.col(text)))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.coalesce(size, F.lit(0)).cast("long").alias("size"), shuffle_key(F.col(doc_id), F.col(text), seed).alias("_key"), *keep)
    rows = rows.withColumn("_part", (F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * pieces / F.lit(1 << 32)).cast("long"))
    # All that follows until the last step works on this narrow table; with ``keep`` the last step reads the texts again.
    slim = written(rows.drop(*keep), "mix")
    targets = source_targets(slim, weights, percent, repeats)
    # Words of the source before each range of the shuffle key.
    ranges = slim.groupBy("source", "_part").agg(F.sum("size").alias("_sum"))
    before = W.partitionBy("source").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    ranges = _join_null_safe(ranges, targets, ["source"])
    inside = W.partitionBy("source", "_part").orderBy("_key", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    open_ = (F.col("size") > 0) & (F.col("target") > 0)
    finish = lambda k: F.try_divide((F.col("_cum") + k * F.col("source_size")).cast("double"), F.col("target"))

    def queued(df):
        return _join_null_safe(df, ranges, ["source", "_part"]).withColumn("_cum", F.col("_before") + F.sum("size").over(inside))

    # The mix has an entry per pass over a source. Where does the budget end?
    slot = lambda at: F.floor(F.least(at, F.lit(1e6)) * pieces)
    passes = F.explode(F.array(*(F.struct(F.lit(k).alias("pass"), finish(k).alias("at")) for k in range(repeats))))
    entries = queued(slim).filter(open_).select("_key", "doc_id", "size", "total", passes.alias("e")).select("_key", "doc_id", "size", "total", "e.*")
    entries = entries.withColumn("_slot", slot(F.col("at")))
    limit = F.col("total") * F.lit(percent) / F.lit(100)
    slots = entries.groupBy("_slot").agg(F.sum("size").alias("_sum"), F.max("total").alias("total"))
    slots = slots.withColumn("_upto", F.sum("_sum").over(W.orderBy("_slot").rowsBetween(W.unboundedPreceding, 0)))
    edge = slots.filter(F.col("_upto") > limit).agg(F.min_by(F.struct("_slot", (F.col("_upto") - F.col("_sum")).alias("_start")), "_slot").alias("x")).select("x.*")
    # The one range that holds the end of the budget is ordered in full (about 1/sqrt(n) of the entries).
    in_last = W.partitionBy("_slot").orderBy("at", "_key", "doc_id", "size", "pass").rowsBetween(W.unboundedPreceding, 0)
    last = entries.join(F.broadcast(edge), "_slot").withColumn("_run", F.col("_start") + F.sum("size").over(in_last))
    cut = last.filter(F.col("_run") <= limit).agg(F.max(F.struct("at", "_key", "doc_id", "size", "pass")).alias("cut"))
    cut = cut.join(F.broadcast(edge.select(F.col("_slot").alias("_edge"))), F.lit(True), "left")
    rows = queued(rows if keep else slim).join(F.broadcast(cut), F.lit(True), "left")  # one row

    def inside_budget(k):
        early = F.col("_edge").isNull() | (slot(finish(k)) < F.col("_edge"))
        upto = F.struct(finish(k).alias("at"), F.col("_key"), F.col("doc_id"), F.col("size"), F.lit(k).alias("pass")) <= F.col("cut")
        return F.when(open_ & (early | F.coalesce(upto, F.lit(False))), 1).otherwise(0)

    copies = inside_budget(0)
    for k in range(1, repeats):
        copies = copies + inside_budget(k)
    out = rows.withColumns({"copies": copies.cast("int"), "finish": F.when(open_, finish(0))})
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "finish", *keep)


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys that may be null; the keys of ``left`` are kept."""
    r = right.select(*(F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns))
    on = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        on = one if on is None else on & one
    return left.join(r, on).drop(*(f"_r_{k}" for k in keys))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken; columns stay as they are.

    Null and empty texts have no words and are never taken; null sources, repeated rows and empty tables are
    handled as in ``mix``.
    """
    whole = docs.withColumn(row := free_name(docs, "_doc"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)))
    taken = mix(whole, doc_id, text, source, keep=(row,), **options).filter("copies > 0")
    return taken.select(F.explode(F.array_repeat(row, F.col("copies"))).alias("d")).select("d.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2 * CAST(sum(size) AS BIGINT) AS cap FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight FROM s),
t AS (SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total, CAST(sum(weight) OVER () AS BIGINT) AS all_weight,
    CAST(coalesce(sum(cap) OVER o, 0) AS BIGINT) AS before, CAST(sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS BIGINT) AS left_weight
    FROM w WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
u AS (SELECT *, cap * left_weight <= (total * 150 / CAST(100 AS DOUBLE) - before) * weight AS full_ FROM t),
v AS (SELECT *, CAST(sum(CASE WHEN full_ THEN cap ELSE 0 END) OVER () AS BIGINT) AS full_cap,
    CAST(sum(CASE WHEN full_ THEN weight ELSE 0 END) OVER () AS BIGINT) AS full_weight FROM u),
g AS (SELECT source, source_size, total, CASE WHEN full_ THEN CAST(cap AS DOUBLE)
    ELSE (total * 150 / CAST(100 AS DOUBLE) - full_cap) * weight / (all_weight - full_weight) END AS target FROM v),
q AS (SELECT d.*, g.source_size, g.total, g.target,
    CAST(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum
    FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
e AS (SELECT doc_id, size, k, total, 0 AS pass, cum / target AS fin FROM q WHERE size > 0
    UNION ALL SELECT doc_id, size, k, total, 1, (cum + source_size) / target FROM q WHERE size > 0),
r AS (SELECT *, sum(size) OVER (ORDER BY fin, k, doc_id, size, pass ROWS UNBOUNDED PRECEDING) AS run FROM e),
c AS (SELECT doc_id, size, k, count(*) AS n FROM r WHERE run <= total * 150 / CAST(100 AS DOUBLE) GROUP BY ALL)
SELECT q.doc_id, CAST(q.size AS BIGINT) AS size, q.source_size, CAST(CASE WHEN q.total = 0 THEN 0 ELSE q.target END AS DOUBLE) AS target,
    CAST(coalesce(c.n, 0) * q.size AS BIGINT) AS taken FROM q LEFT JOIN c ON q.doc_id = c.doc_id AND q.size = c.size AND q.k = c.k"""

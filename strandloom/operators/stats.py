"""Statistics over tables: multiple testing, exact tests, enrichment, survival."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import scans


def bh_adjust(df: DataFrame, p: str = "p", by: list[str] | None = None) -> DataFrame:
    """``df`` with ``padj``, Benjamini-Hochberg; null p values stay null and do not count.

    A global order is not one task, and neither is a value that many rows share: distinct values with their counts are cut
    into ranges, ranks and running minima are carried over between ranges, and rows get the value of their p by a join.
    """
    by = by or []
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_by{i}") for i, c in enumerate(by)]
    names = [f"_by{i}" for i in range(len(by))]
    rows = df.select("*", *keys)
    known = rows.filter(F.col(p).isNotNull()).groupBy(*names, F.col(p).cast("double").alias("_p")).agg(F.count("*").alias("_k"))
    cells = scans.in_ranges(known, names, [F.col("_p").asc()])
    order = W.partitionBy(*names).orderBy("_cell")
    per = cells.groupBy(*names, "_cell").agg(F.sum("_k").alias("_k"))
    per = per.select(*names, "_cell", F.coalesce(F.sum("_k").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_k").over(W.partitionBy(*names)).alias("_n"))
    inside = W.partitionBy(*names, "_cell").orderBy("_p")
    rank = F.col("_before") + F.sum("_k").over(inside.rowsBetween(W.unboundedPreceding, 0))  # the last rank of equal values
    raw = cells.join(per, [*names, "_cell"]).withColumn("_raw", F.col("_p") * F.col("_n") / rank)
    later = raw.groupBy(*names, "_cell").agg(F.min("_raw").alias("_least"))
    later = later.select(*names, "_cell", F.min("_least").over(order.rowsBetween(1, W.unboundedFollowing)).alias("_later"))
    here = F.min("_raw").over(inside.rowsBetween(0, W.unboundedFollowing))
    adjusted = raw.withColumn("_here", here).join(later, [*names, "_cell"]).select(*names, "_p", F.least(F.lit(1.0), F.col("_here"), F.coalesce("_later", F.lit(1.0))).alias("padj"))
    return rows.withColumn("_p", F.col(p).cast("double")).join(adjusted, [*names, "_p"], "left").select(*df.columns, "padj")


_LGAMMA = np.vectorize(math.lgamma, otypes=[float])


def _log_choose(n, k):
    return _LGAMMA(n + 1.0) - _LGAMMA(k + 1.0) - _LGAMMA(n - k + 1.0)


def _near_mode(low: int, high: int, hits: int, drawn: int, n: int) -> tuple[int, int]:
    """The part of the support of a hypergeometric variable outside which no term reaches 1e-300."""
    mode = hits * drawn / max(n, 1)
    spread = math.sqrt(max(mode * (1 - hits / max(n, 1)) * (n - drawn) / max(n - 1, 1), 0.0))
    reach = int(60 * spread) + 400
    return max(low, int(mode) - reach), min(high, int(mode) + reach)


def _fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    n, row, col = a + b + c + d, a + b, a + c
    log_p = lambda k: _log_choose(col, k) + _log_choose(n - col, row - k) - _log_choose(n, row)
    low, high = _near_mode(max(0, row + col - n), min(row, col), row, col, n)
    at = log_p(np.array([a]))[0]
    terms = log_p(np.arange(low, high + 1))
    return float(min(1.0, np.exp(terms[terms <= at + 1e-7]).sum()))


@F.pandas_udf(T.DoubleType())
def fisher_exact(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    """Two-sided Fisher test of the table ((a, b), (c, d)); null where a cell is null or negative."""
    ok = pd.concat([a, b, c, d], axis=1).notna().all(axis=1) & (pd.concat([a, b, c, d], axis=1).min(axis=1) >= 0)
    cells = zip(a.fillna(0).astype(int), b.fillna(0).astype(int), c.fillna(0).astype(int), d.fillna(0).astype(int), ok)
    return pd.Series([_fisher_two_sided(*x[:4]) if x[4] else None for x in cells], index=a.index, dtype=float)


@F.pandas_udf(T.DoubleType())
def hypergeometric_tail(k: pd.Series, universe: pd.Series, hits: pd.Series, drawn: pd.Series) -> pd.Series:
    """P(X >= k) when ``drawn`` of ``universe`` are drawn and ``hits`` of them are marked."""
    out = []
    for x, n, m, r in zip(k.astype(int), universe.astype(int), hits.astype(int), drawn.astype(int)):
        low, high = _near_mode(max(0, m + r - n), min(m, r), m, r, n)
        j = np.arange(max(x, low), high + 1)
        out.append(float(min(1.0, np.exp(_log_choose(m, j) + _log_choose(n - m, r - j) - _log_choose(n, r)).sum())) if len(j) else 0.0)
    return pd.Series(out, index=k.index, dtype=float)


def _beta_fraction(a: float, b: float, x: float) -> float:
    tiny, c = 1e-300, 1.0
    d = 1.0 / max(1.0 - (a + b) * x / (a + 1.0), tiny)
    h = d
    for m in range(1, 300):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 / (1.0 + step * d or tiny)
            c = 1.0 + step / c or tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-14:
            break
    return h


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1.0 - front * _beta_fraction(b, a, 1 - x) / b


@F.pandas_udf(T.DoubleType())
def correlation_p(r: pd.Series, n: pd.Series) -> pd.Series:
    """Two-sided p of a correlation of n points by the t distribution; null below 3 points."""
    out = []
    for x, k in zip(r, n):
        if k is None or k < 3 or x is None or x != x:
            out.append(None)
        elif abs(x) >= 1:
            out.append(0.0)
        else:
            df = k - 2
            t2 = x * x * df / (1 - x * x)
            out.append(incomplete_beta(df / 2, 0.5, df / (df + t2)))
    return pd.Series(out, index=r.index, dtype=float)


@F.pandas_udf(T.DoubleType())
def chi_square_p(x: pd.Series) -> pd.Series:
    """Upper tail of the chi-square distribution with one degree of freedom."""
    return x.map(lambda v: None if v is None or v != v else math.erfc(math.sqrt(max(v, 0.0) / 2)))


def over_representation(genes: DataFrame, sets: DataFrame, universe: DataFrame, min_size: int = 1, max_size: int = 10**9, max_p: float = 1.0, max_padj: float = 1.0) -> DataFrame:
    """Gene sets that hold more of ``genes`` than chance: set, k, size, p, padj, up to both cutoffs. All gene columns: gene."""
    world = universe.select("gene").distinct()
    members = sets.select("set", "gene").distinct().join(world, "gene", "left_semi")
    chosen = genes.select("gene").distinct().join(world, "gene", "left_semi").withColumn("hit", F.lit(1))
    per = members.join(chosen, "gene", "left").groupBy("set").agg(F.count("hit").alias("k"), F.count("*").alias("size"))
    per = per.filter((F.col("size") >= min_size) & (F.col("size") <= max_size) & (F.col("k") > 0))
    totals = world.agg(F.count("*").alias("n")).join(chosen.agg(F.count("*").alias("drawn")), F.lit(True))  # one row
    per = per.join(F.broadcast(totals), F.lit(True))
    out = bh_adjust(per.withColumn("p", hypergeometric_tail("k", "n", "size", "drawn"))).drop("n", "drawn")
    return out.filter((F.col("p") <= max_p) & (F.col("padj") <= max_padj))


def gsea(ranked: DataFrame, sets: DataFrame, permutations: int = 100, seed: int = 1) -> DataFrame:
    """Running-sum enrichment: set, size, es, p. ``ranked``: gene, score; ``sets``: set, gene.

    Only the members of a set are ordered, per set: with r the position of a hit and H the sum of its
    scores so far, the running sum before and after each hit is H - (r - hits) / (N - size). Permutations
    give each gene a random position per seed; the p value is the share of permuted scores at least as
    extreme on the same side.
    """
    n = ranked.agg(F.count("*").alias("n"))  # one row
    # Both orders are carried scans: a task orders a stretch of scores, or of random numbers, not all genes.
    placed = scans.numbered(ranked.withColumn("_o", -F.col("score")), [], "_o", ["gene"], 0.01)
    placed = placed.select("gene", F.abs("score").alias("weight"), (F.col("_idx") + 1).alias("pos"))
    perms = placed.select("gene", F.explode(F.sequence(F.lit(1), F.lit(permutations))).alias("perm"))
    random = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("perm").cast("string"), F.col("gene").cast("string"))), 1, 15), 16, 10).cast("long")
    perms = scans.numbered(perms.withColumn("_o", random), ["perm"], "_o", ["gene"], 1 << 50).select("gene", "perm", (F.col("_idx") + 1).alias("at"))
    every = placed.select("gene", F.lit(0).alias("perm"), F.col("pos").alias("at")).unionByName(perms)
    weights = placed.select(F.col("pos").alias("at"), F.col("weight").alias("w"))
    hits = sets.select("set", "gene").distinct().join(every.select("gene", "perm", "at"), "gene").join(weights, "at")
    whole = hits.groupBy("set", "perm").agg(F.count("*").alias("size"), F.sum("w").alias("total"))
    hits = hits.join(whole, ["set", "perm"]).join(F.broadcast(n), F.lit(True))
    w = W.partitionBy("set", "perm").orderBy("at")
    up = F.sum("w").over(w.rowsBetween(W.unboundedPreceding, 0)) / F.col("total")
    miss = (F.col("at") - F.row_number().over(w)) / F.greatest(F.col("n") - F.col("size"), F.lit(1))
    hits = hits.withColumns({"after": up - miss, "before": up - F.col("w") / F.col("total") - miss})
    per = hits.groupBy("set", "perm", "size").agg(F.max("after").alias("top"), F.min("before").alias("low"))
    per = per.withColumn("es", F.when(F.col("top") >= -F.col("low"), F.col("top")).otherwise(F.col("low")))
    real = per.filter("perm = 0").select("set", "size", "es")
    null = per.filter("perm > 0").select("set", F.col("es").alias("e"))
    tested = real.join(null, "set", "left").groupBy("set", "size", "es")
    same = F.signum("e") == F.signum("es")
    return tested.agg(((F.count(F.when(same & (F.abs("e") >= F.abs("es")), 1)) + 1) / (F.count(F.when(same, 1)) + 1)).alias("p"))


def kaplan_meier(df: DataFrame, time: str, event: str, group: str) -> DataFrame:
    """Survival curve per group: time, at_risk, events, survival. Ordered per group over distinct times."""
    per = df.groupBy(group, time).agg(F.sum(F.col(event).cast("int")).alias("events"), F.count("*").alias("leaving"))
    w = W.partitionBy(group).orderBy(time)
    per = per.withColumn("at_risk", F.sum("leaving").over(W.partitionBy(group).orderBy(F.desc(time)).rowsBetween(W.unboundedPreceding, 0)))
    keep = F.when(F.col("events") == F.col("at_risk"), F.lit(float("-inf"))).otherwise(F.log(1 - F.col("events") / F.col("at_risk")))
    return per.withColumn("survival", F.exp(F.sum(keep).over(w.rowsBetween(W.unboundedPreceding, 0)))).drop("leaving")


def log_rank(df: DataFrame, time: str, event: str, group: str, first, second) -> DataFrame:
    """Log-rank test of two groups: observed and expected events of the first, chi-square, p."""
    both = df.filter(F.col(group).isin(first, second)).withColumn("g", (F.col(group) == F.lit(first)).cast("int"))
    per = both.groupBy(time).agg(F.sum(F.col(event).cast("int")).alias("d"), F.sum(F.col(event).cast("int") * F.col("g")).alias("d1"), F.count("*").alias("c"), F.sum("g").alias("c1"))
    w = W.orderBy(F.desc(time)).rowsBetween(W.unboundedPreceding, 0)  # a row per distinct time
    per = per.withColumns({"n": F.sum("c").over(w), "n1": F.sum("c1").over(w)})
    expected = F.col("d") * F.col("n1") / F.col("n")
    var = F.when(F.col("n") > 1, F.col("d") * (F.col("n1") / F.col("n")) * (1 - F.col("n1") / F.col("n")) * (F.col("n") - F.col("d")) / F.when(F.col("n") > 1, F.col("n") - 1)).otherwise(0.0)
    out = per.agg(F.sum("d1").alias("observed"), F.sum(expected).alias("expected"), F.sum(var).alias("variance"))
    out = out.withColumn("chi2", F.try_divide((F.col("observed") - F.col("expected")) ** 2, "variance"))
    return out.withColumn("p", chi_square_p("chi2"))


def volcano_class(fc: Column, p: Column, min_fc: float, max_p: float) -> Column:
    big, sig = F.abs(fc) >= min_fc, F.coalesce(p, F.lit(1.0)) <= max_p
    return F.when(big & sig, "both").when(big, "fc").when(sig, "p").otherwise("ns")


def significant(res: DataFrame, padj: float = 0.05, fc: float = 0.0, p: float = 1.0) -> DataFrame:
    """Rows below both cutoffs of padj and p, with at least the fold change; nulls fail. Ordered by p."""
    return res.filter((F.col("padj") < padj) & (F.col("p") < p) & (F.abs("log2fc") >= fc)).orderBy("p")


def p_histogram(res: DataFrame, mean: str = "mean", bins: int = 20, least: float = 1.0) -> DataFrame:
    """Counts of p values of rows with a mean above ``least`` in equal bins of [0, 1], closed on the right; 0 is in the first.

    Rows with a null p or mean are left out.
    """
    slot = F.greatest(F.ceil(F.col("p") * bins) - 1, F.lit(0))
    return res.filter(F.col("p").isNotNull() & (F.col(mean) > least)).groupBy(slot.alias("bin")).agg(F.count("*").alias("n"))


def binned_small_p(res: DataFrame, mean: str, p: str = "p", parts: int = 6, cut: float = 0.05) -> DataFrame:
    """Share of p < cut, null p aside, in bins of the mean, closed on the right: up to the least positive mean, then by sixths.

    Edges are 0 and the quantiles of the positive means in ``parts`` parts; rows without a positive mean are in no bin.
    """
    edges = res.filter(F.col(mean) > 0).agg(F.percentile(mean, F.array(*(F.lit(i / parts) for i in range(parts)))).alias("edges"))  # one row
    slot = F.size(F.filter("edges", lambda e: e < F.col(mean)))
    return res.filter(F.col(mean) > 0).join(F.broadcast(edges), F.lit(True)).groupBy(slot.alias("bin")).agg(F.avg((F.col(p) < cut).cast("double")).alias("share"), F.count("*").alias("n"))


def rank_sum(df: DataFrame, group: str, value: str, first, second) -> DataFrame:
    """Wilcoxon rank-sum of two groups: n1, n2, U of the first, normal z (ties averaged)."""
    both = df.filter(F.col(group).isin(first, second))
    counts = both.groupBy(value).agg(F.count("*").alias("c"), F.count(F.when(F.col(group) == F.lit(first), 1)).alias("c1"))
    # Distinct values are cut into ranges, ranks are carried over between them.
    cells = scans.carried(scans.in_ranges(counts, [], [F.col(value).asc()]), [], {"_before": (F.sum, "c")})
    w = scans.inside([], value).rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce("_before", F.lit(0)) + F.coalesce(F.sum("c").over(w), F.lit(0))
    s = cells.withColumn("rank", before + (F.col("c") + 1) / 2.0).agg(F.sum("c1").alias("n1"), (F.sum("c") - F.sum("c1")).alias("n2"), F.sum(F.col("rank") * F.col("c1")).alias("r1"))
    u = F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2.0
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")  # products of three counts leave the longs from 2 million rows on
    z = F.try_divide(F.col("u") - n1 * n2 / 2.0, F.sqrt(n1 * n2 * (n1 + n2 + 1) / 12.0))
    return s.withColumn("u", u).select("n1", "n2", "u", z.alias("z"))

"""Feature x sample matrices, kept long (id, sample, value) inside and wide only at the edges."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import scans

#: Features of a block; the pairs of two blocks are one batch of results.
BLOCK = 512
#: Parts of the features, and the most values of a part; a feature moves once per part.
PARTS = 16
PART_VALUES = 1 << 22


def to_long(wide: DataFrame, ids: list[str], variable: str = "sample", value: str = "value") -> DataFrame:
    return wide.unpivot(ids, [c for c in wide.columns if c not in ids], variable, value)


def attach_design(long: DataFrame, design: DataFrame, key: str = "sample") -> DataFrame:
    """Rows with the factor columns of their sample; samples without a design row are dropped."""
    return long.join(design, key)


def to_wide(long: DataFrame, samples: list[str], value: str = "value", fill: float | None = None, id: str = "id", sample: str = "sample") -> DataFrame:
    """One column per stated sample; the first value of a cell counts."""
    out = long.groupBy(id).pivot(sample, samples).agg(F.first(value, ignorenulls=True))
    return out.fillna(fill, samples) if fill is not None else out


def expression_matrix(long: DataFrame, samples: list[str], value: str = "value", cqv: str | None = None) -> DataFrame:
    """id, a column per sample and, with ``cqv``, a column ``<sample>_CQV`` per sample behind them; the first value of a cell counts."""
    named = [F.first(value, ignorenulls=True).alias("v"), *([F.first(cqv, ignorenulls=True).alias("q")] if cqv else [])]
    out = long.groupBy("id").pivot("sample", samples).agg(*named)
    if not cqv:
        return out
    return out.select("id", *(F.col(f"{s}_v").alias(s) for s in samples), *(F.col(f"{s}_q").alias(f"{s}_CQV") for s in samples))


def filter_prevalence(long: DataFrame, min_count: float, n_samples: int, value: str = "value") -> DataFrame:
    """Features above ``min_count`` in at least half of the samples; halves round to the even number (5 samples: 2)."""
    need = round(n_samples / 2)
    keep = long.groupBy("id").agg(F.count(F.when(F.col(value) > min_count, 1)).alias("k")).filter(F.col("k") >= need)
    return long.join(keep.select("id"), "id", "left_semi")


def drop_features(df: DataFrame, pattern: str, column: str = "id", keep: bool = False) -> DataFrame:
    """Without (or only) the features whose name matches, e.g. spike-ins."""
    hit = F.coalesce(F.col(column).cast("string").rlike(pattern), F.lit(False))
    return df.filter(hit if keep else ~hit)


def filter_matrix(long: DataFrame, ids: str | None = None, samples: str | None = None, fill: float | None = None) -> DataFrame:
    """Restrict rows and columns by patterns; null values become ``fill`` if given."""
    if ids:
        long = long.filter(F.col("id").cast("string").rlike(ids))
    if samples:
        long = long.filter(F.col("sample").rlike(samples))
    return long.fillna(fill, ["value"]) if fill is not None else long


def transpose(long: DataFrame) -> DataFrame:
    """Features as samples and samples as features; rows without the new id are left out."""
    return long.dropna(subset=["sample"]).withColumns({"id": F.col("sample"), "sample": F.col("id").cast("string")})


def slice_rows(long: DataFrame, first: int = 0, last: int = -1) -> DataFrame:
    """Features from place ``first`` up to before ``last`` in the order of their ids, places from 0.

    As surveyed, -1 or a place behind the end stands for the last feature, which is then left out. Rows without an id are left out.
    """
    if first == 0 and last == -1:
        return long.dropna(subset=["id"])
    ids = scans.placed(long.select("id").dropna().distinct(), [], [F.col("id").asc()])
    n = ids.agg(F.count("*").alias("_n"))  # one row
    stop = F.when((F.lit(last) == -1) | (F.lit(last) > F.col("_n")), F.col("_n") - 1).otherwise(last)
    kept = ids.join(F.broadcast(n), F.lit(True)).filter((F.col("_idx") >= max(first, 0)) & (F.col("_idx") < stop)).select("id")
    return long.join(kept, "id", "left_semi")


_OPS = {">": "__gt__", ">=": "__ge__", "<": "__lt__", "<=": "__le__", "==": "__eq__", "!=": "__ne__"}


def pair_condition(x: Column, y: Column, rules: list[tuple[str, float]], mode: str = "all") -> Column:
    """Comparison rules on one (either) or both (all) of two columns."""
    sides = [reduce(lambda a, b: a & b, [getattr(c, _OPS[op])(F.lit(v)) for op, v in rules]) for c in (x, y)]
    return sides[0] & sides[1] if mode == "all" else sides[0] | sides[1]


def log_shift(value: Column, c: float = 1.0) -> Column:
    return F.log2(value + F.lit(c))


def rpm(long: DataFrame, value: str = "count") -> DataFrame:
    """Value per million of its sample's total. The totals are a row per sample, joined back."""
    total = long.groupBy("sample").agg(F.sum(value).alias("_total"))
    return long.join(total, "sample").withColumn("rpm", F.try_divide(F.col(value) * 1e6, "_total")).drop("_total")


def upper_quartile(long: DataFrame, value: str = "count") -> DataFrame:
    """Values scaled by the sample's upper quartile relative to the mean of all samples' upper quartiles."""
    q = long.groupBy("sample").agg(F.percentile(value, F.lit(0.75)).alias("_q"))
    mean = q.agg(F.avg("_q").alias("_mean"))  # one row
    return long.join(q.join(F.broadcast(mean), F.lit(True)), "sample").withColumn("normalized", F.try_divide(F.col(value) * F.col("_mean"), "_q")).drop("_q", "_mean")


def size_factors(long: DataFrame, n_samples: int, value: str = "count") -> DataFrame:
    """Median-of-ratios size factor per sample, over features that are positive in every sample."""
    positive = long.filter(F.col(value) > 0)
    geo = positive.groupBy("id").agg(F.avg(F.log(value)).alias("_g"), F.count("*").alias("_n")).filter(F.col("_n") == n_samples)
    ratio = positive.join(geo, "id").withColumn("r", F.log(value) - F.col("_g"))
    return ratio.groupBy("sample").agg(F.exp(F.percentile("r", F.lit(0.5))).alias("size_factor"))


def normalized_counts(long: DataFrame, n_samples: int, value: str = "count") -> DataFrame:
    return long.join(size_factors(long, n_samples, value), "sample").withColumn("normalized", F.col(value) / F.col("size_factor"))


def integrate_de(results: DataFrame, contrasts: list[str], linear: bool = False) -> DataFrame:
    """Contrasts side by side: fc, p and padj per contrast; missing ones are 0, 1 and 1."""
    fc = F.bround(F.pow(F.lit(2.0), F.col("log2fc")), 4) if linear else F.col("log2fc")
    out = results.withColumn("fc", fc).groupBy("id").pivot("contrast", contrasts).agg(F.first("fc").alias("fc"), F.first("p").alias("p"), F.first("padj").alias("padj"))
    fill = {f"{c}_fc": 0.0 for c in contrasts} | {f"{c}_{k}": 1.0 for c in contrasts for k in ("p", "padj")}
    return out.fillna(fill)


def integrate_splicing(events: DataFrame, kinds: list[str]) -> DataFrame:
    """Per gene, with its ``name`` if events have one, and kind: events up, events down, the largest difference with its sign.

    A difference of 0 counts as up; of equal sizes the positive one is taken; kinds without events are 0. Null
    differences are left out.
    """
    keys = ["gene", *(["name"] if "name" in events.columns else [])]
    top = F.max(F.struct(F.abs("diff").alias("a"), F.col("diff").alias("d")))["d"]
    per = events.filter("diff IS NOT NULL").groupBy(*keys, "kind").agg(F.count(F.when(F.col("diff") >= 0, 1)).alias("up"), F.count(F.when(F.col("diff") < 0, 1)).alias("down"), top.alias("top"))
    out = per.groupBy(*keys).pivot("kind", kinds).agg(F.first("up").alias("up"), F.first("down").alias("down"), F.first("top").alias("top"))
    return out.fillna(0, [c for c in out.columns if c not in keys])


def site_by_sample(hits: DataFrame, samples: list[str], digits: int = 2) -> DataFrame:
    """Site x sample matrix of rounded signals; missing cells 0, sites without any signal stay."""
    out = hits.groupBy("id").pivot("sample", samples).agg(F.round(F.first("value", ignorenulls=True), digits))
    return out.fillna(0.0, samples)


def average_replicates(df: DataFrame, key: str, values: list[str]) -> DataFrame:
    return df.groupBy(key).agg(*(F.avg(v).alias(v) for v in values))


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a stated order."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def join_on_key(left: DataFrame, right: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Inner join in which the first row of each key counts on the left."""
    return first_by(left, [key], order).join(right, key)


def probe_to_gene(probes: DataFrame, lookup: DataFrame, order: list[Column]) -> DataFrame:
    """Probes with the first gene of the lookup."""
    return probes.join(first_by(lookup, ["probe"], order).select("probe", "gene"), "probe")


def common_samples(df: DataFrame, n: int, key: str = "sample", of: str = "gene") -> DataFrame:
    """Keys that occur with all ``n`` members, e.g. samples found in every gene's group."""
    return df.groupBy(key).agg(F.countDistinct(of).alias("k")).filter(F.col("k") == n).select(key)


def sample_distance(long: DataFrame, value: str = "value") -> DataFrame:
    """Euclidean distance of every two samples, over features both have. Pairs are of samples, not of rows."""
    a, b = long.select("id", F.col("sample").alias("s"), F.col(value).alias("x")), long.select("id", F.col("sample").alias("t"), F.col(value).alias("y"))
    return a.join(b, "id").filter("s < t").groupBy("s", "t").agg(F.sqrt(F.sum((F.col("x") - F.col("y")) ** 2)).alias("distance"))


def sample_correlation(long: DataFrame, value: str = "value") -> DataFrame:
    """Pearson correlation of every two samples over features both have."""
    a, b = long.select("id", F.col("sample").alias("s"), F.col(value).alias("x")), long.select("id", F.col("sample").alias("t"), F.col(value).alias("y"))
    return a.join(b, "id").filter("s < t").groupBy("s", "t").agg(F.corr("x", "y").alias("r"), F.count("*").alias("n"))


def ranks(long: DataFrame, value: str = "value") -> DataFrame:
    """Average ranks of the values inside each feature, as Spearman correlation needs them."""
    w = W.partitionBy("id")
    low = F.rank().over(w.orderBy(value))
    ties = F.count("*").over(W.partitionBy("id", value))
    return long.withColumn(value, low + (ties - 1) / 2.0)


def coexpression(long: DataFrame, genes: list | None = None, method: str = "pearson", min_size: int = 3, log2: bool = False, value: str = "value") -> DataFrame:
    """Correlated feature pairs a < b: r, n and both means; constant features give no pair.

    Without ``genes`` all pairs are asked for: features are dealt into ``PARTS`` parts, each pair of parts is a task, and
    in it each pair of blocks is a few matrix products, so what moves is every feature ``PARTS`` times, however many there
    are, and no pair meets sample by sample. ``genes`` restricts one side. A feature has one value per sample; null
    values do not count.
    """
    x = long.withColumn(value, log_shift(F.col(value))) if log2 else long
    x = x.filter(F.col(value).isNotNull())
    if method == "spearman":
        x = ranks(x, value)
    return _all_pairs(x, value, min_size, genes)


def _all_pairs(x: DataFrame, value: str, min_size: int, genes=None) -> DataFrame:
    """Pairs a < b of all features, or with ``genes`` those of them (a) with all others and among each other.

    A feature is one row of samples and values. Features are dealt to ``PARTS`` parts, to more only where a part had more
    than ``PART_VALUES`` values, and a task takes a pair of parts: it holds both and goes through them in blocks of
    ``BLOCK`` features, whose pairs leave it at once. ``genes`` are a part of their own, -1, which alone meets the others.
    """
    x = x.withColumn(value, F.col(value).cast("double")).filter(F.col("id").isNotNull() & F.col("sample").isNotNull() & ~F.isnan(value))
    parts = max(PARTS, -(-x.count() // PART_VALUES))
    own, partners = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"), F.sequence(F.lit(0), F.lit(parts - 1))
    if genes is not None:
        wanted = F.col("id").isin(list(genes))
        own, partners = F.when(wanted, -1).otherwise(own), F.when(wanted, F.sequence(F.lit(-1), F.lit(parts - 1))).otherwise(F.array(F.lit(-1)))
    features = x.groupBy("id").agg(F.collect_list(F.struct(F.col("sample").alias("s"), F.col(value).alias("v"))).alias("_c"))
    rows = features.select("id", F.col("_c.s").alias("s"), F.col("_c.v").alias("v"), own.alias("_k"), F.explode(partners).alias("_j"))
    rows = rows.select("id", "s", "v", "_k", F.least("_k", "_j").alias("_p"), F.greatest("_k", "_j").alias("_q"))

    def pairs(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, q = (k.as_py() for k in key)
        t = pa.Table.from_batches(batches)
        ids, part = t.column("id").to_numpy(), t.column("_k").to_numpy()
        sizes = pc.list_value_length(t.column("s")).to_numpy()
        code, samples = pd.factorize(pc.list_flatten(t.column("s")).to_numpy())
        values = pc.list_flatten(t.column("v")).to_numpy()
        begin = np.concatenate([[0], np.cumsum(sizes)])

        def dense(rows):
            """Values of some features, a column per sample, and where there are any; the first value of a cell counts."""
            at = np.concatenate([np.arange(begin[r], begin[r + 1]) for r in rows])[::-1]
            row = np.repeat(np.arange(len(rows)), sizes[rows])[::-1]
            v, have = np.zeros((len(rows), len(samples))), np.zeros((len(rows), len(samples)))
            v[row, code[at]], have[row, code[at]] = values[at], 1.0
            return ids[rows], v, have

        left, right = np.nonzero(part == p)[0], np.nonzero(part == q)[0]
        for i in range(0, len(left), BLOCK):
            one = dense(left[i : i + BLOCK])
            for j in range(i if p == q else 0, len(right), BLOCK):
                same = p == q and i == j
                found = block(one, one if same else dense(right[j : j + BLOCK]), same, p >= 0 or p == q)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(found, [t.schema.field("id").type] * 2 + types)], names)

    def block(left, right, same, ordered):
        (a, v, hv), (b, w, hw) = left, right
        dot = lambda s, t: s @ t.T
        n, sx, sy = dot(hv, hw), dot(v, hw), dot(hv, w)
        cov, vx, vy = n * dot(v, w) - sx * sy, n * dot(v * v, hw) - sx * sx, n * dot(hv, w * w) - sy * sy
        keep = (n >= min_size) & (vx > 1e-9) & (vy > 1e-9)
        if same:
            keep &= a[:, None] < b[None, :]
        i, j = np.nonzero(keep)
        a, b, n = a[i], b[j], n[i, j]
        swap = (a > b) & ordered
        mean_a, mean_b = sx[i, j] / n, sy[i, j] / n
        r = cov[i, j] / np.sqrt(vx[i, j] * vy[i, j])
        return np.where(swap, b, a), np.where(swap, a, b), r, n.astype("int64"), np.where(swap, mean_b, mean_a), np.where(swap, mean_a, mean_b)

    names, types = ["a", "b", "r", "n", "mean_a", "mean_b"], [pa.float64(), pa.int64(), pa.float64(), pa.float64()]
    kind = x.schema["id"].dataType.simpleString()
    return rows.groupBy("_p", "_q").applyInArrow(pairs, f"a {kind}, b {kind}, r double, n long, mean_a double, mean_b double")


def kendall(long: DataFrame, a, b, value: str = "value") -> DataFrame:
    """Kendall's tau-a of two features over their common samples, and the number of pairs of samples.

    One task counts over the samples of the two features, in n log n steps; samples are the columns of a
    matrix, not its rows. No common samples give no row.
    """
    x = long.filter(F.col("id") == F.lit(a)).select("sample", F.col(value).alias("x"))
    y = long.filter(F.col("id") == F.lit(b)).select("sample", F.col(value).alias("y"))

    def tau(pdf):
        pdf = pdf.dropna().sort_values("x")
        n, values = len(pdf), np.unique(pdf["y"])
        place = np.searchsorted(values, pdf["y"]) + 1
        tree = [0] * (len(values) + 1)

        def upto(k):
            total = 0
            while k > 0:
                total += tree[k]
                k &= k - 1
            return total

        score, seen = 0, 0
        for _, at in pd.Series(place).groupby(pdf["x"].to_numpy()):
            score += sum(upto(k - 1) - (seen - upto(k)) for k in at)
            for k in at:
                while k < len(tree):
                    tree[k] += 1
                    k += k & -k
            seen += len(at)
        count = n * (n - 1) // 2
        return pd.DataFrame({"tau": [score / count if count else None], "pairs": [count]}).astype({"tau": float})

    return x.join(y, "sample").groupBy().applyInPandas(tau, "tau double, pairs long")


def five_numbers(df: DataFrame, group: str, value: str) -> DataFrame:
    """Minimum, quartiles and maximum per group (linear interpolation)."""
    q = F.percentile(value, F.array(*(F.lit(p) for p in (0.0, 0.25, 0.5, 0.75, 1.0))))
    out = df.groupBy(group).agg(q.alias("q"), F.count(value).alias("n"))
    return out.select(group, "n", *(F.get("q", F.lit(i)).alias(n) for i, n in enumerate(("low", "q1", "median", "q3", "high"))))

"""Registered queries of the matrix and statistics operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import matrix as M
from ..operators import stats as S
from .fixtures import MATRIX, PEAKS, matrix, peaks, table

KINDS = ["click", "error", "purchase", "signup", "view"]
_M = f"WITH {MATRIX}"


def _res(s, d):
    """Test results: id, p, log2fc, mean."""
    o = table(s, d, "orders")
    return o.select(F.col("o_orderkey").alias("id"), ((F.col("o_orderkey") * 7919 % 10007) / 10007.0).alias("p"), (F.col("o_totalprice") / 100000.0 - 2).alias("log2fc"), F.col("o_totalprice").alias("mean"), F.col("o_orderpriority").alias("contrast"), F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("status"))


_RES = "res AS (SELECT o_orderkey AS id, (o_orderkey * 7919 % 10007) / 10007.0::DOUBLE AS p, o_totalprice / 100000.0::DOUBLE - 2 AS log2fc, o_totalprice AS mean, o_orderpriority AS contrast, o_custkey AS cust, o_orderstatus AS status FROM orders)"
_CONTRASTS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_BH = """(SELECT *, least(1.0, min(p * n / rk) OVER (ORDER BY rk DESC ROWS UNBOUNDED PRECEDING)) AS padj FROM (SELECT *, row_number() OVER (ORDER BY p, id) AS rk, count(*) OVER () AS n FROM res))"""
_BHG = """(SELECT *, least(1.0, min(p * n / rk) OVER (PARTITION BY contrast ORDER BY rk DESC ROWS UNBOUNDED PRECEDING)) AS padj FROM (SELECT *, row_number() OVER (PARTITION BY contrast ORDER BY p, id) AS rk, count(*) OVER (PARTITION BY contrast) AS n FROM res))"""


def _kinds(s, d):
    return [r[0] for r in table(s, d, "events").select("event_type").distinct().orderBy("event_type").collect()]


def _survival(s, d):
    o = table(s, d, "orders")
    return o.select((F.col("o_orderkey") % 90).alias("days"), (F.col("o_orderstatus") == "F").alias("dead"), F.when(F.col("o_totalprice") > 150000, "high").otherwise("low").alias("grp"))


_SURV = "surv AS (SELECT o_orderkey % 90 AS days, o_orderstatus = 'F' AS dead, CASE WHEN o_totalprice > 150000 THEN 'high' ELSE 'low' END AS grp FROM orders)"


def _events(s, d):
    return table(s, d, "lineitem").select(F.col("l_partkey").alias("gene"), F.concat(F.lit("g"), F.col("l_partkey").cast("string")).alias("name"), F.concat("l_linestatus", "l_returnflag").alias("kind"), (F.col("l_discount") - 0.05).alias("diff"))


QUERIES = {
    "expression_matrix": (
        lambda s, d: M.to_wide(matrix(s, d).withColumn("sample", F.concat(F.lit("s_"), "sample")), ["s_" + k for k in KINDS], "value"),
        f"{_M} SELECT id, {', '.join(f'max(CASE WHEN sample = {k!r} THEN value END) AS s_{k}' for k in KINDS)} FROM matrix GROUP BY id",
    ),
    "matrix_to_long": (
        lambda s, d: M.to_long(M.to_wide(matrix(s, d), KINDS, "value", 0.0), ["id"]),
        f"{_M} SELECT i.id, k.sample, coalesce(m.value, 0) AS value FROM (SELECT DISTINCT id FROM matrix) i CROSS JOIN (SELECT unnest({KINDS}) AS sample) k LEFT JOIN matrix m ON m.id = i.id AND m.sample = k.sample",
    ),
    "filter_prevalence": (
        lambda s, d: M.filter_prevalence(matrix(s, d), 12, 5, "count").select("id", "sample", "count"),
        f"{_M} SELECT id, sample, count FROM matrix WHERE id IN (SELECT id FROM matrix GROUP BY id HAVING count(*) FILTER (count > 12) >= 2)",
    ),
    "drop_features": (
        lambda s, d: M.drop_features(matrix(s, d), "^1.*[05]$").select("id", "sample"),
        f"{_M} SELECT id, sample FROM matrix WHERE NOT regexp_matches(CAST(id AS VARCHAR), '^1.*[05]$')",
    ),
    "filter_matrix": (
        lambda s, d: M.filter_matrix(matrix(s, d), "^[1-5]", "^(click|view)$").select("id", "sample", "value"),
        f"{_M} SELECT id, sample, value FROM matrix WHERE regexp_matches(CAST(id AS VARCHAR), '^[1-5]') AND sample IN ('click', 'view')",
    ),
    "pair_condition": (
        lambda s, d: M.to_wide(matrix(s, d), KINDS).filter(M.pair_condition(F.col("click"), F.col("view"), [(">", 8.0), ("<=", 60.0)], "either")).select("id", "click", "view"),
        f"{_M}, w AS (SELECT id, max(CASE WHEN sample = 'click' THEN value END) AS click, max(CASE WHEN sample = 'view' THEN value END) AS view FROM matrix GROUP BY id) SELECT * FROM w WHERE (click > 8 AND click <= 60) OR (view > 8 AND view <= 60)",
    ),
    "rpm": (lambda s, d: M.rpm(matrix(s, d)).select("id", "sample", "rpm"), f"{_M} SELECT id, sample, count * 1e6 / sum(count) OVER (PARTITION BY sample) AS rpm FROM matrix"),
    "upper_quartile": (
        lambda s, d: M.upper_quartile(matrix(s, d)).select("id", "sample", "normalized"),
        f"{_M}, q AS (SELECT sample, quantile_cont(count, 0.75) AS q FROM matrix GROUP BY sample) SELECT id, sample, count * (SELECT avg(q) FROM q) / q AS normalized FROM matrix JOIN q USING (sample)",
    ),
    "size_factors": (
        lambda s, d: M.size_factors(matrix(s, d), 5),
        f"{_M}, g AS (SELECT id, avg(ln(count)) AS g FROM matrix WHERE count > 0 GROUP BY id HAVING count(*) = 5) SELECT sample, exp(quantile_cont(ln(count) - g, 0.5)) AS size_factor FROM matrix JOIN g USING (id) GROUP BY sample",
    ),
    "normalized_counts": (
        lambda s, d: M.normalized_counts(matrix(s, d), 5).select("id", "sample", "normalized"),
        f"{_M}, g AS (SELECT id, avg(ln(count)) AS g FROM matrix WHERE count > 0 GROUP BY id HAVING count(*) = 5), f AS (SELECT sample, exp(quantile_cont(ln(count) - g, 0.5)) AS f FROM matrix JOIN g USING (id) GROUP BY sample) SELECT id, sample, count / f AS normalized FROM matrix JOIN f USING (sample)",
    ),
    "integrate_de": (
        lambda s, d: M.integrate_de(_res(s, d).groupBy(F.col("cust").alias("id"), "contrast").agg(F.max("log2fc").alias("log2fc"), F.min("p").alias("p"), F.min("p").alias("padj")), _CONTRASTS, linear=True).select("id", *(F.col(f"`{c}_{k}`").alias(f"{k}_{i}") for i, c in enumerate(_CONTRASTS) for k in ("fc", "p"))),
        f"WITH {_RES}, r AS (SELECT cust AS id, contrast, max(log2fc) AS log2fc, min(p) AS p FROM res GROUP BY ALL) SELECT id, " + ", ".join(f"coalesce(max(CASE WHEN contrast = '{c}' THEN round_even(pow(2, log2fc), 4) END), 0) AS fc_{i}, coalesce(max(CASE WHEN contrast = '{c}' THEN p END), 1) AS p_{i}" for i, c in enumerate(_CONTRASTS)) + " FROM r GROUP BY id",
    ),
    "integrate_splicing": (
        lambda s, d: M.integrate_splicing(_events(s, d), ["FA", "FR", "ON"]),
        "WITH e AS (SELECT l_partkey AS gene, 'g' || CAST(l_partkey AS VARCHAR) AS name, l_linestatus || l_returnflag AS kind, l_discount - 0.05::DOUBLE AS diff FROM lineitem), p AS (SELECT gene, name, kind, count(*) FILTER (diff >= 0) AS up, count(*) FILTER (diff < 0) AS down, arg_max(diff, struct_pack(a := abs(diff), b := diff)) AS top FROM e GROUP BY ALL) "
        "SELECT gene, name, " + ", ".join(f"coalesce(max(CASE WHEN kind = '{k}' THEN {c} END), 0) AS \"{k}_{c}\"" for k in ("FA", "FR", "ON") for c in ("up", "down", "top")) + " FROM p GROUP BY gene, name",
    ),
    "site_by_sample": (
        lambda s, d: M.site_by_sample(matrix(s, d).filter("value > 40").withColumn("value", F.col("count") / 4.0), KINDS),
        f"{_M} SELECT id, {', '.join(f'coalesce(max(CASE WHEN sample = {k!r} THEN round(count / 4.0::DOUBLE, 2) END), 0) AS {k}' for k in KINDS)} FROM matrix WHERE value > 40 GROUP BY id",
    ),
    "average_replicates": (lambda s, d: M.average_replicates(peaks(s, d), "qname", ["score"]), f"WITH {PEAKS} SELECT qname, avg(score) AS score FROM peaks GROUP BY qname"),
    "join_on_key": (
        lambda s, d: M.join_on_key(table(s, d, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey", "o_totalprice"), table(s, d, "customer").select(F.col("c_custkey").alias("k"), "c_name"), "k", [F.col("o_orderkey")]),
        "SELECT k, o_orderkey, o_totalprice, c_name FROM (SELECT o_custkey AS k, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1) JOIN (SELECT c_custkey AS k, c_name FROM customer) USING (k)",
    ),
    "probe_to_gene": (
        lambda s, d: M.probe_to_gene(table(s, d, "orders").select(F.col("o_custkey").alias("probe"), "o_orderkey"), table(s, d, "customer").select((F.col("c_custkey") % 700).alias("probe"), F.col("c_name").alias("gene")), [F.col("gene")]),
        "SELECT o_custkey AS probe, o_orderkey, gene FROM orders JOIN (SELECT c_custkey % 700 AS probe, min(c_name) AS gene FROM customer GROUP BY 1) l ON l.probe = o_custkey",
    ),
    "common_samples": (
        lambda s, d: M.common_samples(matrix(s, d).filter("value > 20"), 5, "id", "sample"),
        f"{_M} SELECT id FROM matrix WHERE value > 20 GROUP BY id HAVING count(DISTINCT sample) = 5",
    ),
    "sample_distance": (
        lambda s, d: M.sample_distance(matrix(s, d)),
        f"{_M} SELECT a.sample AS s, b.sample AS t, sqrt(sum((a.value - b.value) ^ 2)) AS distance FROM matrix a JOIN matrix b ON a.id = b.id AND a.sample < b.sample GROUP BY ALL",
    ),
    "sample_correlation": (
        lambda s, d: M.sample_correlation(matrix(s, d)),
        f"{_M} SELECT a.sample AS s, b.sample AS t, corr(a.value, b.value) AS r, count(*) AS n FROM matrix a JOIN matrix b ON a.id = b.id AND a.sample < b.sample GROUP BY ALL",
    ),
    "coexpression": (
        lambda s, d: M.coexpression(matrix(s, d), min_size=4).select("a", "b", "r", "n"),
        f"{_M} SELECT x.id AS a, y.id AS b, corr(x.value, y.value) AS r, count(*) AS n FROM matrix x JOIN matrix y ON x.sample = y.sample AND x.id < y.id GROUP BY ALL HAVING count(*) >= 4",
    ),
    "coexpression_spearman": (
        lambda s, d: M.coexpression(matrix(s, d), method="spearman", min_size=5).select("a", "b", "r"),
        f"{_M}, k AS (SELECT id, sample, rank() OVER (PARTITION BY id ORDER BY value) + (count(*) OVER (PARTITION BY id, value) - 1) / 2.0 AS value FROM matrix) SELECT x.id AS a, y.id AS b, corr(x.value, y.value) AS r FROM k x JOIN k y ON x.sample = y.sample AND x.id < y.id GROUP BY ALL HAVING count(*) >= 5",
    ),
    "coexpression_targets": (
        lambda s, d: S_with_p(M.coexpression(matrix(s, d), genes=[1, 2, 3], min_size=4, log2=True)),
        None,
    ),
    "kendall": (
        lambda s, d: M.kendall(table(s, d, "events").groupBy((F.col("user_id") % 2).alias("id"), F.to_date("ts").cast("string").alias("sample")).agg(F.sum("value").alias("value")), 0, 1),
        """WITH m AS (SELECT user_id % 2 AS id, CAST(CAST(ts AS DATE) AS VARCHAR) AS sample, sum(value) AS value FROM events GROUP BY ALL), b AS (SELECT x.sample, x.value AS x, y.value AS y FROM m x JOIN m y ON x.sample = y.sample AND x.id = 0 AND y.id = 1)
        SELECT sum(sign(p.x - q.x) * sign(p.y - q.y)) / CAST(nullif(count(*), 0) AS DOUBLE) AS tau, count(*) AS pairs FROM b p JOIN b q ON p.sample < q.sample""",
    ),
    "five_numbers": (
        lambda s, d: M.five_numbers(table(s, d, "events"), "event_type", "value"),
        "SELECT event_type, count(value) AS n, quantile_cont(value, 0.0) AS low, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3, quantile_cont(value, 1.0) AS high FROM events GROUP BY event_type",
    ),
    "bh_adjust": (lambda s, d: S.bh_adjust(_res(s, d)).select("id", "padj"), f"WITH {_RES} SELECT id, padj FROM {_BH}"),
    "bh_adjust_by_contrast": (lambda s, d: S.bh_adjust(_res(s, d), by=["contrast"]).select("id", "contrast", "padj"), f"WITH {_RES} SELECT id, contrast, padj FROM {_BHG}"),
    "significant": (
        lambda s, d: S.significant(S.bh_adjust(_res(s, d)), padj=0.9, fc=0.5, p=0.9).select("id", "padj", "log2fc"),
        f"WITH {_RES} SELECT id, padj, log2fc FROM {_BH} WHERE padj < 0.9 AND p < 0.9 AND abs(log2fc) >= 0.5",
    ),
    "volcano_classes": (
        lambda s, d: _res(s, d).groupBy(S.volcano_class(F.col("log2fc"), F.col("p"), 1.0, 0.05).alias("class")).agg(F.count("*").alias("n")),
        f"WITH {_RES} SELECT CASE WHEN abs(log2fc) >= 1 AND p <= 0.05 THEN 'both' WHEN abs(log2fc) >= 1 THEN 'fc' WHEN p <= 0.05 THEN 'p' ELSE 'ns' END AS class, count(*) AS n FROM res GROUP BY 1",
    ),
    "p_histogram": (lambda s, d: S.p_histogram(_res(s, d), least=100000), f"WITH {_RES} SELECT CAST(greatest(ceil(p * 20) - 1, 0) AS BIGINT) AS bin, count(*) AS n FROM res WHERE mean > 100000 GROUP BY 1"),
    "binned_small_p": (
        lambda s, d: S.binned_small_p(_res(s, d), "mean", cut=0.3),
        f"WITH {_RES}, e AS (SELECT quantile_cont(mean, [{', '.join(f'{i}.0/6' for i in range(7))}]) AS q FROM res WHERE mean > 0), b AS (SELECT unnest(range(1, 8)) AS i, unnest(list_concat([0], q[:6])) AS low, unnest(q) AS high FROM e) SELECT CAST(i - 1 AS INT) AS bin, avg(CAST(p < 0.3 AS INT)) AS share, count(*) AS n FROM res JOIN b ON mean > low AND mean <= high GROUP BY 1",
    ),
    "gsea": (lambda s, d: S.gsea(_res(s, d).groupBy(F.col("cust").alias("gene")).agg(F.max("log2fc").alias("score")), table(s, d, "customer").select(F.col("c_mktsegment").alias("set"), F.col("c_custkey").alias("gene")), 20).select("set", "size", F.round("es", 6).alias("es"), "p"), None),
    "kaplan_meier": (
        lambda s, d: S.kaplan_meier(_survival(s, d), "days", "dead", "grp"),
        f"""WITH {_SURV}, p AS (SELECT grp, days, sum(CAST(dead AS INT)) AS events, count(*) AS l FROM surv GROUP BY ALL), r AS (SELECT *, sum(l) OVER (PARTITION BY grp ORDER BY days ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS at_risk FROM p)
        SELECT grp, days, CAST(events AS BIGINT) AS events, CAST(at_risk AS BIGINT) AS at_risk, CASE WHEN min(at_risk - events) OVER w = 0 THEN 0 ELSE exp(sum(CASE WHEN events = at_risk THEN 0 ELSE ln(1 - events / CAST(at_risk AS DOUBLE)) END) OVER w) END AS survival FROM r WINDOW w AS (PARTITION BY grp ORDER BY days ROWS UNBOUNDED PRECEDING)""",
    ),
    "log_rank": (
        lambda s, d: S.log_rank(_survival(s, d), "days", "dead", "grp", "high", "low").select("observed", "expected", "variance", "chi2"),
        f"""WITH {_SURV}, p AS (SELECT days, sum(CAST(dead AS INT)) AS d, sum(CAST(dead AND grp = 'high' AS INT)) AS d1, count(*) AS c, sum(CAST(grp = 'high' AS INT)) AS c1 FROM surv GROUP BY days),
        r AS (SELECT d, d1, CAST(sum(c) OVER w AS DOUBLE) AS n, CAST(sum(c1) OVER w AS DOUBLE) AS n1 FROM p WINDOW w AS (ORDER BY days ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        t AS (SELECT CAST(sum(d1) AS BIGINT) AS observed, sum(d * n1 / n) AS expected, sum(CASE WHEN n > 1 THEN d * (n1 / n) * (1 - n1 / n) * (n - d) / (n - 1) ELSE 0 END) AS variance FROM r) SELECT *, (observed - expected) ^ 2 / variance AS chi2 FROM t""",
    ),
    "rank_sum": (
        lambda s, d: S.rank_sum(_res(s, d), "status", "mean", "F", "O"),
        f"""WITH {_RES}, b AS (SELECT status, rank() OVER (ORDER BY mean) + (count(*) OVER (PARTITION BY mean) - 1) / 2.0::DOUBLE AS r FROM res WHERE status IN ('F', 'O')), s AS (SELECT count(*) FILTER (status = 'F') AS n1, count(*) FILTER (status = 'O') AS n2, sum(r) FILTER (status = 'F') AS r1 FROM b)
        SELECT n1, n2, r1 - n1 * (n1 + 1) / 2.0::DOUBLE AS u, (r1 - n1 * (n1 + 1) / 2.0::DOUBLE - n1 * n2 / 2.0::DOUBLE) / sqrt(n1 * n2 * (n1 + n2 + 1) / 12.0::DOUBLE) AS z FROM s""",
    ),
}


def S_with_p(pairs):
    return pairs.withColumn("p", S.correlation_p("r", "n"))


def _fisher(s, d):
    r = _res(s, d).groupBy("cust").agg(*(F.count(F.when(c, 1)).alias(n) for n, c in (("a", (F.col("p") < 0.5) & (F.col("log2fc") > 0)), ("b", (F.col("p") < 0.5) & (F.col("log2fc") <= 0)), ("c", (F.col("p") >= 0.5) & (F.col("log2fc") > 0)), ("d", (F.col("p") >= 0.5) & (F.col("log2fc") <= 0)))))
    return r.withColumn("pvalue", F.round(S.fisher_exact("a", "b", "c", "d"), 9))


def _enriched(s, d):
    world = table(s, d, "customer").select(F.col("c_custkey").alias("gene"), F.col("c_nationkey").cast("string").alias("set"))
    chosen = table(s, d, "orders").filter("o_totalprice > 250000").select(F.col("o_custkey").alias("gene"))
    return S.over_representation(chosen, world, world)

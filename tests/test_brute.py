"""Queries that SQL cannot express against plain Python on small tables."""

import random
import time

import pytest

from strandloom.operators import reads, sets, signal, stats


def test_greedy_peaks(spark):
    r = random.Random(2)
    rows = [(i, r.choice(["c1", "c2"]), a := r.randint(0, 400), a + r.choice([5, 20, 60]), r.randint(0, 30)) for i in range(200)]
    kept = []
    for i, c, a, b, score in sorted(rows, key=lambda x: (-x[4], x[0])):
        if all(c != d or b <= x or a >= y for _, d, x, y in kept):
            kept.append((i, c, a, b))
    df = spark.createDataFrame(rows, "id long, chrom string, start long, end long, score long")
    assert sorted(x.id for x in signal.greedy_peaks(df).collect()) == sorted(k[0] for k in kept)


def test_mott_trim(spark):
    r = random.Random(3)
    rows = [(i, "".join(r.choice("ACGTN") for _ in range(n)), "".join(chr(33 + r.choice([2, 8, 15, 30, 40])) for _ in range(n))) for i, n in enumerate([0, 1, 5, 30, 30, 60, 60, 100])]
    got = {x.id: x.seq for x in reads.mott_trim(spark.createDataFrame(rows, "id long, seq string, qual string")).collect()}
    for i, seq, qual in rows:
        sums = [sum(ord(q) - 33 - 20 for q in qual[k:]) for k in range(len(qual))]
        at = max((k for k, v in enumerate(sums) if v == min(sums)), default=0) if not sums or min(sums) <= 20 else len(seq)
        kept = seq[:at]
        assert got.get(i) == (kept if kept.strip("N") else None)


def test_elements(spark):
    r = random.Random(4)
    rank = ["SINE", "LINE", "LTR"]
    make = lambda i: (r.choice("ab"), i, r.choice(["miRNA", "repeat", "CpG"]), r.choice(["repeat", "repeat", "other"]), r.choice(rank), a := r.randint(0, 300), a + r.randint(1, 30), r.randint(1, 30))
    extra, main = [make(i) for i in range(120)], [(r.choice("ab"), a := r.randint(0, 300), a + 10) for _ in range(5)]
    want = []
    for segment in "ab":
        kept = []
        for e in sorted((e for e in extra if e[0] == segment), key=lambda e: (e[5], e[6], e[1])):
            if e[2] != "miRNA" and any(m[0] == segment and m[1] < e[6] and e[5] < m[2] for m in main):
                continue
            near = next((k for k, o in enumerate(kept) if e[3] == o[3] == "repeat" and o[5] < e[6] and e[5] < o[6]), None)
            if near is None:
                kept.append(e)
            elif (rank.index(e[4]), -e[7]) < (rank.index(kept[near][4]), -kept[near][7]):
                kept[near] = e
        want += [e[1] for e in kept]
    x = spark.createDataFrame(extra, "segment string, id long, class string, kind string, type string, start long, end long, overlap long")
    m = spark.createDataFrame(main, "segment string, start long, end long")
    assert sorted(e.id for e in sets.resolve_elements(x, m, rank).collect()) == sorted(want)


def test_many_elements_of_a_segment(spark):
    """20,000 repeats that do not meet, between 200 that do, in one sweep; genes in a pile make no pairs."""
    far = [("a", i, "miRNA", "repeat", "LINE", 10 * i, 10 * i + 5, 5) for i in range(20000)]
    near = [("a", 10**6 + i, "miRNA", "repeat", "SINE", 10**6 + i, 10**6 + i + 2, 2) for i in range(200)]
    x = spark.createDataFrame(far + near, "segment string, id long, class string, kind string, type string, start long, end long, overlap long")
    m = spark.createDataFrame([("a", 0, 5)], "segment string, start long, end long")
    began = time.time()
    got = sorted(e.id for e in sets.resolve_elements(x, m, ["SINE", "LINE"]).collect())
    assert got == [*range(20000), *range(10**6, 10**6 + 200, 2)] and time.time() - began < 8


def test_gsea_score(spark):
    r = random.Random(5)
    genes = [(g, r.gauss(0, 1)) for g in range(120)]
    members = {s: set(r.sample(range(120), n)) for s, n in (("x", 8), ("y", 30), ("z", 60))}
    df = spark.createDataFrame(genes, "gene long, score double")
    pairs = spark.createDataFrame([(s, g) for s, m in members.items() for g in m], "set string, gene long")
    got = {x.set: x for x in stats.gsea(df, pairs, 20).collect()}
    for s, m in members.items():
        total, miss, now, path = sum(abs(v) for g, v in genes if g in m), 1 / (120 - len(m)), 0.0, []
        for g, v in sorted(genes, key=lambda x: (-x[1], x[0])):
            now += abs(v) / total if g in m else -miss
            path.append(now)
        best = max(path) if max(path) >= -min(path) else min(path)
        assert got[s].size == len(m) and got[s].es == pytest.approx(best) and 0 < got[s].p <= 1


def test_exact_tests():
    import math

    def brute(a, b, c, d):
        n, row, col = a + b + c + d, a + b, a + c
        p = lambda k: math.comb(col, k) * math.comb(n - col, row - k) / math.comb(n, row)
        return sum(p(k) for k in range(max(0, row + col - n), min(row, col) + 1) if p(k) <= p(a) * (1 + 1e-7))

    for t in [(0, 0, 0, 0), (1, 0, 0, 1), (8, 2, 1, 5), (30, 400, 20, 500), (3, 1500, 900, 700)]:
        assert stats._fisher_two_sided(*t) == pytest.approx(min(1.0, brute(*t)) if sum(t) else 1.0)
    assert 0 < stats._fisher_two_sided(1000, 10**7, 2000, 10**7) < 1e-60


def test_pca_keeps_signs(spark, sf):
    """Weights and shares of variance from the covariance matrix of the centred table."""
    import numpy as np

    from strandloom.operators import pipelines
    from strandloom.plans.fixtures import matrix

    samples = ["click", "error", "purchase", "signup", "view"]
    long = matrix(spark, sf)
    wide = long.toPandas().pivot_table(index="id", columns="sample", values="value").reindex(columns=samples).fillna(0.0).to_numpy()
    values, vectors = np.linalg.eigh(np.cov((wide - wide.mean(axis=1, keepdims=True)).T))
    order = np.argsort(-values)
    got = {(r.sample, r.component): (r.weight, r.variance) for r in pipelines.pca(long, samples).collect()}
    for i in range(2):
        v = vectors[:, order[i]]
        v = v * np.sign(v[np.abs(v).argmax()])
        for j, s in enumerate(samples):
            weight, share = got[s, i + 1]
            assert abs(weight - v[j]) < 1e-6 and abs(share - values[order[i]] / values.sum()) < 1e-6
    assert any(w < 0 for w, _ in got.values())


def test_coexpression_of_targets(spark, monkeypatch):
    """Correlations of three features with all others over common samples, in small blocks."""
    import numpy as np

    from strandloom.operators import matrix

    monkeypatch.setattr(matrix, "BLOCK", 7)
    r = np.random.default_rng(2)
    values = {(i, s): float(r.normal()) for i in range(30) for s in range(9) if r.random() < 0.8}
    df = spark.createDataFrame([(i, f"s{s}", v) for (i, s), v in values.items()], "id long, sample string, value double")
    got = {(x.a, x.b): (x.r, x.n) for x in matrix.coexpression(df, genes=[3, 20, 11], min_size=4).collect()}
    want = {}
    for a in (3, 20, 11):
        for b in range(30):
            both = [s for s in range(9) if (a, s) in values and (b, s) in values]
            if a != b and len(both) >= 4 and (b not in (3, 20, 11) or a < b):
                want[a, b] = np.corrcoef([values[a, s] for s in both], [values[b, s] for s in both])[0, 1], len(both)
    assert set(got) == set(want) and all(abs(got[k][0] - want[k][0]) < 1e-9 and got[k][1] == want[k][1] for k in want)

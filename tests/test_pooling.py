"""Pooling against plain loops over random chains, and groups of edges."""

import os
import random

import pytest
from pyspark.sql import functions as F

from strandloom.operators import pooling as P
from strandloom.operators.stored import written

SCHEMA = "id string, gene string, chrom string, strand string, blocks array<struct<start:long,end:long>>, labels array<string>, rank int"


def chain(r, low=1, high=4):
    at, out = r.randrange(120), []
    for _ in range(r.randint(low, high)):
        at += r.randint(1, 12)
        out.append((at, at := at + r.randint(2, 25)))
    return tuple(out)


def made(r, n, label, rank):
    return [(f"{label}{i}", r.choice("gh"), "c", r.choice("++-"), chain(r), [label], rank) for i in range(n)]


def size(x):
    return sum(b - a for a, b in x)


def both(x, y):
    return tuple((max(a, c), min(b, d)) for a, b in x for c, d in y if max(a, c) < min(b, d))


def union(x, y):
    out = []
    for a, b in sorted(x + y):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return tuple(out)


def named(rows):
    out = {}
    for gene, strand, blocks, labels, rank in rows:
        old = out.get((gene, strand, blocks), ((), 99))
        out[gene, strand, blocks] = tuple(sorted({*old[0], *labels})), min(old[1], rank)
    return [(g, s, b, la, rk) for (g, s, b), (la, rk) in out.items()]


def rest_of(large, small, least, overhang):
    (s, e), hits = small[0], [k for k, (a, b) in enumerate(large) if min(b, small[0][1]) > max(a, small[0][0])]
    if len(small) != 1 or len(large) < 2 or len(hits) != 1 or hits[0] not in (0, len(large) - 1):
        return None
    a, b = large[hits[0]]
    if not overhang and (s < a or e > b):
        return None
    part = (min(e, b) + least, b) if hits[0] == 0 else (a, max(s, a) - least)
    part = (part,) if part[1] - part[0] >= least else ()
    return (part + large[1:] if hits[0] == 0 else large[:-1] + part) or None


def pooled(x, y, least, most, fraction, final):
    x, y, out, met, rests = named(x), named(y), [], set(), {}
    for p in x:
        for q in y:
            shared = both(p[2], q[2])
            if p[0] != q[0] or p[1] != q[1] or size(shared) < least or max(size(shared) / size(p[2]), size(shared) / size(q[2])) < fraction:
                continue
            met |= {(0, p), (1, q)}
            one_p, one_q = len(p[2]) == 1, len(q[2]) == 1
            if p[4] == q[4]:
                blocks = shared if one_p == one_q else q[2] if one_p else p[2]
                large, small, over = (q, p, False) if one_p else (p, q, False)
            else:
                blocks = p[2] if p[4] < q[4] else q[2]
                large, small, over = (q, p, True) if p[4] < q[4] else (p, q, True)
            out.append((p[0], p[1], blocks, p[3] + q[3], min(p[4], q[4])))
            rest = None if final else rest_of(large[2], small[2], least, over)
            if rest and size(rest) >= 0.7 * (size(shared) + least + size(rest)):
                rests.setdefault(large, set()).add(rest)
    for large, parts in rests.items():
        kept = []
        for p in sorted(parts):
            for k, q in enumerate(kept):
                z = both(q, p)
                if (len(p) > 1) == (len(q) > 1) and size(z) >= least and max(size(z) / size(q), size(z) / size(p)) >= fraction:
                    kept[k] = z
                    break
            else:
                kept.append(p)
        out += [(large[0], large[1], k, large[3], large[4]) for k in kept]
    out += [p for p in x if (0, p) not in met] + [q for q in y if (1, q) not in met]
    return named([p for p in out if least <= size(p[2]) <= most])


def plain(rows):
    return [(g, s, b, tuple(la), rk) for _, g, _, s, b, la, rk in rows]


def rows_of(df):
    return sorted((r.gene, r.strand, tuple(map(tuple, r.blocks)), tuple(r.labels), r["rank"]) for r in df.collect())


@pytest.mark.parametrize("seed,ranks,final", [(1, (0, 1), False), (2, (1, 1), False), (3, (1, 0), True), (4, (0, 0), True)])
def test_two_sets_against_loops(spark, seed, ranks, final):
    r = random.Random(seed)
    x, y = made(r, 45, "x", ranks[0]), made(r, 45, "y", ranks[1])
    got = P.pool_peaks(*(spark.createDataFrame(z, SCHEMA) for z in (x, y)), min_len=3, max_len=70, fraction=0.4, final=final)
    assert rows_of(got) == sorted(pooled(plain(x), plain(y), 3, 70, 0.4, final))


def test_remainders_of_unequal_numbers_of_blocks(spark):
    x = [("x", "g", "c", "+", ((0, 30), (100, 130), (200, 230), (300, 330)), ["x"], 0)]
    y = [("y0", "g", "c", "+", ((0, 28),), ["y"], 0), ("y1", "g", "c", "+", ((318, 330),), ["y"], 0)]
    got = rows_of(P.pool_peaks(*(spark.createDataFrame(z, SCHEMA) for z in (x, y)), min_len=3, max_len=200, fraction=0.4))
    assert got == sorted(pooled(plain(x), plain(y), 3, 200, 0.4, False)) and {len(r[2]) for r in got} == {3, 4}


def test_many_sets_against_loops(spark):
    r = random.Random(9)
    sets = [made(r, 14, label, rank) for rank, label in enumerate("xyz")]
    args = (3, 70, 0.4)
    p = [pooled(plain(sets[i]), plain(sets[j]), *args, False) for i, j in ((0, 1), (0, 2), (1, 2))]
    want = pooled(pooled(p[0], p[1], *args, False), p[2], *args, False)
    for s in sets:
        want = pooled([(*q[:4], -1) for q in want], plain(s), *args, True)
    for parts in (1, 5):
        frames = [spark.createDataFrame(s, SCHEMA).repartition(parts) for s in sets]
        assert rows_of(P.pool_many_sets(frames, 3, 70, 0.4)) == sorted(want)


def test_groups_of_edges(spark):
    edges = [("A", "B"), ("B", "C"), ("C", "D"), ("E", "F"), ("G", "H"), ("H", "I"), ("G", "I"), ("G", "J")]
    edges += [(f"n{k:03d}", f"n{k + 1:03d}") for k in range(60)] + [("hub", f"z{k}") for k in range(200)]
    got = {}
    for r in P.components(spark.createDataFrame(edges, "id string, b_id string")).collect():
        got.setdefault(r.group, set()).add(r.id)
    assert got["A"] == set("ABCD") and got["E"] == set("EF") and got["G"] == set("GHIJ") and len(got["n000"]) == 61 and len(got["hub"]) == 201 and len(got) == 5


@pytest.mark.parametrize("mode", ["merge", "intersect", "mergeGroup", "intersectGroup"])
def test_pooled_groups_against_loops(spark, mode):
    r = random.Random(len(mode))
    x, y = made(r, 40, "x", 0), made(r, 40, "y", 0)
    hits = [(p, q) for p in x for q in y if p[3] == q[3] and both(p[4], q[4])]
    pairs = [(p, q) for p, q in hits if p[1] == q[1]]
    label = {p[0]: p[0] for pair in pairs for p in pair}
    for _ in label:
        for p, q in pairs:
            label[p[0]] = label[q[0]] = min(label[p[0]], label[q[0]])
    one = union if mode.startswith("merge") else both
    out = []
    if mode.endswith("Group"):
        for g in set(label.values()):
            mine = [(p, q) for p, q in pairs if label[p[0]] == g]
            whole = ()
            for p, q in mine:
                whole = union(whole, one(p[4], q[4]))
            if mode == "mergeGroup" and size(whole) > 110:
                out += [(p[1], p[3], union(p[4], q[4]), "a,b") for p, q in mine]
            else:
                out.append((mine[0][0][1], mine[0][0][3], whole, "a,b"))
    else:
        out = [(p[1], p[3], one(p[4], q[4]), "a,b") for p, q in pairs]
    out += [(p[1], p[3], p[4], "a") for p in x if p[0] not in {h[0][0] for h in hits}] + [(q[1], q[3], q[4], "b") for q in y if q[0] not in {h[1][0] for h in hits}]
    got = P.pool_groups(*(spark.createDataFrame(z, SCHEMA) for z in (x, y)), mode, 3, 110)
    assert sorted((z.gene, z.strand, tuple(map(tuple, z.blocks)), z.labels) for z in got.collect()) == sorted(z for z in out if 3 <= size(z[2]) <= 110)


def test_many_sets_leave_only_what_they_return(spark, monkeypatch):
    r, tables = random.Random(5), []
    monkeypatch.setattr(P, "written", lambda *args: tables.append(written(*args)) or tables[-1])
    got = P.pool_many_sets([spark.createDataFrame(made(r, 12, label, rank), SCHEMA) for rank, label in enumerate("xyz")], 3, 70, 0.4)
    folders = [t._written_to.removeprefix("file:") for t in tables]
    assert len(got.collect()) > 10 and len(folders) > 15 and [f for f in folders if os.path.exists(f)] == folders[-1:]


def test_only_blocks_of_one_gene_are_paired(spark):
    x, y = (spark.createDataFrame([(i, f"g{i}", "c", "+", [(0, 50)], ["l"], 0) for i in range(30)], SCHEMA.replace("id string", "id int")) for _ in "xy")
    a, b = (P._counted(P._structures(d), "structures") for d in (x, y))
    pairs = P._valid_pairs(a, b, 1, 0.5)
    assert pairs.count() == 30 and "gene" in pairs._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[-1]


def test_written_leaves_no_shuffle_files(spark):
    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}

    before = files()
    written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert not files() - before


def test_chains_of_two_sets_are_derived_once(spark, sf, monkeypatch):
    from strandloom.plans import pool_queries

    made_from = []
    monkeypatch.setattr(pool_queries, "peaks", lambda s, d, real=pool_queries.peaks: made_from.append(d) or real(s, d))
    tables = []
    monkeypatch.setattr(P, "written", lambda *args: tables.append(written(*args)) or tables[-1])
    got = pool_queries.QUERIES["pool_merge_groups"][0](spark, sf)
    assert len(made_from) == 1 and "lineitem" not in got.inputFiles()[0]
    gone = [t._written_to for t in tables if not os.path.exists(t._written_to.removeprefix("file:"))]
    assert any("gene-pairs" in f for f in gone) and any("edges" in f for f in gone) and got.count() > 0

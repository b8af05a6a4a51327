"""The forest against brute force: small leaves, so that everything is split, and balls larger than a leaf."""

import math

import numpy as np

from strandloom.llm import vector_forest

SCHEMA = "vec_id long, embedding array<double>, key string, unit string, label int"


def turned(rng, v, cosine):
    """A unit vector at exactly this cosine to v."""
    w = rng.standard_normal(len(v))
    w -= (w @ v) * v
    return cosine * v + math.sqrt(1 - cosine**2) * w / np.linalg.norm(w)


def brute(rows, cosine=0.9):
    """vec_id -> (links, component); ids are distinct here."""
    x = np.array([v / np.linalg.norm(v) for _, v in rows])
    near = x @ x.T >= cosine
    np.fill_diagonal(near, False)
    label = np.array([i for i, _ in rows])
    while True:
        new = np.minimum(label, np.where(near, label[None, :], 1 << 60).min(axis=1))
        if (new == label).all():
            return {i: (int(n), int(c)) for (i, _), n, c in zip(rows, near.sum(axis=1), label)}
        label = new


def made(seed=5):
    rng = np.random.default_rng(seed)
    unit = lambda v: v / np.linalg.norm(v)
    out = [unit(rng.standard_normal(32)) for _ in range(700)]
    for c in np.linspace(0.9001, 0.99, 150):  # pairs down to the threshold
        out.append(turned(rng, out[int(rng.integers(700))], c))
    centre = unit(rng.standard_normal(32))
    out += [turned(rng, centre, 0.995) for _ in range(400)]  # a ball
    out += [turned(rng, centre, c) for c in np.linspace(0.8, 0.95, 40)]  # around it
    out += [out[3]] * 30  # exact copies
    out += [7.5 * out[4]]
    return list(enumerate(out))


def test_against_brute_force(spark):
    rows = made()
    df = spark.createDataFrame([(i, [float(a) for a in v], "k", "u", 1) for i, v in rows], SCHEMA)
    want = brute(rows)
    got = {r.vec_id: r for r in vector_forest.near_vectors(df, leaf=64, block=100).collect()}
    assert len(got) == len(rows)
    assert all(got[i].n_links <= n for i, (n, _) in want.items())  # none below the threshold, none twice
    found = sum(r.n_links for r in got.values()) / sum(n for n, _ in want.values())
    single = [i for i, (n, _) in want.items() if n == 1]
    assert found >= 0.99 and sum(got[i].n_links for i in single) >= 0.97 * len(single)
    assert sum(got[i].component_id == c for i, (_, c) in want.items()) >= 0.99 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    whole = {r.vec_id: r for r in vector_forest.near_vectors(df).collect()}  # one leaf holds all: exact
    assert {i: (r.n_links, r.component_id) for i, r in whole.items()} == want


def test_a_ball_in_blocks_is_exact(spark):
    """A leaf that is one ball with neighbours, in many blocks: every link is counted once, no pair is left out."""
    rng = np.random.default_rng(1)
    centre = turned(rng, np.eye(8)[0], 0.5)
    rows = list(enumerate([turned(rng, centre, 0.999) for _ in range(300)] + [turned(rng, centre, c) for c in np.linspace(0.84, 0.96, 5)]))
    df = spark.createDataFrame([(i, [float(a) for a in v], "k", "u", 1) for i, v in rows], SCHEMA)
    got = vector_forest.near_vectors(df, trees=2, leaf=1000, block=50).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute(rows)


def test_awkward_vectors(spark):
    v, nan, inf = [1.0, 0.0], float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (None, v), (7, v), (7, v), (8, [1e300, 1e290]), (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0])]
    df = spark.createDataFrame([(*r, "k", "u", 1) for r in rows], SCHEMA)
    got = sorted(vector_forest.near_vectors(df).collect(), key=str)
    hollow = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in got if r.vec_id not in (7, 8)}
    assert hollow == {(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 9, 10, None)}
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in got if r.vec_id in (7, 8)] == [(7, 2, 7, True), (7, 2, 7, True), (8, 2, 7, False)]
    assert vector_forest.near_vectors(df.limit(0)).collect() == []


def test_given_table(spark, sf):
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_forest.query(spark, sf).collect()}
    rows = [(r.vec_id, np.array(r.embedding, dtype=float)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert got == brute(rows)

"""Near-duplicate vectors by a forest of random-projection trees with spill, verified by cosine in double precision.

1. Vectors become unit vectors; equal ones are a class with a weight, so exact copies cost one row.
2. Every tree splits its rows recursively along random directions. The threshold is put where a node's sample is thin, so
   dense groups stay whole, and rows close to it go to both sides (spill). A node is fitted on a sample of about
   ``SAMPLE`` of its rows, ``LEVELS`` levels at a time; all rows are routed. Nodes of at most ``LEAF`` rows are leaves, and so
   are nodes that hold nothing but a ball of near copies or cannot be split.
3. In a leaf that stays large, rows within half the threshold's angle of one centre form a ball: by the triangle inequality
   all of them are links, which are counted and united without being compared. A row has one ball at most.
4. Leaves are compared in full, large ones in pairs of blocks (two blocks of one ball need no comparison). A pair that shares
   several leaves is counted in the smallest of them. A task returns a count and a root for each member that has a link,
   never the pairs.
5. Roots are united to components; counts are summed.

A pair at the threshold is parted by one split with probability of about 0.07 where a node's rows are spread evenly, so it
shares a leaf of one of ``TREES`` trees with probability above 0.99 for 20 levels of splits; closer pairs more often. Nothing is
capped: what is found in a leaf is all counted.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written
from .near_dup import components

COSINE = 0.9
TREES = 12
LEAF, SAMPLE, LEVELS = 1024, 1024, 4
#: Rows of a block of a large leaf.
BLOCK = 2048
#: Half the width of the spill, in standard deviations of the projected distance of a pair at the threshold.
SPILL = 0.25
DIRECTIONS = 6
#: A node is a ball if so many of its sample lie in one; a split must leave at least the rest of 1 - STUCK of the rows.
PURE, STUCK = 0.98, 0.97


def units(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, key (128 bits that name the unit vector), unit (float64 bytes); both null where a vector has no direction."""

    def run(batches):
        for batch in batches:
            keys, rows = [], []
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                v = np.array(x if x is not None and i is not None else [], dtype=np.float64)
                top = np.abs(v).max() if len(v) else 0.0
                if not np.isfinite(v).all() or not top:
                    keys.append(None)
                    rows.append(None)
                    continue
                v = v / top  # no overflow in the squares
                raw = (v / math.sqrt(v @ v) + 0.0).tobytes()
                keys.append(hashlib.blake2b(raw, digest_size=16).digest())
                rows.append(raw)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(rows, pa.binary())], ["vec_id", "key", "unit"])

    return vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("e")).mapInArrow(run, "vec_id long, key binary, unit binary")


def _stack(raw) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)


@lru_cache(maxsize=20_000)
def _direction(node: int, place: int, choice: int, width: int) -> np.ndarray:
    v = np.random.default_rng([node & (2**64 - 1), place, choice]).standard_normal(width)
    return v / np.linalg.norm(v)


def _spill(width: int, cosine: float) -> float:
    return SPILL * math.sqrt((2 - 2 * cosine) / width)


def _ball(x: np.ndarray, cosine: float) -> tuple[float, int]:
    """The share of the rows within half the threshold's angle of the best of 64 rows as a centre, and that row."""
    near = (x[:64] @ x.T >= math.cos(math.acos(cosine) / 2)).sum(axis=1)
    return near.max() / len(x), int(near.argmax())


def _fit(node: int, x: np.ndarray, rows: float, cosine: float, leaf: int) -> tuple[list[float], list[int]]:
    """Thresholds and directions of the next levels in heap order; infinity ends a branch, with direction -1 for good."""
    last = 2**LEVELS
    thresholds, choices = [math.inf] * last, [0] * last
    spill = _spill(x.shape[1], cosine)

    def split(place: int, x: np.ndarray) -> None:
        if place >= last or rows * len(x) / total <= leaf or len(x) < 8:
            return
        best = (math.inf, math.inf, -1)
        if _ball(x, cosine)[0] < PURE:
            for choice in range(DIRECTIONS):
                p = np.sort(x @ _direction(node, place, choice, x.shape[1]))
                cut = (p[1:] + p[:-1]) / 2
                left, right = np.searchsorted(p, cut + spill, "right") / len(p), 1 - np.searchsorted(p, cut - spill, "left") / len(p)
                score = left + right - 1 + (left - right) ** 2 / 4 + np.where(np.maximum(left, right) > STUCK, math.inf, 0)
                at = int(score.argmin())
                best = min(best, (float(score[at]), float(cut[at]), choice))
        if best[2] < 0 or math.isinf(best[0]):
            choices[place] = -1
            return
        _, thresholds[place], choices[place] = best
        p = x @ _direction(node, place, best[2], x.shape[1])
        split(2 * place, x[p <= best[1] + spill])
        split(2 * place + 1, x[p >= best[1] - spill])

    total = len(x)
    split(1, x)
    return thresholds, choices


def _sampled(places: DataFrame, sizes: DataFrame, classes: DataFrame) -> DataFrame:
    """node, rows, unit of about SAMPLE rows of each node of ``sizes``, by a hash of the row."""
    chance = F.pmod(F.xxhash64(F.lit("sample"), "key", "node"), F.lit(1 << 20)) / (1 << 20)
    some = places.join(sizes, "node").filter(chance * F.col("rows") < SAMPLE)
    return some.join(classes.select("key", "unit"), "key").select("node", "rows", "unit", "key")


def grow(classes: DataFrame, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """(key, node): the leaves of every class in every tree."""

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key")
        node = int(pdf["node"].iloc[0])
        return pd.DataFrame([(node, *_fit(node, _stack(pdf["unit"].tolist()), float(pdf["rows"].iloc[0]), cosine, leaf))], columns=["node", "thresholds", "choices"])

    def route(batches):
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            keys, units_ = batch.column("key").to_pylist(), batch.column("unit").to_pylist()
            out: list[tuple[bytes, int, bool]] = []
            for node in np.unique(nodes):
                rows = np.flatnonzero(nodes == node)
                x = _stack([units_[i] for i in rows])
                thresholds, choices = (batch.column(c)[int(rows[0])].as_py() for c in ("thresholds", "choices"))
                spill, todo = _spill(x.shape[1], cosine), [(1, np.arange(len(rows)))]
                while todo:
                    place, some = todo.pop()
                    if place >= len(thresholds) or math.isinf(thresholds[place]):
                        name = int.from_bytes(hashlib.blake2b(f"{node}:{place}".encode(), digest_size=8).digest(), "little", signed=True)
                        over = place < len(thresholds) and choices[place] < 0
                        out.extend((keys[rows[i]], name, over) for i in some)
                        continue
                    p = x[some] @ _direction(int(node), place, choices[place], x.shape[1])
                    todo += [(2 * place, some[p <= thresholds[place] + spill]), (2 * place + 1, some[p >= thresholds[place] - spill])]
            if out:
                k, n, o = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.binary()), pa.array(n, pa.int64()), pa.array(o, pa.bool_())], ["key", "node", "over"])

    tree = F.explode(F.sequence(F.lit(1), F.lit(trees)))
    open_ = classes.select("key", F.length("unit").alias("width"), tree.alias("tree")).select("key", F.xxhash64("tree", "width").alias("node"), F.lit(False).alias("over"))
    leaves = None
    while True:
        open_ = written(open_, "places")
        sizes = written(open_.filter("NOT over").groupBy("node").agg(F.count("*").alias("rows")).filter(F.col("rows") > leaf), "open-nodes")
        done = open_.join(sizes, "node", "left_anti").select("key", "node")
        leaves = done if leaves is None else leaves.unionByName(done)
        if sizes.isEmpty():
            return leaves
        subtrees = _sampled(open_, sizes, classes).groupBy("node").applyInPandas(fit, "node long, thresholds array<double>, choices array<int>")
        subtrees = written(subtrees, "subtrees")
        open_ = open_.select("key", "node").join(subtrees, "node").join(classes.select("key", "unit"), "key").mapInArrow(route, "key binary, node long, over boolean")


def balls(leaves: DataFrame, classes: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(key, ball): for rows of large leaves, the largest ball they are in. Members of a ball are all linked."""
    half = math.cos(math.acos(cosine) / 2 - 1e-9)

    def centre(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key")
        x = _stack(pdf["unit"].tolist())
        return pd.DataFrame({"node": pdf["node"].iloc[:1], "centre": [x[_ball(x, cosine)[1]].tobytes()]})

    def inside(batches):
        for batch in batches:
            u, c = batch.column("unit").to_pylist(), batch.column("centre").to_pylist()
            near = [float(np.frombuffer(a) @ np.frombuffer(b)) >= half for a, b in zip(u, c)]
            yield batch.select(["key", "node"]).filter(pa.array(near, pa.bool_()))

    large = leaves.groupBy("node").agg(F.count("*").alias("rows")).filter(F.col("rows") > block)
    large = written(large, "large-leaves")
    centres = _sampled(leaves, large, classes).groupBy("node").applyInPandas(centre, "node long, centre binary")
    found = leaves.join(written(centres, "centres"), "node").join(classes.select("key", "unit"), "key").select("key", "node", "unit", "centre")
    found = written(found.mapInArrow(inside, "key binary, node long"), "in-balls")
    sized = found.join(found.groupBy("node").agg(F.count("*").alias("c")), "node")
    return written(sized.groupBy("key").agg(F.max_by("node", F.struct("c", "node")).alias("ball")), "balls")


def _meetings(leaves: DataFrame, of_ball: DataFrame, most: int) -> DataFrame:
    """(key, node, a, b, block): the comparisons that a row takes part in; large leaves in pairs of blocks."""
    rows = leaves.join(of_ball, "key", "left")
    sizes = rows.groupBy("node", "ball").agg(F.count("*").alias("c")).groupBy("node").agg(F.sum("c").alias("rows"), F.max(F.when(F.col("ball").isNotNull(), F.struct("c", "ball"))).alias("main"))
    sizes = sizes.filter("rows > 1").select("node", "rows", F.col("main.ball").alias("main"), F.coalesce("main.c", F.lit(0)).alias("core"))
    large = F.col("rows") > most
    blocks = lambda n: F.ceil(n / most).cast("int")
    rest_n, core_n = F.when(large, blocks(F.col("rows") - F.col("core"))).otherwise(1), F.when(large, blocks(F.col("core"))).otherwise(0)
    sizes = sizes.withColumns({"rest_n": rest_n, "core_n": core_n})
    rows = rows.join(sizes, "node").withColumn("in_core", F.coalesce(F.col("core_n") > 0, F.lit(False)) & F.coalesce(F.col("ball") == F.col("main"), F.lit(False)))
    hash_ = F.xxhash64(F.lit("block"), "key")
    block = F.when(F.col("in_core"), F.col("rest_n") + F.pmod(hash_, F.greatest("core_n", F.lit(1)))).otherwise(F.pmod(hash_, F.greatest("rest_n", F.lit(1)))).cast("int")
    # A block of the ball meets every other block; the others meet all blocks, themselves included.
    partners = F.when(F.col("in_core"), F.col("rest_n")).otherwise(F.col("rest_n") + F.col("core_n"))
    rows = rows.withColumn("block", block).filter(partners > 0).withColumn("with", F.explode(F.sequence(F.lit(0), partners - 1)))
    return rows.select("key", "node", F.least("block", "with").alias("a"), F.greatest("block", "with").alias("b"), "block")


def _roots(adjacent: np.ndarray) -> np.ndarray:
    """Each row's smallest reachable row."""
    label = np.arange(len(adjacent))
    while True:
        new = np.minimum(label, np.where(adjacent, label[None, :], len(label)).min(axis=1, initial=len(label)))
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _compare(pdf: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links among the rows of one comparison: key, root (a linked key, smallest of its component here), n (weight of new links)."""
    node, one = int(pdf["node"].iloc[0]), pdf["a"].iloc[0] == pdf["b"].iloc[0]
    pdf = pdf.sort_values("key")
    x, block, ball = _stack(pdf["unit"].tolist()), pdf["block"].to_numpy(), pdf["ball"].fillna(0).to_numpy(np.int64)
    hits = np.zeros((len(x), len(x)), bool)
    for i in range(0, len(x), 512):
        part = slice(i, i + 512)
        hits[part] = x[part] @ x.T >= cosine
        hits[part] &= (ball[part, None] != ball[None, :]) | (ball[part, None] == 0)
        if not one:
            hits[part] &= block[part, None] != block[None, :]
    np.fill_diagonal(hits, False)
    linked = np.flatnonzero(hits.any(axis=1))
    if not len(linked):
        return pd.DataFrame({"key": [], "root": [], "n": []}).astype({"key": object, "root": object, "n": "int64"})
    hits = hits[np.ix_(linked, linked)]
    some = pdf.iloc[linked]
    # Pairs that also share a smaller leaf are counted there.
    smaller: dict[int, list[int]] = {}
    for i, nodes in enumerate(some["nodes"]):
        for other in nodes:
            if other < node:
                smaller.setdefault(other, []).append(i)
    shared = [members for members in smaller.values() if len(members) > 1]
    member = np.zeros((len(linked), len(shared)), np.float32)
    for k, members in enumerate(shared):
        member[members, k] = 1
    new = hits & ~(member @ member.T > 0)
    keys = some["key"].to_numpy()
    return pd.DataFrame({"key": keys, "root": keys[_roots(hits)], "n": (new @ some["weight"].to_numpy(np.float64)).round().astype("int64")})


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id (smallest vec_id reachable), kept.

    Two vectors of equal length are linked if their cosine is at least ``cosine``. Vectors that are null, empty, zero or
    hold null or non-finite components link with nothing; so do rows without an id, which have a null component and are
    kept. Rows that repeat an id are vectors of their own. Other columns are ignored; an empty table gives an empty result.
    """
    rows = written(units(vectors, vec_id, embedding), "units")
    classes = written(rows.filter("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("weight"), F.min("vec_id").alias("rep"), F.first("unit").alias("unit")), "classes")
    leaves = written(grow(classes, cosine, trees, leaf), "leaves")
    of_ball = balls(leaves, classes, cosine, block)
    about = classes.select("key", "weight", "unit").join(leaves.groupBy("key").agg(F.collect_list("node").alias("nodes")), "key").join(of_ball, "key", "left")
    meet = _meetings(leaves, of_ball, block).join(about, "key").groupBy("node", "a", "b")
    found = written(meet.applyInPandas(lambda pdf: _compare(pdf, cosine), "key binary, root binary, n long"), "links")

    inside = of_ball.join(classes.select("key", "weight"), "key")
    whole = inside.groupBy("ball").agg(F.sum("weight").alias("all"), F.min("key").alias("root"))
    inside = inside.join(whole, "ball").select("key", "root", (F.col("all") - F.col("weight")).alias("n"))
    links = written(found.unionByName(inside), "all-links")
    labels = components(links.select(F.col("key").alias("a"), F.col("root").alias("b")))
    of_class = classes.select("key", "rep", "weight").join(labels, "key", "left").join(links.groupBy("key").agg(F.sum("n").alias("n")), "key", "left").withColumn("root", F.coalesce("root", "key"))
    component = of_class.groupBy("root").agg(F.min("rep").alias("component"))
    of_class = of_class.join(component, "root").select("key", "component", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    out = rows.select("vec_id", "key").join(of_class, "key", "left")
    component: Column = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))

"""Near-duplicates by SetSketch registers: bands of registers propose, a joint likelihood estimates, sets decide.

1. Every text becomes its set of distinct word shingles, a 128-bit name of that set, and a SetSketch:
   register i holds the exponentially spaced level ``floor(1 - log_b(min of exponential hashes))``,
   truncated; sketches of parts merge by the maximum.
2. Texts with equal sets form a class; from here on only one row per class is used, so exact copies cost
   nothing however many there are.
3. Bands of four registers put classes into buckets. The number of bands follows from the threshold so
   that a pair at the threshold misses every bucket with probability below ``MISS``.
4. Members with too many shingles of their own to be linked at all leave their bucket. Each bucket links
   the others to one central member only (no pairs within a group). The sketches of a candidate pair
   give a likelihood estimate of its similarity; pairs far below the threshold go, the rest is confirmed
   on the full sets. Linked classes get component labels.
5. Members of buckets that still hold different labels are compared once more, across labels only, by an
   exact prefix filter on their rarest shingles; so no link between texts that share a bucket is lost.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import free_name, row_key, table, written
from .shingles import mix, set_key, shingle_set

#: Fixed values of the sketch: base, rate and number of levels of a register.
BASE, RATE, LEVELS = 1.001, 20.0, 2**16 - 2
ROWS = 4
MISS = 1e-6
#: A pair is dropped before the exact check if its estimate is so many standard deviations too low.
DEVIATIONS = 5.0


def bands_for(percent: int) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROWS))


def sketch(shingles: np.ndarray, registers: int) -> np.ndarray:
    """Registers (uint16) of a set of 64-bit hashes."""
    i = np.arange(1, registers + 1, dtype=np.uint64)
    a, b = mix(i) | np.uint64(1), mix(i + np.uint64(1 << 32))
    low = np.full(registers, np.iinfo(np.uint64).max, np.uint64)
    for part in range(0, len(shingles), 2048):
        low = np.minimum(low, (shingles[part : part + 2048, None] * a + b).min(axis=0))
    least = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(least) / math.log(BASE)), 0, LEVELS + 1).astype(np.uint16)


def joint_estimate(s: np.ndarray, t: np.ndarray, n_s: np.ndarray, n_t: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity of pairs from their registers (rows) and set sizes.

    With u and v the two sizes' shares of their sum, a register of s is larger with probability
    p(u - v J), smaller with p(v - u J), where p(x) = -log_b(1 - x (b - 1) / b).
    """
    more, less = (s > t).sum(axis=1), (s < t).sum(axis=1)
    same = s.shape[1] - more - less
    u = n_s / (n_s + n_t)
    v = 1 - u
    p = lambda x: np.clip(-np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / math.log(BASE), 1e-12, 1)

    def likelihood(j):
        a, b = p(u - v * j), p(v - u * j)
        return more * np.log(a) + less * np.log(b) + same * np.log(np.clip(1 - a - b, 1e-12, 1))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):  # the likelihood is concave in J
        x, y = low + (high - low) / 3, high - (high - low) / 3
        left = likelihood(x) > likelihood(y)
        low, high = np.where(left, low, x), np.where(left, y, high)
    return (low + high) / 2


def _features(docs: DataFrame, k: int, bands: int) -> DataFrame:
    """row, doc_id, n (size of the set), key (its name; null for the empty set), sketch (a long per band)."""

    def run(batches):
        for batch in batches:
            n, keys, rows = [], [], []
            for text in batch.column(2).cast(pa.binary()).to_pylist():
                s = shingle_set(text, k)
                n.append(len(s))
                keys.append(set_key(s) if len(s) else None)
                rows.append(sketch(s, ROWS * bands).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(rows, pa.list_(pa.int64()))], ["row", "doc_id", "n", "key", "sketch"])

    return docs.select("row", "doc_id", "text").mapInArrow(run, "row binary, doc_id long, n long, key binary, sketch array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(key, shingles) of the wanted classes, from the text of one row (id and text) of each, however many texts its id has."""

    def run(batches):
        for batch in batches:
            keys, sets = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                s = shingle_set(text, k)
                keys.append(key)
                sets.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["key", "shingles"])

    texts = docs.select("row", "text").join(wanted.select("key", F.col("rep_row").alias("row")), "row").select("key", "text")
    return texts.mapInArrow(run, "key binary, shingles array<long>").dropDuplicates(["key"])


def _two_sides(pairs: DataFrame, side: DataFrame, columns: list[str]) -> DataFrame:
    for x in ("a", "b"):
        pairs = pairs.join(side.select(F.col("key").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in columns)), x)
    return pairs


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose set sizes and sketches allow the threshold."""
    t = percent / 100

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            get = lambda c: np.array(batch.column(c).to_pylist(), dtype=np.int64)
            s, u = (np.ascontiguousarray(get(c)).view(np.uint16) for c in ("sketch_a", "sketch_b"))
            est = joint_estimate(s, u, get("n_a").astype(float), get("n_b").astype(float))
            slack = DEVIATIONS * math.sqrt(t * (1 - t) / s.shape[1])
            yield batch.select(["a", "b"]).filter(pa.array(est >= t - slack))

    both = _two_sides(pairs, classes, ["n", "sketch"])
    both = both.filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return both.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(run, "a binary, b binary")


def _possible(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Bucket members that can have a link at all: band, value, head of the bucket, key.

    A shingle that no other member of any bucket has cannot be shared. With u such shingles of its n, a
    text shares at most n - u, so a partner of size m needs 100 (n - u) >= percent (m + u). A member that
    fails this for the smallest size in its bucket has no link there and goes; no link is lost. The head
    is the member with the fewest such shingles, the most central one.
    """
    owned = sets.select("key", F.explode("shingles").alias("h"))
    alone = owned.groupBy("h").agg(F.count("*").alias("c"), F.min("key").alias("key")).filter("c = 1").groupBy("key").agg(F.count("*").alias("u"))
    lonely = sets.select("key").join(alone, "key", "left").select("key", F.coalesce("u", F.lit(0)).alias("u"))
    low = members.groupBy("band", "value").agg(F.min("n").alias("low"))
    left = members.join(lonely, "key").join(low, ["band", "value"]).filter(100 * (F.col("n") - F.col("u")) >= percent * (F.col("low") + F.col("u")))
    heads = left.groupBy("band", "value").agg(F.min(F.struct("u", "key"))["key"].alias("head"), F.count("*").alias("size")).filter("size > 1")
    return left.join(heads, ["band", "value"]).select("band", "value", "head", "key")


def _apart(named: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes (key, root) of different roots that can reach the threshold, by prefix filter.

    With the shingles of every set in one global order, rarest first, two sets of sizes n and m that share
    at least A = percent (n + m) / (100 + percent) shingles have a common one at positions i and j with
    1 + min(n - i, m - j) >= A. So only the rare ends of the sets are joined, which loses no link; shingles
    that a large group has in common come last and are not among them. Roots are paired per shingle before
    their members, so members of one component are never compared.
    """
    tokens = sets.join(named, "key").select("key", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("h"))
    often = tokens.groupBy("h").agg(F.count("*").alias("df"))
    order = W.partitionBy("key").orderBy("df", "h")
    ends = tokens.join(often, "h").withColumn("pos", F.row_number().over(order))
    ends = written(ends.filter((F.col("df") > 1) & (F.col("pos") <= F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1)), "ends")
    near = lambda left_a, n_a, left_b, n_b: (1 + F.least(left_a, left_b)) * (100 + percent) >= percent * (F.col(n_a) + F.col(n_b))
    groups = ends.groupBy("h", "root").agg(F.min("n").alias("n"), F.max(F.col("n") - F.col("pos")).alias("left"))
    side = lambda df, x, left, *more: df.select("h", F.col("root").alias(f"root_{x}"), F.col("n").alias(f"n_{x}"), left.alias(f"left_{x}"), *more)
    group = lambda x: side(groups, x, F.col("left"))
    member = lambda x: side(ends, x, F.col("n") - F.col("pos"), F.col("key").alias(f"key_{x}"))
    two = group("r").join(group("s"), "h").filter((F.col("root_r") < F.col("root_s")) & near("left_r", "n_r", "left_s", "n_s"))
    two = two.drop("left_r", "n_r").join(member("r"), ["h", "root_r"]).filter(near("left_r", "n_r", "left_s", "n_s"))
    two = two.drop("left_s", "n_s").join(member("s"), ["h", "root_s"]).filter(near("left_r", "n_r", "left_s", "n_s"))
    return two.select(F.least("key_r", "key_s").alias("a"), F.greatest("key_r", "key_s").alias("b")).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            keep = []
            for s, u in zip(batch.column("shingles_a"), batch.column("shingles_b")):
                s, u = s.values.to_numpy(), u.values.to_numpy()
                both = len(np.intersect1d(s, u, assume_unique=True))
                keep.append(100 * both >= percent * (len(s) + len(u) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _two_sides(pairs, sets, ["shingles"]).select("a", "b", "shingles_a", "shingles_b").mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(key, root) of every node of the edges (a, b): root is the component's smallest key.

    Alternating large-star and small-star steps; every round is a written table, so a round survives the
    loss of executors. Hubs are handled by partial aggregation and a join, never as one group.
    """

    def star(e: DataFrame) -> DataFrame:
        low = e.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        return e.join(low, "u")

    def round_(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = star(large)
        return small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).filter(F.col("u") != F.col("v")).distinct()

    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter(F.col("u") != F.col("v")).distinct()
    now, last = written(now, label), None
    seen = state(now)
    while seen != last:
        last = seen
        now = written(round_(now), label)
        seen = state(now)
    return now.select(F.col("u").alias("key"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("key"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 3, percent: int = 85) -> DataFrame:
    """One row per row of ``docs``: row (128 bits of id and text), doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * intersection >= percent * union of their sets of ``k``-word shingles
    (A-Z lower-cased); fewer than ``k`` words are one shingle. ``component_id`` is the smallest doc_id that
    links reach. Null, empty and white texts have the empty set and are linked with nothing. Rows that
    repeat a doc_id are judged by their own texts. A null doc_id is linked with nothing, has a null
    component and is kept. An empty table gives an empty result.
    """
    bands = bands_for(percent)
    docs = docs.select(row_key(F.col(doc_id), F.col(text)).alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    features = written(_features(docs, k, bands), "features")
    linkable = features.filter(F.col("key").isNotNull() & F.col("doc_id").isNotNull())
    classes = written(linkable.groupBy("key").agg(F.min(F.struct("doc_id", "row")).alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")).select("key", "rep.doc_id", "rep.row", "n", "sketch").withColumnsRenamed({"doc_id": "rep", "row": "rep_row"}), "classes")
    placed = classes.select("key", "n", F.posexplode("sketch").alias("band", "value"))
    shared = placed.groupBy("band", "value").agg(F.count("*").alias("size")).filter("size > 1").select("band", "value")
    members = written(placed.join(shared, ["band", "value"]), "buckets")
    nodes = members.select("key").distinct()
    sets = written(_sets(docs, classes.select("key", "rep_row").join(nodes, "key"), k), "sets")
    members = written(_possible(members, sets, percent), "members")

    def links(pairs: DataFrame, label: str) -> DataFrame:
        likely = written(_plausible(pairs, classes, percent), label)
        return written(_confirmed(likely, sets, percent), "links")

    first = written(members.filter("head != key").select(F.least("head", "key").alias("a"), F.greatest("head", "key").alias("b")).distinct(), "pairs")
    found = links(first, "likely")
    labels = components(found)
    # What is left: pairs of a bucket with different labels that have not been compared.
    named = members.join(labels, "key", "left").select("band", "value", "key", F.coalesce("root", "key").alias("root"))
    open_ = named.groupBy("band", "value").agg(F.countDistinct("root").alias("roots"), F.count("*").alias("size")).filter("roots > 1 and size > 2")
    named = written(named.join(open_.select("band", "value"), ["band", "value"]).select("key", "root").distinct(), "open")
    rest = _apart(named, sets, percent).join(first, ["a", "b"], "left_anti")
    more = links(rest, "rest")
    if not more.isEmpty():
        labels = components(found.unionByName(more))
    of_class = classes.select("key", "rep").join(labels, "key")
    of_root = of_class.groupBy("root").agg(F.min("rep").alias("component"))
    named_class = of_class.join(of_root, "root").select("key", "component")
    every = classes.select("key", "rep").join(named_class, "key", "left").select("key", F.coalesce("component", "rep").alias("component"))
    # Rows without a set or an id join nothing: their key is null there.
    out = features.withColumn("key", F.when(F.col("doc_id").isNotNull(), F.col("key"))).join(every, "key", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("row", "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id; its columns stay as they are.

    Rows equal in id and text count as one document. Documents without words (null, empty or white texts)
    and rows without an id are all kept, once per id and text. An empty table stays empty.
    """
    row = free_name(docs, "_row")
    kept = near_duplicates(docs, doc_id, text, k, percent).filter("kept").select(F.col("row").alias(row)).distinct()
    return docs.withColumn(row, row_key(F.col(doc_id), F.col(text))).join(kept, row, "left_semi").dropDuplicates([row]).drop(row)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")

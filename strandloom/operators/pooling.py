"""Pooling of peaks that are chains of blocks: an algebra of blocks, groups of overlap edges, and pooling of two or many sets.

A peak has gene, chrom, strand, ``blocks`` (structs of start and end, sorted, apart), ``labels`` (sorted) and, for pooling by
caller, ``rank`` (0 is the most trusted). Equal structures of a gene are one peak; its id is made of them, so every step gives
the same rows for every partitioning.
"""

from __future__ import annotations

from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import intervals as I
from . import scans
from .stored import written

BLOCKS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
#: Share of the pooled parts that what is left of a longer peak needs to stay a peak.
REMAINDER = 0.7


def length(blocks: Column) -> Column:
    return F.aggregate(blocks, F.lit(0).cast("long"), lambda n, b: n + b["end"] - b["start"])


def intersect_blocks(a: Column, b: Column) -> Column:
    """The shared parts of two chains."""
    part = lambda x, y: F.struct(F.greatest(x["start"], y["start"]).alias("start"), F.least(x["end"], y["end"]).alias("end"))
    return F.flatten(F.transform(a, lambda x: F.filter(F.transform(b, lambda y: part(x, y)), lambda z: z["start"] < z["end"])))


def union_blocks(a: Column, b: Column) -> Column:
    """All bases of two chains; blocks that overlap or touch are one."""

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= x["start"]), joined).otherwise(F.array_append(done, x))

    return F.aggregate(F.array_sort(F.concat(a, b)), F.array().cast(BLOCKS), add)


def _structures(peaks: DataFrame) -> DataFrame:
    """One row per structure of a gene: labels united, the best rank."""
    keys = ["gene", "chrom", "strand", "blocks"]
    return peaks.filter(F.size("blocks") > 0).groupBy(*keys).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("labels")))).alias("labels"), F.min("rank").alias("rank"))


def _id(blocks: str = "blocks") -> Column:
    return F.md5(F.to_json(F.struct("gene", "chrom", "strand", F.col(blocks).alias("blocks"))))


def _named(structures: DataFrame) -> DataFrame:
    return structures.withColumn("id", _id())


def _counted(structures: DataFrame, label: str, replaces: list[DataFrame] = ()) -> DataFrame:
    """Structures written with a number ``n``, by which pairs name them in a few bytes."""
    return written(structures.withColumn("n", F.monotonically_increasing_id()), label, replaces)


def _met(a: DataFrame, b: DataFrame) -> DataFrame:
    """(id, b_id, same) of peaks whose blocks share bases on one strand, whatever their gene; ``same``: they are of one gene."""
    flat = lambda d: d.select("id", "gene", "chrom", "strand", F.explode("blocks").alias("x")).select("id", "gene", "chrom", "strand", "x.start", "x.end")
    return I.overlap_join(flat(a), flat(b), strand="same").groupBy("id", "b_id").agg(F.max(F.col("gene") == F.col("b_gene")).alias("same"))


def _joined(pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs with the columns of both sides, those of ``b`` as b_*."""
    return pairs.join(a, "id").join(b.select(*(F.col(c).alias(f"b_{c}") for c in b.columns)), "b_id")


def overlap_edges(peaks: DataFrame) -> DataFrame:
    """(id, b_id) of different peaks of one gene whose blocks share bases."""
    flat = peaks.filter("gene IS NOT NULL AND strand <> '.'").select("id", F.struct("gene", "chrom", "strand").alias("chrom"), F.explode("blocks").alias("_b"))
    # Only blocks of one gene, chromosome and strand meet; they are written once, since the join reads them four times.
    flat = written(flat.filter("chrom.chrom IS NOT NULL").select("id", "chrom", "_b.start", "_b.end"), "blocks")
    return I.overlap_join(flat, flat).filter("id < b_id").select("id", "b_id").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, group) of the ends of edges (id, b_id): the group is the smallest id that edges reach.

    Rounds of two star steps, each a written table: every node first links its larger neighbours, then its smaller ones,
    to the smallest of them. A node with many edges is a partial aggregate and a join, never one group.
    """

    def star(e: DataFrame) -> DataFrame:
        return e.join(e.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "u")

    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = written(edges.select(F.greatest("id", "b_id").alias("u"), F.least("id", "b_id").alias("v")).filter("u <> v").distinct(), "edges")
    last = None
    while last != (seen := state(now)):
        last = seen
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = star(large)
        now = written(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "edges", [now])
    return now.select(F.col("u").alias("id"), F.col("v").alias("group")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("group")).distinct())


def separate_overlapping(peaks: DataFrame) -> DataFrame:
    """``peaks`` (with id) with ``group``, the smallest id of their overlap edges within a gene; null for peaks that meet no other."""
    return peaks.join(components(overlap_edges(peaks)), "id", "left")


def _chain(rows: DataFrame, key: str) -> DataFrame:
    """(key, blocks): the union of all block rows (key, start, end) of a key."""
    found = scans.islands(rows.groupBy(key, "start").agg(F.max("end").alias("end")), [key])
    merged = found.groupBy(key, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return merged.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("blocks"))


def pool_groups(a: DataFrame, b: DataFrame, mode: str = "mergeGroup", min_len: int = 1, max_len: int = 10**9) -> DataFrame:
    """Peaks of two sets (id, gene, chrom, strand, blocks) pooled: gene, chrom, strand, blocks, labels (``a``, ``b`` or ``a,b``).

    ``merge`` and ``intersect`` make a peak of every pair of one gene and strand that shares bases, ``mergeGroup`` and
    ``intersectGroup`` one of every group that such pairs connect: the union of its peaks, or of its pairs' shared parts. A merged
    group longer than ``max_len`` gives its pairs' unions instead. Peaks that meet nothing of the other set stay; those that meet
    peaks of other genes only go. Lengths outside the limits are dropped at the end.
    """
    a, b = (d.select(F.concat(F.lit(s), F.col("id").cast("string")).alias("id"), "gene", "chrom", "strand", "blocks") for d, s in ((a, "a"), (b, "b")))
    met = written(_met(a, b), "pairs")
    pairs = written(_joined(met.filter("same"), a, b).filter("gene = b_gene").select("id", "b_id", "gene", "chrom", "strand", "blocks", "b_blocks"), "gene-pairs")
    one = union_blocks if mode.startswith("merge") else intersect_blocks
    by_pair = pairs.withColumn("blocks", one(F.col("blocks"), F.col("b_blocks"))).drop("b_blocks")
    if mode.endswith("Group"):
        groups = components(pairs.select("id", "b_id"))
        by_pair = written(by_pair.join(groups, "id"), "pairs-of-groups", [pairs])
        flat = by_pair.select("group", F.explode("blocks").alias("x")).select("group", "x.*")
        about = by_pair.select("group", "gene", "chrom", "strand").distinct()
        whole = _chain(flat, "group").join(about, "group")
        if mode == "mergeGroup":
            large = whole.filter(length(F.col("blocks")) > max_len).select("group")
            pooled = whole.join(large, "group", "left_anti").select("gene", "chrom", "strand", "blocks").unionByName(by_pair.join(large, "group").select("gene", "chrom", "strand", "blocks"))
        else:
            pooled = whole.select("gene", "chrom", "strand", "blocks")
    else:
        pooled = by_pair.select("gene", "chrom", "strand", "blocks")
    alone = lambda d, c, label: d.join(met.select(F.col(c).alias("id")).distinct(), "id", "left_anti").select("gene", "chrom", "strand", "blocks", F.lit(label).alias("labels"))
    out = pooled.withColumn("labels", F.lit("a,b")).unionByName(alone(a, "id", "a")).unionByName(alone(b, "b_id", "b"))
    return out.filter(length(F.col("blocks")).between(min_len, max_len))


def _remainder(large: Column, small: Column, least: int, overhang: Column) -> Column:
    """What is left of a chain beside a single block that meets only its first or only its last block; else null.

    ``least`` bases next to the shared part go too. Without ``overhang`` the single block must lie inside.
    """
    s, n = F.get(small, F.lit(0)), F.size(large)
    meets = F.transform(large, lambda x: F.least(x["end"], s["end"]) > F.greatest(x["start"], s["start"]))
    at = F.array_position(meets, True)  # from 1
    only = (F.size(F.filter(meets, lambda m: m)) == 1) & ((at == 1) | (at == n))
    x = F.get(large, (at - 1).cast("int"))
    inside = overhang | ((s["start"] >= x["start"]) & (s["end"] <= x["end"]))
    first = F.struct((F.least(s["end"], x["end"]) + least).alias("start"), x["end"].alias("end"))
    last = F.struct(x["start"].alias("start"), (F.greatest(s["start"], x["start"]) - least).alias("end"))
    kept = lambda y: F.filter(F.array(y), lambda z: z["end"] - z["start"] >= least)
    rest = F.when(at == 1, F.concat(kept(first), F.slice(large, F.lit(2), n - 1))).otherwise(F.concat(F.slice(large, F.lit(1), n - 1), kept(last)))
    return F.when((F.size(small) == 1) & (n > 1) & only & inside & (F.size(rest) > 0), rest)


def _settle(parts: list, least: int, fraction: float) -> list:
    """Remainders of one peak, as blocks (part, start, end) in order: each joins the first kept one of its kind (one block, several) whose shared part with it is long enough."""
    kept: list[list[tuple[int, int]]] = []
    blocks: dict[int, list[tuple[int, int]]] = {}
    for b in parts:
        blocks.setdefault(int(b["part"]), []).append((int(b["start"]), int(b["end"])))
    for p in sorted(blocks.values()):
        for k, q in enumerate(kept):
            both = [(max(a, c), min(b, d)) for a, b in q for c, d in p if max(a, c) < min(b, d)]
            n, own, other = (sum(b - a for a, b in x) for x in (both, q, p))
            if (len(p) > 1) == (len(q) > 1) and n >= least and (n >= fraction * own or n >= fraction * other):
                kept[k] = both
                break
        else:
            kept.append(p)
    return [[{"start": a, "end": b} for a, b in q] for q in kept]


def _valid_pairs(a: DataFrame, b: DataFrame, min_len: int, fraction: float) -> DataFrame:
    """(n, b_n, overlap) of structures of one gene and strand that share ``min_len`` bases and ``fraction`` of either."""

    def flat(d):
        known = d.filter("gene IS NOT NULL AND chrom IS NOT NULL AND strand <> '.'")  # others meet nothing
        rows = known.select("n", F.struct("gene", "chrom", "strand").alias("chrom"), length(F.col("blocks")).alias("size"), F.explode("blocks").alias("x"))
        return rows.select("n", "chrom", "size", "x.start", "x.end")

    hits = I.overlap_join(flat(a), flat(b)).groupBy("n", "b_n").agg(F.sum("overlap").alias("overlap"), F.max("size").alias("size"), F.max("b_size").alias("b_size"))
    share = lambda c: F.col("overlap") >= fraction * F.col(c)
    return hits.filter((F.col("overlap") >= min_len) & (share("size") | share("b_size"))).select("n", "b_n", "overlap")


def _pool(a: DataFrame, b: DataFrame, min_len: int, max_len: int, fraction: float, final: bool) -> tuple[DataFrame, list[DataFrame]]:
    """``pool_peaks`` of structures with numbers (``_counted``), as structures; and the written tables that these read.

    Peaks move with their pairs once: those in no pair stay in the same rows, so nothing is joined a second time to find them.
    """
    pairs = written(_valid_pairs(a, b, min_len, fraction), "valid-pairs")
    left = a.join(pairs.withColumnRenamed("b_n", "_to"), "n", "left")
    left = left.withColumn("_to", F.coalesce("_to", -1 - F.col("n")))  # without a partner: a number that no peak has, not one null for all
    right = b.select(*(F.col(c).alias(f"b_{c}") for c in b.columns))
    both = left.join(right, left["_to"] == right["b_n"], "full")
    met = F.col("n").isNotNull() & F.col("b_n").isNotNull()
    mine = F.col("n").isNotNull()
    side = lambda c: F.when(mine, F.col(c)).otherwise(F.col(f"b_{c}"))
    one_a, one_b = F.size("blocks") == 1, F.size("b_blocks") == 1
    longer = F.when(one_a, F.col("b_blocks")).otherwise(F.col("blocks"))
    equal = F.when(one_a != one_b, longer).otherwise(intersect_blocks(F.col("blocks"), F.col("b_blocks")))
    pooled = F.when(F.col("rank") == F.col("b_rank"), equal).when(F.col("rank") < F.col("b_rank"), F.col("blocks")).otherwise(F.col("b_blocks"))
    choose = lambda x, c: F.when(met, x).otherwise(side(c))
    about = [side(c).alias(c) for c in ("gene", "chrom", "strand")]
    peak = F.struct(choose(pooled, "blocks").alias("blocks"), choose(F.array_sort(F.array_union("labels", "b_labels")), "labels").alias("labels"), choose(F.least("rank", "b_rank"), "rank").alias("rank"))
    if final:
        return _structures(both.select(*about, peak.alias("x")).select("gene", "chrom", "strand", "x.*").filter(length(F.col("blocks")).between(min_len, max_len))), [pairs]
    # The chain that can leave a rest: the one of several blocks at equal rank, else the one of the worse rank.
    chain_b = F.when(F.col("rank") == F.col("b_rank"), one_a).otherwise(F.col("rank") < F.col("b_rank"))
    pick = lambda c, d: F.when(chain_b, F.col(c)).otherwise(F.col(d))
    rest = F.when(met, _remainder(pick("b_blocks", "blocks"), pick("blocks", "b_blocks"), min_len, F.col("rank") != F.col("b_rank")))
    enough = length(rest) >= REMAINDER * (F.col("overlap") + min_len + length(rest))
    rest = F.when(enough, F.struct(rest.alias("blocks"), pick("b_labels", "labels").alias("labels"), pick("b_rank", "rank").alias("rank"), pick("b_blocks", "blocks").alias("large")))
    rows = written(both.select(*about, peak.alias("peak"), rest.alias("rest")), "pooled", [pairs])
    settle = F.pandas_udf(lambda parts: pd.Series([_settle(p, min_len, fraction) for p in parts]), T.ArrayType(BLOCKS))
    left = rows.filter("rest IS NOT NULL").select("gene", "chrom", "strand", "rest.*").withColumn("large", F.unhex(_id("large")))
    per = left.groupBy("large", "gene", "chrom", "strand", "rank").agg(F.first("labels").alias("labels"), F.collect_set("blocks").alias("parts"))
    # Flat, because arrays of arrays of unequal sizes do not reach a pandas UDF.
    flat = F.flatten(F.transform("parts", lambda p, i: F.transform(p, lambda b: F.struct(i.alias("part"), b["start"].alias("start"), b["end"].alias("end")))))
    per = per.withColumn("parts", flat)
    out = rows.select("gene", "chrom", "strand", "peak.*").unionByName(per.select("gene", "chrom", "strand", F.explode(settle("parts")).alias("blocks"), "labels", "rank"))
    return _structures(out.filter(length(F.col("blocks")).between(min_len, max_len))), [rows]


def pool_peaks(a: DataFrame, b: DataFrame, min_len: int = 1, max_len: int = 10**9, fraction: float = 0.5, final: bool = False) -> DataFrame:
    """Peaks of two sets (gene, chrom, strand, blocks, labels, rank) pooled by structure; the same columns and ``id``.

    Two peaks of one gene and strand are a pair if they share at least ``min_len`` bases and ``fraction`` of either. A pair of
    equal rank gives the shared parts, or the longer chain if only one of them is a single block; else the structure of the better
    rank is kept. Beside a single block that takes only an end of a chain, the rest of the chain stays a peak of its own if it is
    most of the pair, unless ``final``. Peaks in no pair stay. Lengths outside the limits are dropped.
    """
    a, b = (_counted(_structures(d), "structures") for d in (a, b))
    return _named(_pool(a, b, min_len, max_len, fraction, final)[0])


def pool_many_sets(sets: list[DataFrame], min_len: int = 1, max_len: int = 10**9, fraction: float = 0.5) -> DataFrame:
    """Many sets of peaks pooled: every two of them first, these results as a balanced tree of pools, then each original once more.

    ``sets`` come in the order of trust. In the last round what is pooled counts as more trusted than any original, so
    an original adds only what nothing has met. Every pool is a written table; a run repeats none of them, and a pool takes
    the place of those it is made of.
    """
    if len(sets) == 1:
        return _named(_structures(sets[0].filter(length(F.col("blocks")).between(min_len, max_len))))
    limits = {"min_len": min_len, "max_len": max_len, "fraction": fraction}
    sets = [_counted(_structures(d), "structures") for d in sets]

    def pool(a, b, final=False, gone=()):
        found, read = _pool(a, b, **limits, final=final)
        return _counted(found, "pool", [*read, *gone])

    level = [pool(x, y) for x, y in combinations(sets, 2)]
    while len(level) > 1:
        two = [level[k : k + 2] for k in range(0, len(level), 2)]
        level = [pool(*t, gone=t) if len(t) > 1 else t[0] for t in two]
    now = level[0]
    for original in sets:
        now = pool(now.withColumn("rank", F.lit(-1)), original, final=True, gone=[now, original])
    return _named(now.drop("n"))

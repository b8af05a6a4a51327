"""Prefix trie of conversations by whole-sequence collapse.

1. Every turn becomes a digest of (role, text) and its number of words; texts go no further.
2. Identical whole conversations become one weighted sequence with the list of conversations that end
   there, so copies cost one row each, once. A sequence is named by its length and two lanes of
   ``sum(turn * base ** place) mod p``; sums need no order, so a prefix is named by a running sum and a prefix's
   parent by taking its last term off. Bases are drawn anew in every run.
3. Prefixes of the distinct sequences are aggregated to nodes. Sequences that are proper prefixes of others go by an
   anti-join; what is left are the leaves.
4. A node's value belongs to the sequence of its smallest member. Sums from the end of a sequence backwards,
   aggregated by node, are sums over subtrees, whatever the trie's depth.

No conversation, node or list is one task's memory: places are numbered in ranges whose counts are
carried over, running sums are cut into cells of ``CELL`` places, lists travel in chunks and are hashed as a stream.
"""

from __future__ import annotations

import hashlib
import secrets as _random

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import table, words, written
from .merkle import CRC32_SQL

P = 2**61 - 1
CELL = 1024
#: Conversation ids in one chunk of an end list.
CHUNK = 4096
#: Every id is rebuilt on the first turns (fewer than HEADS) of the id at the start of its run of EVERY.
EVERY, HEADS = 20, 4
_NONE = hashlib.sha256(b"").hexdigest()
_LANES = ["s1", "s2", "len"]


def _lane(hex_: Column, k: int) -> Column:
    """60 bits of a hex digest."""
    return F.conv(F.substring(hex_, 15 * k + 1, 15), 16, 10).cast("long")


def turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, idx (place in the conversation, from 0), t1, t2 (the turn's digest), words.

    Null turns come first; turns of equal number follow each other by their digest. Null role or text is
    empty. Rows without an id belong to no conversation. Repeated rows are turns of their own.
    """
    r, t = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    name = F.sha2(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t), 256)
    rows = conversations.select(F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"), name.alias("name"), F.size(words(t)).cast("long").alias("words")).filter("conv IS NOT NULL")
    rows = written(rows.select("conv", "turn", _lane(F.col("name"), 0).alias("t1"), _lane(F.col("name"), 1).alias("t2"), "words"), "turns")
    order = [F.col("turn").asc_nulls_first(), F.col("t1").asc(), F.col("t2").asc()]
    rows = written(rows.repartitionByRange(F.col("conv").asc(), *order).withColumn("cell", F.spark_partition_id()), "turn-ranges")
    before = W.partitionBy("conv").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)  # a row per range
    carried = rows.groupBy("conv", "cell").agg(F.count("*").alias("c")).withColumn("before", F.coalesce(F.sum("c").over(before), F.lit(0))).drop("c")
    at = F.row_number().over(W.partitionBy("conv", "cell").orderBy(*order)) - 1
    return rows.withColumn("at", at).join(carried, ["conv", "cell"]).select("conv", (F.col("at") + F.col("before")).alias("idx"), "t1", "t2", "words")


def rebuild(own: DataFrame, every: int = EVERY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """All conversations (conv), and their rebuilt turns (conv, pos, t1, t2, words).

    Conversation c gets the first h turns of conversation c - c % every (fewer if it has fewer), then its
    own turns after its first h; h is the unsigned CRC-32 of the decimal c, modulo ``heads``.
    """
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    first = own.filter(F.col("idx") < heads - 1)
    there = first.groupBy("conv").agg(F.count("*").alias("there")).withColumnRenamed("conv", "base")
    convs = own.select("conv").distinct().withColumns({"h": h, "base": F.col("conv") - F.col("conv") % every})
    convs = convs.join(there, "base", "left").select("conv", "base", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("got"))
    head = convs.filter("got > 0").join(first.withColumnRenamed("conv", "base"), "base").filter("idx < got").select("conv", F.col("idx").alias("pos"), "t1", "t2", "words")
    tail = own.join(convs, "conv").filter("idx >= h").select("conv", (F.col("idx") - F.col("h") + F.col("got")).alias("pos"), "t1", "t2", "words")
    return convs.select("conv"), head.unionByName(tail)


def _terms(rows: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """``rows`` with u1 and u2, the terms ``t * base ** pos mod P``."""
    schema = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes) + ", u1 long, u2 long"

    def run(batches):
        powers = [[pow(b, i, P) for i in range(CELL)] for b in bases]
        for batch in batches:
            pos = batch.column("pos").to_pylist()
            out = batch
            for k, b in enumerate(bases):
                t = batch.column(f"t{k + 1}").to_pylist()
                u = [x * (powers[k][i] if i < CELL else pow(b, i, P)) % P for x, i in zip(t, pos)]
                out = out.append_column(f"u{k + 1}", pa.array(u, pa.int64()))
            yield out

    return rows.mapInArrow(run, schema)


def _modular(total: Column) -> Column:
    return (total % F.lit(P).cast("decimal(20,0)")).cast("long")


def _big(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)")


def collapse(ends: DataFrame) -> DataFrame:
    """Identical conversations (conv, s1, s2, len) as sequences: s1, s2, len, weight, rep (smallest member), ends_sha256.

    Chunks of sorted ids come from ranges of (sequence, id); a sequence's chunks are then hashed in their order as a
    stream. Digests are sequential, so one task reads a sequence's whole list, chunk by chunk.
    """

    def chunks(batches):
        key, ids = None, []

        def out():
            return pa.RecordBatch.from_pylist([dict(zip(_LANES, key), first=ids[0], c=len(ids), part=",".join(map(str, ids)))], _CHUNKS)

        for batch in batches:
            for *k, conv in zip(*(batch.column(c).to_pylist() for c in (*_LANES, "conv"))):
                if ids and (k != key or len(ids) == CHUNK):
                    yield out()
                    ids = []
                key = k
                ids.append(conv)
        if ids:
            yield out()

    def lists(batches):
        key, rows = None, []
        for batch in batches:
            for *k, first, c, part in zip(*(batch.column(x).to_pylist() for x in (*_LANES, "first", "c", "part"))):
                if k != key:
                    if key:
                        rows.append((*key, n, rep, h.hexdigest()))
                    key, n, rep, h = k, 0, first, hashlib.sha256()
                else:
                    h.update(b",")
                n += c
                h.update(part.encode())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*rows), _SEQUENCES)], schema=_SEQUENCES)
                rows = []
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*key, n, rep, h.hexdigest()), _SEQUENCES)], schema=_SEQUENCES)

    by = [*_LANES, "conv"]
    ranged = ends.select(*by).repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(chunks, "s1 long, s2 long, len long, first long, c long, part string")
    whole = written(ranged, "end-chunks").repartition(*_LANES).sortWithinPartitions(*_LANES, "first")
    return whole.mapInArrow(lists, "s1 long, s2 long, len long, weight long, rep long, ends_sha256 string")


_CHUNKS = pa.schema([(c, pa.int64()) for c in (*_LANES, "first", "c")] + [("part", pa.string())])
_SEQUENCES = pa.schema([(c, pa.int64()) for c in (*_LANES, "weight", "rep")] + [("ends_sha256", pa.string())])


def _running(rows: DataFrame, key: str, place: str, sums: dict[str, Column], backwards: bool = False) -> DataFrame:
    """Running sums of columns along ``place`` of each ``key``: inside cells of places, and carried over cells."""
    rows = rows.withColumn("_cell", F.floor(F.col(place) / CELL))
    to = lambda c: c.desc() if backwards else c.asc()
    before = W.partitionBy(key).orderBy(to(F.col("_cell"))).rowsBetween(W.unboundedPreceding, -1)
    cells = rows.groupBy(key, "_cell").agg(*(F.sum(v).alias(f"_{n}") for n, v in sums.items()))
    cells = cells.select(key, "_cell", *(F.sum(f"_{n}").over(before).alias(f"_{n}") for n in sums))
    cells = cells.filter(" OR ".join(f"_{n} IS NOT NULL" for n in sums))  # only what has more than one cell
    inside = W.partitionBy(key, "_cell").orderBy(to(F.col(place)))
    rows = rows.withColumns({n: F.sum(v).over(inside) for n, v in sums.items()}).join(cells, [key, "_cell"], "left")
    return rows.withColumns({n: F.col(n) + F.coalesce(f"_{n}", F.lit(0)) for n in sums}).drop("_cell", *(f"_{n}" for n in sums))


def trie(convs: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``convs`` lists the members (conv), ``rebuilt`` their turns (conv, pos, t1, t2, words). Conversations without turns
    end at the root. No conversations: no nodes.
    """
    bases = (_random.randbelow(P - 2**32) + 2**31, _random.randbelow(P - 2**32) + 2**31)
    rows = written(_terms(rebuilt, bases), "terms")
    whole = rows.groupBy("conv").agg(_modular(F.sum(_big("u1"))).alias("s1"), _modular(F.sum(_big("u2"))).alias("s2"), F.count("*").alias("len"))
    whole = convs.join(whole, "conv", "left").select("conv", *(F.coalesce(c, F.lit(0)).alias(c) for c in _LANES))
    sequences = written(collapse(written(whole, "ends")), "sequences")

    one = rows.join(sequences.select(F.col("rep").alias("conv"), "weight"), "conv")
    one = _running(one, "conv", "pos", {"p1": _big("u1"), "p2": _big("u2")})
    less = lambda p, u: _modular(F.col(p) - _big(u))
    steps = one.select(F.col("conv").alias("rep"), (F.col("pos") + 1).alias("depth"), _modular(F.col("p1")).alias("p1"), _modular(F.col("p2")).alias("p2"), less("p1", "u1").alias("q1"), less("p2", "u2").alias("q2"), "words", "weight")
    zero, no = F.lit(0).cast("long"), F.lit(None).cast("long")
    roots = sequences.select("rep", zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), no.alias("q1"), no.alias("q2"), zero.alias("words"), "weight")
    prefixes = written(steps.unionByName(roots), "prefixes")

    node, parent = ["p1", "p2", "depth"], [F.col("q1").alias("p1"), F.col("q2").alias("p2"), (F.col("depth") - 1).alias("depth")]
    inner = prefixes.filter("depth > 0").select(*parent).distinct()
    named = sequences.select(*(F.col(a).alias(b) for a, b in zip(_LANES, node)), "rep", "ends_sha256")
    leaves = named.join(inner, node, "left_anti").select("rep", F.lit(1).cast("long").alias("leaf"))
    counted = prefixes.join(leaves, "rep", "left").groupBy(*node).agg(
        F.min("rep").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum(F.coalesce("leaf", zero)).alias("n_leaves"), F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.min("words").alias("words")
    )
    nodes = written(counted, "nodes")

    value = nodes.select(F.col("conv_id").alias("rep"), "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("value"))
    along = prefixes.select("rep", *node).join(value, ["rep", "depth"], "left").withColumn("value", F.coalesce("value", zero))
    saved = _running(along, "rep", "depth", {"below": F.col("value")}, backwards=True).groupBy(*node).agg(F.sum("below").alias("saved_tokens"))
    children = nodes.filter("depth > 0").groupBy(*parent).agg(F.count("*").alias("n_children"))

    # A sequence owns its nodes from some depth on: below that the parent's smallest member is its own.
    top = nodes.groupBy("conv_id").agg(F.min("depth").alias("top"))
    owned = nodes.join(top, "conv_id").select("conv_id", *node, "q1", "q2", "top")
    deeper = owned.filter("depth > top").select(*node, F.col("conv_id").alias("parent_conv_id"))
    branches = owned.filter("depth = top AND depth > 0").select(*(F.col(c).alias(f"_{c}") for c in node), *parent)
    branches = branches.join(nodes.select(*node, F.col("conv_id").alias("parent_conv_id")), node).select(*(F.col(f"_{c}").alias(c) for c in node), "parent_conv_id")
    parents = written(deeper.unionByName(branches), "parents")

    out = nodes.select(*node, "conv_id", "n_convs", "n_leaves").join(saved, node).join(children, node, "left").join(parents, node, "left").join(named.drop("rep"), node, "left")
    ends = F.coalesce("ends_sha256", F.lit(_NONE)).alias("ends_sha256")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens", ends)


def conversation_trie(conversations: DataFrame, **columns) -> DataFrame:
    """The trie of the rebuilt conversations of a table; see ``turns``, ``rebuild`` and ``trie`` for awkward rows."""
    return trie(*rebuild(written(turns(conversations, **columns), "numbered")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


ORACLE_SQL = f"""
WITH t0 AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
t1 AS (SELECT c, turn, sha256(strlen(role) || ':' || role || text) AS d, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS w FROM t0),
t AS (SELECT c, d, w, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, d) - 1 AS i FROM t1),
cs AS (SELECT DISTINCT c, {CRC32_SQL.format("c::VARCHAR")} % 4 AS h, c - c % 20 AS b FROM t),
r AS (SELECT cs.c, t.i AS o, d, w FROM cs JOIN t ON t.c = cs.b AND t.i < cs.h UNION ALL SELECT cs.c, t.i + 10 AS o, d, w FROM cs JOIN t ON t.c = cs.c AND t.i >= cs.h),
p AS (SELECT c, w, row_number() OVER x AS depth, string_agg(d, '') OVER x AS k FROM r WINDOW x AS (PARTITION BY c ORDER BY o ROWS UNBOUNDED PRECEDING)
    UNION ALL SELECT c, 0, 0, '' FROM cs),
n AS (SELECT k, any_value(depth) AS depth, any_value(w) AS w, min(c) AS conv_id, count(*) AS n FROM p GROUP BY k),
up AS (SELECT k, CASE WHEN k <> '' THEN left(k, len(k) - 64) END AS parent FROM n),
kids AS (SELECT parent AS k, count(*) AS n_children FROM up WHERE parent IS NOT NULL GROUP BY parent),
a AS (SELECT n.k AS low, p.k AS high FROM n JOIN p ON p.c = n.conv_id AND p.depth <= n.depth),
s AS (SELECT a.high AS k, sum((n.n - 1) * n.w) AS saved_tokens, count(*) FILTER (kids.k IS NULL) AS n_leaves FROM a JOIN n ON n.k = a.low LEFT JOIN kids ON kids.k = a.low GROUP BY a.high),
f AS (SELECT c, arg_max(k, depth) AS k FROM p GROUP BY c),
e AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends FROM f GROUP BY k)
SELECT n.conv_id, n.depth::BIGINT AS depth, m.conv_id AS parent_conv_id, n.n::BIGINT AS n_convs, coalesce(kids.n_children, 0)::BIGINT AS n_children,
    s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM n JOIN up USING (k) JOIN s USING (k) LEFT JOIN n m ON m.k = up.parent LEFT JOIN kids ON kids.k = n.k LEFT JOIN e ON e.k = n.k"""

"""Merkle manifest of a dataset: a content-addressed DAG of digests, and proofs by descent, in DataFrame functions only.

Building: every row is a leaf digest, leaves have a rank inside their group (a language), and runs of
``FAN`` neighbours become their digest until one is left, the group's subroot. Subroots, in the order of
their groups, make the root in the same way. The store holds one record per digest: its children.

Proving: requests descend from the root. At each level the record of a digest is fetched, the next base-8
digit of a request's rank selects a child, and the children that are not selected become a segment of
its path; requests with the same digits so far are one row, so a level costs as many rows as it has
requested nodes. The path reversed, leaf first, is the proof.

Ranks are two-level: rows are cut into ranges of (group, id), counts per range are carried over, and
only rows inside a range are numbered together. A group is never one task, however many rows it has.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ascii_lower, table, written

FAN = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value; integers are decimal."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(**values: Column) -> Column:
    return digest(*map(field, values.values()))


def _group(value: Column) -> Column:
    """A group's name as a string without nulls: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def ranked(leaves: DataFrame, order: list[str], label: str) -> DataFrame:
    """``leaves`` with rank (from 0, inside ``group``) and n (rows of the group), as a written table.

    Nulls of the order columns come first; rows equal in all of them are interchangeable.
    """
    by = [F.col(c).asc_nulls_first() for c in order]
    cells = written(leaves.repartitionByRange(F.col("group").asc(), *by).withColumn("cell", F.spark_partition_id()), f"{label}-cells")
    counts = cells.groupBy("group", "cell").agg(F.count("*").alias("c"))
    of_group = W.partitionBy("group").orderBy("cell")  # a row per range of the group
    counts = counts.withColumns({"before": F.coalesce(F.sum("c").over(of_group.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)), "n": F.sum("c").over(W.partitionBy("group"))})
    inside = W.partitionBy("group", "cell").orderBy(*by)
    numbered = cells.withColumn("at", F.row_number().over(inside) - 1).join(counts.drop("c"), ["group", "cell"])
    return written(numbered.withColumn("rank", F.col("at") + F.col("before")).drop("at", "before", "cell"), label)


@dataclass
class Tree:
    """Levels of all groups' trees.

    leaves: group, rank, n, digest and what the caller added. levels[k]: group, at (its place in level k + 1), n,
    digest, children (digests, in order). tops: group, n, height, digest.
    """

    leaves: DataFrame
    levels: list[DataFrame]
    tops: DataFrame

    def record(self, k: int) -> DataFrame:
        """The store's records of level ``k`` (1 and up): digest, children; equal contents are one record."""
        return self.levels[k - 1].select("digest", "children").dropDuplicates(["digest"])


def build(leaves: DataFrame, order: list[str], label: str) -> Tree:
    """The trees over ``leaves`` (group, digest, the columns of ``order``, others)."""
    leaves = ranked(leaves, order, f"{label}-leaves")
    most = leaves.agg(F.max("n")).first()[0] or 0
    nodes = leaves.select("group", F.col("rank").alias("at"), "n", "digest")
    tops, levels = [nodes.filter("n = 1").select("group", "n", F.lit(0).alias("height"), "digest")], []
    width = 1  # leaves below a node of the level
    while most > width:
        run = F.floor(F.col("at") / FAN)
        level = nodes.filter(F.col("n") > width).groupBy("group", run.alias("at")).agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", "digest")))["digest"].alias("children"))
        width *= FAN
        nodes = written(level.withColumn("digest", F.sha2(F.array_join("children", ""), 256)), f"{label}-level")
        levels.append(nodes)
        tops.append(nodes.filter((F.col("n") <= width) & (F.col("n") > width // FAN)).select("group", "n", F.lit(len(levels)).alias("height"), "digest"))
    top = tops[0]
    for t in tops[1:]:
        top = top.unionByName(t)
    return Tree(leaves, levels, top)


def _split(children: Column, digit: Column) -> Column:
    """The siblings of a child, as text on its left and on its right."""
    before = F.slice(children, F.lit(1), digit)
    after = F.slice(children, digit + 2, F.lit(FAN))
    return F.struct(F.array_join(before, "").alias("left"), F.array_join(after, "").alias("right"))


def _down(state: DataFrame, records: DataFrame) -> DataFrame:
    """One level of descent: the state's digests are opened, each child goes on with its siblings in its path."""
    opened = state.join(records, "digest").select(*(c for c in state.columns if c not in ("digest", "at", "path")), "at", "path", "children", F.posexplode("children").alias("digit", "child"))
    return opened.withColumns({"path": F.array_append("path", _split(F.col("children"), F.col("digit"))), "at": F.col("at") * FAN + F.col("digit"), "digest": F.col("child")}).drop("children", "digit", "child")


def _wanted(state: DataFrame, wanted: DataFrame | None, below: int) -> DataFrame:
    """States that a requested leaf (group, rank) lies under; ``below``: leaves below a node of this level."""
    if wanted is None:
        return state
    return state.join(wanted.select("group", F.floor(F.col("rank") / below).alias("at")).distinct(), ["group", "at"], "left_semi")


@dataclass
class Manifest:
    docs: Tree
    groups: Tree

    def proofs(self, wanted: DataFrame | None = None) -> DataFrame:
        """A row per leaf (all, or those of ``wanted``: group, rank): the leaf's columns, subroot, root, path.

        ``path`` has the siblings (left, right) of every level, leaf first.
        """
        no_path = F.array().cast("array<struct<left:string,right:string>>")
        state = self.groups.tops.select("digest", F.lit(0).cast("long").alias("at"), no_path.alias("path"), F.col("digest").alias("root"))
        for k in range(len(self.groups.levels), 0, -1):
            state = _down(state, self.groups.record(k))
        names = self.groups.leaves.select(F.col("rank").alias("at"), F.col("name").alias("group"), "height")
        entered = state.join(names, "at").select("group", "height", "digest", F.lit(0).cast("long").alias("at"), "path", "root", F.col("digest").alias("subroot"))
        if wanted is not None:
            entered = entered.join(wanted.select("group").distinct(), "group", "left_semi")
        entered = written(entered, "entered")
        enter = lambda k: entered.filter(F.col("height") == k).drop("height")
        high = len(self.docs.levels)
        state = enter(high)
        for k in range(high, 1, -1):
            state = _wanted(_down(state, self.docs.record(k)), wanted, FAN ** (k - 1)).unionByName(enter(k - 1))
        leaves = self.docs.leaves if wanted is None else self.docs.leaves.join(wanted.select("group", "rank").distinct(), ["group", "rank"], "left_semi")
        more = [c for c in leaves.columns if c not in ("group", "rank", "n", "digest")]
        ask = F.struct((F.col("rank") % FAN).cast("int").alias("digit"), *more)
        parts = []
        if high:
            # The last digit: requests of a run meet its record, so only runs, not leaves, are moved with their paths.
            runs = leaves.filter("n > 1").groupBy("group", F.floor(F.col("rank") / FAN).alias("at")).agg(F.collect_list(ask).alias("asked"))
            last = state.join(self.docs.record(1), "digest").drop("digest").join(runs, ["group", "at"]).select("*", F.explode("asked").alias("q"))
            path = F.array_append("path", _split(F.col("children"), F.col("q.digit")))
            parts.append(last.select(*(F.col(f"q.{c}").alias(c) for c in more), F.get("children", F.col("q.digit")).alias("leaf"), "subroot", "root", F.reverse(path).alias("path")))
        alone = enter(0).drop("at").join(leaves.filter("n = 1").select("group", *more), "group")
        parts.append(alone.select(*more, F.col("digest").alias("leaf"), "subroot", "root", F.reverse("path").alias("path")))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def manifest(leaves: DataFrame, group: str, order: list[str]) -> Manifest:
    """The manifest of ``leaves``: a digest, a group, columns that order a group's leaves, and others to carry.

    Groups are ordered null first, then bytewise; null ids come first in their group, leaves of equal ids by
    digest. Repeated rows are leaves of their own with equal digests. An empty table has no root and no proofs.
    """
    docs = build(leaves.withColumn("group", _group(F.col(group))), [*order, "digest"], "merkle")
    tops = docs.tops.select(F.lit("").alias("group"), F.col("group").alias("name"), "height", "digest")
    return Manifest(docs, build(tops, ["name"], "merkle-root"))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda acc, s: digest(s["left"], acc, s["right"]))


def verify(docs: DataFrame, claimed: dict[str, Column], columns=COLUMNS, doc_id: str = "doc_id", group: str = "lang") -> DataFrame:
    """Every row's leaf, subroot, root, proof_sha256, and whether the claimed values still fold to the root.

    ``claimed`` replaces columns by what is to be verified. Null values have a mark of their own, empty and very
    long texts are hashed whole, other columns are ignored.
    """
    own = {c: F.col(c) for c in columns}
    leaves = docs.select(F.col(doc_id).alias("doc_id"), F.col(group).cast("string").alias("name"), leaf_digest(**own).alias("digest"), leaf_digest(**(own | claimed)).alias("claimed"))
    found = manifest(written(leaves, "merkle-digests"), "name", ["doc_id"]).proofs()  # written first: the ranges sample their input
    out = found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), fold(F.col("claimed"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered(doc_id: Column, text: Column) -> Column:
    """The text with A-Z lower-cased where 3 divides the CRC-32 of the decimal id; a null id is left alone."""
    return F.when(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, ascii_lower(text)).otherwise(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    return verify(docs, {"text": tampered(F.col("doc_id"), F.col("text"))})


#: CRC-32 of a decimal number, for DuckDB.
CRC32_SQL = """xor(4294967295::UBIGINT, list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split({0}, ''), lambda ch: ascii(ch)::UBIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))))"""


def _sql(most: int = 9) -> str:
    """Both trees level by level, as far as ``FAN ** most`` leaves; a group with one node left keeps it."""
    text = [
        "WITH h AS (SELECT doc_id, lang, sha256({0}) AS leaf, sha256({1}) AS claimed FROM (SELECT *, CASE WHEN {2} % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS t FROM documents))".format(
            " || ".join(f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in COLUMNS),
            " || ".join(f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in (*COLUMNS[:-1], "t")),
            CRC32_SQL.format("doc_id::VARCHAR"),
        ),
        "a0 AS (SELECT coalesce('=' || lang, '') AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS digest, doc_id, claimed FROM h)",
    ]

    def levels(p: str) -> None:
        for k in range(most):
            text.append(f"{p}n{k} AS (SELECT g, pos, digest, count(*) OVER (PARTITION BY g) AS n FROM {p}{k})")
            text.append(f"{p}{k + 1} AS (SELECT g, pos // 8 AS pos, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE any_value(digest) END AS digest FROM {p}n{k} GROUP BY g, pos // 8)")

    levels("a")
    text.append(f"b0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g) - 1 AS pos, digest, g AS name FROM a{most})")
    levels("b")
    folded, proof, joins, aliases = "d.claimed", "''", "", []
    for p, start in (("a", "d.pos"), ("b", "s.pos")):
        for k in range(most):
            x, key = f"{p}x{k}", "d.g" if p == "a" else "0"
            text.append(f"{x} AS (SELECT m.g, m.pos, coalesce(string_agg(o.digest, '' ORDER BY o.pos) FILTER (o.pos < m.pos), '') AS l, coalesce(string_agg(o.digest, '' ORDER BY o.pos) FILTER (o.pos > m.pos), '') AS r, any_value(m.n) AS n FROM {p}n{k} m JOIN {p}n{k} o ON o.g = m.g AND o.pos // 8 = m.pos // 8 GROUP BY m.g, m.pos)")
            joins += f" JOIN {x} ON {x}.g = {key} AND {x}.pos = {start} // {8**k}"
            aliases.append(x)
    for x in aliases:
        proof += f" || {x}.l || {x}.r"
    steps, last = [], "f0"
    text.append(f"f0 AS (SELECT d.doc_id, d.digest AS leaf, s.digest AS subroot, t.digest AS root, sha256({proof}) AS proof_sha256, {folded} AS f, [{', '.join(f'CASE WHEN {x}.n > 1 THEN {{l: {x}.l, r: {x}.r}} END' for x in aliases)}] AS path FROM a0 d JOIN b0 s ON s.name = d.g CROSS JOIN b{most} t{joins})")
    for k in range(2 * most):
        steps.append(f"f{k + 1} AS (SELECT * REPLACE (CASE WHEN path[{k + 1}] IS NULL THEN f ELSE sha256(path[{k + 1}].l || f || path[{k + 1}].r) END AS f) FROM {last})")
        last = f"f{k + 1}"
    return ",\n".join(text + steps) + f"\nSELECT doc_id, leaf, subroot, root, proof_sha256, f AS folded_root, f = root AS verified FROM {last}"


ORACLE_SQL = _sql()

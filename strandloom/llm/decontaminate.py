"""Benchmark decontamination by template windows.

Words are canonicalised: numbers, quantities, units and names become typed placeholders, so that a
question with other parameters has the same template. Windows of neighbouring template words are joined
by hash with those of the benchmark. A document holds an item if enough of the item's windows are found
in one stretch of it and the values that stand for its placeholders are consistent: within one alignment,
values of the item and of the document stand against each other one to one. Beside these, windows without
name placeholders find copies in other upper or lower case, and items that have no window are looked for
word for word.

There is one plan for every size of the benchmark: a bitmap of fixed size tells the tasks which windows can
matter, pairs of a document and an item are proposed by the item's rarest windows only (so many that every
held item has one of them), and all windows are joined for proposed pairs alone. So a window that many
documents and many items share makes no pairs of its own.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import free_name, row_key, table, written
from .shingles import windows

WINDOW = 5
#: Template words of a window that must be plain words.
LITERALS = 3
COVERAGE = 0.5
CONSISTENCY = 0.8
#: Bits of the map of benchmark windows that every task gets: 8 MB, whatever the benchmark's size.
MAP_BITS = 1 << 26

#: Words whose templates a worker remembers.
MEMO = 300_000

#: Unit words.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg lb lbs oz ounce ounces pound pounds ton tons ml l liter liters litre litres gallon gallons cup cups "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years hz khz mhz ghz w kw v volt volts j kj cal kcal k c f degree degrees "
    "percent % $ € £ dollar dollars cent cents euro euros usd eur gbp b kb mb gb tb mph kph".split()
)
#: Unit words that are units only behind a number.
AMBIGUOUS = frozenset("in second min foot yard pound cup degree".split())
_NUMBER = re.compile(r"[-+]?[$€£]?\d[\d.,:/]*%?$")
_QUANTITY = re.compile(r"[-+]?\d[\d.,]*([a-z%]+)$")
_EDGE = re.compile(r"^[^\w$€£%+-]+|[^\w%]+$")

CAPITAL, ENDS, SLOT, MAYBE = 1, 2, 4, 8
_NUM, _QTY, _UNIT, _NAME = (xxhash.xxh3_64_intdigest(x) for x in (b"<num>", b"<qty>", b"<unit>", b"<name>"))


class _Words(dict):
    """Word -> its row in three arrays: hash of the canonical form, flags, hash of the lower-case form."""

    def __init__(self):
        super().__init__()
        self.canon, self.flags, self.literal = np.zeros(1024, np.uint64), np.zeros(1024, np.int64), np.zeros(1024, np.uint64)

    def __missing__(self, word: bytes) -> int:
        raw = word.decode("utf-8", "replace")
        core = _EDGE.sub("", raw)
        low = core.lower()
        literal = out = xxhash.xxh3_64_intdigest(low.encode())
        flags = ENDS if re.search(r"[.!?:;][^\w]*$", raw) else 0
        if _NUMBER.match(low):
            out, flags = _NUM, flags | SLOT
        elif (m := _QUANTITY.match(low)) and m.group(1) in UNITS:
            out, flags = _QTY, flags | SLOT
        elif low in AMBIGUOUS:
            flags |= MAYBE
        elif low in UNITS and len(low) > 1:
            out, flags = _UNIT, flags | SLOT
        elif len(core) > 1 and core[0].isupper() and core[1:].islower():
            flags |= CAPITAL
        k = len(self)
        if k == len(self.canon):
            self.canon, self.flags, self.literal = (np.concatenate([x, np.zeros_like(x)]) for x in (self.canon, self.flags, self.literal))
        self.canon[k], self.flags[k], self.literal[k] = out, flags, literal
        self[word] = k
        return k

    def rows(self, ws: list[bytes]) -> np.ndarray:
        """Rows of the words of a text. The table is emptied between texts when it has grown to its bound."""
        if len(self) > MEMO:
            self.clear()
        return np.fromiter(map(self.__getitem__, ws), np.int64, len(ws))


_WORDS = _Words()


#: Three kinds of hashes: template windows, windows whose names are plain words, and whole items.
TEMPLATE, CASELESS, WHOLE = range(3)
_KEYS = [np.uint64(0), np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)]
_EMPTY = xxhash.xxh3_64_intdigest(b"")


def templates(text: bytes | None) -> tuple[list[bytes], list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Words of a text, and its template with and without name placeholders.

    A template has the hash of each of its words, whether it is a placeholder, and where it starts in the
    text: neighbouring names are one placeholder, and so are a number and its unit. A capitalised word
    inside a sentence is a name; one that starts a sentence is a plain word.
    """
    ws = (text or b"").split()
    rows = _WORDS.rows(ws)
    h, flags = _WORDS.canon[rows], _WORDS.flags[rows]
    slot = (flags & SLOT) > 0
    inside = np.zeros(len(ws), bool)
    inside[1:] = (flags[:-1] & ENDS) == 0
    name = ((flags & CAPITAL) > 0) & inside
    joined = np.zeros(len(ws), bool)
    joined[1:] = (h[:-1] == _NUM) & ((h[1:] == _UNIT) | ((flags[1:] & MAYBE) > 0)) & inside[1:]
    h[:-1][joined[1:]] = _QTY
    starts = np.flatnonzero(~joined)
    caseless = h[starts], slot[starts], starts
    if not name.any():
        return ws, [caseless, caseless]
    joined[1:] |= name[1:] & name[:-1]
    h[name] = _NAME
    starts = np.flatnonzero(~joined)
    return ws, [(h[starts], (slot | name)[starts], starts), caseless]


def _usable(h: np.ndarray, slot: np.ndarray, k: int, key: np.uint64, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Window hashes, and positions of windows on the map with enough plain words."""
    if len(h) < k:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    w = windows(h, k) ^ key
    at = _on_map(w, only)
    if len(at):
        plain = np.concatenate([[0], np.cumsum(~slot)])
        at = at[plain[at + k] - plain[at] >= min(LITERALS, k)]
    return w, at


_SHIFT = np.uint64(64 - (MAP_BITS - 1).bit_length())
_MASK = np.uint64(MAP_BITS - 1)


def _on_map(h: np.ndarray, only: np.ndarray | None) -> np.ndarray:
    """Positions of the hashes that have both bits, of their high and low ends, on the map; all positions without a map."""
    if only is None:
        return np.arange(len(h))
    have = lambda bit: (only[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
    at = np.flatnonzero(have(h >> _SHIFT))
    return at[have(h[at] & _MASK)]


def _literals(ws: list[bytes]) -> np.ndarray:
    """Hashes of the lower-case words; punctuation alone is no word."""
    h = _WORDS.literal[_WORDS.rows(ws)]
    return h[h != _EMPTY]


def _whole(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every ``n`` neighbouring words."""
    return windows(h, n) ^ _KEYS[WHOLE] if 0 < n <= len(h) else np.empty(0, np.uint64)


def _value(word: bytes) -> str:
    return _EDGE.sub("", word.decode("utf-8", "replace")).lower()


def _span(ws: list[bytes], start: int, end: int, glue: str) -> str:
    return glue.join(_value(w) for w in ws[start:end])


def _bitmap(items: DataFrame) -> np.ndarray:
    """The benchmark's window hashes, two bits each, on ``MAP_BITS`` bits: at most MAP_BITS / 64 numbers reach the driver."""
    ends = F.array(F.shiftrightunsigned("h", int(_SHIFT)), F.col("h").bitwiseAND(F.lit(int(_MASK))))
    bits = items.select(F.explode(ends).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    out = np.zeros(MAP_BITS // 64, np.uint64)
    for r in words.collect():
        out[r["word"]] = np.uint64(r["bits"] & (2**64 - 1))
    return out


_KINDS = "kind int, n int, h long, pos long, slots array<string>"


def _windows(df: DataFrame, ids: list[str], k: int, only=None, lengths: list[int] | None = None) -> DataFrame:
    """Windows of each row: the columns ``ids``, kind, n, h, pos, and the values at its placeholders.

    ``only``: a broadcast bitmap of hashes (see ``_bitmap``); windows that are not on it are left out.
    ``lengths``: the numbers of words of the items to be found whole; without it, rows that have no window
    are hashed whole.
    """
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*ids).schema)

    def wanted(h, at):
        return at[_on_map(h[at], only.value)] if only is not None and len(at) else at

    def run(batches):
        for batch in batches:
            rows, kinds, sizes, hs, at, slots = [], [], [], [], [], []

            def add(r, kind, n, h, good, values):
                rows.extend([r] * len(good))
                kinds.extend([kind] * len(good))
                sizes.extend([n] * len(good))
                at.extend(good.tolist())
                slots.extend(values)
                hs.append(h[good])

            for r, text in enumerate(batch.column(len(ids)).cast(pa.binary()).to_pylist()):
                ws, both = templates(text)
                some = False
                for kind, (t, slot, starts) in enumerate(both):
                    h, good = _usable(t, slot, k, _KEYS[kind], None if only is None else only.value)
                    some = some or len(good) > 0
                    if not len(good):
                        continue
                    ends = np.append(starts[1:], len(ws))
                    values = [[_span(ws, starts[q], ends[q], "" if t[q] == _QTY else " ") for q in range(p, p + k) if slot[q]] for p in good.tolist()]
                    add(r, kind, k, h, good, values)
                whole = lengths if lengths is not None else [] if some else [None]
                words = _literals(ws) if whole else None
                for n in whole:
                    n = n or len(words)
                    h = _whole(words, n)
                    good = wanted(h, np.sort(np.unique(h, return_index=True)[1]))
                    add(r, WHOLE, n, h, good, [[]] * len(good))
            hashes = np.concatenate(hs).view(np.int64) if hs else np.empty(0, np.int64)
            kept = batch.select(list(range(len(ids)))).take(pa.array(rows, pa.int64()))
            more = [pa.array(kinds, pa.int32()), pa.array(sizes, pa.int32()), pa.array(hashes), pa.array(at, pa.int64()), pa.array(slots, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*kept.columns, *more], [*ids, "kind", "n", "h", "pos", "slots"])

    return df.select(*ids, "text").mapInArrow(run, f"{fields}, {_KINDS}")


def find_leaks(docs: DataFrame, benchmark: DataFrame, k: int = WINDOW, coverage: float = COVERAGE, consistency: float = CONSISTENCY) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds.

    ``docs``: columns row (identifies a text), doc_id, text; ``benchmark``: item_id, text. Returns row,
    doc_id, item_id, n_found, n_windows, coverage, consistency. An item is held if at least ``coverage``
    of its distinct window positions are found in one stretch (shifts that differ by less than the item's
    length; half of it can be put in anywhere) and at least ``consistency`` of the placeholder values
    there agree, in the template with or without name placeholders; the best is reported. Items of fewer
    than ``k`` words, or without a window of enough plain words, are held where all their words stand in
    order. Null and empty texts have no words. Equal items are reported each; equal rows once. Null item
    ids are one item. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    items = written(_windows(benchmark.select("item_id", "text"), ["item_id"], k).distinct(), "items")
    totals = items.groupBy("item_id", "kind").agg(F.countDistinct("pos").alias("n_windows"), (F.max("pos") + F.max("n")).alias("span"))
    lengths = sorted(r.n for r in items.filter(F.col("kind") == WHOLE).select("n").distinct().collect())  # a few numbers
    only = spark.sparkContext.broadcast(_bitmap(items))
    same = lambda cols: [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in cols]
    # Of n window positions, of which c must be found, one of any n - c + 1 is: take the rarest.
    often = items.groupBy("h").agg(F.count("*").alias("often"))
    rank = F.row_number().over(W.partitionBy("l.item_id", "l.kind").orderBy("often", "h", "pos"))
    need = F.ceil(F.lit(coverage) * F.col("n_windows"))
    rare = items.select("item_id", "kind", "h", "pos").distinct().join(often, "h")
    rare = rare.alias("l").join(totals.alias("r"), same(["item_id", "kind"])).select("l.item_id", "h", "n_windows", rank.alias("rank"))
    rare = rare.filter(F.col("rank") <= F.col("n_windows") - need + 1).select("item_id", "h").distinct()
    seen = written(_windows(docs.select("row", "doc_id", "text"), ["row", "doc_id"], k, only, lengths).drop("n"), "seen")
    pairs = seen.select("row", "h").distinct().join(rare, "h").select("row", "item_id").distinct()
    theirs = items.select("item_id", "h", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"))
    wanted = pairs.alias("l").join(theirs.alias("r"), same(["item_id"])).select("row", "l.item_id", "h", "item_pos", "item_slots")
    hits = seen.join(wanted, ["row", "h"]).alias("l").join(totals.alias("r"), same(["item_id", "kind"]))
    shift = F.col("pos") - F.col("item_pos")
    hits = written(hits.select("row", "doc_id", "l.item_id", "l.kind", "item_pos", "slots", "item_slots", "n_windows", "span", shift.alias("shift")), "hits")
    # Two sets of bands of the item's length: windows whose shifts differ by up to half of it share a band.
    bands = F.transform(F.array(F.lit(0), F.lit(1)), lambda half: F.struct(half.alias("half"), F.floor((F.col("shift") * 2 + half * F.col("span")) / (F.col("span") * 2)).alias("at")))
    hits = hits.withColumn("band", F.explode(bands))
    ids = ["row", "doc_id", "item_id"]
    key = [*ids, "kind", "band"]
    found = hits.groupBy(*key).agg(F.countDistinct("item_pos").alias("n_found"), F.first("n_windows").alias("n_windows"))
    # Values met at each placeholder, alignment by alignment: how many agree with the most frequent partner, either way?
    met = hits.filter(F.size("slots") > 0).select(*key, "shift", F.explode(F.arrays_zip("slots", "item_slots")).alias("s"))
    met = written(met.groupBy(*key, "shift", "s.item_slots", "s.slots").agg(F.count("*").alias("n")), "slots")
    agree = lambda side, name: met.groupBy(*key, "shift", side).agg(F.max("n").alias("agree"), F.sum("n").alias("all")).groupBy(*key).agg((F.sum("agree") / F.sum("all")).alias(name))
    out = found
    for side, name in (("item_slots", "of_item"), ("slots", "of_doc")):
        out = out.alias("l").join(agree(side, name).alias("r"), same(key), "left").select("l.*", F.coalesce(f"r.{name}", F.lit(1.0)).alias(name))
    out = out.withColumns({"coverage": F.col("n_found") / F.col("n_windows"), "consistency": F.least("of_item", "of_doc")})
    best = F.max(F.struct("coverage", "consistency", "n_found", "n_windows"))
    return out.filter((F.col("coverage") >= coverage) & (F.col("consistency") >= consistency)).groupBy(*ids).agg(best.alias("best")).select(*ids, "best.n_found", "best.n_windows", "best.coverage", "best.consistency")


def with_row(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """row (128 bits of id and text: equal rows share it), doc_id and text."""
    return docs.select(row_key(F.col(doc_id), F.col(text)).alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; columns and all other rows stay as they are.

    Null and empty texts hold nothing and stay, repeated rows are judged alike, and an empty table stays empty.
    """
    row = free_name(docs, "_row")
    leaks = find_leaks(with_row(docs, doc_id, text), benchmark, **options).select(F.col("row").alias(row)).distinct()
    return docs.withColumn(row, row_key(F.col(doc_id), F.col(text))).join(leaks, row, "left_anti").drop(row)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_row(table(spark, sf_dir, "documents"))
    leaks = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", "n_found", "n_windows", "coverage", "consistency", F.lit(True).alias("contaminated"))

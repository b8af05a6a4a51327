"""Running values along a chromosome that no single task has to hold.

Positions are cut into cells of a fixed width. Each cell's own value is aggregated first, a table with a
row per (chromosome, cell) carries the values over from one cell to the next, and rows are ordered only
inside their cell. So a window sees one cell, not a chromosome; the carried table has at most
genome length / ``CELL`` rows, whatever the number of intervals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .stored import written

CELL = 1 << 16


def in_cells(df: DataFrame, pos: Column | str = "start", keys: list[str] = ("chrom",), width: int = CELL) -> DataFrame:
    """``df`` with ``_cell``, the stretch of its key in which ``pos`` lies; rows without a key or a position are left out.

    The filter is stated here so that both uses of the result in ``carried`` keep the same plan and share its exchanges.
    """
    cell = F.floor((F.col(pos) if isinstance(pos, str) else pos) / width)
    return df.withColumn("_cell", cell).dropna(subset=[*keys, "_cell"])


def carried(df: DataFrame, keys: list[str], values: dict, later: bool = False) -> DataFrame:
    """``df`` (with ``_cell``) and, per name, the aggregate of a column over all earlier (``later``) cells.

    ``values``: name -> (aggregate function, column); null where no other cell comes before (after).
    """
    per = df.groupBy(*keys, "_cell").agg(*(fn(c).alias(name) for name, (fn, c) in values.items()))
    order = F.col("_cell").desc() if later else F.col("_cell").asc()
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    per = per.select(*keys, "_cell", *(fn(name).over(w).alias(name) for name, (fn, _) in values.items()))
    return df.join(per, [*keys, "_cell"])


def inside(keys: list[str], *order) -> W:
    """The window over the rows of one cell."""
    return W.partitionBy(*keys, "_cell").orderBy(*order)


def islands(df: DataFrame, keys: list[str], distance: int = 0, touching: bool = True) -> DataFrame:
    """``df`` with ``_cell`` and ``island``, a number per key of intervals that reach each other.

    ``touching``: a gap of ``distance`` still joins; else a shared base is needed. Rows need a key, a start and an end.
    """
    known = in_cells(df.dropna(subset=["start", "end"]), keys=keys)
    w = inside(keys, "start", "end")
    known = carried(known, keys, {"_reach": (F.max, "end")})
    reach = F.greatest("_reach", F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1)))
    parted = (F.col("start") > F.col("_reach") + distance) if touching else (F.col("start") >= F.col("_reach"))
    known = known.withColumn("_reach", reach).withColumn("_new", F.when(F.col("_reach").isNull() | parted, 1).otherwise(0))
    known = carried(known.drop("_reach"), keys, {"_seen": (F.sum, "_new")})
    again = inside(keys, "start", "end", F.desc("_new"))  # of rows with equal ends the one that starts an island comes first
    number = F.coalesce("_seen", F.lit(0)) + F.sum("_new").over(again.rowsBetween(W.unboundedPreceding, 0))
    return known.withColumn("island", number).drop("_new", "_seen")


def numbered(df: DataFrame, keys: list[str], order: str, ties: list[str] = (), width: int = CELL) -> DataFrame:
    """``df`` with ``_idx``, the place of each row in the order of its key, from 0.

    ``order`` is a number of which a cell holds ``width`` values; ``ties`` decide between equal ones.
    """
    known = in_cells(df, order, keys, width)
    known = carried(known.withColumn("_one", F.lit(1)), keys, {"_before": (F.sum, "_one")})
    place = F.coalesce("_before", F.lit(0)) + F.row_number().over(inside(keys, order, *ties)) - 1
    return known.withColumn("_idx", place).drop("_one", "_before", "_cell")


def in_ranges(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``df`` with ``_cell``, a range of rows in the order of keys and ``order``; cells hold about equally many rows.

    Ranges come from a sample of the rows, so they are written down before anything is counted in them.
    """
    return written(df.repartitionByRange(*(F.col(k) for k in keys), *order).withColumn("_cell", F.spark_partition_id()), "ranges")


def placed(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``df`` with ``_idx``, the place of each row among those of its key, from 0; ``order`` leaves no ties that matter.

    Unlike ``numbered`` it cuts by rows and not by values, so neither many rows in a narrow range nor a value that
    a third of the rows share make a large task.
    """
    rows = in_ranges(df, keys, order)
    rows = carried(rows.withColumn("_one", F.lit(1)), keys, {"_before": (F.sum, "_one")})
    at = F.row_number().over(W.partitionBy(*keys, "_cell").orderBy(*order)) - 1
    return rows.withColumn("_idx", F.coalesce("_before", F.lit(0)) + at).drop("_one", "_before", "_cell")


def runs(changes: DataFrame, keys: list[str], level: str) -> DataFrame:
    """Runs (keys, start, end, ``level``) between the positions of changes (keys, start, d): the sum of all d so far.

    ``changes`` has one row per position; the run behind the last position has no end.
    """
    changes = in_cells(changes, keys=keys)
    per = changes.groupBy(*keys, "_cell").agg(F.sum("d").alias("_level"), F.min("start").alias("_first"))
    cells = W.partitionBy(*keys).orderBy("_cell")
    per = per.select(*keys, "_cell", F.sum("_level").over(cells.rowsBetween(W.unboundedPreceding, -1)).alias("_level"), F.lead("_first").over(cells).alias("_next"))
    w = inside(keys, "start")
    value = F.coalesce("_level", F.lit(0)) + F.sum("d").over(w.rowsBetween(W.unboundedPreceding, 0))
    return changes.join(per, [*keys, "_cell"]).select(*keys, "start", F.coalesce(F.lead("start").over(w), "_next").alias("end"), value.alias(level))


def blocks(df: DataFrame, halo: int, size: int = 1 << 16) -> DataFrame:
    """Rows with ``_idx`` in blocks of so many: _home is a row's own ``_block``, copies are the neighbours' halos.

    A window over (keys, _block) ordered by _idx sees ``halo`` rows beyond each end of the block, so frames
    of rows need no whole chromosome. Keep the rows with _home = _block.
    """
    size = max(size, halo + 1)
    copies = F.array_distinct(F.transform(F.array(*map(F.lit, (0, -halo, halo))), lambda d: F.floor((F.col("_idx") + d) / size)))
    return df.withColumns({"_home": F.floor(F.col("_idx") / size), "_block": F.explode(copies)})

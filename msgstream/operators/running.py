"""Running sums and maxima of long sequences, over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_FOLD = {"sum": F.sum, "max": F.max}


def _block_of(column: str, size: int) -> Column:
    """The number of a block, rounded down for negative numbers too."""
    return F.call_function("div", F.col(column) - F.pmod(F.col(column), F.lit(size)), F.lit(size))


def _before(rows: DataFrame, by: list[str], order: list[str], columns: dict[str, str], block: int, levels: int) -> DataFrame:
    """``rows`` with each of ``columns`` replaced by its value over the rows before; NULL where there are none."""
    if levels == 0:
        earlier = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumns({name: _FOLD[kind](name).over(earlier) for name, kind in columns.items()})
    keys = [*by, "_block"]
    blocked = rows.withColumn("_block", _block_of(order[0], block))
    totals = blocked.groupBy(*keys).agg(*[_FOLD[kind](name).alias(name) for name, kind in columns.items()])
    heads = _before(totals.withColumnRenamed("_block", "_at"), by, ["_at"], columns, block, levels - 1)
    heads = heads.withColumnRenamed("_at", "_block").withColumn("_head", F.lit(True))
    both = blocked.withColumn("_head", F.lit(False)).unionByName(heads, allowMissingColumns=True)
    first = [F.desc("_head"), *order]
    earlier = Window.partitionBy(*keys).orderBy(*first).rowsBetween(Window.unboundedPreceding, -1)
    swept = both.withColumns({name: _FOLD[kind](name).over(earlier) for name, kind in columns.items()})
    return swept.where(~F.col("_head")).drop("_head", "_block")


def running(
    rows: DataFrame, by: Sequence[str], order: Sequence[str], columns: dict[str, str], block: int = 4096, levels: int = 2
) -> DataFrame:
    """``rows`` with each of ``columns`` ("sum" or "max") replaced by its value over all rows of its key up to this one.

    Rows of a key (``by``) stand in the order of ``order``, whose first column is an integer and cuts them into
    blocks of ``block`` numbers. Blocks are summed up; what all blocks before a block come to is found in the
    same way, level by level, and stands as one more row at the head of the block; then each block is gone
    through by itself. So no task holds more of a key than a block of rows, and on the last level one row for
    ``block ** levels`` numbers. Nothing is joined.

    How many rows share a number is for the caller to bound, as by an aggregate before. Rows equal in all of ``order``
    stand in any order. NULL keys are a key; NULL values change nothing, and what nothing came before stays NULL.
    No rows give none.
    """
    own = {name: f"_own_{name}" for name in columns}
    kept = rows.withColumns({own[name]: F.col(name) for name in columns})
    before = _before(kept, list(by), list(order), columns, block, levels)
    both = {
        name: F.coalesce(F.col(name) + F.col(own[name]), F.col(name), F.col(own[name])) if kind == "sum"
        else F.greatest(name, own[name])
        for name, kind in columns.items()
    }
    return before.withColumns(both).select(*rows.columns)


def last_before(
    rows: DataFrame, marks: DataFrame, by: Sequence[str], time: str, name: str, slice_us: int = 60_000_000, parts: int = 16
) -> DataFrame:
    """``rows`` with ``name``, the time of the last of ``marks`` of the same key at or before their own ``time``.

    An as-of join by union: rows and marks stand in one order of time, and the last mark is carried forward in
    slices of time (see :func:`running`). A slice may hold a large share of the rows, so rows of a slice are dealt to
    ``parts`` by a hash of all of them, and each part gets the slice's marks, once per time. A row without a time has
    no mark; NULL keys are a key.
    """
    by = list(by)
    times = marks.where(F.col(time).isNotNull()).select(*by, F.unix_micros(time).alias("_at")).distinct()
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_part")
    standing = times.select(*by, "_at", everywhere, F.col("_at").alias(name), F.lit(0).alias("_turn"))
    plain = [F.to_json(f.name) if f.dataType.typeName() == "map" else F.col(f.name) for f in rows.schema.fields]
    dealt = rows.withColumns(
        {
            "_at": F.unix_micros(time),
            "_part": F.pmod(F.xxhash64(*plain), F.lit(parts)).cast("int"),
            name: F.lit(None).cast("long"),
            "_turn": F.lit(1),
        }
    )
    both = dealt.where("_at IS NOT NULL").unionByName(standing, allowMissingColumns=True)
    carried = running(both, [*by, "_part"], ["_at", "_turn"], {name: "max"}, block=slice_us)
    found = carried.where("_turn = 1").unionByName(dealt.where("_at IS NULL"))
    return found.withColumn(name, F.timestamp_micros(name)).drop("_at", "_part", "_turn")


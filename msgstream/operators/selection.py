"""Finding the first rows of an order without sorting the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgstream.operators.dedup import comparable_map

# So many rows are ordered in one task; a larger range is narrowed first.
FITS = 100_000
# Accuracy of a sketch, and how far around the wanted rank its bounds are put, as shares of all rows of the range.
SKETCH_K, MARGIN = 2000, 0.005


def _comparable(df: DataFrame) -> list[Column]:
    """All columns in a form that can be compared, grouped and hashed."""
    return [comparable_map(f.name) if f.dataType.typeName() == "map" else F.col(f.name) for f in df.schema.fields]


def _narrowed(scope: DataFrame, key: str, wanted: int, rows: int) -> tuple[Column, int | None, int, int]:
    """A part of the values of ``key`` that holds the ``wanted``-th row: its condition, its value if it is but one,
    the rows before it and in it.

    A quantile sketch proposes a value at the rank and one on either side; the rows in the five parts they make are
    counted exactly. Whichever part it is, it leaves out a value that occurs, or is that value alone.
    """
    ranks = [max(0.0, wanted / rows - MARGIN), wanted / rows, min(1.0, wanted / rows + MARGIN)]
    sketch = F.kll_sketch_agg_bigint(key, SKETCH_K)
    quantiles = F.kll_sketch_get_quantile_bigint(sketch, F.array(*[F.lit(r) for r in ranks]))
    low, middle, high = scope.agg(quantiles.alias("cuts")).first().cuts
    value = F.col(key)
    parts = [
        (value < low, None),
        ((value >= low) & (value < middle), None),
        (value == middle, middle),
        ((value > middle) & (value <= high), None),
        (value > high, None),
    ]
    before = 0
    for (inside, only), n in zip(parts, scope.agg(*[F.count_if(c) for c, _ in parts]).first(), strict=True):
        if before + n >= wanted:
            return inside, only, before, n
        before += n
    raise RuntimeError("the rows changed while they were read")


def first_rows(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The ``n`` first rows by integer columns; among rows equal in these, by a hash of the whole row.

    The last row's place is found column by column. As long as more than ``FITS`` rows may hold it, a sketch
    narrows the values of the column to about a hundredth and exact counts say which part it is (:func:`_narrowed`);
    a value that alone holds too many rows leads on to the next column. What fits is ordered, keys only. So a
    task counts its own rows, or orders ``FITS`` keys, whatever the number of rows at one time. The result is a
    filter over ``df``; nothing in it depends on which task reads a row. Rows that are the same throughout
    and of which but some are wanted are taken once and repeated.

    Jobs run when this is called: two for each narrowing. Fewer than ``n`` rows are all taken. A NULL in a column of
    ``order`` must be made an error, or a value, by the caller.
    """
    keys = [f"_key{i}" for i in range(len(order) + 1)]
    keyed = df.select(*[c.alias(k) for c, k in zip(order, keys, strict=False)], F.xxhash64(*_comparable(df)).alias(keys[-1]))
    rows = keyed.count()
    if n >= rows:
        return df
    if n <= 0:
        return df.limit(0)
    scope, wanted, level, fixed = keyed, n, 0, {}
    while rows > FITS and level < len(keys):
        key = keys[level]
        inside, only, before, rows = _narrowed(scope, key, wanted, rows)
        scope, wanted = scope.where(inside), wanted - before
        if only is not None:
            fixed[key], level = only, level + 1
    if level < len(keys):
        counts = scope.groupBy(*keys).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0))
        last = counts.withColumn("upto", upto).where(F.col("upto") >= wanted).orderBy("upto").first()
        fixed, tied, wanted = {k: last[k] for k in keys}, last.n, wanted - (last.upto - last.n)
    else:
        tied = rows
    values = [F.lit(fixed[k]) for k in keys]
    columns = [*order, F.xxhash64(*_comparable(df))]
    earlier, same = F.lit(False), F.lit(True)
    for column, value in zip(columns, values, strict=True):
        earlier, same = earlier | (same & (column < value)), same & (column == value)
    if wanted == tied:
        return df.where(earlier | same)
    return df.where(earlier).unionByName(_some(df.where(same), wanted))


def _some(df: DataFrame, wanted: int) -> DataFrame:
    """So many of rows of one hash, which are hardly ever different rows."""
    compared = [c.alias(f"_c{i}") for i, c in enumerate(_comparable(df))]
    names = [f"_c{i}" for i in range(len(compared))]
    whole = F.first(F.struct(*df.columns)).alias("row")
    distinct = df.select("*", *compared).groupBy(*names).agg(F.count("*").alias("n"), whole)
    upto = F.sum("n").over(Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, 0))
    copies = F.greatest(F.lit(0), F.least(F.col("n"), F.lit(wanted) - (F.col("upto") - F.col("n"))))
    taken = distinct.withColumn("upto", upto).select("row", copies.alias("copies")).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")

"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: words are runs of anything but space, tab, line feed, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def digest(*values: Column) -> Column:
    """128 bits that stand for the values, in two longs; NULL counts as a value of its own."""
    full = [part for value in values for part in (value.isNull(), value)]
    return F.struct(F.xxhash64(F.lit(1), *full).alias("hi"), F.xxhash64(F.lit(2), *full).alias("lo"))


def word_count(text: Column) -> Column:
    """Number of words; 0 for NULL. What is left after all other characters went is counted, one mark a word."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "w")
    return F.length(F.translate(marks, " \t\n\v\f\r", "")).cast("long")


def keeps_columns(*used: str, made: str | None = None) -> Callable:
    """For an operator that reads the columns ``used`` of its table and hands on all others as they are.

    While it works, the others go by names of their place, so none of them can clash with a name the operator uses
    itself. The column that it adds, ``made``, takes the place of one of that name.
    """

    def decorate(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(operator)
        def run(docs: DataFrame, *args, **settings) -> DataFrame:
            given = [c for c in docs.columns if c != made]
            placed = [c if c in used else f"extra{i}" for i, c in enumerate(given)]
            plain = docs.drop(made) if made in docs.columns else docs
            result = operator(plain.toDF(*placed), *args, **settings)
            names = dict(zip(placed, given, strict=True))
            return result.toDF(*[names.get(c, c) for c in result.columns])

        return run

    return decorate

"""Counting words, lines and messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from msgstream.functions.text import format_count, is_blank, split_words, utf16_length


def extract_words(df: DataFrame, keep=("window",), text: str = "text") -> DataFrame:
    """One row per word, carrying only the ``keep`` columns."""
    return df.select(*keep, F.explode(split_words(text)).alias("word")).where(F.col("word") != "")


def count_each(df: DataFrame, by=("window", "word")) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("count"))


def count_words(df: DataFrame, keep=("window",), text: str = "text") -> DataFrame:
    return count_each(extract_words(df, keep, text), (*keep, "word"))


def format_counts(df: DataFrame, keep=("window",)) -> DataFrame:
    return df.select(*keep, format_count("word", "count").alias("line"))


def global_count(df: DataFrame) -> DataFrame:
    """The number of rows; no row at all when there are none."""
    return df.groupBy(F.lit(1).alias("_all")).agg(F.count("*").alias("count")).drop("_all")


def line_metrics(text: str = "text") -> list:
    length = utf16_length(text)
    return [
        F.count_if(is_blank(text)).alias("empty_lines"),
        F.count(text).alias("line_count"),
        F.sum(length).alias("length_sum"),
        F.min(length).alias("length_min"),
        F.max(length).alias("length_max"),
        F.avg(length).alias("length_mean"),
    ]


def line_stats(df: DataFrame, by=(), text: str = "text") -> DataFrame:
    return df.groupBy(*by).agg(*line_metrics(text)) if by else df.agg(*line_metrics(text))


def observe_lines(df: DataFrame, observation: Observation | str = "lines", text: str = "text") -> DataFrame:
    """Gathers the same metrics on the side while the rows pass through.

    Streams report them under ``observedMetrics`` in the query progress.
    """
    return df.observe(observation, *line_metrics(text))


def distinct_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """Lines received, how many differ, and how many came again."""
    counted = df.groupBy(line).agg(F.count("*").alias("n"))
    return counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("lines"),
        F.count("*").alias("distinct_lines"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated_lines"),
    )


def repeated_lines(df: DataFrame, line: str = "value") -> DataFrame:
    return df.groupBy(line).agg(F.count("*").alias("copies")).where("copies > 1")


def unique_queues(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct("queue").alias("queues"))

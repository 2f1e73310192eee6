"""Envelope row to record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgstream.functions.text import utf8

TEXT_RECORD = (
    "destination",
    "expiration",
    "message_id",
    "priority",
    "redelivered",
    "reply_to",
    "receive_ts",
    "sender_ts",
    "sequence_number",
    "time_to_live",
    "properties",
    "text",
)


def body_text() -> Column:
    """Content followed by attachment, each left out when empty."""
    return F.concat(F.coalesce(utf8("content"), F.lit("")), F.coalesce(utf8("attachment"), F.lit("")))


def text_record(df: DataFrame, include_sender_id: bool = False, keep=()) -> DataFrame:
    """The text record: metadata, properties and the whole body as text.

    A sender time of zero means that the sender set none. ``keep`` names envelope columns to carry along.
    """
    epoch = F.timestamp_seconds(F.lit(0))
    mapped = df.withColumn("text", body_text()).withColumn("sender_ts", F.nullif("sender_ts", epoch))
    extra = ("sender_id",) if include_sender_id else ()
    return mapped.select(*keep, *TEXT_RECORD, *extra)


def bytes_record(df: DataFrame, keep=()) -> DataFrame:
    return df.select(*keep, "message_id", F.col("content").alias("raw"))


def payload_string() -> Column:
    """The body as one string, read by message type; of several bodies only the first that applies.

    Stream and map bodies are shown as JSON, maps with their keys in order.
    """
    kind = F.col("message_type")
    sorted_map = F.map_from_entries(F.array_sort(F.map_entries("map_items")))
    return (
        F.when(kind.isin("text", "bytes"), utf8("content"))
        .when(kind == "stream", F.to_json("stream_items"))
        .when(kind == "map", F.to_json(sorted_map))
        .when(F.octet_length("attachment") > 0, utf8("attachment"))
        .otherwise(F.coalesce(utf8("content"), F.lit("")))
    )


def string_record(df: DataFrame, keep=()) -> DataFrame:
    return df.select(*keep, payload_string().alias("text"))


def payload(df: DataFrame) -> DataFrame:
    return df.select("text")


def property_value(name: str, properties: str = "properties") -> Column:
    """An application property, NULL when the message has none of that name or none at all."""
    return F.try_element_at(properties, F.lit(name))


def typed_property(name: str, kind: str, properties: str = "properties") -> Column:
    """The property as a number, boolean, date or the like; NULL where its value does not fit ``kind``."""
    return F.try_variant_get(F.try_parse_json(property_value(name, properties)), "$", kind)


def redelivered_only(df: DataFrame) -> DataFrame:
    return df.where("redelivered")

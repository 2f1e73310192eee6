"""The provided tables seen as message traffic.

Each binding is one pass over the whole table. Which messages were sent again, what was delivered and
what was acknowledged follows from columns of the row itself; the oracle repeats the same rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgstream.functions.text import from_utc
from msgstream.sources.landing import envelope

# The queues of the events, and one that never holds a message.
EVENT_QUEUES = ["Q/click", "Q/error", "Q/purchase", "Q/signup", "Q/view"]
IDLE_QUEUE = "Q/idle"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table. Its timestamps carry no zone and are taken as UTC throughout."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sent_again(condition: Column) -> Column:
    """First copies, and one more of the messages for which the condition holds."""
    once, twice = F.array(F.lit(False)), F.array(F.lit(False), F.lit(True))
    return F.explode(F.when(condition, twice).otherwise(once)).alias("redelivered")


def _later(ts: Column, microseconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + microseconds)


def event_messages(events: DataFrame) -> DataFrame:
    """Envelope rows with ``text``. Events of value 100 and over were sent again two seconds later."""
    rows = events.select("*", _sent_again(F.col("value") >= 100))
    kind, sent = F.col("event_type"), from_utc("ts")
    wait = F.col("user_id") * 100_000 + F.when(F.col("redelivered"), 2_000_000).otherwise(0)
    k = F.get_json_object("props", "$.k")
    content = F.concat(kind, F.lit(" "))
    attached = ~((kind == "view") & (F.col("value") < 20))
    messages = envelope(
        rows,
        queue=F.concat(F.lit("Q/"), kind),
        message_id=F.col("event_id"),
        message_type=F.create_map(
            *[F.lit(v) for pair in zip(["click", "signup", "purchase", "error", "view"],
                                       ["text", "bytes", "stream", "map", "xml"]) for v in pair]
        )[kind],
        destination=F.concat(F.lit("topic/"), kind),
        expiration=F.lit(0),
        priority=F.floor(F.col("value") / 100),
        reply_to=F.when(kind == "purchase", F.concat(F.lit("reply/"), F.col("user_id").cast("string"))),
        receive_ts=_later(sent, wait),
        sender_ts=F.when(F.col("value") >= 5, sent).otherwise(F.timestamp_seconds(F.lit(0))),
        sequence_number=F.when(kind != "error", F.col("user_id")),
        time_to_live=F.floor("value") * 1000,
        sender_id=F.concat(F.lit("user-"), F.col("user_id").cast("string")),
        properties=F.when(
            kind != "view", F.create_map(F.lit("k"), k, F.lit("user"), F.col("user_id").cast("string"))
        ),
        content=content.cast("binary"),
        attachment=F.when(attached, F.col("props").cast("binary")),
        stream_items=F.array(kind, F.col("props")),
        map_items=F.create_map(F.lit("type"), kind, F.lit("k"), k),
    )
    return messages


def document_messages(documents: DataFrame) -> DataFrame:
    """Text messages, one document a second. Documents not in English were sent again a second later."""
    rows = documents.select("*", _sent_again(F.col("lang") != "en"))
    sent = F.timestamp_seconds(F.col("doc_id") + 1_704_067_200)
    wait = F.when(F.col("redelivered"), 3_000_000).otherwise(2_000_000)
    return rows.select(
        F.col("source").alias("queue"),
        F.col("doc_id").alias("message_id"),
        F.col("doc_id").alias("sequence_number"),
        "redelivered",
        sent.alias("sender_ts"),
        _later(sent, wait).alias("receive_ts"),
        "text",
    )


def delivery_log(events: DataFrame) -> DataFrame:
    """What happened to each event's message.

    Events under value 10 were not delivered yet, those of type error are not acknowledged. Events of
    value 100 and over were removed from their reader, which re-opened its queue, and delivered again.
    """
    sent = from_utc("ts")
    received = _later(sent, F.col("user_id") * 100_000)
    size = F.octet_length("props").cast("long")
    again, delivered = F.col("value") >= 100, F.col("value") >= 10
    acked = delivered & (F.col("event_type") != "error")

    def entry(kind: str, when: Column, condition: Column, message_id: Column = F.col("event_id")) -> Column:
        row = F.struct(
            message_id.alias("message_id"), F.lit(kind).alias("kind"), when.alias("event_time"), size.alias("size_bytes")
        )
        return F.when(condition, row)

    second = F.lit(1_000_000)
    entries = F.array(
        entry("published", sent, F.lit(True)),
        entry("delivered", received, delivered),
        entry("removed", _later(received, second), again),
        entry("rebind", _later(received, second), again, F.lit(None).cast("long")),
        entry("delivered", _later(received, second * 2), again),
        entry("ready", _later(received, second * 3), delivered),
        entry("acked", _later(received, second * 4), acked),
    )
    queue = F.concat(F.lit("Q/"), F.col("event_type")).alias("queue")
    return events.select(queue, F.explode(F.array_compact(entries)).alias("entry")).select("queue", "entry.*")


def trade_messages(lineitem: DataFrame) -> DataFrame:
    """Each line item as a payload of two quotes, the second with few fields, other spacing and a comma
    in its symbol. Payloads of flag R and status F are cut short; those of flag N and status F hold a
    size that is no number. Of flag A, the first quote of line 5 has a year for a date, that of line 6 a
    price that is no number, and that of line 7 an object for a symbol."""
    date = F.date_format("l_shipdate", "yyyy-MM-dd")
    odd = F.when(F.col("l_returnflag") == "A", F.col("l_linenumber")).otherwise(0)
    minute = F.concat(F.lit("09:"), F.lpad(F.col("l_linenumber").cast("string"), 2, "0"))
    quantity = F.col("l_quantity").cast("int").cast("string")
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    tax = F.col("l_tax").cast("decimal(18,2)").cast("string")
    part = F.col("l_partkey").cast("string")
    flags = F.concat("l_returnflag", "l_linestatus")
    low_ask = F.when(flags == "NF", F.lit('"many"')).otherwise(quantity)
    text = F.concat(
        F.lit('[{"date":"'), F.when(odd == 5, F.substring(date, 1, 4)).otherwise(date), F.lit('","sym":'),
        F.when(odd == 7, F.lit('{"s":1}')).otherwise(F.concat(F.lit('"S'), part, F.lit('"'))), F.lit(',"time":"'), minute,
        F.lit('","lowAskSize":'), low_ask, F.lit(',"highAskSize":'), quantity, F.lit("0"),
        F.lit(',"lowBidPrice":'), price, F.lit(',"highBidPrice":'), price, F.lit("5"),
        F.lit(',"lowBidSize":'), quantity, F.lit(',"highBidSize":'), quantity,
        F.lit(',"lowTradePrice":'), price, F.lit(',"highTradePrice":'), price,
        F.lit(',"lowTradeSize":0,"highTradeSize":'), quantity,
        F.lit(',"lowAskPrice":'), price, F.lit(',"highAskPrice":'), price, F.lit(',"vwap":'),
        F.when(odd == 6, F.lit('"NaN"')).otherwise(tax),
        F.lit('},{"date" : "'), date, F.lit('", "sym" : "S'), part, F.lit(',X", "lowAskSize" : '), quantity, F.lit("}]"),
    )
    whole = F.when(flags == "RF", F.substring(text, F.lit(1), F.length(text) - 5)).otherwise(text)
    return lineitem.select(
        F.concat(F.lit("Q/"), F.col("l_returnflag")).alias("queue"),
        F.col("l_orderkey").alias("message_id"),
        F.col("l_linenumber").alias("priority"),
        whole.alias("text"),
    )

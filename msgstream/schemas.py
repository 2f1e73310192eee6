"""Row shapes shared by the library. Streams never infer a schema; they use these."""

from pyspark.sql import types as T

ENVELOPE = T.StructType(
    [
        T.StructField("queue", T.StringType(), False),
        T.StructField("message_id", T.LongType(), False),
        T.StructField("message_type", T.StringType(), False),
        T.StructField("destination", T.StringType()),
        T.StructField("expiration", T.LongType()),
        T.StructField("priority", T.IntegerType()),
        T.StructField("redelivered", T.BooleanType()),
        T.StructField("reply_to", T.StringType()),
        T.StructField("receive_ts", T.TimestampType()),
        T.StructField("sender_ts", T.TimestampType()),
        T.StructField("sequence_number", T.LongType()),
        T.StructField("time_to_live", T.LongType()),
        T.StructField("sender_id", T.StringType()),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("content", T.BinaryType()),
        T.StructField("attachment", T.BinaryType()),
        T.StructField("stream_items", T.ArrayType(T.StringType())),
        T.StructField("map_items", T.MapType(T.StringType(), T.StringType())),
    ]
)

DELIVERY_LOG = T.StructType(
    [
        T.StructField("queue", T.StringType(), False),
        T.StructField("message_id", T.LongType()),
        T.StructField("kind", T.StringType(), False),
        T.StructField("event_time", T.TimestampType(), False),
        T.StructField("size_bytes", T.LongType()),
    ]
)

# The sixteen fields of a trade row, with the type each is stored as.
TRADE_FIELDS = {
    "date": "date",
    "sym": "string",
    "time": "string",
    "lowAskSize": "int",
    "highAskSize": "int",
    "lowBidPrice": "float",
    "highBidPrice": "float",
    "lowBidSize": "int",
    "highBidSize": "int",
    "lowTradePrice": "float",
    "highTradePrice": "float",
    "lowTradeSize": "int",
    "highTradeSize": "int",
    "lowAskPrice": "float",
    "highAskPrice": "float",
    "vwap": "float",
}

# Prices are read at single precision and stored as DOUBLE, which holds the value read exactly.
_STORED = {"date": T.DateType(), "string": T.StringType(), "int": T.IntegerType(), "float": T.DoubleType()}
TRADE = T.StructType([T.StructField(name, _STORED[kind]) for name, kind in TRADE_FIELDS.items()])

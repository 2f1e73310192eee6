"""The queries, each with the SQL that must give the same rows on the same tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgstream.compaction import compact_window_files
from msgstream.config import ReadConfig, default_table_name
from msgstream.functions import text as tx
from msgstream.functions.payload import trade_quarantine, trade_rows
from msgstream.functions.proto import decode_test, encode_test
from msgstream.operators import dedup, eventtime, health, mappers, words
from msgstream.plans import bindings as b
from msgstream.plans import flows
from msgstream.schemas import TRADE, TRADE_FIELDS
from msgstream.scratch import shared_folder
from msgstream.sinks import append_rows, log_lines, write_window_files
from msgstream.sources import landing, queues
from msgstream.streaming import jobs, keyed, ledger, rewindow

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ALL_QUEUES = [*b.EVENT_QUEUES, b.IDLE_QUEUE]

# The bindings again, as DuckDB reads them.
EVENT_MESSAGES = """
event_messages AS (
  SELECT e.*, r.redelivered, 'Q/' || event_type AS queue, event_id AS message_id,
    ts + to_microseconds(user_id * 100000 + CASE WHEN redelivered THEN 2000000 ELSE 0 END) AS receive_ts,
    CASE WHEN value >= 5 THEN ts END AS sender_ts,
    CASE WHEN event_type <> 'error' THEN user_id END AS sequence_number,
    json_extract_string(props, '$.k') AS k,
    NOT (event_type = 'view' AND value < 20) AS attached,
    event_type || ' ' || CASE WHEN event_type = 'view' AND value < 20 THEN '' ELSE props END AS text
  FROM events e JOIN (VALUES (false), (true)) r(redelivered) ON NOT redelivered OR value >= 100)
"""
DOCUMENT_MESSAGES = """
document_messages AS (
  SELECT source AS queue, doc_id AS message_id, redelivered, text,
    TIMESTAMP '2024-01-01' + to_seconds(doc_id) AS sender_ts,
    TIMESTAMP '2024-01-01' + to_seconds(doc_id + CASE WHEN redelivered THEN 3 ELSE 2 END) AS receive_ts
  FROM documents JOIN (VALUES (false), (true)) r(redelivered) ON NOT redelivered OR lang <> 'en')
"""
DELIVERY_LOG = """
log AS (
  SELECT 'Q/' || event_type AS queue, CASE WHEN kind <> 'rebind' THEN event_id END AS message_id, kind,
    CASE WHEN kind = 'published' THEN ts ELSE ts + to_microseconds(user_id * 100000 + late * 1000000) END AS event_time,
    octet_length(encode(props)) AS size_bytes
  FROM events JOIN (VALUES ('published', 0), ('delivered', 0), ('removed', 1), ('rebind', 1), ('delivered', 2),
                           ('ready', 3), ('acked', 4)) k(kind, late)
    ON kind = 'published' OR (kind = 'delivered' AND late = 0 AND value >= 10)
    OR ((kind IN ('removed', 'rebind') OR late = 2) AND value >= 100)
    OR (kind = 'ready' AND value >= 10) OR (kind = 'acked' AND value >= 10 AND event_type <> 'error'))
"""
TRADE_MESSAGES = """
trade_payloads AS (
  SELECT *, l_returnflag || l_linestatus AS flags, strftime(l_shipdate, '%Y-%m-%d') AS d,
    CAST(CAST(l_quantity AS INT) AS VARCHAR) AS q,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS p, CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR) AS t
  FROM lineitem),
trade_texts AS (
  SELECT *, CASE WHEN l_returnflag = 'A' THEN l_linenumber ELSE 0 END AS odd,
    '[{"date":"' || CASE WHEN odd = 5 THEN substring(d, 1, 4) ELSE d END || '","sym":'
    || CASE WHEN odd = 7 THEN '{"s":1}' ELSE '"S' || l_partkey || '"' END || ',"time":"09:' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0')
    || '","lowAskSize":' || CASE WHEN flags = 'NF' THEN '"many"' ELSE q END || ',"highAskSize":' || q || '0'
    || ',"lowBidPrice":' || p || ',"highBidPrice":' || p || '5,"lowBidSize":' || q || ',"highBidSize":' || q
    || ',"lowTradePrice":' || p || ',"highTradePrice":' || p || ',"lowTradeSize":0,"highTradeSize":' || q
    || ',"lowAskPrice":' || p || ',"highAskPrice":' || p || ',"vwap":' || CASE WHEN odd = 6 THEN '"NaN"' ELSE t END
    || '},{"date" : "' || d || '", "sym" : "S' || l_partkey || ',X", "lowAskSize" : ' || q || '}]' AS whole
  FROM trade_payloads),
trade_messages AS (
  SELECT 'Q/' || l_returnflag AS queue, l_orderkey AS message_id, l_linenumber AS priority,
    CASE WHEN flags = 'RF' THEN substring(whole, 1, length(whole) - 5) ELSE whole END AS text
  FROM trade_texts),
parsed_quotes AS (
  SELECT queue, message_id, priority, text, unnest(range(CAST(json_array_length(text) AS BIGINT))) AS quote_no,
    unnest(from_json(text, '["JSON"]')) AS q
  FROM trade_messages WHERE json_valid(text)),
trade_quotes AS (
  SELECT *, CASE
    WHEN NOT regexp_full_match(json_extract_string(q, '$.date'), '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN 'date'
    WHEN json_type(q, '$.sym') = 'OBJECT' THEN 'sym'
    WHEN json_extract_string(q, '$.vwap') = 'NaN' THEN 'vwap'
    WHEN TRY_CAST(json_extract_string(q, '$.lowAskSize') AS INT) IS NULL THEN 'lowAskSize' END AS misfit
  FROM parsed_quotes)
"""
SENT_TIME = "coalesce(sender_ts, receive_ts)"
WORD_ROWS = "unnest(regexp_split_to_array(text, '[^\\p{L}]+')) AS word"


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.event_messages(b.table(spark, sf_dir, "events"))


def event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mappers.text_record(events(spark, sf_dir), keep=("queue",))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.document_messages(b.table(spark, sf_dir, "documents"))


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.delivery_log(b.table(spark, sf_dir, "events"))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.trade_messages(b.table(spark, sf_dir, "lineitem"))


# --- the end-to-end flows -------------------------------------------------------------------------


@query(
    "word_count_4s_dedup",
    f"""WITH {DOCUMENT_MESSAGES}, firsts AS (
      SELECT time_bucket(INTERVAL '4 seconds', {SENT_TIME}) AS window_start, text FROM document_messages
      QUALIFY row_number() OVER (PARTITION BY window_start, message_id ORDER BY receive_ts, redelivered, queue) = 1),
    words AS (SELECT window_start, {WORD_ROWS} FROM firsts)
    SELECT window_start, word, count(*) AS count FROM words WHERE word <> '' GROUP BY ALL""",
)
def word_count_4s_dedup(spark, sf_dir):
    counted = flows.deduplicated_word_count(documents(spark, sf_dir), use_sender_timestamp=True)
    return eventtime.window_bounds(counted).select("window_start", "word", "count")


@query(
    "word_count_by_sequence",
    f"""WITH {EVENT_MESSAGES}, timed AS (
      SELECT *, time_bucket(INTERVAL '1 hour', receive_ts) AS window_start FROM event_messages),
    firsts AS (SELECT window_start, text FROM timed
      QUALIFY sequence_number IS NULL OR row_number() OVER
        (PARTITION BY window_start, sequence_number ORDER BY receive_ts, redelivered, message_id, queue) = 1),
    words AS (SELECT window_start, {WORD_ROWS} FROM firsts)
    SELECT window_start, word, count(*) AS count FROM words WHERE word <> '' GROUP BY ALL""",
)
def word_count_by_sequence(spark, sf_dir):
    counted = flows.deduplicated_word_count(event_texts(spark, sf_dir), "1 hour", by_sequence=True)
    return eventtime.window_bounds(counted).select("window_start", "word", "count")


WORD_LINES = f"""WITH {EVENT_MESSAGES}, words AS (
      SELECT time_bucket(INTERVAL '10 seconds', {SENT_TIME}) AS window_start, {WORD_ROWS} FROM event_messages),
    lines AS (SELECT window_start, word || ': ' || count(*) AS line FROM words WHERE word <> '' GROUP BY window_start, word)"""


@query("word_count_10s_lines", f"{WORD_LINES} SELECT window_start, line FROM lines")
def word_count_10s_lines(spark, sf_dir):
    lines = flows.word_count_lines(event_texts(spark, sf_dir), use_sender_timestamp=True)
    return eventtime.window_bounds(lines).select("window_start", "line")


@query("log_lines", f"{WORD_LINES} SELECT '***' || line AS line FROM lines")
def log_line_query(spark, sf_dir):
    return log_lines(flows.word_count_lines(event_texts(spark, sf_dir), use_sender_timestamp=True))


# Files per window suit windows that hold a file's worth of rows, hence the greater width.
FILE_WIDTH = "6 hours"
FILE_LINES = f"""{WORD_LINES.replace("10 seconds", FILE_WIDTH)} SELECT strftime(window_start, '%Y%m%dT%H%M%S') || '-' ||
      strftime(window_start + INTERVAL '{FILE_WIDTH}', '%Y%m%dT%H%M%S') AS window_key, line FROM lines"""


@query("window_files", FILE_LINES)
def window_files(spark, sf_dir):
    """Writes the word counts as files per window and reads them back."""
    path = shared_folder(spark, "window-files")
    write_window_files(flows.word_count_lines(event_texts(spark, sf_dir), FILE_WIDTH, use_sender_timestamp=True), path)
    return _window_lines(spark, path)


# Windows of the reference width, an hour of them to a folder.
SHORT_LINES = f"""{WORD_LINES} SELECT strftime(window_start, '%Y%m%dT%H%M%S') || '-' ||
      strftime(window_start + INTERVAL '10 seconds', '%Y%m%dT%H%M%S') AS window_key, line FROM lines"""


@query("window_files_10s", SHORT_LINES)
def window_files_10s(spark, sf_dir):
    path = shared_folder(spark, "short-window-files")
    lines = flows.word_count_lines(event_texts(spark, sf_dir), "10 seconds", use_sender_timestamp=True)
    write_window_files(lines, path, folders="hour")
    found = spark.read.schema("value string, window_key string").text(path)
    return found.select(F.split("value", "\t")[0].alias("window_key"), F.split("value", "\t", 2)[1].alias("line"))


@query(
    "window_file_shards",
    f"""WITH files AS ({FILE_LINES})
    SELECT window_key, count(*) AS lines, true AS at_most_three_files FROM files GROUP BY window_key""",
)
def window_file_shards(spark, sf_dir):
    """Window files of three shards at most, counted per window."""
    path = shared_folder(spark, "sharded-window-files")
    lines = flows.word_count_lines(event_texts(spark, sf_dir), FILE_WIDTH, use_sender_timestamp=True)
    write_window_files(lines, path, shards=3)
    rows = spark.read.schema("value string, window_key string, shard string").text(path)
    per_file = rows.groupBy("window_key", F.input_file_name().alias("file")).agg(F.count("*").alias("lines"))
    return per_file.groupBy("window_key").agg(F.sum("lines").alias("lines"), (F.count("*") <= 3).alias("at_most_three_files"))


@query("window_files_compacted", f"SELECT *, true AS in_one_file FROM ({FILE_LINES})")
def window_files_compacted(spark, sf_dir):
    """Window files of four batches, put together: one file a window, as all are small, and nothing left to do after."""
    path = shared_folder(spark, "compacted-window-files")
    lines = flows.word_count_lines(event_texts(spark, sf_dir), FILE_WIDTH, use_sender_timestamp=True)
    part = F.pmod(F.xxhash64("line"), F.lit(4))
    for number in range(4):
        write_window_files(lines.where(part == number), path, batch_id=number)
    compact_window_files(spark, path)
    left = compact_window_files(spark, path)
    rows = spark.read.schema("value string, window_key string, batch_id int").text(path)
    files = rows.select("window_key", F.col("_metadata.file_path").alias("file")).distinct().groupBy("window_key").agg(F.count("*").alias("files"))
    single = files.agg(F.max("files") == 1).scalar()
    return rows.select("window_key", F.col("value").alias("line"), (single & F.lit(left == 0)).alias("in_one_file"))


def _window_lines(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema("value string, window_key string").text(path)
    return rows.select("window_key", F.col("value").alias("line"))


# --- sources --------------------------------------------------------------------------------------

READ_QUEUES = ["Q/click", "Q/view", "Q/click"]


@query(
    "read_queues",
    f"""WITH {EVENT_MESSAGES} SELECT queue, message_id, redelivered, receive_ts, text FROM event_messages
    WHERE queue IN ('Q/click', 'Q/view')""",
)
def read_queues(spark, sf_dir):
    """Publishes every message to a landing folder and reads two queues of it, one of them listed twice."""
    path = shared_folder(spark, "landing")
    landing.publish(events(spark, sf_dir), path)
    config = ReadConfig(READ_QUEUES, batch=True)
    records = queues.read_queues(spark, path, config, mapper=lambda rows: mappers.text_record(rows, keep=("queue",)))
    return records.select("queue", "message_id", "redelivered", tx.utc_time("receive_ts").alias("receive_ts"), "text")


COPIES = "(SELECT count(*) // 10 FROM events)"


def _copies(spark: SparkSession, sf_dir: str) -> int:
    return b.table(spark, sf_dir, "events").count() // 10


@query(
    "published_copies",
    f"""SELECT DISTINCT 'Q/' || event_type AS queue, {COPIES} AS messages, 1 AS bodies, 'Test Message' AS test FROM events""",
)
def published_copies(spark, sf_dir):
    """The same encoded message a tenth as often as there are events, for each queue, published and read back."""
    path = shared_folder(spark, "copies")
    body = encode_test(F.lit("Test Message"))
    landing.publish(landing.copies_per_queue(spark, b.EVENT_QUEUES, _copies(spark, sf_dir), body), path)
    rows = queues.read_queues(spark, path, ReadConfig(b.EVENT_QUEUES, batch=True))
    test = F.max(decode_test("content")["test"]).alias("test")
    return rows.groupBy("queue").agg(
        F.count("*").alias("messages"), F.countDistinct("content").cast("int").alias("bodies"), test
    )


@query(
    "published_numbered",
    f"""SELECT 'Q/' || event_type || ' - ' || i AS text
    FROM (SELECT DISTINCT event_type FROM events), (SELECT unnest(range({COPIES})) AS i)""",
)
def published_numbered(spark, sf_dir):
    path = shared_folder(spark, "numbered")
    landing.publish(landing.numbered_messages(spark, b.EVENT_QUEUES, _copies(spark, sf_dir)), path)
    config = ReadConfig(b.EVENT_QUEUES, batch=True)
    return queues.read_queues(spark, path, config, mapper=lambda rows: mappers.payload(mappers.text_record(rows)))


def _read_columns(df: DataFrame) -> DataFrame:
    return df.select("queue", "message_id", "redelivered", tx.utc_time("receive_ts").alias("receive_ts"))


READ_COLUMNS = "SELECT queue, message_id, redelivered, receive_ts FROM event_messages"


@query("read_max_records", f"WITH {EVENT_MESSAGES} {READ_COLUMNS} ORDER BY receive_ts, message_id LIMIT 5000")
def read_max_records(spark, sf_dir):
    return _read_columns(queues.limited(events(spark, sf_dir), ReadConfig(ALL_QUEUES, max_records=5000)))


@query(
    "read_max_time",
    f"""WITH {EVENT_MESSAGES} {READ_COLUMNS}
    WHERE receive_ts < (SELECT min(receive_ts) FROM event_messages) + INTERVAL '10 days'""",
)
def read_max_time(spark, sf_dir):
    config = ReadConfig(ALL_QUEUES, max_read_time=timedelta(days=10))
    return _read_columns(queues.limited(events(spark, sf_dir), config))


@query(
    "read_both_limits",
    f"""WITH {EVENT_MESSAGES} {READ_COLUMNS}
    WHERE queue IN ('Q/click', 'Q/view')
      AND receive_ts < (SELECT min(receive_ts) FROM event_messages WHERE queue IN ('Q/click', 'Q/view')) + INTERVAL '20 days'
    ORDER BY receive_ts, message_id LIMIT 100000""",
)
def read_both_limits(spark, sf_dir):
    config = ReadConfig(READ_QUEUES, max_records=100_000, max_read_time=timedelta(days=20))
    return _read_columns(queues.limited(queues.select_queues(events(spark, sf_dir), config.queues), config))


# --- mappers --------------------------------------------------------------------------------------

SHOWN_PROPERTIES = """CASE WHEN event_type <> 'view' THEN k END AS property_k,
      CASE WHEN event_type <> 'view' THEN CAST(user_id AS VARCHAR) END AS property_user"""
TEXT_COLUMNS = f"""'topic/' || event_type AS destination, CAST(0 AS BIGINT) AS expiration, message_id,
      CAST(floor(value / 100) AS INTEGER) AS priority, redelivered,
      CASE WHEN event_type = 'purchase' THEN 'reply/' || user_id END AS reply_to, receive_ts, sender_ts, sequence_number,
      CAST(floor(value) AS BIGINT) * 1000 AS time_to_live, text, {SHOWN_PROPERTIES}"""


def _plain_record(df: DataFrame) -> DataFrame:
    shown = df.withColumns(
        {
            "receive_ts": tx.utc_time("receive_ts"),
            "sender_ts": tx.utc_time("sender_ts"),
            "property_k": mappers.property_value("k"),
            "property_user": mappers.property_value("user"),
        }
    )
    return shown.drop("properties")


@query("text_mapper", f"WITH {EVENT_MESSAGES} SELECT {TEXT_COLUMNS} FROM event_messages")
def text_mapper(spark, sf_dir):
    return _plain_record(mappers.text_record(events(spark, sf_dir)))


@query(
    "text_mapper_with_sender",
    f"WITH {EVENT_MESSAGES} SELECT {TEXT_COLUMNS}, 'user-' || user_id AS sender_id FROM event_messages",
)
def text_mapper_with_sender(spark, sf_dir):
    return _plain_record(mappers.text_record(events(spark, sf_dir), include_sender_id=True))


@query(
    "string_mapper",
    f"""WITH {EVENT_MESSAGES} SELECT message_id, redelivered, CASE event_type
      WHEN 'click' THEN event_type || ' ' WHEN 'signup' THEN event_type || ' '
      WHEN 'purchase' THEN '["purchase","{{\\"k\\": ' || k || '}}"]'
      WHEN 'error' THEN '{{"k":"' || k || '","type":"error"}}'
      ELSE CASE WHEN attached THEN props ELSE event_type || ' ' END END AS text
    FROM event_messages""",
)
def string_mapper(spark, sf_dir):
    return mappers.string_record(events(spark, sf_dir), keep=("message_id", "redelivered"))


@query("bytes_mapper", f"WITH {EVENT_MESSAGES} SELECT message_id, redelivered, hex(encode(event_type || ' ')) AS raw FROM event_messages")
def bytes_mapper(spark, sf_dir):
    records = mappers.bytes_record(events(spark, sf_dir), keep=("redelivered",))
    return records.select("message_id", "redelivered", F.hex("raw").alias("raw"))


@query(
    "property_lookup",
    f"""WITH {EVENT_MESSAGES} SELECT message_id, redelivered, CASE WHEN event_type <> 'view' THEN k END AS k_text,
      CASE WHEN event_type <> 'view' THEN CAST(k AS INTEGER) END AS k_number, CAST(NULL AS VARCHAR) AS no_such_property
    FROM event_messages""",
)
def property_lookup(spark, sf_dir):
    return events(spark, sf_dir).select(
        "message_id",
        "redelivered",
        mappers.property_value("k").alias("k_text"),
        mappers.typed_property("k", "int").alias("k_number"),
        mappers.property_value("none").alias("no_such_property"),
    )


@query("redelivered_messages", f"WITH {EVENT_MESSAGES} SELECT queue, message_id, text FROM event_messages WHERE redelivered")
def redelivered_messages(spark, sf_dir):
    return mappers.redelivered_only(event_texts(spark, sf_dir)).select("queue", "message_id", "text")


@query("payloads", f"WITH {DOCUMENT_MESSAGES} SELECT text FROM document_messages")
def payloads(spark, sf_dir):
    return mappers.payload(documents(spark, sf_dir))


# --- event time and windows -----------------------------------------------------------------------


@query(
    "event_time_policy",
    f"""WITH {EVENT_MESSAGES} SELECT message_id, redelivered, receive_ts AS by_receipt, {SENT_TIME} AS by_sender
    FROM event_messages""",
)
def event_time_policy(spark, sf_dir):
    return event_texts(spark, sf_dir).select(
        "message_id",
        "redelivered",
        tx.utc_time(eventtime.event_time(False)).alias("by_receipt"),
        tx.utc_time(eventtime.event_time(True)).alias("by_sender"),
    )


@query(
    "window_counts",
    f"""WITH {EVENT_MESSAGES} SELECT time_bucket(INTERVAL '4 seconds', receive_ts) AS window_start,
      time_bucket(INTERVAL '4 seconds', receive_ts) + INTERVAL '4 seconds' AS window_end, count(*) AS count
    FROM event_messages GROUP BY ALL""",
)
def window_counts(spark, sf_dir):
    counted = words.count_each(flows.windowed(event_texts(spark, sf_dir), "4 seconds"), ("window",))
    return eventtime.window_bounds(counted)


@query(
    "window_labels",
    f"""WITH {EVENT_MESSAGES}, timed AS (SELECT time_bucket(INTERVAL '10 seconds', receive_ts) AS w FROM event_messages)
    SELECT strftime(w, '%H.%M') || '-' || strftime(w + INTERVAL '10 seconds', '%H.%M') AS label,
      count(DISTINCT w) AS windows, count(*) AS messages FROM timed GROUP BY label""",
)
def window_labels(spark, sf_dir):
    per_window = words.count_each(flows.windowed(event_texts(spark, sf_dir), "10 seconds"), ("window",))
    label = tx.window_label("window.start", "window.end").alias("label")
    return per_window.groupBy(label).agg(F.count("*").alias("windows"), F.sum("count").alias("messages"))


@query(
    "window_file_names",
    f"""WITH {EVENT_MESSAGES}, timed AS (SELECT time_bucket(INTERVAL '10 seconds', receive_ts) AS w FROM event_messages)
    SELECT DISTINCT w AS window_start, 'counts-' || strftime(w, '%H.%M') || '-' || strftime(w + INTERVAL '10 seconds', '%H.%M')
      || '-0-of-1.txt' AS file_name FROM timed""",
)
def window_file_names(spark, sf_dir):
    per_window = words.count_each(flows.windowed(event_texts(spark, sf_dir), "10 seconds"), ("window",))
    name = tx.window_file_name("counts", "window.start", "window.end", F.lit(0), 1, ".txt").alias("file_name")
    return per_window.select(tx.utc_time("window.start").alias("window_start"), name)


@query(
    "freshness_by_queue",
    f"""WITH {EVENT_MESSAGES}, waits AS (
      SELECT queue, date_diff('millisecond', sender_ts, receive_ts) AS wait FROM event_messages)
    SELECT queue, count(wait) AS timed_messages, count(*) - count(wait) AS untimed_messages, min(wait) AS min_latency_ms,
      max(wait) AS max_latency_ms, CAST(sum(wait) AS BIGINT) AS total_latency_ms, avg(wait) AS avg_latency_ms,
      quantile_cont(wait, 0.5) AS median_latency_ms, quantile_cont(wait, 0.95) AS p95_latency_ms
    FROM waits GROUP BY queue""",
)
def freshness_by_queue(spark, sf_dir):
    return eventtime.freshness(event_texts(spark, sf_dir))


# --- repeated messages ----------------------------------------------------------------------------


@query(
    "dedup_by_id",
    f"""WITH {EVENT_MESSAGES}, timed AS (
      SELECT *, time_bucket(INTERVAL '4 seconds', receive_ts) AS window_start FROM event_messages)
    SELECT window_start, message_id, receive_ts, redelivered FROM timed QUALIFY row_number() OVER
      (PARTITION BY window_start, message_id ORDER BY receive_ts, redelivered, queue) = 1""",
)
def dedup_by_id(spark, sf_dir):
    rows = dedup.distinct_in_window(flows.windowed(event_texts(spark, sf_dir), "4 seconds"))
    return eventtime.window_bounds(rows).select(
        "window_start", "message_id", tx.utc_time("receive_ts").alias("receive_ts"), "redelivered"
    )


@query(
    "dedup_by_sequence",
    f"""WITH {EVENT_MESSAGES}, timed AS (
      SELECT *, time_bucket(INTERVAL '1 hour', receive_ts) AS window_start FROM event_messages)
    SELECT window_start, sequence_number, message_id, redelivered FROM timed
    QUALIFY sequence_number IS NULL OR row_number() OVER
      (PARTITION BY window_start, sequence_number ORDER BY receive_ts, redelivered, message_id, queue) = 1""",
)
def dedup_by_sequence(spark, sf_dir):
    rows = dedup.distinct_by_sequence(flows.windowed(event_texts(spark, sf_dir), "1 hour"))
    return eventtime.window_bounds(rows).select("window_start", "sequence_number", "message_id", "redelivered")


@query(
    "dedup_content",
    f"""WITH {EVENT_MESSAGES} SELECT message_id, redelivered, receive_ts, text FROM event_messages
    QUALIFY row_number() OVER (PARTITION BY CASE WHEN event_type <> 'view' THEN k || '/' || user_id END, event_type,
      redelivered, floor(value / 100), text ORDER BY receive_ts, message_id, queue) = 1""",
)
def dedup_content(spark, sf_dir):
    rows = dedup.distinct_content(event_texts(spark, sf_dir))
    return rows.select("message_id", "redelivered", tx.utc_time("receive_ts").alias("receive_ts"), "text")


@query(
    "dedup_across_windows",
    f"""WITH {DOCUMENT_MESSAGES} SELECT message_id, receive_ts, redelivered, text FROM document_messages
    QUALIFY row_number() OVER (PARTITION BY message_id ORDER BY receive_ts, redelivered, queue) = 1""",
)
def dedup_across_windows(spark, sf_dir):
    rows = dedup.distinct_across_windows(documents(spark, sf_dir))
    return rows.select("message_id", tx.utc_time("receive_ts").alias("receive_ts"), "redelivered", "text")


RECEIPTS = f"""WITH {EVENT_MESSAGES}, receipts AS (
      SELECT queue, message_id, count(*) FILTER (NOT redelivered) AS first_copies,
        count(*) FILTER (redelivered) AS redelivered_copies, count(DISTINCT text) = 1 AS same_text
      FROM event_messages GROUP BY ALL)"""


@query("redelivery_pairs", f"{RECEIPTS} SELECT * FROM receipts WHERE first_copies > 0 AND redelivered_copies > 0")
def redelivery_pairs(spark, sf_dir):
    return dedup.redelivery_pairs(event_texts(spark, sf_dir))


@query(
    "duplicate_totals",
    f"""{RECEIPTS} SELECT queue, count(*) AS messages, CAST(sum(first_copies + redelivered_copies) AS BIGINT) AS receipts,
      CAST(sum(first_copies + redelivered_copies - 1) AS BIGINT) AS surplus FROM receipts GROUP BY queue""",
)
def duplicate_totals(spark, sf_dir):
    return dedup.duplicate_totals(event_texts(spark, sf_dir))


@query(
    "payload_bag_difference",
    f"""WITH {DOCUMENT_MESSAGES}, sides AS (
      SELECT text, count(*) FILTER (NOT redelivered) AS left_count, count(*) AS right_count
      FROM document_messages GROUP BY text)
    SELECT * FROM sides WHERE left_count <> right_count""",
)
def payload_bag_difference(spark, sf_dir):
    received = documents(spark, sf_dir)
    return dedup.bag_difference(received.where(~F.col("redelivered")), received)


# --- words, lines, counts -------------------------------------------------------------------------


@query(
    "word_totals",
    f"""WITH words AS (SELECT {WORD_ROWS} FROM documents)
    SELECT word, count(*) AS count FROM words WHERE word <> '' GROUP BY word""",
)
def word_totals(spark, sf_dir):
    return words.count_words(b.table(spark, sf_dir, "documents"), keep=())


LINE_STATS = r"""count(*) FILTER (regexp_full_match(text, '[\x00-\x20]*')) AS empty_lines, count(text) AS line_count,
      CAST(sum(units) AS BIGINT) AS length_sum, min(units) AS length_min, max(units) AS length_max, avg(units) AS length_mean"""
LINE_UNITS = r"""length(text) + length(regexp_replace(text, '[^\x{10000}-\x{10FFFF}]', '', 'g')) AS units"""


@query(
    "line_stats",
    f"""WITH {DOCUMENT_MESSAGES}, lines AS (SELECT queue, text, {LINE_UNITS} FROM document_messages)
    SELECT queue, {LINE_STATS} FROM lines GROUP BY queue""",
)
def line_stats(spark, sf_dir):
    return words.line_stats(documents(spark, sf_dir), by=("queue",))


@query(
    "line_stats_all",
    f"""WITH texts AS (SELECT unnest(string_split(text, chr(10))) AS text FROM documents),
    lines AS (SELECT text, {LINE_UNITS} FROM texts) SELECT {LINE_STATS} FROM lines""",
)
def line_stats_all(spark, sf_dir):
    lines = b.table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n", -1)).alias("text"))
    return words.line_stats(lines)


@query("global_count", f"WITH {EVENT_MESSAGES} SELECT count(*) AS count FROM event_messages HAVING count(*) > 0")
def global_count(spark, sf_dir):
    return words.global_count(events(spark, sf_dir))


@query(
    "global_count_of_none",
    f"WITH {EVENT_MESSAGES} SELECT count(*) AS count FROM event_messages WHERE queue = 'Q/idle' HAVING count(*) > 0",
)
def global_count_of_none(spark, sf_dir):
    return words.global_count(queues.select_queues(events(spark, sf_dir), [b.IDLE_QUEUE]))


@query(
    "distinct_lines",
    f"""WITH {EVENT_MESSAGES} SELECT count(*) AS lines, count(DISTINCT text) AS distinct_lines,
      count(*) - count(DISTINCT text) AS repeated_lines FROM event_messages""",
)
def distinct_lines(spark, sf_dir):
    """Writes every text as a line of a file, then counts the lines of all files."""
    path = shared_folder(spark, "lines")
    mappers.payload(event_texts(spark, sf_dir)).write.text(path)
    return words.distinct_lines(spark.read.text(path))


@query(
    "repeated_lines",
    f"WITH {EVENT_MESSAGES} SELECT text, count(*) AS copies FROM event_messages GROUP BY text HAVING count(*) > 1",
)
def repeated_lines(spark, sf_dir):
    return words.repeated_lines(event_texts(spark, sf_dir), "text")


@query("unique_queues", f"WITH {EVENT_MESSAGES} SELECT count(DISTINCT queue) AS queues FROM event_messages")
def unique_queues(spark, sf_dir):
    return words.unique_queues(events(spark, sf_dir))


# --- payloads -------------------------------------------------------------------------------------

QUOTE_COLUMNS = ", ".join(
    (
        f"CAST(CAST(json_extract_string(q, '$.{name}') AS FLOAT) AS DOUBLE) AS \"{name}\""
        if kind == "float"
        else f"CAST(json_extract_string(q, '$.{name}') AS {'VARCHAR' if kind == 'string' else kind}) AS \"{name}\""
    )
    for name, kind in TRADE_FIELDS.items()
)
GOOD_QUOTES = "misfit IS NULL"


@query("trade_rows", f"WITH {TRADE_MESSAGES} SELECT queue, message_id, priority, {QUOTE_COLUMNS} FROM trade_quotes WHERE {GOOD_QUOTES}")
def trade_row_query(spark, sf_dir):
    return trade_rows(trades(spark, sf_dir), keep=("queue", "message_id", "priority"))


@query(
    "trade_quarantine",
    f"""WITH {TRADE_MESSAGES}
    SELECT queue, message_id, CAST(quote_no AS INTEGER) AS quote_no, 'wrong type: ' || misfit AS reason,
      json_extract_string(q, '$.' || misfit) AS value
    FROM trade_quotes WHERE NOT ({GOOD_QUOTES})
    UNION ALL SELECT queue, message_id, NULL, 'not a list of quotes', text FROM trade_messages WHERE NOT json_valid(text)""",
)
def trade_quarantine_query(spark, sf_dir):
    return trade_quarantine(trades(spark, sf_dir))


@query("trade_table", f"WITH {TRADE_MESSAGES} SELECT {QUOTE_COLUMNS} FROM trade_quotes WHERE {GOOD_QUOTES}")
def trade_table(spark, sf_dir):
    """Appends the trade rows to a table made for them, and reads the table."""
    path = shared_folder(spark, "trades")
    name = default_table_name(path.rsplit("/", 1)[-1])
    append_rows(trade_rows(trades(spark, sf_dir)), name, TRADE, path)
    # The table was made for this query alone; its files stay as long as the session.
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(TRADE).parquet(path)


@query(
    "table_schema_check",
    """SELECT 'same schema' AS attempt, count(*) AS rows_after, '' AS complaint FROM events
    UNION ALL SELECT 'other schema', count(*),
      'expecting: struct<event_id:bigint,value:string>, actual: struct<event_id:bigint,value:double>' FROM events""",
)
def table_schema_check(spark, sf_dir):
    """All events are appended to a table, then once more with another type, which is refused."""
    path = shared_folder(spark, "checked")
    name = default_table_name(path.rsplit("/", 1)[-1])
    rows = b.table(spark, sf_dir, "events").select("event_id", "value")
    stored, found = rows.schema, []
    for attempt, given in (("same schema", rows), ("other schema", rows.withColumn("value", F.col("value").cast("string")))):
        complaint = ""
        try:
            append_rows(given, name, path=path)
        except ValueError as refused:
            complaint = str(refused)[str(refused).index("expecting") :]
        after = spark.read.schema(stored).parquet(path).agg(F.count("*").alias("rows_after"))
        found.append(after.select(F.lit(attempt).alias("attempt"), "rows_after", F.lit(complaint).alias("complaint")))
    spark.sql(f"DROP TABLE {name}")
    return found[0].unionByName(found[1])


@query(
    "dedup_bytes",
    f"""WITH {DOCUMENT_MESSAGES} SELECT time_bucket(INTERVAL '4 seconds', {SENT_TIME}) AS window_start, message_id,
      hex(encode(text)) AS raw FROM document_messages
    QUALIFY row_number() OVER (PARTITION BY window_start, message_id ORDER BY receive_ts, redelivered, queue) = 1""",
)
def dedup_bytes(spark, sf_dir):
    """Bytes records, each once in its window."""
    bodies = documents(spark, sf_dir).withColumn("content", F.encode("text", "UTF-8")).drop("text")
    records = mappers.bytes_record(bodies, keep=("queue", "redelivered", "receive_ts", "sender_ts"))
    rows = dedup.distinct_in_window(flows.windowed(records, "4 seconds", use_sender_timestamp=True))
    return eventtime.window_bounds(rows).select("window_start", "message_id", F.hex("raw").alias("raw"))


@query(
    "proto_decode",
    f"""WITH {DOCUMENT_MESSAGES} SELECT time_bucket(INTERVAL '4 seconds', {SENT_TIME}) AS window_start, message_id, text AS test
    FROM document_messages
    QUALIFY row_number() OVER (PARTITION BY window_start, message_id ORDER BY receive_ts, redelivered, queue) = 1""",
)
def proto_decode(spark, sf_dir):
    encoded = documents(spark, sf_dir).withColumn("content", encode_test("text")).drop("text")
    decoded = flows.decoded_messages(encoded, use_sender_timestamp=True)
    return eventtime.window_bounds(decoded).select("window_start", "message_id", "test")


@query(
    "proto_encode",
    """WITH sized AS (SELECT doc_id, encode(text) AS body, octet_length(encode(text)) AS n FROM documents)
    SELECT doc_id, '0A' || CASE WHEN n < 128 THEN printf('%02X', n)
      WHEN n < 16384 THEN printf('%02X%02X', n % 128 + 128, n // 128)
      WHEN n < 2097152 THEN printf('%02X%02X%02X', n % 128 + 128, n // 128 % 128 + 128, n // 16384)
      WHEN n < 268435456 THEN printf('%02X%02X%02X%02X', n % 128 + 128, n // 128 % 128 + 128, n // 16384 % 128 + 128, n // 2097152)
      ELSE printf('%02X%02X%02X%02X%02X', n % 128 + 128, n // 128 % 128 + 128, n // 16384 % 128 + 128,
        n // 2097152 % 128 + 128, n // 268435456) END || hex(body) AS body
    FROM sized""",
)
def proto_encode(spark, sf_dir):
    docs = b.table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.hex(encode_test("text")).alias("body"))


@query("numbered_payloads", "SELECT event_id, 'Q/' || event_type || ' - ' || event_id AS payload FROM events")
def numbered_payloads(spark, sf_dir):
    rows = b.table(spark, sf_dir, "events")
    queue = F.concat(F.lit("Q/"), F.col("event_type"))
    return rows.select("event_id", tx.numbered_payload(queue, F.col("event_id")).alias("payload"))


@query(
    "job_names",
    r"""SELECT page_id, lower(regexp_replace(regexp_replace(url, '[^\w]', '-', 'g'), '^[^a-zA-Z]', 'a')) AS job_name,
      replace(lower(regexp_replace(regexp_replace(url, '[^\w]', '-', 'g'), '^[^a-zA-Z]', 'a')), '-', '_') AS table_name
    FROM pages""",
)
def job_names(spark, sf_dir):
    named = b.table(spark, sf_dir, "pages").select("page_id", tx.normalized_name("url").alias("job_name"))
    return named.withColumn("table_name", tx.table_name("job_name"))


@query(
    "object_paths",
    r"""SELECT page_id, nullif(regexp_extract(url, '^https://([^/]+)/(.+)$', 1), '') AS bucket,
      nullif(regexp_extract(url, '^https://([^/]+)/(.+)$', 2), '') AS object FROM pages""",
)
def object_paths(spark, sf_dir):
    path = tx.object_path("url", scheme="https", on_bad="null").alias("path")
    return b.table(spark, sf_dir, "pages").select("page_id", path).select("page_id", "path.bucket", "path.object")


# --- queue health ---------------------------------------------------------------------------------

QUEUE_STATUS = f"""WITH {DELIVERY_LOG}, status AS (
      SELECT queue, message_id, bool_or(kind = 'published') AS published, bool_or(kind = 'delivered') AS delivered,
        bool_or(kind = 'acked') AS acked, max(size_bytes) AS size_bytes
      FROM log WHERE message_id IS NOT NULL GROUP BY ALL),
    per_queue AS (SELECT queue, count(*) FILTER (published) AS published, count(*) FILTER (acked) AS received,
        count(*) FILTER (published AND NOT acked) AS message_count, count(*) FILTER (delivered AND NOT acked) AS unacked_count,
        CAST(coalesce(sum(size_bytes) FILTER (published AND NOT acked), 0) AS BIGINT) AS backlog_bytes
      FROM status GROUP BY queue
      UNION ALL SELECT 'Q/idle', 0, 0, 0, 0, 0),
    queue_status AS (SELECT *, message_count = 0 AS is_empty, unacked_count >= message_count AS all_delivered,
        published = message_count + received AS conserved FROM per_queue)"""


@query("queue_status", f"{QUEUE_STATUS} SELECT * FROM queue_status")
def queue_status(spark, sf_dir):
    return health.queue_status(log(spark, sf_dir), ALL_QUEUES)


@query("queue_backlog", f"{QUEUE_STATUS} SELECT queue, message_count, backlog_bytes, is_empty FROM queue_status")
def queue_backlog(spark, sf_dir):
    return health.queue_backlog(log(spark, sf_dir), ALL_QUEUES)


@query("queue_unacked", f"{QUEUE_STATUS} SELECT queue, unacked_count FROM queue_status")
def queue_unacked(spark, sf_dir):
    return health.queue_unacked(log(spark, sf_dir), ALL_QUEUES)


@query("queue_caught_up", f"{QUEUE_STATUS} SELECT queue, message_count, unacked_count, all_delivered FROM queue_status")
def queue_caught_up(spark, sf_dir):
    return health.queue_caught_up(log(spark, sf_dir), ALL_QUEUES)


@query(
    "delivery_conservation",
    f"""WITH {EVENT_MESSAGES}, status AS (
      SELECT queue, message_id, bool_or(value >= 20) AS received, bool_or(value < 40) AS waiting FROM event_messages GROUP BY ALL)
    SELECT queue, count(*) AS published, count(*) FILTER (received) AS received, count(*) FILTER (waiting) AS "left",
      count(*) FILTER (received AND waiting) AS in_both, bool_and(received OR waiting) AS conserved
    FROM status GROUP BY queue""",
)
def delivery_conservation(spark, sf_dir):
    """Published are all events, received those of value 20 and over with their copies, left those under 40."""
    published = events(spark, sf_dir)
    received = b.event_messages(b.table(spark, sf_dir, "events").where("value >= 20"))
    left = b.event_messages(b.table(spark, sf_dir, "events").where("value < 40"))
    return health.delivery_conservation(published, received, left)


@query("drained_queues", f"WITH {EVENT_MESSAGES} SELECT queue, count(*) AS count FROM event_messages WHERE queue <> 'Q/error' GROUP BY queue")
def drained_queues(spark, sf_dir):
    return words.count_each(health.drain_queues(events(spark, sf_dir), ["Q/error", b.IDLE_QUEUE]), ("queue",))


@query(
    "queue_counters_120s",
    f"""WITH {DELIVERY_LOG}, stages AS (
      SELECT queue, message_id, min(event_time) FILTER (kind = 'published') AS published_at,
        min(event_time) FILTER (kind = 'acked') AS acked_at, max(size_bytes) AS size_bytes
      FROM log WHERE message_id IS NOT NULL GROUP BY ALL),
    rows AS (
      SELECT queue, event_time, kind, 0 AS change FROM log
      UNION ALL SELECT queue, published_at, '', size_bytes FROM stages
      UNION ALL SELECT queue, acked_at, '', -size_bytes FROM stages WHERE acked_at IS NOT NULL),
    periods AS (SELECT queue, time_bucket(INTERVAL '120 seconds', event_time) AS window_start, sum(change) AS change,
        count(*) FILTER (kind = 'delivered') AS messages_received, count(*) FILTER (kind = 'ready') AS messages_ready,
        count(*) FILTER (kind = 'acked') AS messages_completed, count(*) FILTER (kind = 'rebind') AS rebinds,
        count(*) FILTER (kind = 'removed') AS messages_removed FROM rows GROUP BY ALL),
    levels AS (SELECT *, CAST(sum(change) OVER (PARTITION BY queue ORDER BY window_start) AS BIGINT) AS queue_backlog FROM periods)
    SELECT queue, window_start, queue_backlog, messages_received, messages_ready, messages_completed, rebinds, messages_removed,
      '{{"queueBacklog":' || queue_backlog || ',"messagesReceived":' || messages_received
      || ',"messagesCheckpointReady":' || messages_ready || ',"messagesCheckpointComplete":' || messages_completed
      || ',"pollFlowRebind":' || rebinds || ',"messagesRemovedFromCheckpointQueue":' || messages_removed || '}}' AS report
    FROM levels""",
)
def queue_counters_120s(spark, sf_dir):
    counters = health.queue_counters(log(spark, sf_dir)).withColumn("report", health.counters_json())
    return eventtime.window_bounds(counters).drop("window_end")


COUNTERS_OF = f"""WITH {DELIVERY_LOG}, stages AS (
      SELECT queue, message_id, min(event_time) FILTER (kind = 'published') AS published_at,
        min(event_time) FILTER (kind = 'acked') AS acked_at, max(size_bytes) AS size_bytes
      FROM log WHERE message_id IS NOT NULL GROUP BY ALL),
    rows AS (
      SELECT queue, event_time, kind, 0 AS change FROM log
      UNION ALL SELECT queue, published_at, '', size_bytes FROM stages
      UNION ALL SELECT queue, acked_at, '', -size_bytes FROM stages WHERE acked_at IS NOT NULL)"""


@query(
    "queue_counters_1s",
    f"""{COUNTERS_OF}, periods AS (
      SELECT queue, time_bucket(INTERVAL '1 second', event_time) AS window_start, sum(change) AS change,
        count(*) FILTER (kind = 'delivered') AS messages_received, count(*) FILTER (kind = 'ready') AS messages_ready,
        count(*) FILTER (kind = 'acked') AS messages_completed, count(*) FILTER (kind = 'rebind') AS rebinds,
        count(*) FILTER (kind = 'removed') AS messages_removed FROM rows GROUP BY ALL)
    SELECT * EXCLUDE (change), CAST(sum(change) OVER (PARTITION BY queue ORDER BY window_start) AS BIGINT) AS queue_backlog
    FROM periods""",
)
def queue_counters_1s(spark, sf_dir):
    """Periods of a second; the running backlog is summed in blocks of an hour, over many tasks a queue."""
    counters = health.queue_counters(log(spark, sf_dir), "1 second", block=3600)
    return eventtime.window_bounds(counters).drop("window_end")


@query(
    "commit_prefixes",
    f"""WITH {DELIVERY_LOG}, messages AS (
      SELECT queue, message_id, min(event_time) FILTER (kind = 'acked') AS acked_at FROM log
      WHERE message_id IS NOT NULL AND kind IN ('delivered', 'acked') GROUP BY ALL HAVING bool_or(kind = 'delivered')),
    marks AS (
      SELECT queue, message_id,
        max(coalesce(acked_at, TIMESTAMP '9999-01-01')) OVER (PARTITION BY queue ORDER BY message_id) AS done FROM messages)
    SELECT queue, time_bucket(INTERVAL '120 seconds', done) AS window_start, max(message_id) AS through, count(*) AS committed
    FROM marks WHERE done < TIMESTAMP '9999-01-01' GROUP BY ALL""",
)
def commit_prefixes(spark, sf_dir):
    marks = health.commit_prefixes(log(spark, sf_dir), "120 seconds")
    return eventtime.window_bounds(marks).drop("window_end")


@query(
    "redelivery_causes",
    f"""WITH {DELIVERY_LOG}, deliveries AS (SELECT queue, message_id, event_time FROM log WHERE kind = 'delivered'),
    rebinds AS (SELECT DISTINCT queue, event_time FROM log WHERE kind = 'rebind')
    SELECT d.queue, d.message_id, r.event_time AS rebind_at, count(*) AS attempts
    FROM deliveries d ASOF LEFT JOIN rebinds r ON d.queue = r.queue AND d.event_time >= r.event_time GROUP BY ALL""",
)
def redelivery_causes(spark, sf_dir):
    caused = health.redelivery_causes(log(spark, sf_dir))
    return caused.withColumn("rebind_at", tx.utc_time("rebind_at"))


START = "TIMESTAMP '2024-01-15 00:00:00'"


@query(
    "queue_watermarks",
    f"""WITH {DELIVERY_LOG} SELECT queue, count(*) FILTER (kind = 'acked') AS acked,
      max(event_time) FILTER (kind = 'acked') AS watermark FROM log GROUP BY queue""",
)
def queue_watermarks(spark, sf_dir):
    return eventtime.queue_watermarks(log(spark, sf_dir)).withColumn("watermark", tx.utc_time("watermark"))


@query(
    "overall_watermark",
    f"""WITH {DELIVERY_LOG}, marks AS (
      SELECT queue, greatest({START}, max(event_time) FILTER (kind = 'acked')) AS watermark FROM log GROUP BY queue)
    SELECT min(watermark) AS watermark FROM marks""",
)
def overall_watermark(spark, sf_dir):
    rows = log(spark, sf_dir)
    return eventtime.overall_watermark(rows, F.expr(START)).select(tx.utc_time("watermark").alias("watermark"))


@query(
    "commit_progress",
    f"""WITH {DELIVERY_LOG}, commits AS (
      SELECT queue, time_bucket(INTERVAL '120 seconds', event_time) AS window_start, count(*) AS acked, max(event_time) AS latest
      FROM log WHERE kind = 'acked' GROUP BY ALL)
    SELECT queue, window_start, acked,
      greatest({START}, max(latest) OVER (PARTITION BY queue ORDER BY window_start)) AS watermark FROM commits""",
)
def commit_progress(spark, sf_dir):
    progress = eventtime.commit_progress(log(spark, sf_dir), "120 seconds", F.expr(START))
    return eventtime.window_bounds(progress).drop("window_end").withColumn("watermark", tx.utc_time("watermark"))


# --- streams --------------------------------------------------------------------------------------

RECEIVED_ONCE = f"WITH {EVENT_MESSAGES} SELECT queue, message_id, redelivered, CAST(1 AS BIGINT) AS count FROM event_messages"


def _landed(messages: DataFrame, name: str) -> str:
    """The messages published to a landing folder; streams read it from there."""
    path = shared_folder(messages.sparkSession, name)
    landing.publish(messages, path)
    return path


def _landed_in_order(messages: DataFrame, name: str, use_sender_timestamp: bool = False) -> tuple[str, str]:
    """The messages published in order of event time, and the lateness that this order needs."""
    path = shared_folder(messages.sparkSession, name)
    return path, landing.publish_in_order(messages, path, eventtime.event_time(use_sender_timestamp))


def event_stream(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Text records of all event queues, a few files at a time."""
    path = path or _landed(events(spark, sf_dir), "landing")
    config = ReadConfig(ALL_QUEUES, max_files_per_trigger=landing.files_per_batch(spark, len(b.EVENT_QUEUES), path))
    return queues.read_queues(spark, path, config, mapper=lambda rows: mappers.text_record(rows, keep=("queue",)))


def _drained(df: DataFrame, name: str, start=jobs.start_job, close=None) -> str:
    """Runs the stream over all there is; the folder with its output."""
    spark = df.sparkSession
    path, checkpoint = shared_folder(spark, name), shared_folder(spark, f"{name}-checkpoint")
    jobs.drain_job(lambda trigger: start(df, path, checkpoint, trigger), close)
    return path


def document_stream(spark: SparkSession, sf_dir: str):
    """Documents as a stream of messages in order of their sending, the lateness for it, and what closes it."""
    messages = documents(spark, sf_dir)
    path, lateness = _landed_in_order(messages, "document-landing", use_sender_timestamp=True)
    schema = messages.schema
    most = landing.files_per_batch(spark, 20, path, schema)
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", most).parquet(path)
    return rows, lateness, lambda: landing.close_queues(spark, path, [b.IDLE_QUEUE], schema)


@query(
    "stream_word_count",
    f"""WITH {DOCUMENT_MESSAGES}, firsts AS (
      SELECT time_bucket(INTERVAL '4 seconds', {SENT_TIME}) AS window_start, text FROM document_messages
      QUALIFY row_number() OVER (PARTITION BY window_start, message_id ORDER BY receive_ts, redelivered, queue) = 1),
    words AS (SELECT window_start, {WORD_ROWS} FROM firsts)
    SELECT window_start, word, count(*) AS count FROM words WHERE word <> '' GROUP BY ALL""",
)
def stream_word_count(spark, sf_dir):
    """The flagship as a stream over several batches, drained until every window is written. Messages are remembered
    until their window closes; their words are counted then."""
    messages, lateness, close = document_stream(spark, sf_dir)
    firsts = flows.first_messages(messages, use_sender_timestamp=True, lateness=lateness)
    start = lambda df, *where: jobs.start_panes(df, *where, of=_counted_words)
    path = _drained(firsts, "stream-words", start, close)
    return spark.read.schema("window_start timestamp_ntz, word string, count long, pane int").parquet(path).drop("pane")


def _counted_words(messages: DataFrame) -> DataFrame:
    return eventtime.window_bounds(words.count_words(messages)).select("window_start", "word", "count")


@query("stream_window_files", FILE_LINES)
def stream_window_files(spark, sf_dir):
    source, lateness = _landed_in_order(events(spark, sf_dir), "landing", use_sender_timestamp=True)
    rows = event_stream(spark, sf_dir, source)
    lines = flows.word_count_lines(rows, FILE_WIDTH, use_sender_timestamp=True, lateness=lateness)
    close = lambda: landing.close_queues(spark, source, [b.IDLE_QUEUE])
    return _window_lines(spark, _drained(lines, "stream-window-files", jobs.start_window_files, close))


@query(
    "stream_dedup",
    f"WITH {EVENT_MESSAGES} SELECT DISTINCT queue, message_id, text FROM event_messages",
)
def stream_dedup(spark, sf_dir):
    source, lateness = _landed_in_order(events(spark, sf_dir), "landing")
    timed = eventtime.with_event_time(event_stream(spark, sf_dir, source), lateness=lateness)
    rows = dedup.distinct_across_windows(timed, ("queue", "message_id")).select("queue", "message_id", "text")
    return spark.read.schema("queue string, message_id long, text string").parquet(_drained(rows, "stream-dedup"))


@query(
    "stream_panes",
    f"WITH {EVENT_MESSAGES} SELECT queue, message_id, redelivered, text FROM event_messages",
)
def stream_panes(spark, sf_dir):
    rows = event_stream(spark, sf_dir).select("queue", "message_id", "redelivered", "text")
    path = _drained(rows, "stream-panes", jobs.start_panes)
    return spark.read.schema("queue string, message_id long, redelivered boolean, text string").parquet(f"{path}/pane=*")


def _trade_stream(spark: SparkSession, path: str, schema, in_parts: bool = False) -> DataFrame:
    """Messages of a landing folder of trades, as many files a micro-batch as keep all tasks busy; no state is kept.
    ``in_parts`` makes several micro-batches of a few files too, so that one to be done again is a part of the job."""
    most = landing.files_per_batch(spark, 2, path if in_parts else None, schema)
    config = ReadConfig([f"Q/{flag}" for flag in "ANR"], max_files_per_trigger=most)
    return queues.stream_queues(spark, path, config, schema=schema)


@query(
    "stream_trades",
    f"WITH {TRADE_MESSAGES} SELECT {QUOTE_COLUMNS} FROM trade_quotes WHERE {GOOD_QUOTES}",
)
def stream_trades(spark, sf_dir):
    messages = trades(spark, sf_dir)
    path = _landed(messages, "trade-landing")
    rows = _trade_stream(spark, path, messages.schema)
    return spark.read.schema(TRADE).parquet(_drained(trade_rows(rows), "stream-trades"))


@query(
    "stream_table_once",
    f"WITH {TRADE_MESSAGES} SELECT {QUOTE_COLUMNS} FROM trade_quotes WHERE {GOOD_QUOTES}",
)
def stream_table_once(spark, sf_dir):
    """Trade rows appended to a table by a job that is lost after it wrote its first batch and before that counts.
    Started again, it writes the batch once more; the table has it once."""
    messages = trades(spark, sf_dir)
    source, path, checkpoint = (shared_folder(spark, f"once-{part}") for part in ("landing", "table", "checkpoint"))
    landing.publish(messages, source)
    rows = trade_rows(_trade_stream(spark, source, messages.schema, in_parts=True))

    def lost(batch, batch_id):
        batch.write.parquet(f"{path}/data/job=trades/batch={batch_id}/attempt=lost")
        raise RuntimeError("lost before the batch was entered")

    try:
        jobs.start_batches(rows, lost, checkpoint, jobs.DRAIN).awaitTermination()
    except StreamingQueryException:
        jobs.drain_job(lambda trigger: ledger.start_ledger_job(rows, path, checkpoint, trigger, "trades"))
    return ledger.read_table(spark, path, TRADE)


@query("job_poll_interval", RECEIVED_ONCE)
def job_poll_interval(spark, sf_dir):
    """A live job that polls as often as its settings say, here four times a second, until all has come."""
    config = ReadConfig(ALL_QUEUES, poll_ms=250)
    source = _landed(events(spark, sf_dir), "poll-landing")
    path, checkpoint = shared_folder(spark, "poll"), shared_folder(spark, "poll-checkpoint")
    rows = queues.stream_queues(spark, source, config).select("queue", "message_id", "redelivered")
    query = jobs.start_job(rows, path, checkpoint, config.trigger)
    query.processAllAvailable()
    jobs.cancel_job(query)
    found = spark.read.schema("queue string, message_id long, redelivered boolean").parquet(path)
    return words.count_each(found, ("queue", "message_id", "redelivered"))


@query(
    "stream_rate_limited",
    f"""WITH {EVENT_MESSAGES} SELECT queue, count(*) AS messages, true AS in_three_batches_or_more
    FROM event_messages GROUP BY queue""",
)
def stream_rate_limited(spark, sf_dir):
    """One file a batch: all messages arrive, in as many batches as there are files."""
    source = _landed(events(spark, sf_dir), "landing")
    config = ReadConfig(b.EVENT_QUEUES, poll_ms=100, max_files_per_trigger=1)
    rows = queues.read_queues(spark, source, config, mapper=lambda df: mappers.text_record(df, keep=("queue",)))
    path = _drained(rows.select("queue", "message_id"), "stream-rated", jobs.start_panes)
    found = spark.read.schema("queue string, message_id long, pane int").parquet(path)
    batches = found.agg(F.countDistinct("pane") >= 3).scalar()
    return found.groupBy("queue").agg(F.count("*").alias("messages")).withColumn("in_three_batches_or_more", batches)


LATE_WIDTH, LATE_BY = "1 hour", "1 day"


@query(
    "stream_late_rows",
    f"""WITH {EVENT_MESSAGES}, timed AS (
      SELECT *, time_bucket(INTERVAL '{LATE_WIDTH}', receive_ts) AS window_start, event_id % 5 = 0 AS second FROM event_messages),
    mark AS (SELECT max(receive_ts) FILTER (NOT second) - INTERVAL '{LATE_BY}' AS watermark FROM timed)
    SELECT window_start, count(*) AS count FROM timed, mark
    WHERE NOT second OR window_start + INTERVAL '{LATE_WIDTH}' > watermark GROUP BY window_start""",
)
def stream_late_rows(spark, sf_dir):
    """A fifth of the messages comes after the others were read. Of it, what lies in windows that ended more than
    the allowed lateness before the latest message is dropped, by rule; the rest is counted."""
    messages = events(spark, sf_dir)
    second = F.col("message_id") % 5 == 0
    source = _landed(messages.where(~second), "late-landing")
    path, checkpoint = shared_folder(spark, "stream-late"), shared_folder(spark, "stream-late-checkpoint")

    def start(trigger):
        rows = queues.read_queues(spark, source, ReadConfig(ALL_QUEUES), mapper=lambda df: mappers.text_record(df, keep=("queue",)))
        counted = words.count_each(flows.windowed(rows, LATE_WIDTH, lateness=LATE_BY), ("window",))
        return jobs.start_job(eventtime.window_bounds(counted).drop("window_end"), path, checkpoint, trigger)

    jobs.drain_job(start)
    landing.publish(messages.where(second), source)
    jobs.drain_job(start, lambda: landing.close_queues(spark, source, [b.IDLE_QUEUE]))
    return spark.read.schema("window_start timestamp_ntz, count long").parquet(path)


OLD_WIDTH, NEW_WIDTH = "10 seconds", "30 seconds"


@query(
    "job_rewindow",
    f"""WITH {EVENT_MESSAGES}, mark AS (
      SELECT max(receive_ts) FILTER (receive_ts < {START}) - INTERVAL '{LATE_BY}' AS watermark FROM event_messages),
    timed AS (SELECT queue, time_bucket(INTERVAL '{OLD_WIDTH}', receive_ts) AS bucket FROM event_messages),
    placed AS (SELECT queue, bucket + INTERVAL '{OLD_WIDTH}' <= watermark AS written,
        CASE WHEN written THEN bucket ELSE time_bucket(INTERVAL '{NEW_WIDTH}', bucket) END AS window_start FROM timed, mark)
    SELECT queue, window_start,
      window_start + CASE WHEN written THEN INTERVAL '{OLD_WIDTH}' ELSE INTERVAL '{NEW_WIDTH}' END AS window_end,
      count(*) AS count FROM placed GROUP BY ALL""",
)
def job_rewindow(spark, sf_dir):
    """Messages per queue and window of 10 seconds, until the job is updated to 30: windows it has not written by
    then go on in the new ones."""
    messages, early = events(spark, sf_dir), F.col("receive_ts") < F.expr(START)
    source, folder = _landed(messages.where(early), "rewindow-landing"), shared_folder(spark, "hand-over")
    paths = [shared_folder(spark, f"rewindow-{part}") for part in ("old", "old-state", "new", "new-state")]
    config = ReadConfig(ALL_QUEUES)

    def counted_once(rows):
        return rows.select("queue", F.col("receive_ts").alias("event_time"), F.lit(1).cast("long").alias("n"))

    def start_old(trigger):
        rows = counted_once(queues.stream_queues(spark, source, config)).withWatermark("event_time", LATE_BY)
        totals = eventtime.window_bounds(rewindow.window_totals(rows, OLD_WIDTH))
        return jobs.start_job(totals, paths[0], paths[1], trigger)

    def start_new(trigger):
        rows = rewindow.handed_over(spark, source, config, folder, LATE_BY, counted_once)
        totals = eventtime.window_bounds(rewindow.window_totals(rows, NEW_WIDTH))
        return jobs.start_job(totals, paths[2], paths[3], trigger)

    def go_on():
        landing.publish(messages.where(~early), source)
        return start_new(jobs.DRAIN)

    query = start_old({"processingTime": "100 milliseconds"})
    query.processAllAvailable()
    rewindow.rewindow_job(spark, query, start_old, paths[1], folder, go_on).awaitTermination()
    landing.close_queues(spark, source, [b.IDLE_QUEUE])
    start_new(jobs.DRAIN).awaitTermination()
    schema = "window_start timestamp_ntz, window_end timestamp_ntz, queue string, count long"
    return spark.read.schema(schema).parquet(paths[0]).unionByName(spark.read.schema(schema).parquet(paths[2]))


# Up to when each queue's messages come in the first part.
FIRST_UNTIL = {"click": "2024-01-08", "error": "2024-01-12", "purchase": "2024-01-16", "signup": "2024-01-20", "view": "2024-01-24"}


@query(
    "stream_queue_marks",
    f"""WITH {EVENT_MESSAGES}, timed AS (
      SELECT *, time_bucket(INTERVAL '{LATE_WIDTH}', receive_ts) AS window_start, event_id % 5 <> 0 AND receive_ts <
        CASE event_type {" ".join(f"WHEN '{kind}' THEN TIMESTAMP '{until}'" for kind, until in FIRST_UNTIL.items())} END AS early
      FROM event_messages),
    marks AS (SELECT queue, max(receive_ts) FILTER (early) - INTERVAL '{LATE_BY}' AS before,
        max(receive_ts) - INTERVAL '{LATE_BY}' AS after FROM timed GROUP BY queue)
    SELECT queue, window_start, count(*) AS count FROM timed JOIN marks USING (queue)
    WHERE (early OR window_start + INTERVAL '{LATE_WIDTH}' > before) AND window_start + INTERVAL '{LATE_WIDTH}' <= after
    GROUP BY ALL""",
)
def stream_queue_marks(spark, sf_dir):
    """Queues that have got to different days, then the rest of all of them, some of it from before: late is what its
    own queue has passed by the allowed lateness."""
    messages = events(spark, sf_dir)
    until = F.create_map(*[F.lit(v) for kind, day in FIRST_UNTIL.items() for v in (f"Q/{kind}", f"{day} 00:00:00Z")])
    early = (F.col("message_id") % 5 != 0) & (F.col("receive_ts") < until[F.col("queue")].cast("timestamp"))
    source = _landed(messages.where(early), "marks-landing")
    path, checkpoint = shared_folder(spark, "stream-marks"), shared_folder(spark, "stream-marks-checkpoint")

    def start(trigger):
        rows = queues.stream_queues(spark, source, ReadConfig(ALL_QUEUES)).withColumn("event_time", F.col("receive_ts"))
        counted = keyed.counts_by_queue_mark(rows, timedelta(hours=1), timedelta(days=1), idle=timedelta(days=365))
        with keyed.rocksdb(spark):
            return jobs.start_job(eventtime.window_bounds(counted).drop("window_end"), path, checkpoint, trigger)

    jobs.drain_job(start)
    landing.publish(messages.where(~early), source)
    jobs.drain_job(start)
    return spark.read.schema("window_start timestamp_ntz, queue string, count long").parquet(path)


@query("stream_dedup_ranges", f"WITH {EVENT_MESSAGES} SELECT DISTINCT queue, message_id, text FROM event_messages")
def stream_dedup_ranges(spark, sf_dir):
    """As stream_dedup, over ids that all queues share, with ranges of ids as the state."""
    rows = event_stream(spark, sf_dir).select("queue", "message_id", "text")

    def start(df, path, checkpoint, trigger):
        with keyed.rocksdb(spark):
            return jobs.start_job(df, path, checkpoint, trigger)

    path = _drained(keyed.distinct_by_ranges(rows, (), "message_id", block=2048), "stream-ranges", start)
    return spark.read.schema("queue string, message_id long, text string").parquet(path)


def _two_part_job(spark: SparkSession, sf_dir: str, run) -> DataFrame:
    """Messages received by a job that ``run`` leads: it gets the start and what publishes the second half."""
    messages, even = events(spark, sf_dir), F.col("message_id") % 2 == 0
    source = _landed(messages.where(even), "job-landing")
    path, checkpoint = shared_folder(spark, "job"), shared_folder(spark, "job-checkpoint")
    run(
        lambda trigger: jobs.start_job(
            event_stream(spark, sf_dir, source).select("queue", "message_id", "redelivered"), path, checkpoint, trigger
        ),
        lambda: landing.publish(messages.where(~even), source),
    )
    rows = spark.read.schema("queue string, message_id long, redelivered boolean").parquet(path)
    return words.count_each(rows, ("queue", "message_id", "redelivered"))


@query("stream_restart", RECEIVED_ONCE)
def stream_restart(spark, sf_dir):
    """Ended, started again on its checkpoint, and once more with nothing new: every message came once."""

    def run(start, publish_rest):
        jobs.drain_job(start)
        publish_rest()
        jobs.drain_job(start)
        jobs.drain_job(start)

    return _two_part_job(spark, sf_dir, run)


@query("job_update", RECEIVED_ONCE)
def job_update(spark, sf_dir):
    """A running job goes on under another trigger; nothing is lost or repeated."""

    def run(start, publish_rest):
        query = start({"processingTime": "1 second"})
        query.processAllAvailable()
        publish_rest()
        query = jobs.update_job(query, start, {"processingTime": "100 milliseconds"})
        query.processAllAvailable()
        jobs.cancel_job(query)

    return _two_part_job(spark, sf_dir, run)


@query("job_cancel", f"{RECEIVED_ONCE} WHERE event_id % 2 = 0")
def job_cancel(spark, sf_dir):
    """What is published after a cancel stays unread."""

    def run(start, publish_rest):
        query = start({"processingTime": "100 milliseconds"})
        query.processAllAvailable()
        jobs.cancel_job(query)
        publish_rest()

    return _two_part_job(spark, sf_dir, run)


@query(
    "job_drain",
    """SELECT 'Q/' || event_type AS queue, count(*) AS published, count(*) AS received, CAST(0 AS BIGINT) AS "left",
      CAST(0 AS BIGINT) AS in_both, true AS conserved FROM events GROUP BY event_type""",
)
def job_drain(spark, sf_dir):
    """Drains all queues into files, then checks that every message published was received."""
    path = _drained(event_stream(spark, sf_dir).select("queue", "message_id", "text"), "drain")
    received = spark.read.schema("queue string, message_id long, text string").parquet(path)
    published = events(spark, sf_dir)
    return health.delivery_conservation(published, received, health.not_received(published, received))

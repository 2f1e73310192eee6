"""Column expressions on message text. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from msgstream.config import NAME_DASH, NAME_FIRST, NOT_FIRST, NOT_IN_NAMES

# What separates two words, a blank line, and the log prefix.
WORD_BREAK = r"[^\p{L}]+"
BLANK_LINE = r"\A[\x00-\x20]*\z"
LOG_PREFIX = "***"


def utf8(body) -> Column:
    """Bytes as text; malformed sequences become U+FFFD instead of failing the row."""
    return F.make_valid_utf8(F.col(body).cast("string") if isinstance(body, str) else body.cast("string"))


def split_words(text) -> Column:
    """Maximal runs of letters, case kept. The array may hold empty strings at its ends."""
    return F.split(text, WORD_BREAK, -1)


def is_blank(text) -> Column:
    """True when nothing is left after dropping characters up to U+0020 at both ends."""
    return F.rlike(text, F.lit(BLANK_LINE))


def utf16_length(text) -> Column:
    """Length in UTF-16 units: a character beyond the basic plane counts twice."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("long")


def format_count(word, count) -> Column:
    return F.concat(word, F.lit(": "), F.col(count).cast("string") if isinstance(count, str) else count.cast("string"))


def log_line(text) -> Column:
    return F.concat(F.lit(LOG_PREFIX), text)


def numbered_payload(queue, number) -> Column:
    number = F.col(number) if isinstance(number, str) else number
    return F.concat_ws(" - ", queue, number.cast("string"))


def normalized_name(name) -> Column:
    """Column form of :func:`msgstream.config.normalize_job_name`."""
    dashed = F.regexp_replace(name, NOT_IN_NAMES, NAME_DASH)
    return F.lower(F.regexp_replace(dashed, NOT_FIRST, NAME_FIRST))


def table_name(job_name) -> Column:
    return F.translate(job_name, "-", "_")


def object_path(url, scheme: str = "gs", on_bad: str = "error") -> Column:
    """``scheme://bucket/object`` as STRUCT<bucket, object>; both parts must be non-empty.

    A path that does not fit raises, or gives NULL with ``on_bad="null"``.
    """
    url = F.col(url) if isinstance(url, str) else url
    pattern = rf"^{scheme}://([^/]+)/(.+)$"
    parts = F.struct(
        F.regexp_extract(url, pattern, 1).alias("bucket"), F.regexp_extract(url, pattern, 2).alias("object")
    )
    found = F.when(url.rlike(pattern), parts)
    if on_bad == "null":
        return found
    return found.otherwise(F.raise_error(F.concat(F.lit("not a bucket and object path: "), F.coalesce(url, F.lit("null")))))


def from_utc(ts) -> Column:
    """The instant of a zone-free time that is in UTC, whatever the session's zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts).cast("timestamp")


def utc_time(ts) -> Column:
    """The instant as zone-free UTC time, whatever the session's zone; no two instants look alike."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.lit("1970-01-01").cast("timestamp_ntz"))


def window_label(start, end) -> Column:
    """``HH.mm-HH.mm`` in UTC. Not unique within a day for windows under a minute, nor across days."""
    return F.concat_ws("-", *[F.date_format(utc_time(c), "HH.mm") for c in (start, end)])


def window_file_name(prefix: str, start, end, shard, shards: int, suffix: str = "") -> Column:
    """``prefix-HH.mm-HH.mm-shard-of-shards`` and the suffix. As the label, it may name several windows."""
    shard = F.col(shard) if isinstance(shard, str) else shard
    tail = F.concat(shard.cast("string"), F.lit(f"-of-{shards}{suffix}"))
    return F.concat_ws("-", F.lit(prefix), window_label(start, end), tail)


def window_key(start, end) -> Column:
    """Label in UTC, unique to the window and safe in a path. Milliseconds show for windows that need them."""

    def stamp(column):
        ts = utc_time(column)
        whole = F.date_format(ts, "yyyyMMdd'T'HHmmss")
        return F.when(F.date_trunc("second", ts) == ts, whole).otherwise(F.date_format(ts, "yyyyMMdd'T'HHmmss.SSS"))

    return F.concat_ws("-", stamp(start), stamp(end))

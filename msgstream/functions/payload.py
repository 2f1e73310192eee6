"""Trade quotes: a JSON array of objects in the message text becomes one typed row per object."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgstream.schemas import TRADE_FIELDS

# Every value is first read as written, then cast by field, so that a value that does not fit its
# type can be told from one that is missing.
_AS_WRITTEN = "array<array<struct<" + ",".join(f"`{name}`:string" for name in TRADE_FIELDS) + ">>>"

# How a date is written, and how a value begins that is not a plain one.
DATE = r"\A\d{4}-\d{2}-\d{2}\z"
NESTED = r"\A\s*[\[{]"
# How a payload of lists ends.
LIST_END = r"\][ \t\r\n]*\z"

NO_LIST = "not a list of quotes"


# Numbers of one kind are cast together, as an array: compiled code then holds one loop and not a cast for each field.
_TOGETHER = {kind: [name for name, of in TRADE_FIELDS.items() if of == kind] for kind in ("int", "float")}


def _with_types(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds each field as its type to rows of quotes, once, in columns of its kind; NULL for what does not fit.

    They come out of a generator of one row, so that neither a filter nor a projection over them repeats the casts.
    It is an outer one, as is the one that makes rows of quotes: for others Spark adds a filter on the size of the
    list and makes the list once more for it. Code stays below the size up to which Java compiles a method.
    """
    typed = []
    for name, kind in TRADE_FIELDS.items():
        value = F.col(raw)[name]
        if kind == "date":
            typed.append(F.when(value.rlike(DATE), value.try_cast("date")).alias(f"_{name}"))
        elif kind == "string":
            typed.append(F.when(~value.rlike(NESTED), value).alias(f"_{name}"))
    for kind, names in _TOGETHER.items():
        typed.append(F.array(*[F.col(raw)[name] for name in names]).try_cast(f"array<{kind}>").alias(f"_{kind}"))
    return rows.select("*", F.inline_outer(F.array(F.struct(*typed))))


def _value(name: str) -> Column:
    """The value as its type, NULL where it is none: dates are ``yyyy-MM-dd``, numbers finite, text not nested.

    Numbers may stand in quotes. Text that begins with a bracket cannot be told from a nested value. Of numbers
    that are not finite only :func:`_misfit` knows.
    """
    kind = TRADE_FIELDS[name]
    value = F.col(f"_{kind}")[_TOGETHER[kind].index(name)] if kind in _TOGETHER else F.col(f"_{name}")
    return value.cast("double") if kind == "float" else value


def _misfit(name: str, raw: str = "raw") -> Column:
    none = ~F.coalesce(F.abs(_value(name)) < float("inf"), F.lit(False)) if TRADE_FIELDS[name] == "float" else _value(name).isNull()
    return F.col(raw)[name].isNotNull() & none


def _quotes(text: str) -> Column:
    """The quotes of a payload, as written; NULL unless all of it is a list of quotes, or one alone.

    The JSON reader stops after the first value and would pass over what follows. So the payload is
    read as part of a list that goes on with an empty one: only if that comes last was all of it read.
    A payload cut short ends otherwise than a list does. It is not read at all: an error costs the reader more
    than a whole payload does.
    """
    listed = F.col(text).endswith("]") | F.col(text).rlike(LIST_END)
    payload = F.when(F.ltrim(text).startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).when(listed, F.col(text))
    return F.from_json(F.concat(F.lit("["), payload, F.lit(",[]]")), _AS_WRITTEN)


def _parsed(df: DataFrame, text: str, keep) -> DataFrame:
    """``keep``, ``text`` and ``quotes``, as written; NULL for a payload that is no list of quotes."""
    parsed = df.select(*keep, text, _quotes(text).alias("lists"))
    whole = (F.size("lists") > 1) & (F.size(F.try_element_at("lists", F.lit(-1))) == 0)
    return parsed.select(*keep, text, F.when(whole, F.flatten("lists")).alias("quotes"))


def trade_rows(df: DataFrame, text: str = "text", keep=()) -> DataFrame:
    """One row per quote; a field left out is NULL. Quotes that do not parse are in :func:`trade_quarantine`.

    Quotes become rows as they are written and are typed then, so that compiled code does it.
    """
    rows = _with_types(_parsed(df, text, keep).select(*keep, F.explode_outer("quotes").alias("raw")))
    fits = rows.where(F.col("raw").isNotNull() & ~reduce(Column.__or__, map(_misfit, TRADE_FIELDS)))
    return fits.select(*keep, *[_value(name).alias(name) for name in TRADE_FIELDS])


def trade_quarantine(df: DataFrame, text: str = "text", keep=("queue", "message_id")) -> DataFrame:
    """What did not parse: ``keep``, ``quote_no``, ``reason``, ``value``.

    A quote with values of the wrong type is told by its place in the payload, the fields and their values;
    a payload that is no list of quotes by its text, once; a NULL in a list by its place. Quotes that fit are
    dropped where they become rows, before anything else of the message is copied.
    """
    keep = [c for c in keep if c != text]
    parsed = _parsed(df, text, keep)
    listed = F.col("quotes").isNotNull()
    rows = parsed.select(*keep, text, listed.alias("_listed"), F.posexplode_outer("quotes").alias("_at", "raw"))
    rows = rows.where(F.col("_at").isNotNull() | ~F.col("_listed"))
    raw = F.col("raw")
    misfits = F.array(*[F.when(_misfit(n), F.struct(F.lit(n).alias("name"), raw[n].alias("value"))) for n in TRADE_FIELDS])
    told = _with_types(rows).select(*keep, text, "_listed", "_at", "raw", F.inline_outer(F.array(F.struct(misfits.alias("_misfits")))))
    wrong, values = (F.concat_ws(",", F.col("_misfits")[part]) for part in ("name", "value"))
    bad = told.where(raw.isNull() | (wrong != ""))
    return bad.select(
        *keep,
        F.when(F.col("_listed"), F.col("_at")).alias("quote_no"),
        F.when(raw.isNull(), F.lit(NO_LIST)).otherwise(F.concat(F.lit("wrong type: "), wrong)).alias("reason"),
        F.when(~F.col("_listed"), F.col(text)).when(raw.isNotNull(), values).alias("value"),
    )

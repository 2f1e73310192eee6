"""Protobuf bodies holding one required string, ``Test { required string test = 1 }``, as SQL expressions.

A body is a sequence of fields: a varint of field number and wire type, then a varint, eight bytes, four bytes,
or a varint length and as many bytes. The string is field 1 of the last kind; other fields are passed over.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from msgstream.functions.text import utf8

# The mark before the string, wire types, and the most bytes of a varint.
STRING_MARK = "0A"
VARINT, EIGHT_BYTES, SIZED, FOUR_BYTES = 0, 1, 2, 5
LONGEST_VARINT = 10


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """The expression of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _varint(number: Column) -> Column:
    """A number below 2 ** 35 as bytes, seven bits each, low ones first; all but the last have the high bit set."""
    pieces = []
    for i in range(5):
        rest = F.shiftright(number, 7 * i)
        byte = rest.bitwiseAND(127) + F.when(rest > 127, 128).otherwise(0)
        pieces.append(F.when((rest > 0) | F.lit(i == 0), F.lpad(F.hex(byte), 2, "0")).otherwise(""))
    return F.unhex(F.concat(*pieces))


def _byte(body: Column, at: Column) -> Column:
    """The byte at a place counted from 0; NULL beyond the end."""
    return F.when(at < F.octet_length(body), F.conv(F.hex(F.substr(body, (at + 1).cast("int"), F.lit(1))), 16, 10).cast("long"))


def _read_varint(body: Column, at: Column) -> Column:
    """STRUCT<value, after> of the varint at a place; NULL if it does not end."""

    def read(start: Column) -> Column:
        found, value = F.lit(None).cast("struct<value:bigint,after:bigint>"), _long(0)
        ends = []
        for i in range(LONGEST_VARINT):
            byte = _byte(body, start + i)
            value = value + F.shiftleft(byte.bitwiseAND(127), 7 * i)
            ends.append((byte < 128, F.struct(value.alias("value"), (start + i + 1).alias("after"))))
        for end, result in reversed(ends):
            found = F.when(end, result).otherwise(found)
        return found

    return _let(at, read)


def encode_test(text) -> Column:
    """Text to message bytes. NULL text gives NULL, as a required field cannot be absent."""
    body = F.encode(F.col(text) if isinstance(text, str) else text, "UTF-8")
    return F.concat(F.unhex(F.lit(STRING_MARK)), _varint(F.octet_length(body).cast("long")), body)


def _fields(body: Column) -> Column:
    """The string of a body of any fields; NULL if it does not parse or has none. One step a field."""
    size = F.octet_length(body).cast("long")
    start = F.struct(_long(0).alias("at"), F.lit(None).cast("binary").alias("found"), F.lit(False).alias("bad"))

    def moved(state: Column, tag: Column, inner: Column) -> Column:
        wire, number = tag["value"].bitwiseAND(7), F.shiftright(tag["value"], 3)
        after = (
            F.when(wire == VARINT, inner["after"])
            .when(wire == EIGHT_BYTES, tag["after"] + 8)
            .when(wire == FOUR_BYTES, tag["after"] + 4)
            .when((wire == SIZED) & (inner["value"] >= 0), inner["after"] + inner["value"])
        )

        def to(end: Column) -> Column:
            bad = end.isNull() | (end > size) | (number == 0)
            string = F.substr(body, (inner["after"] + 1).cast("int"), inner["value"].cast("int"))
            found = F.when(~bad & (number == 1) & (wire == SIZED), string).otherwise(state["found"])
            return F.struct(F.coalesce(end, size).alias("at"), found.alias("found"), bad.alias("bad"))

        return _let(after, to)

    def step(state: Column, _: Column) -> Column:
        following = _let(
            _read_varint(body, state["at"]),
            lambda tag: _let(_read_varint(body, tag["after"]), lambda inner: moved(state, tag, inner)),
        )
        return F.when(state["bad"] | (state["at"] >= size), state).otherwise(following)

    # A field has two bytes at least.
    steps = F.sequence(_long(0), F.call_function("div", size, F.lit(2)))
    return F.aggregate(steps, start, step, lambda state: F.when(~state["bad"], state["found"]))


def decode_test(body, on_bad: str = "error") -> Column:
    """Message bytes to STRUCT<test>. A body that does not parse, or lacks the field, fails the
    query, or gives NULL with ``on_bad="null"``. One that is just the string is cut without a loop."""
    body = F.col(body) if isinstance(body, str) else body

    def cut(size: Column) -> Column:
        plain = (F.hex(F.substr(body, F.lit(1), F.lit(1))) == STRING_MARK) & (
            size["after"] + size["value"] == F.octet_length(body)
        )
        rest = F.substr(body, (size["after"] + 1).cast("int"), size["value"].cast("int"))
        return F.when(F.coalesce(plain, F.lit(False)), rest).otherwise(_fields(body))

    def result(found: Column) -> Column:
        read = F.when(found.isNotNull(), F.struct(utf8(found).alias("test")))
        if on_bad == "null":
            return read
        complaint = F.raise_error(F.lit("protobuf body does not parse or lacks its required field"))
        return F.when(body.isNull() | found.isNotNull(), read).otherwise(complaint)

    return _let(_let(_read_varint(body, _long(1)), cut), result)

"""Payloads a cut-and-split reading would get wrong."""

import datetime

import pytest

from msgstream.functions.payload import trade_quarantine, trade_rows
from msgstream.schemas import TRADE, TRADE_FIELDS

SAMPLE = (
    '[{"date":"2021-11-30","sym":"QQZ","time":"07:05","lowAskSize":3,"highAskSize":31,"lowBidPrice":10.1,'
    '"highBidPrice":12.25,"lowBidSize":4,"highBidSize":41,"lowTradePrice":10.5,"highTradePrice":12.75,'
    '"lowTradeSize":1,"highTradeSize":77,"lowAskPrice":11.0,"highAskPrice":13.5,"vwap":11.75}]'
)


def frame(spark, *texts):
    return spark.createDataFrame([("q", i, t) for i, t in enumerate(texts)], "queue string, message_id long, text string")


def good(spark, *texts):
    return [r.asDict() for r in trade_rows(frame(spark, *texts)).collect()]


def bad(spark, *texts):
    return [(r.message_id, r.quote_no, r.reason) for r in trade_quarantine(frame(spark, *texts)).collect()]


def test_sample(spark):
    df = trade_rows(frame(spark, SAMPLE))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in TRADE]
    row = df.first()
    assert row.date == datetime.date(2021, 11, 30) and row.sym == "QQZ"
    assert row.time == "07:05"
    assert row.highTradeSize == 77 and row.vwap == 11.75
    assert bad(spark, SAMPLE) == []


def test_prices_have_single_precision(spark):
    import struct

    row = good(spark, SAMPLE)[0]
    assert row["lowBidPrice"] == struct.unpack("f", struct.pack("f", 10.1))[0]


def test_each_object_is_a_row(spark):
    assert [r["sym"] for r in good(spark, '[{"sym":"A"},{"sym":"B"},{"sym":"C"}]')] == ["A", "B", "C"]


def test_single_object(spark):
    assert [r["sym"] for r in good(spark, '{"sym":"A"}')] == ["A"]


def test_comma_colon_and_brackets_inside_a_value(spark):
    assert good(spark, '[{"sym":"A,B:{C}[D]"}]')[0]["sym"] == "A,B:{C}[D]"


def test_blanks_after_colon(spark):
    assert good(spark, '[ { "lowAskSize" : 20 , "sym" : "A" } ]')[0]["lowAskSize"] == 20


def test_lists_side_by_side_are_all_read(spark):
    assert [r["sym"] for r in good(spark, '[{"sym":"A"}],[{"sym":"B"}]')] == ["A", "B"]
    assert [r["sym"] for r in good(spark, ' {"sym":"A"},{"sym":"B"}')] == ["A", "B"]


def test_null_in_a_list(spark):
    assert [r["sym"] for r in good(spark, '[null,{"sym":"A"}]')] == ["A"]
    assert bad(spark, '[null,{"sym":"A"}]') == [(0, 0, "not a list of quotes")]


def test_missing_fields_are_null(spark):
    row = good(spark, '[{"sym":"A"}]')[0]
    assert set(row) == set(TRADE_FIELDS) and all(v is None for k, v in row.items() if k != "sym")


def test_no_quotes_no_rows(spark):
    assert good(spark, "[]") == [] and bad(spark, "[]") == []


@pytest.mark.parametrize(
    "text",
    [
        "not json", "", '[{"sym":"A"},{"sym":', None, "17", "null", "[17]", '[{"sym":"A"},17]', '[[{"sym":"A"}]]',
        '{"sym":"A"} tail', '{"sym":"A"}\n{"sym":"B"}', '[{"sym":"A"}] [{"sym":"B"}]', '[{"sym":"A"}]] x', "[]] x", "[] x",
    ],
)
def test_not_quotes(spark, text):
    assert good(spark, text) == []
    assert [b[2] for b in bad(spark, text)] == ["not a list of quotes"]


def test_lists_that_do_not_end_the_payload(spark):
    """What ends otherwise than a list does is not read, so an empty list before the rest does not pass for its end."""
    assert good(spark, '[{"sym":"A"}],[]] x') == [] and bad(spark, '[{"sym":"A"}],[]] x') == [(0, None, "not a list of quotes")]
    assert [r["sym"] for r in good(spark, '[{"sym":"A"}] \r\n\t')] == ["A"]


@pytest.mark.parametrize(
    "value, field",
    [('"many"', "lowAskSize"), ("20.5", "lowAskSize"), ("99999999999", "lowAskSize"), ('"x"', "vwap"), ('"06/06/2020"', "date"),
     ('"2020"', "date"), ('"2020-06-06T25:99"', "date"), ('"2020-02-30"', "date"), ('"2020-6-6"', "date"),
     ('"NaN"', "vwap"), ('"Infinity"', "vwap"), ("1e60", "vwap"), ('{"s":1}', "sym"), ("[1]", "time")],
)
def test_wrong_types_are_quarantined_with_the_field(spark, value, field):
    text = f'[{{"sym":"A"}},{{"sym":"B","{field}":{value}}}]'
    assert [r["sym"] for r in good(spark, text)] == ["A"]
    assert bad(spark, text) == [(0, 1, f"wrong type: {field}")]


def test_the_bad_values_are_told_and_texts_once(spark):
    rows = trade_quarantine(frame(spark, '[{"vwap":"x","date":"y"},{"vwap":"NaN"},{"sym":"A"}]', "junk")).collect()
    assert [(r.message_id, r.quote_no, r.value) for r in rows] == [(0, 0, "y,x"), (0, 1, "NaN"), (1, None, "junk")]


def test_numbers_may_stand_in_quotes(spark):
    assert good(spark, '[{"vwap":"1.5","lowAskSize":"7"}]')[0]["vwap"] == 1.5


def test_several_wrong_fields(spark):
    assert bad(spark, '[{"vwap":"x","date":"y"}]') == [(0, 0, "wrong type: date,vwap")]


def test_every_quote_goes_one_way(spark):
    texts = [SAMPLE, "junk", '[{"vwap":"x"},{"vwap":1}]']
    assert len(good(spark, *texts)) == 2 and len(bad(spark, *texts)) == 2

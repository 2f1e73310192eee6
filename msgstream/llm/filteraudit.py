"""How the filters of a cleaning step act on each other: all orders at once, by packed counters."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgstream.llm.common import digest

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in permutations(FILTERS)]
# A field is as wide as a count of rows can get, so sums never run over into the next one.
FIELD_BYTES = 8

# The characters whose presence filter D rejects, and the capital letters that C counts.
SYMBOLS, CAPITALS = b"#$%&*|", bytes(range(ord("A"), ord("Z") + 1))
CONTINUATION = bytes(range(0x80, 0xC0))

AUDIT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def text_failures(text: bytes) -> int:
    """Which of A to D a UTF-8 text fails, one bit each, A lowest.

    ``split`` without arguments parts bytes at exactly the six characters that end words.
    """
    words = text.split()
    points = len(text) - (0 if text.isascii() else len(text) - len(text.translate(None, CONTINUATION)))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    fails = (
        len(words) < 50,
        100 * len(set(words)) < 65 * len(words),
        100 * capitals > 5 * points,
        len(text.translate(None, SYMBOLS)) < len(text),
    )
    return sum(failed << bit for bit, failed in enumerate(fails))


def packed(mask: int) -> int:
    """What happens to a row that fails the filters in ``mask``, as one integer of 64-bit fields.

    One field for each order and step: 1 where that step removes the row. Then one for each filter that the row
    fails, one for each filter that it alone fails, and one that counts the row.
    """
    removed = [0] * (len(ORDERS) * len(FILTERS))
    failing = [bit for bit in range(len(FILTERS)) if mask >> bit & 1]
    if failing:
        for number, order in enumerate(ORDERS):
            removed[number * len(FILTERS) + min(order.index(FILTERS[bit]) for bit in failing)] = 1
    fails = [mask >> bit & 1 for bit in range(len(FILTERS))]
    alone = [int(mask == 1 << bit) for bit in range(len(FILTERS))]
    fields = [*removed, *fails, *alone, 1]
    return sum(value << 8 * FIELD_BYTES * at for at, value in enumerate(fields))


def unpacked(total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Removed by order and step, failing by filter, failing that filter alone, and rows, of a sum of packed integers."""
    steps = len(ORDERS) * len(FILTERS)
    fields = steps + 2 * len(FILTERS) + 1
    counts = np.frombuffer(total.to_bytes(fields * FIELD_BYTES, "little"), "<i8")
    fails, alone = counts[steps:-1].reshape(2, -1)
    return counts[:steps].reshape(len(ORDERS), -1), fails, alone, int(counts[-1])


def failures(docs: DataFrame) -> DataFrame:
    """``doc_id, part, mask, hi, lo, n``: the failures in A to D of each row's text, the text's digest, and how many
    rows are the same in all of these."""
    rows = docs.selectExpr(
        "cast(doc_id AS long) AS doc_id", "coalesce(source, '') AS part", "encode(coalesce(text, ''), 'UTF-8') AS body"
    )
    rows = rows.select("doc_id", "part", "body", digest(F.col("body")).alias("key")).select("doc_id", "part", "key.*", "body")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = [text_failures(body.as_buffer().to_pybytes()) for body in batch.column("body")]
            columns = [batch.column(name) for name in ("doc_id", "part", "hi", "lo")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(masks, pa.int32())], ["doc_id", "part", "hi", "lo", "mask"])

    judged = rows.mapInArrow(judge, "doc_id long, part string, hi long, lo long, mask int")
    return judged.groupBy("doc_id", "part", "hi", "lo", "mask").agg(F.count("*").alias("n"))


def _with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds ``good`` and ``toxic``. Rows without an id have no label and are dealt out by their digest."""
    known = (
        labels.selectExpr("cast(doc_id AS long) AS doc_id", "quality = 1 AS good", "toxic = 1 AS toxic")
        .where("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
        .withColumn("deal", F.lit(0).cast("long"))
    )
    dealt = rows.withColumn("deal", F.when(F.col("doc_id").isNull(), F.col("hi")).otherwise(0))
    joined = dealt.join(known, ["doc_id", "deal"], "left").drop("deal")
    return joined.withColumns({name: F.coalesce(name, F.lit(False)) for name in ("good", "toxic")})


def _with_copies(rows: DataFrame) -> DataFrame:
    """Adds bit E: the text stands under a smaller id.

    The least id of a text is found by an aggregate, and only its own rows are joined to it, by text and id; so
    the copies of a frequent text stay apart.
    """
    least = rows.groupBy("hi", "lo").agg(F.min("doc_id").alias("doc_id")).where("doc_id IS NOT NULL")
    dealt = rows.withColumn("deal", F.when(F.col("doc_id").isNull(), F.xxhash64("part")).otherwise(0))
    least = least.withColumns({"first": F.lit(True), "deal": F.lit(0).cast("long")})
    joined = dealt.join(least, ["hi", "lo", "doc_id", "deal"], "left").drop("deal")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return joined.withColumn("mask", F.col("mask") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0)).drop("first")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step: kept after it, removed by it, failing but removed before it
    (``redundant``), failing no other filter (``unique_fails``), labelled good or toxic among the removed, and the
    filter's removals over all orders (``shapley``).

    A part is a source. Filters reject texts of under 50 words (A), of which less than 65 % are distinct (B), with
    more than 5 % capitals A to Z (C), with one of six symbols (D), or that stand under a smaller id anywhere (E).

    Rows are counted by part, mask and labels first, combined before the shuffle, so a part costs 128 rows at most
    however large it is. Each mask stands for one integer with a field for each of the 600 outcomes
    (:func:`packed`); times its count it is added to its part's three sums, over all rows, good ones and toxic
    ones. Everything reported is read from these.

    NULL text counts as empty, a NULL source as the part of empty name. A row without an id has no label and is
    neither copy nor original. Rows of one id and text are no copies of each other. Of several labels of an id any
    1 counts. An empty table gives no rows. Other columns are not read; texts of any length are taken whole.
    """
    rows = _with_copies(_with_labels(failures(docs), labels))
    counts = rows.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
    of_mask = [packed(mask) for mask in range(1 << len(FILTERS))]

    def totals(table: pa.Table) -> pa.Table:
        everything = good = toxic = 0
        for row in table.to_pylist():
            grown = row["n"] * of_mask[row["mask"]]
            everything += grown
            good += grown if row["good"] else 0
            toxic += grown if row["toxic"] else 0
        removed, fails, alone, n = unpacked(everything)
        good_lost, toxic_lost = unpacked(good)[0], unpacked(toxic)[0]
        at = np.array([[FILTERS.index(letter) for letter in order] for order in ORDERS])
        shapley = np.array([int(removed[at == bit].sum()) for bit in range(len(FILTERS))])
        size = at.size
        columns = {
            "part": pa.repeat(table.column("part")[0].as_py(), size),
            "filter_order": pa.array(np.repeat(ORDERS, len(FILTERS))),
            "step": pa.array(np.tile(np.arange(1, len(FILTERS) + 1, dtype="i4"), len(ORDERS))),
            "kept": n - np.cumsum(removed, axis=1),
            "removed": removed,
            "redundant": fails[at] - removed,
            "unique_fails": alone[at],
            "good_lost": good_lost,
            "toxic_lost": toxic_lost,
            "shapley": shapley[at],
        }
        return pa.table({k: v.ravel() if isinstance(v, np.ndarray) else v for k, v in columns.items()})

    return counts.groupBy("part").applyInArrow(totals, AUDIT)

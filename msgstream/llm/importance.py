"""Drawing documents that look like a target set: hashed features, importance weights, ranks by a radix sort."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgstream.scratch import stored

# Bytes that belong to no word: all ASCII but digits and letters. Capitals A to Z count as small letters.
_SEEN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
# Words whose bucket a worker remembers.
KEPT_WORDS = 400_000

# A pass of the sort looks at so many bits of a key, over blocks of so many rows.
DIGIT_BITS, BLOCK_BITS = 11, 16


class Buckets(dict):
    """The bucket of each feature."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        bucket = zlib.crc32(feature) % self.buckets
        if len(self) < KEPT_WORDS:
            self[feature] = bucket
        return bucket


def features(text: bytes, longest: int) -> list[bytes]:
    """All runs of 1 to ``longest`` words, joined by one space, and how many of them are single words first."""
    words = text.translate(_SEEN).split()
    runs = list(words)
    for n in range(2, longest + 1):
        runs += [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    return runs


def bucket_counts(texts: DataFrame, buckets: int = 10_000, longest: int = 1, column: str = "text") -> np.ndarray:
    """How often features fall in each bucket, over all rows. A task sends one row per bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, totals = Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for body in batch.column(0):
                found = features(body.as_buffer().to_pybytes(), longest)
                totals += np.bincount(np.fromiter(map(of.__getitem__, found), np.int64, len(found)), minlength=buckets)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], ["bucket", "n"])

    bodies = texts.where(F.col(column).isNotNull()).select(F.encode(F.col(column), "UTF-8").alias("body"))
    counted = bodies.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    result = np.zeros(buckets, np.int64)
    for row in counted.collect():  # one row per bucket
        result[row.bucket] = row.n
    return result


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of how much likelier each bucket is in the target set, one added to each count."""
    n, raw_total, target_total = len(raw), float(raw.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (raw_total + n) / ((s + 1.0) * (target_total + n))))
            for s, t in zip(raw.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def noise(doc_id: int | None, seed: int) -> int:
    """Thousandths of a Gumbel draw fixed by seed and id, so that the highest sums are a draw by weight."""
    h = int(hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(
    docs: DataFrame, gain: np.ndarray, longest: int = 1, least_words: int = 20, seed: int = 2024
) -> DataFrame:
    """``doc_id, n_features, weight, score, eligible`` of every row; the weight is the floored mean gain of its features."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Buckets(len(gain))
        for batch in batches:
            sizes, words, sums = [], [], []
            for body in batch.column("body"):
                text = body.as_buffer().to_pybytes()
                found = features(text, longest)
                sizes.append(len(found))
                words.append(len(found) if longest == 1 else len(text.translate(_SEEN).split()))
                sums.append(int(gain[np.fromiter(map(of.__getitem__, found), np.int64, len(found))].sum()))
            n = np.array(sizes, np.int64)
            weight = np.floor_divide(np.array(sums, np.int64), np.maximum(n, 1))
            drawn = weight + np.array([noise(i, seed) for i in batch.column("doc_id").to_pylist()], np.int64)
            columns = [pa.array(n), pa.array(weight), pa.array(drawn), pa.array(np.array(words) >= least_words)]
            names = ["doc_id", "n_features", "weight", "score", "eligible"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    rows = docs.selectExpr("cast(doc_id AS long) AS doc_id", "encode(coalesce(text, ''), 'UTF-8') AS body")
    return rows.mapInArrow(score, "doc_id long, n_features long, weight long, score long, eligible boolean")


# --- distributed radix sort -------------------------------------------------------------------------


def _digit(key: str, shift: int) -> Column:
    return F.shiftrightunsigned(F.col(key), shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))


def _block() -> Column:
    return F.shiftright(F.col("_at"), BLOCK_BITS)


def _counting_pass(rows: DataFrame, key: str, shift: int) -> DataFrame:
    """One stable pass: rows are placed by one digit of a key, those of equal digits as they stood.

    Rows of each block are counted by digit. A row's place is the number of rows of smaller digits, of its digit
    in earlier blocks, and of its digit before it in its own block. The first is a sum over at most 2,048 rows, the
    second a running sum over blocks, not rows. A block has 65,536 places whatever the keys, so no task holds more.
    """
    digit = _digit(key, shift)
    counts = rows.groupBy(_block().alias("block"), digit.alias("digit")).agg(F.count("*").alias("n"))
    totals = counts.groupBy("digit").agg(F.sum("n").alias("n"))
    smaller = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("digit", F.coalesce(F.sum("n").over(smaller), F.lit(0)).alias("start"))
    earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("block", "digit", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    offsets = offsets.join(F.broadcast(starts), "digit").select("block", "digit", (F.col("before") + F.col("start")).alias("to"))

    names = rows.columns

    def place(block: pa.Table, to: pa.Table) -> pa.Table:
        block = block.take(pa.array(np.argsort(block.column("_at").to_numpy(), kind="stable")))
        digits = block.column("_digit").to_numpy()
        order = np.argsort(digits, kind="stable")
        ordered = digits[order]
        first = np.searchsorted(ordered, ordered)
        start = np.zeros(1 << DIGIT_BITS, np.int64)
        start[to.column("digit").to_numpy()] = to.column("to").to_numpy()
        at = np.empty(len(order), np.int64)
        at[order] = start[ordered] + np.arange(len(order)) - first
        return block.set_column(block.column_names.index("_at"), "_at", pa.array(at)).select(names)

    keyed = rows.withColumns({"_digit": digit, "_block": _block()})
    return keyed.groupBy("_block").cogroup(offsets.groupBy("block")).applyInArrow(place, rows.schema)


def radix_sorted(rows: DataFrame, keys: list[str], descending: Iterable[str] = ()) -> DataFrame:
    """``rows`` with ``_at``, their place from 0 in the order of integer columns, the first of ``keys`` leading.

    A least-significant-digit radix sort: stable counting passes over the digits of the composite key, from the
    last digit of the last key to the first of the first, as many as the spans of the keys ask for; NULLs come
    last. Between passes rows are written to the shared folder, so a pass that loses an executor starts from
    written rows. Rows equal in all keys stay as they were read. ``rows`` must be the same each time they are read.
    """
    bounds = rows.agg(
        *[f(k).alias(f"{name}_{k}") for k in keys for name, f in (("least", F.min), ("most", F.max))],
        *[F.count_if(F.col(k).isNull()).alias(f"none_{k}") for k in keys],
    ).first()
    passes, relative = [], {"_at": F.monotonically_increasing_id()}
    for number, key in reversed(list(enumerate(keys))):
        least, most = bounds[f"least_{key}"], bounds[f"most_{key}"]
        if least is not None and least < most:
            # Differences may pass 63 bits; they wrap, and are read as unsigned.
            low, high = F.lit(least), F.lit(most)
            base = (high, F.col(key)) if key in descending else (F.col(key), low)
            relative[f"_key{number}"] = F.coalesce(_wrapped(*base), F.lit(0))
            passes += [(f"_key{number}", shift) for shift in range(0, (most - least).bit_length(), DIGIT_BITS)]
        if bounds[f"none_{key}"] and least is not None:
            relative[f"_none{number}"] = F.col(key).isNull().cast("long")
            passes.append((f"_none{number}", 0))
    placed = stored(rows.withColumns(relative), "radix")
    for key, shift in passes:
        placed = stored(_counting_pass(placed, key, shift), "radix")
    if not passes:  # all keys equal: places need only be without gaps
        placed = _counting_pass(placed.withColumn("_same", F.lit(0).cast("long")), "_same", 0)
    return placed.select(*rows.columns, "_at")


def _wrapped(a: Column, b: Column) -> Column:
    """a - b modulo 2^64, without an overflow error: halves apart."""
    low = F.lit(0xFFFFFFFF)
    under = a.bitwiseAND(low) - b.bitwiseAND(low)
    over = F.shiftright(a, 32) - F.shiftright(b, 32) + F.shiftright(under, 32)
    return F.shiftleft(over, 32).bitwiseOR(under.bitwiseAND(low))


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = 10, buckets: int = 10_000, longest: int = 1,
    least_words: int = 20, seed: int = 2024,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document; the rank of the drawn, NULL of the others.

    Features are runs of 1 to ``longest`` words, hashed to ``buckets``. All documents and all target texts are
    counted; the counts, and so what tasks are sent, are as long as there are buckets. Of the documents of
    ``least_words`` words or more, ``percent`` in a hundred are drawn: those of the highest scores, ties to the
    smaller id, ranked by :func:`radix_sorted`.

    NULL text has no words: weight 0. A NULL ``doc_id`` draws the noise of "null" and comes last among ties.
    Repeated rows are drawn one by one. Rows equal in score and id rank as they were read. Empty tables give no rows;
    an empty target gives the gains of its smoothing. Other columns are not read.
    """
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    rows = stored(scored(docs, gain, longest, least_words, seed), "scored")
    eligible = rows.where("eligible")
    wanted = eligible.count() * percent // 100
    ranked = radix_sorted(eligible, ["score", "doc_id"], descending=["score"])
    rank = F.when(F.col("_at") < wanted, F.col("_at") + 1).alias("rank")
    names = ["doc_id", "n_features", "weight", "score"]
    rest = rows.where("NOT eligible").select(*names, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*names, rank).unionByName(rest)

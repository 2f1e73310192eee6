"""Locally consistent fingerprints: phrases cut by deterministic coin tossing, named level by level."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrase names kept of a level, and bytes kept of each. The level compared is the highest with as many phrases.
KEPT = 32
NAME_BYTES = 5
LEVELS = 40

FINGERPRINTS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)

# Multipliers of a 64-bit finalizer, and an odd constant that tells positions apart.
_M1, _M2, _ODD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _toss_table() -> np.ndarray:
    """For labels before and at a place: twice the lowest bit in which they differ, plus that bit's value."""
    before, at = np.divmod(np.arange(128 * 128), 128)
    differing = before ^ at
    lowest = np.bitwise_count(((differing & -differing) - 1).astype(np.uint16)).astype(np.int64) * (differing > 0)
    return (2 * lowest + ((at >> lowest) & 1)).astype(np.uint8)


_TOSS = _toss_table()


def _shifted(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The value before each place; at the start of a text, the own value with its lowest bit turned."""
    before = np.empty_like(values)
    before[1:] = values[:-1]
    before[starts] = values[starts] ^ values.dtype.type(1)
    return before


def next_level(names: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of the symbols of several texts, none of them empty: names, and where each text starts.

    Runs of one symbol become one symbol first, so neighbours differ. Tossing coins by the lowest bit in which
    a symbol differs from the one before leaves labels below 6 that differ between neighbours as well; phrases
    begin where a label is higher than both its neighbours', so they have between 2 and about 12 symbols. Where
    they begin depends on the few symbols around alone, and a name on the symbols within: equal stretches are
    cut and named alike inside, wherever they stand.
    """
    heads = np.empty(len(names), bool)
    heads[0] = True
    np.not_equal(names[1:], names[:-1], out=heads[1:])
    heads[starts] = True
    at = np.flatnonzero(heads)
    run = np.diff(at, append=len(names)).astype(np.uint64)
    symbols = _mixed(names[at] + run * _ODD)
    starts = np.searchsorted(at, starts)

    differing = symbols ^ _shifted(symbols, starts)
    lowest = np.bitwise_count((differing & (~differing + np.uint64(1))) - np.uint64(1)).astype(np.uint64)
    labels = (2 * lowest + ((symbols >> lowest) & np.uint64(1))).astype(np.uint8)
    for _ in range(3):
        labels = _TOSS[_shifted(labels, starts).astype(np.uint16) * np.uint16(128) + labels]

    begins = np.zeros(len(symbols), bool)
    begins[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    # The first and last symbol of a text have a neighbour on one side only and begin no phrase of their own.
    begins[starts[1:] - 1] = False
    begins[starts] = True
    first = np.flatnonzero(begins)
    sizes = np.diff(first, append=len(symbols))
    place = (np.arange(len(symbols)) - np.repeat(first, sizes) + 1).astype(np.uint64)
    phrases = np.add.reduceat(_mixed(symbols ^ (place * _ODD)), first)
    return _mixed(phrases + sizes.astype(np.uint64)), np.searchsorted(first, starts)


def sketches(texts: list[str]) -> list[dict[int, np.ndarray]]:
    """Of each text, the smallest phrase names of its two comparison levels, by level; none for an empty text."""
    found: list[dict[int, np.ndarray]] = [{} for _ in texts]
    alive = np.array([i for i, text in enumerate(texts) if text], np.int64)
    if not len(alive):
        return found
    names = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    starts = np.cumsum([0, *[len(texts[i]) for i in alive]])[:-1]
    for level in range(1, LEVELS):
        names, starts = next_level(names, starts)
        ends = np.append(starts[1:], len(names))
        order = _mixed(names ^ np.uint64(level))
        go_on = np.zeros(len(alive), bool)
        for k, (i, a, b) in enumerate(zip(alive.tolist(), starts.tolist(), ends.tolist(), strict=True)):
            if level > 1 and b - a < KEPT:
                continue
            found[i][level] = np.unique(order[a:b])[:KEPT]
            found[i].pop(level - 2, None)
            go_on[k] = b - a >= KEPT
        if not go_on.any():
            break
        keep = np.repeat(go_on, ends - starts)
        lengths = (ends - starts)[go_on]
        names, alive = names[keep], alive[go_on]
        starts = np.cumsum([0, *lengths])[:-1]
    return found


def shown(sketch: dict[int, np.ndarray]) -> str:
    """A sketch as text: levels, highest first, each with its names in hexadecimal."""
    levels = []
    for level in sorted(sketch, reverse=True):
        raw = sketch[level].astype(">u8").view(np.uint8).reshape(-1, 8)[:, :NAME_BYTES]
        levels.append(f"{level}:{raw.tobytes().hex()}")
    return ";".join(levels)


def likeness(a: dict[int, np.ndarray], b: dict[int, np.ndarray]) -> float:
    """Share of the phrases that two texts have in common, estimated at the highest level both show.

    Twice the common phrases over all phrases of both, from the smallest names of their union. Two empty
    texts are alike; texts of sizes so different that they show no common level are not.
    """
    if not a and not b:
        return 1.0
    common = a.keys() & b.keys()
    if not common:
        return 0.0
    x, y = a[max(common)], b[max(common)]
    union = np.union1d(x, y)
    if len(x) >= KEPT or len(y) >= KEPT:
        union = union[:KEPT]
    jaccard = len(np.intersect1d(np.intersect1d(x, y), union)) / len(union)
    return 2 * jaccard / (1 + jaccard)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _range_of(doc_id: Column, splits: list[int]) -> Column:
    """Number of splits below the id, plus 1; found among every w-th split first, then among w. 0 for NULL."""
    width = max(1, int(len(splits) ** 0.5))
    array = F.array(*[F.lit(s) for s in splits]) if splits else F.array().cast("array<bigint>")
    coarse = F.array(*[F.lit(s) for s in splits[::width]]) if splits else F.array().cast("array<bigint>")
    block = F.greatest(F.size(F.filter(coarse, lambda s: s < doc_id)) - 1, F.lit(0))
    fine = F.size(F.filter(F.slice(array, block * width + 1, F.lit(width)), lambda s: s < doc_id))
    return F.when(doc_id.isNull(), 0).otherwise(block * width + fine + 1).cast("int")


def fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they are.

    The edited form ends with the start of the next document in descending order of ``doc_id``; the first
    follows the last. Rows are dealt once over ranges of ids, cut at quantiles, and sorted; the first row of
    each range is dealt to the range before it as well, so neighbours always meet in one task, whose memory
    holds a few hundred texts at a time. What passes through the driver is two numbers a range.

    NULL text is empty; an empty text has an empty fingerprint. Rows that share an id follow each other by
    text; NULL ids come last. A single row follows itself. No rows give none, extra columns are not read, and
    texts of any length are read whole.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = ranges or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [k / n for k in range(1, n)]
    cuts = rows.agg(F.percentile_approx("doc_id", shares, 20 * n)).first()[0]
    splits = sorted(set(cuts or []))
    ranged = rows.withColumn("range", _range_of(F.col("doc_id"), splits))
    heads = {row["range"]: row["head"] for row in ranged.groupBy("range").agg(F.max("doc_id").alias("head")).collect()}
    order = sorted(heads, reverse=True)
    # By range: its first id, and the range whose last row it follows.
    first = F.array(*[F.lit(heads.get(r)).cast("long") for r in range(len(splits) + 2)])
    before = {r: order[k - 1] for k, r in enumerate(order)}
    follows = F.array(*[F.lit(before.get(r, -1)) for r in range(len(splits) + 2)])
    own = F.struct(F.col("range"), F.lit(False).alias("head"))
    shared = F.struct(F.get(follows, F.col("range")).alias("range"), F.lit(True).alias("head"))
    is_head = F.col("doc_id").eqNullSafe(F.get(first, F.col("range")))
    dealt = ranged.select(
        "doc_id", "text", F.explode(F.when(is_head, F.array(own, shared)).otherwise(F.array(own))).alias("to")
    ).select("to.range", "to.head", "doc_id", "text")
    sorted_rows = dealt.repartitionById(len(splits) + 2, F.col("range")).sortWithinPartitions(
        F.desc("range"), "head", F.desc_nulls_last("doc_id"), "text"
    )

    names = [field.split()[0] for field in FINGERPRINTS.split(", ")]

    def described(ids: list, texts: list[str]) -> pa.RecordBatch:
        """Rows of all texts but the last, each of which is followed by the one after it."""
        changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
        plain, other = sketches(texts), sketches(changed)
        columns = [
            pa.array(ids[:-1], pa.int64()),
            pa.array([len(text) for text in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest() for text in changed]),
            pa.array([shown(x) for x in plain[:-1]]),
            pa.array([shown(x) for x in other]),
            pa.array([likeness(a, b) for a, b in zip(plain, other, strict=False)], pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(plain, plain[1:], strict=False)], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        size, closed, current = 0, False, None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256).to_pydict()
                for range_, head, doc_id, text in zip(*(part[c] for c in ("range", "head", "doc_id", "text")), strict=True):
                    if range_ != current:
                        ids, texts, size, closed, current = [], [], 0, False, range_
                    if closed:
                        continue
                    ids.append(doc_id)
                    texts.append(text)
                    size += len(text)
                    if head or len(texts) > 512 or size > 2 << 20:
                        if len(texts) > 1:
                            yield described(ids, texts)
                        ids, texts, size, closed = ids[-1:], texts[-1:], len(text), head

    return sorted_rows.mapInArrow(run, FINGERPRINTS)

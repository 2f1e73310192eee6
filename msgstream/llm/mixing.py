"""Mixing sources to target weights by pivotal dependent rounding of copy counts."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msgstream.llm.common import keeps_columns, word_count
from msgstream.scratch import stored

# Weights of the sources in order, repeating, and the most copies of one document.
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
# Units that are rounded together in one task.
FAN = 4096
SEED = 20240101

_UNIT = "source string, doc_id long, size long, n long, mass double, room double, copies long, level int, bucket long"


def source_targets(units: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``source, source_size, target`` from ``source, size, n``.

    Sources in order of code points, NULL last, weigh ``weights`` in turn and share the whole size. A target
    stops at ``most`` times its source's size; the excess is shared by weight among the others, until none is
    above. With sources in order of ceiling over weight, the share per unit of weight that is left when those
    before are at their ceilings rises from one to the next as long as it exceeds a source's own ratio, and
    falls from there: the largest share is the final one. Windows run over one row per source.
    """
    totals = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    by_code = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    turn = F.pmod(F.row_number().over(by_code) - 1, F.lit(len(weights))) + 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), turn.cast("int"))
    ceiling = F.col("source_size") * most
    sources = totals.withColumn("weight", weight).withColumn("ceiling", ceiling)
    ratio = Window.orderBy(F.col("ceiling") / F.col("weight"), "source")
    whole = Window.partitionBy()
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("ceiling").over(before), F.lit(0))
    shared = sources.withColumn("share", left / F.sum("weight").over(rest))
    final = F.max("share").over(whole)
    return shared.withColumn("final", final).select(
        "source",
        "source_size",
        F.least(F.col("ceiling").cast("double"), F.coalesce("final", F.lit(0.0)) * F.col("weight")).alias("target"),
    )


def _coin(level: int, source: str | None, bucket: int) -> np.random.Generator:
    """Random numbers that depend on the group alone, so that a task run again draws the same."""
    name = f"{SEED}/{level}/{source is None}/{source}/{bucket}".encode()
    return np.random.default_rng(int.from_bytes(hashlib.sha256(name).digest()[:16], "little"))


def pivot(mass: np.ndarray, room: np.ndarray, coin: np.random.Generator) -> tuple[np.ndarray, int]:
    """Rounds masses to 0 or their room, but for one at most: the masses, and the place of the open one or -1.

    A mass is a copy probability times a size. Two open units meet: mass flows from one to the other until one
    of them is empty or full. Which way is drawn so that each unit's expected mass stays what it was, and the
    sum stays as it is whatever is drawn. The one still open meets the next.
    """
    mass = mass.astype(np.float64).copy()
    tiny = 1e-9 * np.maximum(room, 1.0)
    open_one = -1
    for i in range(len(mass)):
        if mass[i] <= tiny[i] or mass[i] >= room[i] - tiny[i]:
            mass[i] = 0.0 if mass[i] <= tiny[i] else room[i]
            continue
        if open_one < 0:
            open_one = i
            continue
        j = open_one
        up, down = min(room[i] - mass[i], mass[j]), min(mass[i], room[j] - mass[j])
        step = up if coin.random() * (up + down) < down else -down
        mass[i] += step
        mass[j] -= step
        still = []
        for x in (j, i):
            if mass[x] <= tiny[x]:
                mass[x] = 0.0
            elif mass[x] >= room[x] - tiny[x]:
                mass[x] = room[x]
            else:
                still.append(x)
        open_one = still[0] if still else -1
    return mass, open_one


def settle(mass: np.ndarray, room: np.ndarray, error: float) -> None:
    """Makes up, in place, for what the last unit's rounding added to the sum: units that were rounded are
    rounded the other way, the largest first, as long as the sum comes nearer."""
    for i in np.argsort(-room, kind="stable"):
        change = -room[i] if mass[i] >= room[i] else room[i]
        if room[i] > 0 and abs(error + change) < abs(error):
            mass[i] += change
            error += change


def _round_group(last: bool, fan: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        """Settled units leave with level -1; the one still open goes on to the group above."""
        source, bucket, level = key[0].as_py(), key[1].as_py(), group["level"][0].as_py()
        ids = group["doc_id"].fill_null(0).to_numpy()
        mass, room = group["mass"].to_numpy(), group["room"].to_numpy()
        order = np.lexsort((group["size"].to_numpy(), ids, group["doc_id"].is_null().to_numpy(), -room))
        coin = _coin(level, source, bucket)
        rounded, open_one = pivot(mass[order], room[order], coin)
        if open_one >= 0 and last:
            full, part = room[order][open_one], rounded[open_one]
            rounded[open_one] = full if coin.random() * full < part else 0.0
            settle(rounded, np.where(mass[order] > 0, room[order], 0.0), rounded[open_one] - part)
            open_one = -1
        mass = np.empty(len(order))
        mass[order] = rounded
        levels = np.full(len(order), -1, np.int32)
        if open_one >= 0:
            levels[order[open_one]] = level + 1
        taken = (mass >= room) & (room > 0) & (levels < 0)
        columns = {
            "mass": mass,
            "copies": group["copies"].to_numpy() + taken,
            "level": levels,
            "bucket": np.full(len(order), bucket // fan),
        }
        for name, values in columns.items():
            at = group.column_names.index(name)
            group = group.set_column(at, name, pa.array(values))
        return group

    return run


def copies(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, fan: int = FAN
) -> DataFrame:
    """``source, doc_id, size, source_size, target, copies``, a row for each distinct ``(source, doc_id, size)``.

    Every document of a source has the same expected number of copies, target over source size. Its whole part
    is given to all; the fractional part is rounded by pivoting on mass, so that a source's sum of sizes keeps
    to its target but for the one document left open at the end. That one is drawn by itself, and what it adds
    or takes is made up by documents of the last group (:func:`settle`). Units are dealt over buckets of about
    ``fan``; each rounds its own, largest first, and hands the one unit still open to a group of ``fan``
    buckets above, until one group per source is left: a reduction tree whose groups are all bounded. Draws
    depend on ids, so any run gives the same copies.

    Rows that agree in source, id and size are one unit and get the same copies. NULL sources are one source,
    the last; a NULL id is a unit like others; NULL text has size 0. Size 0 is never taken. No rows give none.
    """
    units = docs.groupBy("source", "doc_id", "size").agg(F.count("*").alias("n"))
    units = stored(units, "mix-units")
    targets = source_targets(units, weights, most)
    joined = units.join(targets, units.source.eqNullSafe(targets.source)).drop(targets.source)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rate = F.least(rate, F.lit(float(most)))
    whole = F.when(F.col("size") > 0, F.floor(rate + 1e-12)).otherwise(0)
    room = (F.col("size") * F.col("n")).cast("double")
    ready = stored(
        joined.select(
            "source", "doc_id", "size", "n", "source_size", "target",
            (F.greatest(rate - whole, F.lit(0.0)) * room).alias("mass"),
            room.alias("room"),
            whole.cast("long").alias("copies"),
        ),
        "mix-rates",
    )
    most_units = ready.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    buckets = max(1, -(-most_units // (fan // 2)))
    place = F.pmod(F.xxhash64("doc_id", "size", F.lit(SEED)), F.lit(buckets))
    columns = [field.split()[0] for field in _UNIT.split(", ")]
    waiting = ready.withColumns({"level": F.lit(0), "bucket": place}).select(columns)
    settled = []
    while True:
        last = buckets == 1
        done = waiting.groupBy("source", "bucket").applyInArrow(_round_group(last, fan), _UNIT)
        if last:
            settled.append(done)
            break
        done = stored(done, "mix-level")
        settled.append(done.where("level < 0"))
        waiting, buckets = done.where("level >= 0"), -(-buckets // fan)
    rounded = settled[0]
    for more in settled[1:]:
        rounded = rounded.unionByName(more)
    rounded = rounded.join(targets, rounded.source.eqNullSafe(targets.source)).drop(targets.source)
    return rounded.select("source", "doc_id", "size", "source_size", "target", "copies")


def sized(docs: DataFrame) -> DataFrame:
    """The documents with ``size``, their number of words; a ``size`` of their own gives way."""
    return docs.withColumn("size", word_count(F.col("text")))


def _with_copies(rows: DataFrame, decided: DataFrame) -> DataFrame:
    decided = decided.select(
        F.col("source").alias("_source"), F.col("doc_id").alias("_id"), F.col("size").alias("_size"),
        "source_size", "target", "copies",
    )
    same = (
        rows.doc_id.eqNullSafe(decided._id)
        & rows.source.eqNullSafe(decided._source)
        & (rows["size"] == decided._size)
    )
    return rows.join(decided, same).drop("_source", "_id", "_size")


def mixture(docs: DataFrame, **settings) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` of every row; see :func:`copies`."""
    rows = stored(sized(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text")).drop("text"), "mix-sizes")
    return _with_copies(rows, copies(rows, **settings)).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


@keeps_columns("doc_id", "source", "text")
def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The documents themselves, each as often as it is taken, with the columns they came with."""
    rows = sized(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text")).drop("text")
    decided = copies(stored(rows, "mix-sizes"), **settings).where("copies > 0")
    chosen = decided.select(
        F.col("source").alias("_source"), F.col("doc_id").alias("_id"), F.col("size").alias("_size"), "copies"
    )
    full = docs.withColumn("_words", word_count(F.col("text")))
    same = (
        full.doc_id.eqNullSafe(chosen._id) & full.source.eqNullSafe(chosen._source) & (full._words == chosen._size)
    )
    repeated = full.join(chosen, same).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])

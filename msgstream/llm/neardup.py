"""Near-duplicates by b-bit MinHash: bands find candidates, packed low bits estimate, full sets confirm."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgstream.llm.common import digest, keeps_columns
from msgstream.scratch import stored

# Minima of a signature, low bits kept of each, minima in a band. Texts of likeness 0.8 share one of the 32
# bands but for one pair in twenty million.
MINIMA = 128
BITS = 2
ROWS = 4
# Estimates are trusted to this much: six standard deviations at likeness 0.8 and 128 minima of two bits.
MARGIN = 0.25
# Texts compared with each other in one task, and edges of which a task takes the components.
BLOCK = 1024
EDGES_A_TASK = 200_000
# Comparisons of a set that found no link, after which it is compared with all of its group at once.
FAILED = 8
# Words whose hashes a worker remembers.
WORDS_KEPT = 100_000

# Multiplier and shifts of a 64-bit finalizer that spreads all bits.
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


_SEEDS = _mixed(np.arange(1, 2 * MINIMA + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = (_SEEDS[:MINIMA, None] | np.uint64(1)).astype(np.uint32)
_OFFSETS = _SEEDS[MINIMA:, None].astype(np.uint32)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < WORDS_KEPT:
            self[word] = value
        return value


_WORDS = _WordHashes()


def words(text: str | None) -> list[bytes]:
    """Runs of other than ASCII white space, A to Z in lower case: just what bytes know as such."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(found: list[bytes], size: int) -> np.ndarray:
    """Sorted 64-bit values of the distinct runs of ``size`` words; of all words where there are fewer."""
    if not found:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(_WORDS.__getitem__, found), np.uint64, len(found))
    size = min(size, len(hashed))
    value = np.full(len(hashed) - size + 1, size, np.uint64)
    for k in range(size):
        value = _mixed(value ^ hashed[k : len(hashed) - size + 1 + k]) + np.uint64(k + 1)
    return np.unique(value)


def minima(values: np.ndarray) -> np.ndarray:
    """The least of each of the hash functions over a set; long sets go through in pieces."""
    short = values.astype(np.uint32)
    least = np.full(MINIMA, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(short), 2048):
        hashed = short[None, at : at + 2048] * _FACTORS
        hashed += _OFFSETS
        least = np.minimum(least, hashed.min(axis=1))
    return _mixed(least.astype(np.uint64))


def packed_bits(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima as 64-bit words: a plane of all lowest bits, then one of all second bits."""
    planes = [np.packbits(((least >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)).view(np.int64) for b in range(BITS)]
    return np.concatenate(planes)


def _estimate(equal: np.ndarray) -> np.ndarray:
    """Likeness from the number of equal low bits: what equal bits come by chance is taken off."""
    chance = 2.0**-BITS
    return (equal / MINIMA - chance) / (1 - chance)


def sequence_key(found: list[bytes]) -> bytes:
    return xxhash.xxh3_128(b" ".join(found)).digest()


def signatures(docs: DataFrame, size: int, marked: bool = False) -> DataFrame:
    """``doc_id, key, n_shingles, bits, bands`` of every row. The key is that of the word sequence, so rows of
    equal keys have equal sets; it is NULL where there is no word. If ``marked``, the two longs of the text's
    digest come along as ``hi, lo``."""
    marks = ["hi", "lo"] if marked else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = {"doc_id": part.column(0), "key": [], "n_shingles": [], "bits": [], "bands": []}
                out |= {name: part.column(2 + i) for i, name in enumerate(marks)}
                for text in part.column(1).to_pylist():
                    found = words(text)
                    values = shingles(found, size)
                    out["n_shingles"].append(len(values))
                    if not len(values):
                        for name in ("key", "bits", "bands"):
                            out[name].append(None)
                        continue
                    least = minima(values)
                    bands = least.reshape(-1, ROWS)
                    band = np.full(len(bands), 0, np.uint64)
                    for row in range(ROWS):
                        band = _mixed(band ^ bands[:, row]) + np.uint64(row)
                    out["key"].append(sequence_key(found))
                    out["bits"].append(packed_bits(least))
                    out["bands"].append((band + np.arange(len(band), dtype=np.uint64)).view(np.int64))
                yield pa.RecordBatch.from_pydict(out, schema)

    longs = pa.list_(pa.int64())
    schema = pa.schema(
        [("doc_id", pa.int64()), ("key", pa.binary()), ("n_shingles", pa.int64()), ("bits", longs), ("bands", longs)]
        + [(name, pa.int64()) for name in marks]
    )
    result = "doc_id long, key binary, n_shingles long, bits array<long>, bands array<long>"
    result += "".join(f", {name} long" for name in marks)
    digests = [digest(F.col("text"))[name].alias(name) for name in marks]
    return docs.select(F.col("doc_id").cast("long"), "text", *digests).mapInArrow(run, result)


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """``node, component`` of each end of ``a, b``: the smallest node reachable.

    Each round links every node to the least of its neighbours' labels and then to that one's label in turn,
    so that distances halve; rounds end when no label changes. A node of many edges is met by aggregates
    before the shuffle. Every round is written, as later ones depend on it.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.where("a <> b").distinct(), f"{purpose}-edges")
    # As many tasks as the edges need: rounds over few edges should not wait for many empty tasks.
    tasks = both.count() // EDGES_A_TASK + 1
    labels = stored(
        both.groupBy("a").agg(F.min("b").alias("least")).select(
            F.col("a").alias("node"), F.least("a", "least").alias("component")
        ).coalesce(tasks),
        f"{purpose}-labels",
    )
    while True:
        mine = labels.select(F.col("node").alias("b"), "component")
        near = both.join(mine, "b").groupBy("a").agg(F.min("component").alias("near")).coalesce(tasks)
        closer = labels.join(near, labels.node == near.a).select(
            "node", F.least("component", "near").alias("next"), F.col("component").alias("before")
        )
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("beyond"))
        moved = stored(
            closer.join(jump, "next", "left").select(
                "node", F.least(F.col("next"), F.coalesce("beyond", "next")).alias("component"), "before"
            ).coalesce(tasks),
            f"{purpose}-labels",
        )
        labels = moved.select("node", "component")
        if moved.where("component <> before").isEmpty():
            return labels


def _meetings(parts: DataFrame, block: int) -> DataFrame:
    """``cluster, chunk, block, node, root, left``: groups of at most about ``block`` rows in which all that is
    outside a cluster's largest part meets all of the cluster; ``left`` marks what is outside.

    Takes ``cluster, node, root``, where ``root`` names the part. Clusters of one part are left out, so the rows
    are as many as the cluster's times those outside over half a block.
    """
    half = block // 2
    shares = parts.groupBy("cluster", "root").agg(F.count("*").alias("part"))
    main = shares.groupBy("cluster").agg(F.sum("part").alias("n"), F.max(F.struct("part", "root")).alias("most"))
    chunks, halves = F.ceil((F.col("n") - F.col("most.part")) / half), F.ceil(F.col("n") / half)
    main = main.select(
        "cluster", F.col("most.root").alias("main"), chunks.cast("int").alias("chunks"), halves.cast("int").alias("halves")
    ).where("chunks > 0")
    dealt = (
        parts.join(main, "cluster")
        .withColumn("left", F.col("root") != F.col("main"))
        .withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(5)), F.col("chunks")).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("halves")).cast("int"))
    )
    each = {name: F.explode(F.sequence(F.lit(0), F.col(count) - 1)) for name, count in (("chunk", "chunks"), ("block", "halves"))}
    chosen = ["cluster", "chunk", "block", "node", "root", "left"]
    everyone = dealt.withColumn("chunk", each["chunk"]).withColumn("left", F.lit(False)).select(chosen)
    outside = dealt.where("left").withColumn("block", each["block"]).select(chosen)
    return everyone.unionByName(outside).groupBy("cluster", "chunk", "block", "node").agg(
        F.first("root").alias("root"), F.max("left").alias("left")
    )


def _renamed(parts: DataFrame, names: DataFrame) -> DataFrame:
    """The parts with a root's new name, if ``root, name`` has one."""
    return parts.join(names, "root", "left").withColumn("root", F.coalesce("name", "root")).drop("name")


def _tied(groups: DataFrame, percent: int) -> DataFrame:
    """``a, b``: roots of rows that are tied in a group of ``cluster, chunk, block, node, root, bits``.

    Ties connect the texts whose estimates reach the floor. A text is compared with those not yet connected
    only, so near copies are done after a few comparisons.
    """
    keys = ["cluster", "chunk", "block"]
    groups = groups.repartition(*keys).select(*keys, "node", "root", "bits").sortWithinPartitions(*keys, "node")
    lanes, floor = MINIMA // 64, percent / 100 - MARGIN

    def connected(ids: np.ndarray, bits: np.ndarray) -> Iterator[tuple[int, int]]:
        planes = bits.view(np.uint64).reshape(len(ids), BITS, lanes)
        left = np.arange(len(ids))
        while len(left) > 1:
            root, waiting, left = left[0], [left[0]], left[1:]
            while waiting and len(left):
                one = planes[waiting.pop()]
                differing = np.bitwise_or.reduce(planes[left] ^ one, axis=1)
                estimate = _estimate(MINIMA - np.bitwise_count(differing).sum(axis=1).astype(np.float64))
                near = estimate >= floor
                waiting += left[near].tolist()
                yield from ((int(ids[root]), int(ids[i])) for i in left[near] if ids[i] != ids[root])
                left = left[~near]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                keys = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
                bits = batch.column(5).flatten().to_numpy().reshape(batch.num_rows, -1)
                new = keys, batch.column(4).to_numpy(), bits
                rest = new if rest is None else tuple(np.concatenate(pair) for pair in zip(rest, new, strict=True))
            if rest is None or not len(rest[0]):
                continue
            keys, ids, bits = rest
            starts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1])
            # The last group may go on in the next batch.
            ends = np.append(starts[1:], len(keys))
            if batch is not None:
                rest, starts, ends = tuple(x[starts[-1] :] for x in rest), starts[:-1], ends[:-1]
            found = [tie for s, e in zip(starts.tolist(), ends.tolist(), strict=True) if e - s > 1 for tie in connected(ids[s:e], bits[s:e])]
            pairs = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return groups.mapInArrow(run, "a long, b long").distinct()


def _clusters(nodes: DataFrame, percent: int, block: int) -> DataFrame:
    """``cluster, node`` of the texts that ties of their bands connect with another.

    A band of more than ``block`` texts is dealt over blocks, a text to one of them, but the smallest to each.
    Near copies are connected by that one; only what is still outside a band's largest part meets all of the band.
    """
    bands = nodes.select("node", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("head")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    dealt = bands.join(shared, "band").select("node", F.col("band").alias("cluster"), blocks.alias("blocks"), "head")
    own = F.array(F.pmod(F.xxhash64("node", "cluster"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    met = dealt.withColumn("block", F.explode(F.when(F.col("node") == F.col("head"), every).otherwise(own)))
    bits = nodes.select("node", "bits")
    ties = _tied(met.withColumn("chunk", F.lit(0)).withColumn("root", F.col("node")).join(bits, "node"), percent)
    # All texts a text is tied to are tied to the smallest of them instead: as many edges, but one a text.
    own = ties.groupBy("b").agg(F.min("a").alias("least"), F.collect_set("a").alias("others"))
    others = own.select(F.explode("others").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
    edges = own.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(others)
    clusters = components(edges, "neardup-clusters")
    if shared.where(F.col("n") > block).isEmpty():
        return clusters.select(F.col("component").alias("cluster"), "node")
    large = dealt.where("blocks > 1").select("cluster", "node").join(clusters, "node", "left")
    large = stored(large.select("cluster", "node", F.coalesce("component", "node").alias("root")), "neardup-bands")
    more = components(_tied(_meetings(large, block).join(bits, "node"), percent), "neardup-clusters")
    # A text may have had no tie before.
    known = clusters.select("node", F.col("component").alias("root"))
    known = known.unionByName(more.select("node", F.col("node").alias("root")).join(clusters, "node", "left_anti"))
    return _renamed(known, more.select(F.col("node").alias("root"), F.col("component").alias("name"))).select(
        F.col("root").alias("cluster"), "node"
    )


class _Forest:
    """Union by smaller root."""

    def __init__(self, roots: np.ndarray):
        self.parent = list(range(len(roots)))
        first: dict[int, int] = {}
        for i, root in enumerate(roots):
            self.parent[i] = first.setdefault(int(root), i)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        self.parent[max(a, b)] = min(a, b)


def _links(texts: list[str], bits: np.ndarray, roots: np.ndarray, left: np.ndarray, size: int, percent: int) -> list[int]:
    """Of each row the place of the first it is connected with, by equal roots or by links of which one end at
    least is marked ``left``.

    The pairs of highest estimate come first, and a pair already connected is skipped, so that sets are
    compared about once a row; sets decide: 100 * common >= percent * all. Pairs are left out where the values
    that are in a second set of the group, too, are too few for a link.
    """
    lanes = MINIMA // 64
    planes = bits.view(np.uint64).reshape(len(texts), BITS, lanes)
    forest = _Forest(roots)
    floor = percent / 100 - MARGIN
    open_rows = np.flatnonzero(left)
    # Estimates of a part of the rows at a time, so that the matrix stays small.
    pairs, strengths = [], []
    for at in range(0, len(open_rows), 128):
        some = open_rows[at : at + 128]
        differing = np.zeros((len(some), len(texts), lanes), np.uint64)
        for plane in range(BITS):
            differing |= planes[some, None, plane] ^ planes[None, :, plane]
        estimate = _estimate(MINIMA - np.bitwise_count(differing).sum(axis=2).astype(np.float64))
        i, j = np.nonzero(estimate >= floor)
        a, b = some[i], j
        once = ((a < b) | ((a > b) & ~left[b])) & (roots[a] != roots[b])
        pairs.append(np.stack([a[once], b[once]], axis=1))
        strengths.append(estimate[i, j][once])
    pair = np.concatenate(pairs) if pairs else np.empty((0, 2), np.int64)
    if not len(pair):
        return [forest.root(i) for i in range(len(texts))]
    strength = np.concatenate(strengths)
    known = {int(i): shingles(words(texts[i]), size) for i in np.unique(pair)}
    values = np.concatenate(list(known.values()))
    values.sort()
    again = np.unique(values[1:][values[1:] == values[:-1]])
    del values
    # Of each set its length and the places in ``again`` of its values that are there.
    lengths, places = np.zeros(len(texts), np.int64), [np.empty(0, np.int32)] * len(texts)
    for i in list(known):
        own = known.pop(i)
        lengths[i], own = len(own), own[np.isin(own, again, assume_unique=True)]
        places[i] = np.searchsorted(again, own).astype(np.int32)
    shared = np.array([len(own) for own in places])
    a, b = pair[:, 0], pair[:, 1]
    most = np.minimum(shared[a], shared[b])
    able = 100 * most >= percent * (lengths[a] + lengths[b] - most)
    pair, strength = pair[able], strength[able]

    flat, ends = np.concatenate(places), np.cumsum(shared)
    mark = np.zeros(len(again), bool)

    def with_each(i: int) -> np.ndarray:
        mark[places[i]] = True
        sums = np.concatenate([[0], np.cumsum(mark[flat], dtype=np.int32)])
        mark[places[i]] = False
        return sums[ends] - sums[ends - shared]

    failed, counted = np.zeros(len(texts), np.int64), {}
    for i, j in pair[np.argsort(-strength, kind="stable")].tolist():
        if forest.root(i) == forest.root(j):
            continue
        if i not in counted and failed[i] == FAILED:
            counted[i] = with_each(i)
        both = counted[i][j] if i in counted else len(np.intersect1d(places[i], places[j], assume_unique=True))
        if 100 * both >= percent * (lengths[i] + lengths[j] - both):
            forest.join(i, j)
        elif i not in counted:
            failed[i] += 1
    return [forest.root(i) for i in range(len(texts))]


def _confirmed(groups: DataFrame, keys: list[str], size: int, percent: int) -> DataFrame:
    """``root, name``: the roots that links connect with another within a group of ``node, text, bits, root,
    left``, and one of these roots that names them all. It is not among the roots itself, so where groups
    share no root a root has one name."""

    def run(group: pa.Table) -> pa.Table:
        order = np.argsort(group["node"].to_numpy(), kind="stable")
        group = group.take(pa.array(order))
        roots, texts = group["root"].to_numpy(), group["text"].to_pylist()
        bits = np.array(group["bits"].to_pylist(), np.int64)
        first = _links(texts, bits, roots, group["left"].to_numpy(zero_copy_only=False), size, percent)
        found = {int(root): int(roots[i]) for root, i in zip(roots, first, strict=True) if root != roots[i]}
        return pa.table({"root": pa.array(list(found), pa.int64()), "name": pa.array(list(found.values()), pa.int64())})

    return groups.groupBy(*keys).applyInArrow(run, "root long, name long")


def _hopeless(members: DataFrame, size: int, percent: int) -> DataFrame:
    """``node`` of those of ``cluster, node, text`` that cannot be linked with any of their cluster, as too many of
    their values are in no other of its sets: what is left of a set has to reach the threshold with the
    smallest set of the cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cluster, node, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                found = shingles(words(text), size).view(np.int64)
                same = (pa.array(np.full(len(found), x, np.int64)) for x in (cluster, node, len(found)))
                yield pa.RecordBatch.from_arrays([*same, pa.array(found)], ["cluster", "node", "length", "value"])

    values = members.select("cluster", "node", "text").mapInArrow(run, "cluster long, node long, length long, value long")
    once = values.groupBy("cluster", "value").agg(F.count("*").alias("n"), F.min("node").alias("node"), F.min("length").alias("length"))
    own = once.where("n = 1").groupBy("cluster", "node").agg(F.max("length").alias("length"), F.count("*").alias("own"))
    shortest = once.groupBy("cluster").agg(F.min("length").alias("shortest"))
    shared = F.col("length") - F.col("own")
    return own.join(shortest, "cluster").where(
        100 * shared < percent * (F.col("length") + F.greatest(F.col("shortest"), shared) - shared)
    ).select("node")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    Two texts are linked if the sets of their distinct runs of ``size`` words overlap in ``percent`` of their
    union or more. A component is what links connect; its id is the smallest ``doc_id`` in it.

    1. Rows of the same words are one text, named by its smallest id.
    2. Texts with a band of minima in common are candidates. Where the packed bits of two of them let expect
       a likeness near the threshold they belong together; a band gives as few ties as connect its texts, so
       a group of n gives n at most, not n * n (:func:`_ties`). What ties connect is a cluster.
    3. Each cluster is dealt over blocks of bounded size. Within a block all pairs are estimated in memory and
       sets are compared for the best estimates first, until all that is linked is connected.
    4. In clusters of several blocks, a text of each part found is sent round to link the parts. What is then
       outside the cluster's largest part is compared with all of the cluster, again in bounded blocks. So no
       link between parts is lost, however large the cluster, and nothing emits a group's pairs.

    Rows without a word have an empty set and are linked with nothing. NULL text is empty. A row without a
    ``doc_id`` never names a component: it gets its text's, and is kept only if no row with an id has its
    text. Rows that repeat an id are judged alike where the text is alike. No rows give none; extra columns
    are not read. A text of any length is read whole.
    """
    return _judged(docs, size, percent, block).select("doc_id", "n_shingles", "component_id", "kept")


def _judged(docs: DataFrame, size: int, percent: int, block: int = BLOCK, marked: bool = False) -> DataFrame:
    """:func:`near_duplicates`; if ``marked``, with the digest of each row's text as ``hi, lo``."""
    rows = stored(signatures(docs, size, marked), "neardup-signatures")
    first = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("first_id"))
    first = stored(first.withColumn("node", F.monotonically_increasing_id()), "neardup-texts")
    members = _linked(docs, rows, first.where("first_id IS NOT NULL"), size, percent, block)
    grouped = first.join(members, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = grouped.join(least, "component").select("key", "component_id")
    judged = rows.drop("bits", "bands").join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return judged.withColumn("component_id", component).drop("key").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def _with_texts(members: DataFrame, docs: DataFrame) -> DataFrame:
    """The members with the text of a row that has their first id and their words."""
    texts = docs.select(F.col("doc_id").cast("long").alias("first_id"), "text")
    both = members.join(texts, "first_id")
    places = {name: both.columns.index(name) for name in ("key", "text")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = batch.column(places["key"]).to_pylist(), batch.column(places["text"]).to_pylist()
            yield batch.filter(pa.array([sequence_key(words(t)) == k for k, t in zip(keys, found, strict=True)], pa.bool_()))

    return both.mapInArrow(run, both.schema).dropDuplicates(["node"])


def _linked(docs: DataFrame, rows: DataFrame, first: DataFrame, size: int, percent: int, block: int) -> DataFrame:
    """``node, component`` of texts that are linked with another."""
    rows = rows.select("key", F.col("doc_id").alias("first_id"), "bits", "bands")
    one = stored(first.join(rows, ["key", "first_id"]).dropDuplicates(["node"]), "neardup-nodes")
    clusters = stored(_clusters(one, percent, block), "neardup-clusters")
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    members = clusters.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    described = members.join(one.select("node", "key", "first_id", "bits"), "node")
    members = stored(_with_texts(described, docs).drop("key", "first_id"), "neardup-members")

    alone = members.select("cluster", "block", "node", "text", "bits", F.col("node").alias("root"), F.lit(True).alias("left"))
    names = stored(_confirmed(alone, ["cluster", "block"], size, percent), "neardup-links")
    # A text is in one block, so its name is that of its part.
    linked = names.select(F.col("root").alias("node"), F.col("name").alias("component"))
    if members.where("blocks > 1").isEmpty():
        return linked

    # Large clusters: one text of each part of two or more meets those of other blocks, until they fit one.
    large = members.where("blocks > 1").select("cluster", "node", "text", "bits")
    parts = stored(_renamed(large.select("cluster", "node", F.col("node").alias("root")), names), "neardup-parts")
    for turn in range(4):
        heads = parts.groupBy("cluster", "root").agg(F.count("*").alias("part")).where("part > 1")
        blocks = heads.groupBy("cluster").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
        met = large.join(heads.select("cluster", F.col("root").alias("node")), ["cluster", "node"]).join(blocks, "cluster")
        met = met.withColumn("block", F.pmod(F.xxhash64("node", F.lit(turn)), F.col("blocks")).cast("int"))
        met = stored(met.withColumn("root", F.col("node")).withColumn("left", F.lit(True)), "neardup-heads")
        names = stored(_confirmed(met.drop("blocks"), ["cluster", "block"], size, percent), "neardup-links")
        parts = stored(_renamed(parts, names), "neardup-parts")
        if met.where("blocks > 1").isEmpty():
            break

    # What is outside a cluster's largest part meets all of the cluster, but for what no set of it can be linked with.
    open_parts = parts.groupBy("cluster").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most")
    texts = large.join(open_parts.select("cluster"), "cluster", "left_semi")
    able = parts.join(stored(_hopeless(texts, size, percent), "neardup-hopeless"), "node", "left_anti")
    outside = stored(_meetings(able, block), "neardup-outside").join(large.drop("cluster"), "node")
    more = _confirmed(outside, ["cluster", "chunk", "block"], size, percent)
    names = components(more.select(F.col("root").alias("a"), F.col("name").alias("b")), "neardup-components")
    parts = _renamed(parts, names.select(F.col("node").alias("root"), F.col("component").alias("name")))
    few = linked.join(large.select("node"), "node", "left_anti")
    return few.unionByName(parts.select("node", F.col("root").alias("component")))


@keeps_columns("doc_id", "text")
def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, its smallest id, with the columns it came with.

    Rows are told apart by id and text, so only those judged not kept go: of an id with several texts each is
    judged by itself, and rows without an id go where a row with one has their words. Rows without a word stay.
    """
    judged = _judged(docs, size, percent, marked=True)
    gone = judged.where(~F.col("kept")).select(F.col("doc_id").alias("_gone"), F.struct("hi", "lo").alias("_text")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_gone")) & (digest(F.col("text")) == F.col("_text"))
    return docs.join(gone, same, "left_anti")

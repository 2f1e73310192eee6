"""Cost-balanced packing of tokenized documents into sequences of fixed capacity."""

from __future__ import annotations

import gc
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, cost double, token_ids binary"
)

# Documents that share a set of open sequences, and the token bytes after which a set is closed early.
BLOCK_DOCS = 4096
BLOCK_BYTES = 32 << 20
# A set is looked at after each group of so many documents. Texts encoded in one call: whole groups, of so many
# documents and bytes at most, but one group at least.
GROUP_DOCS = 256
CALL_DOCS = 1024
CALL_BYTES = 8 << 20
# Chunks, and words in them, whose ids a task remembers between calls: twice as many at most, those not met again go.
CHUNKS_KEPT = 60_000
WORDS_KEPT = 120_000
# Longer ones, in characters, are not remembered.
LONGEST_KEPT = 64
# Words encoded in one call.
CALL_WORDS = 512
# Of each chunk, with a space before it: the word of Latin letters at its start, up to an ASCII character or the end,
# which nothing joins or composes it with, if there is one; then whatever else is in the chunk.
PARTED = re.compile(r" (?:([A-Za-zÀ-ÖØ-öø-ÿ]++)(?=[\x00-\x7F]|\Z))?([^ ]*+)")
# Sequence ids: the partition above, the running number of the sequence in it below.
SEQUENCES_BITS = 40


class ChunkIds:
    """Token ids, as little-endian 32-bit bytes, of texts.

    The tokenizer drops white space and never joins what stands on both sides of it, nor a word with what is
    not a letter after it, and it sees words in lower case. So the ids of a text are those of its chunks
    between spaces one after the other, and those of a chunk are its first word's and the rest's. Each
    distinct chunk and word is encoded once a call, and the ids of some are remembered for the next; words go
    to the tokenizer many at a time, as the last token of each is marked as such.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        # Small Latin words need no normalizing, and spaces are all that stands between them.
        plain = json.loads(self.tokenizer.to_str()) | {"normalizer": None, "added_tokens": []}
        byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        plain["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, byte_level]}
        self.word_tokenizer = Tokenizer.from_str(json.dumps(plain))
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.earlier_chunks: dict[str, bytes] = {}
        self.earlier_words: dict[str, bytes] = {}

    def _learn_words(self, new: list[str]) -> None:
        groups = [new[at : at + CALL_WORDS] for at in range(0, len(new), CALL_WORDS)]
        encodings = self.word_tokenizer.encode_batch_fast([" ".join(group) for group in groups], add_special_tokens=False)
        for group, encoding in zip(groups, encodings, strict=True):
            ids = np.asarray(encoding.ids, "<u4")
            ends, raw = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist(), ids.tobytes()
            self.words.update((word, raw[a:b]) for word, a, b in zip(group, [0, *ends], ends, strict=False))
            if len(ends) != len(group):
                raise ValueError("the vocabulary does not mark the ends of words")

    def _learn(self, words: set[str], others: set[str]) -> None:
        if len(self.chunks) > CHUNKS_KEPT:
            self.chunks, self.earlier_chunks = {}, self.chunks
        if len(self.words) > WORDS_KEPT:
            self.words, self.earlier_words = {}, self.words
        for new, known, earlier in ((words, self.words, self.earlier_words), (others, self.chunks, self.earlier_chunks)):
            new.difference_update(known)
            again = new.intersection(earlier)
            known.update((x, earlier[x]) for x in again)
            new.difference_update(again)
        self._learn_words(list(words))
        new = list(others)
        encodings = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        self.chunks.update((c, np.asarray(e.ids, "<u4").tobytes()) for c, e in zip(new, encodings, strict=True))

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        if not len(texts):
            return []
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts.cast(pa.string())
        chunked = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        chunks = chunked.flatten().dictionary_encode()
        distinct = pa.ListArray.from_arrays([0, len(chunks.dictionary)], chunks.dictionary)
        parted = PARTED.findall(" " + pc.binary_join(distinct, " ")[0].as_py())
        # These letters have one lower-case letter each.
        words = " ".join([word for word, _ in parted]).lower().split(" ")
        rests = [rest for _, rest in parted]
        del parted
        self._learn(set(words) - {""}, set(rests))
        known, others = self.words, self.chunks
        of_chunks = [known[word] + others[rest] if word else others[rest] for word, rest in zip(words, rests, strict=True)]
        for once in {word for word in words if len(word) > LONGEST_KEPT}:
            del known[once]
        for once in {rest for rest in rests if len(rest) > LONGEST_KEPT}:
            del others[once]
        ids = pa.array(of_chunks, pa.large_binary()).take(chunks.indices)
        _, offsets, values = ids.buffers()
        starts = np.frombuffer(offsets, np.int64)[chunked.offsets.to_numpy() - chunked.offsets[0].as_py()].tolist()
        raw = memoryview(values or b"")
        return [bytes(raw[a:b]) for a, b in zip(starts, starts[1:], strict=False)]

    def forget(self) -> None:
        """Leaves the worker, which goes on to other steps, nothing but the tokenizers."""
        self.chunks, self.words, self.earlier_chunks, self.earlier_words = {}, {}, {}, {}


@lru_cache(maxsize=2)
def chunk_ids(path: str) -> ChunkIds:
    return ChunkIds(path)


def encoded_groups(batch: pa.RecordBatch, known: ChunkIds) -> Iterator[tuple[list, list[bytes]]]:
    """The ids and encoded texts of a batch's documents, a group at a time."""
    starts = range(0, batch.num_rows, GROUP_DOCS)
    sizes = [batch.column(1).slice(at, GROUP_DOCS).nbytes for at in starts]
    call: list[int] = []
    for k, at in enumerate(starts):
        call.append(sizes[k])
        if k + 1 < len(sizes) and len(call) < CALL_DOCS // GROUP_DOCS and sum(call) + sizes[k + 1] <= CALL_BYTES:
            continue
        first = at - (len(call) - 1) * GROUP_DOCS
        rows = batch.slice(first, len(call) * GROUP_DOCS)
        ids, texts = rows.column(0).to_pylist(), known.encode(rows.column(1))
        for of in range(0, len(ids), GROUP_DOCS):
            yield ids[of : of + GROUP_DOCS], texts[of : of + GROUP_DOCS]
        call = []


def balanced(lengths: np.ndarray, capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int]]:
    """Places tails, each shorter than the capacity, as (tail, start in it, length, sequence).

    There are as few sequences as can hold all tokens. In descending order of cost, which is that of length,
    each tail goes to the sequence of least cost so far that still has room for it. Tails that fit nowhere
    are cut over the room that is left, again the sequence of least cost first.
    """
    sequences = -(-int(lengths.sum()) // capacity)
    cost, room, placed, homeless = np.zeros(sequences), np.full(sequences, capacity), [], []

    def place(tail: int, start: int, length: int, sequence: int) -> None:
        placed.append((tail, start, length, sequence))
        cost[sequence] += linear * length + quadratic * length * length
        room[sequence] -= length

    for tail in np.argsort(-lengths, kind="stable"):
        length = int(lengths[tail])
        best = int(np.where(room >= length, cost, np.inf).argmin())
        if room[best] >= length:
            place(int(tail), 0, length, best)
        else:
            homeless.append(int(tail))
    for tail in homeless:
        start, length = 0, int(lengths[tail])
        while start < length:
            best = int(np.where(room > 0, cost, np.inf).argmin())
            step = min(int(room[best]), length - start)
            place(tail, start, step, best)
            start += step
    return placed


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 1,
    linear: float = 1.0,
    quadratic: float = 1 / 1024,
) -> DataFrame:
    """Pieces of all documents, by sequence and offset there, with their token ids.

    A document is its token ids and then ``end_id``. It fills whole sequences as long as it can; its tail is
    packed with the tails of other documents of the same block (:func:`balanced`). The cost of a piece of n
    tokens is estimated as ``linear * n + quadratic * n * n``. Blocks follow the scan's order and are bounded
    by rows and bytes, so nothing is shuffled and a task holds one block; each block leaves less than one
    sequence unfilled, and ids follow from partition and order, so a task that runs again gives the same rows.

    NULL text counts as empty: such a document is one piece, the end id alone. A NULL ``doc_id`` is carried
    along. Repeated rows are packed once each. No rows give no pieces. Other columns are not read. A text of
    any length is cut like any other. Equal costs keep the scan's order.
    """

    def pieces(doc_ids: list, encoded: list[bytes], first: int) -> tuple[pa.RecordBatch, int]:
        tokens = np.array([len(x) // 4 for x in encoded])
        rows, sequence = [], first
        for i, n in enumerate(tokens):
            for start in range(0, int(n) // capacity * capacity, capacity):
                rows.append((i, start, capacity, sequence))
                sequence += 1
        tail_of = np.flatnonzero(tokens % capacity)
        tails = tokens[tail_of] % capacity
        for t, start, length, to in balanced(tails, capacity, linear, quadratic):
            i = int(tail_of[t])
            rows.append((i, int(tokens[i] - tails[t]) + start, length, sequence + to))
        used: dict[int, int] = {}
        columns: list[list] = [[] for _ in range(8)]
        for i, start, length, to in rows:
            offset = used.get(to, 0)
            used[to] = offset + length
            cost = linear * length + quadratic * length * length
            values = (
                doc_ids[i], start, length, int(tokens[i]), to, offset, cost, encoded[i][4 * start : 4 * (start + length)]
            )
            for column, value in zip(columns, values, strict=True):
                column.append(value)
        types = [pa.int64()] * 6 + [pa.float64(), pa.binary()]
        names = [field.split()[0] for field in PIECES.split(", ")]
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names), max([first, *(s + 1 for s in used)])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = chunk_ids(tokenizer), np.asarray([end_id], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << SEQUENCES_BITS
        ids: list = []
        encoded: list[bytes] = []
        size = 0
        for batch in batches:
            for doc_id, new in encoded_groups(batch, known):
                ids += doc_id
                encoded += [x + end for x in new]
                size += sum(map(len, encoded[-len(new) :]))
                if len(ids) >= BLOCK_DOCS or size >= BLOCK_BYTES:
                    out, sequence = pieces(ids, encoded, sequence)
                    ids, encoded, size = [], [], 0
                    yield from (out.slice(k, 8192) for k in range(0, out.num_rows, 8192))
        if ids:
            out, sequence = pieces(ids, encoded, sequence)
            yield from (out.slice(k, 8192) for k in range(0, out.num_rows, 8192))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What is kept here holds no cycles, and looking for them takes a quarter of the time. The worker goes on to
        # other tasks, whose cycles must be found again, and beside other steps, which need the memory.
        gc.disable()
        try:
            yield from packed(batches)
        finally:
            gc.enable()
            chunk_ids(tokenizer).forget()
            pa.default_memory_pool().release_unused()

    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "text").mapInArrow(run, PIECES)

"""Encoding texts to ids of a byte-pair piece vocabulary, and decoding them, by rounds of merges over flat arrays."""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate, chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# The mark that stands for a space in pieces, and what an unknown id reads as.
SPACE, UNKNOWN = "▁", " ⁇ "

# Bytes of text taken through the rounds at once, and code points of one text looked at in a piece.
PART_BYTES, WINDOW = 4 << 20, 1 << 20
# Bytes of words and their ids that a worker remembers; beyond it starts anew.
KEPT_BYTES = 96 << 20
# A longer word in which merges must go one by one is merged with a queue instead of rounds.
ROUND_SYMBOLS = 256

NO_RANK = np.int32(2**31 - 1)


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("each_byte_replaced", _each_byte)


class Pieces:
    """A vocabulary of byte-pair pieces with byte fallback, as the sentencepiece library reads it.

    The library gives the pieces and their scores; merging is done here. A merge joins two neighbours whose
    joint text is a piece, the highest score first, the leftmost first among equals.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=path)
        if library.normalize(" a  ﬁ\t") != f"{SPACE}{SPACE}a{SPACE}{SPACE}ﬁ\t":
            raise ValueError("only vocabularies that leave texts as they are and mark their start are supported")
        size = library.get_piece_size()
        names = [library.id_to_piece(i) for i in range(size)]
        special = [library.is_control(i) or library.is_unknown(i) or library.is_byte(i) for i in range(size)]
        if any(library.is_unused(i) for i in range(size)):
            raise ValueError("vocabularies with unused pieces are not supported")
        self.begin, self.end = library.bos_id(), library.eos_id()
        of_byte = {names[i]: i for i in range(size) if library.is_byte(i)}
        self.byte_ids = np.array([of_byte[f"<0x{b:02X}>"] for b in range(256)], np.uint32)

        # Symbols: pieces by their id, then characters that only occur within pieces.
        self.symbols = {name: i for i, name in enumerate(names) if not special[i]}
        self.pieces = size
        for char in sorted({c for name in self.symbols for c in name} - self.symbols.keys()):
            self.symbols[char] = len(self.symbols) + size
        self.of_char = np.full(0x110000, -1, np.int32)
        for symbol, i in self.symbols.items():
            if len(symbol) == 1:
                self.of_char[ord(symbol)] = i

        # Equal scores are equal ranks. A rank is loose if one of its pieces is part of a piece that comes no later.
        scores = np.array([library.get_score(i) for i in range(size)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.stride = max(self.symbols.values()) + 1
        pairs, self.loose = {}, np.zeros(int(self.rank.max()) + 1, bool)
        for name, i in self.symbols.items():
            for cut in range(1, len(name)):
                left, right = self.symbols.get(name[:cut]), self.symbols.get(name[cut:])
                if left is not None and right is not None:
                    pairs[left * self.stride + right] = i
                    for part in (left, right):
                        if part < size and self.rank[part] >= self.rank[i]:
                            self.loose[self.rank[part]] = True
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_pieces = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int32)
        self.pairs = pairs

        # No piece joins a mark to what stands before it, nor holds a character that is never merged.
        joined = sorted({c for name in self.symbols if len(name) > 1 for c in name} - {SPACE})
        within = any(SPACE in name.lstrip(SPACE) for name in self.symbols)
        kept = "".join(map(re.escape, joined))
        self.words_of = re.compile(r"[\s\S]+" if within else f"{SPACE}+[{kept}]*|[{kept}]+|[^{kept}{SPACE}]+")
        self.known: dict[str, bytes] = {}
        self.known_bytes = 0

        text = [b"" if library.is_control(i) else name.replace(SPACE, " ").encode() for i, name in enumerate(names)]
        for byte, i in enumerate(self.byte_ids.tolist()):
            text[i] = bytes([byte])
        text[library.unk_id()] = UNKNOWN.encode()
        self.text = text
        self.silent = {i for i in range(size) if library.is_control(i)}
        self.marked = {i for i, name in enumerate(names) if not special[i] and name.startswith(SPACE)}

    # --- encoding -----------------------------------------------------------------------------------

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece and rank of each pair of neighbours; -1 and NO_RANK where they make none."""
        keys = left.astype(np.int64) * self.stride + right
        keys[(left < 0) | (right < 0)] = -1
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        piece = np.where(self.pair_keys[at] == keys, self.pair_pieces[at], -1)
        return piece, np.where(piece >= 0, self.rank[piece], NO_RANK)

    def _queued(self, symbols: np.ndarray) -> np.ndarray:
        """Where symbols begin once one word is merged, each time the best pair, leftmost first; with the symbols."""
        symbol, n = symbols.tolist(), len(symbols)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        queue: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                key = symbol[i] * self.stride + symbol[after[i]]
                piece = self.pairs.get(key)
                if piece is not None and symbol[i] >= 0:
                    heapq.heappush(queue, (int(self.rank[piece]), i, piece, key))

        for i in range(n):
            offer(i)
        while queue:
            _, i, piece, key = heapq.heappop(queue)
            j = after[i]
            if not alive[i] or j >= n or symbol[i] * self.stride + symbol[j] != key:
                continue
            symbol[i], alive[j], after[i] = piece, False, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        starts = np.flatnonzero(alive)
        return np.stack([starts, np.array(symbol)[starts]])

    def _merged(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit bytes.

        All words lie in one flat array of symbols. A round finds the least rank of a pair in each word, joins
        the pairs of that rank, in each run of overlapping ones every other from the left, and closes the gaps.
        Pairs of one rank can be joined at once, unless what comes of them may join again at that rank or a
        better one: then the word's leftmost pair alone is joined. Words without a pair left leave the array.
        """
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        lengths = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(lengths) - lengths
        done: list[tuple[np.ndarray, np.ndarray]] = []  # where symbols begin, and the symbols
        start, symbol, word = np.arange(len(points)), self.of_char[points], np.repeat(np.arange(len(words)), lengths)
        first = np.zeros(len(points), bool)
        first[starts] = True

        def ranked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            following = np.minimum(at + 1, len(symbol) - 1)
            inside = word[at] == word[following]
            inside &= following > at
            piece, rank = self._pairs(symbol[at], symbol[following])
            return np.where(inside, piece, -1), np.where(inside, rank, NO_RANK)

        piece, rank = ranked(np.arange(len(symbol)))
        while len(symbol):
            heads = np.flatnonzero(first)
            sizes = np.diff(heads, append=len(symbol))
            least = np.minimum.reduceat(rank, heads)
            ended = least == NO_RANK
            single = ~ended & self.loose[np.where(ended, 0, least)]
            for k in np.flatnonzero(single & (sizes > ROUND_SYMBOLS)).tolist():
                at = slice(heads[k], heads[k] + sizes[k])
                places, merged = self._queued(symbol[at])
                done.append((start[at][places], merged))
                ended[k], single[k] = True, False
                first[at] = False  # its symbols go with the ended words, and are written already
                rank[at], symbol[at] = NO_RANK, -2
            if ended.any():
                gone = np.repeat(ended, sizes)
                finished = gone & (symbol != -2)
                done.append((start[finished], symbol[finished]))
                stay = ~gone
                start, symbol, word, first = start[stay], symbol[stay], word[stay], first[stay]
                piece, rank = piece[stay], rank[stay]
                least, single, sizes = least[~ended], single[~ended], sizes[~ended]
                if not len(symbol):
                    break
            take = np.flatnonzero(rank == np.repeat(least, sizes))
            run = np.maximum.accumulate(np.where(np.diff(take, prepend=-2) != 1, np.arange(len(take)), 0))
            chosen = (np.arange(len(take)) - run) % 2 == 0
            if single.any():
                of = word[take]
                leftmost = np.diff(of, prepend=-1) != 0
                chosen &= leftmost | ~np.repeat(single, sizes)[take]
            take = take[chosen]
            symbol[take] = piece[take]
            keep = np.ones(len(symbol), bool)
            keep[take + 1] = False
            start, symbol, word, first, piece, rank = (a[keep] for a in (start, symbol, word, first, piece, rank))
            take -= np.arange(len(take))
            touched = np.zeros(len(symbol), bool)
            touched[take] = touched[np.maximum(take - 1, 0)] = True
            changed = np.flatnonzero(touched)
            piece[changed], rank[changed] = ranked(changed)

        start = np.concatenate([s for s, _ in done])
        order = np.argsort(start)
        start, symbol = start[order], np.concatenate([s for _, s in done])[order]
        single_char = (symbol < 0) | (symbol >= self.pieces)
        fallback = points[start[single_char]]
        counts = np.ones(len(symbol), np.int64)
        counts[single_char] += (fallback >= 0x80).astype(np.int64) + (fallback >= 0x800) + (fallback >= 0x10000)
        ids = np.empty(int(counts.sum()), "<u4")
        as_bytes = np.repeat(single_char, counts)
        raw = fallback.astype("<u4").tobytes().decode("utf-32-le").encode()
        ids[as_bytes] = self.byte_ids[np.frombuffer(raw, np.uint8)]
        ids[~as_bytes] = symbol[~single_char]
        ends = np.cumsum(counts)
        at = 4 * np.append(0, ends)[np.searchsorted(start, np.append(starts, len(points)))]
        flat, bounds = ids.tobytes(), at.tolist()
        return [flat[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def _words(self, text: str) -> Iterator[list[str]]:
        """The text's words, a bounded part of it at a time; nothing is merged over their edges."""
        text = SPACE + text.replace(" ", SPACE) if text else ""
        at, window = 0, WINDOW
        while at < len(text):
            words = self.words_of.findall(text, at, at + window)
            if at + window < len(text):
                words.pop()  # may go on behind the window
                if not words:
                    window *= 2
                    continue
            yield words
            at, window = (at + sum(map(len, words)) if at + window < len(text) else len(text)), WINDOW

    def _learn(self, words: Iterable[str]) -> None:
        if self.known_bytes > KEPT_BYTES:
            self.known.clear()
            self.known_bytes = 0
        new = [w for w in set(words) if w not in self.known]
        if new:
            ids = self._merged(new)
            self.known.update(zip(new, ids, strict=True))
            self.known_bytes += 160 * len(new) + 4 * sum(map(len, new)) + sum(map(len, ids))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit bytes, with begin and end ids."""
        begin, end = (np.array([i], "<u4").tobytes() for i in (self.begin, self.end))
        found = []
        for part in _parts(texts):
            # The words of all texts but very long ones are learned together, and looked up before they may go.
            short = [list(chain.from_iterable(self._words(text))) if len(text) < WINDOW else None for text in part]
            self._learn(chain.from_iterable(filter(None, short)))
            joined = [None if words is None else b"".join(map(self.known.__getitem__, words)) for words in short]
            for text, ids in zip(part, joined, strict=True):
                if ids is None:
                    blocks = []
                    for words in self._words(text):
                        self._learn(words)
                        blocks.append(b"".join(map(self.known.__getitem__, words)))
                    ids = b"".join(blocks)
                found.append(begin + ids + end)
        return found

    # --- decoding -----------------------------------------------------------------------------------

    def decode(self, ids: bytes) -> str:
        """The text of ids given as little-endian 32-bit bytes.

        A run of byte pieces reads as UTF-8, each byte that is none as U+FFFD. Begin and end are silent and part runs,
        and the mark that encoding puts before a text goes.
        """
        numbers = np.frombuffer(ids, "<u4").tolist()
        while numbers and numbers[-1] in self.silent:
            numbers.pop()
        start = next((k for k, i in enumerate(numbers) if i not in self.silent), 0)
        runs = [numbers[start:]] if numbers else []
        if not self.silent.isdisjoint(numbers[start:]):
            runs = [list(run) for silent, run in groupby(numbers, self.silent.__contains__) if not silent]
        texts = [b"".join([self.text[i] for i in run]) for run in runs]
        if runs and runs[0][0] in self.marked:
            texts[0] = texts[0][1:]
        return "".join([text.decode("utf-8", "each_byte_replaced") for text in texts])


def _parts(texts: list[str]) -> Iterator[list[str]]:
    """The texts in bounded parts, in order."""
    part: list[str] = []
    for text, so_far in zip(texts, accumulate(map(len, texts)), strict=True):
        part.append(text)
        if so_far // PART_BYTES > (so_far - len(text)) // PART_BYTES:
            yield part
            part = []
    if part:
        yield part


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encoded(docs: DataFrame, model: str, decode: bool = False) -> DataFrame:
    """``doc_id, n_tokens, token_ids``, the ids as little-endian 32-bit bytes with begin and end; ``decode`` adds
    ``decoded``, the text that the ids give.

    A row gives a row wherever it stands: nothing is shuffled, and a task holds a bounded part of an Arrow batch.
    A NULL text counts as empty: begin and end alone. A NULL ``doc_id`` and repeated rows stay. No rows give none.
    Other columns are not read. A text of any length is taken whole, a window of its words at a time.
    """
    schema = "doc_id long, n_tokens long, token_ids binary" + (", decoded string" if decode else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(model)
        names = [field.split()[0] for field in schema.split(", ")]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                ids = vocabulary.encode([text or "" for text in rows.column(1).to_pylist()])
                counts = pa.array([len(i) // 4 for i in ids], pa.int64())
                columns = [rows.column(0), counts, pa.array(ids, pa.binary())]
                if decode:
                    columns.append(pa.array(map(vocabulary.decode, ids), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "text").mapInArrow(run, schema)


def decoded(tokens: DataFrame, model: str) -> DataFrame:
    """``doc_id, decoded`` from ``doc_id, token_ids``; NULL ids give NULL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(model)
        for batch in batches:
            texts = (None if ids is None else vocabulary.decode(ids) for ids in batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "decoded"])

    return tokens.selectExpr("cast(doc_id AS long) AS doc_id", "token_ids").mapInArrow(run, "doc_id long, decoded string")

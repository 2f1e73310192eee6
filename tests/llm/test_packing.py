import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from msgstream.llm import packing, registry
from msgstream.llm.common import table

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def expected(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def check(tokenizer, texts, rows):
    """Every id lies in one piece, sequences are gapless and within capacity."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert pieces.keys() == texts.keys()
    for doc_id, own in pieces.items():
        ids, at = expected(tokenizer, texts[doc_id]), 0
        for r in sorted(own, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    return len(sequences) * 2048 / sum(r.length for r in rows) - 1


def test_query_against_whole_texts(spark, tokenizer):
    texts = dict(table(spark, SF, "documents").select("doc_id", "text").collect())
    padding = check(tokenizer, texts, registry.op6_cost_balanced_packing(spark, SF).collect())
    assert padding < 0.02


def test_odd_rows(docs, tokenizer):
    texts = {1: None, 2: "", 3: "word " * 30_000, 4: "a\nb\r\n c\t d", 5: "İ<|endoftext|>O'Neil's x", 6: "don't stop"}
    check(tokenizer, texts, registry.packed(docs(list(texts.items()))).collect())


def test_repeated_rows_and_no_rows(docs):
    assert sorted(r.doc_id for r in registry.packed(docs([(1, "a"), (1, "a"), (None, "b")])).collect() if r.doc_id) == [1, 1]
    assert registry.packed(docs([])).collect() == []


def test_ids_by_pieces_are_those_of_the_tokenizer(tokenizer):
    rng, known = random.Random(3), packing.ChunkIds(PATH)
    letters = list("abcXYZ'’.,!?%&  \n\t\r0123éÉßÿÀİıΣσςДд中文́̈  ​\x1f🙂<|>st")
    extra = ["'s", "'ll", "<|endoftext|>", "ﬁ", "é", "O'Neil's", "''s", "N'T", "ÀB'RE"]
    for _ in range(3000):
        text = "".join(rng.choice(letters if rng.random() < 0.8 else extra) for _ in range(rng.randint(0, 30)))
        assert known.encode([text])[0] == expected(tokenizer, text)[:-1].tobytes(), repr(text)


def test_cost_is_balanced():
    lengths = np.array([900] * 20 + [100] * 100)
    placed = packing.balanced(lengths, 2048, 1.0, 1 / 1024)
    assert sum(length for _, _, length, _ in placed) == lengths.sum()
    cost = np.zeros(-(-lengths.sum() // 2048))
    for _, _, length, sequence in placed:
        cost[sequence] += length + length * length / 1024
    assert cost.max() / cost.mean() < 1.25


def test_bounded_blocks_leave_little_room(docs, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_DOCS", 40)
    from conftest import text

    texts = {i: text(i, 40 + 37 * i % 3000) for i in range(100)}
    assert check(tokenizer, texts, registry.packed(docs(list(texts.items())).coalesce(1)).collect()) < 0.1


def test_a_worker_remembers_few_words_and_finds_them_again(tokenizer, monkeypatch):
    """However many words pass, memory stays bounded, and words of an earlier generation give the same ids."""
    monkeypatch.setattr(packing, "CHUNKS_KEPT", 50)
    monkeypatch.setattr(packing, "WORDS_KEPT", 40)
    known = packing.ChunkIds(PATH)
    for i in range(60):
        text = " ".join([f"Often{chr(97 + k)}," for k in range(5)] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + k)}." for k in range(10)])
        assert known.encode([text])[0] == expected(tokenizer, text)[:-1].tobytes()
        assert len(known.chunks) + len(known.earlier_chunks) <= 2 * (50 + 32) and len(known.words) + len(known.earlier_words) <= 2 * (40 + 16)


def test_a_worker_collects_garbage_after_its_packing(docs, spark):
    registry.packed(docs([(i, "a b") for i in range(8)])).collect()

    def run(batches):
        import gc

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"on": [gc.isenabled()] * batch.num_rows})

    assert all(r.on for r in spark.range(8).mapInArrow(run, "on boolean").collect())


def test_a_worker_keeps_no_words_after_its_packing(docs, spark):
    """What a step remembers is not there any more beside the next one's memory."""
    registry.packed(docs([(i, f"some words, {chr(97 + i)} жук") for i in range(8)])).collect()

    def run(batches):
        for batch in batches:
            known = packing.chunk_ids(PATH)
            left = sum(map(len, (known.chunks, known.words, known.earlier_chunks, known.earlier_words)))
            yield pa.RecordBatch.from_pydict({"left": [left] * batch.num_rows})

    assert {r.left for r in spark.range(8).mapInArrow(run, "left long").collect()} == {0}


def test_long_words_are_encoded_but_not_remembered(tokenizer):
    known = packing.ChunkIds(PATH)
    texts = [f"{'ab' * 300}, {'жук' * 300} a.{'x' * 300}", "", "short words", "\n".join(["İ", "a\tb", "naïvé", "É!", "", "ß"])]
    for part in (texts, pa.array([*texts, None, *texts]).slice(2)):
        own = part if isinstance(part, list) else part.to_pylist()
        assert known.encode(part) == [expected(tokenizer, text)[:-1].tobytes() for text in own]
    assert {"short", "words"} <= known.words.keys() and max(map(len, [*known.words, *known.chunks])) < 300


def test_groups_follow_rows_however_many_are_encoded_at_once(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_DOCS", 3)
    texts = [None if i % 7 == 0 else f"w{chr(97 + i % 26)} " * (i % 5) for i in range(32)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(40)), "text": ["x"] * 8 + texts}).slice(8)
    for docs_at_once, bytes_at_once in ((3, 1 << 20), (12, 1 << 20), (12, 40), (12, 0)):
        monkeypatch.setattr(packing, "CALL_DOCS", docs_at_once)
        monkeypatch.setattr(packing, "CALL_BYTES", bytes_at_once)
        groups = list(packing.encoded_groups(batch, packing.ChunkIds(PATH)))
        assert [len(ids) for ids, _ in groups] == [3] * 10 + [2] and sum((ids for ids, _ in groups), []) == list(range(8, 40))
        assert sum((new for _, new in groups), []) == [expected(tokenizer, text)[:-1].tobytes() for text in texts]

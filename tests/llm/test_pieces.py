"""Ids and texts against the library's own, exactly."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from msgstream.llm import pieces, registry
from msgstream.llm.common import table

PATH = public_tokenizers.path(registry.PIECE_MODEL)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Pieces(PATH)


def same(vocabulary, library, texts):
    ids = vocabulary.encode(texts)
    wanted = library.encode(texts, add_bos=True, add_eos=True)
    assert [np.frombuffer(i, "<u4").tolist() for i in ids] == wanted
    assert [vocabulary.decode(i) for i in ids] == [library.decode(w) for w in wanted]


def test_query_equals_library(spark, library):
    rows = {r.doc_id: r for r in registry.op11_sentencepiece_rounds(spark, SF).collect()}
    docs = table(spark, SF, "documents").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        ids = library.encode(doc.text or "", add_bos=True, add_eos=True)
        row = rows[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_random_texts(vocabulary, library):
    rng = random.Random(5)
    signs = "aaaabbttthheee  ▁▁  \n\t123éßñ日本語中文한국어🙂\x00<>0xÁ‍"
    same(vocabulary, library, ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(4000)])
    names = list(vocabulary.symbols)
    same(vocabulary, library, ["".join(rng.choices(names, k=rng.randint(1, 30))) for _ in range(3000)])


def test_pairs_that_overlap_or_tie(vocabulary, library):
    """Runs of one letter, and of spaces, whose pieces all have one score; short in rounds, long by the queue."""
    same(vocabulary, library, ["a" * n for n in range(200)] + ["ha" * n for n in range(100)] + ["=" * n for n in range(200)])
    same(vocabulary, library, [" " * n + "word" + " " * (n // 2) for n in range(0, 700, 13)])
    same(vocabulary, library, [" " * n + "w" for n in range(40)])


def test_very_long_texts(vocabulary, library):
    rng = random.Random(1)
    unbroken = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=60_000))
    same(vocabulary, library, [unbroken, "日本" * 50_000, " " * 60_000, "some words " * 250_000, "x" * 1_200_000])


def test_rounds_equal_the_queue(vocabulary):
    rng = random.Random(3)
    for _ in range(200):
        word = "".join(rng.choices("thea ▁s", k=rng.randint(2, 40)))
        symbols = vocabulary.of_char[[ord(c) for c in word]]
        merged = vocabulary._queued(symbols)[1]
        expected = np.frombuffer(vocabulary._merged([word])[0], "<u4")
        if (merged >= 0).all() and (merged < vocabulary.pieces).all():
            assert merged.tolist() == expected.tolist()


def test_any_ids_decode_as_in_the_library(vocabulary, library):
    rng = random.Random(9)
    for _ in range(5000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), rng.randrange(3)]) for _ in range(rng.randint(0, 8))]
        assert vocabulary.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids)


def test_a_worker_that_forgets_gives_the_same(library, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_BYTES", 1000)
    monkeypatch.setattr(pieces, "PART_BYTES", 500)
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choices("abcde", k=4)) for _ in range(rng.randint(0, 200))) for _ in range(60)]
    same(pieces.Pieces(PATH), library, texts)
    monkeypatch.setattr(pieces, "WINDOW", 16)
    same(pieces.Pieces(PATH), library, texts)


def test_odd_rows(docs, library):
    rows = [(1, "a b"), (2, None), (3, ""), (None, "x  y "), (1, "a b"), (4, " ")]
    given = docs(rows).withColumns({"token_ids": F.lit("clash"), "n_tokens": F.lit(1), "decoded": F.lit("clash")})
    found = pieces.encoded(given, PATH, decode=True)
    assert found.columns == ["doc_id", "n_tokens", "token_ids", "decoded"]
    got = sorted(((r.doc_id or 0, r.decoded, r.n_tokens) for r in found.collect()))
    ids = [library.encode(t or "", add_bos=True, add_eos=True) for _, t in rows]
    assert got == sorted((i or 0, t or "", len(n)) for (i, t), n in zip(rows, ids, strict=True))
    again = pieces.decoded(found, PATH).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in again) == sorted((i or 0, t or "") for i, t in rows)
    assert pieces.encoded(docs([]), PATH).collect() == []
    none = found.select("doc_id", F.lit(None).cast("binary").alias("token_ids"))
    assert {r.decoded for r in pieces.decoded(none, PATH).collect()} == {None}

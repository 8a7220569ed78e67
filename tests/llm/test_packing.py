import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from lexmill.llm import packing
from tests.llm import cases

PATH, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["", " ", "  ", "a  b", " a", "a ", "a \nb", "a\n\nb", "\n", "it's 'tis don't", "x<|endoftext|>y", "a\tb", "a\r\nb", "12,345.6 %% 日本語 é", "a b", "\x1cab"]


def library_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("ranks", [None, RANKS])
def test_ids_are_the_librarys(ranks):
    encoder = packing.Encoder(PATH, ranks)
    for t in [*(t or "" for t in cases.texts()), *ODD]:
        assert np.frombuffer(encoder.text(t), "<u4").tolist() == library_ids(t), t


def test_pieces_and_places(spark):
    df = cases.frame(spark)
    rows = packing.pack(packing.token_pieces(df, PATH, capacity=64, ranks_path=RANKS), capacity=64).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for d in df.collect():
        ids = [*library_ids(d.text or ""), 2]
        own = sorted(by_doc[d.doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(ids)
        assert all(r.length == 64 for r in own[1:]) and [r.start for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        at = 0
        for r in own:
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert len(by_sequence) <= -(-sum(r.length for r in rows) // 64) * 1.05 + 1


def test_supersteps_place_every_piece():
    rng = random.Random(2)
    counts = {}
    for _ in range(3000):
        n = min(100, 1 + int(rng.expovariate(0.04)))
        counts[n] = counts.get(n, 0) + 1
    fill, ranks = {}, {}
    for length, rank, m, first, offset in packing.supersteps(counts, 100):
        assert ranks.get(length, 0) == rank
        ranks[length] = rank + m
        for s in range(first, first + m):
            assert fill.get(s, 0) == offset
            fill[s] = offset + length
            assert fill[s] <= 100
    assert ranks == counts
    assert len(fill) <= -(-sum(k * n for k, n in counts.items()) // 100) * 1.02


def test_empty_and_repeated(spark):
    assert packing.pack(packing.token_pieces(cases.empty(spark), PATH)).count() == 0
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "doc_id long, text string")
    rows = packing.pack(packing.token_pieces(df, PATH)).collect()
    assert len(rows) == 3 and len({(r.sequence_id, r.offset) for r in rows}) == 3

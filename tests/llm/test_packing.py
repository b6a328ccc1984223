import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from fixtures import PROSE, awkward, docs_of, nothing
from gaugeworks.llm import packing
from gaugeworks.llm.packing import WordTokens, pack, placement, public_vocabulary, shortest_pack_first

public_tokenizers = pytest.importorskip("public_tokenizers")

TEXTS = [
    "", None, " \n", "a<|endoftext|>b", "A<|ENDOFTEXT|>b", "It's we'll 12345 x\x1cy é É ́a Σας ΑΣ İstanbul don't,",
    "!!.,;; <| |>", "\x85a\x85", "a, É. ÀB,c ªb, ß! ǅx. x.́ é. é", PROSE * 40, "日本語 テスト", "tab\tand\x0bmore",
]


def encode(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_vocabulary())
    return [[*t.encode(x or "", add_special_tokens=False).ids, 2] for x in texts]


@pytest.mark.parametrize("memory", [10**6, 1])
def test_word_tokens_equal_the_tokenizer(memory):
    tokens = WordTokens(public_vocabulary(), cache_words=memory)
    assert [x.tolist() for x in tokens(pa.array(TEXTS, pa.string()))] == encode(TEXTS)
    assert [x.tolist() for x in tokens(pa.array(TEXTS, pa.string()).slice(3, 5))] == encode(TEXTS[3:8])


def test_patterns_hold_every_piece_once():
    r = random.Random(4)
    for _ in range(20):
        size = r.choice([8, 32, 100])
        histogram = {r.randint(1, size): r.randint(1, 60) for _ in range(r.randint(1, 20))}
        patterns = shortest_pack_first(histogram, size)
        used = Counter()
        for pattern, n in patterns:
            assert n > 0 and sum(pattern) <= size
            used.update({k: v * n for k, v in Counter(pattern).items()})
        assert used == histogram
        base, starts, ids, offsets = placement(histogram, size)
        filled = {}
        for length, n in histogram.items():
            for rank in range(n):
                k = base[length] + rank
                e = np.searchsorted(starts, k, side="right") - 1
                filled.setdefault(int(ids[e] + k - starts[e]), []).append((int(offsets[e]), length))
        assert sorted(filled) == list(range(sum(n for _, n in patterns)))
        for places in filled.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length


def test_longest_first_into_the_emptiest_pack():
    assert dict(shortest_pack_first({6: 2, 4: 1, 2: 2}, 10)) == {(6, 4): 1, (6, 2, 2): 1}


@pytest.mark.parametrize("sequence, block_bits", [(4096, 16), (64, 1)])
def test_awkward_rows(spark, monkeypatch, sequence, block_bits):
    monkeypatch.setattr(packing, "BLOCK_BITS", block_bits)
    docs = awkward(spark)
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = pack(docs, sequence=sequence).collect()
    want = Counter()
    for (doc_id, _), ids in zip(texts, encode([t for _, t in texts])):
        for start in range(0, len(ids), sequence):
            piece = np.array(ids[start : start + sequence], dtype="<u4")
            want[doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(by) == list(range(len(by)))
    for places in by.values():
        places.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and places[0][0] == 0
        assert sum(n for _, n in places) <= sequence


def test_little_padding(spark):
    docs = docs_of(spark, [(i, "word " * (37 * i % 1900)) for i in range(800)])
    got = pack(docs).collect()
    assert sum(r.length for r in got) / (4096 * len({r.sequence_id for r in got})) > 0.97


def test_empty(spark):
    assert pack(nothing(spark)).count() == 0

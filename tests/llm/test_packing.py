import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from seriesforge.llm import packing
from tests.llm.fixtures import TEXTS, documents, edge_documents, empty_documents, frame, rows

PATH = packing.default_tokenizer()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_word_ids_equal_the_tokenizer(tokenizer):
    words, rng = packing.WordIds(PATH, most=50), random.Random(3)
    parts = list("aZé'st 1²½.,!<|>\n\t\x0b\xa0_-ßÀ×÷ª\x85 ") + ["<|endoftext|>", "'re", "'ll", "日本", "é", "İ", "Σ", "ς", "  ", "don't"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert words.ids(t) == packing.pack_ids(tokenizer.encode(t, add_special_tokens=False).ids), repr(t)


def expected_pieces(tokenizer, pairs):
    out = []
    for i, t in pairs:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            own = ids[at : at + 4096]
            out.append((i, piece, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    return sorted(out, key=repr)


def check(got, expected, limit=4096):
    assert sorted((r[:5] for r in got), key=repr) == expected
    bins = {}
    for _, _, _, length, _, sequence, offset in got:
        bins.setdefault(sequence, []).append((offset, length))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= limit
    return len(bins)


def test_documents(spark, tokenizer):
    data = frame(spark, "/root/testdata/sf0.01")
    expected = expected_pieces(tokenizer, zip(data.doc_id.tolist(), data.text))
    bins = check(rows(packing.pack_documents(documents(spark, "/root/testdata/sf0.01"))), expected)
    least = -(-sum(x[3] for x in expected) // 4096)
    assert bins <= least * 1.005 + 1


def test_edges_and_empty_table(spark, tokenizer):
    check(rows(packing.pack_documents(edge_documents(spark))), expected_pieces(tokenizer, TEXTS))
    assert rows(packing.pack_documents(empty_documents(spark))) == []


def test_many_groups_are_pooled(spark, tokenizer):
    data = frame(spark)
    cut = packing.pieces(documents(spark)).cache()
    expected = expected_pieces(tokenizer, zip(data.doc_id.tolist(), data.text))
    few, many = (check(rows(packing.pack(cut, group_rows=n)), expected) for n in (20_000, 25))
    assert many <= few * 1.05 + 1


@pytest.mark.parametrize("seed", range(4))
def test_local_search_empties_bins_where_best_fit_leaves_room(seed):
    lengths = np.random.default_rng(seed).integers(900, 1900, 800)
    before = packing.best_fit(lengths, 4096)
    after = packing.local_search(lengths, before, 4096)
    assert sorted(i for b in after for i in b) == list(range(800))
    assert max(lengths[b].sum() for b in after) <= 4096
    assert len(after) < len(before)


def test_exchanges_empty_a_bin():
    # 60+30, 50+40 and 10+10 of 100: best fit would not need it, the given bins do.
    lengths = np.array([60, 30, 50, 40, 10, 10])
    assert len(packing.local_search(lengths, [[0, 1], [2, 3], [4, 5]], 100)) == 2
    # One for one: 45 against 40, then 5 moves.
    lengths = np.array([55, 40, 45, 5])
    assert len(packing.local_search(lengths, [[0, 1], [2], [3]], 100)) == 2

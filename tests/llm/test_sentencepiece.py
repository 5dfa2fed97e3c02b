import random
import time
import zlib

import pytest

from seriesforge.llm import sentencepiece_viterbi as sv
from tests.llm.fixtures import TEXTS, documents, edge_documents, empty_documents, frame, rows


@pytest.fixture(scope="module")
def pieces():
    return sv.Pieces.load(sv.default_model())


def plain(p, s):
    """Viterbi over the whole text at once."""
    best, back = [0.0] + [float("-inf")] * len(s), [0] * (len(s) + 1)
    for end in range(1, len(s) + 1):
        for start in range(max(0, end - p.longest), end):
            score = p.scores.get(s[start:end], p.fallback if end - start == 1 else None)
            if score is not None and best[start] + score > best[end]:
                best[end], back[end] = best[start] + score, start
    out, end = [], len(s)
    while end:
        out.append(s[back[end] : end])
        end = back[end]
    return [i for q in reversed(out) for i in ([p.ids[q]] if q in p.ids else [p.bytes[b] for b in q.encode()])]


def test_streaming_equals_the_whole_search(pieces):
    rng, encoder = random.Random(2), sv.Encoder(pieces)
    for _ in range(800):
        t = "".join(rng.choice(["a", "the", " ", "  ", "er", "ing", "😀", "日", "é", "\n", "x", "▁", "qqqq", "00"]) for _ in range(rng.randint(0, 40)))
        marked = "▁" + t.replace(" ", "▁") if t else ""
        expected = plain(pieces, marked)
        search, out = sv.StreamingViterbi(pieces), []
        for c in marked:
            out += search.feed(c)
        assert out + search.finish() == expected == sv.viterbi(pieces, marked) == memoryview(encoder.encode(t)).cast("I").tolist()
        assert sv.decode(pieces, expected) == t.replace("▁", " ")


def test_words_are_searched_without_the_stream(pieces, monkeypatch):
    rng = random.Random(5)
    words = ["▁" + "".join(rng.choice(["a", "er", "ing", "😀", "日", "é", "\n", "q", "0", "=", "\ud800"]) for _ in range(rng.randint(0, 30))) for _ in range(600)]
    streamed = [sv.viterbi(pieces, w) for w in words]
    monkeypatch.setattr(sv, "viterbi", None)
    assert [memoryview(sv.Encoder(pieces)[w]).cast("I").tolist() for w in words] == streamed


def test_the_window_stays_bounded(pieces):
    search, n = sv.StreamingViterbi(pieces), 0
    for _ in range(2000):
        n += len(search.feed("theerinaaaaaaab" * 4))
    assert n and search.widest < 12 * pieces.longest


@pytest.mark.parametrize("period", ["a", " ", "ab", "▁x", "\n", "=-"])
def test_runs_of_a_period_take_linear_time(pieces, period):
    run = "▁" + (period * 4000).replace(" ", "▁")
    assert sv.viterbi(pieces, run) == plain(pieces, run)
    seconds = []
    for n in (100_000, 1_000_000):
        start = time.perf_counter()
        found = sv.viterbi(pieces, (period * (n // len(period))).replace(" ", "▁"))
        seconds.append(time.perf_counter() - start)
        assert found
    assert seconds[1] < 30 * max(seconds[0], 0.1), seconds


def test_round_trip_of_documents(spark, pieces):
    data = frame(spark).set_index("doc_id").text
    got = rows(sv.round_trip(documents(spark)))
    assert len(got) == len(data)
    for i, n, crc, decoded, exact in got[:25]:
        ids = plain(pieces, "▁" + data[i].replace(" ", "▁")) if data[i] else []
        assert n == len(ids) and crc == zlib.crc32(b"".join(k.to_bytes(4, "little") for k in ids))
    assert all(exact and decoded == zlib.crc32((data[i] or "").encode()) for i, _, _, decoded, exact in got)


def test_encode_then_decode(spark):
    encoded = sv.encode_documents(edge_documents(spark))
    assert rows(sv.decode_documents(encoded)) == sorted(((i, t or "") for i, t in TEXTS), key=repr)
    unknown = spark.createDataFrame([(1, None), (2, [99_999_999, 0, 1])], "doc_id long, ids array<int>")
    assert rows(sv.decode_documents(unknown)) == [(1, ""), (2, "")]


def test_edges_and_empty_table(spark):
    got = rows(sv.round_trip(edge_documents(spark)))
    assert len(got) == len(TEXTS) and all(r[4] for r in got)
    assert {r[1:] for r in got if r[0] in (1, 2, 13)} == {(0, 0, 0, True)}
    assert rows(sv.round_trip(empty_documents(spark))) == []

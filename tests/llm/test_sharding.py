import zlib
from collections import defaultdict

from seriesforge.llm import sharding
from tests.llm.fixtures import TEXTS, documents, edge_documents, empty_documents, frame, rows


def check(got, pairs, shards, spread):
    size = lambda t: len((t or "").encode()) + 16
    assert sorted((r[:3] for r in got), key=repr) == sorted(((i, size(t), zlib.crc32((t or "").encode())) for i, t in pairs), key=repr)
    held, slots = defaultdict(int), defaultdict(list)
    for _, n, _, law, shard, slot, grown in got:
        assert law == "bytes" and grown is None and 0 <= shard < shards
        held[shard] += n
        slots[shard].append(slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(held.values()) / shards
    assert max(held.values()) - mean <= spread and mean - min(held.get(k, 0) for k in range(shards)) <= spread


def test_documents(spark):
    data = frame(spark, "/root/testdata/sf0.01")
    got = rows(sharding.shard_documents(documents(spark, "/root/testdata/sf0.01")))
    largest = max(len((t or "").encode()) for t in data.text)
    check(got, list(zip(data.doc_id.tolist(), data.text)), 40, largest)


def test_small_copies_stay_together_and_large_groups_are_dealt_out(spark):
    texts = [f"text number {k} " * (1 + k % 7) for k in range(3000)]
    pairs = [(k, t) for k, t in enumerate(texts)] + [(3000 + k, texts[k]) for k in range(0, 3000, 10)] + [(10_000 + k, "hot " * 20) for k in range(3000)]
    docs = spark.createDataFrame([(i, t, "en", f"src{i % 9}") for i, t in pairs], "doc_id long, text string, lang string, source string")
    got = rows(sharding.shard_documents(docs, shards=7, part=1 / 32))
    total = sum(r[1] for r in got)
    check(got, pairs, 7, total / 7 * 0.06)
    where = {r[0]: r[4] for r in got}
    assert all(where[k] == where[3000 + k] for k in range(0, 3000, 10))
    assert len({where[10_000 + k] for k in range(3000)}) > 1


def test_copies_that_share_one_id_or_have_none_are_dealt_out(spark):
    pairs = [(5, "hot " * 20)] * 1500 + [(None, "cold " * 16)] * 1500 + [(100 + k, f"text {k} " * 9) for k in range(300)]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in pairs], "doc_id long, text string, lang string, source string")
    got = rows(sharding.shard_documents(docs, shards=5, part=1 / 32))
    check(got, pairs, 5, sum(r[1] for r in got) / 5 * 0.08)
    assert len({r[4] for r in got if r[0] == 5}) > 1 and len({r[4] for r in got if r[0] is None}) > 1


def test_edges_and_empty_table(spark):
    check(rows(sharding.shard_documents(edge_documents(spark), shards=3)), TEXTS, 3, 200_000)
    assert rows(sharding.shard_documents(empty_documents(spark))) == []


def test_missing_metadata(spark):
    docs = edge_documents(spark).select("doc_id", "text")
    assert len(rows(sharding.shard_documents(docs, shards=4))) == len(TEXTS)

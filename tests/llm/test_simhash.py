import numpy as np
import xxhash

from seriesforge.llm import simhash
from seriesforge.llm.components import connected_components
from tests.llm.fixtures import TEXTS, documents, edge_documents, empty_documents, frame, rows


def slow_print(t):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def expected(pairs):
    ids = [i for i, _ in pairs]
    prints = np.array([slow_print(t) for _, t in pairs], np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints) <= 4
    label = np.array([np.inf if i is None else i for i in ids])
    while True:
        new = np.array([label[near[k]].min() for k in range(len(ids))])
        if (new == label).all():
            break
        label = new
    label = [None if x == np.inf else int(x) for x in label]
    return sorted(((i, f"{int(p):016x}", c, i == c) for i, p, c in zip(ids, prints, label)), key=repr)


def test_edges(spark):
    assert rows(simhash.simhash_components(edge_documents(spark))) == expected(TEXTS)


def test_empty_table(spark):
    assert rows(simhash.simhash_components(empty_documents(spark))) == []


def test_documents(spark):
    data = frame(spark)
    assert rows(simhash.simhash_components(documents(spark))) == expected(list(zip(data.doc_id.tolist(), data.text)))


def clusters(seed=3):
    """Dense clusters a few bits wide, bit 63 included, and strangers."""
    rng = np.random.default_rng(seed)
    out = set()
    for base in rng.integers(0, 2**64, 12, dtype=np.uint64):
        for _ in range(60):
            x = int(base)
            for b in rng.choice([*range(8), 63], rng.integers(0, 7)):
                x ^= 1 << int(b)
            out.add(x)
    out |= {int(x) for x in rng.integers(0, 2**64, 300, dtype=np.uint64)}
    return np.array(sorted(out), np.uint64)


def slow_components(prints):
    near = np.bitwise_count(prints[:, None] ^ prints) <= 4
    label = np.arange(len(prints))
    while True:
        new = np.array([label[near[k]].min() for k in range(len(prints))])
        if (new == label).all():
            return label
        label = new


def test_links_whatever_the_blocks_and_the_cut_of_hot_keys(spark):
    prints = clusters()
    signed = prints.view(np.int64)
    label = slow_components(prints)
    nodes = spark.createDataFrame([(int(x),) for x in signed], "fp long")
    from pyspark.sql import functions as F

    table = F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(int(r)))).cast("short") for r in simhash.REFERENCES])
    nodes = nodes.withColumn("table", table).cache()
    for n, cap in ((len(prints), 2048), (len(prints), 7), (10**9, 2048)):
        edges = simhash.near_edges(nodes, n, run_cap=cap)
        pairs = [(r.a, r.b) for r in edges.distinct().collect()]
        at = {int(x): k for k, x in enumerate(signed)}
        parent = list(range(len(prints)))

        def root(k):
            while parent[k] != k:
                k = parent[k]
            return k

        for a, b in pairs:
            assert int(prints[at[a]] ^ prints[at[b]]).bit_count() <= 4
            parent[max(root(at[a]), root(at[b]))] = min(root(at[a]), root(at[b]))
        assert [root(k) for k in range(len(prints))] == label.tolist()


def test_every_choice_of_blocks_finds_a_pair():
    for m in range(5, 11):
        masks = simhash.key_masks(m)
        rng = np.random.default_rng(m)
        for _ in range(200):
            bits = rng.choice(64, 4, replace=False)
            diff = sum(1 << int(b) for b in bits)
            assert any(diff & (mask % 2**64) == 0 for mask in masks)


def test_components_of_a_path_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(100, 400)] + [(5, k) for k in range(6, 60)] + [(600 + i, 600 + (i + 1) % 50) for i in range(50)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges + [(5, 5)], "a long, b long")).collect())
    assert got == {k: 100 for k in range(100, 401)} | {k: 5 for k in range(5, 60)} | {k: 600 for k in range(600, 650)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_copies_go(spark):
    docs = edge_documents(spark)
    left = simhash.drop_near_copies(docs)
    assert left.columns == docs.columns
    kept = {i for i, _, _, stays in expected(TEXTS) if stays}
    assert {r.doc_id for r in left.collect()} == kept


def test_a_row_goes_by_its_own_decision(spark):
    texts = [(1, "one text kept here"), (2, "one text kept here"), (2, "quite another story of its own"),
             (None, "one text kept here"), (None, "a row without an id"), (3, None)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in texts], "doc_id long, text string, `__id` string")
    left = simhash.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert rows(left) == sorted(((*texts[k], "clash") for k in (0, 2, 4, 5)), key=repr)

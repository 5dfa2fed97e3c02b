import numpy as np

from seriesforge.llm import embedding_dedup as ed
from tests.llm.fixtures import rows


def brute(ids, vectors):
    ok = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for v in vectors]
    n, good = len(ids), [k for k in range(len(ids)) if ok[k]]
    link = np.zeros((n, n), bool)
    for d in {len(vectors[k]) for k in good}:
        own = np.array([k for k in good if len(vectors[k]) == d])
        x = np.array([vectors[k] for k in own], float)
        x /= np.abs(x).max(1, keepdims=True)
        x /= np.linalg.norm(x, axis=1)[:, None]
        link[np.ix_(own, own)] = x @ x.T >= 0.95
    np.fill_diagonal(link, False)
    label = np.array([np.inf if i is None else i for i in ids])
    while True:
        new = np.array([min(label[k], label[link[k]].min(initial=np.inf)) for k in range(n)])
        if (new == label).all():
            break
        label = new
    label = [None if x == np.inf else int(x) for x in label]
    return sorted(((i, int(m), c, i == c) for i, m, c in zip(ids, link.sum(1), label)), key=repr)


def frame_of(spark, ids, vectors):
    data = [(i, v, 1, "clash", "clash") for i, v in zip(ids, vectors)]
    return spark.createDataFrame(data, "vec_id long, embedding array<double>, label int, e string, node string")


def test_groups_copies_and_odd_vectors(spark):
    rng, vectors = np.random.default_rng(0), []
    for b in rng.normal(size=(25, 16)):
        for _ in range(rng.integers(1, 14)):
            vectors.append((b + rng.normal(size=16) * rng.choice([0, 0.1, 0.2, 0.3])).tolist())
    vectors += [vectors[3]] * 40
    vectors += [None, [0.0] * 16, [float("nan")] * 16, [None] * 16, [], [1.0, 2.0], [2.0, 4.0], [1e200] * 16, [1e-200] * 16,
                [float("inf")] + [0.0] * 15, [-0.0] * 16]
    ids = [*range(100, 100 + len(vectors) - 2), None, None]
    got = rows(ed.embedding_links(frame_of(spark, ids, vectors), block=64, window=8))
    assert got == brute(ids, vectors)


def test_one_group_wider_than_windows_and_blocks(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=32)
    vectors = [(base + rng.normal(size=32) * s).tolist() for s in rng.uniform(0.02, 0.3, 700)]
    ids = list(range(700))
    x = np.array(vectors) / np.linalg.norm(vectors, axis=1)[:, None]
    members = spark.createDataFrame([(0, i, 1 + i % 3, v) for i, v in zip(ids, x.tolist())],
                                    "component long, vec_id long, times long, e array<double>")
    got = dict(tuple(r) for r in ed.count_links(members, 0.95, block=64).collect())
    link = x @ x.T >= 0.95
    np.fill_diagonal(link, False)
    assert got == dict(enumerate((link @ (1 + np.arange(700) % 3)).tolist()))


def test_recall_of_the_passes(spark):
    """Pairs near the threshold among many strangers: at least nine of ten connected."""
    rng, vectors = np.random.default_rng(9), []
    for _ in range(150):
        a = rng.normal(size=64)
        a /= np.linalg.norm(a)
        b = rng.normal(size=64)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        vectors += [a.tolist(), (0.955 * a + np.sqrt(1 - 0.955**2) * b).tolist()]
    vectors += rng.normal(size=(1200, 64)).tolist()
    ids = list(range(len(vectors)))
    got = {r[0]: r[1:] for r in rows(ed.embedding_links(frame_of(spark, ids, vectors)))}
    found = sum(got[2 * k + 1][1] == 2 * k for k in range(150))
    assert found >= 0.95 * 150
    assert all(got[k][0] == 0 for k in range(300, len(ids)))


def test_empty_table(spark):
    assert rows(ed.embedding_links(frame_of(spark, [], []))) == []


def dense(n=3000, pairs=60, seed=11):
    """Vectors at about cosine 0.8 to each other and, among them, lone pairs just above the threshold."""
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    base = unit(rng.normal(size=64))
    x = unit(np.sqrt(0.8) * base + np.sqrt(0.2) * unit(rng.normal(size=(n, 64))))
    b = rng.normal(size=(pairs, 64))
    b = unit(b - (b * x[:pairs]).sum(1, keepdims=True) * x[:pairs])
    return np.concatenate([x, 0.952 * x[:pairs] + np.sqrt(1 - 0.952**2) * b])


def test_lone_pairs_in_a_dense_region_are_found(spark):
    x = dense()
    ids = list(range(len(x)))
    got = rows(ed.embedding_links(frame_of(spark, ids, x.tolist())))
    link = x @ x.T >= 0.95
    assert link.sum() == len(x) + 120
    first = link.argmax(1).tolist()
    assert got == sorted(((k, int(m) - 1, f, f == k) for k, (m, f) in enumerate(zip(link.sum(1), first))), key=repr)


def test_passes_follow_the_rows_and_exact_blocks_miss_nothing(spark):
    assert ed.passes_for(1, 0.95, 1e-3) < ed.passes_for(15, 0.95, 1e-3) < ed.passes_for(40, 0.95, 1e-3)
    keys = np.sort(np.array([0, 1, 2, 3, 3, 3, -(2**62)], np.int64))
    assert ed.depths(keys, 1).tolist() == [1, 64, 64, 64, 65, 65, 65]
    x = dense(700, 40)
    vectors = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, e array<double>")
    parts = spark.createDataFrame([(k, 0) for k in range(300)], "node long, component long")
    got = {frozenset(r) for r in ed.exact_edges(vectors, parts, len(x), 0.95, 100).collect()}
    assert got == {frozenset((k, 700 + k)) for k in range(40)}

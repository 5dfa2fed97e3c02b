import hashlib
import re
from collections import defaultdict

import numpy as np

from seriesforge.llm import exact_dedup
from tests.llm.fixtures import TEXTS, documents, edge_documents, empty_documents, frame, rows


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def expected(pairs):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[norm(t)].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        stays = False
        for i in ids:
            kept = i == keep and not stays
            stays |= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_edges(spark):
    assert rows(exact_dedup.exact_dedup(edge_documents(spark))) == expected(TEXTS)


def test_empty_table(spark):
    assert rows(exact_dedup.exact_dedup(empty_documents(spark))) == []
    assert rows(exact_dedup.drop_copies(empty_documents(spark))) == []


def test_documents(spark):
    data = frame(spark)
    assert rows(exact_dedup.exact_dedup(documents(spark))) == expected(list(zip(data.doc_id.tolist(), data.text)))


def test_cuts_depend_on_content_only():
    data = np.random.default_rng(1).integers(97, 123, 300_000, dtype=np.uint8)
    whole = np.flatnonzero(exact_dedup.chunk_ends(data))
    moved = np.flatnonzero(exact_dedup.chunk_ends(np.r_[np.zeros(999, np.uint8), data])) - 999
    assert len(whole) > 30 and set(whole[whole > 32]) == set(moved[moved > 32])
    bounds = exact_dedup._bounds(np.zeros(0, np.int64), 0, 200_000)
    assert bounds == [0, 65_536, 131_072, 196_608, 200_000]


def test_colliding_identifiers_are_found(spark):
    weak = lambda data: bytes([len(data) % 2])
    got = rows(exact_dedup.exact_dedup(edge_documents(spark), (weak, *exact_dedup.DIGESTS)))
    assert got == expected(TEXTS)


def test_drop_copies_keeps_columns_and_one_row_a_group(spark):
    docs = edge_documents(spark)
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, norm(r.text)) for r in left.collect() if r.doc_id is not None) == sorted(
        (i, norm(next(t for j, t in TEXTS if j == i))) for i, _, _, kept, _ in expected(TEXTS) if kept and i is not None)
    assert sum(r.doc_id is None for r in left.collect()) == 1


def test_helper_columns_do_not_clash(spark):
    docs = spark.createDataFrame([(k, t, "mine", "mine") for k, t in [(1, "a"), (2, "a"), (3, "b"), (3, "b")]],
                                 "doc_id long, text string, `__id` string, `__sha` string")
    assert sorted(tuple(r) for r in exact_dedup.drop_copies(docs).collect()) == [(1, "a", "mine", "mine"), (3, "b", "mine", "mine")]

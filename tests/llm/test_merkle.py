"""The manifest against trees built by hand, whole tables and awkward ones."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from seriesforge.llm import catalog, merkle
from tests.llm.fixtures import SF, edge_documents, empty_documents
from tests.oracle import compare, connect

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text) -> str:
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def path(tree, i):
    out = []
    for level in tree[:-1]:
        start = i // 3 * 3
        out.append(("".join(level[start:i]), "".join(level[i + 1 : start + 3])))
        i //= 3
    return out


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        groups[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    trees = [levels([leaf(r, r["text"]) for r in groups[s]]) for s in names]
    top, out = levels([t[-1][0] for t in trees]), []
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            proof, text = path(trees[k], i) + path(top, k), r["text"]
            if text is not None and zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf(r, text)
            for left, right in proof:
                folded = h(left, folded, right)
            root = top[-1][0]
            out.append((r["doc_id"], trees[k][0][i], trees[k][-1][0], root, h(*[a + b for a, b in proof]), folded, folded == root))
    return sorted(out, key=repr)


def found(docs):
    return sorted(map(tuple, merkle.merkle_manifest(docs).collect()), key=repr)


def test_whole_table_against_trees_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = found(docs)
    assert got == brute(docs.collect())
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_whole_table_matches_sql(spark):
    assert compare(catalog.QUERIES["op11_merkle_manifest"](spark, SF), connect(SF), catalog.ORACLES["op11_merkle_manifest"]) is None


@pytest.mark.parametrize("per_source", [[1], [243], [2, 244, 3, 4], [1, 1, 1, 730], [5, 9, 27, 28]])
def test_sizes_around_every_border(spark, per_source):
    rows = [(k, f"s{s}", None, k, f"a\n{k}") for s, n in enumerate(per_source) for k in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert found(docs) == brute(docs.collect())


def test_many_sources_need_several_records_of_sources(spark):
    docs = spark.createDataFrame([(k, f"s{k % 260}", "en", 1, "x") for k in range(300)], SCHEMA)
    assert found(docs) == brute(docs.collect())


def test_nulls_repeats_and_clashing_columns(spark):
    docs = edge_documents(spark)
    assert found(docs) == brute(docs.collect())
    assert found(empty_documents(spark)) == []


def test_one_row_repeated_is_dealt_out(spark):
    docs = spark.createDataFrame([(1, "hot", "en", 3, "a\nb")] * 800 + [(None, None, None, None, None)], SCHEMA)
    assert found(docs) == brute(docs.collect())


def test_requests_open_only_the_way_they_go(spark):
    rows = [(k, "a" if k % 3 else None, None, k, "t") for k in range(900)]
    plain = spark.createDataFrame(rows, SCHEMA)
    leaves = merkle.materialize(plain.select("doc_id", "source", merkle.leaf_digest().alias("leaf")), "leaves")
    manifest = merkle.build(leaves)
    asked = spark.createDataFrame([("a", 7), ("a", 7), (None, 299), ("a", 600), ("nobody", 0)], "source string, at long")
    proofs = {(r["source"], r["at"]): r for r in merkle.prove(manifest, asked).collect()}
    assert set(proofs) == {("a", 7), (None, 299)}
    stored = {(r["source"], r["at"]): r["leaf"] for r in manifest.leaves.collect()}
    for key, r in proofs.items():
        digest = stored[key]
        for left, right in r["path"]:
            digest = h(left, digest, right)
        assert digest == manifest.root
    asked_all = merkle.prove(manifest, manifest.leaves)
    assert asked_all.where(merkle.fold(F.col("leaf"), F.col("path")) != manifest.root).count() == 0


def test_a_record_leads_from_its_digest_to_its_children(spark):
    plain = spark.createDataFrame([(k, "a", None, k, "t") for k in range(300)], SCHEMA)
    manifest = merkle.build(merkle.materialize(plain.select("doc_id", "source", merkle.leaf_digest().alias("leaf")), "leaves"))
    for records in manifest.trees.records:
        for r in records.collect():
            nodes = list(r["levels"][0])
            for above in [*r["levels"][1:], [r["digest"]]]:
                nodes = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
                assert nodes == list(above)

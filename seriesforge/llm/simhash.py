"""SimHash near-duplicates by pivot distance tables.

Every distinct fingerprint carries its Hamming distances to a fixed set of reference fingerprints.
By the triangle inequality two fingerprints within ``limit`` bits differ by at most ``limit`` in each
coordinate, so pairs are discarded by their largest coordinate difference and only survivors are
verified. Distances of unrelated 64-bit fingerprints crowd around 32, so a table alone can't keep a
cluster from comparing everything with everything. The rows are therefore dealt out by exact keys
first: of ``m`` bit blocks at least ``m - limit`` agree in any pair that links, and every choice of so
many blocks is a key. ``m`` only follows the number of fingerprints; each choice finds every link.

A task gets one key's fingerprints, links them into as few edges as connect them, and never writes
all pairs. Keys with more than ``run_cap`` fingerprints are cut into chunks and each pair of chunks is
a group of its own, so no key is gathered in one task and no pair is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import documents, materialize, settle, slices, text_of
from seriesforge.llm.components import connected_components

SEED, SHINGLE, LIMIT, PIVOTS, RUN_CAP = 42, 4, 4, 16, 2048

#: The reference fingerprints.
REFERENCES = np.random.default_rng(1601).integers(-(2**63), 2**63 - 1, PIVOTS, dtype=np.int64)


def fingerprint(text: str, words: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the word shingles, repeats included; 0 without any word."""
    tokens = text.encode("utf-8").lower().split()  # bytes: lowers A-Z and splits at ASCII space only
    if not tokens:
        return 0
    line = b" ".join(tokens)
    h64 = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        hashes = np.array([h64(line, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
        starts = [0, *ends[:-words].tolist()]
        hashes = np.array([h64(line[s:e], SEED) for s, e in zip(starts, (ends[words - 1 :] - 1).tolist())], np.uint64)
    n = len(hashes)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 65_536):
        bits = np.unpackbits(hashes[at : at + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(0, dtype=np.uint32)
    packed = np.packbits((counts * 2 > n).astype(np.uint8)).view(">u8")[0]
    return int(packed.astype(np.uint64).view(np.int64))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = [fingerprint(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"])


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, id, text) to (row, id, fingerprint in hex)."""
    for batch in slices(batches):
        found = [f"{fingerprint(t) % 2**64:016x}" for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())], ["row", "id", "fp"])


def block_count(n: int, limit: int = LIMIT, per_row: float = 16.0) -> int:
    """Fewest bit blocks whose keys give a fingerprint at most ``per_row`` chance companions."""
    for m in range(limit + 1, limit + 6):
        if n * comb(m, limit) / 2 ** (64 * (m - limit) / m) <= per_row:
            return m
    return limit + 6


def key_masks(m: int, limit: int = LIMIT) -> list[int]:
    """Signed masks of every choice of ``m - limit`` out of ``m`` blocks of bits."""
    edges = [round(64 * i / m) for i in range(m + 1)]
    blocks = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(blocks, m - limit)]
    return [x - 2**64 if x >= 2**63 else x for x in masks]


def _pairs_left(fp: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray, limit: int) -> np.ndarray:
    """Which pairs survive the pivot table and are within ``limit`` bits."""
    near = np.abs(table[i] - table[j]).max(1) <= limit
    near[near] = np.bitwise_count((fp[i[near]] ^ fp[j[near]]).view(np.uint64)) <= limit
    return near


def _forest(fp: np.ndarray, table: np.ndarray, side: np.ndarray, cross: bool, limit: int) -> list[tuple[int, int]]:
    """Edges (by index) that connect what links; with ``cross`` only pairs of different sides count."""
    comp, out = np.arange(len(fp)), []
    for i in range(len(fp) - 1):
        other = np.flatnonzero(comp[i + 1 :] != comp[i]) + i + 1
        if cross:
            other = other[side[other] != side[i]]
        if len(other):
            hit = other[_pairs_left(fp, table, np.full(len(other), i), other, limit)]
            if len(hit):
                joined, first = np.unique(comp[hit], return_index=True)
                out += [(i, int(j)) for j in hit[first]]
                comp[np.isin(comp, joined)] = comp[i]
    return out


def _links(limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by group to edges; a group that a batch ends in is carried to the next."""

    def edges(group: np.ndarray, cross: np.ndarray, side: np.ndarray, fp: np.ndarray, table: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]).any(1)])
        sizes = np.diff(np.r_[starts, len(group)])
        a, b = [], []
        for n in range(2, 9):  # the many small groups: all their pairs at once
            at = starts[(sizes == n) & ~cross[starts]]
            for x, y in combinations(range(n), 2) if len(at) else ():
                near = _pairs_left(fp, table, at + x, at + y, limit)
                a.append(fp[at[near] + x])
                b.append(fp[at[near] + y])
        for at, n in zip(starts, sizes):
            if n > 8 or n > 1 and cross[at]:
                own = slice(at, at + n)
                found = np.array(_forest(fp[own], table[own], side[own], bool(cross[at]), limit), np.int64).reshape(-1, 2)
                a.append(fp[own][found[:, 0]])
                b.append(fp[own][found[:, 1]])
        cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(cat(a)), pa.array(cat(b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            if not batch.num_rows:
                continue
            column = [np.asarray(batch.column(k)) for k in range(6)]
            own = [np.stack(column[:4], axis=1), column[2] != column[3], column[4], column[5],
                   np.asarray(batch.column(6).flatten()).reshape(batch.num_rows, -1)]
            kept = [np.concatenate(x) for x in zip(kept, own)] if kept else own
            last = np.flatnonzero((kept[0][:-1] != kept[0][-1]).any(1))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield edges(*[x[:cut] for x in kept])
                kept = [x[cut:] for x in kept]
        if kept:
            yield edges(*kept)

    return run


def near_edges(nodes: DataFrame, n: int, limit: int = LIMIT, run_cap: int = RUN_CAP) -> DataFrame:
    """Edges (a, b) that connect all fingerprints of ``nodes`` (fp, table) linked by ``limit`` bits or fewer."""
    masks = key_masks(block_count(n, limit), limit)
    keys = F.array(*[F.struct(F.lit(k).alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(masks)])
    index = nodes.select("fp", "table", F.explode(keys).alias("k")).select("k.c", "k.key", "fp", "table")
    sizes = index.groupBy("c", "key").count().where(F.col("count") > run_cap)
    hot = settle(sizes.select("c", "key", F.ceil(F.col("count") / run_cap).cast("int").alias("chunks")), "hot-keys")
    chunks = F.coalesce("chunks", F.lit(1))
    dealt = index.join(hot, ["c", "key"], "left").select(
        "c", "key", "fp", "table", chunks.alias("chunks"), F.pmod(F.xxhash64("fp"), chunks).cast("int").alias("side")
    )
    # A row of chunk s meets every chunk x in the group (min(s, x), max(s, x)).
    met = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("x"))
    groups = met.select(
        F.col("c").cast("long"), "key", F.least("side", "x").cast("long").alias("i"),
        F.greatest("side", "x").cast("long").alias("j"), F.col("side").cast("long"), "fp", "table",
    )
    sorted_ = groups.repartition("c", "key", "i", "j").sortWithinPartitions("c", "key", "i", "j", "fp")
    return sorted_.mapInArrow(_links(limit), "a long, b long")


def fingerprints(docs: DataFrame) -> DataFrame:
    return documents(docs).mapInArrow(_fingerprints, "doc_id long, fp long")


def simhash_components(docs: DataFrame, limit: int = LIMIT, run_cap: int = RUN_CAP) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint, component_id, kept.

    Null texts are empty; a text without a word has fingerprint zero and links like any other.
    A text of fewer than four words is one shingle. component_id is the smallest doc_id reachable
    over links; null ids count as larger than any, and a component of null ids only has null. kept:
    doc_id is component_id; rows that repeat this id all stay (exact dedup removes equal rows).
    Equal fingerprints are one node, so a pile of copies is compared once.
    """
    prints = materialize(fingerprints(docs), "fingerprints")
    table = F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(int(r)))).cast("short") for r in REFERENCES])
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    nodes = materialize(distinct.withColumn("table", table), "nodes")
    edges = near_edges(nodes.select("fp", "table"), nodes.count(), limit, run_cap)
    parts = connected_components(edges).select(F.col("node").alias("fp"), "component")
    thin = nodes.select("fp", "least", "n")
    linked = materialize(thin.join(parts, "fp"), "linked")
    least = settle(linked.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    several = thin.where("n > 1").join(parts, "fp", "left_anti").select("fp", F.col("least").alias("component_id"))
    labels = settle(linked.join(least, "component").select("fp", "component_id").unionByName(several), "labels")
    # A label, once found, stands even if it is null.
    found = prints.join(labels.withColumn("known", F.lit(True)), "fp", "left")
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that are not kept: an anti-join by id and fingerprint, sort-merge at every size (see exact dedup)."""
    found = simhash_components(docs).where("not kept").select(F.struct("doc_id", "fingerprint").alias("gone"))
    gone = settle(found.distinct(), "near-copies").hint("merge").select(F.col("gone.doc_id").alias("id"), F.col("gone.fingerprint").alias("fp"))
    # The row travels as one column, so none of its names can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    marked = rows.mapInArrow(_marked, rows.select("row", F.col("doc_id").alias("id"), F.lit("").alias("fp")).schema)
    same = F.col("x.id").eqNullSafe(F.col("y.id")) & (F.col("x.fp") == F.col("y.fp"))
    return marked.alias("x").join(gone.alias("y"), same, "left_anti").select("row.*")

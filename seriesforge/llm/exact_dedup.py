"""Exact deduplication by content-defined chunk recipes.

A text, its white space normalised, is cut where a rolling hash of its last bytes ends in zeros,
so equal passages are cut alike wherever they stand. Each chunk gets a 128-bit identifier, and a
document becomes the ordered list of its chunks' identifiers, its recipe. Two texts are equal when
their recipes are. Identifiers are verified: all chunks that share one must agree in an independent
cryptographic digest, and should they ever differ the next hash takes over. Texts are read once and
never move; recipes and digests, under 1 % of long texts, are all that is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import SPACE, documents, materialize, settle, slices

#: Bytes the rolling hash sees, bits that must be zero at a cut (4 KB on average), longest chunk.
WINDOW, CUT_BITS, LONGEST = 16, 12, 65_536

Digest = Callable[[bytes], bytes]
DIGESTS: tuple[Digest, ...] = tuple(
    (lambda data, seed=seed: xxhash.xxh3_128_digest(data, seed)) for seed in (11, 23, 47)
)

_GEAR = np.random.default_rng(7).integers(0, 2**32, 256, dtype=np.uint32)


def chunk_ends(data: np.ndarray) -> np.ndarray:
    """Whether a cut may follow each byte: a gear hash over WINDOW bytes, by doubling."""
    h = _GEAR[data]
    step = 1
    while step < WINDOW:
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        step *= 2
    return (h >> np.uint32(32 - CUT_BITS)) == 0


def _bounds(cuts: np.ndarray, start: int, end: int) -> list[int]:
    """Chunk borders of the bytes from start to end, both included; cuts: possible ends in the buffer.

    The first WINDOW positions still see bytes of the text before and never count.
    """
    lo, hi = np.searchsorted(cuts, (start + WINDOW, end))
    out = [start]
    for at in [*(cuts[lo:hi] + 1).tolist(), end]:
        while at - out[-1] > LONGEST:
            out.append(out[-1] + LONGEST)
        if at > out[-1]:
            out.append(at)
    return out


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the offsets of a string column without nulls."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def _cut(column: pa.Array) -> Iterator[list[memoryview]]:
    data, offsets = _buffers(column)
    low, high = int(offsets[0]), int(offsets[-1])
    cuts = np.flatnonzero(chunk_ends(data[low:high])) + low
    view = memoryview(data)
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        bounds = _bounds(cuts, start, end)
        yield [view[x:y] for x, y in zip(bounds, bounds[1:])]


def _recipes(digest: Digest) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, checks, shas = [], [], []
            for chunks in _cut(batch.column(1)):
                ids.append([digest(c) for c in chunks])
                whole = hashlib.sha256()
                for c in chunks:
                    whole.update(c)
                shas.append(whole.hexdigest())
                checks.append([hashlib.sha256(c).digest() for c in chunks] if len(chunks) > 1 else [whole.digest()] * len(chunks))
            columns = [batch.column(0), *(pa.array(x, pa.list_(pa.binary())) for x in (ids, checks)), pa.array(shas, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "recipe", "checks", "text_sha256"])

    return run


def normalised(docs: DataFrame) -> DataFrame:
    return documents(docs).withColumn("text", F.regexp_replace("text", SPACE, " "))


def recipes(docs: DataFrame, digests: Sequence[Digest] = DIGESTS) -> DataFrame:
    """(doc_id, recipe, text_sha256) for every row, written; identifiers are verified."""
    texts = normalised(docs)
    schema = "doc_id long, recipe array<binary>, checks array<binary>, text_sha256 string"
    for digest in digests:
        made = materialize(texts.mapInArrow(_recipes(digest), schema), "recipes")
        chunks = made.select(F.explode(F.arrays_zip("recipe", "checks")).alias("x"))
        # A digest as four longs: their extremes combine in the map tasks, whatever repeats.
        parts = [F.conv(F.hex(F.substring("x.checks", 1 + 8 * k, 8)), 16, -10).cast("long") for k in range(4)]
        thin = chunks.select(F.col("x.recipe").alias("id"), *[p.alias(f"p{k}") for k, p in enumerate(parts)])
        seen = thin.groupBy("id").agg(*[(F.min(f"p{k}") != F.max(f"p{k}")).alias(f"d{k}") for k in range(4)])
        if not seen.where("d0 or d1 or d2 or d3").limit(1).count():
            return made.drop("checks")
    raise RuntimeError("different chunks share an identifier under every hash")


def exact_dedup(docs: DataFrame, digests: Sequence[Digest] = DIGESTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII white space became one space; a null
    text is empty, and empty texts are equal. Of a group the smallest doc_id stays; null ids come
    last, and keep_id is null when a group has no other. Of repeated rows (same id, same text)
    exactly one stays. Other columns are not read. An empty table gives an empty result.
    """
    made = recipes(docs, digests)
    groups = made.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = settle(groups.where("group_size > 1"), "groups")
    rows = made.groupBy("recipe", "doc_id", "text_sha256").agg(F.count(F.lit(1)).cast("int").alias("n"))
    joined = rows.join(groups, "recipe", "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        "text_sha256",
        F.explode(F.sequence(F.lit(1), F.col("n"))).alias("k"),
    )
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("k") == 1)
    return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that :func:`exact_dedup` drops; columns as they were.

    The drop list (id and digest) is joined by a sort-merge join at every size: it grows with the
    corpus, so a plan that counts on broadcasting it would change its costs on the way. Texts move
    once. Rows repeated with the same id and text are brought down to one.
    """
    found = materialize(exact_dedup(docs).select("doc_id", "text_sha256", "kept"), "kept")
    key = found.where("not kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct()
    stays = found.where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    same = [F.col("x.__id").eqNullSafe(F.col("y.__id")), F.col("x.__sha") == F.col("y.__sha")]
    twins = settle(key.alias("x").join(stays.alias("y"), same, "left_semi"), "twins")
    gone = settle(key.alias("x").join(twins.alias("y"), same, "left_anti"), "gone")
    # The row travels as one column, so none of its names can clash.
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("__id"),
        F.sha2(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), SPACE, " "), 256).alias("__sha"),
    )
    left = marked.alias("x").join(gone.hint("merge").alias("y"), same, "left_anti")
    if not twins.limit(1).count():
        return left.select("row.*")
    single = left.alias("x").join(twins.alias("y"), same, "left_anti")
    one = left.alias("x").join(twins.alias("y"), same, "left_semi").dropDuplicates(["__id", "__sha"])
    return single.unionByName(one).select("row.*")


ORACLE = """
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
"""

"""Embedding near-duplicates by sorted projection passes.

Each pass orders all distinct vectors lexicographically by 64 random hyperplane signs of its own and
compares every vector with its ``window`` followers; pairs whose cosine reaches the threshold in
double precision are united across passes. The order is global: a range sort numbers the rows, and
the numbered list is cut into equal blocks that overlap by a window, so results don't depend on how
Spark partitions it.

A window is bounded and a group of copies isn't. The passes therefore only have to connect a group;
its links are then counted exactly, without writing pairs. Around a component's mean direction a
vector has an angle; two whose angles sum to at most the threshold's are linked for certain, and two
whose angles differ by more aren't. What is left is verified block by block. Of a tight group, however
large, almost all pairs are settled by angles alone.

How many passes it takes follows the data. A pass is sure to bring a pair together if it agrees in one more
leading sign than either vector shares with the row a window away. Those depths are measured, so each
vector has a bound on the chance that all passes miss a pair at the threshold. Vectors whose bound is above
``miss`` (dense regions, where many signs are needed) are passed again among themselves, or, where that
would cost more, compared with each other exactly.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.llm.common import gapless, materialize, settle
from seriesforge.llm.components import connected_components

THRESHOLD, PASSES, WINDOW, BLOCK = 0.95, 16, 32, 1024
#: Rows of a block in the exact count, and the rounding an angle may carry.
COUNT_BLOCK, MARGIN = 1024, 1e-6
#: Bound on the chance to miss a pair at the threshold, vectors of a block of the exact follow-up, and the
#: products a vector may take there for each pass it saves.
MISS, EXACT_BLOCK, PASS_COST = 1e-3, 8192, 4096


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles, ok) for every row; ok: not null or zero, all components finite."""
    e = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("e"))
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.withColumn("ok", F.coalesce(finite & F.exists("e", lambda x: x != 0), F.lit(False)))


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(rows, -1)


def _directions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``u``, column 1 at length one; scaled by its largest component first, so squares can't overflow or vanish."""
    for batch in batches:
        offsets = np.asarray(batch.column(1).offsets)
        first = offsets[:-1] - offsets[0]
        flat, size = np.array(batch.column(1).flatten(), np.float64), np.diff(offsets)
        flat /= np.repeat(np.maximum.reduceat(np.abs(flat), first), size)
        flat /= np.repeat(np.sqrt(np.add.reduceat(flat * flat, first)), size)
        u = pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), pa.array(flat))
        yield pa.RecordBatch.from_arrays([*batch.columns, u], [*batch.schema.names, "u"])


def heights(x: np.ndarray, which: int) -> np.ndarray:
    """Of each vector over the 64 hyperplanes of one pass."""
    return x @ np.random.default_rng([977, which, x.shape[1]]).normal(size=(x.shape[1], 64))


def signs(x: np.ndarray, which: int) -> np.ndarray:
    """The sort keys of one pass: 64 hyperplane signs, the first the most significant, as signed longs."""
    bits = np.packbits(heights(x, which) > 0, axis=1).view(">u8").ravel().astype(np.uint64)
    return (bits ^ np.uint64(1 << 63)).view(np.int64)  # order as unsigned


def missing(x: np.ndarray, which: int, depth: np.ndarray, threshold: float) -> np.ndarray:
    """Logarithm of the chance that a pass tells a vector (of length one) from one at the threshold within ``depth`` signs.

    Given the vector's height over a plane, the other's is normal around it: close to a plane, where a dense
    region's rarer signs lie, the two differ more often than elsewhere.
    """
    grid = np.linspace(0, 9, 9001)
    normal = np.log([0.5 + 0.5 * math.erf(g / math.sqrt(2)) for g in grid])
    equal = np.cumsum(np.interp(np.abs(heights(x, which)) * threshold / math.sqrt(max(1e-18, 1 - threshold**2)), grid, normal), axis=1)
    agree = np.where(depth > 0, np.take_along_axis(equal, np.clip(depth, 1, 64)[:, None] - 1, 1)[:, 0], 0.0)
    with np.errstate(divide="ignore"):
        return np.where(depth > 64, 0.0, np.maximum(np.log1p(-np.exp(agree)), -1e6))


def passes_for(depth: float, threshold: float, miss: float) -> float:
    """Passes after which the chance to have missed a pair at the threshold is about ``miss``, if it takes ``depth`` equal signs."""
    q = (1 - math.acos(threshold) / math.pi) ** depth
    return 1 if q >= 1 else math.ceil(math.log(miss) / math.log1p(-q)) if q > 0 else math.inf


def depths(keys: np.ndarray, window: int) -> np.ndarray:
    """For each of the sorted keys: the leading signs that only its window neighbours share with it; 65: none do."""
    out = np.zeros(len(keys), np.int64)
    if len(keys) > window:
        apart = (keys[window:] ^ keys[:-window]).view(np.uint64)
        for shift in (32, 16, 8, 4, 2, 1):  # all bits below the first that differs
            apart |= apart >> np.uint64(shift)
        need = 65 - np.bitwise_count(apart).astype(np.int64)
        out[:-window] = need
        out[window:] = np.maximum(out[window:], need)
    return out


def _keys(passes: Sequence[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict[int, list[int]] = {}
            for k, n in enumerate(np.diff(np.asarray(batch.column(1).offsets)).tolist()):
                groups.setdefault(n, []).append(k)
            for n, rows in groups.items():  # vectors of one length
                part = batch.take(pa.array(rows))
                x = _matrix(part.column(1), part.num_rows)
                for which in passes:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), which, np.int32)), pa.array(np.full(len(x), n, np.int32)), pa.array(signs(x, which)), part.column(0)],
                        ["pass", "dim", "key", "vec_id"],
                    )

    return run


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows, one dot product a pair in double precision."""
    return (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1))


def _window_links(threshold: float, window: int, block: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("pos").combine_chunks()
        ids, pos = table.column("vec_id").to_numpy(), table.column("pos").to_numpy()
        x = _matrix(table.column("e").chunk(0), table.num_rows)
        own = pos // block == key[1].as_py()
        missed = missing(x, int(key[0].as_py().split("/")[0]), depths(table.column("key").to_numpy(), window), threshold)
        a, b = [], []
        comp = np.arange(len(ids))
        for at in range(0, len(ids), window):
            left, right = x[at : at + window], x[at : at + 2 * window]
            i, j = np.nonzero(left @ right.T >= threshold - 1e-9)
            near = (j > i) & (j <= i + window)
            i, j = i[near] + at, j[near] + at
            sure = cosines(x[i], x[j]) >= threshold
            for p, q in zip(i[sure].tolist(), j[sure].tolist()):  # only what connects
                if comp[p] != comp[q]:
                    comp[comp == comp[q]] = comp[p]
                    a.append(ids[p])
                    b.append(ids[q])
        n = int(own.sum())
        return pa.table({
            "a": pa.array([*a, *ids[own].tolist()], pa.int64()), "b": pa.array([*b, *[None] * n], pa.int64()),
            "missed": pa.array([*[None] * len(a), *missed[own].tolist()], pa.float64()),
        })

    return run


def window_edges(vectors: DataFrame, threshold: float, passes: Sequence[int], window: int, block: int) -> DataFrame:
    """Verified links (a, b) between window neighbours that connect what the passes find; and, with b null, for
    each vector a and pass the logarithm of the chance to miss a pair at the threshold."""
    block = max(block, window)
    keys = vectors.mapInArrow(_keys(passes), "pass int, dim int, key long, vec_id long")
    keys = keys.withColumn("list", F.concat_ws("/", "pass", "dim"))
    order = ["list", "key", "vec_id"]
    # Position in the sorted list: parts of a range sort, numbered within, plus the rows before each part.
    parts = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = materialize(parts.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "order")
    sizes = parts.groupBy("list", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("list").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(sizes.select("list", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "part-starts")
    pos = F.col("start") + F.col("at") - F.col("first")
    placed = parts.join(starts, ["list", "part"]).select("list", "key", "vec_id", pos.alias("pos"))
    # A window of rows around a block belongs to it, too.
    first, last = F.floor((F.col("pos") - window) / block).cast("long"), F.floor((F.col("pos") + window) / block).cast("long")
    blocks = placed.withColumn("block", F.explode(F.sequence(F.greatest(first, F.lit(0).cast("long")), last)))
    rows = blocks.join(vectors, "vec_id").select("list", "block", "pos", "key", "vec_id", "e")
    return rows.groupBy("list", "block").applyInArrow(_window_links(threshold, window, block), "a long, b long, missed double")


def _exact_links(threshold: float, tile: int = 256) -> Callable[[tuple, pa.Table], pa.Table]:
    """Of one pair of blocks: as few links as connect what links."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side, ids = table.column("own").to_numpy(), table.column("vec_id").to_numpy()
        x = _matrix(table.column("e").chunk(0), len(ids))
        _, comp = np.unique(table.column("known").to_numpy(), return_inverse=True)
        i, j = np.flatnonzero(side == key[1].as_py()), np.flatnonzero(side == key[2].as_py())
        a, b = [], []
        for at in range(0, len(i), tile):
            part = i[at : at + tile]
            z = x[part] @ x[j].T
            for r, p in enumerate(part.tolist()):
                hit = j[(z[r] >= threshold - 1e-9) & (comp[j] != comp[p])]
                hit = hit[cosines(x[[p] * len(hit)], x[hit]) >= threshold]
                if len(hit):
                    joined, first = np.unique(comp[hit], return_index=True)
                    a += [ids[p]] * len(first)
                    b += ids[hit[first]].tolist()
                    comp[np.isin(comp, joined)] = comp[p]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def exact_edges(vectors: DataFrame, parts: DataFrame, n: int, threshold: float, block: int) -> DataFrame:
    """Links (a, b) that connect all of ``vectors`` (vec_id, e); ``parts`` (node, component) are connected already.

    Every pair of blocks is a group of its own but those of one and the same component, so a large group of
    near copies is not compared with itself again.
    """
    rows = vectors.join(parts.select(F.col("node").alias("vec_id"), "component"), "vec_id", "left")
    rows = rows.select("vec_id", "e", F.size("e").alias("dim"), F.coalesce("component", "vec_id").alias("known"))
    large = settle(rows.groupBy("known").count().where(F.col("count") > block).select("known", F.ceil(F.col("count") / block).alias("cut")), "large")
    salt = lambda c: F.pmod(F.xxhash64("vec_id"), c).cast("string")
    whole = F.col("cut").isNotNull()
    # A block's name: its component if it holds only that, and a number.
    dealt = rows.join(large, "known", "left").select(
        "dim", "vec_id", "e", "known", F.when(whole, F.col("known")).alias("only"),
        F.when(whole, F.concat_ws("/", F.col("known"), salt(F.col("cut")))).otherwise(salt(F.lit(-(-n // block) or 1))).alias("own"),
    )
    dealt = materialize(dealt, "exact-blocks")
    names = settle(dealt.select("dim", "own", "only").distinct(), "exact-names")
    x, y = names.alias("x"), names.alias("y")
    met = x.join(y, (F.col("x.dim") == F.col("y.dim")) & (F.col("x.own") <= F.col("y.own")) & F.coalesce(F.col("x.only") != F.col("y.only"), F.lit(True)))
    met = met.select(F.col("x.dim").alias("dim"), F.col("x.own").alias("i"), F.col("y.own").alias("j"))
    met = settle(met.select("dim", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("own")), "exact-pairs")
    return dealt.join(met, ["dim", "own"]).select("dim", "i", "j", "own", "vec_id", "known", "e").groupBy("dim", "i", "j").applyInArrow(
        _exact_links(threshold), "a long, b long")


def all_edges(vectors: DataFrame, threshold: float, passes: int, window: int, block: int, miss: float = MISS,
              exact_block: int = EXACT_BLOCK, pass_cost: int = PASS_COST) -> DataFrame:
    """Links (a, b) that connect all pairs of ``vectors`` (vec_id, e) that link, but for chances of at most ``miss`` each.

    Passes for evenly spread vectors at first; then those whose measured bound is above ``miss`` go on.
    """
    n = vectors.count()
    evenly = passes_for(1 + max(0.0, math.log2(max(n, 1) / window)), threshold, miss)
    done, more, open_, bound, edges = 0, max(passes, int(min(evenly, 4096))), vectors, None, None
    while n > 1 and more:
        found = materialize(window_edges(open_, threshold, range(done, done + more), window, block), "window-links")
        done += more
        new = found.where("b is not null").select("a", "b")
        edges = new if edges is None else edges.unionByName(new)
        missed = found.where("b is null").groupBy(F.col("a").alias("vec_id")).agg(F.sum("missed").alias("missed"))
        if bound is not None:
            missed = missed.join(bound.select("vec_id", F.col("missed").alias("so_far")), "vec_id").withColumn("missed", F.col("missed") + F.col("so_far"))
        bound = materialize(missed.where(F.col("missed") > math.log(miss)), "open")
        open_ = materialize(vectors.join(bound.select("vec_id"), "vec_id", "left_semi"), "open-vectors")
        # At the rate so far, what most of them still need; a rest goes on again.
        each = F.least(F.lit(1e9), F.lit(float(done)) * (F.lit(math.log(miss)) / F.least("missed", F.lit(-1e-12)) - 1))
        n, needs = bound.agg(F.count(F.lit(1)), F.percentile_approx(each, 0.9)).first()
        if not n:
            break
        if n / 2 <= pass_cost * needs:
            parts = connected_components(edges)
            return edges.unionByName(exact_edges(open_, parts, n, threshold, exact_block))
        more = max(1, math.ceil(needs))
    return edges if edges is not None else vectors.select(F.col("vec_id").alias("a"), F.col("vec_id").alias("b"))


def _angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(component, vec_id, times, e, center) to the angle of each vector with its component's center."""
    for batch in batches:
        e, center = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        angle = []
        for x, c in zip(e, center):
            x, c = np.array(x), np.array(c[: len(x)])
            size = np.sqrt(c @ c)
            angle.append(float(np.arccos(np.clip(x @ c / size, -1, 1))) if size > 1e-9 else 3.0)
        columns = [batch.column(k) for k in range(4)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(angle, pa.float64())], ["component", "vec_id", "times", "e", "angle"])


def _verified(threshold: float, limit: float, margin: float) -> Callable[[tuple, pa.Table], pa.Table]:
    """Of one pair of blocks: how many rows each vector of one links to in the other; angles settle what they can."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side, ids = table.column("side").to_numpy(), table.column("vec_id").to_numpy()
        x, angle = _matrix(table.column("e").chunk(0), len(ids)), table.column("angle").to_numpy()
        times = table.column("times").to_numpy()
        i, j = (np.flatnonzero(side == s) for s in (0, 1))
        z = x[i] @ x[j].T
        total, apart = angle[i][:, None] + angle[j], np.abs(angle[i][:, None] - angle[j])
        certain = total <= limit - margin
        link = certain | (apart <= limit + margin) & (z >= threshold)
        p, q = np.nonzero(~certain & (np.abs(z - threshold) < 1e-9))
        link[p, q] = cosines(x[i][p], x[j][q]) >= threshold
        link &= ids[i][:, None] != ids[j]
        return pa.table({"vec_id": pa.array(ids[i]), "more": pa.array(link.astype(np.int64) @ times[j])})

    return run


def count_links(members: DataFrame, threshold: float, block: int = COUNT_BLOCK) -> DataFrame:
    """(vec_id, links): for each distinct vector of a component, the rows it links to among the other vectors.

    members: component, vec_id, times (rows with this very vector), e (of length one). Vectors whose angle with the
    center is at most half the threshold's link to each other: counted by a sum. All others, and what
    the first may link to beyond, are verified in pairs of blocks of which at least one holds an outer
    vector.
    """
    limit = float(np.arccos(threshold))
    dim = members.agg(F.max(F.size("e"))).first()[0]
    if not dim:
        return members.select("vec_id", F.lit(0).cast("long").alias("links"))
    sums = [F.sum(F.get("e", F.lit(k)) * F.col("times")).alias(f"s{k}") for k in range(dim)]
    centers = members.groupBy("component").agg(*sums).select("component", F.array(*[F.coalesce(f"s{k}", F.lit(0.0)) for k in range(dim)]).alias("center"))
    measured = members.select("component", "vec_id", "times", "e").join(settle(centers, "centers"), "component")
    angles = materialize(measured.mapInArrow(_angles, "component long, vec_id long, times long, e array<double>, angle double"), "angles")
    inner = F.col("angle") <= (limit - MARGIN) / 2
    sizes = settle(
        angles.groupBy("component").agg(
            F.sum(F.when(inner, F.col("times")).otherwise(0)).alias("inner_rows"),
            F.sum(F.when(inner, 1).otherwise(0)).alias("n_inner"), F.sum(F.when(inner, 0).otherwise(1)).alias("n_outer"),
        ), "component-sizes")
    rows = angles.join(sizes, "component").withColumn("inner", inner)
    certain = rows.select("vec_id", F.when(F.col("inner"), F.col("inner_rows") - F.col("times")).otherwise(F.lit(0)).cast("long").alias("more"))
    # Blocks: outer vectors 0 .. u-1, inner ones u .. u+v-1. Pairs of two inner blocks are never formed.
    u, v = (F.ceil(F.col(n) / block).cast("int") for n in ("n_outer", "n_inner"))
    salt = lambda n: F.pmod(F.xxhash64("vec_id"), F.greatest(n, F.lit(1))).cast("int")
    dealt = rows.where("n_outer > 0").withColumn("own", F.when(F.col("inner"), u + salt(v)).otherwise(salt(u)))
    partners = F.when(F.col("inner"), F.sequence(F.lit(0), u - 1)).otherwise(F.sequence(F.lit(0), u + v - 1))
    met = dealt.select("component", "vec_id", "times", "e", "angle", "own", F.explode(partners).alias("other"))
    pairs = met.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("side")).select(
        "component", F.when(F.col("side") == 0, F.col("own")).otherwise(F.col("other")).alias("i"),
        F.when(F.col("side") == 0, F.col("other")).otherwise(F.col("own")).alias("j"), "side", "vec_id", "times", "e", "angle",
    )
    verified = pairs.groupBy("component", "i", "j").applyInArrow(_verified(threshold, limit, MARGIN), "vec_id long, more long")
    return certain.unionByName(verified).groupBy("vec_id").agg(F.sum("more").alias("links"))


def embedding_links(vectors: DataFrame, threshold: float = THRESHOLD, passes: int = PASSES, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and
    vectors of different length don't link. n_links counts the other rows linked directly, copies
    included; component_id is the smallest vec_id reachable (null ids count as the largest); kept:
    vec_id is component_id. Equal vectors are one node, whatever their number.
    """
    rows = usable(vectors)
    good = rows.where("ok")
    classes = good.groupBy("e").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("times"))
    # A node's id: a number of its own, as ids may be null or repeat.
    nodes = gapless(materialize(classes.withColumn("one", F.lit(0)).withColumn("h", F.xxhash64("e")), "classes"), "one", ["h", "e"], "node")
    nodes = nodes.select("node", "e", "least", "times")
    nodes = materialize(nodes.mapInArrow(_directions, "node long, e array<double>, least long, times long, u array<double>"), "nodes")
    edges = all_edges(nodes.select(F.col("node").alias("vec_id"), F.col("u").alias("e")), threshold, passes, window, block)
    parts = materialize(connected_components(edges), "parts")
    joined = materialize(nodes.join(parts, "node"), "members")
    least = settle(joined.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    links = count_links(joined.select("component", F.col("node").alias("vec_id"), "times", F.col("u").alias("e")), threshold)
    known = joined.select("node", "e", "times", "component").join(least, "component").join(
        links.withColumnRenamed("vec_id", "node"), "node").select("e", "component_id", "times", "links")
    copies = nodes.where("times > 1").join(parts, "node", "left_anti").select("e", F.col("least").alias("component_id"), "times", F.lit(0).cast("long").alias("links"))
    labels = settle(known.unionByName(copies).withColumn("known", F.lit(True)), "labels")
    found = rows.where("ok").join(labels, "e", "left").unionByName(rows.where("not ok"), allowMissingColumns=True)
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("vec_id"))
    return found.select(
        "vec_id", F.coalesce(F.col("links") + F.col("times") - 1, F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"),
    )

"""Merkle manifest of a dataset: a content-addressed DAG, asked from the root down.

Every row is a leaf. The leaves of a source, by id, are the foot of a tree in which each run of three
consecutive nodes becomes their digest; the tops of the sources' trees are the foot of one more such
tree. What is stored are records from a digest to the children below it, ``DEPTH`` levels at once: a
record is one row, found by nothing but its digest, of at most 3**DEPTH digests at its foot.

A request names a source and a rank. It goes from the root's record to the leaf: the rank's base-3
digits select a child on each level, the children not selected are collected left and right of it,
and the last digit of a record's segment gives the digest of the next record. Requests that share a
prefix travel as one row, so no record is a hot key and a level of the DAG is one join by digest;
only at the leaves' own records do requests meet their segment. The segments, reversed, are the proof.

All of it is DataFrame expressions: one scan of the texts gives digests, nothing else moves. Ranks
come from one range shuffle of the digests, so a source may hold any share of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.llm.ordering import numbered
from seriesforge.llm.sql import crc32_sql
from seriesforge.session import materialize

FAN, DEPTH = 3, 5
FOOT = FAN**DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SEGMENT = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value; integers in decimal."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row of documents; ``changed`` gives other values for some of its fields."""
    return digest(*[encoded(changed.get(name, F.col(name))) for name in FIELDS])


def _height(leaves: Column) -> Column:
    """Levels above that many leaves: the least h with 3**h >= leaves."""
    return F.size(F.filter(F.array(*[F.lit(FAN**k) for k in range(40)]), lambda p: p < leaves))


def _runs(nodes: Column) -> Column:
    """Digests of each run of three consecutive nodes."""
    starts = F.sequence(F.lit(1), F.size(nodes), F.lit(FAN))
    return F.transform(starts, lambda s: digest(F.array_join(F.slice(nodes, s, FAN), "")))


def _segment(levels: Column, place: Column) -> Column:
    """What a record leaves unselected on the way to the digest at ``place`` of its foot, top down."""
    def step(k: Column) -> Column:
        level = F.element_at(levels, k + 1)
        at = F.floor(place / F.element_at(F.array(*[F.lit(FAN**j) for j in range(DEPTH)]), k + 1)).cast("int")
        digit = at % FAN
        joined = lambda start, n: F.array_join(F.slice(level, start, n), "")
        return F.struct(joined(at - digit + 1, digit).alias("left"), joined(at + 2, FAN - 1 - digit).alias("right"))

    top = F.size(levels) - 1
    return F.transform(F.sequence(top, F.lit(0), F.lit(-1)), step)


@dataclass(frozen=True)
class Forest:
    """Trees over numbered nodes: ``records[p]`` holds the records whose foot is ``p * DEPTH`` levels above the leaves."""

    records: list[DataFrame]  # digest, levels
    tops: DataFrame  # tree, height, digest


def grow(nodes: DataFrame, label: str) -> Forest:
    """The trees over ``nodes`` (tree, at, leaves, digest): ``at`` numbers a tree's nodes from 0 to ``leaves`` - 1.

    Each round packs FOOT neighbours into one record, so rounds are few and groups bounded.
    """
    feet = nodes.select("tree", "at", _height(F.col("leaves")).alias("height"), "digest")
    highest = feet.agg(F.max("height")).first()[0] or 0
    records, tops = [], feet.where("height = 0")
    for p in range(-(-highest // DEPTH)):
        levels = [F.transform(F.array_sort(F.collect_list(F.struct("at", "digest"))), lambda x: x.digest).alias("l0")]
        packed = feet.where(F.col("height") > p * DEPTH).groupBy("tree", "height", F.floor(F.col("at") / FOOT).alias("at")).agg(*levels)
        depth = F.least(F.lit(DEPTH), F.col("height") - p * DEPTH)
        for k in range(DEPTH):
            packed = packed.withColumn(f"l{k + 1}", F.when(depth > k, _runs(F.col(f"l{k}"))).otherwise(F.col(f"l{k}")))
        packed = materialize(packed.select(
            "tree", "height", "at", F.element_at(f"l{DEPTH}", 1).alias("digest"),
            F.slice(F.array(*[f"l{k}" for k in range(DEPTH)]), 1, depth).alias("levels")), f"{label}-records")
        # One record a digest: equal subtrees are stored once.
        records.append(packed.select("digest", "levels").dropDuplicates(["digest"]))
        feet = packed.select("tree", "at", "height", "digest")
        tops = tops.unionByName(feet.where(F.col("height") <= (p + 1) * DEPTH).select(*tops.columns))
    return Forest(records, tops.drop("at"))


def _down(forest: Forest, frontier: DataFrame, wanted: DataFrame, stop: int) -> DataFrame:
    """Rows of ``frontier`` (tree, at, height, digest, above, ...) taken down to records of round ``stop``.

    ``wanted`` (tree, at) are the feet asked for; rows that no request passes are left where they are.
    """
    kept = [c for c in frontier.columns if c not in ("at", "digest", "above")]
    for p in range(len(forest.records) - 1, stop - 1, -1):
        asked = wanted.select(F.col("tree").alias("__tree"), F.floor(F.col("at") / FOOT ** (p + 1)).alias("__at")).distinct()
        low = frontier.where(F.col("height") <= p * DEPTH)
        high = frontier.where(F.col("height") > p * DEPTH)
        high = high.join(asked, high["tree"].eqNullSafe(asked["__tree"]) & (high["at"] == asked["__at"]), "left_semi")
        opened = high.join(forest.records[p], "digest")
        children = opened.select(*kept, F.col("at").alias("__up"), "above", "levels", F.posexplode(F.element_at("levels", 1)).alias("place", "digest"))
        below = children.select(
            *kept, (F.col("__up") * FOOT + F.col("place")).alias("at"), "digest",
            F.concat("above", _segment(F.col("levels"), F.col("place"))).alias("above"))
        frontier = low.unionByName(below)
    return frontier


@dataclass(frozen=True)
class Manifest:
    """The records of a dataset, its leaves in order, and the digest that stands for all of them."""

    root: str
    sources: Forest  # one tree over the sources' tops
    trees: Forest  # one tree a source
    tops: DataFrame  # source, height, subroot, at
    leaves: DataFrame  # source, at, digest, and the columns handed in


def build(leaves: DataFrame) -> Manifest | None:
    """The manifest of ``leaves`` (source, doc_id, leaf, ...), a stored table; None if there are none.

    Leaves are ordered by source (null first, bytewise), id (null first) and digest; equal rows are
    equal leaves, so which of them comes first changes nothing.
    """
    if leaves.isEmpty():
        return None
    ranked = numbered(leaves, "source", ["doc_id", "leaf"], "at")
    sizes = ranked.groupBy(F.col("source").alias("__source")).agg(F.count(F.lit(1)).alias("leaves"))
    sizes = materialize(sizes, "sizes")
    met = ranked["source"].eqNullSafe(sizes["__source"])
    stored = materialize(ranked.join(sizes, met).drop("__source"), "leaves")
    trees = grow(stored.select(F.col("source").alias("tree"), "at", "leaves", F.col("leaf").alias("digest")), "tree")
    subroots = materialize(trees.tops.select(F.lit(0).alias("all"), F.col("tree").alias("source"), "height", F.col("digest").alias("subroot")), "subroots")
    tops = materialize(numbered(subroots, "all", ["source"], "at").drop("all"), "tops")
    sources = grow(tops.select(F.lit(0).alias("tree"), "at", F.lit(tops.count()).alias("leaves"), F.col("subroot").alias("digest")), "source")
    return Manifest(sources.tops.first()["digest"], sources, trees, tops, stored)


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` (source, at, ...) with ``subroot`` and ``path``: the siblings (left, right) from leaf to root.

    Several requests may name one leaf; a request for a leaf that does not exist has no row.
    """
    none = F.from_json(F.lit("[]"), SEGMENT)
    asked = requests.select("source", "at").withColumnRenamed("source", "tree").distinct()
    # Sources that are asked for, by their rank among the sources.
    of = asked.select("tree").distinct().withColumnRenamed("tree", "__asked")
    tops = manifest.tops.join(of, manifest.tops["source"].eqNullSafe(of["__asked"]), "left_semi")
    one = manifest.sources.tops.select(F.lit(0).alias("tree"), F.lit(0).cast("long").alias("at"), "height", "digest", none.alias("above"))
    reached = _down(manifest.sources, one, tops.select(F.lit(0).alias("tree"), "at"), 0).select("at", "above")
    start = tops.join(reached, "at").select(
        F.col("source").alias("tree"), F.lit(0).cast("long").alias("at"), "height", F.col("subroot").alias("digest"), "above", "subroot")
    last = _down(manifest.trees, start, asked, 1)
    if manifest.trees.records:
        last = last.join(manifest.trees.records[0], "digest", "left")
    else:
        last = last.withColumn("levels", F.lit(None).cast("array<array<string>>"))
    last = last.select(F.col("tree").alias("__tree"), F.col("at").alias("__pack"), "above", "subroot", "levels")
    rows = requests.withColumn("__of", F.floor(F.col("at") / FOOT))
    met = rows["source"].eqNullSafe(last["__tree"]) & (rows["__of"] == last["__pack"])
    there = F.when(F.col("levels").isNull(), F.col("at") == 0).otherwise(F.col("at") % FOOT < F.size(F.element_at("levels", 1)))
    own = F.when(F.col("levels").isNotNull(), _segment(F.col("levels"), (F.col("at") % FOOT).cast("int"))).otherwise(none)
    joined = rows.join(last, met).where(there)
    return joined.withColumn("path", F.reverse(F.concat("above", own))).drop("__of", "__tree", "__pack", "above", "levels")


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, leaf to root, left to right."""
    return digest(F.array_join(F.transform(path, lambda x: F.concat(x.left, x.right)), ""))


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and its siblings give."""
    return F.aggregate(path, leaf, lambda below, x: digest(x.left, below, x.right))


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The proofs are those of the untouched table. Rows whose unsigned crc32 of the decimal id is even
    (a null id counts as empty text) then present a leaf whose text has lost its newlines; ``verified``
    says whether what is presented still leads to the root. Null fields, sources and ids are values of
    their own; columns that ``docs`` lacks count as null, others are ignored. An empty table has no
    rows; a table of one row is its own root and its proof is the digest of nothing.
    """
    types = {"doc_id": "long", "n_chars": "long"}
    plain = docs.select(*[(F.col(c) if c in docs.columns else F.lit(None)).cast(types.get(c, "string")).alias(c) for c in FIELDS])
    even = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0
    changed = leaf_digest(text=F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    leaves = materialize(plain.select(
        "doc_id", "source", leaf_digest().alias("leaf"),
        F.when(even & F.contains(F.col("text"), F.lit("\n")), changed).alias("other")), "leaf-digests")
    manifest = build(leaves)
    if manifest is None:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    found = prove(manifest, manifest.leaves)
    root, presented = F.lit(manifest.root), F.coalesce("other", "leaf")
    out = found.select("doc_id", "leaf", "subroot", root.alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
                       fold(presented, F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


SCHEMA = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _encoded_sql(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || ({value}::VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars"]
    return f"sha256({' || '.join(map(_encoded_sql, [*fields, text]))})"


_UP = "list_transform(range(0, (len(l) + 2) // 3), lambda i: sha256(array_to_string(l[3*i+1:3*i+3], '')))"

#: Trees as lists a level, proofs as lists of "left|right".
ORACLE = f"""
WITH RECURSIVE plain AS (
  SELECT row_number() OVER () AS rid, doc_id, source, {_leaf_sql('text')} AS leaf,
    CASE WHEN {crc32_sql("coalesce(doc_id::VARCHAR, '')")} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")}
      ELSE {_leaf_sql('text')} END AS presented
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM plain),
trees(source, h, l) AS (
  SELECT source, 0, list(leaf ORDER BY rank) FROM ranked GROUP BY source
  UNION ALL SELECT source, h + 1, {_UP} FROM trees WHERE len(l) > 1),
tops AS (
  SELECT source, l[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM trees WHERE len(l) = 1),
upper_levels(h, l) AS (
  SELECT 0, list(subroot ORDER BY pos) FROM tops HAVING count(*) > 0
  UNION ALL SELECT h + 1, {_UP} FROM upper_levels WHERE len(l) > 1),
places AS (
  SELECT rid, trees.h, l, rank // (3 ** trees.h)::BIGINT AS i
  FROM ranked JOIN trees ON ranked.source IS NOT DISTINCT FROM trees.source AND len(l) > 1
  UNION ALL
  SELECT rid, 100 + u.h, l, pos // (3 ** u.h)::BIGINT
  FROM ranked JOIN tops ON ranked.source IS NOT DISTINCT FROM tops.source JOIN upper_levels u ON len(l) > 1),
proofs AS (
  SELECT rid, list(array_to_string(l[i//3*3+1:i], '') || '|' || array_to_string(l[i+2:i//3*3+3], '') ORDER BY h) AS path
  FROM places GROUP BY rid),
folded AS (
  SELECT doc_id, leaf, subroot, (SELECT l[1] FROM upper_levels WHERE len(l) = 1) AS root,
    sha256(replace(array_to_string(coalesce(path, []), ''), '|', '')) AS proof_sha256,
    list_reduce([presented] || coalesce(path, []), lambda d, x: sha256(split_part(x, '|', 1) || d || split_part(x, '|', 2))) AS folded_root
  FROM ranked JOIN tops ON ranked.source IS NOT DISTINCT FROM tops.source LEFT JOIN proofs USING (rid))
SELECT *, folded_root = root AS verified FROM folded
"""

"""Operator 13, Merkle manifest of a dataset, by sibling-shift self-joins.

Every row becomes a leaf, the SHA-256 of its columns.  The leaves of a group are
numbered in order; at every level each node meets its siblings by an equijoin of
the level with itself on the computed sibling index (``idx XOR 1`` in a binary
tree, the slots ``(slot + offset) mod arity`` of its run otherwise), and the rows
in slot zero emit the parents.  A group that is down to one node leaves with it.
The groups' roots are the leaves of one more tree.  The way back hands each
node its parent's path: a path entry holds the node's slot and the digests of
its siblings, left to right, so a leaf and its path give the root again
(``fold``) without any other row.

A level has a written table of its own, so a lost executor repeats one level.
Nodes are joined on (group, index): a group that holds a third of all rows is
dealt like any other.  The driver sees the largest group's size and the root.

Defined results: a null column value counts as ``-``; null groups come first and
are one group; null ids come first in a group; rows that agree in group and id
are ordered by their leaf, and equal leaves are interchangeable; an empty table
has no rows and no root; columns that are not named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxtide.llm.common import materialize

#: The columns of a leaf, in this order.
LEAF = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that one plan walks down before its paths are written.
STRIDE = 6


def sha(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, end to end."""
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """``-`` for null, else byte count, colon, value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(**changed: Column) -> Column:
    """The leaf of a row, with some columns ``changed``."""
    return sha(*(framed(changed.get(c, F.col(c))) for c in LEAF))


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def numbered(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """``rows`` (with ``grp``) plus idx and n: the place in the group in the order
    of ``by``, and the group's size.  A range sort gives each task a stretch;
    the stretches' counts (one narrow row a task and group) give the offsets."""
    parts = materialize(rows.repartitionByRange("grp", *by).withColumn("part", F.spark_partition_id()), f"{name}-parts")
    counts = parts.groupBy("grp", "part").agg(F.count("*").alias("here"))
    group = Window.partitionBy("grp")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = counts.select("grp", "part", (F.sum("here").over(before) - F.col("here")).alias("start"), F.sum("here").over(group).alias("n"))
    place = F.row_number().over(Window.partitionBy("grp", "part").orderBy(*by)) - 1
    return parts.withColumn("place", place).join(starts, ["grp", "part"]).withColumn("idx", (F.col("start") + F.col("place")).cast("bigint")).drop("part", "place", "start")


def _level(nodes: DataFrame, arity: int, name: str) -> DataFrame:
    """The nodes of one level with their path ``entry`` and their ``parent``'s
    digest: each sibling slot is one equijoin of the level with itself."""
    slot = F.col("idx") % arity
    out, met = nodes, []
    for shift in range(1, arity):
        at = F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("idx") - slot + (slot + shift) % arity
        beside = nodes.select("grp", F.col("idx").alias(f"idx{shift}"), F.col("digest").alias(f"beside{shift}"))
        out = out.withColumn(f"idx{shift}", at).join(beside, ["grp", f"idx{shift}"], "left")
        met.append(F.struct(((slot + shift) % arity).alias("slot"), F.col(f"beside{shift}").alias("digest")))
    others = F.transform(F.array_sort(F.filter(F.array(*met), lambda s: s["digest"].isNotNull())), lambda s: hexed(s["digest"]))
    run = F.concat(F.array_join(F.slice(others, 1, slot.cast("int")), ""), hexed(F.col("digest")), F.array_join(F.slice(others, slot.cast("int") + 1, F.size(others)), ""))
    entry = F.concat(F.unhex(F.lpad(F.hex(slot), 2, "0")), F.unhex(F.array_join(others, "")))
    return materialize(out.withColumn("entry", entry).withColumn("above", F.when(slot == 0, F.unhex(sha(run)))).drop(*(f"{c}{s}" for c in ("idx", "beside") for s in range(1, arity))), name)


def grow(leaves: DataFrame, arity: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Trees over ``leaves`` (grp, idx, n, digest and more): the levels that have
    siblings, and the root of each group with the number of levels below it."""
    size = leaves.agg(F.max("n")).first()[0] or 0
    levels, nodes, tops = [], leaves, []
    while True:
        tops.append(nodes.where("n = 1").select("grp", "digest", F.lit(len(levels)).alias("height")))
        if size <= 1:
            break
        levels.append(_level(nodes.where("n > 1"), arity, f"{name}-{len(levels)}"))
        nodes = levels[-1].where("above is not null").select(
            "grp", F.floor(F.col("idx") / arity).alias("idx"), F.ceil(F.col("n") / arity).alias("n"), F.col("above").alias("digest"))
        size = -(-size // arity)
    roots = tops[0]
    for t in tops[1:]:
        roots = roots.unionByName(t)
    return levels, materialize(roots, f"{name}-roots")


def paths(leaves: DataFrame, levels: list[DataFrame], roots: DataFrame, arity: int, name: str) -> DataFrame:
    """``leaves`` with what ``roots`` (grp, height, path, and more) hand down: the
    path from each leaf to its group's root, followed by that root's path."""
    handed = [c for c in roots.columns if c not in ("grp", "height", "path")]
    given = lambda height: roots.where(F.col("height") == height).select("grp", F.lit(0).cast("bigint").alias("up"), "path", *handed)
    above = given(len(levels))
    for height in reversed(range(len(levels))):
        kept = [c for c in levels[height].columns if c not in ("n", "entry", "above")] if height == 0 else ["grp", "idx"]
        nodes = levels[height].withColumn("up", F.floor(F.col("idx") / arity).cast("bigint")).withColumnRenamed("entry", "step")
        here = nodes.join(above, ["grp", "up"]).select(*kept, F.concat(F.array("step"), "path").alias("path"), *handed)
        if height == 0:
            lone = leaves.where("n = 1").join(given(0).drop("up"), "grp").select(*kept, "path", *handed)
            return here.unionByName(lone)
        if (len(levels) - height) % STRIDE == 0:
            here = materialize(here, f"{name}-paths-{height}")
        above = here.withColumnRenamed("idx", "up").unionByName(given(height))
    return leaves.where("n = 1").join(given(0).drop("up"), "grp").drop("n")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf (hex) and its path give."""
    def step(digest: Column, entry: Column) -> Column:
        left = F.conv(F.hex(F.substring(entry, 1, 1)), 16, 10).cast("int") * 32
        return sha(hexed(F.substring(entry, F.lit(2), left)), digest, hexed(F.substring(entry, left + 2, F.octet_length(entry))))
    return F.aggregate(path, leaf, step)


def proof(path: Column) -> Column:
    """Digest of a path's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda e: hexed(F.substring(e, F.lit(2), F.octet_length(e)))), ""), 256)


def manifest(docs: DataFrame, arity: int = 2, **carried: Column) -> DataFrame:
    """One row per row of ``docs``: doc_id, the columns ``carried`` (digests in
    hex, computed with the leaf), leaf, subroot, root and path (for ``fold``)."""
    group = F.when(F.col("lang").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col("lang")))
    rows = docs.select("doc_id", group.alias("grp"), F.unhex(leaf_of()).alias("digest"), *(F.unhex(c).alias(f"carried_{k}") for k, c in carried.items()))
    leaves = numbered(rows, ["doc_id", "digest"], "manifest")
    leaves = materialize(leaves, "manifest-leaves")
    levels, tops = grow(leaves, arity, "manifest")
    # the groups' roots are the leaves of the tree above them
    crown = materialize(numbered(tops.select(F.lit("").alias("grp"), F.col("grp").alias("group"), "digest", "height"), ["group"], "crown"), "crown-leaves")
    upper, summit = grow(crown, arity, "crown")
    root = summit.first()
    roots = paths(crown, upper, summit.select("grp", "height", F.array().cast("array<binary>").alias("path")), arity, "crown")
    roots = materialize(roots.select(F.col("group").alias("grp"), "path", F.col("digest").alias("subroot")).join(tops.select("grp", "height"), "grp"), "manifest-tops")
    found = paths(leaves, levels, roots, arity, "manifest")
    return found.select("doc_id", *(hexed(F.col(f"carried_{k}")).alias(k) for k in carried), hexed(F.col("digest")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"),
                        F.lit(hexed_bytes(root["digest"]) if root else None).cast("string").alias("root"), "path")


def hexed_bytes(digest) -> str:
    return bytes(digest).hex()

"""Merkle manifest of a dataset: digests of rows, of parts and of the whole, with proofs.

The rows of a part are ranked. The digits of a rank say on which branch of the tree a row
hangs, level by level, so that grouping the digits away one after the other, within blocks of
bounded size, nests each run of nodes in the node above. A block is one row; what it holds
is unfolded by transforms and an explode. Blocks are the nodes of the next tier.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.ordered import written
from wakeline.operators.lookup import lookup_join

#: Nodes that become one.
RUN = 3
#: Levels nested in one block, which holds RUN ** LEVELS nodes at most.
LEVELS = 6
NEW = ("leaf", "path", "subroot", "root")
NO_STEPS = "array<struct<before:string,after:string>>"


def field(value: Column) -> Column:
    """A value as it goes into a leaf: its length in bytes and itself; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def proof_text(path: Column) -> Column:
    """All siblings on the way up, in order."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``path`` amount to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def _ranked(rows: DataFrame, tree: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0, in ``order`` within their tree) and ``n``, the tree's size.

    Rows are dealt out in ranges, so that a large tree lies in many tasks; what comes
    before a range's rows of a tree is told by the counts of the ranges before it.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(ranges, *tree, *order).sortWithinPartitions(*tree, *order)
    place = F.monotonically_increasing_id() % F.lit(1 << 33)
    dealt = written(dealt.withColumns({"_range": F.spark_partition_id(), "_place": place}), "merkle-ranges")
    whole = Window.partitionBy(*tree) if tree else Window.partitionBy(F.lit(0))
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    spans = dealt.groupBy(*tree, "_range").agg(F.min("_place").alias("_first"), F.count("*").alias("_own"))
    shift = F.coalesce(F.sum("_own").over(before), F.lit(0)) - F.col("_first")
    spans = spans.select(*tree, "_range", shift.alias("_shift"), F.sum("_own").over(whole).alias("n"))
    found = lookup_join(dealt, spans, [*tree, "_range"])
    return found.select(*[F.col(f"r.{c}") for c in rows.columns], (F.col("_place") + F.col("_shift")).alias("rank"), "n")


def _digests(kids: Column) -> Column:
    return F.array_join(F.transform(kids, lambda kid: kid["digest"]), "")


def _nested(nodes: DataFrame, tree: Sequence[str], levels: int) -> DataFrame:
    """One row per block: ``tree``, ``block``, ``n``, its ``digest`` and ``kids``, the nodes within.

    ``nodes`` has ``rank``, ``n``, ``digest`` and ``held``. A tree that is a single node at
    some level passes through the levels above as it is.
    """
    digits = {f"_d{i}": (F.floor(F.col("rank") / RUN**i) % RUN).cast("int") for i in range(levels)}
    rows = nodes.withColumns(digits).withColumn("block", F.floor(F.col("rank") / RUN**levels)).repartition(*tree, "block")
    node = F.struct(F.col("_d0").alias("digit"), "digest", "held")
    for level in range(levels):
        above = [f"_d{i}" for i in range(level + 1, levels)]
        rows = rows.groupBy(*tree, "block", "n", *above).agg(F.sort_array(F.collect_list(node)).alias("kids"))
        joined = F.sha2(_digests(F.col("kids")), 256)
        rows = rows.withColumn("digest", F.when(F.col("n") <= RUN**level, F.col("kids")[0]["digest"]).otherwise(joined))
        if above:
            node = F.struct(F.col(above[0]).alias("digit"), "digest", "kids")
    return rows


def _leaves(kids: Column, level: int, n: Column) -> Column:
    """``held`` of everything below ``kids``, nodes of ``level``, with its ``path`` to the node above them."""

    def below(kid: Column, i: Column) -> Column:
        before, after = _digests(F.slice(kids, 1, i)), _digests(F.slice(kids, i + 2, F.lit(RUN)))
        step = F.array(F.struct(before.alias("before"), after.alias("after")))
        steps = F.when(n > RUN**level, step).otherwise(F.array().cast(NO_STEPS))
        if level == 0:
            return F.array(F.struct(kid["held"].alias("held"), steps.alias("path")))
        inner = _leaves(kid["kids"], level - 1, n)
        return F.transform(inner, lambda leaf: F.struct(leaf["held"].alias("held"), F.concat(leaf["path"], steps).alias("path")))

    return F.flatten(F.transform(kids, below))


def _unfolded(tier: DataFrame, levels: int) -> DataFrame:
    """One row per node of the blocks: ``held``, ``path`` up to the root, ``subroot``, ``root``."""
    leaf = F.explode(_leaves(F.col("kids"), levels - 1, F.col("n"))).alias("_leaf")
    found = tier.select(leaf, "above", "subroot", "root")
    return found.select("_leaf.held", F.concat("_leaf.path", "above").alias("path"), "subroot", "root")


def manifest(
    rows: DataFrame, leaf: Column, tree: str, order: str, keep: Sequence[str] = (), levels: int = LEVELS
) -> DataFrame:
    """Per row: the columns ``keep``, its ``leaf``, the ``path`` (what stands before and after it at each
    level, bottom to top), the ``subroot`` of its ``tree`` and the ``root`` of all.

    Rows of a tree ascend by ``order`` (null first), equal ones by their leaf; trees ascend by
    ``tree``, null being one of them and the first. Equal rows are leaves of their own. No rows
    give no rows. Columns to keep that are named as the new ones are left out.

    Only digests and kept columns are shuffled, never what the leaves are made of. A tree that
    holds most rows is cut into ranges and blocks like any other. A tier is written once and
    has one row per block; the tiers are as many as digits of the largest tree need.
    """
    kept = [c for c in keep if c not in NEW]
    leaves = rows.select(
        F.col(tree).alias("tree"), F.col(order).alias("order"), leaf.alias("digest"), F.struct(*kept).alias("kept") if kept else F.lit(None).alias("kept")
    )
    leaves = written(leaves, "merkle-leaves").withColumn("held", F.struct(F.col("digest").alias("leaf"), "kept")).drop("kept")
    nodes = _ranked(leaves, ["tree"], ["order", "digest"])

    tiers: list[tuple[DataFrame, list[str]]] = []
    for keys in (["tree"], []):
        while True:
            tier = written(_nested(nodes, keys, levels), "merkle-blocks")
            tiers.append((tier, keys))
            if (tier.agg(F.max("n")).first()[0] or 0) <= RUN**levels:
                break
            above = F.ceil(F.col("n") / RUN**levels).alias("n")
            nodes = tier.select(*keys, F.col("block").alias("rank"), above, "digest", F.struct(*keys, "block").alias("held"))
        if keys:
            crests = tier.select("tree", "digest", F.struct("tree", "block").alias("held"))
            nodes = _ranked(crests, [], ["tree"])

    crest = len([keys for _, keys in tiers if keys]) - 1
    found = None
    for i in reversed(range(len(tiers))):
        tier, keys = tiers[i]
        if found is None:
            met = tier.withColumns({"above": F.array().cast(NO_STEPS), "root": F.col("digest"), "subroot": F.lit(None).cast("string")})
        else:
            known = found.select("held.*", F.col("path").alias("above"), "subroot", "root")
            both = tier.unionByName(known, allowMissingColumns=True)
            # the two rows of a block, its own and what the tier above knows of it, become one
            carried = [c for c in both.columns if c not in (*keys, "block")]
            met = both.groupBy(*keys, "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in carried])
        if i == crest:
            met = met.withColumn("subroot", F.col("digest"))
        found = _unfolded(met, levels)
    return found.select(*[F.col("held.kept")[c].alias(c) for c in kept], F.col("held.leaf").alias("leaf"), "path", "subroot", "root")

"""Merkle manifest of a dataset: per group a tree over its rows, and one tree over the groups' roots.

Rows are leaves, numbered by slots without gaps in each group. A window over one block of slots holds several levels at
once: at level l a node stands in the row of its first leaf, its siblings stand ``arity ** l`` rows before or after it, so
lag and lead columns with fixed offsets, masked by the slot and by the length of the run, supply them, and the row of the first
child hashes the parent. A block is one window partition of ``arity ** LEVELS`` rows, whatever the size of the group; the tops
of the blocks are the leaves of the next tier, so a group of any size is a few tiers, and no group passes through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored

#: Levels that one tier climbs.
LEVELS = 8
HOP = "struct<before:string,after:string>"


def digest(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the parts on end."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as ``length:value`` with the length in UTF-8 bytes; a null as ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: list[Column]) -> Column:
    return digest(*[field(c) for c in columns])


def numbered(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` plus slot (from 0, in the order given) and n, the number of rows, in each group; and the largest n.

    Spark sorts by ranges over (group, order, a running number), so a group or a row that repeats spreads over many tasks; each range
    counts its rows by group and starts at the sum of the ranges before it.
    """
    keys = [F.col(group), *[F.col(c) for c in order], F.col("_tie")]
    ranged = stored(rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "merkle-ranges")
    within = Window.partitionBy(group).orderBy("_part")
    starts = stored(ranged.groupBy(group, "_part").agg(F.count("*").alias("_here")).select(
        F.col(group).alias("_group"), F.col("_part").alias("_of"), F.sum("_here").over(Window.partitionBy(group)).alias("n"),
        F.coalesce(F.sum("_here").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start")), "merkle-starts")
    local = F.row_number().over(Window.partitionBy("_part", group).orderBy(*order, "_tie")) - 1
    placed = (ranged.withColumn("_local", local).join(starts, (F.col(group) == F.col("_group")) & (F.col("_part") == F.col("_of")))
              .select(*rows.columns, (F.col("_start") + F.col("_local")).cast("long").alias("slot"), "n"))
    return placed, starts.agg(F.max("n")).first()[0] or 0


def _tier(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` (grp, slot, n, digest, ...) plus block, hops (siblings per level inside the block) and top (in a block's first row)."""
    kept, slot = nodes.columns, F.col("slot")
    rows = nodes.select(*kept, F.expr(f"slot div {arity ** LEVELS}L").alias("block"), F.col("digest").alias("top"))
    window = Window.partitionBy("grp", "block").orderBy("slot")
    names = []
    for level in range(LEVELS):
        step = arity ** level
        width = F.expr(f"(n + {step - 1}L) div {step}L")
        place = F.expr(f"(slot div {step}L) % {arity}L")
        run = F.least(F.lit(arity).cast("long"), width - F.expr(f"slot div {step * arity}L") * arity)
        lags = [F.lag("top", k * step).over(window).alias(f"_lag{k}") for k in range(1, arity)]
        leads = [F.lead("top", k * step).over(window).alias(f"_lead{k}") for k in range(1, arity)]
        before = F.concat(F.lit(""), *[F.when(place >= k, F.col(f"_lag{k}")).otherwise("") for k in range(arity - 1, 0, -1)])
        after = F.concat(F.lit(""), *[F.when(place + k < run, F.col(f"_lead{k}")).otherwise("") for k in range(1, arity)])
        parent = F.when(width <= 1, F.col("top")).when(slot % (step * arity) == 0, digest(F.col("top"), after))
        hop = F.when((slot % step == 0) & (width > 1), F.struct(before.alias("before"), after.alias("after")))
        rows = rows.select("*", *lags, *leads).select(*kept, "block", *names, hop.alias(f"_hop{level}"), parent.alias("top"))
        names.append(f"_hop{level}")
    # The ancestor of a row is the last node row up to it; levels above the root have none.
    hops = [F.last(name, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0)).alias(name) for name in names]
    return rows.select(*kept, "block", "top", *hops).select(*kept, "block", "top", F.array_compact(F.array(*names)).alias("hops"))


def paths(nodes: DataFrame, longest: int, arity: int) -> DataFrame:
    """``nodes`` (grp, slot, n, digest, ...) plus hops up to the group's root, and root; a lone node is its own root.

    A hop has the siblings before and after the node, as digests on end. Tiers are written: each has ``arity ** LEVELS`` times
    fewer rows than the one below. ``longest`` is the largest n.
    """
    if longest <= 1:
        return nodes.withColumn("hops", F.array().cast(f"array<{HOP}>")).withColumn("root", F.col("digest"))
    block = arity ** LEVELS
    tier = stored(_tier(nodes, arity), "merkle-tier")
    tops = (tier.filter(F.col("slot") % block == 0)
            .select("grp", F.col("block").alias("slot"), F.expr(f"(n + {block - 1}L) div {block}L").alias("n"), F.col("top").alias("digest")))
    above = paths(tops, -(-longest // block), arity).select("grp", F.col("slot").alias("block"), F.col("hops").alias("_above"), "root")
    return tier.join(above, ["grp", "block"]).withColumn("hops", F.concat("hops", "_above")).drop("block", "top", "_above")


def proof_digest(hops: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(hops, lambda x: F.concat(x["before"], x["after"]))), 256)


def fold(leaf: Column, hops: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(hops, leaf, lambda now, x: digest(x["before"], now, x["after"]))


def manifest(rows: DataFrame, group_col: str, order_cols: list[str], leaf_col: str = "leaf", keep: tuple[str, ...] = (), arity: int = 2) -> DataFrame:
    """One row per input row: columns of ``keep``, leaf, subroot, root and hops, its path to the root.

    Leaves stand in the order of ``order_cols`` (nulls first), then of their digests; equal leaves have slots of their own. A null
    group is a group of its own, the first; groups are ordered bytewise. While a level has several nodes every ``arity`` of them are
    hashed, a shorter last run too; a lone leaf is its group's root and a lone group's root is the root. ``verify`` needs only a
    leaf, its hops and the root. Other columns are not read, so their names cannot clash. An empty table gives no rows.
    """
    if arity < 2:
        raise ValueError("arity must be two or more")
    order = [f"_order{i}" for i in range(len(order_cols))]
    keyed = rows.select(F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("grp"), F.col(leaf_col).alias("digest"),
                        *[F.col(c).alias(o) for c, o in zip(order_cols, order)], *[F.col(c).alias(f"keep_{c}") for c in keep])
    own = paths(*numbered(keyed, "grp", [*order, "digest"]), arity)
    subroots = own.filter("slot = 0").select(F.lit("").alias("grp"), F.col("grp").alias("_key"), F.col("root").alias("digest"))
    tops = stored(paths(*numbered(subroots, "grp", ["_key"]), arity)
                  .select(F.col("_key").alias("grp"), F.col("digest").alias("subroot"), F.col("hops").alias("_above"), F.col("root").alias("_root")), "merkle-groups")
    return own.join(tops, "grp").select(*[F.col(f"keep_{c}").alias(c) for c in keep], F.col("digest").alias("leaf"), "subroot",
                                        F.col("_root").alias("root"), F.concat("hops", "_above").alias("hops"))


def verify(proofs: DataFrame, leaf_col: str = "leaf") -> DataFrame:
    """``proofs`` (a leaf, hops, root) plus folded_root and verified: whether the leaf is the one the manifest was made of."""
    return proofs.withColumn("folded_root", fold(F.col(leaf_col), F.col("hops"))).withColumn("verified", F.col("folded_root") == F.col("root"))

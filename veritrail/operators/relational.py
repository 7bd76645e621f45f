"""Operators on rows: keep-latest, resolution by routes, ordering without a single task, set and pair forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def latest(df: DataFrame, keys: Sequence[str], by: str = "ingested_at", ties: Sequence[str] | None = None) -> DataFrame:
    """One row a key: the one with the largest `by`, nulls last; ties go to the smallest of all other columns in their order.

    The rank limit is applied to each task's rows before the shuffle too, so that a hot key costs no task more than a row from each.
    Rows are carried once; there is one exchange. Maps count as their entries in order."""

    def comparable(c: str) -> Column:
        return F.array_sort(F.map_entries(c)) if df.schema[c].dataType.typeName() == "map" else F.col(c)

    order = [comparable(c) for c in (ties if ties is not None else df.columns) if c != by and c not in keys]
    return top_in_group(df, keys, [F.desc_nulls_last(by), *order], 1)


def resolved(facts: DataFrame, routes: Sequence[tuple[str, Column, DataFrame | None, Sequence[str]]], tag: str = "resolved_via") -> DataFrame:
    """Resolves facts by the first route whose condition holds.

    A route: name, condition, lookup (or None: the fact holds the answer already), the columns to join on."""
    out, before = None, F.lit(False)
    for name, condition, lookup, on in routes:
        mine = facts.where(~before & F.coalesce(condition, F.lit(False)))
        part = (mine if lookup is None else mine.join(lookup, list(on))).withColumn(tag, F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        before = before | F.coalesce(condition, F.lit(False))
    return out


def numbered(df: DataFrame, order: Sequence[Column], name: str = "rank", weight: Column | None = None, running: str | None = None) -> DataFrame:
    """Row numbers from 1 in a global order, and a running sum of a weight, without one task for all rows.

    Rows are dealt by ranges of the order; each range is numbered by itself and raised by what the ranges before
    hold. The order should be total for the numbers to be the same in every run."""
    base = df.withColumn("_w", (weight if weight is not None else F.lit(1)).cast("double"))
    ranged = base.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    ranged = cut(ranged)  # ranges are sampled: they are fixed before two readers rely on them
    sums = ranged.groupBy("_part").agg(F.count("*").alias("_n"), F.sum("_w").alias("_s"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    sums = sums.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_s").over(before), F.lit(0.0)).alias("_s0"))
    inside = Window.partitionBy("_part").orderBy(*order)
    out = ranged.withColumn("_k", F.row_number().over(inside)).withColumn("_c", F.sum("_w").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    out = out.join(F.broadcast(sums), F.col("_part") == F.col("_p")).withColumn(name, (F.col("_n0") + F.col("_k")).cast("long"))
    if running:
        out = out.withColumn(running, F.col("_s0") + F.col("_c"))
    return out.drop("_w", "_part", "_p", "_k", "_c", "_n0", "_s0")


def unordered_pairs(df: DataFrame, on: Sequence[str], member: str, *carry: str) -> DataFrame:
    """(on, a, b) for members a < b of a group, with columns a_<c> and b_<c> for each c carried. Groups must be bounded before, as by hub suppression."""

    def side(name: str) -> DataFrame:
        return df.select(*on, F.col(member).alias(name), *[F.col(c).alias(f"{name}_{c}") for c in carry])

    return side("a").join(side("b"), list(on)).where("a < b")


def top_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of each group; the rank limit is applied before the shuffle too."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def both_ways(edges: DataFrame, src: str = "src", dst: str = "dst", keep: Sequence[str] = ()) -> DataFrame:
    """Each edge and its reverse, once."""
    there = edges.select(*keep, F.col(src).alias("src"), F.col(dst).alias("dst"))
    return there.unionByName(there.select(*keep, F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()

"""A running sum that is kept inside bounds at every step."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.session import shuffle_sized_for, stored

# A group of up to so many rows is gathered in one row and folded there.
MOST_GATHERED = 16_384
# Rows of a block, and nodes that a node of the tree has, in groups that are larger.
_FAN_BITS = 8
_FAN = 1 << _FAN_BITS


def bounded_running_sum(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    delta: str,
    start: float,
    bounds: tuple[float, float],
    name: str,
    most_gathered: int = MOST_GATHERED,
) -> DataFrame:
    """Add `name`: per group, in order, `level = clamp(level + delta)`, beginning with `start`.

    A window cannot express a clamp at each step. The groups are counted first, without a shuffle of
    rows. Are all of them within `most_gathered`, each is gathered and folded in one row. Otherwise
    the rows are sorted over all tasks and cut into blocks of 256, wherever the cuts fall, so a group
    of any share of the data lies in many tasks. The effect of a block on the level is again a clamped
    sum, `min(ceiling, max(floor, level + total))`, and such effects compose: a tree with 256 nodes
    below each node gives the level that every block opens with, and from there its rows are folded.
    All of it is built-in expressions, and no row gathers more than 256 rows or nodes.

    `order` must be unique within a group. NULL and NaN deltas count as 0.
    """
    group, order, columns = list(group), list(order), df.columns
    low, high = (float(b) for b in bounds)

    def clamp(x: Column) -> Column:
        return F.least(F.lit(high), F.greatest(F.lit(low), x))

    # an infinite delta is as good as one that leads from anywhere beyond the bounds, and can be added up
    huge = 2 * (abs(low) + abs(high) + abs(start)) + 1
    step = F.coalesce(F.nanvl(F.col(delta).cast("double"), F.lit(0.0)), F.lit(0.0))
    step = F.least(F.lit(huge), F.greatest(F.lit(-huge), step)) if math.isfinite(huge) else step
    keys, places = [f"g{i}" for i in range(len(group))], [f"o{i}" for i in range(len(order))]
    rows = df.select(
        *[F.col(c).alias(k) for c, k in zip(group, keys)],
        F.struct(*[F.col(c).alias(o) for c, o in zip(order, places)], step.alias("step"), F.struct(*columns).alias("row")).alias("x"),
    )

    def levels(steps: Column, opening: Column) -> Column:
        """The level after each of some steps; many are folded by the block, as an array grows by copying."""

        def fold(steps, first):
            return F.slice(_running(steps, first, lambda level, x: clamp(level + x)), 2, _FAN)

        def block(done, b):
            last = F.element_at(F.element_at(done, -1), -1)
            return F.concat(done, F.array(fold(F.slice(steps, b * _FAN + 1, F.lit(_FAN)), last)))

        blocks = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _FAN).cast("int"))
        done = F.aggregate(blocks, F.array(F.array(opening)), block)
        many = F.flatten(F.slice(done, F.lit(2), F.size(done)))
        return F.when(F.size(steps) <= _FAN, fold(steps, opening)).otherwise(many)

    def finished(blocks: DataFrame, opening: Column) -> DataFrame:
        zipped = F.arrays_zip(F.col("rows.row").alias("row"), levels(F.col("rows.step"), opening).alias("level"))
        return blocks.select(F.inline(zipped).alias("row", "level")).select("row.*", F.col("level").alias(name))

    with shuffle_sized_for(df) as partitions:
        largest = rows.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        if largest <= most_gathered:
            # dealt out by name: the plan of the result is made outside of this block
            dealt = rows.repartition(partitions, *keys) if keys else rows
            groups = dealt.groupBy(*keys).agg(F.sort_array(F.collect_list("x")).alias("rows"))
            return finished(groups, F.lit(float(start)))
        blocks = _blocks(rows, keys, places, clamp, partitions)
        openings = _openings(blocks.select(*keys, "node", "effect"), keys, float(start))
        return finished(_with_opening(blocks, openings, keys), F.col("opening"))


def _running(items: Column, first: Column, further) -> Column:
    """`first`, and what `further` makes of it with each item: one value more than items."""
    return F.aggregate(items, F.array(first), lambda done, x: F.concat(done, F.array(further(F.element_at(done, -1), x))))


def _applied(effect: Column, level: Column) -> Column:
    return F.least(effect["ceiling"], F.greatest(effect["floor"], level + effect["total"]))


def _blocks(rows: DataFrame, keys: list[str], places: list[str], clamp, partitions: int) -> DataFrame:
    """Stored: the group, node (number of the block in order), its rows in order, and their effect."""
    nothing = F.struct(F.lit(0.0).alias("total"), F.lit(-math.inf).alias("floor"), F.lit(math.inf).alias("ceiling"))

    def further(done, x):
        return F.struct(
            (done["total"] + x["step"]).alias("total"),
            clamp(done["floor"] + x["step"]).alias("floor"),
            clamp(done["ceiling"] + x["step"]).alias("ceiling"),
        )

    sequence = [*keys, *[f"x.{o}" for o in places]]
    blocks = (
        rows.repartitionByRange(partitions, *sequence)
        .sortWithinPartitions(*sequence)
        .withColumn("node", F.shiftright(F.monotonically_increasing_id(), _FAN_BITS))
        .groupBy(*keys, "node")
        .agg(F.sort_array(F.collect_list("x")).alias("rows"))
        .withColumn("effect", F.aggregate("rows", nothing, further))
    )
    # stored, as the ranges of another evaluation would be others
    return stored(blocks, "blocks")


def _openings(nodes: DataFrame, keys: list[str], start: float) -> DataFrame:
    """(keys, node, opening): the level before each node, by a tree over the nodes' effects."""

    def both(done, x):
        e = x["effect"]
        return F.struct(
            (done["total"] + e["total"]).alias("total"),
            _applied(e, done["floor"]).alias("floor"),
            _applied(e, done["ceiling"]).alias("ceiling"),
        )

    def below(nodes: DataFrame, *parent: Column) -> DataFrame:
        return nodes.groupBy(*keys, *parent).agg(F.sort_array(F.collect_list(F.struct("node", "effect"))).alias("kids"))

    def opened(parents: DataFrame, opening: Column) -> DataFrame:
        levels = _running(F.col("kids"), opening, lambda level, x: _applied(x["effect"], level))
        zipped = F.arrays_zip(F.col("kids.node").alias("node"), F.slice(levels, F.lit(1), F.size("kids")).alias("opening"))
        return parents.select(*keys, F.inline(zipped).alias("node", "opening"))

    tiers = []
    while (nodes.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0) > _FAN:
        tiers.append(below(nodes, F.shiftright("node", _FAN_BITS).alias("parent")))
        all_kids = F.aggregate(F.slice("kids", F.lit(2), F.lit(_FAN)), F.col("kids")[0]["effect"], both)
        nodes = tiers[-1].select(*keys, F.col("parent").alias("node"), all_kids.alias("effect"))
    openings = opened(below(nodes), F.lit(start))
    for tier in reversed(tiers):
        openings = opened(_with_opening(tier.withColumnRenamed("parent", "node"), openings, keys), F.col("opening"))
    return openings


def _with_opening(nodes: DataFrame, openings: DataFrame, keys: list[str]) -> DataFrame:
    of = openings.select(*[F.col(c).alias(f"of_{c}") for c in [*keys, "node"]], "opening")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in [*keys, "node"]])
    return nodes.join(of.hint("merge"), same)  # a broadcast could leave all rows to one task

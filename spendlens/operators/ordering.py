"""Numbering, running totals and neighbours along an order, for groups of any size.

A plain window puts a whole group into one task. Here the rows are sorted across the cluster
instead and written with their (task, position) pair: a range of the sort is one shuffle partition, however hot its key is, and only one carry
row per range has to travel between ranges.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from spendlens.session import materialize

PLACE = "_place"  # task number in the upper bits, position within the task in the lower 33
PART = "_part"
POSITION = "_position"


def ordered(df: DataFrame, *order: str | Column) -> DataFrame:
    """Sort ``df`` globally and keep the order as the columns ``_part`` and ``_position``.

    The order must be total, so that a repeated task yields the same positions.
    """
    ranked = df.orderBy(*order).withColumn(PLACE, F.monotonically_increasing_id())
    return (
        materialize(ranked, "ordered", "zstd")
        .withColumn(PART, F.shiftright(PLACE, 33))
        .withColumn(POSITION, F.col(PLACE).bitwiseAND((1 << 33) - 1))
        .drop(PLACE)
    )


def without_order(rows: DataFrame) -> DataFrame:
    return rows.drop(PART, POSITION)


def row_index(rows: DataFrame, name: str) -> DataFrame:
    """Dense 1-based number over the whole order."""
    sizes = rows.groupBy(PART).agg(F.count("*").alias("_size"))
    # one row per sorted range, so both the window and the broadcast are bounded
    starts = starts_of(sizes, PART)
    return (
        rows.join(F.broadcast(starts), PART)
        .withColumn(name, F.col("_start") + F.col(POSITION) + 1)
        .drop("_start")
    )


RANGES_PER_TASK = 16  # ranges are dealt to tasks by a hash, so there are several for each
KEYS_PER_RANGE = 8


def with_range(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Add the number of the range of ``keys`` that a row is in: ranges follow the order of the keys and hold about as many rows each.

    ``rows`` must be stored: they are counted, and the borders are taken from keys that a hash picks, so that a repeated task gives the same
    numbers. Equal keys are in one range.
    """
    count = RANGES_PER_TASK * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    step = max(1, rows.count() // (count * KEYS_PER_RANGE))
    # a bounded number of different keys, whatever the rows
    picked = rows.where(F.pmod(F.xxhash64(*keys), F.lit(step)) == 0).select(*keys).distinct().orderBy(*keys)
    texts = [row[0] for row in picked.select(F.to_json(F.struct(*keys))).collect()]
    borders = [texts[i * len(texts) // count] for i in range(1, count)] if len(texts) >= count else texts
    known = F.from_json(F.lit(f"[{', '.join(borders)}]"), T.ArrayType(rows.select(*keys).schema))
    found, width = rows.withColumn(name, F.lit(0)), 1 << len(borders).bit_length()
    # a search by halves: one comparison for each bit of the number
    while width := width // 2:
        passed = F.get(known, F.col(name) + (width - 1)) <= F.struct(*keys)
        found = found.withColumn(name, F.col(name) + F.when(passed, width).otherwise(0))
    return found


def starts_of(sizes: DataFrame, part: str) -> DataFrame:
    """(part, _start): the rows in the ranges before each, from a ``_size`` for every range. There is one row per range."""
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(part, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))


def running_total(rows: DataFrame, groups: Sequence[str], value: Column, name: str) -> DataFrame:
    """Sum of ``value`` within the group up to and including the row.

    ``rows`` must be ordered by the groups first.
    """
    valued = rows.withColumn("_value", value)
    within = (
        Window.partitionBy(PART, *groups).orderBy(POSITION)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    pieces = valued.groupBy(PART, *groups).agg(F.sum("_value").alias("_piece"))
    # a group has one piece per range it spans; a range can only continue its first group
    earlier = Window.partitionBy(*groups).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.select(
        F.col(PART).alias("_carry_part"),
        *[F.col(group).alias(f"_carry_{group}") for group in groups],
        F.sum("_piece").over(earlier).alias("_carry"),
    ).where(F.col("_carry").isNotNull())
    same_piece = F.col(PART) == F.col("_carry_part")
    for group in groups:
        same_piece &= F.col(group).eqNullSafe(F.col(f"_carry_{group}"))
    return (
        valued.withColumn("_within", F.sum("_value").over(within))
        .join(F.broadcast(carried), same_piece, "left")
        .withColumn(name, F.col("_within") + F.coalesce(F.col("_carry"), F.lit(0)))
        .select(*rows.columns, name)
    )


def last_known(rows: DataFrame, groups: Sequence[str], value: Column, name: str) -> DataFrame:
    """The latest non-null ``value`` of the group up to and including the row, over the borders of ranges.

    ``rows`` must be ordered by the groups first. One row per range and group piece travels between ranges.
    """
    boxed = F.when(value.isNotNull(), F.struct(value.alias("value")))
    valued = rows.withColumn("_value", boxed)
    within = (
        Window.partitionBy(PART, *groups).orderBy(POSITION)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    pieces = valued.where(F.col("_value").isNotNull()).groupBy(PART, *groups).agg(F.max_by("_value", POSITION).alias("_piece"))
    # only the last group of a range goes on in the next one, so one value per range is carried: that of its last group
    ends = rows.groupBy(PART).agg(F.max(POSITION).alias(POSITION))
    last_groups = rows.join(F.broadcast(ends), [PART, POSITION]).select(PART, *groups)
    known = last_groups.alias("g").join(
        pieces.alias("p"), (F.col(f"g.{PART}") == F.col(f"p.{PART}")) & _same_groups("g", "p", groups), "left",
    ).select(F.col(f"g.{PART}").alias(PART), *[F.col(f"g.{group}").alias(group) for group in groups], "_piece")
    # a group may cover whole ranges that say nothing of it
    earlier = Window.partitionBy(*groups).orderBy(PART).rowsBetween(Window.unboundedPreceding, 0)
    so_far = known.withColumn("_piece", F.last("_piece", ignorenulls=True).over(earlier))
    following_part = F.lead(PART).over(Window.orderBy(PART))
    parts = rows.select(PART).distinct().select(PART, following_part.alias("_carry_part"))
    carried = so_far.join(F.broadcast(parts), PART).where(F.col("_piece").isNotNull() & F.col("_carry_part").isNotNull()).select(
        "_carry_part", *[F.col(group).alias(f"_carry_{group}") for group in groups], F.col("_piece").alias("_carry"))
    same_piece = F.col(PART) == F.col("_carry_part")
    for group in groups:
        same_piece &= F.col(group).eqNullSafe(F.col(f"_carry_{group}"))
    return (
        valued.withColumn("_within", F.last("_value", ignorenulls=True).over(within))
        .join(F.broadcast(carried), same_piece, "left")
        .withColumn(name, F.coalesce("_within", "_carry").getField("value"))
        .select(*rows.columns, name)
    )


def _same_groups(left: str, right: str, groups: Sequence[str]) -> Column:
    same = F.lit(True)
    for group in groups:
        same &= F.col(f"{left}.{group}").eqNullSafe(F.col(f"{right}.{group}"))
    return same


def cumulate(df: DataFrame, groups: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Sum of ``value`` per group along a total order, up to and including the row."""
    return without_order(running_total(ordered(df, *groups, *order), groups, value, name))


def number_in_groups(df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``row_number`` per group along a total order."""
    return cumulate(df, groups, order, F.lit(1).cast("bigint"), name)


def following(rows: DataFrame, groups: Sequence[str], column: str, name: str) -> DataFrame:
    """``lead(column)`` per group along the order."""
    return _neighbour(rows, groups, column, name, forward=True)


def preceding(rows: DataFrame, groups: Sequence[str], column: str, name: str) -> DataFrame:
    """``lag(column)`` per group along the order."""
    return _neighbour(rows, groups, column, name, forward=False)


def _neighbour(rows: DataFrame, groups: Sequence[str], column: str, name: str, forward: bool) -> DataFrame:
    boxed = F.struct(F.col(column).alias("value"))
    shift = F.lead if forward else F.lag
    within = Window.partitionBy(PART, *groups).orderBy(POSITION)
    # the row at the near end of the adjacent range, one per range
    edge = F.min(F.col(POSITION)) if forward else F.max(F.col(POSITION))
    ends = rows.groupBy(PART).agg(edge.alias(POSITION))
    edges = rows.join(F.broadcast(ends), [PART, POSITION]).select(
        PART, F.struct(*[F.col(group).alias(f"g{i}") for i, group in enumerate(groups)],
                       F.col(column).alias("value")).alias("_edge"),
    )
    adjacent = edges.select(PART, shift("_edge").over(Window.orderBy(PART)).alias("_edge"))
    same_group = F.col("_edge").isNotNull()
    for i, group in enumerate(groups):
        same_group &= F.col(group).eqNullSafe(F.col(f"_edge.g{i}"))
    return (
        rows.withColumn("_near", shift(boxed).over(within))
        .join(F.broadcast(adjacent), PART, "left")
        .withColumn(
            name,
            F.when(F.col("_near").isNotNull(), F.col("_near.value"))
            .when(same_group, F.col("_edge.value")),
        )
        .select(*rows.columns, name)
    )

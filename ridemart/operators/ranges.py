"""Joining values to the ranges that hold them, as an equi-join by bins of several sizes, or summing them by range."""

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

# Ranges without a lower or an upper end, and empty bins, have no size of their own.
OPEN = 1 << 20
_LEVEL, _BIN = "_range_level", "_range_bin"
# Rows and range ends that one block of the axis of values may hold, about.
BLOCK_ROWS = 500_000
_BLOCK, _AT, _ROWS = "_range_block", "_range_at", "_range_rows"


def _size(level: Column) -> Column:
    return F.pow(F.lit(2.0), level)


def binned_ranges(ranges: DataFrame, low: str, high: str) -> DataFrame:
    """The ranges once per bin that they touch. A range is in bins of about its own length: it touches two or three."""
    a, b = F.col(low).cast("double"), F.col(high).cast("double")
    closed = a.isNotNull() & b.isNotNull()
    level = F.when(closed, F.ceil(F.log2(b - a))).otherwise(F.lit(OPEN)).cast("int")
    first, last = F.floor(a / _size(F.col(_LEVEL))), F.floor(b / _size(F.col(_LEVEL)))
    bins = F.when(F.col(_LEVEL) == OPEN, F.array(F.lit(0).cast("bigint"))).otherwise(F.sequence(first, last))
    return ranges.filter(~closed | (b > a)).withColumn(_LEVEL, level).withColumn(_BIN, F.explode(bins))


def join_ranges(
    rows: DataFrame, ranges: DataFrame, value: str, low: str, high: str, summed: bool = False,
) -> DataFrame:
    """Each row with each range that holds its value: ``low`` <= value < ``high``; an inner join.

    Ranges may overlap, lie within each other and differ in length by any factor. NULL ends are open, a NULL
    value is in no range, and ranges that hold nothing are ignored. A row looks into one bin per size of bin in
    use, which are as many as the lengths of ranges have powers of two; so both sides meet by hashing, and
    neither is compared with all of the other. The ranges may be too many to broadcast. Columns of both sides
    come out as they are; the ranges' must have other names than the rows'.

    The pairs grow with the rows times the ranges. ``summed`` gives each range once, with the number of rows that it
    holds (``rows_held``) and the ``least`` and ``most`` value of them, and forms no pairs; see ``_sum_ranges``.
    """
    if summed:
        return _sum_ranges(rows, ranges, value, low, high)
    binned = binned_ranges(ranges, low, high)
    levels = [row[0] for row in binned.select(_LEVEL).distinct().collect()]
    number = F.col(value).cast("double")
    keys = [
        F.struct(F.lit(level).alias(_LEVEL), (F.lit(0) if level == OPEN else F.floor(number / F.lit(2.0 ** level))).cast("bigint").alias(_BIN))
        for level in sorted(levels)
    ]
    if not keys:
        return rows.join(binned.drop(_LEVEL, _BIN), F.lit(True), "inner").filter(F.lit(False))
    looked = rows.filter(number.isNotNull() & ~F.isnan(number)).select("*", F.inline(F.array(*keys)))
    holds = (F.col(low).isNull() | (F.col(value) >= F.col(low))) & (F.col(high).isNull() | (F.col(value) < F.col(high)))
    return looked.join(binned, [_LEVEL, _BIN]).filter(holds).drop(_LEVEL, _BIN)


def _sum_ranges(rows: DataFrame, ranges: DataFrame, value: str, low: str, high: str) -> DataFrame:
    """Ranges with what they hold, by the order of values: those before the upper end without those before the lower.

    Values and ends meet as distinct places on one axis, which is cut into blocks of about BLOCK_ROWS rows. Within a
    block running sums tell of each place how many rows lie before it and which values are next to it, and sums by
    block tell of the blocks before. So each row and each range is sorted once, however much the ranges overlap.
    """
    a, b, number = F.col(low), F.col(high), F.col(value)
    kept = ranges.filter(a.isNull() | b.isNull() | (b.cast("double") > a.cast("double")))
    found = rows.filter(number.isNotNull() & ~F.isnan(number.cast("double")))
    whole = found.agg(F.count(F.lit(1)).alias("rows"), F.min(value).alias("least"), F.max(value).alias("most"))
    total = whole.first()
    ends = kept.select(F.explode(F.array(a, b)).alias(_AT), F.lit(0).cast("bigint").alias(_ROWS)).filter(F.col(_AT).isNotNull())
    places = found.select(number.alias(_AT), F.lit(1).cast("bigint").alias(_ROWS)).unionByName(ends)
    places = _in_blocks(places, (total["rows"] + ends.count()) // BLOCK_ROWS + 1)

    taken = F.when(F.col(_ROWS) > 0, F.col(_AT))
    blocks = places.groupBy(_BLOCK).agg(
        F.sum(_ROWS).alias("_in_block"), F.min(taken).alias("_block_least"), F.max(taken).alias("_block_most"),
    )
    # A row per block: the window's one task sees nothing else.
    by_block = Window.orderBy(_BLOCK)
    earlier, later = by_block.rowsBetween(Window.unboundedPreceding, -1), by_block.rowsBetween(1, Window.unboundedFollowing)
    blocks = blocks.select(
        _BLOCK, F.coalesce(F.sum("_in_block").over(earlier), F.lit(0)).alias("_earlier"),
        F.max("_block_most").over(earlier).alias("_earlier_most"), F.min("_block_least").over(later).alias("_later_least"),
    )
    up = Window.partitionBy(_BLOCK).orderBy(_AT).rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(_BLOCK).orderBy(F.desc(_AT)).rowsBetween(Window.unboundedPreceding, 0)
    distinct = places.groupBy(_BLOCK, _AT).agg(F.sum(_ROWS).alias(_ROWS), (F.min(_ROWS) == 0).alias("_is_end"))
    near = distinct.select(
        _BLOCK, _AT, "_is_end", F.coalesce(F.sum(_ROWS).over(up), F.lit(0)).alias("_before"),
        F.max(taken).over(up).alias("_last"), F.min(taken).over(down).alias("_next"),
    ).filter("_is_end").join(F.broadcast(blocks), _BLOCK)
    before = F.col("_before") + F.col("_earlier")
    lows = near.select(
        F.col(_AT).alias("_low_at"), before.alias("_before_low"), F.coalesce("_next", "_later_least").alias("_from_low"),
    )
    highs = near.select(
        F.col(_AT).alias("_high_at"), before.alias("_before_high"), F.coalesce("_last", "_earlier_most").alias("_to_high"),
    )
    held = kept.join(lows, a == F.col("_low_at"), "left").join(highs, b == F.col("_high_at"), "left")
    kind = found.schema[value].dataType
    below = F.when(a.isNull(), F.lit(0)).otherwise(F.col("_before_low"))
    through = F.when(b.isNull(), F.lit(total["rows"])).otherwise(F.col("_before_high"))
    least = F.when(a.isNull(), F.lit(total["least"])).otherwise(F.col("_from_low"))
    most = F.when(b.isNull(), F.lit(total["most"])).otherwise(F.col("_to_high"))
    return held.select(
        *[F.col(name) for name in ranges.columns], (through - below).alias("rows_held"),
        least.cast(kind).alias("least"), most.cast(kind).alias("most"),
    ).filter(F.col("rows_held") > 0)


def _in_blocks(places: DataFrame, blocks: int) -> DataFrame:
    """Places with the number of their block, in order: cut at quantiles, so that a place has one block whatever task sees it."""
    at = F.col(_AT).cast("double")
    cuts = []
    if blocks > 1:
        shares = [k / blocks for k in range(1, blocks)]
        cuts = places.filter(~F.isnan(at)).agg(F.percentile_approx(at, shares, max(10_000, 10 * blocks))).first()[0] or []
    splits = [-math.inf, *sorted({cut for cut in cuts if math.isfinite(cut)}), math.inf]
    if len(splits) < 3:
        return places.withColumn(_BLOCK, F.lit(0.0))
    cut = Bucketizer(splits=splits, inputCol="_place", outputCol=_BLOCK, handleInvalid="keep")
    return cut.transform(places.withColumn("_place", at)).drop("_place")

"""Hierarchical grid cells as native column expressions.

The grid is a quadtree over plain longitude/latitude degrees. A cell at level ``z`` is a string of
``z`` digits 0-3, most significant first; digit = x bit + 2 * y bit, x growing east and y growing south.
A parent is therefore a prefix, and all of this stays inside whole-stage code generation.
"""

from functools import reduce

from pyspark.sql import Column, functions as F

GRID_LEVEL = 15      # about 0.9 x 0.6 km at latitude 40
REGION_LEVEL = 12    # about 7 x 5 km
DISTRICT_LEVEL = 11  # about 15 x 10 km
MAX_LEVEL = 18       # a cell read as a decimal number must fit a bigint


def _bucket(offset: Column, span: float, level: int) -> Column:
    buckets = 1 << level
    return F.least(F.floor(offset / F.lit(span) * F.lit(buckets)), F.lit(buckets - 1))


# The numbers of five bits, their binary digits read as decimal ones.
_BITS = 5
_DECIMAL = tuple(int(f"{bits:b}") for bits in range(1 << _BITS))


def _decimal_bits(bucket: Column, level: int) -> Column:
    """The bucket's binary digits read as a decimal number, five at a time: sums of numbers, no text is made."""
    digits = F.array(*[F.lit(value).cast("bigint") for value in _DECIMAL])
    parts = [
        F.get(digits, F.shiftright(bucket, low).bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")) * F.lit(10 ** low)
        for low in range(0, level, _BITS)
    ]
    return reduce(Column.__add__, parts)


def geo_cell(lat: Column, lon: Column, level: int = GRID_LEVEL) -> Column:
    """The cell holding a point; NULL for a NULL, NaN or out-of-range coordinate."""
    if not 1 <= level <= MAX_LEVEL:
        raise ValueError(f"level must be between 1 and {MAX_LEVEL}, not {level}")
    # An axis bucket's bits, read as decimal digits, are 0/1 per digit, so x + 2y puts each bit pair into its own
    # decimal digit without any carry: the sum's digits are the cell.
    x = _decimal_bits(_bucket(lon + F.lit(180.0), 360.0, level), level)
    y = _decimal_bits(_bucket(F.lit(90.0) - lat, 180.0, level), level)
    in_range = lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)
    return F.when(in_range, F.lpad((x + y * F.lit(2)).cast("string"), level, "0"))


def _is_cell(cell: Column) -> Column:
    return (F.length(cell) > 0) & (F.translate(cell, "0123", "") == "")


def _centre(cell: Column, bits: str) -> Column:
    """Centre of the cell's bucket on one axis, as a fraction of the axis."""
    bucket = F.conv(F.translate(cell, "0123", bits), 2, 10).cast("double")
    return (bucket + F.lit(0.5)) / F.pow(F.lit(2.0), F.length(cell))


def cell_lon(cell: Column) -> Column:
    """Longitude of the cell's centroid; NULL for anything that is not a cell."""
    return F.when(_is_cell(cell), _centre(cell, "0101") * F.lit(360.0) - F.lit(180.0))


def cell_lat(cell: Column) -> Column:
    """Latitude of the cell's centroid; NULL for anything that is not a cell."""
    return F.when(_is_cell(cell), F.lit(90.0) - _centre(cell, "0011") * F.lit(180.0))


def cell_parent(cell: Column, level: int) -> Column:
    """The ancestor at ``level``; NULL when the cell is coarser than that or is not a cell."""
    return F.when(_is_cell(cell) & (F.length(cell) >= level), F.substring(cell, 1, level))


def cell_region(cell: Column) -> Column:
    """The region of a cell that ``geo_cell`` made, without checking that again."""
    return F.when(F.length(cell) >= REGION_LEVEL, F.substring(cell, 1, REGION_LEVEL))

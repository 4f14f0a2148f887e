"""Questions over the star: measures, rollups, slices, shares, top-N, pivots."""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ridemart.functions.geo import cell_region
from ridemart.functions.ride import day_type, rush_label
from ridemart.schemas import BUCKET_TABLE, DATE_TABLE, FACT_TABLE, GEOGRAPHY_TABLE, TIME_TABLE
from ridemart.sources.commits import create_once, read_text
from ridemart.sources.tables import read_star_table

ENDS = ("start", "end")
RegionFunction = Callable[[Column], Column] | None
# A star whose regions are not prefixes of its cells has a note of that; they come from its geography dimension then.
GRID_NOTE = "_regions_by_dimension"
# Stands for the region rule of the star's own grid.
OWN_GRID = "own"


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    date: DataFrame
    time: DataFrame
    geography: DataFrame
    bucket: DataFrame
    region: RegionFunction = cell_region


def note_grid(spark: SparkSession, gold: str) -> None:
    """Note that the star's regions are not those of the built-in grid, if its geography dimension says so."""
    if read_text(spark, f"{gold}/{GRID_NOTE}") is None:
        cells = read_star_table(spark, gold, GEOGRAPHY_TABLE)
        if not cells.filter(~F.col("parent_geo_res6").eqNullSafe(cell_region(F.col("geo_hash")))).isEmpty():
            create_once(spark, f"{gold}/{GRID_NOTE}", "regions come from dim_geography")


def load_star(spark: SparkSession, gold: str) -> Star:
    date = read_star_table(spark, gold, DATE_TABLE)
    time = read_star_table(spark, gold, TIME_TABLE)
    return Star(
        fact=read_star_table(spark, gold, FACT_TABLE),
        date=date.withColumns({
            "day_type": day_type(F.col("is_weekend")),
            "month_key": F.col("year") * 100 + F.col("month"),
        }),
        time=time.withColumn("rush_label", rush_label(F.col("is_rush_hour"))),
        geography=read_star_table(spark, gold, GEOGRAPHY_TABLE),
        bucket=read_star_table(spark, gold, BUCKET_TABLE),
        region=cell_region if read_text(spark, f"{gold}/{GRID_NOTE}") is None else None,
    )


# --- measures: over the sums that ``rollup`` carries, so that they hold at any grain ---

def total_trips() -> Column:
    return F.sum("trips")


def avg_duration_min() -> Column:
    return F.sum("duration_sec") / F.sum("timed") / F.lit(60)


def pct_same_region() -> Column:
    return F.sum("same_cell") / F.sum("trips")


def rollup(fact: DataFrame, *keys: str | Column) -> DataFrame:
    """Fact rows summed to the given keys.

    Done before any dimension is joined: the fact then leaves its scan as one row per key and task,
    and the joins work on that. All sums are of integers, so summing them again is exact.
    """
    return fact.groupBy(*keys).agg(
        F.sum("trip_count").alias("trips"),
        F.sum("is_same_cell").alias("same_cell"),
        F.sum("trip_duration_sec").alias("duration_sec"),
        F.count("trip_duration_sec").alias("timed"),
    )


def by_attributes(fact: DataFrame, dim: DataFrame, key: str, *attributes: str) -> DataFrame:
    """A rollup by the key of one dimension, with attributes of that dimension to group by."""
    return rollup(fact, key).join(dim.select(key, *attributes), key, "left")


def with_dates(rolled: DataFrame, star: Star, *attributes: str) -> DataFrame:
    return rolled.join(star.date.select("date_key", *attributes), "date_key", "left")


def with_times(rolled: DataFrame, star: Star, *attributes: str) -> DataFrame:
    return rolled.join(star.time.select("time_key", *attributes), "time_key", "left")


def geography_role(star: Star, end: str) -> DataFrame:
    """The one geography dimension in the role of ``start`` or ``end``, its columns prefixed so."""
    return star.geography.select(
        F.col("geo_hash").alias(f"{end}_geo_key"),
        F.col("lat").alias(f"{end}_lat"),
        F.col("lon").alias(f"{end}_lon"),
        F.col("parent_geo_res6").alias(f"{end}_region"),
        F.col("parent_geo_res5").alias(f"{end}_district"),
    )


def with_geography(rows: DataFrame, star: Star, end: str, *attributes: str) -> DataFrame:
    key = f"{end}_geo_key"
    return rows.join(geography_role(star, end).select(key, *attributes), key, "left")


def by_region(
    star: Star, *ends: str, name: str, region: RegionFunction | str = OWN_GRID,
    label: Callable[..., Column] = lambda region: region,
) -> DataFrame:
    """A rollup with the column ``name``: ``label`` of the regions of the given ends.

    The native grid's region is a prefix of the cell, which needs no join: one shuffle, at the grain
    of the answer. With ``region=None`` it comes from the geography dimension, joined once per end to
    the fact summed by cell: the way for a grid plugged in from outside. Unless told otherwise, the star's own
    grid decides.
    """
    region = star.region if region == OWN_GRID else region
    keys = [f"{end}_geo_key" for end in ends]
    if region is not None:
        return rollup(star.fact, label(*[region(F.col(key)) for key in keys]).alias(name))
    rolled = rollup(star.fact, *keys)
    for end in ends:
        rolled = with_geography(rolled, star, end, f"{end}_region")
    return rolled.withColumn(name, label(*[F.col(f"{end}_region") for end in ends]))


def wide(star: Star) -> DataFrame:
    """The fact with every dimension joined, geography twice, for free-form questions.

    Dates join on the month as well, so that a filter on a date attribute prunes the fact's partitions.
    Prefer ``slice_fact`` or ``wide_sums`` where sums are wanted: they sum before they join.
    """
    rows = star.fact.join(star.date, ["date_key", "month_key"], "left")
    rows = rows.join(star.time, "time_key", "left").join(star.bucket, "duration_bucket_key", "left")
    for end in ENDS:
        rows = rows.join(geography_role(star, end), f"{end}_geo_key", "left")
    return rows


def wide_sums(star: Star, *attributes: str, fact: DataFrame | None = None) -> DataFrame:
    """A rollup with any attributes of the ``wide`` star: for free-form questions, of both ends compared too.

    The fact is summed by just the foreign keys that the named attributes need; only the sums are joined.
    """
    dims = {
        "date_key": star.date, "time_key": star.time, "duration_bucket_key": star.bucket,
        **{f"{end}_geo_key": geography_role(star, end) for end in ENDS},
    }
    used = {key: [name for name in attributes if name in dim.columns] for key, dim in dims.items()}
    unknown = [name for name in attributes if not any(name in names for names in used.values())]
    if unknown:
        raise ValueError(f"unknown attributes: {', '.join(unknown)}")
    used = {key: names for key, names in used.items() if names}
    rows = rollup(star.fact if fact is None else fact, *used)
    for key, names in used.items():
        rows = rows.join(dims[key].select(key, *[name for name in names if name != key]), key, "left")
    return rows


_COMPARE = {
    "=": lambda column, value: column == value,
    "<>": lambda column, value: column != value,
    "<": lambda column, value: column < value,
    "<=": lambda column, value: column <= value,
    ">": lambda column, value: column > value,
    ">=": lambda column, value: column >= value,
}
Conditions = Mapping[str, object]


def slice_rows(rows: DataFrame, conditions: Conditions) -> DataFrame:
    """Rows that meet a condition per column: a list of values, or an (operator, value) pair."""
    for name, wanted in conditions.items():
        if isinstance(wanted, tuple):
            operator, value = wanted
            rows = rows.filter(_COMPARE[operator](F.col(name), value))
        else:
            rows = rows.filter(F.col(name).isin(*wanted))
    return rows


def slice_fact(star: Star, conditions: Conditions, *by: str) -> DataFrame:
    """A rollup to group by any attributes of the ``wide`` star, under conditions on any of them.

    Date conditions go first, as a semi join that prunes the fact's months. The rest works on the
    fact summed by just the foreign keys that the named attributes need.
    """
    dated = {name: wanted for name, wanted in conditions.items() if name in star.date.columns}
    fact = star.fact
    if dated:
        days = slice_rows(star.date, dated).select("date_key", "month_key")
        fact = fact.join(days, ["date_key", "month_key"], "left_semi")
    rest = {name: wanted for name, wanted in conditions.items() if name not in dated}

    rows = wide_sums(star, *dict.fromkeys([*rest, *by]), fact=fact)
    return slice_rows(rows, rest)


def share_of_total(measure: str) -> Column:
    """Share of a column in its sum over all rows. For aggregated rows: the window is one task."""
    return F.col(measure) / F.sum(measure).over(Window.partitionBy())


def top_n(
    rows: DataFrame, by: str, n: int, tie_break: Sequence[str] = (), ties: str = "key",
) -> DataFrame:
    """The n largest rows by a column.

    ``ties="key"`` settles equal values by ``tie_break`` and gives n rows at most; ``ties="all"``
    also gives every row that equals the last one. Both keep n rows per task, never a global sort.
    """
    best = rows.orderBy(F.desc(by), *tie_break).limit(n)
    if ties == "key":
        return best
    if ties != "all":
        raise ValueError(f"ties must be 'key' or 'all', not {ties!r}")
    cut = best.agg(F.min(by).alias("_cut"))
    return rows.join(F.broadcast(cut), F.col(by) >= F.col("_cut"), "left_semi")


HOURS = tuple(range(24))


def hour_column(hour: int) -> str:
    return f"h{hour:02d}"


def day_by_hour(star: Star) -> DataFrame:
    """A rollup to group by ``day_name`` and ``hour``."""
    rolled = with_dates(rollup(star.fact, "date_key", "time_key"), star, "day_name")
    return with_times(rolled, star, "hour")


def pivot_hours(rolled: DataFrame) -> DataFrame:
    """Days as rows, hours as columns, NULL where nothing happened."""
    pivoted = rolled.groupBy("day_name").pivot("hour", list(HOURS)).agg(F.sum("trips"))
    return pivoted.select("day_name", *[F.col(str(hour)).alias(hour_column(hour)) for hour in HOURS])


def heat_intensity(pivoted: DataFrame) -> DataFrame:
    """Each pivot cell's place between the smallest (0) and largest (1) cell; empty cells count as 0."""
    names = [hour_column(hour) for hour in HOURS]
    cells = pivoted.select(
        "day_name",
        F.posexplode(F.array(*[F.coalesce(F.col(name), F.lit(0)) for name in names])).alias("hour", "trips"),
    )
    every = Window.partitionBy()
    low, high = F.min("trips").over(every), F.max("trips").over(every)
    return cells.withColumn("intensity", (F.col("trips") - low) / F.nullif(high - low, F.lit(0)))

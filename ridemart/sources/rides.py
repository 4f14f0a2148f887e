"""Ride inputs: message lines, CSV folders, and newly arrived files."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ridemart.schemas import FILE_LEDGER, FILE_MANIFEST, RAW
from ridemart.sources.tables import constant_rows, new_rows_only, read_ledger


def read_lines_stream(spark: SparkSession, fmt: str = "kafka", **options: object) -> DataFrame:
    """A stream of messages with a ``value`` column.

    ``kafka`` takes the connector's options (``kafka.bootstrap.servers``, ``subscribe``,
    ``startingOffsets``, ``maxOffsetsPerTrigger``, ...); option names with dots go in as
    ``**{"kafka.bootstrap.servers": ...}``. ``text`` takes ``path``: one message per line.
    """
    reader = spark.readStream.format(fmt)
    for name, value in options.items():
        reader = reader.option(name, str(value))
    return reader.load()


def line_text(value: Column) -> Column:
    return value.cast("string")


def place_of(lines: DataFrame) -> Column:
    """Where a message came from: topic, partition and offset, or the file; NULL for other rows."""
    if {"topic", "partition", "offset"} <= set(lines.columns):
        return F.concat(F.col("topic"), F.lit("-"), F.col("partition").cast("string"), F.lit("@"), F.col("offset").cast("string"))
    try:
        lines.select("_metadata.file_path")
    except AnalysisException:
        return F.lit(None).cast("string")
    return F.col("_metadata.file_path")


def parse_ride_lines(lines: DataFrame, column: str = "value", keep_record: bool = False) -> DataFrame:
    """Typed raw rides from CSV lines, by position; batch or stream.

    A missing field or one that does not convert becomes NULL, never an error. Fields past the last
    are ignored, an empty id is NULL, and blank lines are skipped. With ``keep_record`` every ride carries its
    ``line`` and ``place``, so that a reject can be repaired.
    """
    text = line_text(F.col(column))
    fields = F.split(F.col("_line"), ",")
    parsed = [
        F.get(fields, position).try_cast(field.dataType).alias(field.name)
        for position, field in enumerate(RAW.fields)
    ]
    record, place = [], []
    if keep_record:
        record, place = [F.col("_line").alias("line"), F.col("_place").alias("place")], [place_of(lines).alias("_place")]
    return (
        lines.select(text.alias("_line"), *place)
        .filter(F.trim("_line") != "")
        .select(*parsed, *record)
        .withColumn("trip_id", F.nullif(F.col("trip_id"), F.lit("")))
    )


def split_ride_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The fields of CSV lines as they came: text by position, NULL where missing, the rest in ``extra``.

    For landing: nothing is converted, so a field that would not parse is still there. Blank lines are
    skipped.
    """
    text, fields = line_text(F.col(column)), F.split(F.col("_line"), ",")
    size = len(RAW.names)
    named = [F.get(fields, position).alias(name) for position, name in enumerate(RAW.names)]
    rest = F.when(F.size(fields) > size, F.array_join(F.slice(fields, size + 1, F.greatest(F.size(fields) - size, F.lit(1))), ","))
    return lines.select(text.alias("_line")).filter(F.trim("_line") != "").select(*named, rest.alias("extra"))


def to_csv_lines(rides: DataFrame) -> DataFrame:
    """Rides as one ``value`` line each, ready for a message sink or a text file."""
    # concat_ws skips NULLs and would shift the fields, so NULL has to become an empty field first.
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in RAW.names]
    return rides.select(F.concat_ws(",", *fields).alias("value"))


def publish_rides(rides: DataFrame, fmt: str = "kafka", **options: object) -> None:
    """Send rides as messages: to a topic with the connector's options, or as ``text`` to a ``path``."""
    writer = to_csv_lines(rides).write.mode("append").format(fmt)
    for name, value in options.items():
        writer = writer.option(name, str(value))
    writer.save()


def read_ride_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Headed CSV files of raw rides, by the names in their headers.

    Columns may stand in any order and others are ignored; a needed one that is missing is an error. Files
    read together must have the same header: one that differs from the first fails when it is read. What
    does not convert becomes NULL. Without paths there are no rides.
    """
    if not paths:
        return constant_rows(spark, [], RAW)
    rows = spark.read.option("header", True).option("enforceSchema", False).csv(list(paths))
    present = {name.lower() for name in rows.columns}
    missing = [name for name in RAW.names if name.lower() not in present]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in the header of {', '.join(paths[:3])}")
    return rows.select(*[F.col(field.name).try_cast(field.dataType).alias(field.name) for field in RAW.fields])


def stream_ride_files(
    spark: SparkSession, path: str, max_files: int | None = 5, keep_record: bool = False,
) -> DataFrame:
    """A growing folder of headed CSV files; ``max_files`` limits one trigger, None takes all.

    A stream's files are read by position, in the order of ``RAW``; columns after its last are ignored. With
    ``keep_record`` a row that does not fit carries its text as ``line``, another one its fields put together
    again, and all their file as ``place``.
    """
    schema = T.StructType([*RAW.fields, T.StructField("line", T.StringType())]) if keep_record else RAW
    reader = spark.readStream.schema(schema).option("header", True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if not keep_record:
        return reader.csv(path)
    rows = reader.option("columnNameOfCorruptRecord", "line").csv(path)
    whole = F.to_csv(F.struct(*RAW.names), {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]"})
    return rows.select(*RAW.names, F.coalesce("line", whole).alias("line"), F.col("_metadata.file_path").alias("place"))


def new_files_only(spark: SparkSession, path: str, manifest: str) -> DataFrame:
    """Paths of the files under ``path`` that the manifest does not list yet.

    Only file names are listed here; no file is opened. Record the paths with ``append_ledger``
    once their rows have been written.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    names = listed.select(F.col("path"))
    return new_rows_only(names, read_ledger(spark, manifest, FILE_MANIFEST), ["path"])


def file_digests(spark: SparkSession, *paths: str) -> DataFrame:
    """What each text file holds, as path and digest: equal for files of the same lines, in whatever order.

    Sums over the lines, so a file of any size is read in parts and no part of it moves. 128 bits of sums and
    the numbers of lines and bytes make an accidental match as good as impossible.
    """
    lines = spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias("path"), "value")

    def total(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), F.col("value")).cast("decimal(20,0)"))

    sums = lines.groupBy("path").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.octet_length("value")).alias("bytes"), total(1).alias("one"), total(2).alias("two"),
    )
    parts = [F.col(name).cast("string") for name in ("lines", "bytes", "one", "two")]
    return sums.select("path", F.sha2(F.concat_ws("/", *parts), 256).alias("digest"))


def new_content_only(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """Files below ``path`` that hold something new, as path and digest; for ``append_ledger`` once they are taken.

    A file whose path the ledger has is not opened. One that holds the same lines as a file of the ledger, a
    renamed or repeated copy, is left out; of several new files with the same lines the first by name stays.
    The names of unknown files reach the driver, as Spark's reader needs them there.
    """
    known = read_ledger(spark, ledger, FILE_LEDGER)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    unknown = [row["path"] for row in new_rows_only(listed, known, ["path"]).collect()]
    if not unknown:
        return constant_rows(spark, [], FILE_LEDGER)
    fresh = new_rows_only(file_digests(spark, *unknown), known, ["digest"])
    return fresh.groupBy("digest").agg(F.min("path").alias("path")).select(*FILE_LEDGER.names)

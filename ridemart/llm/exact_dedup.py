"""Exact de-duplication by sorting whole contents.

Spark samples splitters and range-partitions the rows by their normalised bytes, sorts each range with
spilling, and compares every row with its neighbour, byte by byte over the whole text. The order is by the
first bytes, then by the SHA-256 of the whole, then by the whole text: rows stay next to their equals, and
neither splitters nor keys grow with the texts. The digest places rows, it never decides equality.

A text that holds so many rows that it would fill a task of its own is cut into several sub-ranges. Each
yields one representative per text; those are few by construction and are compared once more.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ridemart.llm.common import ascii_lower, checkpointed, whole_text

HEAD_BYTES = 64
# A text is cut up once it holds over 1 / (PIECES * shuffle partitions) of all rows.
PIECES = 4
KEY = ("_head", "_digest", "_salt")


def _keyed(docs: DataFrame, id_col: str, text_col: str, carried: Column | None) -> DataFrame:
    lowered = ascii_lower(F.col("_text"))
    extra = [carried.alias("_row")] if carried is not None else []
    return docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text"), *extra).withColumns({
        "_digest": F.sha2(lowered.cast("binary"), 256),
        "_head": F.substring(lowered.cast("binary"), 1, HEAD_BYTES),
    })


def _hot_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Digests that hold more than their share of rows, and into how many pieces to cut them.

    At most PIECES * partitions texts can hold that share each, which bounds this table.
    """
    shares = PIECES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = checkpointed(
        _keyed(docs, id_col, text_col, None).groupBy("_digest").agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1)
    )
    share = max(1.0, docs.count() / shares)
    return counts.filter(F.col("_n") > share).select(
        "_digest", F.ceil(F.col("_n") / F.lit(share)).cast("int").alias("_pieces"),
    )


def _marked(docs: DataFrame, id_col: str, text_col: str, smallest: bool, carried: Column | None) -> DataFrame:
    hot = _hot_texts(docs, id_col, text_col)
    keyed = (
        _keyed(docs, id_col, text_col, carried).join(F.broadcast(hot), "_digest", "left")
        .withColumn("_salt", F.coalesce(F.pmod(F.xxhash64("_id"), F.col("_pieces")).cast("int"), F.lit(-1)))
        .drop("_pieces")
        .repartitionByRange("_head", "_digest", "_salt")
        .withColumn("_norm", ascii_lower(F.col("_text"))).drop("_text")
    )
    by_text = Window.partitionBy(*KEY).orderBy("_norm", "_id")
    runs = keyed.withColumn(
        "_first", ~F.lag("_norm").over(by_text).eqNullSafe(F.col("_norm")),
    ).withColumn(
        "_run", F.sum(F.col("_first").cast("int")).over(by_text.rowsBetween(Window.unboundedPreceding, 0)),
    ).withColumn("_norm", F.when(F.col("_first") & (F.col("_salt") >= 0), F.col("_norm")))

    best = F.min("_id") if smallest else F.max("_id")
    order = F.col("_id").asc_nulls_last() if smallest else F.col("_id").desc_nulls_last()
    run = Window.partitionBy(*KEY, "_run")
    members = runs.withColumns({
        "_keep": best.over(run), "_size": F.count(F.lit(1)).over(run),
        "_place": F.row_number().over(run.orderBy(order)),
    })

    # One row per text and piece of the few texts that were cut up.
    pieces = members.filter(F.col("_first") & (F.col("_salt") >= 0)).select(*KEY, "_run", "_norm", "_keep", "_size")
    meet = Window.partitionBy("_head", "_digest").orderBy("_norm", "_salt", "_run")
    grouped = pieces.withColumn(
        "_new", ~F.lag("_norm").over(meet).eqNullSafe(F.col("_norm")),
    ).withColumn("_text_no", F.sum(F.col("_new").cast("int")).over(meet.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy("_head", "_digest", "_text_no")
    better = F.min("_keep") if smallest else F.max("_keep")
    total = grouped.select(
        "_digest", "_salt", "_run",
        better.over(whole).alias("_all_keep"), F.sum("_size").over(whole).alias("_all_size"),
    )
    return members.drop("_norm").join(F.broadcast(total), ["_digest", "_salt", "_run"], "left").select(
        "_id", "_digest", *(["_row"] if carried is not None else []),
        F.when(F.col("_all_size").isNull(), F.col("_keep")).otherwise(F.col("_all_keep")).alias("keep_id"),
        F.coalesce("_all_size", "_size").alias("group_size"), "_place",
    ).withColumn("kept", (F.col("_place") == 1) & F.col("_id").eqNullSafe(F.col("keep_id")))


def mark_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; NULL counts as empty, and all empty texts are one
    group. ``keep`` names the id that stays, "smallest" or "largest". Of rows that repeat that very id one
    stays. A NULL id stays only in a group that has no other id. Other columns of ``docs`` are ignored, so
    their names do not matter. An empty table gives an empty result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be 'smallest' or 'largest', not {keep!r}")
    marked = _marked(docs, id_col, text_col, keep == "smallest", None)
    return marked.select(
        F.col("_id").alias(id_col), "keep_id", "group_size", "kept", F.col("_digest").alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. The same rules as ``mark_copies``."""
    marked = _marked(docs, id_col, text_col, keep == "smallest", F.struct("*"))
    return marked.filter("kept").select("_row.*")

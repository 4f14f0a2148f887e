"""WARC archives: writing pages as records, and reading them back by verified boundary chains.

Writing: one record per page; a repeated payload becomes a revisit of the page that keeps it. The text sink
writes a record per row, whose end mark is its line separator, on any file system Spark knows.

Reading: files are split among tasks at the version line, wherever it occurs. Every occurrence is a candidate
record with a candidate successor: its own offset, its header, Content-Length, and the end mark. Only records
that are reached from the start of the file along those links are kept, by pointer jumping: the links are
doubled, so a file of n candidates takes log2(n) rounds of joins. A version line inside a payload is never
reached, however complete the record after it looks.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ridemart.llm.common import checkpointed, few, stored

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
# Payloads from this size on are stored once.
REVISIT_BYTES = 1000
_PREFIX = "urn:page:"
# Tables of keys up to this many rows (some 100 bytes each) go to the payloads; larger ones meet them in a shuffle.
BROADCAST_ROWS = 500_000
# Links of one task while pointers jump.
LINKS_PER_TASK = 50_000


def write_pages(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    revisit_bytes: int = REVISIT_BYTES,
) -> None:
    """Write one record per row. Of equal payloads of at least ``revisit_bytes``, the largest id's is the
    response and the others revisit it.

    A NULL payload is empty; a NULL id is written as an empty one and always as a response; a NULL url is
    empty, and line feeds in it are blanked. Rows that repeat an id are records each. An empty table writes no
    record. Other columns are ignored. Payloads go out as they are, whatever they contain.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    url = F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("")), "[\r\n]+", " ")
    rows = pages.select(F.col(id_col).alias("id"), url.alias("url"), payload.alias("payload")).withColumns({
        "size": F.octet_length("payload"), "digest": F.sha1(F.col("payload").cast("binary")),
    })
    # Equality rests on SHA-256 and the length; only digests meet, never the payloads.
    large = rows.filter((F.col("size") >= revisit_bytes) & F.col("id").isNotNull()).select(
        "id", "size", F.sha2(F.col("payload").cast("binary"), 256).alias("same"),
    )
    kept = large.groupBy("same", "size").agg(F.max("id").alias("refers"), F.count(F.lit(1)).alias("n"))
    repeats = large.join(kept.filter("n > 1"), ["same", "size"]).filter("id <> refers").select("id", "same", "refers").distinct()
    repeats = few(checkpointed(repeats), BROADCAST_ROWS)
    # An id may repeat with other payloads, so the join takes the payload's digest too.
    same = F.sha2(F.col("payload").cast("binary"), 256)
    linked = rows.withColumn("same", same).join(repeats, ["id", "same"], "left")
    revisit = F.col("refers").isNotNull()
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    header = F.concat_ws(
        "\r\n",
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit(f"WARC-Record-ID: <{_PREFIX}"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">")),
        F.when(revisit, F.concat(F.lit(f"WARC-Refers-To: <{_PREFIX}"), F.col("refers").cast("string"), F.lit(">"))),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("Content-Type: text/html")),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    )
    record = F.concat(F.lit(VERSION), header, F.lit(END), body)
    linked.select(record.alias("value")).write.option("lineSep", END).text(path)


def _raw_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The files cut at every version line: file, split, row (in order within a split), chunk, digest."""
    return spark.read.option("lineSep", VERSION).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"), F.col("value").alias("chunk"),
    ).withColumn("digest", F.unhex(F.sha2(F.col("chunk").cast("binary"), 256)))


def read_candidates(raw: DataFrame) -> DataFrame:
    """Every version line: file, split, digest, offset, next (where its record would end), without the payloads.

    What stands before a file's first version line is a row as well, with an offset below 0.
    A split's chunks come in order, so an offset is the bytes before it: of earlier splits, then within its
    own. ``next`` is NULL where header or length cannot be read. Splits are those of one reading, whose sizes
    are set down; a later reading may cut the files elsewhere, so chunks are found again by their digest.
    """
    sized = stored(raw.select(
        "file", "split", "row", "digest", (F.octet_length("chunk").cast("bigint") + len(VERSION)).alias("bytes"),
        F.octet_length(F.substring_index("chunk", END, 1)).cast("bigint").alias("head"),
        F.col("chunk").contains(END).alias("complete"), _field(F.col("chunk"), "Content-Length").try_cast("bigint").alias("length"),
    ), "chunk-sizes")
    own = Window.partitionBy("file", "split").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    placed = sized.withColumn("end", F.sum("bytes").over(own))
    # One row per split is left of this: few enough for a window per file.
    totals = placed.groupBy("file", "split").agg(F.max("end").alias("total"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file", "split", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))
    offset = F.col("before") + F.col("end") - F.col("bytes") - len(VERSION)
    following = F.col("offset") + len(VERSION) + F.col("head") + len(END) + F.col("length") + len(END)
    return placed.join(starts, ["file", "split"]).withColumn("offset", offset).select(
        "file", "split", "digest", "offset", F.when(F.col("complete") & (F.col("length") >= 0), following).alias("next"),
    )


def _field(chunk: Column, name: str) -> Column:
    """A header field of a record, NULL where it is missing. Only what stands before the payload is searched."""
    head = F.concat(F.lit("\r\n"), F.substring_index(chunk, END, 1), F.lit("\r\n"))
    found = F.regexp_extract(head, rf"\r\n{name}:[ \t]*([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def reachable(links: DataFrame) -> DataFrame:
    """The candidates on the chain from offset 0 of their file: file, offset.

    Doubling: after round k the reached rows are the first 2^k of each chain and a jump spans 2^k records.
    Jumps end where no candidate is, which also ends the chain.
    """
    known = links.select("file", "offset", "next")
    tasks = 1 + known.count() // LINKS_PER_TASK

    def kept(rows: DataFrame) -> DataFrame:
        return checkpointed(rows.coalesce(tasks))

    reached = known.filter("offset = 0").select("file", "offset")
    jumps = known.filter(F.col("next").isNotNull()).join(
        known.select("file", F.col("offset").alias("next")), ["file", "next"], "left_semi",
    ).select("file", "offset", "next")
    reached, jumps = kept(reached), kept(jumps)
    while not jumps.isEmpty():
        ahead = reached.join(jumps, ["file", "offset"]).select("file", F.col("next").alias("offset"))
        longer = jumps.join(
            jumps.select("file", F.col("offset").alias("next"), F.col("next").alias("_far")), ["file", "next"],
        ).select("file", "offset", F.col("_far").alias("next"))
        reached, jumps = kept(reached.unionByName(ahead)), kept(longer)
    return reached


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The verified records: file, offset, type, id, refers_to, url, stated_digest, payload, intact.

    ``intact`` says that the payload has the stated length, ends as a record must, and has the stated digest
    (revisits have no payload of their own). A payload that holds version lines is put together again from
    its chunks: the pieces of one record meet in one task, those of a file do not. Payloads are found by file and
    SHA-256 of their chunk, never by place in a split, as executors that come or go change how files are cut.

    Files without a record and empty files give no row, nor does what stands before a file's first record or after
    the end of its chain. Repeated records are rows each. A payload of any length is one value.
    """
    raw = _raw_chunks(spark, path)
    candidates = checkpointed(read_candidates(raw))
    starts = reachable(candidates).withColumn("starts", F.col("offset"))
    owned = candidates.drop("next").join(starts, ["file", "offset"], "left")
    # A chunk belongs to the last start at or before it: in its own split, or else in an earlier one.
    own = Window.partitionBy("file", "split").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = owned.groupBy("file", "split").agg(F.max("starts").alias("last")).select(
        "file", "split", F.max("last").over(before).alias("carried"),
    )
    owner = owned.withColumn("own", F.max("starts").over(own)).join(carried, ["file", "split"]).select(
        "file", "digest", "offset", F.coalesce("own", "carried").alias("record"),
    )
    several = owner.groupBy("file", "record").agg(F.count(F.lit(1)).alias("n"))
    owner = checkpointed(owner.join(several, ["file", "record"], "left"))
    # The payloads move once, to meet their places; those of one piece need no more. A chunk that a file has
    # several times stands for all its places, so only the first of equal chunks goes on.
    place = F.when(F.col("record").isNotNull(), F.struct("record", "offset", "n"))
    places = checkpointed(owner.groupBy("file", "digest").agg(
        F.collect_list(place).alias("places"), F.count(F.lit(1)).alias("times"),
    ).filter(F.size("places") > 0))
    single, repeated = places.filter("times = 1"), places.filter("times > 1")
    found = raw.join(few(single, BROADCAST_ROWS), ["file", "digest"]).select("file", "places", "chunk")
    if not repeated.isEmpty():
        again = raw.join(few(repeated, BROADCAST_ROWS), ["file", "digest"]).groupBy("file", "digest").agg(
            F.first("places").alias("places"), F.first("chunk").alias("chunk"),
        )
        found = found.unionByName(again.select("file", "places", "chunk"))
    pieces = found.select("file", F.explode("places").alias("place"), "chunk").select("file", "place.*", "chunk")
    alone = pieces.filter("n = 1").select("file", F.col("record").alias("offset"), F.col("chunk").alias("text"))
    split_up = pieces.filter("n > 1").groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("offset", "chunk"))).alias("pieces"),
    ).select("file", F.col("record").alias("offset"), F.array_join("pieces.chunk", VERSION).alias("text"))
    whole = alone if owner.filter("record IS NOT NULL AND n > 1").isEmpty() else alone.unionByName(split_up)

    text = F.col("text")
    urn = rf"<{_PREFIX}(.*)>"
    parsed = whole.select(
        "file", "offset", "text", F.octet_length(F.substring_index("text", END, 1)).alias("head"),
        _field(text, "Content-Length").try_cast("int").alias("length"), _field(text, "WARC-Type").alias("type"),
        F.regexp_extract(_field(text, "WARC-Record-ID"), urn, 1).alias("id"),
        F.regexp_extract(_field(text, "WARC-Refers-To"), urn, 1).alias("refers_to"),
        F.coalesce(_field(text, "WARC-Target-URI"), F.lit("")).alias("url"),
        F.regexp_extract(_field(text, "WARC-Payload-Digest"), "sha1:(.*)", 1).alias("stated_digest"),
    )
    body = F.substring(text.cast("binary"), F.col("head") + len(END) + 1, F.col("length"))
    fits = F.octet_length("text") == F.col("head") + F.col("length") + 2 * len(END)
    good = (F.col("type") == "revisit") | (F.sha1("body") == F.col("stated_digest"))
    return parsed.withColumn("body", body).select(
        "file", "offset", "type", "id", "refers_to", "url", "stated_digest",
        F.col("body").cast("string").alias("payload"), F.coalesce(fits & text.endswith(END) & good, F.lit(False)).alias("intact"),
    )


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Per record: id, type, refers_to, and bytes and SHA-1 of the full payload, of the one it refers to for revisits.

    A revisit without its response has NULL for both.
    """
    small = checkpointed(records.select(
        "id", "type", "refers_to", "stated_digest", F.octet_length("payload").cast("bigint").alias("bytes"),
        F.sha1(F.col("payload").cast("binary")).alias("digest"),
    ))
    responses = small.filter("type = 'response'").select(
        F.col("id").alias("refers_to"), F.col("digest").alias("stated_digest"),
        F.col("bytes").alias("_bytes"), F.col("digest").alias("_digest"),
    ).distinct()
    revisits = small.filter("type = 'revisit'").join(responses, ["refers_to", "stated_digest"], "left").select(
        "id", "type", "refers_to", F.col("_bytes").alias("bytes"), F.col("_digest").alias("digest"),
    )
    return small.filter("type = 'response'").select(
        "id", "type", F.lit(None).cast("string").alias("refers_to"), "bytes", "digest",
    ).unionByName(revisits)

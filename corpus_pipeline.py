"""From raw documents to training tokens: five stages, each a whole table in and a whole table out."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ridemart.llm import bpe, decontaminate, exact_dedup, jaccard_join, quality
from ridemart.llm.common import stored


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; its sample comes from the rows given."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    network = quality.train(docs, labels, parts=4, held_out=2)
    return docs.filter(quality.score(spark, F.col("text"), network) >= quality.THRESHOLD)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per text, the one with the smallest id."""
    return exact_dedup.drop_copies(docs, keep="smallest")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per component of links: five-word shingles, Jaccard similarity of 0.8 or more."""
    return jaccard_join.keep_one(docs, jaccard_join.Rule(words=5, share=80))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids per document, and whether decoding them gives the very text."""
    import public_tokenizers

    vocabulary = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    named = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    named = named.withColumn("text_sha256", F.sha2(F.col("text").cast("binary"), 256))
    return bpe.encode_rows(named, vocabulary, public_tokenizers.PATTERN).select(
        "row.doc_id", "row.lang", "row.source", "row.text_sha256", F.size("ids").alias("n_tokens"), "ids",
        (F.sha2("decoded", 256) == F.col("row.text_sha256")).alias("round_trip"),
    )


STAGES = [
    ("quality_classifier", keep_quality),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("byte_bpe", encode_tokens),
]

# A trained network and a byte-pair encoder are not SQL; the tests hold the operators behind the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

"""Registered queries: each numbered operator over its whole table, thin as can be."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runway.llm import bpe, html, quality, records, secrets, sharding
from runway.llm.batches import limit_batches
from runway.llm.decontaminate import benchmark_matches
from runway.llm.divergence import audit
from runway.llm.exactdup import exact_duplicates, normalised
from runway.llm.neardup import near_duplicates
from runway.llm.resample import resample
from runway.llm.substrings import repeats
from runway.llm.topk import top_k
from runway.sources import read_table
from runway.sources.sinks import materialise

#: the public tokenizer that the queries use; any other file can be given to the operators
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        limit_batches(spark)
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


@query
def op5_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class id of every document under 5-word shingle Jaccard >= 0.75."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages found in the documents: the best window of each document and item."""
    return benchmark_matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels outside the held-out fifth."""
    docs = read_table(spark, sf_dir, "documents")
    stats = materialise(spark, docs.select("doc_id", quality.statistics("text").alias("stats")), "statistics")
    model = quality.fit(quality.training_rows(stats, read_table(spark, sf_dir, "labels")))
    return (stats.select("doc_id", quality.held_out().alias("held_out"), quality.scorer(model)("stats").alias("score"))
            .withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int")))


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document with the forest's verdict."""
    docs = read_table(spark, sf_dir, "documents")
    found = secrets.secret_findings(docs, secrets.labelled_findings(docs))
    return found.select("doc_id", "position", F.length("secret").alias("length"), F.sha2("secret", 256).alias("secret_sha256"),
                        F.concat(F.substring("secret", 1, 4), F.lit("...")).alias("shown"), "probability", "is_secret")


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document, decode the ids again; digests of both."""
    path = tokenizer_path()
    encoded = bpe.encode(read_table(spark, sf_dir, "documents"), path).withColumn("decoded", bpe.decode("ids", path))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 equal shards by their ids (law `key`)."""
    placed = sharding.assign_shards(read_table(spark, sf_dir, "documents"), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op7_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as framed binary records and read back."""
    _, index = records.encode_to_files(read_table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)
    return index.select("doc_id", "start", "n_tokens", "ids_crc32", "part", "offset", "length")


@query
def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors for every vector whose id is divisible by 20."""
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a run of 13 that an earlier document holds; digest of the rest."""
    found = repeats(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = read_table(spark, sf_dir, "pages")
    found = html.extract(pages, html.train_labeller(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document, and whether it is the one that stays."""
    docs = read_table(spark, sf_dir, "documents").withColumn("text_sha256", F.sha2(normalised("text"), 256))
    return exact_duplicates(docs, carry=("text_sha256",))


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language, and the terms that mark each source."""
    return audit(read_table(spark, sf_dir, "documents"))


@query
def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark's words; a tenth of the longer ones are drawn."""
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))

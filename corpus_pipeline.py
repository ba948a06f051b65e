"""The corpus pipeline: from raw documents to token ids.

Five stages in order, each over everything that the stage before kept: drop
what the quality classifier rejects, keep one document of each near-duplicate
group, drop documents that hold a benchmark passage, mask secrets, encode
with BPE (and decode again).  The first four return the columns of documents;
columns beside those are ignored, whatever their names.  Every stage takes NULL ids
and texts, repeated rows and an empty table, which gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runway.llm import bpe, quality, secrets
from runway.llm.batches import limit_batches
from runway.llm.decontaminate import benchmark_hits
from runway.llm.neardup import near_duplicates
from runway.llm.queries import tokenizer_path
from runway.session import delete_path, intermediates, shared_path
from runway.sources.sinks import materialise, write_replace

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least 0.3, learned from the labels of this table's documents."""
    limit_batches(spark)
    stats = docs.select("doc_id", quality.statistics("text").alias("stats"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(materialise(spark, quality.training_rows(stats, labels), "training"))
    return docs.where(quality.text_scorer(model)("text") >= quality.THRESHOLD).select(DOCUMENT_COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id.

    An id's rows with words share their verdict; its rows without any are always kept.
    """
    limit_batches(spark)
    gone = near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    with_words = F.when(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.col("doc_id"))
    return docs.join(gone, with_words == F.col("__gone"), "left_anti").select(DOCUMENT_COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    limit_batches(spark)
    hits = benchmark_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return hits.where(F.size("benchmark_hits") == 0).select(DOCUMENT_COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mask and n_chars brought up to date."""
    limit_batches(spark)
    masked = secrets.redact(docs, secrets.labelled_findings(docs))
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(DOCUMENT_COLUMNS)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as token ids, with the decoded text beside them.

    The ids are written before they are decoded: in one task, encoding and decoding would
    each have a Python worker, and Spark keeps every worker for the stages that follow.
    """
    limit_batches(spark)
    path = tokenizer_path()
    ids = materialise(spark, bpe.encode(docs, path, carry=("doc_id", "lang", "source")), "ids")
    return ids.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
                      bpe.decode("ids", path).alias("decoded"))


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("bpe", encode_bpe),
]

#: classifiers, MinHash and BPE have no SQL form; the tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of ``sf_dir``, each written and read again.

    A stage's intermediate tables go when its result is written, and that result goes
    when the next one is; only the ids that the last stage has written stay.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, name)
        with intermediates(spark):
            write_replace(stage(spark, docs, sf_dir), path)
        if before:
            delete_path(spark, before)
        docs, before = spark.read.parquet(path), path
    out = STAGES[-1][1](spark, docs, sf_dir)
    delete_path(spark, before)
    return out

import os

import pytest
from pyspark.sql import types as T

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with the operators' own."""
    def make(pairs, clashing=True):
        df = spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t)) for i, t in pairs], DOCUMENTS)
        if clashing:
            from pyspark.sql import functions as F
            for name in ("token", "component", "block", "shard", "stats", "word", "a", "doc", "size", "slot", "position", "ids", "v"):
                df = df.withColumn(name, F.lit("clash"))
        return df
    return make


@pytest.fixture(scope="session")
def lorem():
    """A deterministic source of invented words."""
    import random
    rng = random.Random(8)
    syllables = ["ka", "ter", "mo", "lin", "dra", "ves", "pi", "nor", "shu", "ele"]

    def text(n):
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))
    return text

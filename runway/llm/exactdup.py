"""Exact duplicate texts by progressive refinement.

Texts are equal when they are identical after each run of ASCII white space
becomes one space.  Rows are grouped by what is cheap first, and only rows that
may still have a partner go on:

1. length of the normalised text: a length that one row alone has is done;
2. hash of the first ``PREFIX`` characters, of the rows with a shared length;
3. SHA-256 of the whole text, of the rows with a shared length and prefix.

Steps 1 and 2 run on a narrow table (16 bytes a row).  Which groups survive is
told to the next step by a table of ``MARKS`` 64-bit words in which each
surviving group sets one bit: its size is fixed, so it is broadcast at any scale,
no text is shuffled, and a row that meets a set bit by chance is hashed for
nothing but is not misjudged, since the full hash alone decides.  Groups are
summed up before they are shuffled; the results go back to the rows of the few
groups that hold a large share of all rows by broadcast, to the rest by a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runway.sources.sinks import materialise

SPACES = r"[\x20\x09-\x0D]+"
PREFIX = 64            # characters of the prefix hash
MARKS = 1 << 18        # words of a table of surviving groups (2 MB of bits)
LARGE = 1000           # a group with over 1 / LARGE of all rows is joined by broadcast: fewer than LARGE groups


def normalised(text: str | Column) -> Column:
    """The text with each run of ASCII white space as one space; NULL is empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def _place(keys: list[str]) -> tuple[Column, Column]:
    """Number of the word and the bit of a group in the table of marks."""
    h = F.xxhash64(F.lit(len(keys)), *keys)
    return F.pmod(h, F.lit(MARKS)), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(h, 40), F.lit(64)).cast("int"))


def _surviving(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Marks (word, bits) of the groups of at least two rows: MARKS rows at most."""
    word, bit = _place(keys)
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return groups.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))


def _marked(rows: DataFrame, marks: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``rows`` with a boolean column: whether the row's group may survive."""
    word, bit = _place(keys)
    out = rows.withColumns({"_word": word, "_bit": bit}).join(
        F.broadcast(marks.select(F.col("word").alias("_word"), "bits")), "_word", "left")
    return out.withColumn(name, F.coalesce(F.col("bits").bitwiseAND(F.col("_bit")) != 0, F.lit(False))).drop("_word", "_bit", "bits")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``docs``: doc_id, the carried columns, keep_id, group_size, kept.

    ``keep_id`` is the smallest id among the rows whose texts are equal,
    ``group_size`` their number, and ``kept`` is true for one row of each group: the
    one with that id.  NULL, empty texts: NULL counts as empty, and all empty texts
    are equal; a text of white space alone is one space.  Repeated rows (same id, same
    text) count each and one of them is kept.  Rows without an id come last: if no
    row of a group has an id, keep_id is NULL and one row is kept.  No rows give
    no rows.  Columns that are not carried are ignored, whatever their names; carried ones
    must not be called like the results.
    """
    spark = docs.sparkSession
    names = [f"c{i}" for i in range(len(carry))]
    text = normalised(text_col)
    narrow = materialise(spark, docs.select(F.octet_length(text).alias("length"), F.xxhash64(F.substring(text, 1, PREFIX)).alias("prefix")), "prefixes")
    by_length = materialise(spark, _surviving(narrow, ["length"]), "lengths")
    alike = _marked(narrow, by_length, ["length"], "shared").where("shared")
    by_prefix = materialise(spark, _surviving(alike, ["length", "prefix"]), "length_prefixes")

    whole = docs.select(F.col(id_col).cast("long").alias("id"), *[F.col(c).alias(n) for c, n in zip(carry, names, strict=True)], text.alias("text"))
    whole = whole.withColumns({"length": F.octet_length("text"), "prefix": F.xxhash64(F.substring("text", 1, PREFIX))})
    whole = _marked(_marked(whole, by_length, ["length"], "shared"), by_prefix, ["length", "prefix"], "alike")
    rows = whole.select("id", *names, F.when(F.col("shared") & F.col("alike"), F.unhex(F.sha2("text", 256))).alias("full"))
    # written once: the numbers of the rows tell repeated rows apart
    rows = materialise(spark, rows.withColumn("row", F.monotonically_increasing_id()), "hashed")

    members = rows.where(F.col("full").isNotNull())
    groups = members.groupBy("full").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row")).alias("first"))
    groups = materialise(spark, groups.where("n > 1"), "groups")
    large = groups.where(F.col("n") > F.lit(rows.count() / LARGE))
    joined = members.join(F.broadcast(large), "full").unionByName(
        members.join(F.broadcast(large.select("full")), "full", "left_anti").join(groups, "full", "left"))
    alone = rows.where(F.col("full").isNull()).withColumns({"n": F.lit(None).cast("long"), "first": F.lit(None).cast(groups.schema["first"].dataType)})
    grouped = F.col("n").isNotNull()
    return joined.unionByName(alone).select(
        F.col("id").alias("doc_id"), *[F.col(n).alias(c) for n, c in zip(names, carry, strict=True)],
        F.when(grouped, F.col("first.id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        F.when(grouped, F.col("first.row") == F.col("row")).otherwise(True).alias("kept"))

"""Exact duplicates against brute force."""

import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from runway.llm import exactdup
from runway.llm.exactdup import exact_duplicates, normalised


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    return sorted((i, min([x for x in groups[k] if x is not None], default=None), len(groups[k]))
                  for i, t in rows if i is not None for k in [re.sub(r"[\x20\x09-\x0D]+", " ", t or "")])


def found(df):
    return sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in df.collect() if r["doc_id"] is not None)


def test_against_brute_force(spark, make_docs, lorem):
    rng = random.Random(5)
    base = [lorem(n) for n in (3, 30, 200)]
    base += [base[1][:-1] + "x", base[2][:-2] + "zz", base[2].upper()]               # equal length and prefix, other text
    rows = [(i, re.sub(" ", lambda m: rng.choice([" ", "  ", "\t\n", "\r\x0b\x0c "]), rng.choice(base))) for i in rng.sample(range(1000), 200)]
    rows += [(2000, None), (2001, ""), (2002, " "), (2003, "\n\t"), (2004, " a"), (2005, "a"), (2006, "a "), (2007, " a"), (2008, "é" * 200_000), (2009, "é" * 200_000)]
    got = exact_duplicates(make_docs(rows)).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == brute(rows)
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got)


def test_repeated_rows_and_rows_without_id(make_docs):
    rows = [(7, "x y")] * 3 + [(9, "x  y"), (None, "x y"), (None, "lone"), (None, "lone"), (3, "other"), (4, None), (None, "")]
    got = exact_duplicates(make_docs(rows)).collect()
    by = defaultdict(list)
    for r in got:
        by[(r["keep_id"], r["group_size"])].append(r)
    assert sorted(by, key=str) == sorted([(7, 5), (None, 2), (3, 1), (4, 2)], key=str)
    assert all(sum(r["kept"] for r in rows) == 1 for rows in by.values())
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_empty_table_and_carried_columns(make_docs):
    docs = make_docs([(1, "a b"), (2, "a\nb"), (3, "c")])
    out = exact_duplicates(docs.withColumn("sha", F.sha2(normalised("text"), 256)), carry=("sha", "stats", "text"))
    assert out.columns == ["doc_id", "sha", "stats", "text", "keep_id", "group_size", "kept"]
    assert {(r["doc_id"], r["text"], r["keep_id"]) for r in out.collect()} == {(1, "a b", 1), (2, "a\nb", 1), (3, "c", 3)}
    assert exact_duplicates(docs.where("false")).count() == 0


def test_only_shared_lengths_and_prefixes_are_hashed_in_full(spark, make_docs, lorem):
    """A row is read in full only if another one has its length and its first characters."""
    prefix = lorem(40)[:exactdup.PREFIX]
    rows = [(1, prefix + "one"), (2, prefix + "two"), (3, "y" + prefix + "ab"), (4, "z" * 500), (5, "q" * 500)]
    docs = make_docs(rows)
    text = normalised("text")
    narrow = docs.select(F.octet_length(text).alias("length"), F.xxhash64(F.substring(text, 1, exactdup.PREFIX)).alias("prefix"), "doc_id")
    lengths = exactdup._surviving(narrow, ["length"])
    step = exactdup._marked(narrow, lengths, ["length"], "shared").where("shared")
    assert {r["doc_id"] for r in step.collect()} == {1, 2, 3, 4, 5}
    prefixes = exactdup._surviving(step, ["length", "prefix"])
    assert {r["doc_id"] for r in exactdup._marked(step, prefixes, ["length", "prefix"], "alike").where("alike").collect()} == {1, 2}
    assert {(r["doc_id"], r["group_size"]) for r in exact_duplicates(docs).collect()} == {(i, 1) for i in range(1, 6)}

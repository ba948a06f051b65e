"""MinHash near-duplicate detection by a signature-coordinate inverted join.

Method
------
Every text is lower-cased (A-Z) and cut into words; its set holds its distinct
5-word shingles.  Texts with equal word sequences form a class; only one
representative per class goes on.  Each representative gets a signature of
``COORDS`` MinHash coordinates and is posted under every (coordinate, value)
pair.  Two texts at Jaccard 0.75 agree in 96 of 128 coordinates on average and
in fewer than ``MATCHES`` = 70 with probability 2e-7.

* prefix merge: values are ordered by how many texts carry them, rare first.
  Two texts with at least M common values of K share one within the first
  K - M + 1 of each, so only those are merged into candidates;
* skip merge: the remaining, frequent values are never merged; the agreement
  over all K coordinates is counted per candidate by comparing signatures;
* a candidate with enough agreement is confirmed on the full shingle sets.

A posting list is never expanded into its pairs.  Each text first meets only its
best hub (the smallest id of a list, most lists in common), then the hubs and
list neighbours that are still in another component.  What is left are the pairs
of one list in different components; an exact prefix and position filter on their
full shingle sets, with the agreement threshold, leaves few of them to confirm.
No list, pair or text is capped or dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runway.llm.graph import connected_components
from runway.llm.wordhash import shingle_list, word_hashes
from runway.sources.sinks import materialise

WORDS = 5            # words of a shingle
PERCENT = 75         # a link: 100 * intersection >= PERCENT * union
COORDS = 128         # signature length K
MATCHES = 70         # agreements M that make a pair a candidate
RARE = 100           # the last step orders shingles of up to so many texts by that number

_rng = np.random.default_rng(20_240_131)
_XOR = _rng.integers(0, 1 << 32, COORDS, dtype=np.uint32)
_ODD = _rng.integers(0, 1 << 32, COORDS, dtype=np.uint32) | np.uint32(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The K smallest permuted values of a shingle set (never empty), as unsigned 32-bit integers."""
    low = shingles.astype(np.uint32)
    best = np.full(COORDS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(low), 1024):
        np.minimum(best, ((low[at:at + 1024, None] ^ _XOR) * _ODD).min(axis=0), out=best)
    return best


def _profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """doc_id, text -> doc_id, content key (two longs), set size, signature (NULL for an empty set)."""
    with np.errstate(over="ignore"):
        for pdf in batches:
            h, at = word_hashes(pdf["text"], lower=True)
            rows = []
            for i, doc in enumerate(pdf["doc_id"]):
                words = h[at[i]:at[i + 1]]
                s = np.unique(shingle_list(words, WORDS))
                weights = np.arange(1, len(words) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
                k1 = int((words * weights).sum().astype(np.int64)) if len(words) else 0
                k2 = int(((words >> np.uint64(17)) * (weights ^ np.uint64(0x5851F42D4C957F2D))).sum().astype(np.int64)) if len(words) else 0
                rows.append((None if pd.isna(doc) else int(doc), k1, k2, len(words), len(s),
                             signature(s).view(np.int32).tolist() if len(s) else None))
            yield pd.DataFrame(rows, columns=["doc_id", "k1", "k2", "n_words", "n_shingles", "sig"]).astype({"doc_id": "Int64"})


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """doc, text -> doc, its sorted distinct shingles as 6-byte integers in one binary."""
    with np.errstate(over="ignore"):
        for pdf in batches:
            h, at = word_hashes(pdf["text"], lower=True)
            packed = []
            for i in range(len(pdf)):
                s = np.unique(shingle_list(h[at[i]:at[i + 1]], WORDS))
                packed.append(np.ascontiguousarray(s.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes())
            yield pd.DataFrame({"doc": pdf["doc"], "members": packed})


def _unpack(raw: bytes) -> np.ndarray:
    six = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 6)
    eight = np.zeros((len(six), 8), dtype=np.uint8)
    eight[:, :6] = six
    return eight.view(np.uint64).ravel()


def _confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs with both sets -> the pairs that are links, with intersection and union sizes."""
    for pdf in batches:
        rows = []
        for a, b, x, y in zip(pdf["a"], pdf["b"], pdf["set_a"], pdf["set_b"], strict=True):
            both = np.concatenate([_unpack(x), _unpack(y)])
            union = len(np.unique(both))
            common = len(both) - union
            if 100 * common >= PERCENT * union:
                rows.append((a, b, common, union))
        yield pd.DataFrame(rows, columns=["a", "b", "common", "union"]).astype("int64")


def _agreement(x: str, y: str) -> F.Column:
    return F.aggregate(F.zip_with(x, y, lambda p, q: (p == q).cast("int")), F.lit(0), lambda s, v: s + v)


def _links(pairs: DataFrame, sigs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of distinct (a, b): those that agree in enough coordinates and are links on their full sets."""
    p = (pairs.join(sigs.select(F.col("doc").alias("a"), F.col("sig").alias("sig_a")), "a")
         .join(sigs.select(F.col("doc").alias("b"), F.col("sig").alias("sig_b")), "b")
         .where(_agreement("sig_a", "sig_b") >= MATCHES).select("a", "b"))
    return (p.join(sets.select(F.col("doc").alias("a"), F.col("members").alias("set_a")), "a")
            .join(sets.select(F.col("doc").alias("b"), F.col("members").alias("set_b")), "b")
            .mapInPandas(_confirm, "a long, b long, common long, `union` long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest id reachable over links (Jaccard of full
    5-word shingle sets >= 0.75), itself included.  NULL or empty texts and
    texts of white space have an empty set and are linked with nothing; a text
    of one to four words is one shingle.  Rows that share an id count as one
    document when links are followed; rows without an id are kept, alone, with
    component NULL.  Other columns of ``docs`` are ignored, whatever their names.
    """
    spark: SparkSession = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    profile = materialise(spark, base.mapInPandas(
        _profile, "doc_id long, k1 long, k2 long, n_words long, n_shingles long, sig array<int>"), "profile")

    # classes of equal word sequences; one representative each
    named = profile.where("doc_id is not null and n_shingles > 0")
    classes = named.groupBy("k1", "k2", "n_words").agg(F.min("doc_id").alias("doc"))
    # the representative's row; rows that share its id and its key are the same text
    sigs = (named.select(F.col("doc_id").alias("doc"), "n_shingles", "sig", "k1", "k2", "n_words")
            .join(classes, ["doc", "k1", "k2", "n_words"], "left_semi").dropDuplicates(["doc", "k1", "k2"])
            .select("doc", "n_shingles", "sig"))
    sigs = materialise(spark, sigs, "sigs")

    # posting lists of values that several texts carry
    prefix = materialise(spark, _postings(sigs), "postings")
    heads = prefix.groupBy("token").agg(F.count("*").alias("n"), F.min("doc").alias("hub")).where("n > 1")
    listed = materialise(spark, prefix.join(heads, "token"), "lists")

    candidates = listed.select("doc").distinct()
    texts = base.select(F.col("doc_id").alias("doc"), "text").join(candidates, "doc", "left_semi")
    sets = texts.mapInPandas(_sets, "doc long, members binary")
    same_id = None
    if not named.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        sets = sets.distinct()  # rows that share an id: each of its sets once
        # and the representatives of its texts are connected
        reps = materialise(spark, named.join(classes, ["k1", "k2", "n_words"]).select("doc_id", "doc").distinct(), "same_id")
        low = reps.groupBy("doc_id").agg(F.min("doc").alias("a"))
        same_id = reps.join(low, "doc_id").where("a < doc").select("a", F.col("doc").alias("b")).distinct()
    sets = materialise(spark, sets, "sets")

    # 1. each text against the hub it shares most lists with
    hubs = listed.where("doc > hub").groupBy(F.col("hub").alias("a"), F.col("doc").alias("b")).agg(F.count("*").alias("lists"))
    best = hubs.groupBy("b").agg(F.max_by("a", F.struct("lists", F.negate("a"))).alias("a")).select("a", "b")
    links = materialise(spark, _links(best, sigs, sets), "links")

    # 2. hubs and list neighbours that are still in another component
    def with_component(rows: DataFrame, comp: DataFrame) -> DataFrame:
        return (rows.join(comp.withColumnRenamed("node", "doc"), "doc", "left")
                .withColumn("component", F.coalesce("component", "doc")))

    # one hop is enough to tell most: texts that are linked to the same hub are connected
    linked = links.select(F.col("b").alias("node"), F.col("a").alias("component"))
    apart = materialise(spark, with_component(listed.select("token", "doc", "n"), linked), "apart")
    first = apart.groupBy("token").agg(F.min(F.struct("doc", "component")).alias("hub"))
    to_hub = (apart.join(first, "token").where("component != hub.component")
              .select(F.col("hub.doc").alias("a"), F.col("doc").alias("b")))
    near = materialise(spark, to_hub.unionByName(_neighbours(apart)).distinct().join(best, ["a", "b"], "left_anti"), "near")
    links = materialise(spark, links.unionByName(_links(near, sigs, sets)), "links")
    edges = links.select("a", "b")
    comp = materialise(spark, connected_components(edges.unionByName(same_id) if same_id is not None else edges), "components")

    # 3. what is left: pairs of one list in different components (a list of two is done)
    rest = with_component(apart.where("n > 2").select("token", "doc"), comp)
    mixed = (rest.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo != hi").select("token"))
    rest = materialise(spark, rest.join(mixed, "token", "left_semi"), "unresolved")
    left = _last_pairs(sets, sigs, rest.groupBy("doc").agg(F.min("component").alias("component")))
    left = left.join(near, ["a", "b"], "left_anti").join(best, ["a", "b"], "left_anti")
    late = materialise(spark, _links(left, sigs, sets), "links")
    if not late.isEmpty():  # join the components that the last links connect
        for side in ("a", "b"):
            late = with_component(late.withColumnRenamed(side, "doc"), comp).withColumn(side, F.col("component")).drop("doc", "component")
        merged = connected_components(late.select("a", "b")).select(F.col("node").alias("component"), F.col("component").alias("root"))
        known = comp.unionByName(merged.select(F.col("component").alias("node"), "component")).distinct()
        comp = known.join(merged, "component", "left").select("node", F.coalesce("root", "component").alias("component")).distinct()

    of_class = classes.join(comp.withColumnRenamed("node", "doc"), "doc", "left").select(
        "k1", "k2", "n_words", F.coalesce("component", "doc").alias("component"))
    return (profile.join(of_class, ["k1", "k2", "n_words"], "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component")))
                    .otherwise(F.col("doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _postings(sigs: DataFrame) -> DataFrame:
    """(doc, token): each text's prefix, its values that several texts carry without the M - 1 most frequent of them.

    Values held by one text alone take the first places of the prefix and meet nobody.  All K
    values of every text pass here: the rows are sorted once by value and what is left
    once by text, nothing is joined back or gathered into arrays.
    """
    tokens = sigs.select("doc", F.explode(F.transform(
        "sig", lambda v, i: F.shiftleft(i.cast("long"), 32) + (v.cast("long") + F.lit(2147483648)))).alias("token"))
    shared = tokens.withColumn("df", F.count("*").over(Window.partitionBy("token"))).where("df > 1")
    often_first = Window.partitionBy("doc").orderBy(F.desc("df"), F.desc("token"))
    return shared.withColumn("place", F.row_number().over(often_first)).where(F.col("place") >= MATCHES).select("doc", "token")


def _neighbours(lists: DataFrame) -> DataFrame:
    """Each text with the next one of its lists, in an order of each list's own, where their components differ.

    A list is split by a hash of (list, text) into parts of about 100 texts and
    only neighbours within a part are paired, so a list that many texts share is
    not sorted by one task.
    """
    mixed = lists.withColumn("r", F.xxhash64("token", "doc"))
    mixed = mixed.withColumn("part", F.pmod(F.col("r"), F.greatest(F.lit(1), F.expr("n div 100"))))
    w = Window.partitionBy("token", "part").orderBy("r", "doc")
    pairs = mixed.withColumn("next", F.lead(F.struct("doc", "component")).over(w)).where("next.component != component")
    return pairs.select(F.least("doc", "next.doc").alias("a"), F.greatest("doc", "next.doc").alias("b"))


def _last_pairs(sets: DataFrame, sigs: DataFrame, unresolved: DataFrame) -> DataFrame:
    """Pairs (a, b) of unresolved texts in different components that can still be links.

    An exact prefix filter on the full sets: with the shingles in one common
    order, rare ones first, two sets with a Jaccard of PERCENT share a shingle in the
    first n - PERCENT% n + 1 of each, and where they first meet, at places i and j, no
    more than 1 + min(n - i, m - j) shingles can be common.  In a family of near
    copies the rare shingles are those of the edits, so few texts meet.  Shingles in
    more than RARE of the unresolved texts come after the rare ones, in hash order.
    """
    spark = sets.sparkSession
    unresolved = materialise(spark, unresolved, "unresolved")
    mine = sets.join(unresolved.select("doc"), "doc", "left_semi")

    def flat(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for doc, raw in zip(pdf["doc"], pdf["members"], strict=True):
                s = _unpack(raw).view(np.int64)
                for at in range(0, len(s), 100_000):
                    part = s[at:at + 100_000]
                    yield pd.DataFrame({"doc": np.full(len(part), doc, dtype=np.int64), "s": part})

    rows = mine.mapInPandas(flat, "doc long, s long")
    rare = rows.groupBy("s").agg(F.count("*").alias("df")).where(F.col("df") <= RARE)
    known = rows.join(rare, "s")

    def prefix(sets_of: pd.DataFrame, known_of: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"doc": [], "token": [], "place": [], "n": []}, dtype="int64")]
        for doc, raw in zip(sets_of["doc"], sets_of["members"], strict=True):
            s = _unpack(raw).view(np.int64)
            held = known_of.drop_duplicates("s").set_index("s")["df"]
            df = pd.Series(s).map(held).fillna(RARE + 1).to_numpy(dtype=np.int64)
            order = np.lexsort((s, df))[: len(s) - -(-PERCENT * len(s) // 100) + 1]
            place = np.arange(1, len(order) + 1)
            shared = df[order] > 1           # a shingle of this text alone meets nobody
            out.append(pd.DataFrame({"doc": doc, "token": s[order][shared], "place": place[shared], "n": len(s)}).astype("int64"))
        return pd.concat(out)

    heads = mine.groupBy("doc").cogroup(known.groupBy("doc")).applyInPandas(prefix, "doc long, token long, place long, n long")
    heads = materialise(spark, heads.join(unresolved, "doc").join(sigs.select("doc", "sig"), "doc"), "prefixes")
    x, y = heads.alias("x"), heads.alias("y")
    both = F.expr("x.n + y.n")
    return x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.doc") < F.col("y.doc"))
                  & (F.col("x.component") != F.col("y.component"))
                  & ((100 + PERCENT) * (1 + F.least(F.expr("x.n - x.place"), F.expr("y.n - y.place"))) >= PERCENT * both)
                  & (_agreement("x.sig", "y.sig") >= MATCHES)).select(
        F.col("x.doc").alias("a"), F.col("y.doc").alias("b")).distinct()

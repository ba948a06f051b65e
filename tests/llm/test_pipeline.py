"""The pipeline's stages against brute force on a small corpus, and the queries with SQL against DuckDB."""

import hashlib
import os

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_neardup import brute as brute_components

import corpus_pipeline as P
from runway.llm import bpe, oracle, queries, secrets
from runway.session import shared_path

SF = "/root/testdata/sf0.001"


def key(n):
    return hashlib.sha1(str(n).encode()).hexdigest()


@pytest.fixture(scope="module")
def corpus(spark, make_docs, lorem):
    item = lorem(25)
    good = lambda: ". ".join(lorem(14).capitalize() for _ in range(6)) + "."
    rows = [(i, good()) for i in range(120)]
    rows += [(200 + i, " ".join(w + "###" for w in lorem(80).split())) for i in range(60)]           # junk
    rows += [(300 + i, rows[i][1] + " added words") for i in range(10)]                              # near copies
    rows += [(320 + i, rows[20][1]) for i in range(5)]                                               # exact copies
    rows += [(340 + i, f"{good()} {item} {good()}") for i in range(4)]                               # benchmark passages
    rows += [(350 + i, f'{good()} token = "{key(i)}" {good()}') for i in range(5)]                   # secrets
    rows += [(360, None), (361, ""), (None, good())]
    base = shared_path(spark, "corpus")
    make_docs(rows, clashing=False).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(i, int(not 200 <= i < 300), 0) for i, _ in rows if i is not None and i < 360], T.StructType([
        T.StructField(n, T.LongType()) for n in ("doc_id", "quality", "toxic")])).write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, item), (2, lorem(30))], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base, rows, item


def stage(spark, base, docs, n):
    out = P.STAGES[n][1](spark, docs, base)
    path = shared_path(spark, f"stage{n}")
    out.write.parquet(path)
    return spark.read.parquet(path)


def pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=str)


def test_stages_one_after_the_other(spark, corpus):
    base, rows, item = corpus
    docs = spark.read.parquet(f"{base}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "bpe"]

    one = stage(spark, base, docs, 0)
    kept = pairs(one)
    assert one.columns == P.DOCUMENT_COLUMNS
    assert not {i for i, _ in kept} & set(range(200, 260))
    assert {i for i, _ in kept} >= {*range(120), *range(300, 310), *range(340, 344), *range(350, 355)}

    two = stage(spark, base, one, 1)
    stays = {i for i, _, _, k in brute_components(kept) if k}
    assert pairs(two) == [(i, t) for i, t in kept if i in stays]
    assert not {i for i, _ in pairs(two)} & {*range(300, 310), *range(320, 325)}

    three = stage(spark, base, two, 2)
    assert pairs(three) == [(i, t) for i, t in pairs(two) if item not in (t or "")]

    four = stage(spark, base, three, 3)
    want = []
    for i, t in pairs(three):
        if i is not None and 350 <= i < 355:
            t = t.replace(key(i - 350), secrets.MASK)
        want.append((i, t))
    assert pairs(four) == want
    assert all(r["n_chars"] == len(r["text"]) for r in four.where("text is not null").collect())

    five = stage(spark, base, four, 4)
    tokenizer = bpe.load(queries.tokenizer_path())
    got = sorted(((r["doc_id"], list(r["ids"]), r["n_tokens"], r["decoded"]) for r in five.collect()), key=str)
    expect = []
    for i, t in pairs(four):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        expect.append((i, ids, len(ids), tokenizer.decode(ids, skip_special_tokens=False)))
    assert got == sorted(expect, key=str)


def test_run_applies_the_stages(spark, corpus):
    base, _, _ = corpus
    out = P.run(spark, base)
    assert out.columns == ["doc_id", "lang", "source", "ids", "n_tokens", "decoded"]
    ids = {r["doc_id"] for r in out.select("doc_id").collect()}
    assert ids >= set(range(20, 120)) and not ids & {*range(200, 260), *range(300, 310), *range(340, 344)}


CLASHES = ("stats", "token", "component", "block", "word", "run", "lead", "path", "position", "label", "kept", "ids", "data", "v", "secret", "features")


@pytest.mark.parametrize("rows", ["none", "bad", "some"])
def test_registered_queries_take_empty_tables_and_clashing_columns(spark, corpus, rows):
    """op1 and the pipeline on documents with extra columns, on none, and on documents of which no stage keeps any."""
    base, _, _ = corpus
    docs = spark.read.parquet(f"{base}/documents.parquet").withColumns({c: F.lit("clash") for c in CLASHES})
    docs = docs.where({"none": "false", "bad": "doc_id between 200 and 259", "some": "true"}[rows])
    folder = shared_path(spark, f"corpus-{rows}")
    docs.write.parquet(f"{folder}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{base}/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
    out = P.run(spark, folder)
    found = queries.QUERIES["op1_secret_scan"](spark, folder)
    if rows == "none":
        assert out.count() == 0 and found.count() == 0
    elif rows == "bad":
        assert out.columns == ["doc_id", "lang", "source", "ids", "n_tokens", "decoded"] and out.count() <= 60
    else:
        want = {(r["doc_id"], tuple(r["ids"])) for r in P.run(spark, base).collect()}
        assert {(r["doc_id"], tuple(r["ids"])) for r in out.collect()} == want
        assert {r["doc_id"] for r in found.where("is_secret").collect()} == set(range(350, 355))


def test_run_leaves_the_input_of_its_last_stage_only(spark, corpus):
    folder = os.path.dirname(corpus[0].removeprefix("file:"))
    before = set(os.listdir(folder))
    assert P.run(spark, corpus[0]).count() > 100
    assert len([n for n in set(os.listdir(folder)) - before if n.startswith("runway-")]) == 1


def test_ids_are_written_before_they_are_decoded(spark, corpus):
    """One Python worker a task: what the last stage returns reads written ids and only decodes them."""
    out = P.encode_bpe(spark, spark.read.parquet(f"{corpus[0]}/documents.parquet"), corpus[0])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "InArrow" not in plan and "InPandas" not in plan
    assert out.count() == len(corpus[1])


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(oracle.ORACLES))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(oracle.ORACLES[name])
    columns = [c[0] for c in res.description]
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(res.fetchall())

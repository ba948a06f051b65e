import datetime as dt
import math
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runway.functions import schema
from runway.operators import predicates
from runway.plans import catalog
from runway.session import intermediates, private_folder_allowed, shared_path
from runway.sources.sinks import current_version, materialise, read_current, replace_and_reload, replace_table


def test_schema_diff_and_same_columns(spark):
    a = spark.createDataFrame([(1, "x", 2.0)], "id int, name string, v double")
    b = spark.createDataFrame([(1, 2.0, "x")], "id long, v double, extra string")
    d = {r["name"]: r for r in schema.schema_diff(spark, a, b).collect()}
    assert set(d) == {"id", "name", "v", "extra"}
    assert d["id"]["left_type"] == "int" and d["id"]["right_type"] == "bigint" and not d["id"]["same"]
    assert d["v"]["left_pos"] == 2 and d["v"]["right_pos"] == 1 and not d["v"]["same"]
    assert d["name"]["right_pos"] is None and d["extra"]["left_pos"] is None
    assert schema.same_columns(a, a.select("*")) and not schema.same_columns(a, b)
    assert all(r["same"] for r in schema.schema_diff(spark, a, a).collect())


def test_conform_casts_orders_and_fills(spark):
    df = spark.createDataFrame([("7", 1.5, "x")], "a string, b double, c string")
    declared = T.StructType([T.StructField("b", schema.spark_type_for("float64")),
                             T.StructField("a", schema.spark_type_for("int64")),
                             T.StructField("z", schema.spark_type_for("datetime64[ns]")),
                             T.StructField("c", schema.spark_type_for("int32"))])
    out = schema.conform(df, declared, strict=False)
    assert out.columns == ["b", "a", "z", "c"]
    assert [f.dataType for f in out.schema.fields] == [T.FloatType(), T.LongType(), T.TimestampType(),
                                                       T.IntegerType()]
    assert tuple(out.first()) == (1.5, 7, None, None)      # 'x' -> int fails softly to NULL
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        schema.conform(df, declared).collect()


def test_conform_counts_failed_casts(spark):
    df = spark.createDataFrame([("7", "x", 1), ("y", None, 2), (None, "z", 3), ("8", "9", 4)], "`a.b` string, rows string, n int")
    declared = T.StructType([T.StructField("a.b", T.LongType()), T.StructField("rows", T.IntegerType()),
                             T.StructField("missing", T.DateType()), T.StructField("n", T.StringType())])
    seen = Observation("casts")
    out = schema.conform(df, declared, strict=False, failed=seen)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(7, None, None, "1"), (None, None, None, "2"), (None, None, None, "3"), (8, 9, None, "4")], key=str)
    assert seen.get == {"rows": 4, "a.b": 1, "rows_": 2, "n": 0}
    with pytest.raises(ValueError, match="strict"):
        schema.conform(df, declared, failed=Observation())


def test_prefix_and_select_by_type(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1.0, 2)], "time timestamp_ntz, avg_t double, n int")
    assert schema.prefix_columns(df, "dep_").columns == ["dep_time", "dep_avg_t", "dep_n"]
    assert schema.prefix_columns(df, "arr_", keep=("n",)).columns == ["arr_time", "arr_avg_t", "n"]
    assert schema.select_by_type(df).columns == ["avg_t"]


def test_open_span_on_dates_excludes_both_ends(spark):
    df = spark.createDataFrame([(dt.date(2018, 1, d),) for d in (1, 2, 9, 10)], "FL_DATE date")
    got = [r[0].day for r in predicates.open_span(df, "FL_DATE", "2018-01-01", "2018-01-10").collect()]
    assert sorted(got) == [2, 9]


def test_replace_and_reload_overwrites(spark):
    path = shared_path(spark, "test-sink")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    second = spark.createDataFrame([(3, "a")], "k int, p string")
    assert replace_and_reload(spark, first, path, partition_by=("p",)).count() == 2
    back = replace_and_reload(spark, second, path, partition_by=("p",))
    assert [tuple(r) for r in back.select("k", "p").collect()] == [(3, "a")]
    m = materialise(spark, first, "test-mat")
    assert sorted(r["k"] for r in m.collect()) == [1, 2]


def test_a_failing_replace_leaves_the_old_rows(spark):
    path = shared_path(spark, "test-versions")
    first = replace_table(spark, spark.range(10), path)
    broken = spark.range(1000).withColumn("id", F.when(F.col("id") < 990, F.col("id")).otherwise(F.raise_error(F.lit("broken row")).cast("long")))
    with pytest.raises(Exception, match="broken row"):
        replace_table(spark, broken, path)
    assert current_version(spark, path) == first and read_current(spark, path).count() == 10
    folder = path.removeprefix("file:")
    assert sorted(n for n in os.listdir(folder) if not n.startswith(".")) == sorted(["_current", os.path.basename(first)])

    # a plan may read the rows it replaces; readers of the old version can be spared
    second = replace_table(spark, read_current(spark, path).where("id < 4"), path, keep_old=True)
    assert read_current(spark, path).count() == 4 and spark.read.parquet(first).count() == 10
    replace_table(spark, read_current(spark, path).where("id < 2"), path)
    assert read_current(spark, path).count() == 2 and not os.path.exists(second.removeprefix("file:"))


def test_partitioned_write_makes_few_files(spark):
    path = shared_path(spark, "test-files")
    df = spark.range(4000).repartition(16).withColumn("p", (F.col("id") % 3).cast("string"))
    assert replace_and_reload(spark, df, path, partition_by=("p",)).count() == 4000
    files = [f for _, _, names in os.walk(path.removeprefix("file:")) for f in names if f.endswith(".parquet")]
    assert len(files) <= 6


def test_intermediates_are_removed_also_on_failure(spark):
    keep = shared_path(spark, "kept")
    paths = []
    with pytest.raises(RuntimeError), intermediates(spark):
        paths.append(shared_path(spark, "gone"))
        spark.range(3).write.parquet(paths[0])
        raise RuntimeError
    spark.range(3).write.parquet(keep)
    assert not os.path.exists(paths[0].removeprefix("file:")) and os.path.exists(keep.removeprefix("file:"))


def test_jobs_at_the_same_time_keep_their_own_tables(spark):
    import threading
    inside, done = threading.Event(), threading.Event()
    paths = {}

    def other():
        with intermediates(spark):
            paths["other"] = shared_path(spark, "other")
            spark.range(3).write.parquet(paths["other"])
            inside.set()
            done.wait(60)

    worker = threading.Thread(target=other)
    worker.start()
    inside.wait(60)
    with intermediates(spark):
        paths["mine"] = shared_path(spark, "mine")
        spark.range(3).write.parquet(paths["mine"])
    assert not os.path.exists(paths["mine"].removeprefix("file:")) and spark.read.parquet(paths["other"]).count() == 3
    done.set()
    worker.join()
    assert not os.path.exists(paths["other"].removeprefix("file:"))


def test_only_a_local_session_may_use_a_private_folder():
    assert private_folder_allowed("local") and private_folder_allowed("local[*]")
    for master in ("yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"):
        assert not private_folder_allowed(master)


def test_compared_columns_keep_special_values(spark):
    df = spark.sql("SELECT double('NaN') a, double('Infinity') b, 1e30D c, 1e-7D d, -double('Infinity') e")
    kept = catalog.settled(df, ("a", "b", "c", "e")).first()
    assert math.isnan(kept["a"]) and kept["b"] == math.inf and kept["c"] == 1e30 and kept["e"] == -math.inf
    assert kept["d"] == 1e-7                                # not a sum: untouched

"""Per-carrier statistics, shares, histograms and the correlation matrix.

These are the numbers behind the reference's charts (pie slices, strip plot,
correlation heat map); the charts themselves are not built.  Every statistic is
a partial/final aggregate, so a carrier with a third of all legs costs one
pre-aggregated row per task before the shuffle.
"""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runway.functions.schema import columns_of_type
from runway.functions.text import delay_label
from runway.session import default_parallelism
from runway.sources.sinks import materialise

#: a variance below this part of the mean square is computed once more, exactly
CONSTANT = 1e-7
#: size of a delay sketch: its rank error stays below SKETCH_ERROR with 99 % confidence
SKETCH_K = 1024
SKETCH_ERROR = 0.005


def carrier_stats(df: DataFrame, carrier: str = "OP_UNIQUE_CARRIER",
                  delay: str = "DEP_DELAY_NEW") -> DataFrame:
    """min, max, count and mean delay per carrier (NULL delays ignored, NULL carrier
    dropped), sorted by count ascending."""
    return _per_carrier(df, carrier, delay).orderBy("n_delay", "carrier")


def _per_carrier(df: DataFrame, carrier: str, delay: str) -> DataFrame:
    return (df.where(F.col(carrier).isNotNull())
              .groupBy(F.col(carrier).alias("carrier"))
              .agg(F.min(delay).alias("min_delay"), F.max(delay).alias("max_delay"),
                   F.count(delay).alias("n_delay"), F.avg(delay).alias("mean_delay")))


def carrier_share(df: DataFrame, carrier: str = "OP_UNIQUE_CARRIER",
                  delay: str = "DEP_DELAY_NEW") -> DataFrame:
    """Share of legs per carrier in percent, with the whole-percent label value.

    Counts are the per-carrier non-NULL delay counts (the pie sizes); the total
    is a window over the already aggregated rows (one per carrier).
    """
    counts = _per_carrier(df, carrier, delay).select("carrier", "n_delay")
    pct = F.col("n_delay") * 100.0 / F.sum("n_delay").over(Window.partitionBy())
    return counts.select("carrier", "n_delay", pct.alias("share_pct"),
                         F.bround(pct, 0).alias("share_label"))


def carrier_mean_clipped(df: DataFrame, carrier: str = "OP_UNIQUE_CARRIER",
                         delay: str = "DEP_DELAY_NEW") -> DataFrame:
    """Mean delay per carrier clipped at zero, and its whole-minute label value."""
    means = _per_carrier(df, carrier, delay).select("carrier", "mean_delay")
    clipped = F.greatest(F.col("mean_delay"), F.lit(0.0))
    return means.select("carrier", clipped.alias("mean_clipped"),
                        F.bround(clipped, 0).alias("mean_label"))


def delay_histogram(df: DataFrame, width: float = 15.0, carrier: str = "OP_UNIQUE_CARRIER",
                    delay: str = "DEP_DELAY_NEW") -> DataFrame:
    """Distribution of delay per carrier: fixed-width bins and their counts."""
    bin_lo = F.floor(F.col(delay) / F.lit(width)) * F.lit(width)
    return (df.where(F.col(delay).isNotNull())
              .groupBy(F.col(carrier).alias("carrier"), bin_lo.cast("double").alias("bin_lo"))
              .agg(F.count(F.lit(1)).alias("n")))


def delay_quantiles(df: DataFrame, probs=(0.25, 0.5, 0.75), carrier: str = "OP_UNIQUE_CARRIER",
                    delay: str = "DEP_DELAY_NEW") -> DataFrame:
    """Exact quantiles of delay per carrier (interpolated), one column q25, q50, ... each.

    Delays are counted per (carrier, value) first, so the quantiles are taken over
    the distinct values of a carrier with their frequencies.
    """
    counts = (df.where(F.col(delay).isNotNull()).groupBy(F.col(carrier).alias("carrier"), F.col(delay).alias("v"))
                .agg(F.count(F.lit(1)).alias("n")))
    return counts.groupBy("carrier").agg(*[F.percentile("v", p, F.col("n")).alias(f"q{round(p * 100)}") for p in probs])


def delay_sketches(df: DataFrame, keys: tuple[str, ...] = ("OP_UNIQUE_CARRIER",), delay: str = "DEP_DELAY_NEW", k: int = SKETCH_K) -> DataFrame:
    """A mergeable quantile sketch (KLL) of the delays of each group: the key columns, n, sketch.

    For continuous delays, where ``delay_quantiles`` would keep every distinct value.  A
    sketch is some tens of kilobytes however many delays it has seen; sketches of days or
    airports can be written and merged later (``merge_sketches``).  NULL and NaN delays
    are left out; a group without any has no row.
    """
    seen = df.where(F.col(delay).isNotNull() & ~F.isnan(F.col(delay).cast("double")))
    return seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(delay).cast("double"), F.lit(k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Sketches of finer groups (or of several tables) merged to one per ``keys``."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """The sketches' quantiles, one column q25, q50, ... each: delays that occurred, whose rank is off by SKETCH_ERROR at most."""
    quantiles = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(f"q{round(p * 100)}") for p in probs]
    return sketches.select(*[c for c in sketches.columns if c not in ("n", "sketch")], "n", *quantiles)


def sketch_rank_errors(df: DataFrame, quantiles: DataFrame, probs=(0.25, 0.5, 0.75), carrier: str = "OP_UNIQUE_CARRIER",
                       delay: str = "DEP_DELAY_NEW") -> DataFrame:
    """(carrier, prob, n, rank_error): how far each sketched quantile is from its place among the delays, counted exactly.

    A value that occurs often covers a range of places; the error is the distance from that range.
    """
    long = quantiles.select(F.col(carrier).alias("carrier"), F.inline(F.array(*[
        F.struct(F.lit(float(p)).alias("prob"), F.col(f"q{round(p * 100)}").alias("value")) for p in probs])))
    seen = df.where(F.col(delay).isNotNull()).groupBy(F.col(carrier).alias("of"), F.col(delay).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    counted = (long.join(seen, F.col("carrier").eqNullSafe(F.col("of"))).groupBy("carrier", "prob")
               .agg(F.sum("c").alias("n"), F.sum(F.when(F.col("v") < F.col("value"), F.col("c")).otherwise(0)).alias("below"),
                    F.sum(F.when(F.col("v") <= F.col("value"), F.col("c")).otherwise(0)).alias("upto")))
    low, high = F.col("below") / F.col("n"), F.col("upto") / F.col("n")
    return counted.select("carrier", "prob", "n", F.greatest(F.lit(0.0), low - F.col("prob"), F.col("prob") - high).alias("rank_error"))


def numbered_distinct(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values of a column with their place in sorted order (from 1).

    The values are split into ranges, counted per range and numbered within
    ranges, so no task sees them all.
    """
    spark = df.sparkSession
    values = df.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct()
    ranged = values.repartitionByRange(default_parallelism(spark), "value").withColumn("range", F.spark_partition_id())
    ranged = materialise(spark, ranged, "distinct")       # the ranges stay as they are for both uses
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)   # one row per range
    totals = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    starts = totals.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("range").orderBy("value")
    return (ranged.withColumn("r", F.row_number().over(within)).join(F.broadcast(starts), "range")
                  .select("value", (F.col("first") + F.col("r")).alias("place")))


def delay_labels(df: DataFrame, delay: str = "DEP_DELAY_NEW",
                 keys: tuple[str, ...] = ()) -> DataFrame:
    """Each delay with its ``' 2h15m'`` label."""
    return df.select(*keys, F.col(delay).alias("delay"), delay_label(delay).alias("label"))


def pearson_pairs(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pairwise Pearson correlation in long form (col_a, col_b, corr).

    Pairwise complete: each pair uses the rows where both are neither NULL nor NaN.
    A column that is constant on a pair's rows, or holds an infinite value, gives NULL
    (not an error under ANSI).

    The columns are written once.  A first pass takes each column's mean and range; the
    second turns each row into one vector of the shifted and scaled values, of which
    values are present, and of the squares, and sums up the vectors' Gram matrix: it
    holds, for every pair, the number of complete rows and the sums of x, y, xy, xx and yy.
    A task keeps one such matrix, and matrices are merged as a tree, so what
    travels depends on the number of columns alone.  Pairs whose variance all but
    vanishes on their common rows are computed once more by exact aggregates.
    """
    if columns is None:
        columns = columns_of_type(df)
    spark = df.sparkSession
    schema = "col_a string, col_b string, corr double"
    if not columns:
        return spark.createDataFrame([], schema)
    k = len(columns)
    number = [F.col(c).cast("double") for c in columns]
    values = materialise(spark, df.select(*[F.when(~F.isnan(c), c).alias(f"v{i}") for i, c in enumerate(number)]), "numbers")
    values = _scaled(values, k)
    moments = _comoments(values, k)

    doubtful, found = [], {}
    for i in range(k):
        for j in range(i, k):
            n, sx, sy, sxy, sxx, syy = moments(i, j)
            if not n:
                found[i, j] = None
                continue
            var_x, var_y = sxx / n - (sx / n) ** 2, syy / n - (sy / n) ** 2
            if not (math.isfinite(var_x) and math.isfinite(var_y)):
                found[i, j] = None
            elif var_x <= CONSTANT * sxx / n or var_y <= CONSTANT * syy / n:
                doubtful.append((i, j))
            else:
                found[i, j] = (sxy / n - sx / n * (sy / n)) / math.sqrt(var_x * var_y)
    for at in range(0, len(doubtful), 50):
        found |= _exact_correlations(values, doubtful[at:at + 50])
    cells = [(columns[a], columns[b], found[min(a, b), max(a, b)]) for a in range(k) for b in range(k)]
    return spark.createDataFrame(cells, schema)


def _scaled(values: DataFrame, k: int) -> DataFrame:
    """The columns v0 ... less their mean, divided by their range, so that sums of squares neither lose digits nor overflow."""
    names = [f"v{i}" for i in range(k)]
    seen = values.agg(*[F.avg(c).alias(f"m_{c}") for c in names], *[(F.max(c) - F.min(c)).alias(f"r_{c}") for c in names]).first()
    return values.select(*[((F.col(c) - F.lit(seen[f"m_{c}"] or 0.0)) / F.lit(seen[f"r_{c}"] or 1.0)).alias(c) for c in names])


def _comoments(values: DataFrame, k: int):
    """Lookup of (n, sum x, sum y, sum xy, sum xx, sum yy) of a pair of the columns v0 ... of ``values``."""
    z = [F.col(f"v{i}") for i in range(k)]
    absent = F.lit(0.0)
    vector = F.array(*[F.coalesce(x, absent) for x in z], *[x.isNotNull().cast("double") for x in z], *[F.coalesce(x * x, absent) for x in z])
    rows = MLUtils.convertVectorColumnsFromML(values.select(array_to_vector(vector).alias("row")), "row")
    if rows.isEmpty():
        return lambda i, j: (0, 0.0, 0.0, 0.0, 0.0, 0.0)
    gram = RowMatrix(rows, numCols=3 * k).computeGramianMatrix().toArray().tolist()

    def pair(i: int, j: int) -> tuple:
        return (gram[k + i][k + j], gram[i][k + j], gram[j][k + i], gram[i][j], gram[2 * k + i][k + j], gram[2 * k + j][k + i])
    return pair


def _exact_correlations(values: DataFrame, pairs: list[tuple[int, int]]) -> dict[tuple[int, int], float | None]:
    """Correlations by Spark's own covariance and deviation, each over the rows where both are present."""
    def one(i: int, j: int):
        both = F.col(f"v{i}").isNotNull() & F.col(f"v{j}").isNotNull()
        x, y = F.when(both, F.col(f"v{i}")), F.when(both, F.col(f"v{j}"))
        r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
        return F.when(~F.isnan(r), r).alias(f"r{i}_{j}")
    got = values.agg(*[one(i, j) for i, j in pairs]).first()
    return {(i, j): got[f"r{i}_{j}"] for i, j in pairs}

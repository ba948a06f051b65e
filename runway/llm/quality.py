"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

Each text is reduced to ``STATISTICS`` numbers.  Random Fourier features of the
standardised numbers approximate a Gaussian kernel; every partition of the
labelled rows sums its part of the normal equations, Spark adds the parts cell by
cell, and the ridge solution of the fixed-size system gives a raw score.  A
fixed grid of raw scores with label counts, again summed by Spark, is turned
into a monotone map to [0, 1] by pooling adjacent violators.

Only the fixed-size sums (moments, normal equations, grid) reach the driver.
All labelled training rows are used; none are sampled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runway.llm.wordhash import gram_hashes, word_hashes

STATISTICS = ("words", "bytes", "word_bytes", "upper", "digits", "symbols", "exclaims", "bars", "stops",
              "non_ascii", "distinct_words", "distinct_runs", "top_word", "lines", "distinct_lines")
FEATURES = 256        # random Fourier features
BANDWIDTH = 0.1       # gamma of exp(-gamma * |x - y|^2) on standardised statistics
RIDGE = 1.0           # added to the diagonal of the normal equations
GRID = 2048           # cells of raw score over [-0.5, 1.5] for the calibration
FOLDS = 4             # of the training rows, one fold in FOLDS calibrates and the others fit the ridge
THRESHOLD = 0.3       # predicted 1 from this score on

# byte classes: 1 upper, 2 digit, 3 symbol, 4 exclamation, 5 bar, 6 stop or comma, 7 line end, 8 non-ASCII
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[65:91] = 1
_CLASS[48:58] = 2
for _c in b"#$%&*+/<=>@\\^_`{}~[]":
    _CLASS[_c] = 3
_CLASS[ord("!")], _CLASS[ord("|")], _CLASS[10] = 4, 5, 7
_CLASS[ord(".")] = _CLASS[ord(",")] = 6
_CLASS[128:] = 8


def text_statistics(text: str | None, words: np.ndarray) -> list[float]:
    """The statistics of one whole text, given the hashes of its words; all zero for no text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(STATISTICS)
    size = len(raw)
    by_byte = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    kind = np.bincount(_CLASS, weights=by_byte, minlength=9)
    n = len(words)
    _, counts = np.unique(words, return_counts=True)
    runs = gram_hashes(words, 3)
    lines = [x for x in raw.split(b"\n") if x]
    share = lambda a, b: float(a) / b if b else 0.0
    return [
        np.log1p(n), np.log1p(size), np.log1p(share(size, n)), *(np.sqrt(kind[i] / size) for i in (1, 2, 3, 4, 5, 6, 8)),
        share(len(counts), n), share(len(np.unique(runs)), len(runs)), np.sqrt(share(counts.max() if n else 0, n)),
        np.log1p(len(lines)), share(len(set(lines)), len(lines)),
    ]


def _all_statistics(texts: pd.Series) -> list[list[float]]:
    with np.errstate(over="ignore"):
        h, at = word_hashes([None if t is None else t for t in texts], lower=False)
        return [text_statistics(t, h[at[i]:at[i + 1]]) for i, t in enumerate(texts)]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def statistics(texts: pd.Series) -> pd.Series:
    """Statistics of whole texts; a NULL text counts as empty."""
    return pd.Series(_all_statistics(texts))


def held_out(id_col: str = "doc_id") -> F.Column:
    """True where crc32 of the id as text leaves remainder 0 by 5; False for rows without an id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


@dataclass(frozen=True)
class Model:
    """A fitted classifier: everything in it has a size fixed by the parameters above."""

    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    grid: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.cos(np.clip((x - self.mean) / self.scale, -8, 8) @ self.waves + self.phase) * np.sqrt(2 / FEATURES)
        return np.hstack([z, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.grid, self.levels), 0.0, 1.0)


def pool_adjacent(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted isotonic regression: the closest non-decreasing sequence."""
    blocks: list[list[float]] = []  # mean, weight, length
    for v, w in zip(values, weights, strict=True):
        blocks.append([float(v), float(w), 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.empty(0)


def _blank(seed: int, mean: np.ndarray, scale: np.ndarray) -> Model:
    rng = np.random.default_rng(seed)
    waves = rng.normal(0, np.sqrt(2 * BANDWIDTH), (len(STATISTICS), FEATURES))
    return Model(mean, scale, waves, rng.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1),
                 np.array([-0.5, 1.5]), np.array([0.5, 0.5]))


def fit(labelled: DataFrame, seed: int = 11) -> Model:
    """Fit on all rows of ``labelled`` (stats array<double>, label 0/1, fold int), which is read three times: pass a written table.

    Rows whose label is not 0 or 1 are ignored, repeated rows count each, other columns are
    ignored.  Without any usable row every score is 0.5.
    """
    rows = labelled.where("label in (0, 1) and stats is not null").select("stats", F.col("label").cast("double"), "fold")
    k = len(STATISTICS)
    sums = rows.agg(F.count("*").alias("n"), *[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(k)],
                    *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(k)]).first()
    if not sums["n"]:
        return _blank(seed, np.zeros(k), np.ones(k))
    mean = np.array([sums[f"m{i}"] for i in range(k)])
    model = _blank(seed, mean, np.maximum(np.array([sums[f"s{i}"] for i in range(k)]), 1e-6))
    size = FEATURES + 1

    def equations(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left, right = np.zeros((size, size)), np.zeros(size)
        for pdf in batches:
            if len(pdf):
                z = model.features(np.array(pdf["stats"].tolist()))
                left += z.T @ z
                right += z.T @ pdf["label"].to_numpy()
        yield pd.DataFrame({"part": [np.concatenate([left[np.triu_indices(size)], right])]})

    cells = (rows.where(f"fold % {FOLDS} != 0").select("stats", "label").mapInPandas(equations, "part array<double>")
             .select(F.posexplode("part").alias("cell", "v")).groupBy("cell").agg(F.sum("v").alias("v")).collect())
    flat = np.zeros(size * (size + 1) // 2 + size)
    for c in cells:
        flat[c["cell"]] = c["v"]
    left = np.zeros((size, size))
    left[np.triu_indices(size)] = flat[:-size]
    left = left + np.triu(left, 1).T
    model = Model(model.mean, model.scale, model.waves, model.phase,
                  np.linalg.solve(left + RIDGE * np.eye(size), flat[-size:]), model.grid, model.levels)

    def cell_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            raw = model.raw(np.array(pdf["stats"].tolist()).reshape(len(pdf), k))
            cell = np.clip(((raw + 0.5) / 2 * GRID).astype(np.int64), 0, GRID - 1)
            yield pd.DataFrame({"cell": cell, "label": pdf["label"]})

    grid = (rows.where(f"fold % {FOLDS} = 0").select("stats", "label").mapInPandas(cell_of, "cell long, label double")
            .groupBy("cell").agg(F.count("*").alias("n"), F.sum("label").alias("ones")).orderBy("cell").collect())
    if not grid:  # too few rows to calibrate on: the clipped ridge score
        return Model(model.mean, model.scale, model.waves, model.phase, model.weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    at = np.array([(g["cell"] + 0.5) / GRID * 2 - 0.5 for g in grid])
    n = np.array([g["n"] for g in grid], dtype=float)
    levels = pool_adjacent(np.array([g["ones"] for g in grid]) / n, n)
    return Model(model.mean, model.scale, model.waves, model.phase, model.weights, at, levels)


def training_rows(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """Labelled rows outside the held-out fifth: stats, label, fold.

    Labels that name a document twice count each distinct value once.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")).where("doc_id is not null").distinct()
    rows = stats.select(F.col(id_col).alias("doc_id"), "stats").join(known, "doc_id").where(~held_out())
    return rows.select("stats", "label", F.expr("crc32(cast(doc_id as string)) div 5").alias("fold"))


def scorer(model: Model):
    """The fitted model as a column function of the statistics; equal rows score alike."""
    @F.pandas_udf("double")
    def score(stats: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array(stats.tolist()).reshape(len(stats), len(STATISTICS))))
    return score


def text_scorer(model: Model):
    """The fitted model as a column function of whole texts: statistics and score in one call."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array(_all_statistics(texts)).reshape(len(texts), len(STATISTICS))))
    return score.asNondeterministic()      # evaluated once a row, wherever its result is used

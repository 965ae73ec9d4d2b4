"""Quality classifier: random Fourier features, ridge by normal equations, isotonic calibration.

A document is described by statistics of its whole text, computed in column
functions. Standardised, they go through random Fourier features, whose products
approximate a Gaussian kernel. Each partition of the labelled rows sums its share of
the normal equations, (D + 1) squared numbers whatever its rows; the shares are added
by matrix row in Spark, in two levels. One fold is kept back to fit the isotonic curve from raw to
calibrated scores on a histogram of at most BINS bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from neumata.llm.quality_rules import MEASURES, repeated_words
from neumata.llm.shared import Scratch, let, words_of

FEATURES_D, RIDGE, BINS, SEED = 256, 1e-3, 2048, 11
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 4
#: Groups of partitions whose sums are added before those of the groups are.
GROUPS = 256
#: Share of the raw score in the calibrated one; it orders documents on a level of the isotonic curve.
ORDERING = 0.01
CUT = 0.3


def statistics(text: Column) -> Column:
    """array<double> of the text's statistics; a null text is described as an empty one."""
    text = F.coalesce(text, F.lit(""))

    def of(words: Column) -> Column:
        n = F.greatest(F.size(words), F.lit(1)).cast("double")
        chars = F.greatest(F.length(text), F.lit(1)).cast("double")
        m = lambda name: MEASURES[name](text, words).cast("double")
        count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
        runs = F.size(F.filter(words, lambda w, i: (i > 0) & (F.get(words, F.greatest(i - 1, F.lit(0))) == w))).cast("double")
        lines = F.greatest(m("n_lines"), F.lit(1.0))
        return F.array(
            F.log1p(F.size(words).cast("double")),
            m("word_chars") / n,
            F.log1p(10 * m("n_symbols") / n),
            F.log1p(10 * m("n_marks") / n),
            m("n_dup_lines") / lines,
            F.log1p(n / lines),
            repeated_words(words).cast("double") / n,
            F.size(F.array_distinct(words)).cast("double") / n,
            runs / n,
            count(r"\p{Lu}") / chars,
            count(r"\d") / chars,
            count(r"[.,;:]") / n,
            count(r"[^\x00-\x7F]") / chars,
            F.log1p(count(r"[^\p{L}\p{N}\x20\x09-\x0D.,;:!?#*$%&|<>]") / n),
        )

    return let(words_of(text), of)


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


@dataclass(frozen=True)
class Model:
    """mean, std: of the statistics; weights, phase: of the features; ridge: coefficients, intercept last; curve: raw and calibrated."""

    mean: np.ndarray
    std: np.ndarray
    weights: np.ndarray
    phase: np.ndarray
    ridge: np.ndarray
    curve: tuple[np.ndarray, np.ndarray]

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.std, -6, 6)
        f = np.sqrt(2 / self.weights.shape[1]) * np.cos(z @ self.weights + self.phase)
        return np.hstack([f, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.features(x) @ self.ridge, 0, 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        return np.clip((1 - ORDERING) * np.interp(raw, *self.curve) + ORDERING * raw, 0, 1)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing curve of least weighted squares through y over rising x, pooling adjacent violators."""
    pools: list[list[float]] = []  # weight, mean, first x, last x
    for xi, yi, wi in zip(x, y, weight, strict=True):
        pools.append([wi, yi, xi, xi])
        while len(pools) > 1 and pools[-2][1] >= pools[-1][1]:
            w, m, _, last = pools.pop()
            v = pools[-1]
            pools[-1] = [v[0] + w, (v[0] * v[1] + w * m) / (v[0] + w), v[2], last]
    xs = np.array([e for p in pools for e in (p[2], p[3])])
    ys = np.array([p[1] for p in pools for _ in range(2)])
    return xs, ys


def fit(labelled: DataFrame) -> Model:
    """A model from rows (x: array<double>, y: double in 0 to 1, fold: int). Without rows all scores are about a half."""
    first = labelled.first()
    d = len(first["x"]) if first else 1
    moments = labelled.agg(*(f(F.col("x")[k]) for k in range(d) for f in (F.avg, F.stddev_pop))).first() if first else [0.0, 1.0]
    mean, std = np.array(moments[0::2], float), np.maximum(np.array(moments[1::2], float), 1e-6)
    rng = np.random.default_rng(SEED)
    weights = rng.standard_normal((d, FEATURES_D)) / np.sqrt(d)
    model = Model(mean, std, weights, rng.uniform(0, 2 * np.pi, FEATURES_D), np.zeros(FEATURES_D + 1), (np.zeros(1), np.full(1, 0.5)))
    if not first:
        return model

    def share(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((FEATURES_D + 1, FEATURES_D + 2))
        for pdf in batches:
            if len(pdf):
                z = model.features(np.stack(pdf["x"].to_numpy()))
                total += z.T @ np.column_stack([z, pdf["y"].to_numpy()])
        yield pd.DataFrame({"row": np.arange(len(total)), "some": TaskContext.get().partitionId() % GROUPS, "sums": list(total)})

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"row": pdf["row"].iloc[:1], "some": pdf["some"].iloc[:1], "sums": [np.stack(pdf["sums"].to_numpy()).sum(0)]})

    some = labelled.where(F.col("fold") != CALIBRATION)
    kinds = "row int, some int, sums array<double>"
    shares = some.select("x", "y").mapInPandas(share, kinds).groupBy("row", "some").applyInPandas(added, kinds)  # GROUPS rows a matrix row
    sums = shares.groupBy("row").applyInPandas(added, kinds).collect()  # FEATURES_D + 1 rows
    total = np.stack([r["sums"] for r in sorted(sums, key=lambda r: r["row"])])
    gram, target = total[:, :-1], total[:, -1]
    n = max(gram[-1, -1], 1.0)
    ridge = np.linalg.solve(gram + RIDGE * n * np.diag([*np.ones(FEATURES_D), 1e-9]) + 1e-9 * np.eye(len(gram)), target)
    model = Model(model.mean, model.std, model.weights, model.phase, ridge, model.curve)

    @F.pandas_udf("double")
    def raw(x: pd.Series) -> pd.Series:
        return pd.Series(model.raw(np.stack(x.to_numpy())) if len(x) else [], dtype=float)

    calibrate = labelled.where(F.col("fold") == CALIBRATION)
    scored = calibrate.select(F.round(raw("x") * BINS).alias("bin"), "y")
    bins = scored.groupBy("bin").agg(F.avg("y").alias("y"), F.count("*").alias("n")).orderBy("bin").collect()
    if not bins:
        return Model(model.mean, model.std, model.weights, model.phase, ridge, (np.array([0.0, 1.0]), np.array([0.0, 1.0])))
    curve = isotonic(*(np.array([r[c] for r in bins], float) / (BINS if c == "bin" else 1) for c in ("bin", "y", "n")))
    return Model(model.mean, model.std, model.weights, model.phase, ridge, curve)


def scored(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """Per row: doc_id, held_out, score and predicted.

    Labels (doc_id, 0 or 1) are learnt only where the fold of doc_id is not HELD_OUT;
    null labels are ignored, and a document with several gets their mean. Scores
    depend on the text alone, of whatever length. Empty and null texts are scored like
    any other; repeated rows repeat and, if labelled, count as often; an empty table
    gives an empty result; other columns are ignored.
    """
    scratch = Scratch(spark, "classifier")
    described = docs.select("doc_id", fold_of(F.col("doc_id")).cast("int").alias("fold"), statistics(F.col("text")).alias("x"))
    described = scratch.keep(described, "statistics")
    given = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.avg(label).alias("y"))
    labelled = scratch.keep(described.where(F.col("fold") != HELD_OUT).join(given, "doc_id").select("x", "y", "fold"), "labelled")
    model = fit(labelled)

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(x.to_numpy())) if len(x) else [], dtype=float)

    out = described.select("doc_id", (F.col("fold") == HELD_OUT).alias("held_out"), score("x").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))

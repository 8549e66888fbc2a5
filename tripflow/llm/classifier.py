"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, checkpointed, held_out, learnable, table
from .statistics import COUNTS, ratios, with_counts

# The model learns from at most so many labelled rows, those with the lowest hashes.
FIT_ROWS = 100_000
FEATURES = 256
RIDGE = 1.0
# Width of the Gaussian kernel over standardised statistics, per square root of their number.
WIDTH = 0.7
CUT = 0.3


@dataclass
class Scorer:
    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray

    def features(self, counts: pd.DataFrame) -> np.ndarray:
        """Random cosines whose inner products approximate a Gaussian kernel, and a constant."""
        x = (ratios(counts) - self.mean) / self.spread
        z = np.sqrt(2.0 / len(self.phases)) * np.cos(np.clip(x, -8.0, 8.0) @ self.directions + self.phases)
        return np.column_stack([z, np.ones(len(z))])

    def raw(self, counts: pd.DataFrame) -> np.ndarray:
        return self.features(counts) @ self.weights


def with_raw(counts: DataFrame, scorer: Scorer) -> DataFrame:
    @F.arrow_udf("double")
    def raw(*columns: pa.Array) -> pa.Array:
        frame = pd.DataFrame({n: c.to_numpy(zero_copy_only=False) for n, c in zip(COUNTS, columns)})
        return pa.array(scorer.raw(frame))

    return counts.withColumn("raw", raw(*[F.col(c) for c in COUNTS]))


def fit_ridge(rows: DataFrame, seed: int = 5) -> Scorer:
    """Solve the normal equations of ``rows`` (the counts and ``quality``), summed over partitions by Spark."""
    width = ratios(pd.DataFrame({c: [0] for c in COUNTS})).shape[1]
    rng = np.random.default_rng(seed)
    plain = Scorer(
        np.zeros(width),
        np.ones(width),
        rng.normal(size=(width, FEATURES)) / (WIDTH * np.sqrt(width)),
        rng.uniform(0.0, 2.0 * np.pi, FEATURES),
        np.zeros(FEATURES + 1),
    )

    def summed(blocks) -> dict[tuple[int, int], float]:
        """Sums of the matrices that ``blocks`` makes of each partition's rows, entry by entry."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0.0
            for batch in batches:
                if batch.num_rows:
                    total = total + blocks(batch.to_pandas())
            if not np.isscalar(total):
                i, j = np.indices(total.shape)
                yield pa.record_batch([i.ravel(), j.ravel(), total.ravel()], ["i", "j", "v"])

        parts = rows.mapInArrow(run, "i long, j long, v double")
        return {(r["i"], r["j"]): r["v"] for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}

    def moments(frame: pd.DataFrame) -> np.ndarray:
        r = ratios(frame)
        return np.stack([np.full(width, len(r)), r.sum(axis=0), (r * r).sum(axis=0)])

    def equations(frame: pd.DataFrame) -> np.ndarray:
        z = plain.features(frame)
        return np.column_stack([z.T @ z, z.T @ frame["quality"].to_numpy(np.float64)])

    found = summed(moments)
    if not found:
        return plain
    n, first, second = (np.array([found[i, j] for j in range(width)]) for i in range(3))
    plain.mean = first / n
    plain.spread = np.sqrt(np.maximum(second / n - plain.mean**2, 1e-12))
    system = np.zeros((FEATURES + 1, FEATURES + 2))
    for (i, j), v in summed(equations).items():
        system[i, j] = v
    gram = system[:, :-1] + RIDGE * np.diag([1.0] * FEATURES + [0.0])
    plain.weights = np.linalg.lstsq(gram, system[:, -1], rcond=None)[0]
    return plain


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``score`` (0 to 1) and ``predicted`` (1 from ``CUT`` on).

    Only statistics of the text enter a score. Labels are learned from rows outside the held-out fifth: three
    quarters of them fit the ridge, the others calibrate it. Rows without a label of 0 or 1 are ignored;
    without labelled rows every score is 0.5. Null and empty texts have zero counts and are scored as such.
    """
    counts = checkpointed(with_counts(docs.select("doc_id", "text")).drop("text"))
    known = labels.where(learnable(F.col("doc_id")) & F.col("quality").isin(0, 1)).select("doc_id", "quality")
    labelled = checkpointed(counts.join(known, "doc_id"))
    sample = checkpointed(bounded_sample(labelled, ["doc_id"], FIT_ROWS).repartition(8, "doc_id"))
    for_calibration = F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(4)) == 0
    scorer = fit_ridge(sample.where(~for_calibration))
    scored = with_raw(counts, scorer)
    pairs = checkpointed(with_raw(sample.where(for_calibration), scorer).select("raw", F.col("quality").cast("double").alias("label")))
    if pairs.isEmpty():
        calibrated = F.lit(0.5)
    else:
        steps = IsotonicRegression(featuresCol="raw", labelCol="label").fit(pairs)
        at, value = np.array(steps.boundaries.toArray()), np.array(steps.predictions.toArray())

        @F.arrow_udf("double")
        def calibrate(raw: pa.Array) -> pa.Array:
            return pa.array(np.clip(np.interp(raw.to_numpy(zero_copy_only=False), at, value), 0.0, 1.0))

        calibrated = calibrate("raw")
    return scored.select("doc_id", calibrated.alias("score")).withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def op2_quality(spark, sf_dir):
    """The quality score of every document, learned from the four fifths that are not held out."""
    found = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")

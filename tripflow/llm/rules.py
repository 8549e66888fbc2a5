"""Quality rules: an isolation forest over rule statistics, its threshold calibrated on labelled rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, learnable, table, unit_interval
from .statistics import COUNTS, with_counts

TREES = 100
SUBSAMPLE = 256
# How many times worse it is to lose a share of good documents than to keep the same share of bad ones.
LOSS_WEIGHT = 5.0
BINS = 1000


# Every rate is taken as if so many ordinary words and lines were added, which steadies short texts.
ORDINARY_WORDS, ORDINARY_LINES = 20, 4


def rates(counts: pd.DataFrame) -> np.ndarray:
    """The rule statistics of each text as rates that length alone doesn't move."""
    c = {name: counts[name].to_numpy(np.float64) for name in COUNTS}
    words, chars = c["n_words"] + ORDINARY_WORDS, c["word_chars"] + 5 * ORDINARY_WORDS
    return np.column_stack(
        [
            chars / words,
            c["n_symbols"] / words,
            c["n_dup_lines"] / (c["n_lines"] + ORDINARY_LINES),
            c["n_repeat_words"] / words,
            np.log1p(c["n_distinct_words"]) / np.log1p(np.maximum(c["n_words"], 1)),
            c["n_upper"] / chars,
            (c["n_marks"] + ORDINARY_WORDS / 5) / words,
        ]
    )


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search in a binary tree of ``n`` rows."""
    n = np.asarray(n, np.float64)
    several = 2.0 * (np.log(np.maximum(n - 1.0, 1.0)) + np.euler_gamma) - 2.0 * (n - 1.0) / np.maximum(n, 1.0)
    return np.where(n > 2, several, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays: at a leaf both children are the leaf itself, and ``length`` is its path length."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    depth: int
    scale: float

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1; rows that random splits set apart early are near 1."""
        if not self.trees:
            return np.zeros(len(x))
        rows, total = np.arange(len(x)), np.zeros(len(x))
        for feature, split, left, right, length in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = np.where(x[rows, feature[node]] < split[node], left[node], right[node])
            total += length[node]
        return 2.0 ** (-total / len(self.trees) / self.scale)


def grow(x: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 11) -> Forest:
    """A forest whose trees draw their rows from ``x``."""
    rng = np.random.default_rng(seed)
    size = min(subsample, len(x))
    return grow_from([x[rng.choice(len(x), size, replace=False)] for _ in range(trees if len(x) else 0)], seed)


def grow_from(samples: list[np.ndarray], seed: int = 11) -> Forest:
    """A forest with one tree for each of the samples."""
    rng = np.random.default_rng(seed)
    size = max(map(len, samples), default=0)
    depth = max(1, int(np.ceil(np.log2(max(size, 2)))))

    def tree(rows: np.ndarray):
        nodes: list[list[float]] = []

        def add(part: np.ndarray, level: int) -> int:
            at = len(nodes)
            nodes.append([0, 0.0, at, at, level + float(average_path(len(part)))])
            low, high = (part.min(axis=0), part.max(axis=0)) if len(part) else (np.zeros(1), np.zeros(1))
            varied = np.flatnonzero(high > low)
            if level < depth and len(varied):
                feature = int(rng.choice(varied))
                split = float(rng.uniform(low[feature], high[feature]))
                below = part[:, feature] < split
                nodes[at][:2] = feature, split
                nodes[at][2] = add(part[below], level + 1)
                nodes[at][3] = add(part[~below], level + 1)
            return at

        add(rows, 0)
        columns = list(zip(*nodes))
        return (*(np.array(columns[i], np.float64 if i in (1, 4) else np.int64) for i in range(5)),)

    return Forest([tree(rows) for rows in samples], depth, max(1.0, float(average_path(size))))


def tree_rows(counts: DataFrame, trees: int = TREES, subsample: int = SUBSAMPLE) -> DataFrame:
    """``tree, rank`` and the counts of the rows that each tree is grown from: ``subsample`` of them, drawn by hash
    from the whole table.

    Each row belongs to one tree, or to as many as it takes for every tree to have enough rows to draw from. The
    rows of a tree are thinned by hash before they are ranked, so that no task sees more than a bounded number.
    """
    n = counts.count()
    shares = min(trees, -(-2 * trees * subsample // max(n, 1)))
    hashed, step = F.xxhash64("doc_id", *COUNTS), F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))
    dealt = (
        counts.select("doc_id", *COUNTS, hashed.alias("hash"), step.alias("step"))
        .withColumn("tree", F.pmod(F.pmod("hash", F.lit(trees)) + F.col("step"), F.lit(trees)).cast("int"))
        .withColumn("draw", F.xxhash64("hash", "tree"))
        .where(unit_interval(F.col("draw")) * (n * shares / trees) < 3.0 * subsample)
    )
    rank = F.row_number().over(Window.partitionBy("tree").orderBy("draw", "doc_id"))
    return dealt.withColumn("rank", rank).where(F.col("rank") <= subsample).select("tree", "rank", *COUNTS)


def score(counts: DataFrame, forest: Forest) -> DataFrame:
    """``counts`` with ``anomaly``; a column of that name is replaced."""
    counts = counts.drop("anomaly")
    schema = T.StructType([*counts.schema.fields, T.StructField("anomaly", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = rates(batch.select(list(COUNTS)).to_pandas())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forest.anomaly(x))], [*batch.schema.names, "anomaly"])

    return counts.mapInArrow(run, schema)


def calibrate(scored: DataFrame, labels: DataFrame) -> float:
    """The anomaly from which a document is rejected, chosen over all labelled rows outside the held-out fifth.

    Labelled rows are counted by score and label, at most ``2 * (BINS + 1)`` counts in all. Without labels
    of both kinds nothing is rejected.
    """
    known = labels.where(learnable(F.col("doc_id")) & F.col("quality").isin(0, 1)).select("doc_id", "quality")
    counted = (
        scored.select("doc_id", F.floor(F.col("anomaly") * BINS).cast("int").alias("bin"))
        .join(known, "doc_id")
        .groupBy("bin", "quality")
        .count()
        .collect()
    )
    counts = np.zeros((2, BINS + 1))
    for r in counted:
        counts[r["quality"], r["bin"]] += r["count"]
    bad, good = counts.sum(axis=1)
    if not (bad and good):
        return float("inf")
    # Share of bad and of good documents that would be rejected from each bin on.
    caught, lost = (c[::-1].cumsum()[::-1] / n for c, n in zip(counts, (bad, good)))
    gain = caught - LOSS_WEIGHT * lost
    return int(gain.argmax()) / BINS if gain.max() > 0 else float("inf")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, the counts, ``anomaly``, ``base_failed`` and ``kept``.

    A document fails the base rules with fewer than 50 words or more than half of them in repeated windows.
    The others are kept unless the forest finds them as anomalous as labelled junk. Null and empty texts
    fail the base rules. Repeated documents are rows of their own, and of repeated labels each counts in the
    calibration. Counts are stored once; the forest, the threshold and the verdicts read those.
    """
    counts = checkpointed(with_counts(docs.select("doc_id", "text")).drop("text"))
    # At most ``TREES * SUBSAMPLE`` rows of a few numbers.
    drawn = tree_rows(counts.where("n_words > 0")).toPandas().sort_values(["tree", "rank"])
    forest = grow_from([rates(rows) for _, rows in drawn.groupby("tree")])
    scored = checkpointed(score(counts, forest))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("anomaly") < calibrate(scored.where(~failed), labels))
    )


def op6_quality_rules(spark, sf_dir):
    """The base counts and both verdicts of every document."""
    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *base, "base_failed", "kept", "anomaly")

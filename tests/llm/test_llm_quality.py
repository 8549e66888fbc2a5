import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tripflow.llm import classifier, rules, statistics

WORD = r"[^\x20\x09-\x0D]+"
TEXTS = [
    None, "", "  ", "a", "a b c", "a b c a b c", "a a a a", "a b\na b\n\n \na b", "#*$ %& | <> é", "x y \x0bz\x1fq",
    "one two three " * 40, "Same line.\nSame line.\nsame line.\n", "word " * 300_000, "a b\r\na b\r\n",
]


def base_by_force(text):
    words = re.findall(WORD, text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    hit = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def tables(spark, tmp_path, rows, labels):
    spark.createDataFrame(rows, "doc_id long, text string, n_words string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    made = [rng.choice(["", " ", "\n"]).join(rng.choices(["a", "b", "c ", "#", "\n", " ", "é", "A"], k=rng.randrange(60))) for _ in range(300)]
    return TEXTS + made


def test_rule_counts_against_brute_force(spark, tmp_path, texts):
    folder = tables(spark, tmp_path, [(i, t, "x") for i, t in enumerate(texts)], [])
    found = {r["doc_id"]: r for r in rules.op6_quality_rules(spark, folder).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        want, r = base_by_force(text), found[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, repr(text)[:80]
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r["base_failed"] == failed
        assert r["kept"] == (not failed)  # no labels: the forest rejects nothing


def test_forest_finds_the_odd_one():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(size=(500, 3)), [[9.0, -9.0, 9.0]]])
    scores = rules.grow(x).anomaly(x)
    assert scores.argmax() == 500 and ((scores > 0) & (scores < 1)).all()
    same = rules.grow(np.ones((10, 3))).anomaly(np.ones((2, 3)))
    assert same[0] == same[1]
    assert (rules.grow(np.zeros((0, 3))).anomaly(np.ones((2, 3))) == 0).all()


def test_path_lengths_by_walking():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 2))
    forest = rules.grow(x, trees=5)

    def walk(tree, row):
        feature, split, left, right, length = tree
        node = 0
        while left[node] != node:
            node = left[node] if row[feature[node]] < split[node] else right[node]
        return length[node]

    want = [2 ** (-np.mean([walk(t, row) for t in forest.trees]) / forest.scale) for row in x]
    assert forest.anomaly(x) == pytest.approx(want)


def test_junk_goes_and_clean_documents_stay(spark):
    folder = "/root/testdata/sf0.1"
    found = rules.op6_quality_rules(spark, folder).where("not base_failed").select("doc_id", "kept")
    labelled = found.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("crc32(cast(doc_id as string)) % 5 = 0")
    shares = {r["quality"]: r["share"] for r in labelled.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert shares[1] > 0.97 and shares[0] < 0.2


def test_features_approximate_the_kernel():
    width = rules.rates(pd.DataFrame({c: [0] for c in statistics.COUNTS})).shape[1] + 2
    rng = np.random.default_rng(5)
    n = 4000
    directions, phases = rng.normal(size=(width, n)) / 2.0, rng.uniform(0, 2 * np.pi, n)
    a, b = rng.normal(size=width), rng.normal(size=width)
    z = [np.sqrt(2 / n) * np.cos(v @ directions + phases) for v in (a, b)]
    assert z[0] @ z[1] == pytest.approx(np.exp(-((a - b) ** 2).sum() / 8), abs=0.06)


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    found = classifier.op2_quality(spark, folder)
    rows = found.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.95
    assert found.count() == 1000


def test_classifier_on_edge_cases(spark, tmp_path, texts):
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "a b", None), (0, None, "x")]
    labels = [(i, i % 2, 0) for i in range(100)] + [(None, 1, 0), (3, None, 0), (5, 1, 0), (5, 1, 0)]
    found = classifier.op2_quality(spark, tables(spark, tmp_path, rows, labels)).collect()
    assert len(found) == len(rows)
    assert all(0.0 <= r["score"] <= 1.0 and r["predicted"] == int(r["score"] >= 0.3) for r in found)


def test_classifier_without_labels_or_documents(spark, tmp_path):
    folder = tables(spark, tmp_path / "a", [(1, "x", None)], [])
    assert [(r["score"], r["predicted"]) for r in classifier.op2_quality(spark, folder).collect()] == [(0.5, 1)]
    folder = tables(spark, tmp_path / "b", [], [])
    assert classifier.op2_quality(spark, folder).count() == 0 and rules.op6_quality_rules(spark, folder).count() == 0


@pytest.mark.parametrize("n, each", [(30, 30), (3_000, 256), (40_000, 256)])
def test_every_tree_draws_its_rows_from_the_whole_table(spark, n, each):
    counts = spark.range(n).select(F.col("id").alias("doc_id"), *[F.col("id").alias(c) for c in rules.COUNTS])
    drawn = rules.tree_rows(counts).toPandas()
    assert (drawn.groupby("tree").size() == each).all() and drawn["tree"].nunique() == rules.TREES
    column = rules.COUNTS[0]
    assert not drawn.duplicated(["tree", column]).any()
    if n > 30_000:  # far more rows than trees need: they share few, and all of the table is in reach
        assert drawn[column].nunique() > 0.5 * len(drawn) and drawn[column].max() > 0.99 * n and drawn[column].min() < 0.01 * n
    assert rules.tree_rows(counts.limit(0)).count() == 0

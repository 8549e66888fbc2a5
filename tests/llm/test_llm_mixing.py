import random
from collections import Counter

import pytest
from pyspark.sql import types as T

from tripflow.llm import mixing

DOC = "doc_id long, text string, source string"


def docs_of(spark, rows):
    return spark.createDataFrame(rows, DOC)


def expected_targets(sizes, weights=(1, 2, 3), cap=3):
    """Targets by raising one level in small steps of exact reshares."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, open_, target = sum(sizes.values()), set(names), {}
    while open_:
        rest = total - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > cap * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = cap * sizes[s]
        open_ -= over
    return target


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for i in range(3000):
        source = rng.choices(["b", "a", "é", None, "tiny", ""], [30, 50, 10, 10, 1, 5])[0]
        out.append((i, " ".join(["w"] * int(rng.lognormvariate(3, 1))), source))
    return out + [(5000, None, "a"), (5001, "", "b"), (None, "x y z", "b"), (None, None, None)]


def test_targets_and_taken(spark, rows):
    plan = mixing.mix_plan(docs_of(spark, rows)).toPandas()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    targets = expected_targets(sizes)
    for source, part in plan.groupby(plan["source"].fillna("<null>")):
        name = None if source == "<null>" else source
        assert part["target"].iloc[0] == pytest.approx(targets[name])
        assert part["source_size"].iloc[0] == sizes[name]
        taken = (part["size"] * part["copies"] * part["rows"]).sum()
        assert abs(taken - targets[name]) <= part["size"].max()
    assert plan["copies"].between(0, 3).all()
    assert plan["rows"].sum() == len(rows)


def test_reruns_agree_whatever_the_layout(spark, rows):
    def result(df):
        return sorted(map(str, mixing.mix_plan(df).drop("rows").collect()))

    docs = docs_of(spark, rows)
    assert result(docs) == result(docs.repartition(7).orderBy("text"))


def test_copies_average_to_the_share(spark):
    docs = docs_of(spark, [(i, "a b c d", "s") for i in range(400)] + [(1000 + i, "a b c d", "t") for i in range(400)])
    totals = Counter()
    for seed in range(3):
        for r in mixing.mix_plan(docs, weights=(1, 3), seed=seed).collect():
            totals[r["source"]] += r["copies"]
    assert totals == {"s": 3 * 200, "t": 3 * 600}


def test_mix_repeats_rows_and_keeps_other_columns(spark):
    rows = [(i, f"one two {i}", "s" if i % 3 else None, i * 2, "x") for i in range(120)]
    rows += [rows[0]] * 50 + [(None, None, "s", None, None), (None, "", None, 1, "y")]
    docs = spark.createDataFrame(rows, DOC + ", copies long, text_hash string")
    mixed = mixing.mix(docs, max_repeat=3)
    assert mixed.columns == docs.columns
    plan = mixing.mix_plan(docs.select("doc_id", "text", "source")).collect()
    plan = {(r["doc_id"], r["source"], r["size"]): r["copies"] * r["rows"] + r["more"] for r in plan}
    counted = Counter((r["doc_id"], r["source"], len((r["text"] or "").split())) for r in mixed.collect())
    originals = Counter((r[0], r[2], len((r[1] or "").split())) for r in rows)
    assert counted == Counter({k: n for k, n in plan.items() if n}) and set(plan) == set(originals)


def test_empty_and_wordless_tables(spark):
    empty = docs_of(spark, [])
    assert mixing.mix(empty).count() == 0
    wordless = docs_of(spark, [(1, None, "a"), (2, "  ", None)])
    assert {(r["doc_id"], r["target"], r["copies"]) for r in mixing.mix_plan(wordless).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}


def test_query_has_one_row_per_document(spark, tmp_path):
    docs_of(spark, [(1, "a b", "s"), (1, "a b", "s"), (2, None, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    found = mixing.op1_mixing(spark, str(tmp_path))
    assert found.count() == 3
    types = {f.name: f.dataType for f in found.schema}
    assert types["size"] == types["taken"] == types["source_size"] == T.LongType() and types["target"] == T.DoubleType()


def test_main_path_is_native(spark, tmp_path):
    docs_of(spark, [(1, "a b", "s")]).write.parquet(f"{tmp_path}/documents.parquet")
    plan = mixing.op1_mixing(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_equal_rows_land_on_the_target(spark, tmp_path):
    text = " ".join(["w"] * 10)
    rows = [(7, text, "a")] * 1000 + [(100 + i, text, "b") for i in range(1000)] + [(8, None, "a")] * 5
    docs_of(spark, rows).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    found = mixing.op1_mixing(spark, str(tmp_path)).toPandas()
    assert len(found) == len(rows)
    for first, target in ((found.doc_id < 100, 20_000 / 3), (found.doc_id >= 100, 40_000 / 3)):
        assert found[first].target.iloc[0] == pytest.approx(target)
        assert abs(found[first].taken.sum() - target) <= 10
    assert set(found[found.doc_id == 7].taken) == {0, 10}
    mixed = Counter(r["source"] for r in mixing.mix(docs_of(spark, rows)).where("text is not null").collect())
    assert abs(mixed["a"] - 2000 / 3) <= 1 and abs(mixed["b"] - 4000 / 3) <= 1

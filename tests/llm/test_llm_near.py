import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tripflow.llm import near
from tripflow.llm.components import components

SCHEMA = "doc_id long, text string, labels string"


def shingles(text):
    words = (text or "").replace("\x0b", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def by_force(rows, threshold=0.8):
    """(links by row, class by row) over all pairs."""
    sets = [shingles(t) for _, t in rows]
    links, parent = Counter(), list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    least = {}
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            least[i] = min(ids, default=None)
    return links, least


def corpus(seed=5):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for group in range(40):
        base = rng.choices(words, k=rng.randrange(1, 120))
        for _ in range(rng.choice([1, 1, 2, 5])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy))
    rows += ["same text of a few words here"] * 30 + [None, "", "  ", "a b", "a  b", "a b c"]
    return [(i, t) for i, t in enumerate(rows)]


def test_links_and_classes_against_all_pairs(spark):
    rows = corpus()
    rows += [rows[3], rows[3], (None, "only here and without any id at all")]
    found = near.near_duplicates(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).collect()
    links, least = by_force(rows)
    got = Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in found)
    assert got == Counter((rows[i][0], least[i], links[i]) for i in range(len(rows)))


def test_large_group_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_SHINGLES", 300)
    rng = random.Random(1)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(80):
        copy = list(base)
        copy[rng.randrange(60)] = f"x{i % 20}"
        rows.append((i, " ".join(copy)))
    found = near.near_duplicates(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).collect()
    links, least = by_force(rows)
    assert {(r["doc_id"], r["class_id"], r["n_links"]) for r in found} == {(i, least[i], links[i]) for i in range(80)}


def test_one_of_each_class_stays(spark):
    rows = corpus(6)
    rows += [rows[0]] * 3
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    kept = near.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    _, least = by_force(rows)
    want = sorted({least[i] for i in range(len(rows))})
    assert sorted(r["doc_id"] for r in kept.collect()) == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert near.near_duplicates(docs).count() == 0 and near.keep_one_of_each(docs).count() == 0


def test_recall_of_the_forest_at_the_threshold():
    depth = near.forest_depth(0.8, near.TREES, near.MAX_DEPTH, near.TARGET_RECALL)
    assert depth < near.MAX_DEPTH
    rng = np.random.default_rng(2)
    found = 0
    for _ in range(300):
        common, own = rng.integers(0, 2**63, 160).astype(np.uint64), rng.integers(0, 2**63, 40).astype(np.uint64)
        a, b = np.unique(np.concatenate([common, own[:20]])), np.unique(np.concatenate([common, own[20:]]))
        labels = near.forest_labels([a, b], near.TREES, depth)
        found += (labels[0] == labels[1]).any()
    assert found >= 297


def test_shingles_of_short_and_odd_texts():
    sets = near.shingle_sets(pa.array(["", " ", "a b", "a  b\n", "a b c d e", "a b c d e f", "b a"], pa.large_string()))
    assert [len(s) for s in sets] == [0, 0, 1, 1, 1, 2, 1]
    assert (sets[2] == sets[3]).all() and not (sets[2] == sets[6]).any()


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    edges += [(1000, i) for i in range(1001, 1200)] + [(7, 7)]
    parent = {n: n for e in edges for n in e}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {n: find(n) for e in edges if e[0] != e[1] for n in e}

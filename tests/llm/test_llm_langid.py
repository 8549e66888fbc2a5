import itertools
import math

import numpy as np
import pytest

from tripflow.llm import langid

PIECES = ["a", "ab", "b", "ba", "▁", "▁a", "▁ab", "c"]


def segmentations(word):
    if not word:
        yield []
    for i in range(1, len(word) + 1):
        if word[:i] in PIECES or i == 1:
            for rest in segmentations(word[i:]):
                yield [word[:i], *rest]


def chances():
    rng = np.random.default_rng(0)
    return np.vstack([rng.dirichlet(np.ones(len(PIECES)), 2).T, np.full(2, langid.UNKNOWN), np.zeros(2)])


def chance(piece, language, table):
    return table[PIECES.index(piece) if piece in PIECES else len(PIECES), language]


def test_forward_sums_all_segmentations():
    table, lattice = chances(), langid.Lattice(PIECES)
    for word in ("▁abab", "▁bac", "▁xab", "▁"):
        arcs = lattice.arcs([word], len(word))
        got = langid.forward(arcs, len(word), 1, table)[-1][0]
        for language in range(2):
            want = sum(math.prod(chance(p, language, table) for p in s) for s in segmentations(word))
            assert got[language] == pytest.approx(want)


def test_expected_counts_weigh_segmentations():
    table, lattice, word = chances(), langid.Lattice(PIECES), "▁abab"
    got = langid.expected_counts(lattice.arcs([word], 5), 5, np.array([[2.0, 3.0]]), table)
    for language, weight in ((0, 2.0), (1, 3.0)):
        all_ = [(s, math.prod(chance(p, language, table) for p in s)) for s in segmentations(word)]
        total = sum(c for _, c in all_)
        for piece in PIECES:
            want = weight * sum(c * s.count(piece) for s, c in all_) / total
            assert got[PIECES.index(piece), language] == pytest.approx(want)


def plain_log(word, language, table):
    """The forward pass in exact fractions, position by position."""
    from fractions import Fraction

    sums = [Fraction(1)] + [Fraction(0)] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - langid.LONGEST_PIECE), end):
            if word[start:end] in PIECES or end - start == 1:
                sums[end] += sums[start] * Fraction(float(chance(word[start:end], language, table)))
    top = sums[-1]
    return math.log(top.numerator) - math.log(top.denominator)


@pytest.mark.parametrize("length", [1, 15, 16, 17, 31, 32, 33, 47, 48, 49, 100, 517])
def test_long_runs_are_summed_across_parts(length):
    rng, table, lattice = np.random.default_rng(length), chances(), langid.Lattice(PIECES)
    words = ["".join(rng.choice(list("abcx"), length)), "ab" * length, "x" * length]
    got = langid.LanguageModel(["one", "two"], PIECES, table).word_scores(lattice, words)
    for word, logs in zip(words, got):
        for language in range(2):
            assert logs[language] == pytest.approx(plain_log("▁" + word, language, table), rel=1e-9)


def test_pieces_of_sixteen_letters_reach_over_parts(monkeypatch):
    monkeypatch.setitem(globals(), "PIECES", ["a", "b", "ab" * 8, "ba" * 8, "▁"])
    monkeypatch.setattr(langid, "PARTS_AT_ONCE", 3)
    table, lattice = chances(), langid.Lattice(PIECES)
    words = ["ab" * 30, "ba" * 45 + "b", "a" * 40]
    got = langid.LanguageModel(["one", "two"], PIECES, table).word_scores(lattice, words)
    for word, logs in zip(words, got):
        assert list(logs) == pytest.approx([plain_log("▁" + word, k, table) for k in range(2)], rel=1e-9)


def test_too_many_languages_are_refused(spark):
    docs = spark.range(200).selectExpr("id doc_id", "'some text' text", "concat('l', id % 40) lang")
    with pytest.raises(ValueError, match="more than 10 languages"):
        langid.training_rows(docs, 5, most_languages=10)
    assert langid.training_rows(docs, 1).count() == 40


def test_vocabulary_is_the_public_one():
    pieces = langid.read_vocabulary()
    assert len(pieces) > 20_000 and "▁the" in pieces and len(set(pieces)) == len(pieces)


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return langid.learn(docs, docs_per_language=30)


def test_edge_cases(spark, trained):
    texts = [None, "", " 12 !? ", "the of and that with", "x" * 300_000, "le la des que dans", "le la des que dans", "́"]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)], "doc_id long, text string, score double")
    found = [(r["lang_pred"], r["score"]) for r in langid.identify(docs, trained).orderBy("doc_id").collect()]
    assert [found[i] for i in (0, 1, 2, 7)] == [("und", 0.0)] * 4
    assert found[3][0] == "en" and found[5] == found[6] and found[5][0] == "fr"
    assert found[4][0] in trained.languages and all(0.0 <= s <= 1.0 for _, s in found)


def test_without_labels_nothing_is_recognised(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    model = langid.learn(docs)
    assert langid.identify(docs, model).first()["lang_pred"] == "und"
    assert langid.identify(docs.limit(0), langid.learn(docs.limit(0))).count() == 0


def test_held_out_accuracy(spark):
    found = langid.op7_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id"
    )
    rows = [r for r in found.collect() if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.97

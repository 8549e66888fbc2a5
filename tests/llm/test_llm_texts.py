"""Decontamination and substring deduplication."""

import random

import pytest
from pyspark.sql import functions as F

from tripflow.llm import decontaminate, repeats

DOCS = "doc_id long, text string, text_hash string"
ITEM = (
    "Anna buys 12 apples and 30 kg of flour for the bakery. Later Anna gives 12 apples to Peter, who bakes"
    " seven cakes with them before the market closes. How many apples does Anna have left?"
)


def leaks(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x") for i, t in enumerate(docs)], DOCS)
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r["changed"] for r in decontaminate.leaks(d, b).collect()}


def test_verbatim_and_reparameterised_questions(spark):
    changed = ITEM.replace("Anna", "Maria").replace("12", "47").replace("30 kg", "5 tons").replace("seven", "nine")
    inconsistent = changed.replace("gives 47", "gives 48").replace("Later Maria", "Later Nora")
    filler = "some words before it and"
    docs = [
        f"{filler} {ITEM} and more behind", f"{filler}\n{changed}", inconsistent, filler * 20, None, "", ITEM.upper(),
        "Anna buys 12 apples.", ITEM,
    ]
    found = leaks(spark, docs, [ITEM, "too short", None, ""])
    assert found[0, 0] is False and found[1, 0] is True and found[8, 0] is False
    assert (2, 0) not in found
    assert {d for d, _ in found} <= {0, 1, 6, 8}


def test_short_items_repeats_and_ties(spark):
    item = "What is the smallest prime"
    found = leaks(spark, [f"ask: {item}? yes", "what is the smallest", item, item], [item, item, "one two"])
    assert set(found) == {(d, i) for d in (0, 2, 3) for i in (0, 1)}


def test_windows_against_plain_search(spark):
    """Random passages: a document leaks an item exactly if half of the item's words lie in shared windows."""
    rng = random.Random(8)
    words = [f"word{i}x" for i in range(500)]
    items = [" ".join(rng.choices(words, k=rng.randrange(9, 60))) for _ in range(20)]
    docs = []
    for _ in range(150):
        text = rng.choices(words, k=rng.randrange(5, 200))
        if rng.random() < 0.6:
            item = rng.choice(items).split()
            a = rng.randrange(len(item))
            at = rng.randrange(len(text))
            text[at:at] = item[a : a + rng.randrange(4, 60)]
        docs.append(" ".join(text))
    want = set()
    for d, text in enumerate(docs):
        t = text.split()
        windows = {tuple(t[i : i + 8]) for i in range(len(t) - 7)}
        for i, item in enumerate(items):
            w = item.split()
            hit = {k + j for k in range(len(w) - 7) if tuple(w[k : k + 8]) in windows for j in range(8)}
            if 2 * len(hit) >= len(w):
                want.add((d, i))
    found = leaks(spark, docs, items)
    assert set(found) == want and not any(found.values())


def test_decontaminate_keeps_the_rest_with_all_columns(spark):
    rows = [(1, ITEM, "a"), (2, "clean text", None), (2, "clean text", None), (None, None, "b"), (None, ITEM, "c")]
    docs = spark.createDataFrame(rows, DOCS)
    items = spark.createDataFrame([(0, ITEM)], "item_id long, text string")
    kept = decontaminate.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted(map(str, (tuple(r) for r in kept.collect()))) == sorted(map(str, rows[1:4]))
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == 5
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0


def removed_by_force(rows):
    first, want = {}, set()
    ranked = sorted((r for r in rows if r[1]), key=lambda r: r[0])
    for doc, text in ranked:
        for digest, start, end in repeats.text_units(text):
            if digest in first:
                want.add((doc, start, end, first[digest]))
            else:
                first[digest] = doc
    return want


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(9)
    sentences = [" ".join(rng.choices(["red", "green", "blue", "One", "two", "é"], k=rng.randrange(3, 20))) for _ in range(60)]
    rows = []
    for i in range(200):
        chosen = [rng.choice(sentences) + rng.choice([".", "!", "", "?\n", "\n"]) for _ in range(rng.randrange(8))]
        rows.append((i, rng.choice([" ", "\n"]).join(chosen)))
    return rows + [(900, None), (901, ""), (902, "word " * 100_000)]


def test_removed_units_against_brute_force(spark, tmp_path, passages):
    spark.createDataFrame([(*r, "x") for r in passages], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    found = repeats.op9_substring_dedup(spark, str(tmp_path)).collect()
    assert {tuple(r) for r in found} == removed_by_force(passages) and len(found) == len(set(map(tuple, found)))


def test_case_and_punctuation_dont_matter_and_offsets_are_original(spark):
    a = "É start. The quick brown fox jumps over the lazy dog today! End"
    b = "Other\nthe QUICK, brown fox  jumps over the lazy dog today\nlast"
    docs = spark.createDataFrame([(2, b, "x"), (1, a, "y"), (3, "short line", "z"), (None, a, None)], "doc_id long, text string, removed string")
    found = {r["doc_id"]: r for r in repeats.remove_repeats(docs).collect()}
    assert found[1]["text"] == a and found[1]["removed"] is None
    span = found[2]["removed"][0]
    assert b[span["start"] : span["end"]].startswith("the QUICK") and found[2]["text"] == "Other\n\nlast"
    assert found[None]["text"].startswith("É start.") and "quick" not in found[None]["text"]


def test_hot_line_and_empty_table(spark):
    line = "this very line is shared by all of the documents"
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat_ws("\n", F.col("id").cast("string"), F.lit(line)).alias("text"))
    found = repeats.repeated_units(docs)
    assert found.count() == 2999 and found.where("first_rank <> 0").count() == 0
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_pasted_passages_against_a_search_for_them(spark):
    """Whole passages are found wherever in a line they are pasted; the search knows sentences, not units."""
    rng = random.Random(10)

    def sentence(n):
        return " ".join(f"w{rng.randrange(10**9)}" for _ in range(n)) + "."

    rows, want = [], {}
    lengths = [[6] * 12, [4, 10] * 5, [10, 4] * 5, [3, 5, 9, 1, 1, 20, 2], *([rng.randrange(1, 12) for _ in range(9)] + [8] for _ in range(20))]
    for k, lens in enumerate(lengths):
        passage = " ".join(map(sentence, lens))
        rows.append((2 * k, f"{passage} {sentence(3)}", "x"))
        front = " ".join(sentence(n) for n in rng.choice([[5], [2, 2], [9], [5, 1]]))
        rows.append((2 * k + 1, f"{front} {passage} {sentence(4)}", "x"))
        want[2 * k + 1] = set(range(len(front) + 1, len(front) + 1 + len(passage)))
    docs = spark.createDataFrame(rows, DOCS)
    texts = {r[0]: r[1] for r in rows}
    got = {}
    for r in repeats.repeated_units(docs).collect():
        got.setdefault(r["doc_id"], set()).update(range(r["start"], r["end"]))
    assert {d: {i for i in s if texts[d][i] != " "} for d, s in got.items()} == {
        d: {i for i in s if texts[d][i] != " "} for d, s in want.items()
    }


def test_overlapping_repeats_of_one_text_leave_the_first(spark):
    text = "No no no. " * 4 + "\n" + "No no no. " * 3
    docs = spark.createDataFrame([(1, text, "x"), (2, "So it is. " + "No no no. " * 4, "x")], DOCS)
    found = {r["doc_id"]: r["text"].split() for r in repeats.remove_repeats(docs).collect()}
    assert found == {1: ("No no no. " * 4).split(), 2: "So it is.".split()}


def test_lines_of_any_length_and_runs_of_neighbours(spark):
    unlike = lambda i, n: " ".join(f"u{i}x{j}" for j in range(n))
    footer, lines = "Call us on weekdays, thank you", ["one two three four five", "six seven eight nine ten", "a b c d e f"]
    stock = "this stock sentence of ten words stands in many texts."
    passage = ". ".join(unlike("p", 9).replace("x", f"y{k}x") for k in range(4)) + "."
    rows = [(i, f"{unlike(i, 5)}\n{footer}", "x") for i in range(200)]
    rows += [(300 + i, "\n\n".join([unlike(300 + i, 5), "\n".join(lines)]), "x") for i in range(20)]
    rows += [(400 + i, f"{unlike(400 + i, 5)}. {stock} {unlike(500 + i, 4)}", "x") for i in range(10)]
    rows += [(600, f"{unlike(600, 4)}. {passage} {unlike(601, 9)}", "x"), (601, f"{passage} {stock}\n", "x"), (601, f"{passage} {stock}\n", "y")]
    rows += [(None, None, "x"), (None, footer, "x"), (700, "", "x"), (701, "Again!\nagain", "x"), (702, "word " * 100_000, "x")]
    docs = spark.createDataFrame(rows, DOCS)
    texts = {r[0]: r[1] for r in rows}
    found = {}
    for r in repeats.repeated_runs(docs).collect():
        found.setdefault(r["doc_id"], []).append((texts[r["doc_id"]][r["start"] : r["end"]], r["n_words"], r["first_doc_id"]))
    assert all(found[i] == [(footer, 6, 0)] for i in range(1, 200)) and 0 not in found and found[None][0][1:] == (6, 0)
    assert all(found[300 + i] == [("\n".join(lines), 16, 300)] for i in range(1, 20)) and 300 not in found
    assert not any(400 + i in found for i in range(10))  # a stock sentence within lines is left alone
    assert found[601] == [(f"{passage} {stock}", 46, 400)] and 600 not in found
    assert found[701] == [("again", 1, 701)] and 700 not in found and 702 not in found
    plain = {r["doc_id"] for r in repeats.repeated_runs(docs, lines=False).collect()}
    assert plain == {601}
    assert repeats.repeated_runs(docs.limit(0)).count() == 0


def test_rows_of_one_id_with_different_texts_are_documents_of_their_own(spark):
    line = "both rows of this id hold this very line of words"
    docs = spark.createDataFrame([(1, f"a\n{line}", "x"), (1, f"b\n{line}", "x"), (2, f"b\n{line}", "x"), (2, f"b\n{line}", "y")], DOCS)
    kept = sorted(r["text"] for r in repeats.remove_repeats(docs).collect())
    assert [t.endswith(line) for t in kept].count(True) == 1 and len(kept) == 4


def test_items_rich_in_slots_match_when_copied(spark):
    short = "Compute 12 + 35 - 4 * 7 + 9"
    table = "Add " + ", ".join(f"{n} and {n * n} and" for n in range(11, 40)) + " nothing"
    found = leaks(spark, [f"Now: {short} please", f"see {table}", short.replace("9", "8"), " ".join(map(str, range(60)))], [short, table])
    assert set(found) == {(0, 0), (1, 1), (2, 0)} and found[2, 0] and not found[0, 0]


def test_one_contradiction_spoils_its_own_windows_only(spark):
    rng = random.Random(11)
    words = [f"word{rng.randrange(10**6)}x" for _ in range(200)]
    for at, word in ((5, "Anna"), (120, "Anna"), (60, "17"), (180, "17")):
        words[at] = word
    typo = [*words[:120], "Ana", *words[121:]]
    edit = [*words[:180], "18", *words[181:]]
    found = leaks(spark, [" ".join(typo), " ".join(edit)], [" ".join(words)])
    assert set(found) == {(0, 0), (1, 0)} and not any(found.values())


def test_what_stands_before_a_copy_does_not_matter(spark):
    items = ["What is the capital of France?", "Minutes per working day", "Say yes", "Paris"]
    docs = ["Question What is the capital of France?", "Geography\nWhat is the capital of France?", "5 Minutes per working day", "say yes!", "They say yes", "Paris"]
    found = leaks(spark, docs, items)
    assert set(found) == {(0, 0), (1, 0), (2, 1), (3, 2), (5, 3)} and not any(found.values())

import random
import re

from tripflow.llm import licenses

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
SCHEMA = "doc_id long, text string, words string"


def by_force(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), places


def test_base_against_brute_force(spark, tmp_path):
    rng = random.Random(2)
    parts = ["MIT", "mit", "License", "license.", "apache", "General", "public", "GNU", "émit", "x", "\n", "É", "9", "licenseé", "-"]
    texts = [
        None, "", " ", "MIT license", "mit\x00LICENSE", "the Apache\nLicense, Version 2.0", "general public license " * 3000,
        "Released under the MIT License.", "mit licenſe", "License mit", "mit mit license license",
    ]
    texts += [rng.choice(["", " "]).join(rng.choices(parts, k=rng.randrange(40))) for _ in range(300)]
    texts += [" ".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(300)]
    spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in licenses.op10_licenses(spark, str(tmp_path)).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        n, places = by_force(text)
        r, starts = found[i], [s for s, _ in places]
        want = (n, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({p for _, p in places})))
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == want, text
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) | {""}
        assert 0.0 <= r["score"] <= 1.0 and (r["score"] > 0) == bool(r["labels"])


def labels(spark, *texts):
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], SCHEMA)
    return [sorted({p["label"] for p in r["places"]}) for r in licenses.scan_licenses(docs).orderBy("doc_id").collect()]


def test_notices_survive_small_changes_but_not_without_their_key_phrase(spark):
    notice = "Redistribution and use in source and binary forms, with or without modification, are permitted"
    changed = notice.replace("modification", "changes")
    broken = notice.replace("binary forms", "object forms")
    found = labels(spark, notice, changed, broken, "Licensed under CC BY-NC 4.0.", "source and forms of use " * 50, None)
    assert found == [["bsd"], ["bsd"], [], ["cc-by-nc"], [], []]


def test_ties_repeats_and_empty_table(spark):
    assert labels(spark, "mit license", "mit license") == [["mit"], ["mit"]]
    assert licenses.scan_licenses(spark.createDataFrame([], SCHEMA)).count() == 0


def test_main_path_is_native(spark):
    docs = spark.createDataFrame([(1, "mit license", None)], SCHEMA)
    plan = licenses.scan_licenses(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

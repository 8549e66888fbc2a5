"""License scan: rare words of notice templates are looked up by position, then key phrases are verified."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, table

# A word of a text whose letters A-Z are in lower case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A notice as words, and the phrase in it that must stand as it is. ``base`` templates count as places."""

    label: str
    notice: str
    key: str
    base: bool = False


TEMPLATES = (
    Template("mit", "mit license", "mit license", True),
    Template("apache", "apache license", "apache license", True),
    Template("gpl", "general public license", "general public license", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "free of charge to any person"),
    Template("apache", "licensed under the apache license version 2 0", "apache license"),
    Template("apache", "spdx license identifier apache 2 0", "license identifier apache"),
    Template("mit", "spdx license identifier mit", "license identifier mit"),
    Template("gpl", "licensed under the gnu general public license version 3", "general public license"),
    Template("gpl", "spdx license identifier gpl 3 0", "license identifier gpl"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "in source and binary forms"),
    Template("mpl", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
)
# A template is looked up by this many of its rarest words, and checked at twice as many.
LOOKUPS = 3
MIN_SUPPORT = 0.7


def words(text: str = "text") -> Column:
    """All words of the whole text. ``lower`` also changes letters beyond A-Z, but makes no word longer,
    shorter or equal to an ASCII word that it wasn't, except through the Kelvin sign."""
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(WORD), F.lit(0))


def word_idf(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> dict[str, float]:
    """How rare each word of the templates is among all documents. One row per template word reaches the driver."""
    vocabulary = sorted({w for t in templates for w in t.notice.split()})
    found = F.array_distinct(F.filter(words(), lambda w: w.isin(vocabulary)))
    # The empty word stands for the document itself.
    counted = docs.select(F.explode(F.concat(F.array(F.lit("")), found)).alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in counted.collect()}
    total = counts.pop("", 0)
    return {w: math.log((1 + total) / (1 + counts.get(w, 0))) + 1e-3 for w in vocabulary}


def postings(templates: tuple[Template, ...], idf: Mapping[str, float]) -> dict[str, list[Column]]:
    """The index: for each rare word of each template, where the template's other words must stand."""
    out: dict[str, list[Column]] = {}
    for t in templates:
        notice, key = t.notice.split(), t.key.split()
        key_at = next(i for i in range(len(notice)) if notice[i : i + len(key)] == key)
        by_rarity = sorted(range(len(notice)), key=lambda i: (-idf[notice[i]], i))
        checked = range(len(notice)) if t.base else by_rarity[: 2 * LOOKUPS]
        total = sum(idf[notice[i]] for i in checked)
        # One lookup finds every place of a phrase that must be there as a whole.
        for at in by_rarity[: 1 if t.base else LOOKUPS]:
            out.setdefault(notice[at], []).append(
                F.struct(
                    F.lit(notice[at]).alias("word"),
                    F.lit(at).alias("at"),
                    F.lit(t.label).alias("label"),
                    F.lit(t.base).alias("base"),
                    F.array(*[
                        F.struct(F.lit(i).alias("at"), F.lit(notice[i]).alias("word"), F.lit(idf[notice[i]] / total).alias("part"))
                        for i in checked
                    ]).alias("rare"),
                    F.array(*[
                        F.struct(F.lit(key_at + i).alias("at"), F.lit(w).alias("word")) for i, w in enumerate(key)
                    ]).alias("key"),
                )
            )
    return out


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, tokens: str = "words") -> DataFrame:
    """``docs`` with ``words`` and ``places``: (label, base, start, support) of each template found.

    Each occurrence of one of a template's rarest words proposes a start. It becomes a place if enough of
    the other rare words, weighed by rarity, stand at their relative positions and the key phrase stands
    there word for word. Work per text is linear in its words. A null text has no words and no places;
    existing columns called ``words`` or ``places`` are replaced.
    """
    by_word = postings(templates, word_idf(docs.select("text"), templates))
    index, lookups = F.array(*[p for found in by_word.values() for p in found]), list(by_word)
    hits_name, index_name = fresh(docs, "license_hits", "license_index")
    tokenised = docs.withColumn(tokens, words())
    hits = tokenised.withColumn(
        hits_name,
        F.filter(
            F.transform(tokens, lambda w, i: F.struct(w.alias("word"), i.alias("at"))), lambda h: h["word"].isin(lookups)
        ),
    ).withColumn(index_name, index)

    def stands(w: Column, start: Column) -> Column:
        return F.coalesce(F.get(F.col(tokens), start + w["at"]) == w["word"], F.lit(False))

    def place(p: Column, start: Column) -> Column:
        support = F.aggregate(p["rare"], F.lit(0.0), lambda a, w: a + F.when(stands(w, start), w["part"]).otherwise(0.0))
        return F.struct(
            p["label"].alias("label"),
            p["base"].alias("base"),
            start.alias("start"),
            F.when(F.forall(p["key"], lambda w: stands(w, start)), support).otherwise(0.0).alias("support"),
        )

    proposed = F.flatten(
        F.transform(
            hits_name,
            lambda h: F.transform(
                F.filter(index_name, lambda p: p["word"] == h["word"]), lambda p: place(p, h["at"] - p["at"])
            ),
        )
    )
    return hits.withColumn("places", F.filter(proposed, lambda p: p["support"] >= MIN_SUPPORT)).drop(hits_name, index_name)


def op10_licenses(spark, sf_dir):
    """License places and labels of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_licenses(docs).drop("text")
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])

    def labels(places: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    return found.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("places")).alias("labels"),
        F.least(F.lit(1.0), F.coalesce(F.array_max(F.transform("places", lambda p: p["support"])), F.lit(0.0))).alias("score"),
    )

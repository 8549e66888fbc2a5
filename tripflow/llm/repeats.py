"""Substring deduplication: normalised lines and sentences are hashed, and the first occurrence stays."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import arrow
from .common import checkpointed, fresh, table

# A line, cut further after a sentence's end, since shared passages are also pasted into lines.
UNIT = re.compile(r"[^\n.!?]+(?:[.!?]+(?=\s|\Z)|[.!?]+(?=\S)[^\n.!?]*)*")
WORDS = re.compile(r"[^\W_]+")
# Shorter ones are no evidence of copying and stay.
MIN_WORDS = 8
# A run of repeated neighbours is evidence of copying from so many words on: half a passage of fifty.
MIN_RUN = 25
UNIT_TYPE = "array<struct<high: long, low: long, start: int, end: int, cut_from: int, again: boolean>>"


def _spans(text: str, min_words: int) -> list[tuple[bytes, int, int, int]]:
    """The units of ``text_units``, and the start of the last sentence where that alone is long enough, else of the unit."""
    out: list[tuple[bytes, int, int, int]] = []
    line: list[tuple[bytes, int, int, int]] = []  # (words, their number, start, end) of the sentences of a line
    end = 0
    for m in UNIT.finditer(text):
        words = WORDS.findall(m.group().lower())
        if words:
            start = m.start()
            if line and text.find("\n", end, start) >= 0:
                _line_spans(line, min_words, out)
                line = []
            end = m.end()
            line.append((" ".join(words).encode("utf-8", "surrogatepass"), len(words), start, end))
    _line_spans(line, min_words, out)
    return out


def _line_spans(line: list[tuple[bytes, int, int, int]], min_words: int, out: list[tuple[bytes, int, int, int]]) -> None:
    """The shortest run of at least ``min_words`` words from each sentence on, and up to each sentence."""
    first = total = 0
    for j, (_, n, _, _) in enumerate(line):
        total += n
        if total < min_words:
            continue
        # Runs that end here: those that only this sentence makes long enough, and the shortest one.
        before = total - n
        while total >= min_words:
            if before < min_words or total - line[first][1] < min_words:
                words = line[j][0] if first == j else b" ".join([s[0] for s in line[first : j + 1]])
                digest = hashlib.blake2b(words, digest_size=16).digest()
                out.append((digest, line[first][2], line[j][3], line[j if n >= min_words else first][2]))
            if total - line[first][1] < min_words:
                break
            total -= line[first][1]
            before -= line[first][1]
            first += 1


def text_units(text: str, min_words: int = MIN_WORDS) -> Iterator[tuple[bytes, int, int]]:
    """(digest, start, end) of the units of a text. Case, punctuation and white space don't matter for the
    digest; offsets are code points of the text as it is.

    Each sentence of a line with as many of the following ones as reach ``min_words`` words is a unit, and so
    is each with as many of those before it. Units overlap, and what is one doesn't depend on the text around
    it: a passage of whole sentences has the same units wherever it is pasted.
    """
    for digest, start, end, _ in _spans(text, min_words):
        yield digest, start, end


def line_units(text: str) -> Iterator[tuple[bytes, int, int]]:
    """(digest, start, end) of every line of a text that has a word, of any length. A line is no copy of a part of one."""
    at = 0
    for line in text.split("\n"):
        words = list(WORDS.finditer(line))
        if words:
            key = "\n".join(["", *(w.group().lower() for w in words)]).encode("utf-8", "surrogatepass")
            yield hashlib.blake2b(key, digest_size=16).digest(), at + words[0].start(), at + words[-1].end()
        at += len(line) + 1


def units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per unit: ``doc_id, rank, text_hash, high, low, start, end, cut_from, again``. ``again``: an
    equal unit of the same text ends before it. ``rank`` and ``text_hash`` order documents: by id, those without
    one after the others, by text hash among equals."""

    @F.arrow_udf(UNIT_TYPE)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            digests, starts, ends, cuts, again, counts = [], [], [], [], [], []
            for _, block in arrow.slices(batch):
                for text in block.to_pylist():
                    seen: dict[bytes, int] = {}  # end of the first one
                    before = len(digests)
                    for digest, start, end, cut_from in _spans(text, min_words):
                        digests.append(digest)
                        starts.append(start)
                        ends.append(end)
                        cuts.append(cut_from)
                        again.append(seen.setdefault(digest, end) <= start)
                    counts.append(len(digests) - before)
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            rows = pa.StructArray.from_arrays(
                [
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                    pa.array(starts, pa.int32()),
                    pa.array(ends, pa.int32()),
                    pa.array(cuts, pa.int32()),
                    pa.array(again, pa.bool_()),
                ],
                ["high", "low", "start", "end", "cut_from", "again"],
            )
            offsets = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), rows)

    keyed = docs.select("doc_id", _rank(), F.xxhash64("text").alias("text_hash"), found("text").alias("units"))
    return keyed.select("doc_id", "rank", "text_hash", F.explode("units").alias("u")).select("doc_id", "rank", "text_hash", "u.*")


def _rank() -> Column:
    """The place of a document: its id, or for those without one a place behind all others."""
    unnamed = F.lit(2**62) + F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col("text"), F.lit(""))), 2)
    return F.coalesce(F.col("doc_id"), unnamed).alias("rank")


def repeated_units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The units to remove: ``doc_id, rank, text_hash, start, end, cut_from, first_rank`` with the rank of
    the document that keeps it.

    Every unit that an earlier document has, or an earlier place of the same text. Rows equal in id and text
    count as one document, so their units are removed from all or none of them. Digests are grouped after
    a partial aggregation; a unit that a third of all documents share is one row per task there. The shared
    digests are stored, so that the join with the occurrences is shuffled on both sides and Spark can split it.
    """
    # Taking texts apart costs far more than writing the units, which are needed twice.
    return _later_ones(checkpointed(units(docs.select("doc_id", "text"), min_words)))


def _later_ones(found: DataFrame) -> DataFrame:
    """Of stored units, those that an earlier document has or that stand earlier in the same text."""
    place = F.struct("rank", "text_hash")
    shared = (
        found.groupBy("high", "low")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"), F.max("again").alias("any_again"))
        .where((F.col("first") < F.col("last")) | F.col("any_again"))
        .select("high", "low", F.col("first.rank").alias("first_rank"), F.col("first.text_hash").alias("first_hash"))
    )
    return (
        found.join(checkpointed(shared), ["high", "low"])
        .where((place > F.struct("first_rank", "first_hash")) | F.col("again"))
        .select("doc_id", "rank", "text_hash", "start", "end", "cut_from", "first_rank")
    )


def _merged(spans: Column) -> Column:
    @F.arrow_udf("array<struct<start: int, end: int>>")
    def merged(lists: pa.Array) -> pa.Array:
        out = []
        for spans in lists.to_pylist():
            joined: list[dict] = []
            for s in sorted(spans, key=lambda s: (s["start"], s["end"])):
                if joined and s["start"] <= joined[-1]["end"]:
                    joined[-1]["end"] = max(joined[-1]["end"], s["end"])
                else:
                    joined.append(s)
            out.append(joined)
        return pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))

    return merged(spans)


def _runs(text: Column, units: Column, min_run: int) -> Column:
    """The runs of a text's repeated units that are long enough, as (start, end, n_words, first_rank)."""

    @F.arrow_udf("array<struct<start: int, end: int, n_words: int, first_rank: long>>")
    def runs(texts: pa.Array, lists: pa.Array) -> pa.Array:
        out = []
        for text, units in zip(texts.to_pylist(), lists.to_pylist()):
            joined: list[dict] = []
            for u in sorted(units, key=lambda u: (u["start"], u["end"])):
                # Between neighbours there is nothing but marks and white space.
                if joined and (u["start"] <= joined[-1]["end"] or not WORDS.search(text, joined[-1]["end"], u["start"])):
                    last = joined[-1]
                    last["end"] = max(last["end"], u["end"])
                    last["first_rank"] = min(last["first_rank"], u["first_rank"])
                    last["whole"] |= u["whole"]
                else:
                    joined.append(dict(u))
            found = []
            for r in joined:
                n = sum(1 for _ in WORDS.finditer(text, r["start"], r["end"]))
                if n >= min_run or r["whole"]:
                    found.append({"start": r["start"], "end": r["end"], "n_words": n, "first_rank": r["first_rank"]})
            out.append(found)
        fields = [("start", pa.int32()), ("end", pa.int32()), ("n_words", pa.int32()), ("first_rank", pa.int64())]
        return pa.array(out, pa.list_(pa.struct(fields)))

    return runs(text, units)


def repeated_lines(docs: DataFrame) -> DataFrame:
    """Lines of any length that an earlier document has, or an earlier place of the same text, as ``repeated_units``."""

    @F.arrow_udf("array<struct<high: long, low: long, start: int, end: int, again: boolean>>")
    def found(texts: pa.Array) -> pa.Array:
        out = []
        for _, block in arrow.slices(texts):
            for text in block.to_pylist():
                seen: set[bytes] = set()
                lines = []
                for digest, start, end in line_units(text):
                    high, low = np.frombuffer(digest, np.int64).tolist()
                    lines.append({"high": high, "low": low, "start": start, "end": end, "again": digest in seen})
                    seen.add(digest)
                out.append(lines)
        fields = [("high", pa.int64()), ("low", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("again", pa.bool_())]
        return pa.array(out, pa.list_(pa.struct(fields)))

    keyed = docs.select("doc_id", _rank(), F.xxhash64("text").alias("text_hash"), F.explode(found("text")).alias("u"))
    return _later_ones(checkpointed(keyed.select("doc_id", "rank", "text_hash", "u.*", F.col("u.start").alias("cut_from"))))


def repeated_runs(docs: DataFrame, min_run: int = MIN_RUN, lines: bool = True, min_words: int = MIN_WORDS) -> DataFrame:
    """What ``repeated_units`` lists, as spans that can be cut out: ``doc_id, start, end, n_words, first_doc_id``.

    Units that overlap or have no word between them are one run, and a run counts from ``min_run`` words on, so that a
    stock sentence alone is no evidence of copying. With ``lines`` a whole line that an earlier document has counts
    at any length, such as a footer or the lines of a paragraph. Spans of a document don't overlap; offsets are code
    points of the original text; ``first_doc_id`` is the earliest document that keeps a part of the run. Rows equal in id and
    text have their spans once. Null and empty texts have none. A document's units meet in one row, so one text
    is the smallest unit of work.
    """
    docs = docs.select("doc_id", "text")
    listed = repeated_units(docs, min_words).withColumn("whole", F.lit(False))
    if lines:
        listed = listed.unionByName(repeated_lines(docs).withColumn("whole", F.lit(True)))
    by_doc = listed.groupBy(F.col("rank").alias("of_rank"), F.col("text_hash").alias("of_hash")).agg(
        F.collect_set(F.struct("start", "end", "first_rank", "whole")).alias("units")
    )
    # Stored, so that the join is shuffled on both sides and Spark can split it.
    by_doc = checkpointed(by_doc)
    texts = docs.select("doc_id", "text", _rank(), F.xxhash64("text").alias("text_hash"))
    joined = texts.join(by_doc, (F.col("rank") == F.col("of_rank")) & (F.col("text_hash") == F.col("of_hash")))
    once = joined.dropDuplicates(["rank", "text_hash"])
    runs = once.select("doc_id", F.explode(_runs(F.col("text"), F.col("units"), min_run)).alias("r"))
    kept = F.when(F.col("r.first_rank") < 2**62, F.col("r.first_rank"))
    return runs.select("doc_id", "r.start", "r.end", "r.n_words", kept.alias("first_doc_id"))


def _cut(text: Column, spans: Column) -> Column:
    @F.arrow_udf("string")
    def cut(texts: pa.Array, removed: pa.Array) -> pa.Array:
        out = []
        for text, spans in zip(texts.to_pylist(), removed.to_pylist()):
            if spans:
                kept, at = [], 0
                for s in spans:
                    kept.append(text[at : s["start"]])
                    at = s["end"]
                text = "".join([*kept, text[at:]])
            out.append(text)
        return pa.array(out, pa.string())

    return cut(text, spans)


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated units cut out of ``text``, and ``removed``: their (start, end) in the original,
    merged where they overlap or touch. Short sentences before the first long one of a repeated passage stay.

    Null and empty texts stay as they are, with null ``removed``, as do texts without repeats. Other columns
    pass through; an existing ``removed`` is replaced.
    """
    docs = docs.drop("removed")
    hashed, text_hash, rank, span_hash, spans = fresh(docs, "rank_hash", "text_hash", "span_rank", "span_hash", "spans")
    removed = repeated_units(docs, min_words)
    found = F.collect_set(F.struct(F.col("cut_from").alias("start"), "end"))
    by_doc = removed.groupBy(F.col("rank").alias(rank), F.col("text_hash").alias(span_hash)).agg(_merged(found).alias(spans))
    keyed = docs.withColumn(hashed, _rank()).withColumn(text_hash, F.xxhash64("text"))
    joined = keyed.join(by_doc, (F.col(hashed) == F.col(rank)) & (F.col(text_hash) == F.col(span_hash)), "left")
    cut = joined.withColumn("text", _cut(F.col("text"), F.col(spans)))
    return cut.select(*docs.columns, F.col(spans).alias("removed"))


def op9_substring_dedup(spark, sf_dir):
    """Every unit that goes, with its original offsets and the document that keeps the first occurrence."""
    removed = repeated_units(table(spark, sf_dir, "documents"))
    kept = F.when(F.col("first_rank") < 2**62, F.col("first_rank"))
    return removed.select("doc_id", "start", "end", kept.alias("first_doc_id"))

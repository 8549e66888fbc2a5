"""Benchmark decontamination by templates: numbers, names and units become typed slots."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrow
from .common import checkpointed, fresh, table

# Template tokens per window. Shorter items are one window of their own length; below SHORTEST, a document must
# be nothing but the item.
WINDOW = 8
SHORTEST = 4
# Share of an item's tokens that matching windows must cover.
COVERAGE = 0.5
# Windows of documents that can't match are dropped by a bitmap of this many bits, whatever the benchmark's size.
BITMAP_BITS = 22
NUMBER = re.compile(r"[+-]?\d[\d.,:/]*(?:st|nd|rd|th|%)?")
GLUED = re.compile(r"([+-]?\d[\d.,]*)([a-zµ°]+)")
# Number words and units.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    " eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
UNITS = frozenset(
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms ton tons lb lbs"
    " pound pounds oz ounce ounces ml l liter liters litre litres gallon gallons ms s sec second seconds min minute"
    " minutes h hr hour hours day days week weeks month months year years dollar dollars euro euros cent cents percent"
    " degree degrees celsius fahrenheit kelvin joule joules watt watts volt volts newton newtons hz mb gb tb".split()
)
LITERAL, NUM, NAME, UNIT = range(4)
_BASE = 0x9E3779B97F4A7C15
_SLOTS = ("", "<num>", "<name>", "<unit>")


def _shape(raw: str) -> tuple[str, int, bool, bool]:
    """A token's value, its kind before its neighbours are looked at, whether it is in title case, and
    whether it ends a sentence. An empty value: nothing but punctuation."""
    core = raw.strip("\"'`“”‘’«»()[]{}<>.,;:!?¿¡*#|&%$-–—_=~^/\\")
    low = core.lower()
    ends = raw.rstrip("\"'”’»)]}*#&%$|").endswith((".", "!", "?", ":"))
    if not core:
        return "", LITERAL, False, ends
    if NUMBER.fullmatch(low) or low in NUMBER_WORDS:
        return low, NUM, False, ends
    glued = GLUED.fullmatch(low)
    if glued and glued[2] in UNITS:
        return low, NUM, False, ends
    title = core[0].isupper() and core[1:] != core[1:].upper() if len(core) > 1 else False
    return low, LITERAL, title, ends


class Templates:
    """The template tokens of a slice of texts: ``hashes``, ``kinds``, ``rows`` and, by code, ``values``."""

    def __init__(self, texts: pa.Array):
        raw, rows = arrow.tokens(pc.ascii_split_whitespace(texts))
        coded = raw.dictionary_encode()
        shapes = [_shape(t) for t in coded.dictionary.to_pylist()]
        codes = coded.indices.to_numpy(zero_copy_only=False)
        self.values = np.array([s[0] for s in shapes] or [""], dtype=object)
        kinds, titles, ends, words, units = (
            np.array(column, dtype)[codes] if len(codes) else np.zeros(0, dtype)
            for column, dtype in (
                ([s[1] for s in shapes], np.int8),
                ([s[2] for s in shapes], bool),
                ([s[3] for s in shapes], bool),
                ([bool(s[0]) for s in shapes], bool),
                ([s[0] in UNITS for s in shapes], bool),
            )
        )
        first = np.ones(len(codes), bool)  # of a sentence
        first[1:] = ends[:-1] | (rows[1:] != rows[:-1])
        # Bare punctuation goes; a sentence's start passes to the word behind it.
        stray = first[:-1] & ~words[:-1]
        first[1:] |= stray
        titled = np.where(titles, NAME, kinds)
        kinds = np.where(titles & ~first, NAME, kinds)
        codes, kinds, titled, units, self.rows = codes[words], kinds[words], titled[words], units[words], rows[words]
        after_number = np.zeros(len(codes), bool)
        after_number[1:] = (kinds[:-1] == NUM) & (self.rows[1:] == self.rows[:-1])
        unit = after_number & units & (kinds != NUM)
        self.kinds = np.where(unit, UNIT, kinds)
        # By capitals alone, wherever a sentence starts: the same in a copy, whatever stands before it.
        self.titled = np.where(unit, UNIT, titled)
        self.codes = codes
        by_code = pd.util.hash_array(self.values, categorize=False).astype(np.uint64)
        self.exact = by_code[codes]
        self.by_kind = pd.util.hash_array(np.array(_SLOTS, dtype=object), categorize=False).astype(np.uint64)
        self.starts = np.searchsorted(self.rows, np.arange(len(texts)))
        self.counts = np.bincount(self.rows, minlength=len(texts))

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(first token, hash) of the windows that stay in one text.

        Windows that are at least half literal are hashed as templates, with kinds by sentence and by capitals
        alone; the others with one half by template and one by value, so that copies and those with one half
        changed match. Kinds of the first token don't depend on the one before it. Windows below SHORTEST are
        whole texts, hashed by value.
        """
        n = len(self.codes) - length + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        inside = self.rows[:n] == self.rows[length - 1 :]
        if length < SHORTEST:
            whole = np.flatnonzero(inside & (self.counts[self.rows[:n]] == length))
            return whole, _mixed([self.exact[whole + i] for i in range(length)], length)
        firsts, hashes = [], []
        for kinds in (self.kinds, self.titled):
            # The first token of a window has nothing before it: no unit, and by sentence no name.
            head = np.where((kinds == UNIT) | ((kinds == NAME) & (kinds is self.kinds)), LITERAL, kinds)
            literal = np.zeros(n, np.int8)
            for i in range(length):
                literal += (kinds if i else head)[i : i + n] == LITERAL
            columns = [np.where(k == LITERAL, self.exact, self.by_kind[k]) for k in (head, kinds)]
            total = _mixed([columns[i > 0][i : i + n] for i in range(length)], length)
            chosen = np.flatnonzero(inside & (2 * literal >= length))
            firsts.append(chosen)
            hashes.append(total[chosen])
        rest, half = np.flatnonzero(inside & (2 * literal < length)), length - length // 2
        for by_value in (range(half), range(length - half, length)):
            firsts.append(rest)
            parts = [(self.exact if i in by_value else columns[i > 0])[rest + i] for i in range(length)]
            hashes.append(_mixed(parts, length + 100 * (by_value.start + 1)))
        return np.concatenate(firsts), np.concatenate(hashes)


def _mixed(parts: list[np.ndarray], seed: int) -> np.ndarray:
    total = np.full(len(parts[0]), np.uint64(seed))
    for part in parts:
        total = total * np.uint64(_BASE) + part
    return (total ^ (total >> np.uint64(29))).view(np.int64)


def _window_rows(t: Templates, length: int, keep=None) -> tuple[np.ndarray, pa.RecordBatch]:
    """(row, batch of position, length, hash) for one window length."""
    first, hashes = t.windows(length)
    if keep is not None:
        kept = keep(hashes)
        first, hashes = first[kept], hashes[kept]
    rows = t.rows[first] if len(first) else np.zeros(0, np.int64)
    columns = [(first - t.starts[rows]).astype(np.int32), np.full(len(first), length, np.int32), hashes]
    return rows, pa.record_batch([pa.array(c) for c in columns], ["position", "length", "hash"])


WINDOW_COLUMNS = "position int, length int, hash long"
TOKEN_COLUMNS = "values array<string>, kinds array<int>, titled array<int>"


def _token_columns(t: Templates, spans: list[tuple[int, int]]) -> list[pa.Array]:
    """Values and both kinds of stretches of tokens."""
    return [
        pa.array([t.values[t.codes[a:b]].tolist() for a, b in spans], pa.list_(pa.string())),
        *(pa.array([kinds[a:b].tolist() for a, b in spans], pa.list_(pa.int32())) for kinds in (t.kinds, t.titled)),
    ]


def item_windows(items: DataFrame) -> DataFrame:
    """All windows of all items: ``item, tokens`` and the window's columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in arrow.slices(batch.column("text")):
                t = Templates(texts)
                ids = batch.column("item").slice(start, len(texts))
                for length in range(1, WINDOW + 1):
                    rows, found = _window_rows(t, length)
                    # Windows shorter than WINDOW only for items that are no longer than that.
                    chosen = np.flatnonzero((t.counts[rows] == length) | (length == WINDOW))
                    at = pa.array(rows[chosen])
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(at), pa.array(t.counts[rows[chosen]].astype(np.int32)), *found.take(pa.array(chosen)).columns],
                        ["item", "tokens", *found.schema.names],
                    )

    return items.select("item", "text").mapInArrow(arrow.sparing(run), f"item long, tokens int, {WINDOW_COLUMNS}")


def item_tokens(items: DataFrame) -> DataFrame:
    """The template tokens of all items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in arrow.slices(batch.column("text")):
                t = Templates(texts)
                ids = [batch.column(c).slice(start, len(texts)) for c in ("item", "item_id")]
                spans = list(zip(t.starts.tolist(), (t.starts + t.counts).tolist()))
                yield pa.RecordBatch.from_arrays(
                    [*ids, *_token_columns(t, spans)], ["item", "item_id", "values", "kinds", "titled"]
                )

    return items.select("item", "item_id", "text").mapInArrow(arrow.sparing(run), f"item long, item_id long, {TOKEN_COLUMNS}")


def _bits(used: DataFrame, column: str) -> np.ndarray:
    """A bitmap of the low bits of a column's values, packed."""
    low = used.select(F.col(column).bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)).alias("bit")).distinct().toArrow()
    bitmap = np.zeros(1 << BITMAP_BITS, bool)
    bitmap[low.column("bit").to_numpy()] = True
    return np.packbits(bitmap)


def doc_windows(docs: DataFrame, bits: np.ndarray, lengths: list[int]) -> DataFrame:
    """The windows of all documents whose hash is in the bitmap: ``doc_id, text_hash`` and the window's columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(bits).astype(bool)
        mask = np.int64(len(known) - 1)
        for batch in batches:
            for start, texts in arrow.slices(batch.column("text")):
                t = Templates(texts)
                ids, hashes = (batch.column(c).slice(start, len(texts)) for c in ("doc_id", "text_hash"))
                for length in lengths:
                    rows, found = _window_rows(t, length, lambda h: known[h & mask])
                    at = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(at), hashes.take(at), *found.columns], ["doc_id", "text_hash", *found.schema.names]
                    )

    return docs.mapInArrow(arrow.sparing(run), f"doc_id long, text_hash long, {WINDOW_COLUMNS}")


def doc_stretches(docs: DataFrame) -> DataFrame:
    """The tokens of a document that stand where an item's would: one row per struct of ``spans``. ``lead``
    tokens of the item lie before the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in arrow.slices(batch.column("text")):
                t = Templates(texts)
                for row, spans in enumerate(batch.column("spans").slice(start, len(texts)).to_pylist()):
                    size, at = int(t.counts[row]), int(t.starts[row])
                    for k in range(0, len(spans), 1000):
                        part = spans[k : k + 1000]
                        ends = [(at + max(s["shift"], 0), at + min(s["shift"] + s["tokens"], size)) for s in part]
                        same = pa.array([start + row] * len(part), pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column("doc_id").take(same),
                                batch.column("text_hash").take(same),
                                pa.array([s["item"] for s in part], pa.int64()),
                                pa.array([max(-s["shift"], 0) for s in part], pa.int32()),
                                *_token_columns(t, ends),
                            ],
                            ["doc_id", "text_hash", "item", "lead", "values", "kinds", "titled"],
                        )

    return docs.mapInArrow(arrow.sparing(run), f"doc_id long, text_hash long, item long, lead int, {TOKEN_COLUMNS}")


def _runs(flags: list[bool], least: int) -> Iterator[range]:
    start = 0
    for p, flag in enumerate([*flags, False]):
        if not flag:
            if p - start >= least:
                yield range(start, p)
            start = p + 1


def counted(item: tuple[list, list, list], doc: tuple[list, list, list], lead: int) -> tuple[list[int], bool]:
    """The item's tokens that lie in counting windows, and whether one of them has another value in the document.

    ``item`` and ``doc``: values, kinds by sentence and kinds by capitals of tokens that stand at equal places.
    """
    n = len(item[0])
    least = min(WINDOW, n)
    equal, key, value = [False] * n, [None] * n, [None] * n
    slots: dict[tuple, Counter] = {}
    for p, theirs, kind, titled in zip(range(lead, n), *doc):
        ours, slot = item[0][p], item[2][p]
        equal[p] = ours == theirs
        both_literal = kind == LITERAL and item[1][p] == LITERAL
        if slot != LITERAL and (equal[p] or (slot == titled and not both_literal)):
            key[p], value[p] = (slot, ours), theirs
            slots.setdefault(key[p], Counter())[theirs] += 1
    contradicted = sum(len(c) > 1 for c in slots.values())
    held = sum(len(c) == 1 and c.total() > 1 for c in slots.values())
    trusted = contradicted == 0 or held > contradicted
    covered, changed = {p for run in _runs(equal, least) for p in run}, False
    if trusted:
        kept = {k: c.most_common(1)[0][0] for k, c in slots.items()}
        fits = [equal[p] if key[p] is None else value[p] == kept[key[p]] for p in range(n)]
        before: set[tuple] = set()
        confirmed = []
        for p in range(n):
            confirmed.append(fits[p] and (equal[p] or key[p] in before))
            if fits[p] and key[p]:
                before.add(key[p])
        for run in _runs(fits, least):
            if any(2 * sum(confirmed[p : p + least]) >= least for p in range(run.start, run.stop - least + 1)):
                covered.update(run)
                changed |= not all(equal[p] for p in run)
    return sorted(covered), changed


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Documents that hold an item or a re-parameterised one: ``doc_id, text_hash, item_id, coverage, changed``.

    Windows of documents and items are joined by hash; each document, item and shift that match somewhere are
    one alignment, whose tokens are then compared. Windows that are equal in all values count always. Others
    count if their template is the item's and each slot value of the item stands for one value of the document,
    apart from a minority of slots, whose rarer values no window may hold;
    half of a window's tokens must be equal or repeat a slot, in the window or in one linked to it by others
    that match. The windows of all alignments must cover ``coverage`` of the item's tokens. ``changed``: some
    slot has another value than in the item. Items of fewer than four tokens match documents that are nothing
    else; null or empty texts on either side match nothing. Repeated items are reported once per item_id.
    """
    items = benchmark.select(F.xxhash64("item_id", "text").alias("item"), "item_id", "text").dropDuplicates(["item"])
    windows = checkpointed(item_windows(items))
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    theirs = windows.select("item", "tokens", F.col("position").alias("item_position"), "length", "hash")
    matched = doc_windows(keyed, _bits(windows, "hash"), lengths).join(theirs, ["hash", "length"])
    span = F.struct("item", "tokens", (F.col("position") - F.col("item_position")).alias("shift"))
    spans = checkpointed(matched.groupBy("doc_id", "text_hash").agg(F.collect_set(span).alias("spans")))
    bits = _bits(spans, "text_hash")

    @F.arrow_udf("boolean")
    @arrow.sparing
    def known(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bitmap = np.unpackbits(bits).astype(bool)
        for batch in batches:
            yield pa.array(bitmap[batch.to_numpy(zero_copy_only=False) & np.int64(len(bitmap) - 1)])

    hit = spans.select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), "spans")
    texts = keyed.where(known("text_hash")).join(
        hit, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    )
    stretches = doc_stretches(texts.select("doc_id", "text_hash", "text", "spans"))
    renamed = {c: f"item_{c}" for c in ("values", "kinds", "titled")}
    aligned = stretches.join(item_tokens(items).withColumnsRenamed(renamed), "item")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ours, theirs = (
                zip(*(batch.column(p + c).to_pylist() for c in ("values", "kinds", "titled"))) for p in ("item_", "")
            )
            found = [counted(*pair) for pair in zip(ours, theirs, batch.column("lead").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "text_hash", "item_id", "item")),
                    pa.array([len(v) for v in batch.column("item_values").to_pylist()], pa.int32()),
                    pa.array([f[0] for f in found], pa.list_(pa.int32())),
                    pa.array([f[1] for f in found], pa.bool_()),
                ],
                ["doc_id", "text_hash", "item_id", "item", "tokens", "covered", "changed"],
            )

    compared = aligned.mapInArrow(
        arrow.sparing(compare), "doc_id long, text_hash long, item_id long, item long, tokens int, covered array<int>, changed boolean"
    ).where(F.size("covered") > 0)
    return (
        compared.groupBy("doc_id", "text_hash", "item_id", "item", "tokens")
        .agg(
            (F.size(F.array_distinct(F.flatten(F.collect_set("covered")))) / F.col("tokens")).alias("coverage"),
            F.max("changed").alias("changed"),
        )
        .where(F.col("coverage") >= coverage)
        .groupBy("doc_id", "text_hash", "item_id")
        .agg(F.max("coverage").alias("coverage"), F.min("changed").alias("changed"))
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without those that hold an item of the benchmark; all columns pass through."""
    (hashed,) = fresh(docs, "text_hash")
    hit = checkpointed(leaks(docs, benchmark, coverage).select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).distinct())
    keyed = docs.withColumn(hashed, F.xxhash64("text"))
    return keyed.join(
        hit, keyed["doc_id"].eqNullSafe(hit["hit_id"]) & (keyed[hashed] == hit["hit_hash"]), "left_anti"
    ).select(*docs.columns)


def op4_decontamination(spark, sf_dir):
    """Every pair of a document and a benchmark item that it holds."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", "changed")

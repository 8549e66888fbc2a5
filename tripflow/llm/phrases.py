"""Phrases whose words stand together more often than their parts do: Toivonen's mining, then scores.

A sample proposes phrases. One pass over all texts counts them and their negative border: phrases that were not
proposed, but whose beginning and end, one word shorter, were. Every word is in one of the two. Border phrases that
prove frequent may have frequent extensions. One more pass counts every phrase left out of which no part is known to
be rare; then no frequent phrase is missing, whatever the sample held.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import arrow
from .common import checkpointed, table

LEAST = 30
LONGEST = 4
TOP = 2000
# A phrase goes if a longer one around it has this share of its occurrences, in percent.
COVERED = 80
SCALE = 2_000_000
NO_LANGUAGE = "und"

SAMPLE = 1 / 16
SAMPLE_SEED = 20
# Bits of a filter per phrase in it, and the bits of the largest filter (64 MB); past it, more phrases are counted
# for nothing, and results stay the same.
BITS_PER_PHRASE = 16
MOST_BITS = 29
_CHUNK = 15
# Rows that a worker hands over at once.
LOT = 1 << 16

_COUNTS = "lang string, phrase string, size int, n long"
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hashes(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash per string, the same in every process."""
    if not len(strings):
        return np.zeros(0, np.uint64)
    strings = strings.cast(pa.large_string())
    bounds = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(strings.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    ends, lengths = bounds[1:] - bounds[0], np.diff(bounds)
    powers = np.cumprod(np.full(int(lengths.max()) + 1, _STEP))
    place = np.arange(len(data)) - np.repeat(ends - lengths, lengths)
    total = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[place]) if len(data) else np.zeros(0, np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), total])
    return _mixed(total[ends] - total[ends - lengths] + lengths.astype(np.uint64))


def _byte_table(which: str) -> np.ndarray:
    table_ = np.zeros(256, bool)
    table_[[ord(c) for c in which]] = True
    return table_


class Pieces:
    """The words of a slice of texts: ``ids`` of (language, word) and the piece that each word stands in."""

    def __init__(self, langs: pa.Array, texts: pa.Array):
        texts = pc.ascii_lower(arrow.flat(texts))
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        starts = offsets[:-1] - offsets[0]
        breaks = _byte_table(".,;:!?\n\v\f\r")[data]
        word = ~breaks & ~_byte_table(" \t")[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        first[starts[starts < len(data)]] |= word[starts[starts < len(data)]]
        last = word.copy()
        last[:-1] &= ~word[1:] | first[1:]
        first, last = np.flatnonzero(first), np.flatnonzero(last)
        self.rows = np.searchsorted(starts, first, side="right") - 1
        # How many breaks stand before, and how many texts: equal for words of one piece only.
        self.piece = np.searchsorted(np.flatnonzero(breaks), first) + self.rows
        bounds = np.concatenate([[0], np.cumsum(last - first + 1)])
        words = pa.LargeStringArray.from_buffers(
            len(first), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[word]))
        ).dictionary_encode()
        del breaks, word, first, last, bounds
        langs = langs.fill_null(NO_LANGUAGE).dictionary_encode()
        lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[self.rows]
        self.languages, self.n_words = langs.dictionary.cast(pa.string()), np.bincount(lang, minlength=len(langs.dictionary))
        code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.ids, found = pd.factorize(code * max(1, len(langs.dictionary)) + lang)
        self.lang = langs.dictionary.take(pa.array(found % max(1, len(langs.dictionary))))
        self.words = words.dictionary.take(pa.array(found // max(1, len(langs.dictionary))))
        by_lang, by_word = _hashes(langs.dictionary), _hashes(words.dictionary)
        self.lang_hash, self.word_hash = by_lang[lang], by_word[code]

    def hashes(self, size: int) -> np.ndarray:
        """A hash of the language and the ``size`` words from each word on, piece ends or not."""
        n = max(0, len(self.ids) - size + 1)
        found = self.lang_hash[:n]
        for i in range(size):
            found = found * _STEP + self.word_hash[i : n + i]
        return _mixed(found)

    def phrases(self, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(a place of each different phrase, its number of places) of the phrases that start at words ``at``."""
        codes = self.ids[at]
        for i in range(1, size):
            codes = pd.factorize(codes * (len(self.words) + 1) + self.ids[at + i])[0]
        if size == 1:
            codes = pd.factorize(codes)[0]
        counts = np.bincount(codes)
        some = np.zeros(len(counts), np.int64)
        some[codes] = at
        return some, counts

    def batch(self, at: np.ndarray, size: int, counts: np.ndarray) -> pa.RecordBatch:
        words = [self.words.take(pa.array(self.ids[at + i])) for i in range(size)]
        phrase = words[0] if size == 1 else pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string()))
        lang = self.lang.take(pa.array(self.ids[at])).cast(pa.string())
        sizes = np.full(len(at), size, np.int32)
        return pa.RecordBatch.from_arrays(
            [lang, phrase.cast(pa.string()), pa.array(sizes), pa.array(counts.astype(np.int64))],
            ["lang", "phrase", "size", "n"],
        )


def _in_filter(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether both bits of each hash are set in a packed filter, whose size is a power of two."""
    mask = np.uint64(len(bits) * 8 - 1)
    one, two = hashes & mask, (hashes >> np.uint64(32)) & mask
    seven, three = np.uint64(7), np.uint64(3)
    return ((bits[one >> three] >> (one & seven)) & (bits[two >> three] >> (two & seven)) & 1).astype(bool)


def phrase_filter(phrases: DataFrame, most_bits: int = MOST_BITS) -> np.ndarray:
    """A packed Bloom filter of the (lang, phrase) rows: it may hold others, but misses none.

    Its size follows the number of rows up to a bound. Tasks set the bits of parts of the filter; the driver
    only lays the parts side by side.
    """
    n = phrases.count()
    power = min(most_bits, max(_CHUNK, int(np.ceil(np.log2(max(1, n) * BITS_PER_PHRASE)))))
    mask = np.uint64((1 << power) - 1)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = Pieces(batch.column("lang"), batch.column("phrase"))
            sizes = np.bincount(known.rows, minlength=len(batch))
            first = np.searchsorted(known.rows, np.arange(len(batch)))
            for size in np.unique(sizes[sizes > 0]):
                found = known.hashes(int(size))[first[sizes == size]]
                both = np.unique(np.concatenate([found & mask, (found >> np.uint64(32)) & mask])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(both >> _CHUNK), pa.array(both & ((1 << _CHUNK) - 1))], ["chunk", "bit"])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, bits = None, np.zeros(1 << _CHUNK, bool)

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([np.packbits(bits, bitorder="little").tobytes()])], ["chunk", "bits"]
            )

        for batch in batches:
            chunks, at = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("chunk", "bit"))
            starts = np.flatnonzero(np.diff(chunks, prepend=-1))
            for start, stop in zip(starts, np.append(starts[1:], len(chunks)), strict=True):
                if chunk is not None and chunks[start] != chunk:
                    yield row()
                    bits[:] = False
                chunk = int(chunks[start])
                bits[at[start:stop]] = True
        if chunk is not None:
            yield row()

    set_bits = phrases.select("lang", "phrase").mapInArrow(places, "chunk long, bit long").distinct()
    laid = set_bits.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(parts, "chunk long, bits binary")
    bits = np.zeros((1 << power) // 8, np.uint8)
    for row in laid.toArrow().to_pylist():
        at = row["chunk"] << (_CHUNK - 3)
        bits[at : at + len(row["bits"])] = np.frombuffer(row["bits"], np.uint8)
    return bits


def count_phrases(
    docs: DataFrame, sizes: list[int], known: np.ndarray | None = None, parts: int = 0, found: np.ndarray | None = None
) -> DataFrame:
    """``lang, phrase, size, n``: how often phrases of these sizes stand in pieces of ``docs`` (lang, text).

    With the filter ``known`` only phrases whose own parts, of ``parts`` words or one word fewer than the phrase,
    are all in it are counted. What is counted, is counted fully: a filter decides by phrase, not by place. A row of
    size 0 and no phrase has the language's words.

    With ``found`` too, a filter of the frequent phrases among those counted with ``known``, the phrases that were not
    counted are, unless a part of them is known to be rare. Sizes then go up from 1 by 1, and words are not counted.
    """
    context = docs.sparkSession.sparkContext
    held, proved = context.broadcast(known), context.broadcast(found)

    def counts_of(here: Pieces) -> Iterator[pa.RecordBatch]:
        known, found = held.value, proved.value
        hashes, inside = functools.cache(here.hashes), {}
        # Where a phrase of the size before starts that may be frequent.
        maybe = np.ones(len(here.ids) + 1, bool)
        for size in sizes:
            n = len(here.ids) - size + 1
            if n <= 0:
                continue
            good = here.piece[:n] == here.piece[size - 1 :]
            part = min(size - 1, parts)
            if part and part not in inside:
                inside[part] = _in_filter(known, hashes(part))
            counted = np.ones(n, bool)
            for i in range(size - part + 1 if part else 0):
                counted &= inside[part][i : n + i]
            if found is None:
                good &= counted
            else:
                good &= maybe[:n] & maybe[1 : n + 1]
                if size < sizes[-1]:
                    maybe = good & (~counted | _in_filter(found, hashes(size)))
                good &= ~counted
            at, counts = here.phrases(np.flatnonzero(good), size)
            for lot in range(0, len(at), LOT):
                yield here.batch(at[lot : lot + LOT], size, counts[lot : lot + LOT])
            if size == 1 and found is None:
                of = np.flatnonzero(here.n_words)
                none, zero = pa.array([""] * len(of), pa.string()), pa.array([0] * len(of), pa.int32())
                n_words = pa.array(here.n_words[of].astype(np.int64))
                totals = [here.languages.take(pa.array(of)), none, zero, n_words]
                yield pa.RecordBatch.from_arrays(totals, ["lang", "phrase", "size", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in arrow.slices(batch.column("text")):
                # Nothing of a slice is held when the next one is taken apart.
                yield from counts_of(Pieces(batch.column("lang").slice(start, len(texts)), texts))

    counted = docs.select("lang", "text").mapInArrow(arrow.sparing(run), _COUNTS)
    return counted.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))


def frequent_phrases(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, sample: float = SAMPLE, most_bits: int = MOST_BITS
) -> DataFrame:
    """``lang, phrase, size, n`` of every phrase of up to ``longest`` words that stands ``least`` times in ``docs``
    (lang, text), and a row of size 0 per language with its number of words.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and into words at spaces and tabs.
    Null texts have no words; a null language is ``und``. Counts are exact for any sample, an empty one too: the
    sample decides only which passes find a phrase. Long texts are counted in bounded slices, one text at least.
    """
    docs = docs.select("lang", "text")
    some = docs.sample(False, sample, SAMPLE_SEED)
    lowered = max(2, int(least * sample))

    def often(counted: DataFrame, at_least: int) -> DataFrame:
        return checkpointed(counted.where((F.col("n") >= at_least) | (F.col("size") == 0)))

    # The sample's phrases: words and pairs first, then longer ones made of its frequent pairs.
    proposed = often(count_phrases(some, [1, 2][:longest]), lowered).where("size > 0")
    if longest > 3:
        pairs = phrase_filter(proposed.where("size = 2"), most_bits)
        longer = often(count_phrases(some, list(range(3, longest)), pairs, 2), lowered)
        proposed = proposed.union(longer)
    known = phrase_filter(proposed, most_bits)
    found = often(count_phrases(docs, list(range(1, longest + 1)), known, longest - 1), least)
    extensible = found.where(F.col("size").between(1, longest - 1))
    if extensible.join(proposed, ["lang", "phrase"], "left_anti").isEmpty():
        return found  # what was left out has a part that was not proposed, hence one that is rare
    left_out = count_phrases(docs, list(range(1, longest + 1)), known, longest - 1, phrase_filter(extensible, most_bits))
    return found.union(often(left_out, least))


def _joined(words: Column, first: Column | int, count: Column | int) -> Column:
    return F.array_join(F.slice(words, first, count), " ")


def collocations(frequent: DataFrame, covered: int = COVERED) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the phrases in ``frequent`` of two words or more.

    ``a`` is the phrase's count, ``l`` and ``r`` those of its two parts at the cut with the lowest score
    ``floor(2000000 a / (l + r))``, the first of such cuts. Phrases inside a longer one that has ``covered``
    percent of their occurrences or more are left out. Division is of decimals, hence exact.
    """
    words, size = F.split("phrase", " "), F.col("size")
    known = frequent.where("size > 0").select("lang", "phrase", "n")
    longer = frequent.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"))
    cuts = longer.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "lang", "phrase", "a", "k", _joined(words, F.lit(1), F.col("k")).alias("left"), _joined(words, F.col("k") + 1, size - F.col("k")).alias("right")
    )
    left = known.select(F.col("lang"), F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = known.select(F.col("lang"), F.col("phrase").alias("right"), F.col("n").alias("r"))
    cuts = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    exact = F.expr(f"(cast(a as decimal(20, 0)) * {SCALE}) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    cut = F.struct(exact.alias("score"), "k", "l", "r")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(cut).alias("cut"))
    inner = longer.where("size > 2").withColumn("m", F.explode(F.sequence(F.lit(2), size - 1)))
    inner = inner.withColumn("i", F.explode(F.sequence(F.lit(1), size - F.col("m") + 1)))
    inner = inner.select("lang", _joined(words, F.col("i"), F.col("m")).alias("phrase"), "a")
    around = inner.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = scored.join(around, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (F.col("around") * 100 < F.col("a") * covered)
    )
    return kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def op13_collocations(spark, sf_dir):
    """The 2,000 best phrases of each language."""
    found = frequent_phrases(table(spark, sf_dir, "documents"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = collocations(found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    totals = found.where("size = 0").select("lang", F.col("n"))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


ORACLE_OP13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (
  SELECT lang, size, w, unnest(range(1, len(w) - size + 2)) AS i
  FROM words, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size),
grams AS (SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase FROM starts),
f AS (SELECT lang, size, phrase, count(*) AS n FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
cand AS (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND n >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.n AS l, r.n AS r, (2000000::HUGEINT * c.a) // (l.n + r.n) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM cand) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1 : c.size], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS around
  FROM (SELECT *, unnest(range(1, size - m + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS m FROM cand))
  GROUP BY ALL),
kept AS (
  SELECT s.* FROM lowest s LEFT JOIN inner_ i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE i.around IS NULL OR 100 * i.around < 80 * s.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score::BIGINT AS score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""

"""Language identification: unigrams over a fixed public vocabulary, summed over all segmentations."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import arrow
from .common import checkpointed, held_out, learnable, table, unit_interval

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
# The model learns each language from at most so many documents, those with the lowest hashes. The bound is a
# parameter of the fit; every text is scored.
DOCS_PER_LANGUAGE = 1000
# The model is a matrix of pieces and languages. A table with more languages than this is refused.
MOST_LANGUAGES = 1000
ROUNDS = 4
# Weight of the uniform distribution that each language's counts are mixed with, in pieces.
SMOOTHING = 200.0
# Probability of a letter that no piece covers.
UNKNOWN = 1e-8
# Longer runs of letters are taken in parts: for the fit each by itself, for scores with the sums carried over.
PART = 32
LONGEST_PIECE = 16
# Parts of long runs whose transfer matrices are held at once.
PARTS_AT_ONCE = 1000
NOT_LETTERS = r"[^\p{L}\p{M}]+"
NO_LANGUAGE = "und"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def read_vocabulary(path: str = VOCABULARY) -> list[str]:
    """Lower-case pieces of a public SentencePiece model, without control and byte pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return sorted({p for p in (model.id_to_piece(i).lower() for i in ids) if len(p) <= LONGEST_PIECE})


def _prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes of strings of one length, given as a matrix of code points."""
    hashes = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    for i in range(codes.shape[1]):
        hashes[:, i + 1] = hashes[:, i] * _BASE + codes[:, i].astype(np.uint64) + np.uint64(1)
    return hashes


def _codes(strings: list[str], length: int) -> np.ndarray:
    return np.array(strings, dtype=f"<U{length}").view(np.uint32).reshape(len(strings), length)


@dataclass
class Lattice:
    """All ways to cut strings into pieces. Piece ``len(pieces)`` is an unknown letter, the next one is none."""

    pieces: list[str]
    hashes: np.ndarray = field(init=False)
    order: np.ndarray = field(init=False)

    def __post_init__(self):
        hashes = np.empty(len(self.pieces), np.uint64)
        by_length: dict[int, list[int]] = {}
        for i, p in enumerate(self.pieces):
            by_length.setdefault(len(p), []).append(i)
        for length, ids in by_length.items():
            hashes[ids] = _prefix_hashes(_codes([self.pieces[i] for i in ids], length))[:, length]
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(LONGEST_PIECE, _BASE)]), dtype=np.uint64)

    def arcs(self, strings: list[str], length: int) -> dict[tuple[int, int], np.ndarray]:
        """For each (start, end), the piece that stands there in each of the strings, all ``length`` long."""
        unknown, none = len(self.pieces), len(self.pieces) + 1
        prefix = _prefix_hashes(_codes(strings, length))
        out = {}
        for start in range(length):
            for end in range(start + 1, min(length, start + LONGEST_PIECE) + 1):
                h = prefix[:, end] - prefix[:, start] * self.powers[end - start]
                at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
                found = np.where(self.hashes[at] == h, self.order[at], unknown if end == start + 1 else none)
                if end == start + 1 or (found != none).any():
                    out[start, end] = found
        return out


def forward(arcs: dict, length: int, n: int, chances: np.ndarray) -> list[np.ndarray]:
    """Probability of each prefix under each language, summed over all segmentations."""
    sums = [np.ones((n, chances.shape[1]))] + [np.zeros((n, chances.shape[1])) for _ in range(length)]
    for (start, end), piece in sorted(arcs.items(), key=lambda a: a[0][1]):
        sums[end] += sums[start] * chances[piece]
    return sums


def expected_counts(arcs: dict, length: int, weights: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in each language; ``weights`` counts each string in each language."""
    n = len(weights)
    ahead = forward(arcs, length, n, chances)
    behind = [np.zeros_like(ahead[0]) for _ in range(length)] + [np.ones_like(ahead[0])]
    for (start, end), piece in sorted(arcs.items(), key=lambda a: -a[0][0]):
        behind[start] += behind[end] * chances[piece]
    scale = weights / ahead[length]
    out = np.zeros_like(chances)
    for (start, end), piece in arcs.items():
        uses = ahead[start] * chances[piece] * behind[end] * scale
        for language in range(chances.shape[1]):
            out[:, language] += np.bincount(piece, uses[:, language], len(out))
    return out


def transfers(lattice: Lattice, windows: list[str], chances: np.ndarray) -> np.ndarray:
    """For windows of one length, matrices (window, from, to, language) that carry prefix sums over a part.

    A window is a part behind the 15 letters before it. ``from`` are the 16 prefixes that end among those letters or
    before them, ``to`` the last 16 prefixes of the window.
    """
    length, n = len(windows[0]), len(windows)
    sums = [np.zeros((n, LONGEST_PIECE, chances.shape[1])) for _ in range(length + 1)]
    for i in range(LONGEST_PIECE):
        sums[i][:, i] = 1.0
    for (start, end), piece in sorted(lattice.arcs(windows, length).items(), key=lambda a: a[0][1]):
        if end >= LONGEST_PIECE:
            sums[end] += sums[start] * chances[piece][:, None, :]
    return np.stack(sums[-LONGEST_PIECE:], axis=2)


def long_scores(lattice: Lattice, words: list[str], chances: np.ndarray) -> np.ndarray:
    """Log probability of each marked word of more than ``LONGEST_PIECE`` letters, over all its segmentations.

    The sums of the last 16 prefixes are carried from part to part and rescaled there, so no product underflows
    and no piece is lost where parts meet. Parts are of 16 letters: a sum that is carried reaches over 31 at most.
    """
    logs = np.zeros((len(words), chances.shape[1]))
    if not words or not chances.shape[1]:
        return logs
    step, carried = LONGEST_PIECE, {}
    heads = [w[:step] for w in words]
    for at in range(0, len(heads), PARTS_AT_ONCE):
        some = heads[at : at + PARTS_AT_ONCE]
        sums = np.stack(forward(lattice.arcs(some, step), step, len(some), chances)[1:], axis=1)
        carried.update(zip(range(at, at + len(some)), sums))
    # The parts of all words, one word after the other, so that few sums are under way.
    places = ((i, p) for i, w in enumerate(words) for p in range(step, len(w), step))
    most = max(1, PARTS_AT_ONCE // (1 + chances.shape[1] // 16))
    while some := list(itertools.islice(places, most)):
        windows = [words[i][p - step + 1 : p + step] for i, p in some]
        matrices: dict[str, np.ndarray] = {}
        for same in by_length(set(windows)).values():
            matrices.update(zip(same, transfers(lattice, same, chances)))
        for (i, _), window in zip(some, windows):
            sums = np.einsum("jl,jil->il", carried[i], matrices[window])
            top = sums.max(axis=0)
            logs[i] += np.log(top)
            carried[i] = sums / top
    for i, sums in carried.items():
        logs[i] += np.log(sums[-1])
    return logs


def parts(word: str) -> list[str]:
    """A word with its mark of a word's begin, in parts that the fit takes one by one."""
    marked = "▁" + word
    return [marked[i : i + PART] for i in range(0, len(marked), PART)]


def by_length(strings) -> dict[int, list[str]]:
    out: dict[int, list[str]] = {}
    for s in strings:
        out.setdefault(len(s), []).append(s)
    return out


def letter_runs(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-case runs of letters, and the row that each is from."""
    return arrow.tokens(pc.split_pattern_regex(pc.utf8_lower(texts), NOT_LETTERS))


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: list[str]
    chances: np.ndarray  # (pieces + unknown + none) x languages

    def word_scores(self, lattice: Lattice, words: list[str]) -> np.ndarray:
        """Log probability of each word under each language."""
        marked = ["▁" + w for w in words]
        scores = np.zeros((len(words), self.chances.shape[1]))
        places: dict[int, list[int]] = {}
        for i, w in enumerate(marked):
            places.setdefault(min(len(w), PART + 1), []).append(i)
        for length, at in places.items():
            for low in range(0, len(at), 20_000):
                some = at[low : low + 20_000]
                strings = [marked[i] for i in some]
                if length > PART:
                    scores[some] = long_scores(lattice, strings, self.chances)
                else:
                    scores[some] = np.log(forward(lattice.arcs(strings, length), length, len(some), self.chances)[length])
        return scores


def training_rows(docs: DataFrame, docs_per_language: int, most_languages: int = MOST_LANGUAGES) -> DataFrame:
    """(lang, text) of the learnable documents with the lowest hashes of each language.

    Languages are counted first and thinned by hash, so that the ranking sees a bounded number of rows. The
    counts that are broadcast have ``MOST_LANGUAGES`` rows at most; more languages are an error.
    """
    known = docs.where(learnable(F.col("doc_id")) & F.col("lang").isNotNull())
    counts = known.groupBy(F.col("lang").alias("language")).agg(F.count(F.lit(1)).alias("n"))
    counts = checkpointed(counts)
    if counts.limit(most_languages + 1).count() > most_languages:
        raise ValueError(f"more than {most_languages} languages: the model would not fit in a worker")
    drawn = known.withColumn("draw", F.xxhash64("doc_id"))
    thinned = drawn.join(F.broadcast(counts), F.col("lang") == F.col("language")).where(
        unit_interval(F.col("draw")) * F.col("n") < 3.0 * docs_per_language
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id"))
    return thinned.withColumn("rank", rank).where(F.col("rank") <= docs_per_language).select("lang", "text")


def learn(docs: DataFrame, vocabulary: str = VOCABULARY, docs_per_language: int = DOCS_PER_LANGUAGE) -> LanguageModel:
    """Fit per-language piece probabilities by expectation maximisation over counted words.

    Words are counted and expectations summed by Spark; the driver holds one number per piece and language.
    """
    pieces = read_vocabulary(vocabulary)
    size = len(pieces) + 2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages = np.array(batch.column("lang").to_pylist(), dtype=object)
            for start, texts in arrow.slices(batch.column("text")):
                words, rows = letter_runs(texts)
                table_ = pa.table({"lang": pa.array(languages[start + rows], pa.string()), "word": words.cast(pa.string())})
                table_ = table_.append_column("n", pa.array(np.ones(len(table_), np.int64)))
                counted = table_.group_by(["lang", "word"]).aggregate([("n", "sum")]).rename_columns(["lang", "word", "n"])
                yield from counted.combine_chunks().to_batches()

    sample = training_rows(docs.select("doc_id", "lang", "text"), docs_per_language)
    counts = checkpointed(
        sample.mapInArrow(arrow.sparing(count), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    )
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    words = counts.groupBy("word").agg(F.collect_list(F.struct("lang", "n")).alias("by_lang"))
    chances = np.full((size, max(1, len(languages))), 1.0 / len(pieces))
    chances[-2], chances[-1] = UNKNOWN, 0.0
    if not languages:
        return LanguageModel(languages, pieces, chances)

    def expect(chances: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattice, place = Lattice(pieces), {name: i for i, name in enumerate(languages)}
            total = np.zeros_like(chances)
            for batch in batches:
                weights: dict[str, np.ndarray] = {}
                for word, by_lang in zip(batch.column("word").to_pylist(), batch.column("by_lang").to_pylist()):
                    for part in parts(word):
                        w = weights.setdefault(part, np.zeros(len(languages)))
                        for r in by_lang:
                            w[place[r["lang"]]] += r["n"]
                for length, strings in by_length(weights).items():
                    arcs = lattice.arcs(strings, length)
                    total += expected_counts(arcs, length, np.array([weights[s] for s in strings]), chances)
            piece, language = np.nonzero(total)
            yield pa.record_batch(
                {"piece": piece.astype(np.int64), "language": language.astype(np.int64), "uses": total[piece, language]}
            )

        return run

    for _ in range(ROUNDS):
        summed = (
            words.mapInArrow(arrow.sparing(expect(chances)), "piece long, language long, uses double")
            .groupBy("piece", "language")
            .agg(F.sum("uses").alias("uses"))
            .toPandas()
        )
        uses = np.zeros((size, len(languages)))
        uses[summed["piece"], summed["language"]] = summed["uses"]
        known = uses[:-2] + SMOOTHING / len(pieces)
        chances = np.vstack([known / known.sum(axis=0), np.full(len(languages), UNKNOWN), np.zeros(len(languages))])
    return LanguageModel(languages, pieces, chances)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the probability of that language given the whole text.

    A null text, one without letters, or a model without languages gives ``und`` and 0. Languages that tie
    go to the first by name. Existing columns of those names are replaced. Workers hold a bounded cache
    of scored words and take long texts apart in bounded slices; one text is the smallest slice.
    """
    most_cached = 300_000

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    @arrow.sparing
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lattice = Lattice(model.pieces)
        places: dict[str, int] = {}
        known = np.zeros((0, len(model.languages)))
        for batch in batches:
            logs = np.zeros((len(batch), len(model.languages)))
            letters = np.zeros(len(batch), bool)
            for start, texts in arrow.slices(batch):
                letters[start : start + len(texts)] = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
                words, rows = letter_runs(texts)
                coded = words.dictionary_encode()
                unique = coded.dictionary.to_pylist()
                if len(places) + len(unique) > most_cached:
                    places, known = {}, known[:0]
                new = [w for w in unique if w not in places]
                if new and model.languages:
                    places.update(zip(new, range(len(known), len(known) + len(new))))
                    known = np.vstack([known, model.word_scores(lattice, new)])
                if not model.languages or not unique:
                    continue
                at = np.array([places[w] for w in unique])[coded.indices.to_numpy(zero_copy_only=False)]
                for language in range(len(model.languages)):
                    logs[start : start + len(texts), language] = np.bincount(rows, known[at, language], len(texts))
            if not model.languages:
                best, score, named = None, np.zeros(len(batch)), pa.array([NO_LANGUAGE] * len(batch), pa.string())
            else:
                best = logs.argmax(axis=1)
                score = 1.0 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                score = np.where(letters, score, 0.0)
                named = pa.array(np.where(letters, np.array(model.languages, dtype=object)[best], NO_LANGUAGE), pa.string())
            yield pa.StructArray.from_arrays([named, pa.array(score)], ["lang_pred", "score"])

    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]
    found = docs.select(*rest, scored(F.col(text)).alias("_language"))
    return found.select(*rest, "_language.lang_pred", "_language.score")


def op7_language_id(spark, sf_dir):
    """The language of every document, learned from the four fifths that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn(docs)
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

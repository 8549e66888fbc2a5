"""Statistics of whole texts that quality rules and classifiers look at."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrow

# All are counts: words, their code points, symbols, lines equal to an earlier one, words in repeated
# windows of three, lines with a word, different words, capitals, digits, sentence marks.
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_upper",
    "n_digits", "n_marks",
)
STRUCT = "struct<" + ", ".join(f"{c}: long" for c in COUNTS) + ">"


def _repeats(codes: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Which words stand in a window of three that occurs at least twice in the same text."""
    hit = np.zeros(len(codes), bool)
    if len(codes) < 3:
        return hit
    pairs = pd.factorize(codes[:-1] * size + codes[1:])[0].astype(np.int64)
    triples = pd.factorize(pairs[:-1] * size + codes[2:])[0].astype(np.int64)
    within = np.flatnonzero(rows[:-2] == rows[2:])
    windows = pd.factorize(triples[within] * (rows[-1] + 1) + rows[within])[0]
    often = within[np.bincount(windows)[windows] > 1] if len(within) else within
    for i in range(3):
        hit[often + i] = True
    return hit


def _of_slice(texts: pa.Array) -> np.ndarray:
    n = len(texts)

    def per_row(rows, weights=None):
        return np.bincount(rows, weights, n).astype(np.int64)

    def matches(pattern):
        return pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)

    words, rows = arrow.tokens(pc.ascii_split_whitespace(texts))
    coded = words.dictionary_encode()
    codes, size = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), max(1, len(coded.dictionary))
    lines, line_rows = arrow.tokens(pc.split_pattern(texts, "\n"))
    full = pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]")
    lines, line_rows = lines.filter(full).dictionary_encode(), line_rows[full.to_numpy(zero_copy_only=False)]
    line_codes = lines.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n_lines = per_row(line_rows)
    return np.stack(
        [
            per_row(rows),
            per_row(rows, pc.utf8_length(words).to_numpy(zero_copy_only=False)),
            matches(r"[#*$%&|<>]"),
            n_lines - per_row(pd.unique(line_codes * n + line_rows) % n),
            per_row(rows[_repeats(codes, rows, size)]),
            n_lines,
            per_row(pd.unique(codes * n + rows) % n),
            matches("[A-Z]"),
            matches("[0-9]"),
            matches("[.,;:!?]"),
        ]
    )


def text_counts(batch: pa.Array) -> pa.Array:
    counts = np.zeros((len(COUNTS), len(batch)), np.int64)
    for start, texts in arrow.slices(batch):
        counts[:, start : start + len(texts)] = _of_slice(texts)
    return pa.StructArray.from_arrays([pa.array(c) for c in counts], list(COUNTS))


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one column per name in ``COUNTS``; columns of those names are replaced.

    A null text counts as empty, an empty one has only zeros. Texts are handled in bounded slices, and one
    text is the smallest slice.
    """
    rest = [c for c in docs.columns if c not in COUNTS]
    return docs.select(*rest, F.arrow_udf(text_counts, STRUCT)(F.col(text)).alias("_counts")).select(*rest, "_counts.*")


def ratios(counts: pd.DataFrame) -> np.ndarray:
    """The counts as a matrix of rates that don't grow with a text's length."""
    c = {name: counts[name].to_numpy(np.float64) for name in COUNTS}
    words, lines = np.maximum(c["n_words"], 1), np.maximum(c["n_lines"], 1)
    chars = np.maximum(c["word_chars"], 1)
    return np.column_stack(
        [
            c["word_chars"] / words,
            c["n_symbols"] / words,
            c["n_dup_lines"] / lines,
            c["n_repeat_words"] / words,
            np.log1p(c["n_distinct_words"]) / np.log1p(words),
            c["n_upper"] / chars,
            c["n_digits"] / chars,
            c["n_marks"] / words,
            np.log1p(c["n_words"]),
        ]
    )

"""Token ids of documents, written to files of packed blocks and read back."""

from __future__ import annotations

import functools
import math
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import arrow
from .common import checkpointed, table
from .packed import TokenFile, file_image
from .ranks import running_start

END_ID = 0
# Bytes of text per partition that writes files, and ids after which a file is closed behind a document.
PART_BYTES = 48 << 20
FILE_IDS = 1 << 21
# Bytes of text that are encoded at once, and different pieces whose ids a worker remembers.
LOT_BYTES = 4 * arrow.SLICE_BYTES
REMEMBERED = 1_000_000

_IMAGES = "image binary"
_DOCUMENTS = "part int, number int, place int, doc_id long, ids binary"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _kinds() -> np.ndarray:
    """What a byte says of its character: 0 unknown, 1 letter or digit, 2 other visible, 3 space, 4 mark."""
    kinds = np.zeros(256, np.uint8)
    kinds[0x21:0x7F] = 2
    kinds[[c for c in range(128) if chr(c).isalnum()]] = 1
    kinds[[0x20, *range(0x09, 0x0E)]] = 3
    kinds[[ord(c) for c in ".,;:!?#$%&*"]] = 4
    # Lead bytes of characters among which there is no white space.
    kinds[[*range(0xC3, 0xE0), 0xE0, *range(0xE4, 0xF5)]] = 2
    return kinds


_KINDS = _kinds()


def piece_starts(data: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where texts can be cut so that the pieces' ids, one after the other, are those of the whole text.

    Byte-level BPE with the usual pattern never joins what stands before white space with it, a lone line end
    with what follows, or a letter or digit with a mark (``.,;:!?#$%&*``) behind it. Cuts fall only where the bytes prove
    one of these; no special token holds such a place.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    kind = _KINDS[data]
    letter = kind == 1
    # Bytes inside a character are of the kind of its first one, at most three bytes before.
    inner = np.flatnonzero((data[1:] & 0xC0) == 0x80) + 1
    if len(inner):
        for _ in range(3):
            kind[inner] = kind[inner - 1]
        # Of the two-byte letters beside é only the signs × and ÷ are none.
        latin = (data[inner - 1] == 0xC3) & (data[inner] != 0x97) & (data[inner] != 0xB7)
        letter[inner] = latin | (kind[inner] == 1)
    seen = (kind != 0) & (kind != 3)
    cut = np.zeros(n, bool)
    cut[1:] = seen[:-1] & (kind[1:] == 3) | letter[:-1] & (kind[1:] == 4)
    lone = (data[1:-1] == 0x0A) & seen[:-2] & seen[2:]
    cut[2:] |= lone
    cut[text_starts[text_starts < n]] = True
    return np.flatnonzero(cut)


# Pieces that are surely one match of the pattern: letters up to U+024F only, a space in front or none.
ONE_WORD = "^ ?[A-Za-zÀ-ÖØ-öø-ɏ]+$"
# Pieces that are encoded together.
TOGETHER = 2048


def _byte_characters() -> np.ndarray:
    """The character, as UTF-16, that byte-level vocabularies have for each byte: itself if it can be seen."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    characters = np.zeros(256, "<u2")
    characters[visible] = visible
    others = np.setdiff1d(np.arange(256), visible)
    characters[others] = 256 + np.arange(len(others))
    return characters


_CHARACTERS = _byte_characters()


def _takes_words(tokenizer) -> bool:
    """Whether the tokenizer does nothing to a lone word but give its bytes, as characters, to its model."""
    from tokenizers import models, pre_tokenizers

    before = tokenizer.pre_tokenizer
    if not isinstance(before, pre_tokenizers.ByteLevel) or not before.use_regex or before.add_prefix_space:
        return False
    added = pa.array([t.content for t in tokenizer.get_added_tokens_decoder().values()], pa.string())
    inside = pc.any(pc.match_substring_regex(added, ONE_WORD)).as_py()
    return not inside and tokenizer.normalizer is None and isinstance(tokenizer.model, models.BPE)


class Encoder:
    """Ids of texts by a tokenizer file. Pieces between safe cuts are encoded once and remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.takes_words = _takes_words(self.tokenizer)
        self.known = pa.array([], pa.large_string())
        # Ids of the remembered pieces one after the other, and where each one's start.
        self.flat, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _keep(self, numbers: np.ndarray) -> None:
        """Forget all pieces but those of these numbers, which move up."""
        lists = pa.LargeListArray.from_arrays(pa.array(self.bounds, pa.int64()), pa.array(self.flat)).take(pa.array(numbers))
        flat, bounds = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(np.diff(self.bounds)[numbers])
        self.known, self.flat, self.bounds = self.known.take(pa.array(numbers)), flat, np.append(0, bounds)

    def _encode(self, pieces: pa.Array, words: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per piece), each piece for itself. Words go straight to the library's model."""
        ids, sizes, tokenize = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], self.tokenizer.model.tokenize
        for first in range(0, len(pieces), TOGETHER):
            lot = pieces.slice(first, TOGETHER).to_numpy(zero_copy_only=False).tolist()
            if words:
                data = np.frombuffer("\n".join(lot).encode(), np.uint8)
                lot = _CHARACTERS[data].tobytes().decode("utf-16-le").split(chr(_CHARACTERS[0x0A]))
                found = [[token.id for token in tokenize(word)] for word in lot]
            else:
                found = [e.ids for e in self.tokenizer.encode_batch_fast(lot, add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(chain.from_iterable(found), np.int32, int(sizes[-1].sum())))
        return np.concatenate(ids), np.concatenate(sizes)

    def _remember(self, pieces: pa.Array) -> np.ndarray:
        """The numbers of the pieces; new ones are encoded first."""
        if not len(pieces):
            return np.zeros(0, np.int32)
        # One dictionary for both: the remembered pieces keep their numbers, and new ones follow. Chunks without rows go.
        coded = pa.chunked_array([self.known, pieces]).dictionary_encode().chunks[-1]
        if len(coded.dictionary) > REMEMBERED and len(self.known):
            used = np.bincount(coded.indices.to_numpy(zero_copy_only=False), minlength=len(coded.dictionary))
            self._keep(np.flatnonzero(used[: len(self.known)]))
            coded = pa.chunked_array([self.known, pieces]).dictionary_encode().chunks[-1]
        new = coded.dictionary.slice(len(self.known))
        word = np.zeros(len(new), bool)
        if self.takes_words:
            word = pc.match_substring_regex(new, ONE_WORD).to_numpy(zero_copy_only=False)
        # Words first, then the others: the new pieces' places among them are their numbers.
        order = np.concatenate([np.flatnonzero(word), np.flatnonzero(~word)])
        new = new.take(pa.array(order))
        n_words = int(word.sum())
        parts = [self._encode(new.slice(0, n_words), True), self._encode(new.slice(n_words), False)]
        sizes = np.concatenate([p[1] for p in parts])
        numbers = coded.indices.to_numpy(zero_copy_only=False)
        place = np.arange(len(coded.dictionary), dtype=np.int32)
        place[len(self.known) + order] = len(self.known) + np.arange(len(order), dtype=np.int32)
        flat = np.concatenate([self.flat, *(p[0] for p in parts)])
        bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])
        self.known, self.flat, self.bounds = pa.concat_arrays([self.known, new]), flat, bounds
        return place[numbers]

    def ids(self, texts: pa.Array, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per text) of large strings; ``end`` is appended to each text if given."""
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        starts = offsets[:-1] - offsets[0]
        cuts = piece_starts(data, starts)
        bounds = pa.py_buffer(np.append(cuts, len(data)).astype(np.int64))
        pieces = pa.LargeStringArray.from_buffers(len(cuts), bounds, pa.py_buffer(np.ascontiguousarray(data)))
        numbers = self._remember(pieces)
        of_text = np.append(np.searchsorted(cuts, starts), len(cuts))
        counts = np.diff(np.concatenate([[0], np.cumsum(np.diff(self.bounds)[numbers])])[of_text])
        flat, bounds = self.flat, self.bounds
        if end is not None:  # one more remembered piece, behind the last one of each text
            flat, bounds = np.append(flat, np.int32(end)), np.append(bounds, bounds[-1] + 1)
            numbers = np.insert(numbers, of_text[1:], np.int32(len(self.known)))
            counts = counts + 1
        lists = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), pa.array(flat))
        return lists.take(pa.array(numbers)).flatten().to_numpy(zero_copy_only=False).view(np.uint32), counts


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One for all tasks of a Python worker, so that later ones find what earlier ones remember."""
    return Encoder(path)


def _images(path: str, end: int | None, file_ids: int):
    """A function over sorted partitions of (part, doc_id, text): one row per file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, ids, doc_ids, counts, held = 0, 0, [], [], [], 0

        def file() -> pa.RecordBatch:
            image = file_image(part, number, np.concatenate(ids), doc_ids, np.concatenate(counts))
            return pa.RecordBatch.from_arrays([pa.array([image], pa.binary())], ["image"])

        for batch in batches:
            for start, texts in arrow.slices(batch.column("text"), LOT_BYTES):
                part = batch.column("part")[0].as_py()
                found, lengths = encoder(path).ids(texts, end)
                names, ends = batch.column("doc_id").slice(start, len(texts)).to_pylist(), np.cumsum(lengths)
                first = 0
                while first < len(texts):
                    before = int(ends[first - 1]) if first else 0
                    stop = min(len(texts), int(np.searchsorted(ends, before + file_ids - held)) + 1)
                    ids.append(found[before : ends[stop - 1]])
                    counts.append(lengths[first:stop])
                    doc_ids += names[first:stop]
                    held += len(ids[-1])
                    if held >= file_ids:
                        yield file()
                        number, ids, doc_ids, counts, held = number + 1, [], [], [], 0
                    first = stop
        if doc_ids:
            yield file()

    return run


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str | None = None,
    end: int | None = END_ID,
    doc_id: str = "doc_id",
    text: str = "text",
    part_bytes: int = PART_BYTES,
    file_ids: int = FILE_IDS,
) -> None:
    """Write the token ids of all whole texts to files in ``folder``, in ascending order of ``doc_id``.

    ``tokenizer`` is a file of the tokenizers library for byte-level BPE without normaliser; no special tokens
    are added, and ``end`` closes each document unless it is None. A null text counts as empty; an id is a
    whole number or null, null ones come first. Rows of one id follow a hash of their texts; equal rows are
    told apart by physical place only. Other columns are not looked at.

    Texts are range-partitioned once, tokenised where they arrive and packed in files of about ``file_ids`` ids
    (one document is the least), which a task holds one at a time. Spark's own writer commits the files, so lost
    tasks leave nothing behind; each file ends with one more byte, the writer's line end. An empty table writes none.
    """
    texts = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), texts.alias("text"))
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / part_bytes))
    keys = ["doc_id", "drawn", "tie"]
    drawn = narrow.withColumn("drawn", F.xxhash64("text")).withColumn("tie", F.monotonically_increasing_id())
    laid = drawn.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    laid = laid.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    images = laid.mapInArrow(_images(tokenizer or default_tokenizer(), end, file_ids), _IMAGES)
    images.select(F.col("image").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of token files: ``part, number, place`` (their order), ``doc_id`` and ``ids``, unsigned 32-bit
    little-endian integers. Files are read whole, each by one task; Spark lists them, wherever they lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                file = TokenFile(memoryview(content.as_buffer())[:-1])
                n, values = file.n_docs, file.ids().astype("<u4")
                offsets = np.concatenate([[0], np.cumsum(file.counts) * 4])
                first = 0
                while first < n:  # offsets of a batch are 32-bit
                    stop = max(first + 1, int(np.searchsorted(offsets, offsets[first] + (1 << 28), side="right")) - 1)
                    data = values[offsets[first] // 4 : offsets[stop] // 4]
                    bounds = (offsets[first : stop + 1] - offsets[first]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(stop - first, file.part, np.int32)),
                            pa.array(np.full(stop - first, file.number, np.int32)),
                            pa.array(np.arange(first, stop, dtype=np.int32)),
                            pa.array(file.doc_ids[first:stop], pa.int64()),
                            pa.Array.from_buffers(pa.binary(), stop - first, [None, pa.py_buffer(bounds), pa.py_buffer(data)]),
                        ],
                        ["part", "number", "place", "doc_id", "ids"],
                    )
                    first = stop

    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    return files.load(folder).select("content").mapInArrow(run, _DOCUMENTS)


def op11_token_blocks(spark, sf_dir):
    """The ids of each document as its token file gives them back: where they start among all ids, how many, checksum."""
    folder = scratch_dir(spark, "tokens") + "/files"
    write_tokens(table(spark, sf_dir, "documents"), folder)
    found = read_tokens(spark, folder).select(
        "part",
        "number",
        "place",
        "doc_id",
        F.octet_length("ids").cast("long").alias("size"),
        F.crc32("ids").alias("ids_crc32"),
    )
    found = running_start(checkpointed(found), ["part", "number"], ["place"], "size", "before")
    return found.select(
        "doc_id",
        (F.col("before") / 4).cast("long").alias("start"),
        (F.col("size") / 4).cast("long").alias("n_tokens"),
        "ids_crc32",
    )

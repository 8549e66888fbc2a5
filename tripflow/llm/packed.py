"""Integers in patched frame-of-reference blocks, and files of them that hold whole documents.

A block holds up to BLOCK ids: its minimum, the width that a percentile of the differences to it needs, the
low bits of all differences at that width, and the positions and high bits of those that need more. A file is
a header, blocks, the documents' ids and lengths, the places where blocks start, and a trailer of fixed size.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np

BLOCK = 1024
PERCENTILE = 0.9
MAGIC = b"PFR1"
# Magic; number of the partition, number of the file in it.
HEADER = "<4sII"
# Minimum, ids, exceptions, width.
BLOCK_HEADER = "<IHHB"
# Ids, documents, blocks, place of the documents' table; magic.
TRAILER = "<QQQQ4s"
# Blocks that are packed together.
TOGETHER = 64


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def _low_bits(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of each row's values, packed row by row."""
    size = 2 if width <= 16 else 4
    whole = np.ascontiguousarray(values.astype(f"<u{size}")).ravel().view(np.uint8)
    bits = np.unpackbits(whole, bitorder="little").reshape(*values.shape, 8 * size)[:, :, :width]
    return np.packbits(bits.reshape(len(values), -1), axis=1, bitorder="little")


def pack_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> list[bytes]:
    """The blocks of ``ids`` (unsigned, 32 bits), each of BLOCK ids but the last."""
    ids = np.ascontiguousarray(ids, np.uint32)
    full = len(ids) // BLOCK * BLOCK
    parts = [ids[i : min(i + TOGETHER * BLOCK, full)].reshape(-1, BLOCK) for i in range(0, full, TOGETHER * BLOCK)]
    if full < len(ids):
        parts.append(ids[full:][None, :])
    out: list[bytes] = []
    for part in parts:
        n = part.shape[1]
        least = part.min(axis=1)
        above = part - least[:, None]
        place = min(n - 1, int(percentile * n))
        widths = _bit_lengths(np.partition(above, place, axis=1)[:, place])
        packed: list[bytes] = [b""] * len(part)
        for width in np.unique(widths):
            rows = np.flatnonzero(widths == width)
            for row, bits in zip(rows, _low_bits(above[rows], int(width)), strict=True):
                packed[row] = bits.tobytes()
        high = np.where(widths < 32, above.T >> np.minimum(widths, 31).astype(np.uint32), 0).T
        rows, places = np.nonzero(high)
        exceptions, places = high[rows, places].astype("<u4"), places.astype("<u2")
        ends = np.searchsorted(rows, np.arange(len(part) + 1))
        for row in range(len(part)):
            here = slice(ends[row], ends[row + 1])
            head = struct.pack(BLOCK_HEADER, int(least[row]), n, here.stop - here.start, int(widths[row]))
            out.append(head + packed[row] + places[here].tobytes() + exceptions[here].tobytes())
    return out


def unpack_block(image: memoryview | bytes, start: int) -> np.ndarray:
    """The ids of the block that starts at ``start``."""
    least, n, exceptions, width = struct.unpack_from(BLOCK_HEADER, image, start)
    at = start + struct.calcsize(BLOCK_HEADER)
    size = (n * width + 7) // 8
    wide = 16 if width <= 16 else 32
    spread = np.zeros((n, wide), np.uint8)
    if width:
        packed = np.frombuffer(image, np.uint8, size, at)
        spread[:, :width] = np.unpackbits(packed, count=n * width, bitorder="little").reshape(n, width)
    values = np.packbits(spread.ravel(), bitorder="little").view(f"<u{wide // 8}").astype("<u4")
    if exceptions:
        where = np.frombuffer(image, "<u2", exceptions, at + size)
        high = np.frombuffer(image, "<u4", exceptions, at + size + 2 * exceptions)
        values[where] |= high << np.uint32(width)
    return values + np.uint32(least)


def file_image(part: int, number: int, ids: np.ndarray, doc_ids: Sequence[int | None], counts: np.ndarray) -> bytes:
    """A whole file: the ``ids`` of consecutive documents, ``counts`` of them each."""
    blocks = pack_blocks(ids)
    head = struct.pack(HEADER, MAGIC, part, number)
    starts = len(head) + np.concatenate([[0], np.cumsum([len(b) for b in blocks], dtype=np.int64)])
    return b"".join(
        [
            head,
            *blocks,
            np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], "u1").tobytes(),
            np.asarray(counts, "<u8").tobytes(),
            starts[:-1].astype("<u8").tobytes(),
            struct.pack(TRAILER, len(ids), len(doc_ids), len(blocks), int(starts[-1]), MAGIC),
        ]
    )


class TokenFile:
    """Reads a file's image. Its block index gives any range of ids without unpacking the rest."""

    def __init__(self, image: bytes | memoryview):
        self.image = memoryview(image)
        end = len(self.image) - struct.calcsize(TRAILER)
        self.n_ids, self.n_docs, self.n_blocks, table, magic = struct.unpack_from(TRAILER, self.image, max(end, 0))
        opening, self.part, self.number = struct.unpack_from(HEADER, self.image, 0)
        if magic != MAGIC or opening != MAGIC:
            raise ValueError("not a whole token file")
        ids = np.frombuffer(self.image, "<i8", self.n_docs, table)
        missing = np.frombuffer(self.image, "u1", self.n_docs, table + 8 * self.n_docs)
        self.doc_ids = [None if m else int(d) for d, m in zip(ids, missing, strict=True)]
        self.counts = np.frombuffer(self.image, "<u8", self.n_docs, table + 9 * self.n_docs).astype(np.int64)
        self.starts = np.frombuffer(self.image, "<u8", self.n_blocks, table + 17 * self.n_docs).astype(np.int64)

    def ids(self, first: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``first`` to ``stop`` of the file. Only the blocks that hold them are unpacked."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if first >= stop:
            return np.zeros(0, np.uint32)
        blocks = range(first // BLOCK, (stop - 1) // BLOCK + 1)
        found = np.concatenate([unpack_block(self.image, int(self.starts[b])) for b in blocks])
        return found[first - blocks[0] * BLOCK : stop - blocks[0] * BLOCK]

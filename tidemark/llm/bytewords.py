"""Words of many texts at once, as places in one buffer of UTF-8 bytes, and their hashes.

A batch is cut into pieces of about a megabyte. A longer text is cut at the ends of words;
each of its parts but the first begins with the last word of the part before, so that no
pair of neighbours is lost, and says so.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES, PIECE_ROWS = 1 << 20, 512
LONG_WORD = 64  # words of more bytes are hashed one by one
FULL = np.uint32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


CRC = _crc_table()


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Which of the 256 byte values lie in one of the ranges, ends included."""
    found = np.zeros(256, bool)
    for low, high in ranges:
        found[low : high + 1] = True
    return found


def ascii_lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


@dataclass
class Piece:
    """Texts ``first`` to ``last`` of a batch, or a part of one text.

    ``goes_on``: the first word was the last one of the part before.
    """

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray
    goes_on: bool = False


def pieces(texts: pa.Array, inside: np.ndarray) -> Iterator[Piece]:
    """The pieces of a column of strings without nulls; ``inside`` tells the bytes of words."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + PIECE_BYTES, "right")) - 1
        last = min(max(end, row + 1), row + PIECE_ROWS, len(texts))
        part = data[offsets[row] : offsets[last]]
        if len(part) <= PIECE_BYTES:
            yield Piece(row, last, part, offsets[row : last + 1] - offsets[row])
        else:
            yield from _parts(row, part, inside)
        row = last


def _parts(row: int, text: np.ndarray, inside: np.ndarray) -> Iterator[Piece]:
    start, carried = 0, text[:0]
    while start < len(text):
        stop = start + PIECE_BYTES
        while stop < len(text) and inside[text[stop]]:  # to the end of the word
            outside = np.flatnonzero(~inside[text[stop : stop + PIECE_BYTES]])
            stop += int(outside[0]) if len(outside) else PIECE_BYTES
        # A part that is not the first starts with a byte between words.
        part = np.concatenate([carried, text[start:stop]])
        yield Piece(row, row + 1, part, np.array([0, len(part)]), len(carried) > 0)
        start, within = stop, np.flatnonzero(inside[part])
        if len(within):
            end = int(within[-1]) + 1
            before = np.flatnonzero(~inside[part[:end]])
            carried = part[int(before[-1]) + 1 if len(before) else 0 : end]


def words(piece: Piece, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row (from 0 in the piece), first byte and length of each word, in order."""
    data, bounds = piece.data, piece.bounds
    within = np.zeros(len(data) + 1, bool)
    within[:-1] = inside[data]
    begins, ends = within.copy(), within[:-1].copy()
    begins[1:] &= ~within[:-1]
    ends &= ~within[1:]
    begins[bounds[:-1]] = within[bounds[:-1]]
    stops = bounds[1:][bounds[1:] > 0] - 1
    ends[stops] = within[stops]
    start = np.flatnonzero(begins[:-1])
    length = np.flatnonzero(ends) + 1 - start
    return np.searchsorted(bounds, start, "right") - 1, start, length


def crc32(data: np.ndarray, start: np.ndarray, length: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """CRC-32 of each run of bytes, or of it after the bytes whose CRC-32 is ``before``."""
    order = np.argsort(-length, kind="stable")
    begin, size = start[order], length[order]
    state = np.full(len(order), FULL) if before is None else (before[order] ^ FULL).astype(np.uint32)
    big = int(np.searchsorted(-size, -LONG_WORD, "left"))
    for i in range(big):
        run = data[begin[i] : begin[i] + size[i]].tobytes()
        state[i] = np.uint32(zlib.crc32(run, int(state[i] ^ FULL))) ^ FULL
    for at in range(min(LONG_WORD, int(size[big]) if big < len(size) else 0)):
        live = int(np.searchsorted(-size, -at, "left"))
        now = state[big:live]
        state[big:live] = CRC[(now ^ data[begin[big:live] + at]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = state ^ FULL
    return out

"""Texts of an Arrow batch as indices into their distinct chunks, and values of chunks put in the place of the chunks.

A chunk is a run of separators (white space, or the space alone) and what follows it up to the next such run. Chunks are
slices of the texts' own buffer, so none is made as a Python string but the distinct ones, and each of these is looked at once per
strip.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of texts that are cut at a time.
STRIP = 8 << 20


def strips(texts: pa.Array, most: int = 0) -> Iterator[pa.Array]:
    """Slices of about `most` (STRIP) bytes, of one text at least."""
    most = most or STRIP
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    number = (np.cumsum(sizes) - sizes) // most
    edges = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(texts)]
    for a, z in zip(edges, edges[1:], strict=False):
        yield texts.slice(a, z - a)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each text begins and the last one ends."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if pa.types.is_large_string(texts.type) else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def space_before(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place is white space beyond ASCII."""
    one, two, three = raw[at - 1], raw[np.maximum(at - 2, 0)], raw[np.maximum(at - 3, 0)]
    short = (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    general = (two == 0x80) & ((one <= 0x8A) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF)) | (two == 0x81) & (one == 0x9F)
    return short | (three == 0xE2) & general | (three == 0xE1) & (two == 0x9A) & (one == 0x80) | (three == 0xE3) & (two == 0x80) & (one == 0x80)


def chunked(texts: pa.Array, white: bool = False) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The chunks of all texts in a row, and where those of each text begin and the last ones end. The texts must not be null.

    white: separators are the six ASCII characters of white space, and a run that starts with any other is not cut."""
    raw, ends = bytes_of(texts)
    space = raw == 32
    space |= ((raw >= 9) & (raw <= 13)) if white else False
    cut = np.zeros(len(raw) + 1, dtype=bool)
    at = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    if white:
        high = raw[at - 1] >= 0x80
        at = np.concatenate((at[~high], at[high][~space_before(raw, at[high])]))
    cut[at] = True
    cut[ends] = True
    cut[len(raw)] = False
    places = np.append(np.flatnonzero(cut), len(raw)) if len(raw) else np.zeros(1, np.int64)
    begins = np.searchsorted(places, ends)
    slices = pa.StringArray.from_buffers(len(places) - 1, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(raw))
    return slices.dictionary_encode(), begins


def binaries(raw: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """An array of byte strings that lie in a row; ends: where each begins and the last one ends."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(raw.view(np.uint8))])


def in_place(values: pa.LargeBinaryArray, chunks: pa.DictionaryArray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of all chunks in a row, as bytes, and where those of each text begin and the last ones end.

    values: one per distinct chunk."""
    all_ = values.take(chunks.indices)
    offsets = np.frombuffer(all_.buffers()[1], dtype=np.int64)[: len(all_) + 1] if len(all_) else np.zeros(1, np.int64)
    data = all_.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets[begins]

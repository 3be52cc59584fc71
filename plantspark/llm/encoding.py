"""Token ids of whole texts by a public tokenizer file.

A byte-pair tokenizer never merges across white space, so a text's ids are those of its chunks in a row: a run of white space
and what follows it. The chunks of a strip of an Arrow batch are found and told apart without making strings of them
(`chunks`); every distinct one is encoded once, and its ids are put wherever it stands. Simple chunks (Latin letters, figures and
signs) are split by the tokenizer's pattern in one pass over all of them, and their distinct parts merged together by the merges of its file
(`merges`); everything else takes the full path of the `tokenizers` library. Nothing is remembered from strip to strip.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from plantspark.llm.chunks import binaries, bytes_of, chunked, in_place, strips
from plantspark.llm.merges import Merges

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Fixed values. The split patterns of the two kinds of tokenizer, for chunks of simple characters; {0}: letters, {1}: figures.
BYTE_SPLIT = r" ?[{0}]+| ?[{1}]+| ?[^ \n{0}{1}]+"
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[{0}]+|[{1}]|[^ {0}{1}]+"
#: Simple characters: printable ones from the first letter behind the ASCII controls up to here; composition leaves them alone,
#: and case has no special rules but those of U+0130.
SIMPLE = "".join(map(chr, [*range(0x21, 0x7F), *range(0xA1, 0x130), *range(0x131, 0x250)]))


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in shown)
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def in_class(characters: Iterable[str]) -> str:
    """As part of a character class of a pattern."""
    return "".join(f"\\U{ord(c):08x}" for c in characters)


class Encoder:
    """Encodes texts to arrays of ids. path: a tokenizer file; the ids are those of encode(add_special_tokens=False)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.words = self.tokenizer.normalizer is not None  # lower case, white space dropped
        kinds = {k: in_class(c for c in SIMPLE if unicodedata.category(c)[0] == k) for k in "LN"}
        self.split = re.compile((WORD_SPLIT if self.words else BYTE_SPLIT).format(kinds["L"], kinds["N"]))
        # in a byte tokenizer an apostrophe may start a part
        simple = "".join(f"\\x{{{ord(c):x}}}" for c in (SIMPLE if self.words else SIMPLE.replace("'", "")))  # a pattern of Arrow
        self.simple = f"^[\t-\r ]*[{simple}]+$" if self.words else f"^ ?[{simple}]+$"
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        if model["type"] != "BPE" or model["ignore_merges"] or model["dropout"] or model["byte_fallback"]:
            raise ValueError(f"{path}: not a plain byte-pair model")
        ids, end = model["vocab"], model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.first = np.array([ids[letters[b]] for b in range(256)], dtype=np.int32)  # symbols of bytes
        self.last = np.array([ids[letters[b] + end] for b in range(256)], dtype=np.int32)  # at the end of a part
        self.merges = Merges({(ids[a], ids[b]): (ids[a + b], k) for k, (a, b) in enumerate(model["merges"])}, size)

    def simple_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks in a row, and how many each has."""
        if self.words:
            chunks = " ".join(chunks).lower().split()
        sizes = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        parts = self.split.findall((" " if self.words else "\n").join(chunks))  # no part holds the separator
        ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)))
        number = np.bincount(np.searchsorted(np.cumsum(sizes), ends), minlength=len(chunks))  # parts fill their chunks
        distinct = pa.array(parts, pa.string()).dictionary_encode()
        raw, places = bytes_of(distinct.dictionary)
        symbols = self.first[raw]
        symbols[places[1:] - 1] = self.last[raw[places[1:] - 1]]
        out, counts = self.merges.run(symbols, places[:-1], np.diff(places))
        ids = binaries(out, np.concatenate(([0], np.cumsum(counts))) * out.itemsize)
        flat, at = in_place(ids, distinct, np.concatenate(([0], np.cumsum(number))))
        return flat.view(out.dtype), np.diff(at) // out.itemsize

    def chunk_ids(self, chunks: pa.Array) -> pa.LargeBinaryArray:
        """Packed ids of each chunk."""
        simple = pc.match_substring_regex(chunks, self.simple).to_numpy(zero_copy_only=False)
        own, other = np.flatnonzero(simple), np.flatnonzero(~simple)
        names = chunks.to_numpy(zero_copy_only=False)  # strings
        counts = np.zeros(len(names), dtype=np.int64)
        ids, counts[own] = self.simple_ids(names[own].tolist()) if len(own) else (np.zeros(0, np.int32), 0)
        found = [e.ids for e in self.tokenizer.encode_batch(names[other].tolist(), add_special_tokens=False)]
        counts[other] = [len(x) for x in found]
        ends = np.concatenate(([0], np.cumsum(counts)))
        out = np.empty(int(ends[-1]), dtype=self.dtype)
        mine = np.repeat(simple, counts)
        out[mine] = ids
        out[~mine] = np.fromiter(chain.from_iterable(found), dtype=np.int64, count=int((~mine).sum()))
        return binaries(out, ends * self.dtype.itemsize)

    def encode_batch(self, texts: pa.Array, most: int = 0) -> Iterator[np.ndarray]:
        """The ids of each text of an Arrow array; null is empty. What comes is a view into the ids of a strip. most: as in strips."""
        for strip in strips(texts, most):
            chunks, begins = chunked(strip.fill_null(""), white=True)
            flat, at = in_place(self.chunk_ids(chunks.dictionary), chunks, begins)
            flat, at = flat.view(self.dtype), (at // self.dtype.itemsize).tolist()
            for a, z in zip(at, at[1:], strict=False):
                yield flat[a:z]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per task process and file."""
    return Encoder(path)

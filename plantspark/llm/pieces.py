"""Encoding to, and decoding from, the pieces of a SentencePiece vocabulary of the merge type.

Encoding. The text gets a space in front, and spaces become the space mark. Its characters are the first symbols. An agenda
holds every pair of adjacent symbols whose concatenation is a piece, the highest score first, the leftmost of equal ones; the
best pair is merged, its new neighbours enter the agenda, and pairs with symbols that are gone leave it. What is no piece at the
end becomes byte pieces.

No piece holds a character followed by the space mark unless that character is one too. So no merge crosses the start of a run of spaces,
and the chunks from there to the next are encoded by themselves, each distinct one once per strip of an Arrow batch. Nor does a merge join two
characters that are neighbours in no piece: between these a chunk falls into atoms. The agendas of all short atoms of a strip
advance together, a merge each per round (`merges`).

Decoding. Pieces are put in a row, byte pieces as bytes (what is not UTF-8 becomes U+FFFD), control pieces as nothing, the unknown
piece as its sign; space marks become spaces and the first space goes.

Checks. Every distinct chunk of a strip is encoded and decoded by the sentencepiece library as well; a difference is an error
that names the chunk. Vocabularies must leave texts as they are but for the spaces (no normalisation rules, spaces kept) and have byte
pieces; others are refused.

Defined cases: a null or empty text has the begin and end ids only and decodes to an empty text. A very long chunk is encoded in time
n log n. Nothing is remembered from strip to strip, so memory is the Arrow batch and one strip. Repeated ids and rows are encoded one by
one. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantspark.llm.chunks import binaries, chunked, in_place, strips
from plantspark.llm.common import map_texts
from plantspark.llm.merges import Merges

#: The mark of a space in pieces, and how the unknown piece is written in texts.
MARK, UNKNOWN = "▁", " ⁇ "
#: Chunks that the library checks at a time.
CHECKED = 50_000
#: Texts that a vocabulary must leave alone.
PROBES = ["ﬁ Ａ  x ", " \t\n é é İ ", "​﻿\x00\x7f", "½ ㍿ ﷺ"]


class PieceCoder:
    """path: a SentencePiece model file of the merge type."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = lib = SentencePieceProcessor(model_file=path)
        if any(lib.normalize(t) != MARK + t.replace(" ", MARK) for t in PROBES):
            raise ValueError(f"{path}: texts are normalised")
        size = lib.get_piece_size()
        kinds = [(i, lib.id_to_piece(i)) for i in range(size)]
        self.bytes = {int(p[1:-1], 16): i for i, p in kinds if lib.is_byte(i)}
        special = {i for i, _ in kinds if lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i)}
        self.ids = {p: i for i, p in kinds if i not in special}
        if len(self.bytes) != 256 or MARK not in self.ids or any(lib.is_unused(i) for i in range(size)):
            raise ValueError(f"{path}: not a vocabulary with byte pieces, the space mark and no unused pieces")
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError(f"{path}: pieces reach over spaces")
        shown = {i: p.encode() for p, i in self.ids.items()} | {i: bytes([b]) for b, i in self.bytes.items()}
        self.shown = shown | {i: b"" for i in special if lib.is_control(i)} | {lib.unk_id(): UNKNOWN.encode()}
        self.is_byte, self.silent = set(self.bytes.values()), {i for i in special if lib.is_control(i)}
        self.begin, self.end = lib.bos_id(), lib.eos_id()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.texts = pa.array([self.shown[i].replace(MARK.encode(), b" ") for i in range(size)], pa.large_binary())
        self.tables(size)

    def tables(self, size: int) -> None:
        """Characters as symbols, and the pairs of symbols that make a piece. Symbols are ids of pieces, and numbers from `size`
        for characters that occur in pieces without being one."""
        letters = sorted({c for p in self.ids if len(p) > 1 for c in p})
        extra = [c for c in letters if c not in self.ids]
        self.number = self.ids | {c: size + k for k, c in enumerate(extra)}
        self.extra_points = np.array([ord(c) for c in extra], dtype=np.int64)
        self.size, self.base = size, size + len(extra)
        self.symbol = np.full(0x110000, -1, dtype=np.int32)  # of a character; -1: in no piece
        self.letter = np.zeros(0x110000, dtype=np.int16 if len(letters) < 1 << 15 else np.int32)  # 0: neighbour of none
        for c, i in self.number.items():
            if len(c) == 1:
                self.symbol[ord(c)] = i
        for k, c in enumerate(letters, 1):
            self.letter[ord(c)] = k
        place = {c: k for k, c in enumerate(letters, 1)}
        self.neighbours = np.zeros((len(letters) + 1, len(letters) + 1), dtype=bool)
        pairs = {}
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                self.neighbours[place[p[k - 1]], place[p[k]]] = True
                left, right = self.number.get(p[:k]), self.number.get(p[k:])
                if left is not None and right is not None:
                    pairs[left, right] = i
        best_first = sorted({-self.library.get_score(i) for i in pairs.values()})  # equal scores have one rank
        rank = {x: k for k, x in enumerate(best_first)}
        self.merges = Merges({pair: (i, rank[-self.library.get_score(i)]) for pair, i in pairs.items()}, self.base)
        self.byte_ids = np.array([self.bytes[b] for b in range(256)], dtype=np.int32)

    def chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks in a row, and where those of each begin and the last ones end. Chunks: spaces, then other characters."""
        text = "".join(chunks.to_pylist()).replace(" ", MARK)
        points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.int32)
        ends = np.concatenate(([0], np.cumsum(pc.utf8_length(chunks).to_numpy(zero_copy_only=False))))
        if not len(points):
            return np.zeros(0, np.int32), ends
        letters = self.letter[points]
        cut = np.ones(len(points), dtype=bool)
        cut[1:] = ~self.neighbours[letters[:-1], letters[1:]]
        cut[ends[:-1]] = True
        starts = np.flatnonzero(cut)
        sizes = np.diff(np.append(starts, len(points)))
        known = self.symbol[points]
        first = np.where(known < 0, -points - 2, known)  # of a character in no piece: below -1
        out, counts = self.merges.run(first, starts, sizes)
        of_chunk = np.repeat(np.searchsorted(ends, starts, side="right") - 1, counts)
        return self.with_bytes(out, of_chunk, len(chunks))

    def with_bytes(self, symbols: np.ndarray, of_chunk: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols: those that are no piece become the pieces of their bytes."""
        missing = np.flatnonzero((symbols < 0) | (symbols >= self.size))
        lengths = np.ones(len(symbols), dtype=np.int64)
        points = symbols[missing].astype(np.int64)
        own = points >= 0
        points[own], points[~own] = self.extra_points[points[own] - self.size], -points[~own] - 2
        distinct, which = np.unique(points, return_inverse=True)
        raw = [chr(x).encode() for x in distinct.tolist()]
        lengths[missing] = np.array([len(x) for x in raw], dtype=np.int64)[which]
        at = np.cumsum(lengths) - lengths
        out = np.empty(int(lengths.sum()), dtype=np.int32)
        out[at] = symbols
        for k in range(4):
            byte = np.array([x[k] if k < len(x) else 0 for x in raw], dtype=np.int64)[which]
            some = lengths[missing] > k
            out[at[missing][some] + k] = self.byte_ids[byte[some]]
        return out, np.concatenate(([0], np.cumsum(np.bincount(of_chunk, weights=lengths, minlength=n).astype(np.int64))))

    def encode(self, text: str) -> list[int]:
        """Without begin and end ids."""
        ids, at, *_ = code_strip(self, pa.array([text]))
        return ids.tolist()

    def inside(self, ids: Iterable[int]) -> bytes:
        """The text of ids in the middle of others, with spaces."""
        out, run = [], []
        for i in ids:
            if i in self.is_byte:
                run.append(self.shown[i])
                continue
            if run:
                out.append(readable(b"".join(run)))
                run = []
            out.append(self.shown[i])
        if run:
            out.append(readable(b"".join(run)))
        return b"".join(out).replace(MARK.encode(), b" ")

    def decode(self, ids: Iterable[int]) -> str:
        ids = [i for i in ids if i not in self.silent]
        raw = self.inside(ids)
        starts = bool(ids) and ids[0] not in self.is_byte and raw.startswith(b" ") and ids[0] != self.library.unk_id()
        return raw[1 if starts else 0 :].decode()

    def chunk_values(self, chunks: pa.Array) -> tuple[pa.LargeBinaryArray, pa.LargeBinaryArray]:
        """Packed ids and decoded text of each chunk, after the library has said the same."""
        ids, at = self.chunk_ids(chunks)
        text = self.texts.take(pa.array(ids))
        places = np.frombuffer(text.buffers()[1], dtype=np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        data = text.buffers()[2]
        decoded = binaries(np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), places[at])
        for a in range(0, len(chunks), CHECKED):
            self.check(chunks[a : a + CHECKED], ids, at[a : a + CHECKED + 1], decoded[a : a + CHECKED])
        return binaries(ids.astype(self.dtype), at * self.dtype.itemsize), decoded

    def check(self, chunks: pa.Array, ids: np.ndarray, at: np.ndarray, decoded: pa.Array) -> None:
        """The library puts the first space itself, but not in front of nothing."""
        names = [c[1:] for c in chunks.to_pylist()]
        theirs = self.library.encode(names, num_threads=1)
        back = pc.binary_join_element_wise(pa.scalar(" "), pa.array(self.library.decode(theirs, num_threads=1), pa.string()), pa.scalar(""))
        mark = [self.ids[MARK]]
        theirs = [t if n else mark for t, n in zip(theirs, names, strict=True)]
        sizes = np.fromiter(map(len, theirs), dtype=np.int64, count=len(theirs))
        flat = np.fromiter(chain.from_iterable(theirs), dtype=np.int32, count=int(sizes.sum()))
        equal = np.array_equal(sizes, np.diff(at)) and np.array_equal(flat, ids[at[0] : at[-1]])
        if not equal or not decoded.equals(back.cast(pa.binary()).cast(pa.large_binary())):
            for k, n in enumerate(names):
                own = ids[at[k] : at[k + 1]].tolist()
                if own != theirs[k] or decoded[k].as_py() != back[k].as_py().encode():
                    raise ValueError(f"differs from the library: {' ' + n!r}: {own}, {theirs[k]}")


def readable(raw: bytes) -> bytes:
    """UTF-8, with the replacement character for each byte that is not."""
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        out = []
        while raw:
            try:
                out.append(raw.decode())
                break
            except UnicodeDecodeError as error:
                out += [raw[: error.start].decode(), "�"]
                raw = raw[error.start + 1 :]
        return "".join(out).encode()


@lru_cache(maxsize=1)
def coder(path: str) -> PieceCoder:
    """One per task process and file."""
    return PieceCoder(path)


def code_strip(own: PieceCoder, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids and decoded bytes of all texts in a row, each with the places where those of a text begin and the last ones end."""
    if pc.any(pc.match_substring(texts, MARK)).as_py():
        texts = pc.replace_substring(texts, MARK, " ")  # the mark is how the vocabulary writes a space
    some = pc.greater(pc.binary_length(texts), 0)
    texts = pc.if_else(some, pc.binary_join_element_wise(pa.scalar(" "), texts, pa.scalar("")), texts)
    chunks, begins = chunked(texts)
    ids, decoded = own.chunk_values(chunks.dictionary)
    flat, at = in_place(ids, chunks, begins)
    text, text_at = in_place(decoded, chunks, begins)
    return flat.view(own.dtype), at // own.dtype.itemsize, text, text_at


def coded(docs: DataFrame, model: str, id_column: str = "doc_id", text: str = "text", with_values: bool = True) -> DataFrame:
    """One row per document: id_column, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids (little-endian unsigned
    32-bit, with begin and end ids) and decoded."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))

    def make() -> Callable[[pa.Array], dict[str, pa.Array]]:
        own = coder(model)
        begin, end = (np.array([i], "<u4").tobytes() for i in (own.begin, own.end))

        def of_texts(texts: pa.Array) -> dict[str, pa.Array]:
            sizes, id_hashes, text_hashes, packed, decoded = [], [], [], [], []
            for strip in strips(texts.fill_null("")):
                flat, at, raw, raw_at = code_strip(own, strip)
                flat = flat.astype("<u4")
                for a, z, c, d in zip(at[:-1].tolist(), at[1:].tolist(), raw_at[:-1].tolist(), raw_at[1:].tolist(), strict=True):
                    ids, body = b"".join((begin, flat[a:z].tobytes(), end)), raw[c + 1 : d].tobytes()
                    sizes.append(z - a + 2)
                    id_hashes.append(sha256(ids).hexdigest())
                    text_hashes.append(sha256(body).hexdigest())
                    if with_values:
                        packed.append(ids)
                        decoded.append(body.decode())
            out = {"n_tokens": pa.array(sizes, pa.int64()), "ids_sha256": pa.array(id_hashes, pa.string()), "decoded_sha256": pa.array(text_hashes, pa.string())}
            return out | ({"ids": pa.array(packed, pa.binary()), "decoded": pa.array(decoded, pa.string())} if with_values else {})

        return of_texts

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * with_values
    return map_texts(rows, "text", make, schema, as_list=False).withColumnRenamed("id", id_column)


def restored(rows: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """Replaces a column of packed ids by the column `text`; null stays null."""

    def make() -> Callable[[pa.Array], dict[str, pa.Array]]:
        own = coder(model)

        def of_ids(packed: pa.Array) -> dict[str, pa.Array]:
            texts = [None if p is None else own.decode(np.frombuffer(p, "<u4").tolist()) for p in packed.to_pylist()]
            return {"text": pa.array(texts, pa.string())}

        return of_ids

    return map_texts(rows, ids, make, "text string", as_list=False)

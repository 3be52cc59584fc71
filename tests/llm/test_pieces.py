"""The coder of pieces against the library, on whole texts."""

import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor

from plantspark.llm import chunks, merges, pieces

#: Unicode white space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATH = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = [*"aA éÉß'' st  \n\t \xa0 　\x00\x1c\x85ǅ1²Ⅷ漢🙂éİſΣ▁▁.,-_<>", "<s>", "</s>", "<0x41>", "<unk>", "the", "ing", "  ", "  ", " \xa0 "]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(1)
    return ["".join(draw.choice(LETTERS) for _ in range(draw.randint(0, 60))) for _ in range(3000)]


def test_texts_as_the_library_codes_them(library, texts):
    own = pieces.PieceCoder(PATH)
    flat, at, raw, raw_at = pieces.code_strip(own, pa.array(texts))
    for k, t in enumerate(texts):
        want = library.encode(t)
        assert (k > 200 or own.encode(t) == want) and flat[at[k] : at[k + 1]].tolist() == want, repr(t)
        assert own.decode(want) == library.decode(want) == raw[raw_at[k] + 1 : raw_at[k + 1]].tobytes().decode()


def test_any_ids_decode_as_in_the_library(library):
    own, draw = pieces.PieceCoder(PATH), random.Random(2)
    known = [*range(0, 300), *[library.piece_to_id(x) for x in ("▁", "▁▁", "▁the", "s", "▁▁▁▁", "é")]]
    for _ in range(4000):
        ids = [draw.choice(known) if draw.random() < 0.7 else draw.randrange(32_000) for _ in range(draw.randint(0, 9))]
        assert own.decode(ids) == library.decode(ids), ids


def test_long_chunks(library):
    own, draw = pieces.PieceCoder(PATH), random.Random(3)
    for text in ("".join(draw.choice("abcdeinorst") for _ in range(20_000)), "ab" * 30_000, " " * 5000, "é漢" * 4000):
        assert own.encode(text) == library.encode(text)


def test_a_difference_is_an_error():
    own = pieces.PieceCoder(PATH)
    own.chunk_values(pa.array([" a", " the", " "]))
    own.merges.ranks[:-1][own.merges.made == own.ids["▁the"]] = merges.NONE
    with pytest.raises(ValueError, match="differs from the library: ' the'"):
        own.chunk_values(pa.array([" a", " the"]))


def test_the_heap_and_the_matrix_agree(monkeypatch, texts):
    own = pieces.PieceCoder(PATH)
    want = own.chunk_ids(pa.array([" " + t.replace(" ", "") for t in texts]))
    monkeypatch.setattr(merges, "WIDTHS", ())
    got = own.chunk_ids(pa.array([" " + t.replace(" ", "") for t in texts]))
    assert all(np.array_equal(a, b) for a, b in zip(want, got, strict=True))


def test_chunks_cover_the_texts(texts):
    for some in (pa.array(texts[:500]), pa.array(texts[:500]).slice(100, 50), pa.array([""]), pa.array(["", "", " ", ""]), pa.array([], pa.string())):
        found, begins = chunks.chunked(some, white=True)
        parts = found.to_pylist()
        for t, a, z in zip(some.to_pylist(), begins, begins[1:], strict=False):
            assert "".join(parts[a:z]) == t
            assert all(re.match(r"[\t-\r ]", y) and not re.search(f"[{SPACE}]$", x) for x, y in zip(parts[a:z], parts[a + 1 : z], strict=False))
            assert not any(re.search(f"[^{SPACE}][\t-\r ]", p) for p in parts[a:z])
        found, begins = chunks.chunked(some)
        parts = found.to_pylist()
        assert ["".join(parts[a:z]) for a, z in zip(begins, begins[1:], strict=False)] == some.to_pylist()
        assert all(" " not in p.lstrip(" ") for p in parts)
        values = found.dictionary.cast(pa.large_binary())
        raw, at = chunks.in_place(values, found, begins)
        assert [raw[a:z].tobytes().decode() for a, z in zip(at, at[1:], strict=False)] == some.to_pylist()
        assert sum(len(s) for s in chunks.strips(some, 300)) == len(some)


def test_operator(spark, odd, odd_rows, none, library, monkeypatch):
    monkeypatch.setattr(chunks, "STRIP", 2000)
    got = pieces.coded(odd, PATH)
    want = []
    for i, t, *_ in odd_rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        raw = np.array(ids, "<u4").tobytes()
        back = library.decode(ids)
        want.append((i, len(ids), sha256(raw).hexdigest(), sha256(back.encode()).hexdigest(), raw, back))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
    assert Counter((*r[:4], bytes(r[4]), r[5]) for r in got.collect()) == Counter(want)
    texts = pieces.restored(got.select("doc_id", "ids"), PATH).collect()
    assert Counter(map(tuple, texts)) == Counter((w[0], w[5]) for w in want)
    assert pieces.coded(none, PATH).count() == 0

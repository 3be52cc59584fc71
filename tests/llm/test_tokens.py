"""Packing and token files against plain encoding."""

import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from plantspark.llm import chunks, merges, packing, token_files
from plantspark.llm.encoding import Encoder
from plantspark.session import new_folder


def plain(name, texts, end):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return [e.ids + [end] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library(name, monkeypatch):
    draw = random.Random(1)
    letters = ["\u2003", " \u2003 ", "\xa0\n", *"aA éÉß'' st \n\t  　\x1c\x85ǅ1²Ⅷ漢🙂éİſΣς'll've.,-_", "<|endoftext|>", "  "]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 50))) for _ in range(1500)]
    encoder = Encoder(public_tokenizers.path(name))
    want = [ids[:-1] for ids in plain(name, texts, 0)]
    assert [ids.tolist() for ids in encoder.encode_batch(pa.array(texts))] == want
    monkeypatch.setattr(chunks, "STRIP", 200)
    some = [None, *texts[:100], None]
    got = [ids.tolist() for ids in encoder.encode_batch(pa.array(some).slice(1))]
    assert got == [*want[:100], []]


def test_packing_keeps_every_id_once(spark, odd, odd_rows):
    spec = packing.Packing(width=64, open_windows=4, least_cut=4)
    rows = packing.pack(odd, public_tokenizers.path("byte_bpe_50k.json"), spec=spec).toPandas()
    bodies = Counter()
    for _, text, *_ in odd_rows:
        bodies[tuple(plain("byte_bpe_50k.json", [text], 1)[0])] += 1
    assert rows["length"].sum() == sum(len(k) * n for k, n in bodies.items())
    for r in rows.itertuples():
        ids = np.frombuffer(r.ids, dtype="<u4")
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
    for _, g in rows.sort_values("offset").groupby("sequence_id"):
        assert g["offset"].tolist() == (g["length"].cumsum() - g["length"]).tolist() and g["length"].sum() <= 64
    used = rows.groupby("sequence_id")["length"].sum()
    assert used.sum() / (64 * len(used)) > 0.95
    whole = rows[rows["length"] == rows["doc_tokens"]]
    assert all(tuple(np.frombuffer(r.ids, dtype="<u4")) in bodies for r in whole.itertuples())


def test_packing_pieces_follow_each_other(spark):
    text = " ".join(f"w{i}" for i in range(3000))
    docs = spark.createDataFrame([(i, text[: i * 300]) for i in range(40)], "doc_id long, text string").repartition(8)
    rows = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), spec=packing.Packing(128, 2, 8)).toPandas()
    want = plain("byte_bpe_50k.json", [text[: i * 300] for i in range(40)], 1)
    for doc, g in rows.sort_values("start").groupby("doc_id"):
        assert np.concatenate([np.frombuffer(x, dtype="<u4") for x in g["ids"]]).tolist() == want[doc]


def test_packing_holds_a_small_strip():
    """Arrays beside the texts of a batch; one strip of these 14 MB took 49 MB and a copy of the batch, as it holds a null."""
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 9))) for _ in range(500)]
    texts = pa.array([None, *(" ".join(draw.choices(words, k=3000)) for _ in range(700))])
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(map(len, encoder.encode_batch(texts)))
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    most = 0
    for ids in encoder.encode_batch(texts, packing.STRIP):
        want -= len(ids)
        most = max(most, pa.total_allocated_bytes() - before)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert want == 0 and peak < 25e6 and most < 20e6, (peak, most)


def test_packing_of_nothing(none):
    assert packing.pack(none, public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_wavelet_matrix():
    draw = np.random.default_rng(2)
    for high in (1, 2, 7, 300, 70_000):
        ids = draw.integers(0, high, 1500).astype("<u4")
        content = token_files.to_file(token_files.WaveletMatrix.build(ids), [1500], 0, 0, 0, [1])
        matrix = token_files.from_file(content)[2]
        assert (matrix.decode() == ids).all()
        for i in draw.integers(0, 1500, 20).tolist():
            assert matrix.access(i) == ids[i]
            token = int(ids[i])
            assert matrix.count(token, i) == (ids[:i] == token).sum() and matrix.count(token) == (ids == token).sum()
            k = matrix.count(token, i)
            assert matrix.find(token, k) == i
        assert matrix.count(80_000) == 0 and matrix.find(int(ids[0]), 5000) is None


def test_token_files(spark, odd, odd_rows):
    folder = new_folder(spark, "test-files")
    path = public_tokenizers.path("word_bpe_49k.json")
    got = token_files.token_file_digests(odd, folder, path, shard_tokens=500).toPandas()
    ids = plain("word_bpe_49k.json", [r[1] for r in odd_rows], 2)
    want = Counter((-1 if r[0] is None else r[0], len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes())) for r, x in zip(odd_rows, ids, strict=True))
    assert Counter(zip(got["doc_id"].fillna(-1).astype(int), got["n_tokens"], got["ids_crc32"], strict=True)) == want
    got = got.sort_values("start")
    assert got["start"].tolist() == (got["n_tokens"].cumsum() - got["n_tokens"]).tolist()
    assert got["doc_id"].fillna(-1).is_monotonic_increasing


def test_token_files_of_nothing(spark, none):
    assert token_files.token_file_digests(none, new_folder(spark, "none"), public_tokenizers.path("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_equal_parts_are_merged_once(name, monkeypatch):
    """Chunks that differ in signs, case or the space before share their parts; each part is merged once a strip."""
    texts = [f" {a}{w}{z}" for w in ("straight", "Straight", "forward") for a in ("", "(", "-") for z in ("", ",", ".", ";", ")")] * 2
    encoder, merged = Encoder(public_tokenizers.path(name)), []
    run = encoder.merges.run
    monkeypatch.setattr(encoder.merges, "run", lambda symbols, starts, sizes: merged.append([tuple(symbols[a : a + n]) for a, n in zip(starts, sizes, strict=True)]) or run(symbols, starts, sizes))
    assert [ids.tolist() for ids in encoder.encode_batch(pa.array(texts))] == [ids[:-1] for ids in plain(name, texts, 0)]
    assert len(merged) == 1 and len(set(merged[0])) == len(merged[0]) < 25


@pytest.mark.parametrize("slots", [1, 4])
def test_pairs_are_found_in_the_table(slots, monkeypatch):
    """Also where many keys want one slot, and where the pair is not there or no pair at all."""
    monkeypatch.setattr(merges, "SLOTS", slots)
    monkeypatch.setattr(merges, "AT_ONCE", 100)
    draw = np.random.default_rng(5)
    made = {(int(a), int(b)): (int(a + b), k) for k, (a, b) in enumerate({(x, y) for x, y in draw.integers(0, 300, (4000, 2)).tolist()})}
    table = merges.Merges(made, 1000)
    symbols = draw.integers(-3, 320, 30_000).astype(np.int32)
    at = table.pairs_in_row(symbols)
    want = [made.get(x) for x in zip(symbols.tolist(), symbols[1:].tolist(), strict=False)]
    assert [(int(table.made[k]), int(table.ranks[k])) if k < len(made) else None for k in at[:-1].tolist()] == want
    assert at[-1] == len(made) and any(want) and not all(want)

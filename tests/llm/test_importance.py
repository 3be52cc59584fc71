"""Importance resampling against plain counting."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest

from plantspark.llm import importance


def plain(rows, target, longest=2, buckets=10_000, least=20, percent=25):
    def cut(text):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), Counter(crc32(f.encode()) % buckets for f in runs)

    docs, wanted = [cut(t) for _, t in rows], Counter()
    for t in target:
        wanted.update(cut(t)[1])
    every = Counter()
    for _, f in docs:
        every.update(f)
    s, t = sum(every.values()), sum(wanted.values())
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((every[b] + 1) * (t + buckets)))) for b in every}
    out = []
    for (i, _), (words, f) in zip(rows, docs, strict=True):
        n = sum(f.values())
        weight = sum(gain[b] * k for b, k in f.items()) // n if n else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, words, n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    can = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, -r[3], r[2], r[1]))
    most = percent * len(can) // 100
    ranked = [(*r, k if k <= most else None) for k, r in enumerate(can, 1)]
    return Counter(ranked + [(*r, None) for r in out if r[1] < least])


@pytest.mark.parametrize("options", [{}, {"longest": 3, "buckets": 77, "percent": 60}, {"longest": 1, "buckets": 70_000, "percent": 100}])
def test_resampling(spark, odd, odd_rows, options, monkeypatch):
    monkeypatch.setattr(importance, "STRIP", 3000)
    target = [odd_rows[9][1], odd_rows[12][1], None, "", "Word ﬀ É99 a-b", " - "]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = importance.resample(odd, table, **options)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == plain([(r[0], r[1]) for r in odd_rows], target, **options)


def test_strips_cut_words_as_whole_texts_do(odd_rows, monkeypatch):
    import pyarrow as pa

    texts = pa.array([r[1] or "" for r in odd_rows])
    whole = [x.tolist() for x in importance.features(texts, 2, 999)]
    monkeypatch.setattr(importance, "STRIP", 500)
    parts = [importance.features(t, 2, 999) for t in importance.strips(texts)]
    assert len(parts) > 5 and whole == [[y for p in parts for y in p[k].tolist()] for k in range(3)]


def test_buckets_are_handed_on_strip_by_strip(spark, monkeypatch):
    """The features of a whole Arrow batch never wait together for its last text."""
    import pyarrow as pa

    monkeypatch.setattr(importance, "STRIP", 500)
    monkeypatch.setattr(importance, "PORTION", 7)
    texts = [None, "", *(" ".join(f"w{i}x{k}" for k in range(30)) for i in range(100)), "a" * 2000, "b c"]
    ran = []

    class Rows:
        columns, schema = ["id", "text"], spark.createDataFrame([], "id long, text string").schema

        def mapInArrow(self, run, schema):
            ran.append(run)

    importance.bucketed(Rows(), "text", 2, 999)
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts})
    out = list(ran[0](iter([batch, batch.slice(3, 90)])))
    assert len(out) > 20 and max(len(b) for b in out) < 10
    whole, sizes, words = importance.features(pa.array([t or "" for t in texts]), 2, 999)
    first = pa.Table.from_batches(out)[: len(texts)].combine_chunks()
    assert first["id"].to_pylist() == list(range(len(texts)))
    assert first["n_features"].to_pylist() == sizes.tolist() and first["n_words"].to_pylist() == words.tolist()
    assert b"".join(first["buckets"].to_pylist()) == whole.astype("<u2").tobytes()
    assert sum(len(b) for b in out) == len(texts) + 90
    assert [len(b) for b in importance.portions(iter(out[:1] + [batch]))][-2:] == [7, len(texts) % 7]


def test_many_equal_rows(spark):
    """A third of the rows agree in id and text: their ranks follow each other, over many ranges."""
    same = " ".join(f"w{i}" for i in range(30))
    rows = [(5, same)] * 300 + [(i, f"{same} {i} {i % 7}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = importance.resample(docs, docs.filter("doc_id = 599"))
    assert Counter(map(tuple, got.collect())) == plain(rows, [rows[-1][1]])


def test_nothing(spark, none):
    assert importance.resample(none, none).count() == 0
    one = spark.createDataFrame([(1, "a b " * 12)], "doc_id long, text string")
    assert Counter(map(tuple, importance.resample(one, none, percent=100).collect())) == plain([(1, "a b " * 12)], [], percent=100)

"""Compression bands, language evidence, mixing, vectors and PPM against brute force."""

import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from plantspark.llm import compression, language_id, lm_scoring, mixing, vector_tree

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    text = text or ""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    five = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(five)
    repeats = {p for i, w in enumerate(five) if seen[w] > 1 for p in range(i, i + 5)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    failed = len(words) < 10 or 100 * len(repeats) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeats), failed)


def test_compression_counts(odd, odd_rows, none):
    got = compression.compression_bands(odd).collect()
    want = Counter((r[0], *base_counts(r[1])) for r in odd_rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)
    assert compression.compression_bands(none).count() == 0


def test_compression_verdicts(spark):
    draw = random.Random(2)
    vocabulary = ["".join(draw.choices("etaoinshrdlu", k=draw.randint(2, 9))) for _ in range(3000)]
    prose = " ".join(draw.choices(vocabulary, k=1500))
    noise = " ".join("".join(chr(draw.randrange(33, 0x2FF)) for _ in range(12)) for _ in range(400))
    varied = " ".join(f"{w}{i}" for i, w in enumerate(["same words again and again in this text"] * 300))
    mixed = prose[:4000] + varied
    rows = [(1, prose), (2, noise), (3, varied), (4, mixed)]
    got = {r.doc_id: r for r in compression.compression_bands(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].kept for i in (1, 2, 3, 4)] == [True, False, False, False]
    packer = zstandard.ZstdCompressor(level=3)
    assert got[1].zstd_ratio == len(packer.compress(prose.encode())) / len(prose.encode())
    assert got[4].n_bad_chunks >= got[4].n_chunks // 3


def test_long_english_is_inside_without_labels():
    for n, ratio in ((26_000, 0.368), (23_000, 0.364), (35_000, 0.359)):  # LGPL-2.1, GFDL-1.3, GPL-3
        assert compression.inside(n, ratio)


def test_compression_limits_follow_the_labels(spark):
    draw = random.Random(6)
    vocabulary = ["".join(draw.choices("etaoinshrdlu", k=draw.randint(2, 9))) for _ in range(90)]
    rows = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(200, 1400)))) for i in range(600)]
    docs = spark.createDataFrame([*rows, *[(1000 + i, rows[0][1]) for i in range(300)]], "doc_id long, text string")
    labels = [(i, 1) for i in range(400)] + [(0, 0), (450, None), (None, 1)] + [(1000 + i, 1) for i in range(300)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    without = {r.doc_id: r.kept for r in compression.compression_bands(docs).collect()}
    got = {r.doc_id: r for r in compression.compression_bands(docs, labels=labels).collect()}
    assert len(got) == len(without) == 900
    # the unlabelled are like the labelled
    assert np.mean([without[i] for i in range(400, 600)]) < 0.5 and np.mean([got[i].kept for i in range(400, 600)]) > 0.99
    bands = compression.fitted(docs, labels, "doc_id", "text", compression.Limits())
    assert {at for at in bands if bands[at] != compression.BANDS[at]} == {compression.length_class(got[i].n_bytes) for i in range(600)}
    assert compression.fitted(docs, labels.filter("doc_id < 20"), "doc_id", "text", compression.Limits()) == compression.BANDS


def test_compression_limits_come_from_all_labelled_texts(spark):
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(60)) for _ in range(50)]
    docs = spark.createDataFrame([(i * 9000, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.range(450_000).selectExpr("id as doc_id", "1 as quality")
    ratios = [r for r in compression.compression_bands(docs).collect()]
    by_class = {}
    for r in ratios:
        by_class.setdefault(compression.length_class(r.n_bytes), []).append(r.zstd_ratio)
    at, found = max(by_class.items(), key=lambda x: len(x[1]))
    tail, middle = np.quantile(found, [compression.TAIL, 0.5])
    want = compression.lower_limit(compression.BANDS[at][0], len(found), min(found), tail, middle)
    low = compression.fitted(docs, labels, "doc_id", "text", compression.Limits())[at][0]
    assert len(found) >= compression.FEWEST and abs(low - want) < 1e-12 and low != compression.BANDS[at][0]


def test_lower_limit_leaves_room():
    few, many = (compression.lower_limit(0.41, n, 0.466, 0.483, 0.513) for n in (100, 10_000))
    assert 0.41 <= few < many < 0.466  # under the smallest labelled, further where labels are few
    assert compression.lower_limit(0.41, 29, 0.466, 0.483, 0.513) == 0.41
    assert compression.lower_limit(0.41, 10_000, 0.40, 0.405, 0.43) < 0.40


def test_repeats_with_many_words():
    draw = random.Random(3)
    words = [str(draw.randrange(9000)) for _ in range(20_000)]
    words[700:706], words[15_000:15_006] = words[100:106], words[100:106]
    assert compression.repeated_words(words) == base_counts(" ".join(words))[4] > 0


def test_chunks_cover_the_text():
    for n in (0, 1, 99, 100, 149, 150, 1234):
        raw = os.urandom(n)
        assert b"".join(compression.chunks(raw, 100)) == raw


def test_language(spark, odd, odd_rows, none):
    out = language_id.identify(language_id.document_records(odd)).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in odd_rows)
    empty = [r for r in out if r.grams == 0]
    assert empty and not any(r.kept for r in empty) and all(r.language == "und" for r in empty)
    assert language_id.identify(language_id.document_records(none)).count() == 0


SYLLABLES = {"de": "der und sch ein ich ung zu".split(), "en": "the ing of th er on ed".split(), "es": "de que ción los ar ll ía".split(), "fr": "les eau tion ou é qu ai".split()}


def language_rows(n, seed, wrong=0.0, words=25):
    draw, rows = random.Random(seed), []
    for i in range(n):
        language = draw.choice(sorted(SYLLABLES))
        text = " ".join("".join(draw.choices(SYLLABLES[language], k=2)) for _ in range(words))
        said = draw.choice(sorted(SYLLABLES)) if draw.random() < wrong else language
        rows.append((i, text, said, f"www.{language}-site.{language}", language))
    return rows


def test_language_held_out(spark):
    rows = language_rows(400, 1, wrong=0.2)
    rows += [(1000 + i, "".join(chr(0x4E00 + random.Random(i).randrange(9000)) for _ in range(300)), None, None, "und") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, declared string, host string, truth string")
    got = language_id.identify(docs.drop("truth"), fit_rows=60).collect()
    truth = {r[0]: r[4] for r in rows}
    assert np.mean([r.language == truth[r.doc_id] for r in got]) > 0.99
    assert all(r.kept == (truth[r.doc_id] != "und") for r in got)


def test_host_decides_where_text_says_little(spark):
    rows = language_rows(300, 2) + [(900, "x", None, "www.fr-site.fr", ""), (901, "x", None, "new.de-site.de", ""), (902, "x", "es", None, "")]
    docs = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, declared string, host string")
    got = {r.doc_id: r.language for r in language_id.identify(docs).collect()}
    assert (got[900], got[901], got[902]) == ("fr", "de", "es")


def test_page_records(spark):
    html = '<!DOCTYPE html><HTML class=x lang="pt-BR"><script>var a="<p>no</p>";</script><!-- no --><p>Sim&nbsp;aqui</p></html>'
    rows = [(1, "https://u:p@Blog.Site.COM:8080/a?b#c", html), (2, "nothing", "plain"), (3, None, None)]
    got = {r.page_id: r for r in language_id.page_records(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert (got[1].declared, got[1].host, got[1].text.split()) == ("pt", "blog.site.com", ["Sim", "aqui"])
    assert (got[2].declared, got[2].host, got[2].text, got[3].text) == (None, None, "plain", None)


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        open_ = [s for s in order if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return {**share, **{s: 3.0 * sizes[s] for s in full}}
        full |= over


def test_mixing(spark, odd, odd_rows, none):
    draw = random.Random(9)
    rows = [(i, " ".join("w" for _ in range(draw.randint(0, 60))), draw.choice(["a"] * 6 + ["b", "ß", "Z", None, ""])) for i in range(1500)]
    rows += rows[:3] + [(5000, "w " * 40, "tiny"), (5001, None, "zero"), (None, "w w", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got, again = (mixing.mix(d, carry=["source"]).collect() for d in (docs, docs.repartition(2)))
    assert Counter(map(tuple, got)) == Counter(map(tuple, again)) and len(got) == len(rows)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
        largest[source] = max(largest[source], len((text or "").split()))
    targets = plain_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source]) and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 2 * largest[s] for s in sizes)
    assert Counter(r.doc_id for r in mixing.mix(odd).collect()) == Counter(r[0] for r in odd_rows)
    assert mixing.mix(none).count() == 0


def test_mixing_of_one_row_many_times(spark, monkeypatch):
    """Equal rows are dealt over blocks, whatever their number; reruns agree."""
    monkeypatch.setattr(mixing, "RUN", 50)
    rows = [(None, "a b c", "x")] * 1500 + [(i, "w " * (i % 9 + 1), "y") for i in range(300)] + [(7, "one two", "x")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    sized = mixing.copies_numbered(docs.select("doc_id", "text"))
    assert sorted(r._copy for r in sized.filter("text = 'a b c'").collect()) == list(range(1500))
    order = sized.filter("text = 'a b c'").select(mixing.F.xxhash64(mixing.F.lit(11), "doc_id", "_copy").alias("h"))
    assert order.distinct().count() == 1500
    got, again = (Counter(map(tuple, mixing.mix(d).collect())) for d in (docs, docs.repartition(7)))
    assert got == again and sum(got.values()) == len(rows)
    for target in {r[3] for r in got}:
        assert abs(sum(r[5] * n for r, n in got.items() if r[3] == target) - target) <= 10


def test_flight_keeps_totals_and_probabilities():
    sizes = np.random.default_rng(0).integers(1, 50, 40).astype(float)
    rows = np.vstack([np.ones(40), sizes])
    pi, hits = np.full(40, 0.3), np.zeros(40)
    for seed in range(400):
        draw = np.random.default_rng(seed)
        out = mixing.flight(pi, rows, draw)
        assert np.allclose(rows @ out, rows @ pi) and ((out > 0) & (out < 1)).sum() <= 2
        hits += mixing.land(out, sizes, draw)
    assert abs(hits / 400 - 0.3).max() < 0.1


def plain_neighbours(rows, k):
    good = [(i, v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v) and len(v) == 8]
    ids, m = np.array([i for i, _ in good]), np.array([v for _, v in good])
    out = {}
    for i, v in good:
        if i % 100 == 0:
            d = np.sqrt(((m - np.array(v)) ** 2).sum(axis=1))
            ok = np.flatnonzero(ids != i)
            out[i] = [(int(ids[j]), float(d[j])) for j in ok[np.lexsort((ids[ok], d[ok]))[:k]]]
    return out


@pytest.mark.parametrize("n", [3, 2500])
def test_vector_search(spark, n):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(20, 8))
    rows = [(i, (centres[i % 20] + draw.normal(size=8) * 0.3).astype("f4").tolist()) for i in range(n)]
    same = draw.normal(size=8).astype("f4").tolist()
    if n > 100:
        rows += [(10_000 + i, same) for i in range(600)]
        rows += [(20_000, None), (20_001, [0.0] * 8), (20_100, [float("nan")] * 8), (20_200, [1.0] * 7), (None, same), (20_300, [None] * 8), (20_400, [])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = defaultdict(list)
    for r in sorted(vector_tree.search(docs).collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(got[r["query_id"]]) + 1
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    want = plain_neighbours(rows, 10)
    assert {q: len(x) for q, x in got.items()} == {q: len(x) for q, x in want.items() if x}
    found = [len({i for i, _ in got[q]} & {i for i, _ in x}) / len(x) for q, x in want.items() if x]
    assert np.mean(found) >= 0.9
    assert got[10_000] == want[10_000] if n > 100 else got[0] == want[0]


def test_vector_search_finds_the_neighbours_it_is_calibrated_for(spark):
    m = np.random.default_rng(2).normal(size=(6400, 8)).astype("f4")  # no clusters, and no more queries than probes
    rows = [(i, v.tolist()) for i, v in enumerate(m)]
    got = defaultdict(set)
    for r in vector_tree.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect():
        got[r["query_id"]].add(r["vec_id"])
    want = plain_neighbours(rows, 10)
    assert len(want) <= vector_tree.PROBES
    assert np.mean([len(got[q] & {i for i, _ in x}) / len(x) for q, x in want.items()]) >= 0.97


def test_vector_search_of_nothing(spark):
    assert vector_tree.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def plain_ppm(trie_counts, context, symbol, order):
    """log10 probability by the definition, with sets."""
    seen, out = set(), 0.0
    for k in range(order, -1, -1):
        counts = trie_counts[k].get(context[len(context) - k :], {})
        free = {s: c for s, c in counts.items() if s not in seen}
        total = sum(free.values())
        if symbol in free:
            return out + math.log10((2 * free[symbol] - 1) / (2 * total))
        if free:
            out += math.log10(len(free) / (2 * total))
        seen |= set(counts)
    return out - math.log10(256 - len(seen))


def test_gram_counts_are_bounded(monkeypatch):
    """Counts stay right however small the runs are, and what waits is handed on early."""
    draw = random.Random(6)
    texts = [" ".join("".join(draw.choices("abcd", k=draw.randint(1, 6))) for _ in range(draw.randint(0, 90))) for _ in range(80)] + [None, ""]
    want = Counter()
    for t in texts:
        want.update(lm_scoring.grams([b" ".join(lm_scoring.tokens(t)) + b"\n"])[0].view(np.int64).tolist())
    monkeypatch.setattr(lm_scoring, "MOST_HELD", 500)
    monkeypatch.setattr(lm_scoring, "HANDED", 100)
    monkeypatch.setattr(lm_scoring, "COUNTED", 300)
    got, sizes = Counter(), []
    for rows in lm_scoring.count_grams(iter([pa.RecordBatch.from_pydict({"text": pa.array(texts[a : a + 7], pa.string())}) for a in range(0, len(texts), 7)])):
        sizes.append(rows.num_rows)
        for gram, n in zip(*(rows.column(i).to_pylist() for i in (0, 1)), strict=True):
            got[gram] += n
    assert got == want and max(sizes) <= 100 and len(sizes) > 10


def test_grams_of_one_pair_are_spread():
    """Contexts that end in one common pair of bytes go to many shards, all longer contexts of a triple to one."""
    keys = np.array([(a << 32 | b << 24 | 0x6865 << 8 | 0x20) for a in range(40) for b in range(97, 123)], dtype=np.uint64)  # "?he" + blank
    home = lm_scoring.in_shard(keys, 8)
    assert len(set(home.tolist())) == 8
    assert all(len(set(home[b::26].tolist())) == 1 for b in range(26))


@pytest.mark.parametrize("shard_grams", [3_000_000, 400])
def test_ppm(spark, odd, odd_rows, shard_grams, monkeypatch):
    monkeypatch.setattr(lm_scoring, "SHARD_GRAMS", shard_grams)
    if shard_grams == 400:
        monkeypatch.setattr(lm_scoring, "MOST_HELD", 3000)
        monkeypatch.setattr(lm_scoring, "AT_ONCE", 700)
        monkeypatch.setattr(lm_scoring, "COUNTED", 2000)
        monkeypatch.setattr(lm_scoring, "BUFFER", 9000)
    got = lm_scoring.ppm_scores(odd, hot_words=20).collect()
    lower = lambda t: [w.lower() for w in WORDS.findall(t or "")] if (t or "").isascii() else [w.translate({i: i + 32 for i in range(65, 91)}) for w in WORDS.findall(t or "")]
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 == 0 for r in odd_rows]
    words, tries = Counter(), [defaultdict(Counter) for _ in range(lm_scoring.ORDER + 1)]
    raws = [b"\n" * lm_scoring.ORDER + " ".join(lower(r[1])).encode() + b"\n" for r in odd_rows]
    for h, r, raw in zip(held, odd_rows, raws, strict=True):
        if not h:
            words.update([*lower(r[1]), "\n"])
            for i in range(lm_scoring.ORDER, len(raw)):
                for k in range(lm_scoring.ORDER + 1):
                    tries[k][raw[i - k : i]][raw[i]] += 1
    n, v, want = sum(words.values()), len(words), defaultdict(list)
    for h, r, raw in zip(held, odd_rows, raws, strict=True):
        tokens = [*lower(r[1]), "\n"]
        base = sum(math.log10((words[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        score = sum(plain_ppm(tries, raw[i - lm_scoring.ORDER : i], raw[i], lm_scoring.ORDER) for i in range(lm_scoring.ORDER, len(raw)))
        want[r[0]].append((h, len(tokens), sum(words[t] > 0 for t in tokens), n, base, score))
    found = defaultdict(list)
    for r in got:
        found[r.doc_id].append((r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score))
    assert set(found) == set(want)
    for i, rows in want.items():
        for a, b in zip(sorted(rows), sorted(found[i]), strict=True):
            assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9)


def test_ppm_probabilities_add_up():
    raw = [b"abracadabra\n", b"abc\n"]
    keys, _ = lm_scoring.grams(raw)
    tables = [np.unique(keys & lm_scoring.Trie.mask(k + 1), return_counts=True) for k in range(lm_scoring.ORDER + 1)]
    trie = lm_scoring.Trie(tables)
    for context in (b"\n" * 6, b"dabrac", b"zzzzab", b"zzzzzz"):
        every = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)], dtype=np.uint64)
        assert (10 ** trie.score(every)).sum() == pytest.approx(1.0)


def test_ppm_of_nothing(none, spark):
    assert lm_scoring.ppm_scores(none).count() == 0
    one = spark.createDataFrame([(None, "a b")], "doc_id long, text string")  # held out, so nothing is learnt
    row = lm_scoring.ppm_scores(one).first()
    assert row.held_out and row.train_tokens == 0 and row.score == pytest.approx(-4 * math.log10(256))


def test_documents_are_tokens_with_one_space_between(odd_rows, monkeypatch):
    texts = [r[1] for r in odd_rows] + [" a", "b ", "\x0b\x0cC  \r\nd\t", "A\x00Z\x1cÀ[@", None, ""]
    for size in (1, 200, 1 << 20):
        monkeypatch.setattr(lm_scoring, "COUNTED", size)
        parts = list(lm_scoring.documents_of(pa.array(["x", *texts], pa.string()).slice(1)))
        raw, lengths = lm_scoring.together(parts)
        ends = np.cumsum(lengths).tolist()
        want = [lm_scoring.tokens(t) for t in texts]
        assert [raw[z - n : z].tobytes() for z, n in zip(ends, lengths.tolist(), strict=True)] == [b" ".join(x) + b"\n" for x in want]
        words, owner = lm_scoring.words_of((raw, lengths))
        assert list(zip(owner.tolist(), words.to_pylist(), strict=True)) == [(i, w) for i, x in enumerate(want) for w in x]


def test_a_task_hands_on_a_gram_once_while_they_fit(monkeypatch):
    draw = random.Random(7)
    text = " ".join("".join(draw.choices("abcdefgh", k=5)) for _ in range(450))
    distinct = len(np.unique(lm_scoring.grams([b" ".join(lm_scoring.tokens(text)) + b"\n"])[0]))
    monkeypatch.setattr(lm_scoring, "MOST_HELD", 4000)
    monkeypatch.setattr(lm_scoring, "COUNTED", 3000)
    assert 2000 < distinct < 3000
    assert sum(b.num_rows for b in lm_scoring.count_grams(iter([pa.RecordBatch.from_pydict({"text": [text] * 5})] * 3))) == distinct


def test_words_are_counted_in_bounds(monkeypatch):
    draw = random.Random(8)
    texts = [" ".join("".join(draw.choices("abc", k=draw.randint(1, 6))) for _ in range(draw.randint(0, 80))) for _ in range(60)] + [None, "", " "]
    want = Counter(w for t in texts for w in lm_scoring.tokens(t))
    monkeypatch.setattr(lm_scoring, "MOST_WORDS", 300)
    monkeypatch.setattr(lm_scoring, "HANDED", 50)
    monkeypatch.setattr(lm_scoring, "COUNTED", 100)
    got, sizes = Counter(), []
    for rows in lm_scoring.count_words(iter([pa.RecordBatch.from_pydict({"text": pa.array(texts[a : a + 9], pa.string())}) for a in range(0, len(texts), 9)])):
        sizes.append(rows.num_rows)
        got.update(dict(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True)) if len(set(rows.column(0).to_pylist())) == rows.num_rows else {})
    assert got == want and max(sizes) <= 50 and len(sizes) > 10

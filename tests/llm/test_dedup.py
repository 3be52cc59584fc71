"""Line windows, suffix arrays and SimHash against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from plantspark.llm import line_dedup, simhash, suffix_dedup
from plantspark.llm.graph import components


def by_lines(rows):
    """rows: (id, text); later windows by (id, position), ids that repeat don't remove each other's."""
    first = {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        lines = [] if text is None else text.split("\n")
        for p in range(len(lines) - 2):
            first.setdefault(tuple(lines[p : p + 3]), i)
    out = []
    for i, text in rows:
        lines, gone, own = [] if text is None else text.split("\n"), set(), set()
        for p in range(len(lines) - 2):
            w = tuple(lines[p : p + 3])
            if first[w] != i or w in own:
                gone |= {p, p + 1, p + 2}
            own.add(w)
        kept = text if not gone else "\n".join(x for p, x in enumerate(lines) if p not in gone)
        out.append((i, len(lines), len(gone), kept))
    return Counter(out)


def test_line_windows(spark, odd, odd_rows):
    got = line_dedup.remove_repeated_windows(odd).select("doc_id", "n_lines", "n_removed", "text").collect()
    assert Counter(map(tuple, got)) == by_lines([(r[0], r[1]) for r in odd_rows])
    assert {"fp", "n", "lang"} <= set(line_dedup.remove_repeated_windows(odd).columns)


def test_line_windows_overlap(spark, none):
    draw = random.Random(3)
    rows = [(i, "\n".join(draw.choice("abc") for _ in range(draw.randint(0, 12)))) for i in range(60)]
    got = line_dedup.remove_repeated_windows(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_removed, r.text) for r in got) == by_lines(rows)
    assert line_dedup.remove_repeated_windows(none).count() == 0


def test_line_windows_of_rows_that_share_an_id(spark):
    draw, last = random.Random(8), 2**63 - 1
    ids = [None] * 30 + [5] * 10 + [6] * 10 + [last] * 5 + list(range(10, 20))
    rows = [(i, "\n".join(draw.choice("abcde") for _ in range(draw.randint(0, 9)))) for i in ids]
    rows += [(None, "p\nq\nr"), (None, "p\nq\nr\ns"), (None, "p\nq\nr"), (last, "t\nu\nv"), (None, "t\nu\nv"), (None, "w\nw\nx\nx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    keys = {(r.doc_id, r.text): (r._key_a, r._key_b) for r in line_dedup.with_key(docs).collect()}
    first, want = {}, []
    for at, row in enumerate(sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, keys[r]))):
        lines, gone = row[1].split("\n"), set()
        for p in range(len(lines) - 2):
            if first.setdefault(tuple(lines[p : p + 3]), (at, p)) != (at, p):
                gone |= {p, p + 1, p + 2}
        kept = "\n".join(x for p, x in enumerate(lines) if p not in gone) if gone else row[1]
        want += [(row[0], len(lines), len(gone), kept)] * rows.count(row)
    got = line_dedup.remove_repeated_windows(docs).select("doc_id", "n_lines", "n_removed", "text").collect()
    assert Counter(map(tuple, got)) == Counter(want)


def test_line_windows_plan_is_native(odd):
    plan = line_dedup.remove_repeated_windows(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def by_bytes(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r), dtype=bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int(np.diff(np.concatenate(([0], gone.astype(int)))).clip(0).sum())
        out.append((r, runs, bytes(b for b, g in zip(r, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("copies", [2, 3, 4, 6])
def test_few_suffixes_with_long_prefixes_are_compared_with_each_other(copies, monkeypatch):
    """Copies that differ late fall apart place by place; only groups of more than SMALL are sorted anew each time."""
    draw = np.random.default_rng(copies)
    passage = draw.integers(97, 123, 600).astype(np.uint8)
    bodies = [bytes(passage[: 500 - 70 * (k % 2)]) + bytes(draw.integers(97, 123, 300).astype(np.uint8)) for k in range(copies)]
    bodies += [bodies[0][:450], b"aaaa" * 150, b"aaaa" * 120 + b"b"]
    text = np.frombuffer(b"\xff".join(bodies) + b"\xff", dtype=np.uint8)
    sorts, lexsort = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: sorts.append(len(keys[0])) or lexsort(keys))
    order = suffix_dedup.suffix_array(text, suffix_dedup.words(text, 400), 400).tolist()
    assert sorted(order) == list(range(len(text)))
    heads = [bytes(text[i : i + 400]).ljust(400, b"\0") for i in order]
    assert heads == sorted(heads)
    assert copies > 2 or sum(sorts) < 100


def test_suffix_order_and_spans():
    draw = random.Random(3)
    for _ in range(120):
        length = draw.choice([3, 8, 11, 16])
        letters = draw.choice([b"ab", b"abc", bytes(range(255))])
        pieces = [bytes(draw.choice(letters) for _ in range(draw.randint(length, 60))) for _ in range(draw.randint(1, 8))]
        times = np.array([draw.choice([1, 1, 1, 2]) for _ in pieces])
        raw = b"\xff".join(pieces) + b"\xff"
        text = np.frombuffer(raw, dtype=np.uint8)
        order = suffix_dedup.suffix_array(text, suffix_dedup.words(text, -(-length // 8) * 8), length).tolist()
        assert sorted(order) == list(range(len(raw)))
        assert [raw[i : i + length] for i in order] == sorted(raw[i : i + length] for i in order)
        got = defaultdict(set)
        for p, a, z in suffix_dedup.repeated_spans(pieces, times, length):
            got[p] |= set(range(a, z))
        seen = Counter()
        for p, n in zip(pieces, times, strict=True):
            seen.update({p[i : i + length]: 0 for i in range(len(p) - length + 1)})
            for i in range(len(p) - length + 1):
                seen[p[i : i + length]] += int(n)
        for j, p in enumerate(pieces):
            assert got[j] == {x for i in range(len(p) - length + 1) if seen[p[i : i + length]] > 1 for x in range(i, i + length)}


def check_bytes(docs, rows, **options):
    got = suffix_dedup.remove_repeats(docs, **options).collect()
    want = by_bytes([r[1] for r in rows], options["length"])
    assert Counter((r.doc_id, bytes(r.raw), len(r.spans), bytes(r.kept)) for r in got) == Counter(
        (row[0], *w) for row, w in zip(rows, want, strict=True)
    )


def test_suffix_dedup(odd, odd_rows, none):
    check_bytes(odd, odd_rows, length=60, core=20, narrower=(8, 1))
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_suffix_dedup_splits_dense_cores(spark):
    """One passage in many surroundings, and many near copies: every core is dense, down to single windows."""
    draw = random.Random(5)
    word = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    passage, base = word(90), word(200)
    rows = [(i, word(draw.randint(0, 40)) + passage + word(draw.randint(0, 40))) for i in range(60)]
    for i in range(60, 120):
        at = draw.randrange(200)
        rows.append((i, base[:at] + "#" + base[at + 1 :]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check_bytes(docs, rows, length=50, core=16, dense=3, narrower=(8, 1))


def test_suffix_dedup_with_more_shards_than_repeats(spark):
    """Pieces fall into 40 shards, most without pieces or without a repeat."""
    draw = random.Random(9)
    word = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    long_, pair_ = word(100), word(70)
    rows = [(i, word(draw.randint(0, 90)) + (long_ if i < 30 else pair_ if i < 32 else "") + word(draw.randint(0, 30))) for i in range(60)]
    # neighbours share a core each, but never a whole window
    rows += [(100 + i, word(30) + x + word(30)) for i in range(20) for x in [word(25)] for _ in range(2)]
    rows += [(200, "z" * 300), (201, None), (202, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        check_bytes(docs, rows, length=50, core=16, dense=8, narrower=(8, 1))
        alone = [(i, word(30) + x + word(30)) for i in range(6) for x in [word(25)] for _ in range(2)]
        check_bytes(spark.createDataFrame(alone, "doc_id long, text string"), alone, length=50, core=16)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_long_text_in_segments(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 64)
    raw = b"abcdefghij" * 30 + bytes(random.Random(2).choices(b"abcdef", k=400)) + b"abcdefghij" * 10
    starts = [(a, z) for a, z, _ in suffix_dedup.pieces_of(raw, 40, 12)]
    assert [s for a, z in starts for s in range(a, z - 39)] == list(range(len(raw) - 39))
    for a, z, at in suffix_dedup.pieces_of(raw, 40, 12):
        assert a <= at and z - 40 <= at and at + 12 <= a + 40


def plain_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes)) if hashes else 0


def groups_of(prints, radius):
    parent = list(range(len(prints)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[top(i)] = top(j)
    return [top(i) for i in range(len(prints))]


def test_simhash(odd, odd_rows, none):
    got = simhash.simhash_groups(odd).collect()
    prints = [plain_print(r[1]) for r in odd_rows]
    tops = groups_of(prints, 2)
    least = defaultdict(list)
    for r, t in zip(odd_rows, tops, strict=True):
        least[t] += [] if r[0] is None else [r[0]]
    want = Counter((r[0], f"{p:016x}", min(least[t]) if least[t] else None) for r, p, t in zip(odd_rows, prints, tops, strict=True))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    assert simhash.simhash_groups(none).count() == 0


def test_links_in_dense_shards(spark):
    """Small limits force many packs and several rounds of blocks; components must be those of all pairs."""
    draw = random.Random(8)
    values = {draw.getrandbits(64) for _ in range(60)}
    for seed in list(values)[:3]:
        values |= {seed ^ sum(1 << draw.randrange(64) for _ in range(draw.randint(1, 3))) for _ in range(80)}
    values = sorted(values)
    nodes = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    for pack, dense in ((256, 4096), (5, 12)):
        roots = {r.node: r.root for r in components(simhash.links(nodes, 2, pack, dense)).collect()}
        tops = groups_of(values, 2)
        signed = [v - (1 << 64) if v >> 63 else v for v in values]
        got = Counter(frozenset(s for s in signed if roots.get(s, s) == r) for r in {roots.get(s, s) for s in signed})
        want = Counter(frozenset(s for s, t in zip(signed, tops, strict=True) if t == u) for u in set(tops))
        assert got == want


def test_tree_search():
    draw = random.Random(1)
    values = list({draw.getrandbits(16) for _ in range(300)})
    tree = simhash.BKTree(values)
    for q in values[:40] + [draw.getrandbits(16) for _ in range(40)]:
        assert sorted(tree.within(q, 3)) == [i for i, v in enumerate(values) if (v ^ q).bit_count() <= 3]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, x) for x in range(501, 560)] + [(900, 901), (901, 900), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(101)}, **{i: 500 for i in range(500, 560)}, 900: 900, 901: 900}

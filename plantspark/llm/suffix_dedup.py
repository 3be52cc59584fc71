"""Removal of repeated byte strings with suffix arrays built by two-stage sorting.

Every byte covered by a `length`-byte string that also starts anywhere else goes. All such strings (windows) of the
corpus are dealt into shards so that equal windows meet, and a shard finds its repeats with a suffix array.

Dealing. Of the CORE-byte strings in a window, the one with the smallest hash is its core; equal windows have equal
cores at equal places. Consecutive windows with one core make a piece of text; each window start lies in exactly one
piece. Only pieces whose core occurs twice in the corpus can hold a repeat. Equal pieces are combined, with their number,
before any text moves; the distinct pieces of a core go to one shard. A core with over DENSE distinct pieces (a passage
with many different surroundings) is dealt anew: its pieces are cut into narrower ones, whose windows share a longer core, at last
into single windows, which are equal if their cores are.

Sorting. The text of a shard is its pieces, each followed by a byte that no text has. Suffixes that are smaller than
their successors are sorted directly, to a depth of `length` bytes, and in small groups compared with each other; all others are induced: the buckets of the first byte are scanned in order, and
each suffix found puts its predecessor, if that is greater, at the end of what its bucket holds so far. Then common
prefixes of neighbours are computed; a window is repeated if a neighbour shares all its bytes or its piece occurs twice.
A shard holds about SHARD_BYTES.

Defined cases: null and empty texts have no bytes. Rows equal in id and text are two documents, so each repeats the other. Null and
repeated ids are allowed. A long text is cut into segments of SEGMENT windows while it is searched, which changes no
result. Other columns are not read. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantspark.llm.common import BROADCAST_KEYS, KEY, stored, with_key

LENGTH = 400
CORE = 128
DENSE = 128
#: Widths (windows a core can have) of the pieces of later rounds.
NARROWER = (16, 1)
#: Groups of up to so many suffixes with a common prefix are sorted by comparing each with each.
SMALL = 3
SEGMENT = 1 << 18
SHARD_BYTES = 1_000_000
RANGES = "array<struct<a: bigint, z: bigint>>"
ARROW_RANGES = pa.list_(pa.struct([("a", pa.int64()), ("z", pa.int64())]))
PARTS = ["up1", "up2", "at", "n", "core", "p1", "p2", "place", "size", "body"]
SEPARATOR = 0xFF  # in no UTF-8 text
#: Pieces, and with their texts, that a task holds before it hands them on.
ROWS, PARTS_HELD = 20_000, 2_000

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_powers: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for i, b in enumerate((BASE, inverse)):
            up = np.full(max(n + n // 4, 4096), b)
            up[0] = 1
            _powers[i] = np.cumprod(up, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every `width` bytes."""
    up, down = powers(len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)))
    h = (sums[width:] - sums[:-width]) * down[: len(data) - width + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def cores(data: np.ndarray, length: int, core: int) -> np.ndarray:
    """The place of the core of each window: the smallest hash, the first of equal ones."""
    width = length - core + 1
    h = rolling(data, core)
    n = len(h) - width + 1
    low = np.uint64((1 << 20) - 1)
    keys = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    padded = np.full(-(-len(h) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(h)] = keys
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(right[:n], left[width - 1 : width - 1 + n]) & low).astype(np.int64)


def pieces_of(raw: bytes, length: int, core: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, place of the core) of each piece of a text."""
    windows = len(raw) - length + 1
    for a in range(0, windows, SEGMENT):
        data = np.frombuffer(raw, dtype=np.uint8, offset=a, count=min(SEGMENT, windows - a) + length - 1)
        at = cores(data, length, core)
        first = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
        last = np.append(first[1:], len(at)) - 1 + length
        yield from zip((first + a).tolist(), (last + a).tolist(), (at[first] + a).tolist(), strict=True)


def signed(digest: int) -> int:
    return digest - (1 << 64) if digest >> 63 else digest


def pair(data: bytes) -> tuple[int, int]:
    digest = xxhash.xxh3_128_intdigest(data)
    return signed(digest >> 64), signed(digest & ((1 << 64) - 1))


def search_pieces(docs: DataFrame, length: int, core: int) -> DataFrame:
    """KEY, start, size, place (of the core in the piece), core, p1, p2 (hash of the piece)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for a, b, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                raw = body.as_py()
                for start, end, at in pieces_of(raw, length, core):
                    rows.append((a, b, start, end - start, at - start, signed(xxhash.xxh3_64_intdigest(raw[at : at + core])), *pair(raw[start:end])))
                if len(rows) > ROWS:
                    yield columns(rows)
                    rows = []
            if rows:
                yield columns(rows)

    def columns(rows: list[tuple]) -> pa.RecordBatch:
        data = np.array(rows, dtype=np.int64).T
        kinds = [np.int64, np.int64, np.int64, np.int32, np.int32, np.int64, np.int64, np.int64]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(k)) for c, k in zip(data, kinds, strict=True)], names=[*KEY, "start", "size", "place", "core", "p1", "p2"])

    rows = docs.select(*KEY, F.col("_raw")).filter(F.octet_length("_raw") >= length)
    return rows.mapInArrow(find, f"{KEY[0]} long, {KEY[1]} long, start long, size int, place int, core long, p1 long, p2 long")


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """True for suffixes that are smaller than the suffix after them; the last one is not."""
    step = np.sign(np.diff(text.astype(np.int16), append=-1))
    change = np.flatnonzero(step)
    following = change[np.searchsorted(change, np.arange(len(text)))]
    return step[following] > 0


def words(text: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes at each place as one number, in the order of the bytes; zeros after the end."""
    padded = np.concatenate((text, np.zeros(depth + 8, dtype=np.uint8))).astype(np.uint64)
    out = np.zeros(len(padded) - 7, dtype=np.uint64)
    for i in range(8):
        out = out << np.uint64(8) | padded[i : len(out) + i]
    return out


def greater_of_pairs(a: np.ndarray, b: np.ndarray, at: np.ndarray, word: np.ndarray, depth: int) -> np.ndarray:
    """Whether the bytes behind each place of a are greater than those behind b; both agree in the first `at` bytes."""
    greater = np.zeros(len(a), dtype=bool)
    open_, x, y, ends = np.arange(len(a)), a + at, b + at, a + depth
    while len(open_):
        left, right = word[x], word[y]
        greater[open_] = left > right
        same = np.flatnonzero(left == right)
        open_, x, y, ends = open_[same], x[same] + 8, y[same] + 8, ends[same]
        if len(open_) and (x >= ends).any():
            more = x < ends
            open_, x, y, ends = open_[more], x[more], y[more], ends[more]
    return greater


def sorted_directly(places: np.ndarray, word: np.ndarray, hashes: np.ndarray, depth: int) -> np.ndarray:
    """The places in the order of the `depth` bytes that follow. Places with equal hashes of these bytes are sorted as one."""
    _, one, which = np.unique(hashes[places], return_index=True, return_inverse=True)
    chosen = places[one]
    rank = np.zeros(len(chosen), dtype=np.int64)
    # the undecided ones, in order of what has been compared; equal so far: same group, numbered by its first rank
    open_, group = np.arange(len(chosen)), np.zeros(len(chosen), dtype=np.int64)
    pairs: list[tuple[np.ndarray, ...]] = []  # of small groups, which are compared at the end
    for at in range(0, depth, 8):
        if not len(open_):
            break
        key = word[chosen[open_] + at]
        head = np.concatenate(([True], group[1:] != group[:-1]))
        differ = np.concatenate(([False], key[1:] != key[:-1])) & ~head
        if not differ.any():
            continue
        number = np.cumsum(head) - 1
        mixed = np.zeros(number[-1] + 1, dtype=bool)
        mixed[number[differ]] = True
        part = np.flatnonzero(mixed[number])  # only groups that fall apart here are sorted
        order = np.lexsort((key[part], number[part])) if number[-1] else np.argsort(key[part])
        open_[part], key[part] = open_[part][order], key[part][order]
        new = head | np.concatenate(([True], key[1:] != key[:-1]))
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(key)))
        group = group + np.repeat(first, size) - np.flatnonzero(head)[number]
        rank[open_] = group
        for k in range(2, SMALL + 1):
            begin = first[size == k]
            for i, j in combinations(range(k), 2):
                pairs.append((open_[begin + i], open_[begin + j], np.full(len(begin), at + 8, dtype=np.int32)))
        left = np.repeat(size > SMALL, size)
        open_, group = open_[left], group[left]
    if pairs:
        a, b, at_ = map(np.concatenate, zip(*pairs, strict=True))
        greater = greater_of_pairs(chosen[a], chosen[b], at_, word, depth)
        rank += np.bincount(np.where(greater, a, b), minlength=len(rank))
    return places[np.argsort(rank[which], kind="stable")]


def suffix_array(text: np.ndarray, word: np.ndarray, depth: int) -> np.ndarray:
    """All places, ordered by the bytes that follow to a depth of at least `depth`."""
    small = smaller_than_next(text)
    tail = np.concatenate((text, np.zeros(depth, dtype=np.uint8)))
    direct = sorted_directly(np.flatnonzero(small), word, rolling(tail, depth), depth)
    bounds = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([len(text) - 1]))
    out = []
    for c in range(256):
        parts = [np.concatenate(waiting[c])] if waiting[c] else []
        while parts and len(parts[-1]):  # runs of this byte
            before = parts[-1] - 1
            before = before[before >= 0]
            parts.append(before[(text[before] == c) & ~small[before]])
        bucket = np.concatenate([*parts, direct[bounds[c] : bounds[c + 1]]])
        waiting[c] = []
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket - 1
        before = before[before >= 0]
        before = before[text[before] > c]
        by = text[before]
        before = before[np.argsort(by, kind="stable")]
        counts = np.bincount(by, minlength=256)
        ends = np.cumsum(counts)
        for d in np.flatnonzero(counts):
            waiting[d].append(before[ends[d] - counts[d] : ends[d]])
    return np.concatenate(out)


def common_prefixes(order: np.ndarray, word: np.ndarray, depth: int) -> np.ndarray:
    """Bytes that each place shares with the one before it in the order, up to `depth` (a multiple of 8); 0 for the first."""
    shared = np.zeros(len(order), dtype=np.int64)
    open_ = np.arange(1, len(order))
    for at in range(0, depth, 8):
        differ = word[order[open_] + at] ^ word[order[open_ - 1] + at]
        equal = differ == 0
        lead = sum((differ[~equal] < np.uint64(1 << 8 * k)).astype(np.int64) for k in range(1, 8))
        shared[open_[~equal]] = at + lead
        open_ = open_[equal]
        if not len(open_):
            break
    shared[open_] = depth
    return shared


def repeated_spans(pieces: list[bytes], times: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """(piece, start, end) of the bytes covered by windows found twice or more; merged within a piece."""
    end = bytes([SEPARATOR])
    text = np.frombuffer(end.join(pieces) + end, dtype=np.uint8)
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    owner = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes + 1)
    depth = -(-length // 8) * 8
    full = (begins + sizes)[owner] - np.arange(len(text)) >= length
    word = words(text, depth)
    order = suffix_array(text, word, length)
    order = order[full[order]]
    shared = common_prefixes(order, word, depth) >= length
    found = times[owner] > 1
    found[order[shared]] = True
    found[order[np.flatnonzero(shared) - 1]] = True
    del word, order, shared
    starts = np.flatnonzero(found & full)
    if not len(starts):
        return
    cut = np.flatnonzero((np.diff(starts) > length) | (np.diff(owner[starts]) > 0)) + 1
    for a, z in zip(starts[np.concatenate(([0], cut))], starts[np.append(cut, len(starts)) - 1], strict=True):
        p = owner[a]
        yield int(p), int(a - begins[p]), int(z - begins[p] + length)


def cut(body: bytes, place: int, width: int, narrow: int, length: int) -> Iterator[tuple[int, bytes, int, int, int]]:
    """Narrower pieces: (start in the piece, bytes, place of the core, width, size of the core)."""
    for low in range(0, width, narrow):
        high = min(low + narrow, width) - 1
        a, z = max(0, place - high), min(len(body) - length, place - low)
        if a <= z:
            yield a, body[a : z + length], place - low - a, high - low + 1, length - (high - low)


def spans_of(pieces: DataFrame, length: int, width: int, dense: int, narrower: tuple[int, ...]) -> DataFrame:
    """pieces: core, p1, p2, n, place, size, body; distinct. Returns p1, p2, ranges (of bytes that go), a row per piece."""
    spark = pieces.sparkSession
    sizes = pieces.groupBy("core").agg(F.count("*").alias("k"))
    dense_cores = stored(sizes.filter(F.col("k") > dense).select("core"), "suffix-dense") if narrower else None
    some = narrower and dense_cores.limit(1).count()
    thin = pieces.join(dense_cores, "core", "left_anti") if some else pieces
    total = thin.agg(F.sum("size")).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_BYTES))

    def sort(group: pa.Table) -> pa.Table:
        """The pieces with repeats; in many shards there are none."""
        group = group.sort_by([("p1", "ascending"), ("p2", "ascending")])
        found: dict[int, list[dict]] = {}
        for i, a, z in repeated_spans(group.column("body").to_pylist(), group.column("n").to_numpy(), length):
            found.setdefault(i, []).append({"a": a, "z": z})
        some = group.select(["p1", "p2"]).take(pa.array(list(found), pa.int64()))
        return some.append_column("ranges", pa.array(list(found.values()), ARROW_RANGES))

    shard = F.pmod(F.xxhash64("core"), F.lit(shards)).alias("shard")
    schema = f"p1 long, p2 long, ranges {RANGES}"
    out = stored(thin.select("p1", "p2", "n", "body", shard).groupBy("shard").applyInArrow(sort, schema), "suffix-spans")
    if not some:
        return out

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.int32(), pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=PARTS)

        for batch in batches:
            rows: list[tuple] = []
            for p1, p2, n, place_, whole in zip(*(batch.column(c) for c in ("p1", "p2", "n", "place", "body")), strict=True):
                for at, body, place, _, size in cut(whole.as_py(), place_.as_py(), width, narrower[0], length):
                    rows.append((p1.as_py(), p2.as_py(), at, n.as_py(), signed(xxhash.xxh3_64_intdigest(body[place : place + size])), *pair(body), place, len(body), body))
                if len(rows) > PARTS_HELD:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)

    wide = pieces.join(dense_cores, "core", "left_semi").select("p1", "p2", "n", "place", "body")
    names = "up1 long, up2 long, at long, n long, core long, p1 long, p2 long, place int, size int, body binary"
    parts = stored(wide.mapInArrow(narrow, names), "suffix-narrow")
    own = parts.groupBy("core", "p1", "p2").agg(
        F.sum("n").alias("n"), F.first("place").alias("place"), F.first("size").alias("size"), F.first("body").alias("body")
    )
    below = spans_of(stored(own, "suffix-pieces"), length, narrower[0], dense, narrower[1:])
    moved = F.transform("ranges", lambda r: F.struct((r["a"] + F.col("at")).alias("a"), (r["z"] + F.col("at")).alias("z")))
    back = parts.select("up1", "up2", "at", "p1", "p2").join(below, ["p1", "p2"]).select("up1", "up2", moved.alias("ranges"))
    back = together(back.withColumnsRenamed({"up1": "p1", "up2": "p2"}), ["p1", "p2"])
    return out.unionByName(stored(back, "suffix-back"))


def together(rows: DataFrame, by: list[str]) -> DataFrame:
    """Collects the ranges of each key (those of one text or piece) and merges them."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[{"a": a, "z": z} for a, z in merged([(r["a"], r["z"]) for r in x])] for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, ARROW_RANGES)], names=[*by, "ranges"])

    found = rows.groupBy(*by).agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    return found.mapInArrow(merge, f"{by[0]} long, {by[1]} long, ranges {RANGES}")


def merged(ranges: list) -> list[tuple[int, int]]:
    """Ranges that overlap or touch become one."""
    out: list[list[int]] = []
    for a, z in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, core: int = CORE,
                   dense: int = DENSE, narrower: tuple[int, ...] = NARROWER) -> DataFrame:
    """One row per document: id_column, raw (its bytes), spans (removed, as [from, to)), kept (the remaining bytes)."""
    keyed = with_key(docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text")), "_id", "_text")
    keyed = keyed.select(*KEY, "_id", F.coalesce(F.col("_text").cast("binary"), F.lit(b"")).alias("_raw"))
    found = stored(search_pieces(keyed, length, core), "suffix-search")
    twice = stored(found.groupBy("core").agg(F.count("*").alias("k")).filter("k > 1").select("core"), "suffix-twice")
    found = stored(found.join(twice, "core"), "suffix-found")
    own = found.groupBy("core", "p1", "p2").agg(
        F.count("*").alias("n"), F.min("size").alias("size"), F.min("place").alias("place"),
        F.min_by("start", KEY[0]).alias("start"), F.min_by(KEY[1], KEY[0]).alias(KEY[1]), F.min(KEY[0]).alias(KEY[0]),
    )
    own = stored(own, "suffix-distinct")
    texts = having(keyed, own.select(*KEY).distinct(), "suffix-keys")
    body = F.substring("_raw", F.col("start").cast("int") + 1, F.col("size")).alias("body")
    pieces = stored(texts.join(own, KEY).select("core", "p1", "p2", "n", "place", "size", body), "suffix-pieces")
    spans = spans_of(pieces, length, length - core + 1, dense, narrower)

    moved = F.transform("ranges", lambda r: F.struct((r["a"] + F.col("start")).alias("a"), (r["z"] + F.col("start")).alias("z")))
    ranges = found.select(*KEY, "start", "p1", "p2").join(spans, ["p1", "p2"]).select(*KEY, moved.alias("ranges"))
    ranges = stored(together(ranges, KEY), "suffix-ranges")

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        for batch in batches:
            spans_, kept = [], []
            for body_, ranges_ in zip(batch.column(1), batch.column(2), strict=True):
                goes = [(r["a"], r["z"]) for r in ranges_.as_py()]
                body_ = body_.as_py()
                edges = [0, *[x for s in goes for x in s], len(body_)]
                kept.append(b"".join(body_[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True)))
                spans_.append([{"from": a, "to": z} for a, z in goes])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans_, kind), pa.array(kept, pa.binary())], names=["_id", "_raw", "spans", "kept"])

    kind = keyed.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, _raw binary, spans array<struct<from: long, to: long>>, kept binary"
    some = having(keyed, ranges.select(*KEY), "suffix-keys").join(ranges, KEY).select("_id", "_raw", "ranges").mapInArrow(cut_out, schema)
    whole = without(keyed, ranges.select(*KEY)).select(
        "_id", "_raw", F.array().cast("array<struct<from: bigint, to: bigint>>").alias("spans"), F.col("_raw").alias("kept")
    )
    return whole.unionByName(some).select(F.col("_id").alias(id_column), F.col("_raw").alias("raw"), "spans", "kept")


def having(rows: DataFrame, keys: DataFrame, label: str) -> DataFrame:
    """The rows with one of the keys; these are broadcast if they are few, so that only such rows are shuffled later."""
    keys = stored(keys, label)
    return rows.join(F.broadcast(keys), KEY, "left_semi") if keys.count() <= BROADCAST_KEYS else rows


def without(rows: DataFrame, keys: DataFrame) -> DataFrame:
    few = keys.count() <= BROADCAST_KEYS
    return rows.join(F.broadcast(keys) if few else keys, KEY, "left_anti")


"""SimHash near-duplicates: fingerprints of word shingles, linked through BK-trees.

Fingerprints: A-Z lower-cased, words, overlapping shingles joined by one space, XXH64 with seed 42 of each, and per bit
the majority. Two fingerprints that differ in at most d bits agree in at least one of d + 1 blocks of bits, so the
distinct fingerprints are sharded by (block, its value). A shard's fingerprints are cut into packs of about PACK; each
pack becomes a BK-tree (children keyed by their integer Hamming distance to the parent), and the trees go to
all packs of their shard, whose fingerprints follow only the edges within the radius. A shard with more than DENSE
fingerprints is first sharded anew by blocks of the bits that are still free, in which the same argument holds, so no
shard compares more than DENSE fingerprints with each other unless they agree in all but d + 1 bits.

Trees reach the packs of their shard by a shuffle join. A Spark broadcast would lead all fingerprints of the corpus through the
driver. Only a spanning forest of the links of two packs is returned, never all pairs; the components of
these links are the components of all links.

Defined cases: a null or empty text has fingerprint zero, and all of those are linked like any other. Fewer words than the
shingle length: the whole sequence is the one shingle. Rows are kept one by one; repeated rows share a component. A null id
is never the smallest unless no other is there. Empty tables give empty results; only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantspark.llm.common import map_texts, stored
from plantspark.llm.graph import components

BITS = 64
PACK = 256
DENSE = 4096
SEED = 42


def fingerprint(text: str | None, width: int) -> int:
    """Unsigned 64-bit SimHash; bit j is set if it is set in over half of the shingles' hashes."""
    # of bytes, `lower` changes A-Z only and `split` cuts at the six white-space characters
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)], dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    major = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(major, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str, text: str, width: int, carry: list[str]) -> DataFrame:
    """id_column, the columns to carry, fp (the fingerprint as a signed long)."""

    def make():
        def prints(texts: list) -> dict[str, pa.Array]:
            return {"fp": pa.array(np.array([fingerprint(t, width) for t in texts], dtype=np.uint64).view(np.int64))}

        return prints

    return map_texts(docs.select(id_column, *carry, F.col(text).alias("_text")), "_text", make, "fp long")


class BKTree:
    """A tree of distinct integers; the child at distance d of a node holds all that differ from it in d bits."""

    def __init__(self, values: list[int]):
        self.values, self.children = values, [{} for _ in values]
        for i in range(1, len(values)):
            at = 0
            while True:
                d = (values[i] ^ values[at]).bit_count()
                below = self.children[at].setdefault(d, i)
                if below == i:
                    break
                at = below

    def within(self, query: int, radius: int) -> list[int]:
        """Positions of the values that differ from the query in at most `radius` bits."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (query ^ self.values[at]).bit_count()
            if d <= radius:
                found.append(at)
            edges = self.children[at]
            todo += [edges[k] for k in range(d - radius, d + radius + 1) if k in edges]
        return found


def forest(left: list[int], right: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links between the tree of `left` and the queries of `right`, and within equal packs."""
    tree, parent = BKTree(left), {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for query in right:
        for at in tree.within(query, radius):
            a, b = top(query), top(left[at])
            if a != b:
                parent[a] = b
                yield query, left[at]


def blocks(free: list[tuple[int, int]], count: int) -> list[list[tuple[int, int]]]:
    """Cuts the free bits, given as ranges [from, to), into `count` blocks of nearly equal size."""
    bits = [b for a, z in free for b in range(a, z)]
    cuts = [len(bits) * i // count for i in range(count + 1)]
    out = []
    for a, z in zip(cuts, cuts[1:], strict=False):
        ranges: list[list[int]] = []
        for b in bits[a:z]:
            if ranges and ranges[-1][1] == b:
                ranges[-1][1] += 1
            else:
                ranges.append([b, b + 1])
        out.append([(r[0], r[1]) for r in ranges])
    return out


def masked(ranges: list[tuple[int, int]]) -> Column:
    mask = sum(((1 << (z - a)) - 1) << a for a, z in ranges)
    return F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long"))


def links(nodes: DataFrame, radius: int, pack: int = PACK, dense: int = DENSE) -> DataFrame:
    """nodes: fp, distinct. Returns edges a, b whose components are those of all pairs within the radius."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for left, right in zip(batch["left"], batch["right"], strict=True):
                found += forest((np.asarray(left).astype(np.uint64)).tolist(), np.asarray(right).astype(np.uint64).tolist(), radius)
            yield pd.DataFrame(np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64), columns=["a", "b"])

    edges: DataFrame | None = None
    rows = nodes.select("fp", F.lit("").alias("path"), F.lit(0).cast("long").alias("agreed"))
    paths: list[tuple[str, list[tuple[int, int]]]] = [("", [(0, BITS)])]
    while True:
        choices, following = [], []
        for path, free in paths:
            for i, block in enumerate(blocks(free, radius + 1)):
                rest = [b for j, other in enumerate(blocks(free, radius + 1)) if j != i for b in other]
                new = f"{path}{i}"
                following.append((new, rest))
                choices.append(F.when(F.col("path") == path, F.struct(F.lit(new).alias("path"), F.col("agreed").bitwiseOR(masked(block)).alias("agreed"))))
        exploded = rows.select("fp", F.explode(F.array_compact(F.array(*choices))).alias("s")).select("fp", "s.*")
        sizes = exploded.groupBy("path", "agreed").agg(F.count("*").alias("n")).filter("n > 1")
        shards = stored(exploded.join(sizes, ["path", "agreed"]), "simhash-shards")
        last = min(sum(z - a for a, z in rest) for _, rest in following) <= 2 * (radius + 1)
        small = shards if last else shards.filter(F.col("n") <= dense)
        packs = small.withColumn("pack", F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / pack)))
        packs = stored(packs.groupBy("path", "agreed", "pack").agg(F.collect_list("fp").alias("fps")), "simhash-packs")
        trees = packs.select("path", "agreed", F.col("pack").alias("tree"), F.col("fps").alias("left"))
        met = trees.join(packs.withColumnRenamed("fps", "right"), ["path", "agreed"]).filter("tree <= pack").select("left", "right")
        found = stored(met.mapInPandas(search, "a long, b long"), "simhash-links")
        edges = found if edges is None else edges.unionByName(found)
        rows = shards.filter(F.col("n") > dense).select("fp", "path", "agreed")
        if last or not rows.limit(1).count():
            return edges
        paths = following


def simhash_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 3, radius: int = 2,
                   pack: int = PACK, dense: int = DENSE, carry: list[str] = ()) -> DataFrame:
    """One row per document: id_column, fingerprint (16 hex digits), component_id (smallest id reachable), root (a number
    of the component, also where ids repeat), and the columns named in `carry`."""
    prints = stored(fingerprints(docs, id_column, text, width, list(carry)), "simhash-prints")
    nodes = stored(prints.groupBy("fp").agg(F.min(id_column).alias("_least")), "simhash-nodes")
    roots = components(links(nodes.select("fp"), radius, pack, dense))
    placed = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "_least", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("_least").alias("component_id"))
    groups = placed.select("fp", "root").join(least, "root")
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(groups, "fp").select(id_column, shown, "component_id", "root", *carry)

"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree is fitted on a bounded sample (about SAMPLE vectors, chosen by a hash): k-means with BRANCHES centres, and again within each
cluster until a cluster has under LEAF vectors of the sample. Every row is then put into the leaf that the
nearest centres lead to. A query walks the tree best bin first: a priority queue holds nodes by the distance of their centres, the
nearest is taken, its children are queued, and each leaf taken is a visit.

How many leaves a query visits is calibrated: for some queries the true neighbours are found by brute force over all rows (these
queries, a fixed number, against blocks of rows), and the visits are widened until `recall` of them would be found. The
search itself joins queries and vectors by leaf, both cut into blocks, so that a leaf with a third of all rows is
spread over many tasks. Each block gives its nearest vectors per query, and those are ranked.

Defined cases: rows whose id is null, or whose vector is null, zero, of another length than most, or holds null or non-finite
components take no part. Rows with the query's id are no candidates for it; equal rows are one query and as many
candidates. Ties go to the smaller id. With fewer candidates than asked for, all are returned, which needs all leaves to
be visited, so then every leaf is. Other columns are not read. Empty tables give empty results.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantspark.llm.common import stored

SAMPLE = 32_768
BRANCHES = 16
LEAF = 256
#: Queries of the calibration.
PROBES = 64
SMALLEST_BLOCK, LARGEST_BLOCK = 64, 16_384
#: Rows that a task hands on at a time when it lists the leaves of queries.
AT_ONCE = 4096


@dataclass
class Tree:
    """children[i]: nodes below node i, empty for a leaf; centres[i]: centre of node i."""

    centres: np.ndarray
    children: list[list[int]]

    @classmethod
    def fit(cls, sample: np.ndarray, seed: int = 5) -> Tree:
        draw, centres, children, todo = np.random.default_rng(seed), [sample.mean(axis=0)], [[]], [(0, sample)]
        while todo:
            node, rows = todo.pop()
            if len(rows) < LEAF:
                continue
            label, found = k_means(rows, min(BRANCHES, len(rows)), draw)
            if len(found) < 2:  # all rows are equal
                continue
            for i, centre in enumerate(found):
                children[node].append(len(centres))
                todo.append((len(centres), rows[label == i]))
                centres.append(centre)
                children.append([])
        return cls(np.array(centres), children)

    @property
    def leaves(self) -> int:
        return sum(not c for c in self.children)

    def place(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out, todo = np.zeros(len(rows), dtype=np.int64), [(0, np.arange(len(rows)))]
        while todo:
            node, which = todo.pop()
            below = self.children[node]
            if not below:
                out[which] = node
                continue
            nearest = squared(rows[which], self.centres[below]).argmin(axis=1)
            todo += [(child, which[nearest == i]) for i, child in enumerate(below) if (nearest == i).any()]
        return out

    def visit(self, query: np.ndarray, most: int) -> list[int]:
        """The first leaves of a best-bin-first walk."""
        queue, found = [(0.0, 0)], []
        while queue and len(found) < most:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                found.append(node)
                continue
            for child, d in zip(below, ((self.centres[below] - query) ** 2).sum(axis=1), strict=True):
                heapq.heappush(queue, (float(d), child))
        return found


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances, good enough to choose centres."""
    return (a * a).sum(axis=1)[:, None] - 2 * a @ b.T + (b * b).sum(axis=1)


def k_means(rows: np.ndarray, k: int, draw: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Labels and centres; empty clusters are dropped."""
    centres = np.unique(rows[draw.choice(len(rows), k, replace=False)], axis=0)
    for _ in range(rounds):
        label = squared(rows, centres).argmin(axis=1)
        used, label = np.unique(label, return_inverse=True)
        centres = np.array([rows[label == i].mean(axis=0) for i in range(len(used))])
    label = squared(rows, centres).argmin(axis=1)
    used, label = np.unique(label, return_inverse=True)
    return label, centres[used]


def distances(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, one query at a time."""
    return np.array([np.sqrt(((rows - q) ** 2).sum(axis=1)) for q in queries]).reshape(len(queries), len(rows))


def matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def nearest(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> Iterator[tuple]:
    """(position of the query, id, score) of the k nearest rows of each query, without rows that have its id."""
    for at, (own, d) in enumerate(zip(query_ids, distances(queries, rows), strict=True)):
        ok = np.flatnonzero(ids != own)
        best = ok[np.lexsort((ids[ok], d[ok]))[:k]]
        for i in best:
            yield at, int(ids[i]), float(d[i])


def valid(table: DataFrame, id_column: str, vector: str) -> DataFrame:
    """id, vec (array of doubles, or of floats where the table has them) of the rows that take part."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    single = table.schema[vector].dataType.simpleString() == "array<float>"
    vec = F.col(vector) if single else F.col(vector).cast("array<double>")
    rows = table.select(F.col(id_column).cast("long").alias("id"), vec.alias("vec"))
    rows = rows.filter("id is not null and vec is not null").filter(~F.exists("vec", bad) & F.exists("vec", lambda x: x != 0))
    common = rows.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("k")).orderBy(F.desc("k"), "n").first()
    return rows.filter(F.size("vec") == (common["n"] if common else 0))


def search(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding", every: int = 100, k: int = 10,
           recall: float = 0.97) -> DataFrame:
    """Queries are the rows whose id is divisible by `every`: query_id, rank, vec_id, score."""
    spark = table.sparkSession
    kept = stored(valid(table, id_column, vector), "vectors")
    n = kept.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if n == 0:
        return spark.createDataFrame([], schema)
    order = F.xxhash64("id", "vec")
    share = F.pmod(order, F.lit(1 << 30)) < int(min(1.0, SAMPLE / n) * (1 << 30))  # about SAMPLE rows, whatever n is
    kind = kept.schema["vec"].dataType.simpleString()
    tree = Tree.fit(matrix(kept.filter(share).toPandas().sort_values("id", kind="stable")["vec"]))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(leaf=tree.place(matrix(batch["vec"])))

    placed = stored(kept.mapInPandas(place, f"id long, vec {kind}, leaf long"), "vectors-placed")
    queries = placed.filter(F.col("id") % every == 0).select("id", "vec").distinct()
    visits = calibrated(placed, queries.orderBy(order).limit(PROBES).toPandas(), tree, k, recall)
    if n <= k * tree.leaves // max(1, visits):  # so few rows that the visited leaves may hold under k
        visits = tree.leaves

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = max(1, AT_ONCE // visits)
        for batch in batches:
            for i in range(0, len(batch), step):
                part = batch.iloc[i : i + step]
                found = part.assign(leaf=[tree.visit(q, visits) for q in matrix(part["vec"])])
                yield found.explode("leaf").astype({"leaf": "int64"})

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    block = max(SMALLEST_BLOCK, min(LARGEST_BLOCK, n // (2 * parts)))
    asked = stored(queries.mapInPandas(walk, f"id long, vec {kind}, leaf long"), "vectors-asked")
    sizes = placed.groupBy("leaf").agg(F.ceil(F.count("*") / block).alias("row_blocks"))
    sizes = sizes.join(asked.groupBy("leaf").agg(F.ceil(F.count("*") / block).alias("query_blocks")), "leaf")
    sizes = F.broadcast(stored(sizes, "vectors-sizes"))  # one row per leaf, under SAMPLE / LEAF * BRANCHES
    rows = placed.join(sizes, "leaf").select(
        "leaf", "id", "vec", F.pmod(F.xxhash64("id", "vec"), "row_blocks").alias("b"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("query_blocks") - 1)).alias("q"),
    )
    asks = asked.join(sizes, "leaf").select(
        "leaf", "id", "vec", F.pmod(F.xxhash64("id", "vec"), "query_blocks").alias("q"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("row_blocks") - 1)).alias("b"),
    )

    def meet(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(r):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "query": pd.Series(dtype=object), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        ids, vecs = q["id"].to_numpy(), q["vec"].tolist()
        found = list(nearest(ids, matrix(q["vec"]), r["id"].to_numpy(), matrix(r["vec"]), k))
        return pd.DataFrame([(ids[a], hash_of(vecs[a]), i, d) for a, i, d in found], columns=["query_id", "query", "vec_id", "score"])

    keys = ["leaf", "b", "q"]
    met = asks.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(meet, "query_id long, query binary, vec_id long, score double")
    best = Window.partitionBy("query_id", "query").orderBy("score", "vec_id")
    return met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def hash_of(vector) -> bytes:
    """Tells apart queries that share an id."""
    return blake2b(np.asarray(vector, dtype=np.float64).tobytes(), digest_size=8).digest()


def calibrated(placed: DataFrame, probes: pd.DataFrame, tree: Tree, k: int, recall: float) -> int:
    """Leaves to visit so that the probes find `recall` of their true neighbours; widened by a quarter until that is reached."""
    if not len(probes):
        return 1
    ids, queries = probes["id"].to_numpy(), matrix(probes["vec"])

    def brute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                leaf = dict(zip(batch["id"], batch["leaf"], strict=True))
                found = list(nearest(ids, queries, batch["id"].to_numpy(), matrix(batch["vec"]), k))
                yield pd.DataFrame([(a, i, d, leaf[i]) for a, i, d in found], columns=["probe", "id", "score", "leaf"])

    best = Window.partitionBy("probe").orderBy("score", "id")
    met = placed.mapInPandas(brute, "probe long, id long, score double, leaf long")
    true = met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("probe", "leaf").toPandas()
    order = [{leaf: i for i, leaf in enumerate(tree.visit(q, tree.leaves))} for q in queries]
    at = np.array([order[p][leaf] for p, leaf in zip(true["probe"], true["leaf"], strict=True)])
    visits = 4
    while visits < tree.leaves and len(at) and (at < visits).mean() < recall:
        visits += max(1, visits // 4)
    return min(visits, tree.leaves)

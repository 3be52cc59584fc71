"""Mixing sources to target weights by balanced sampling with the cube method.

Every source has a target number of words. A document of a source with target / size = r is taken floor(r)
times, and once more with probability f = r - floor(r). The once-more draws are made by the cube method: the
vector of probabilities moves through the null space of the balancing constraints (the number of documents
and the number of words of the source stay what they are) until no move is left. The flight runs in small
blocks of documents in parallel; each block leaves at most two documents undecided, which are gathered, 64
blocks at a time, into blocks of the next round, until a source has a single block. Its landing drops the
constraint on documents first and draws the last one.

Each flight preserves the inclusion probabilities, and each block preserves its totals, so the words taken from a
source differ from its target by less than its largest document, or two for a tiny source.

Blocks are dealt by a hash of id, text and the number of the copy: rows that agree in all that is read are counted first and
then numbered, RUN of them at a time, so that no row, however often it occurs, fills a block or a task.

Defined cases: a null text has size 0; a null source is a source of its own, the last one; sources without words
get target 0 and nothing is taken from them; repeated ids and rows are documents of their own; draws depend on the seed, the id,
the text and the number of the copy only, so reruns agree (equal rows are interchangeable). An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantspark.llm.common import WORD, stored

#: Weights of the sources in their order, repeated.
WEIGHTS = (5, 2, 1)
#: A target is at most so many times the size of its source.
MOST_REPEATS = 3
#: Documents per block of the first round; blocks merged into one in later rounds.
BLOCK, MERGE = 128, 64
#: Copies of one row that a task numbers.
RUN = 4096
EPS = 1e-9


def numbered(sources: DataFrame) -> DataFrame:
    """The sources with their position in code point order from 0, null last."""
    spark = sources.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = sources.repartitionByRange(n, F.col("source").asc_nulls_last())
    ranged = stored(ranged.withColumn("_part", F.spark_partition_id()), "mix-sources")
    sizes = {r["_part"]: r["n"] for r in ranged.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    starts, total = [], 0
    for part in sorted(sizes):  # one row per partition
        starts.append((part, total))
        total += sizes[part]
    first = spark.createDataFrame(starts or [(0, 0)], "_part int, _first long")
    inside = Window.partitionBy("_part").orderBy(F.col("source").asc_nulls_last())
    return (
        ranged.join(F.broadcast(first), "_part")
        .withColumn("source_no", F.col("_first") + F.row_number().over(inside) - 1)
        .drop("_part", "_first")
    )


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Adds `target`: shares of all words by weight, at most `most` times the size; the excess goes to the others.

    sources: source, source_size. The rate, words per unit of weight, rises until no further source reaches its limit;
    each step is one aggregate over the sources.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights) + 1).cast("int"))
    rows = stored(numbered(sources).withColumn("weight", weight.cast("double")), "mix-weights")
    limit = F.col("source_size").cast("double") * most
    total = rows.agg(F.sum(F.col("source_size").cast("double"))).first()[0] or 0.0
    rate, held = 0.0, -1
    while True:
        full = F.col("weight") * rate >= limit if held >= 0 else F.lit(False)
        out = rows.agg(
            F.sum(F.when(full, 1).otherwise(0)).alias("n"),
            F.sum(F.when(full, limit).otherwise(0.0)).alias("words"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if out["n"] is None or out["n"] == held or not out["weight"]:
            break
        held, rate = out["n"], (total - out["words"]) / out["weight"]
    return rows.withColumn("target", F.least(F.col("weight") * rate, limit))


def flight(pi: np.ndarray, rows: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Moves pi until at most len(rows) entries are strictly between 0 and 1, keeping rows @ pi."""
    pi = pi.copy()
    open_ = [i for i in range(len(pi)) if EPS < pi[i] < 1 - EPS]
    active, rest = open_[: len(rows) + 1], iter(open_[len(rows) + 1 :])
    while len(active) == len(rows) + 1:
        a = rows[:, active]
        if len(rows) == 2:
            u = np.cross(a[0], a[1])
            if not np.any(np.abs(u) > 0):  # equal rows: any move along the first is as good
                u = np.array([a[0][1], -a[0][0], 0.0])
        else:
            u = np.array([a[0][1], -a[0][0]])
            if not np.any(u):
                u = np.array([1.0, 0.0])
        u = u / np.abs(u).max()
        now = pi[active]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > 0, (1 - now) / u, np.where(u < 0, -now / u, np.inf)).min()
            down = np.where(u > 0, now / u, np.where(u < 0, (now - 1) / u, np.inf)).min()
        now = now + u * up if draw.random() * (up + down) < down else now - u * down
        pi[active] = np.where(now <= EPS, 0.0, np.where(now >= 1 - EPS, 1.0, now))
        left = [i for i in active if 0.0 < pi[i] < 1.0]
        while len(left) <= len(rows):
            new = next(rest, None)
            if new is None:
                break
            left.append(new)
        if len(left) == len(active) and left == active:
            break
        active = left
    return pi


def land(pi: np.ndarray, sizes: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Decides the last ones: words are kept as long as two are open, then one draw."""
    pi = flight(pi, np.vstack([np.where(sizes > 0, sizes, 1.0)]), draw)
    for i in np.flatnonzero((pi > 0) & (pi < 1)):
        pi[i] = float(draw.random() < pi[i])
    return pi


def decided(rows: DataFrame, seed: int) -> DataFrame:
    """rows: source_no, size, pi, _order, ... Flights by block, round by round, until every pi is 0 or 1."""
    rows = rows.withColumn("_block", F.pmod(F.xxhash64(F.lit(seed), "_order"), F.greatest(F.lit(1), F.ceil(F.col("_n") / BLOCK))))
    rows = rows.withColumn("_blocks", F.greatest(F.lit(1), F.ceil(F.col("_n") / BLOCK)).cast("long")).drop("_n")
    schema = rows.schema

    def move(group: pa.Table) -> pa.Table:
        source, block, blocks = (group.column(c)[0].as_py() for c in ("source_no", "_block", "_blocks"))
        size, order = (group.column(c).to_numpy() for c in ("size", "_order"))
        by = np.lexsort((size, order))
        draw = np.random.default_rng([seed, source, block, blocks])
        sizes = size[by].astype(float)
        pi = flight(group.column("pi").to_numpy()[by], np.vstack([np.ones(len(by)), sizes / max(1.0, sizes.max())]), draw)
        out = np.empty(len(by))
        out[by] = land(pi, sizes, draw) if blocks == 1 else pi
        return group.set_column(group.schema.get_field_index("pi"), "pi", pa.array(out))

    done = []
    while True:
        rows = stored(rows.groupBy("source_no", "_block").applyInArrow(move, schema), "mix-round")
        is_open = (F.col("pi") > 0) & (F.col("pi") < 1)
        done.append(rows.filter(~is_open))
        if not rows.filter(is_open).limit(1).count():
            return reduce(DataFrame.unionByName, done)
        merged = F.ceil(F.col("_blocks") / MERGE).cast("long")
        rows = rows.filter(is_open).withColumn("_block", F.pmod("_block", merged)).withColumn("_blocks", merged)


def copies_numbered(rows: DataFrame) -> DataFrame:
    """All rows again, with the number `_copy` of each among those that agree with it."""
    same = stored(rows.groupBy(*rows.columns).agg(F.count("*").alias("_k")), "mix-copies")
    runs = same.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_k") - 1) / RUN))))
    if same.filter(F.col("_k") > RUN).limit(1).count():
        runs = runs.repartition(*rows.columns, "_run")
    first = F.col("_run") * RUN
    return runs.withColumn("_copy", F.explode(F.sequence(first, F.least(first + RUN, "_k") - 1))).drop("_k", "_run")


def mix(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: int = 11, carry: list[str] = ()) -> DataFrame:
    """One row per document: size, source_size, target, copies, taken (copies x size), and the columns named in `carry`."""
    held = [f"_carried{i}" for i in range(len(carry))]
    sized = stored(
        docs.select(
            F.col(id_column).alias("_id"),
            F.col(source).alias("source"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(text).alias("_text"),
            *[F.col(c).alias(h) for c, h in zip(carry, held, strict=True)],
        ),
        "mix-sizes",
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_n"))
    sources = stored(targets(sources, weights, most), "mix-targets").drop("weight")
    small = sources.count() <= 10_000
    rows = copies_numbered(sized).withColumnRenamed("source", "_s").join(
        F.broadcast(sources) if small else sources, F.col("_s").eqNullSafe(F.col("source"))
    )
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.withColumn("_ratio", F.when(F.abs(ratio - F.round(ratio)) < EPS, F.round(ratio)).otherwise(ratio))
    rows = rows.select(
        "_id", "size", "source_size", "target", "source_no", "_n", *held,
        F.floor("_ratio").cast("long").alias("_whole"),
        (F.col("_ratio") - F.floor("_ratio")).alias("pi"),
        F.xxhash64(F.lit(seed), "_id", "size", "_text", "_copy").alias("_order"),
    )
    copies = F.col("_whole") + F.round("pi").cast("long")
    return decided(rows, seed).select(
        F.col("_id").alias(id_column), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"),
        *[F.col(h).alias(c) for c, h in zip(carry, held, strict=True)],
    )

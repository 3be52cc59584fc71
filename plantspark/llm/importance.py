"""Importance resampling towards a target collection, on hashed n-grams.

Features of a text are its runs of one to `longest` consecutive words; the bucket of a feature is the CRC-32 of its bytes
modulo `buckets`. With S features in all documents, s of them in a bucket, and T and t for the target, the gain of the bucket
is the logarithm of its smoothed share in the target over that in the documents, in floored thousandths. A document's
weight is the floored mean of the gains of its features. A Gumbel number from a hash of its id is added, and the highest
scores are drawn: a sample without replacement whose chances follow the weights.

Features come from Arrow kernels over strips of a batch: ascii_lower, split_pattern_regex, list_flatten,
dictionary_encode. The dictionary's indices, shifted against each other within a text, form the n-grams as numbers; the CRC
is taken of each distinct n-gram, continued from that of its first words, and taken back to all places. Buckets are kept in a stored table, so texts are read
and cut once; counts are sums of one array per task, and the gains of a document are a segment-reduce over what a `take` finds.

Ranks are global without a global task: rows are dealt by ranges of (score, id), numbered inside a range, and the
sizes of the ranges before are added. Rows that agree in every column are dealt apart by a row number, as they are interchangeable.

Bounds: `buckets` numbers per task, and once on the driver; the features of a strip of STRIP bytes of texts, or of PORTION rows, beside the Arrow batch.

Defined cases: a null or empty text has no words, so weight 0; it counts for nothing else. A null id has the score of the
empty string in place of the id and comes last among equal scores. Repeated ids and rows are documents of their own; equal in score and id, they are ordered
by weight, number of features and words, and then are equal in all that is returned. An empty target or table of documents is a
collection without features (T or S is 0). An empty table of documents gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantspark.llm.common import schema_text, stored

#: What separates words: ASCII characters other than digits and small letters. Fixed value.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONGEST, BUCKETS = 2, 10_000
LEAST_WORDS, DRAWN_PERCENT, SEED = 20, 25, "7"
#: Bytes of texts that are cut and handed on at a time; rows whose buckets are counted or weighed at a time.
STRIP, PORTION = 1 << 20, 1000


def strips(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of about STRIP bytes, of one text at least."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    number = (np.cumsum(sizes) - sizes) // STRIP
    edges = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(texts)]
    for a, z in zip(edges, edges[1:], strict=False):
        yield texts.slice(a, z - a)


def words_of(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """The words of all texts in a row as indices into the list of distinct words; the text each belongs to."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), BETWEEN)
    encoded = pc.list_flatten(parts).dictionary_encode()
    owner = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False)
    index = encoded.indices.to_numpy(zero_copy_only=False)
    empty = pc.index(encoded.dictionary, "").as_py()  # before a separator at the start, after one at the end
    if empty >= 0:
        real = index != empty
        index, owner = index[real], owner[real]
    return index.astype(np.int64), encoded.dictionary.cast(pa.binary()).to_pylist(), owner.astype(np.int64)


def features(texts: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features, those of a text together; features and words of each text."""
    index, words, owner = words_of(texts)
    n_words = np.bincount(owner, minlength=len(texts))
    spaced = [b" " + w for w in words]
    # CRCs and numbers of the n-grams that start at each word, as far as there are any
    checks = np.fromiter(map(crc32, words), dtype=np.int64, count=len(words))
    grams, found, owners = index, [checks[index] % buckets], [owner]
    for n in range(2, longest + 1):
        inside = owner[n - 1 :] == owner[: len(owner) - n + 1] if len(owner) >= n else np.zeros(0, bool)
        at = np.flatnonzero(inside)
        keys = grams[at] * len(words) + index[at + n - 1]  # the shorter gram at this place, and one more word
        distinct, place = np.unique(keys, return_inverse=True)
        before, last = np.divmod(distinct, max(1, len(words)))
        checks = np.fromiter(map(crc32, map(spaced.__getitem__, last.tolist()), checks[before].tolist()), dtype=np.int64, count=len(distinct))
        found.append((checks % buckets)[place])
        owners.append(owner[at])
        grams = np.zeros(len(index), dtype=np.int64)
        grams[at] = place
    belongs = np.concatenate(owners)
    order = np.argsort(belongs, kind="stable")
    return np.concatenate(found)[order], np.bincount(belongs, minlength=len(texts)), n_words


def kind_of(buckets: int) -> np.dtype:
    return np.dtype("<u2" if buckets <= 1 << 16 else "<u4")


def bucketed(rows: DataFrame, text: str, longest: int, buckets: int) -> DataFrame:
    """Replaces the text by n_words, n_features and buckets (little-endian numbers, a feature each); a strip is handed on at a time."""
    kind, names = kind_of(buckets), [c for c in rows.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for strip in strips(batch.column(batch.schema.get_field_index(text)).fill_null("")):
                found, n_features, n_words = features(strip, longest, buckets)
                ends = pa.array(np.append(0, np.cumsum(n_features) * kind.itemsize), pa.int32())
                packed = pa.Array.from_buffers(pa.binary(), len(strip), [None, ends.buffers()[1], pa.py_buffer(found.astype(kind))])
                old = [batch.column(batch.schema.get_field_index(c)).slice(at, len(strip)) for c in names]
                yield pa.RecordBatch.from_arrays([*old, pa.array(n_words), pa.array(n_features), packed], names=[*names, "n_words", "n_features", "buckets"])
                at += len(strip)
            pa.default_memory_pool().release_unused()

    made = "n_words long, n_features long, buckets binary"
    return rows.mapInArrow(run, ", ".join(x for x in (schema_text(rows, text), made) if x))


def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, PORTION at a time."""
    for batch in batches:
        for a in range(0, len(batch), PORTION):
            yield batch.slice(a, PORTION)


def flat(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a binary column in a row, and how many each row has; a copy is made only of a column with nulls."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // kind.itemsize
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    first, last = offsets[column.offset], offsets[column.offset + len(column)]
    data = column.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8)[first:last].view(kind) if data is not None else np.zeros(0, kind), sizes


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket over the whole table: each task sends one array."""
    kind = kind_of(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in portions(batches):
            total += np.bincount(flat(batch.column(0), kind)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    summed = rows.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in summed.toLocalIterator():  # at most `buckets` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(...)) of each bucket, in doubles."""
    k, all_s, all_t = len(documents), float(documents.sum()), float(target.sum())
    ratios = ((target + 1.0) * (all_s + k)) / ((documents + 1.0) * (all_t + k))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios.tolist()], dtype=np.int64)


def weighed(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """Replaces the buckets by the weight."""
    kind, names = kind_of(len(gain)), [c for c in rows.columns if c != "buckets"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            found, sizes = flat(batch.column("buckets"), kind)
            some = np.flatnonzero(sizes)
            sums = np.zeros(len(sizes), dtype=np.int64)
            if len(some):
                starts = (np.cumsum(sizes) - sizes)[some]
                sums[some] = np.add.reduceat(gain.take(found), starts)
            weight = pa.array(sums // np.maximum(sizes, 1))  # rounds down
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), weight], names=[*names, "weight"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in names)
    return rows.mapInArrow(run, f"{kinds}, weight long")


def drawn(rows: DataFrame, most: int) -> DataFrame:
    """Adds the rank (1, 2, ...) by score, highest first; null beyond `most`."""
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("weight").desc(), "n_features", "n_words"]
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(n, *order, "_row")
    ranged = stored(spread.withColumn("_part", F.spark_partition_id()), "importance-ranges")
    starts, total = [], 0
    for r in ranged.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect():  # one row per partition
        starts.append((r["_part"], total))
        total += r["n"]
    first = spark.createDataFrame(starts or [(0, 0)], "_part int, _first long")
    inside = Window.partitionBy("_part").orderBy(*order, "_row")
    rank = F.col("_first") + F.row_number().over(inside)
    return ranged.join(F.broadcast(first), "_part").withColumn("rank", rank).withColumn("rank", F.when(F.col("rank") <= most, F.col("rank"))).drop("_part", "_first", "_row")


def resample(docs: DataFrame, target: DataFrame, id_column: str = "doc_id", text: str = "text", longest: int = LONGEST,
             buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = DRAWN_PERCENT, seed: str = SEED) -> DataFrame:
    """One row per document: id_column, n_words, n_features, weight, score, rank (null if not drawn)."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    found = stored(bucketed(rows, "text", longest, buckets), "importance-buckets")
    wanted = bucketed(target.select(F.col(text).alias("text")), "text", longest, buckets)
    gain = gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets))

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 32))
    score = F.col("weight") + F.floor(-1000 * F.log(-F.log(share)))
    scored = stored(weighed(found, gain).withColumn("score", score.cast("long")), "importance-scores")
    can = F.col("n_words") >= least_words
    most = percent * scored.filter(can).count() // 100
    out = drawn(scored.filter(can), most).unionByName(scored.filter(~can).withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("id").alias(id_column), "n_words", "n_features", "weight", "score", "rank")


#: DuckDB SQL for the rows of `resample` with the default parameters, over documents and benchmark; CRCs are taken byte by
#: byte of each distinct feature, from a table that is made by its rule.
ORACLE_SQL = r"""
with recursive bits(byte, k, value) as (
  select i, 0, i from range(256) as b(i)
  union all
  select byte, k + 1, case when value & 1 = 1 then xor(value >> 1, 3988292384) else value >> 1 end from bits where k < 8),
crc as (select list(value order by byte) as t from bits where k = 8),
texts as (
  select 0 as side, doc_id, row_number() over () as row, coalesce(text, '') as text from documents
  union all
  select 1, null, null, coalesce(text, '') from benchmark),
words as (
  select side, doc_id, row,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from texts),
features as (
  select side, row, unnest(w || list_transform(range(1, len(w)), lambda i : w[i] || ' ' || w[i + 1])) as feature from words),
counted as (select side, row, feature, count(*) as n from features group by all),
hashed as (
  select feature,
         xor(list_reduce(
           list_prepend(4294967295::bigint, list_transform(range(0, strlen(feature)), lambda i : ('0x' || substr(hex(encode(feature)), (2 * i + 1)::int, 2))::bigint)),
           lambda acc, b : xor(acc >> 8, crc.t[(xor(acc, b) & 255) + 1])), 4294967295) % 10000 as bucket
  from (select distinct feature from counted), crc),
found as (select c.side, c.row, h.bucket, sum(c.n) as n from counted c join hashed h using (feature) group by all),
totals as (select coalesce(sum(n) filter (side = 0), 0)::double as s, coalesce(sum(n) filter (side = 1), 0)::double as t from found),
buckets as (
  select bucket, coalesce(sum(n) filter (side = 0), 0)::double as s, coalesce(sum(n) filter (side = 1), 0)::double as t from found group by bucket),
gains as (
  select b.bucket, floor(1000 * ln(((b.t + 1) * (a.s + 10000)) / ((b.s + 1) * (a.t + 10000))))::bigint as gain from buckets b, totals a),
weights as (
  select f.row, sum(f.n) as n_features, floor(sum(f.n * g.gain)::double / sum(f.n))::bigint as weight
  from found f join gains g using (bucket) where f.side = 0 group by f.row),
scored as (
  select w.doc_id, len(w.w) as n_words, coalesce(x.n_features, 0)::bigint as n_features, coalesce(x.weight, 0) as weight,
         coalesce(x.weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(w.doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score
  from words w left join weights x on w.row = x.row where w.side = 0),
ranked as (
  select *, case when n_words >= 20 then row_number() over (partition by n_words >= 20 order by score desc, doc_id nulls last) end as place,
         (25 * count(*) filter (n_words >= 20) over ()) // 100 as most
  from scored)
select doc_id, n_words::bigint as n_words, n_features, weight, score, case when place <= most then place end as rank from ranked
"""

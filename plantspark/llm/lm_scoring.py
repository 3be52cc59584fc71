"""Scoring texts by prediction by partial matching (PPM) over bytes.

A document is its tokens: words (A-Z lower-cased) with one space between, then the end. Its bytes are predicted one by one
from the ORDER bytes before. The trie holds, for every context of 0 to ORDER bytes seen in training, the counts of
the bytes that followed. With T counts of D distinct bytes, byte s has probability (2c - 1) / 2T and the escape D / 2T
(method D); after an escape the next shorter context is asked, with the bytes of the longer one excluded from its
counts. Below the empty context all bytes not yet excluded are equally likely.

Counting is a grouped aggregate over the whole training part: each task counts the longest grams of its texts, the counts meet
by gram, and shorter contexts are sums over longer ones. The trie is cut into shards of about SHARD_GRAMS grams by the
last three bytes of the context, to which all longer contexts that end so belong, so that grams after a common pair of bytes are spread;
contexts of fewer bytes (a few hundred thousand grams in texts, 256 ** 3 at most) are in every shard. A task finds the
distinct grams of about BUFFER bytes of texts, reads one shard at a time from the shared folder, and scores the grams that belong to
it. No count is dropped. A shard grows beyond SHARD_GRAMS only by the grams that follow one context of three bytes.

The base score of a word is its add-0.1 unigram probability. Counts of words come from an aggregate as well; the most frequent
ones, at most HOT_WORDS, go to every task, the other words of the documents meet their counts in a join.

Defined cases: a null or empty text is the end token alone. A null id counts as held out (its text is empty). Repeated ids and rows are
scored one by one and train as often as they occur. Other columns are not read. Without training texts every byte has
probability 1/256. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import batched

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantspark.llm.chunks import bytes_of
from plantspark.llm.chunks import strips as text_strips
from plantspark.llm.common import read_parts, shared_file_system, stored
from plantspark.session import new_folder

ORDER = 6
SHARD_GRAMS = 4_000_000
HOT_WORDS = 300_000
#: Words, in runs, that a task holds before it merges them and hands them on.
MOST_WORDS = 400_000
#: Grams that a task holds, in runs, before it merges them and hands them on; grams handed on at a time.
MOST_HELD, HANDED = 3_000_000, 200_000
#: Bytes of texts whose distinct grams are looked up together, which reads all shards once.
BUFFER = 1 << 25
#: Bytes cut into grams (a part), grams scored at a time, parts whose words are told apart together.
COUNTED, AT_ONCE, TOGETHER = 1 << 20, 1 << 19, 8
END = b"\n"
#: Contexts are dealt to shards by so many last bytes.
DEALT = 3
#: Spread these over shards.
MIX, PRIME = 40_503, 16_777_259


def held_out(id_column: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 10 == 0


def tokens(text: str | None) -> list[bytes]:
    """Of bytes, `lower` changes A-Z only, and `split` cuts at the six white-space characters."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


#: The documents of some texts: their bytes in a row, and the length of each.
Documents = tuple[np.ndarray, np.ndarray]
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def documents_of(texts: pa.Array) -> Iterator[Documents]:
    """The documents of a batch (of each text `b" ".join(tokens(text)) + END`), about COUNTED bytes at a time."""
    for part in text_strips(texts.fill_null(""), COUNTED) if len(texts) else ():
        inner, ends = bytes_of(part)
        behind = ends[1:] + np.arange(len(part))  # END behind each text, so that a blank follows each word
        is_inner = np.ones(len(inner) + len(part), dtype=bool)
        is_inner[behind] = False
        raw = np.full(len(is_inner), END[0], dtype=np.uint8)
        raw[is_inner] = LOWER[inner]
        blank = BLANK[raw]
        stays = ~blank
        stays[1:] |= ~blank[:-1]  # the first blank behind a word
        ends = np.cumsum(stays)[behind]
        empty = np.diff(ends, prepend=0) == 0
        stays[behind[empty]] = True
        lengths = np.diff(ends + np.cumsum(empty), prepend=0)
        out = raw[stays]
        out[blank[stays]] = 32
        out[np.cumsum(lengths) - 1] = END[0]
        yield out, lengths


def grams(documents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of the documents the gram of ORDER bytes before it and itself; the length of each document."""
    lengths = np.array([len(d) for d in documents], dtype=np.int64)
    return grams_of((np.frombuffer(b"".join(documents), dtype=np.uint8), lengths)), lengths


def grams_of(documents: Documents) -> np.ndarray:
    raw, lengths = documents
    own = np.arange(len(raw)) + np.repeat(np.arange(len(lengths)) * ORDER, lengths)
    padded = np.full(len(raw) + len(lengths) * ORDER + 8, END[0], dtype=np.uint8)
    padded[own + ORDER] = raw
    eight = np.ndarray(len(padded) - 7, dtype=">u8", buffer=padded, strides=(1,))  # bytes from each place on
    return eight.astype(np.uint64)[own] >> np.uint64(8)


def together(parts: Sequence[Documents]) -> Documents:
    raws, lengths = zip(*parts, strict=True)
    return np.concatenate(raws), np.concatenate(lengths)


def words_of(documents: Documents) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of some documents in a row, and the document of each."""
    raw, lengths = documents
    gap = (raw == 32) | (raw == END[0])  # one behind each word, and one for an empty document
    ends = np.flatnonzero(gap)
    sizes = np.diff(ends, prepend=-1) - 1
    owner = np.searchsorted(np.cumsum(lengths), ends, side="right")
    some = sizes > 0
    places = np.concatenate(([0], np.cumsum(sizes[some]))).astype(np.int32)
    found = pa.BinaryArray.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(raw[~gap])])
    return found.dictionary_encode(), owner[some]


class Trie:
    """Contexts and counts of one shard. tables: for order 0, 1, ... the grams (sorted) and their counts."""

    def __init__(self, tables: list[tuple[np.ndarray, np.ndarray]]):
        self.grams, self.counts = [g for g, _ in tables], [n for _, n in tables]
        self.contexts, self.total, self.distinct, self.free_total, self.free_distinct = [], [], [], [], []
        for k, (g, n) in enumerate(zip(self.grams, self.counts, strict=True)):
            context = g >> np.uint64(8)
            first = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))) if len(g) else np.zeros(0, int)
            self.contexts.append(context[first])
            self.total.append((np.add.reduceat(n, first) if len(g) else n).astype(np.float64))
            self.distinct.append(np.diff(np.append(first, len(g))).astype(np.float32))
            if k and len(g):  # what is left of the next shorter context when this one's bytes are excluded
                short = g & self.mask(k)
                seen = np.add.reduceat(self.counts[k - 1][np.searchsorted(self.grams[k - 1], short)], first)
                below = np.searchsorted(self.contexts[k - 1], short[first] >> np.uint64(8))
                self.free_total.append(self.total[k - 1][below] - seen)
                self.free_distinct.append(self.distinct[k - 1][below] - self.distinct[k])
            else:
                self.free_total.append(np.zeros(0))
                self.free_distinct.append(np.zeros(0))

        g, n = tables[-1]
        size = self.distinct[-1].astype(np.int64)
        self.whole = np.log10((2 * n - 1) / (2 * np.repeat(self.total[-1], size)))  # of the longest grams

    #: What a built trie consists of, a list of one array per order each.
    PARTS = ("grams", "counts", "contexts", "total", "distinct", "free_total", "free_distinct")

    def save(self, file) -> None:
        for array in (*(a for part in self.PARTS for a in getattr(self, part)), self.whole):
            np.lib.format.write_array(file, np.ascontiguousarray(array))

    @classmethod
    def load(cls, file) -> Trie:
        out = cls.__new__(cls)
        for part in cls.PARTS:
            setattr(out, part, [np.lib.format.read_array(file) for _ in range(ORDER + 1)])
        out.whole = np.lib.format.read_array(file)
        return out

    @staticmethod
    def mask(width: int) -> np.uint64:
        return np.uint64((1 << 8 * width) - 1)

    @staticmethod
    def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(table):
            return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return at, table[at] == keys

    def score(self, keys: np.ndarray) -> np.ndarray:
        """log10 of the probability of the last byte of each gram after the bytes before it."""
        at, hit = self.find(self.grams[-1], keys)
        out = np.where(hit, self.whole[at] if len(self.whole) else 0.0, 0.0)  # most are known whole
        todo = np.flatnonzero(~hit)
        longer = np.full(len(todo), -1)
        for k in reversed(range(len(self.grams))):
            part = keys[todo] & self.mask(k + 1)
            at, hit = self.find(self.grams[k], part)
            context, known = self.find(self.contexts[k], part >> np.uint64(8))
            total, distinct = np.zeros(len(part)), np.zeros(len(part))
            plain, cut = known & (longer < 0), longer >= 0
            total[plain], distinct[plain] = self.total[k][context[plain]], self.distinct[k][context[plain]]
            if cut.any():
                total[cut], distinct[cut] = self.free_total[k + 1][longer[cut]], self.free_distinct[k + 1][longer[cut]]
            out[todo[hit]] += np.log10((2 * self.counts[k][at[hit]] - 1) / (2 * total[hit]))
            escape = ~hit & (distinct > 0)
            out[todo[escape]] += np.log10(distinct[escape] / (2 * total[escape]))
            longer, todo = np.where(known, context, -1)[~hit], todo[~hit]
        root = float(self.distinct[0][0]) if len(self.distinct[0]) else 0.0
        out[todo] -= np.log10(256 - root)
        return out


def read_shard(folder: str, shard: int) -> Trie:
    """A shard's rows lie sorted by size and gram in its file."""
    parts = [read_parts(f"{folder}/shard={s}", ["size", "gram", "n"], may_miss=True) for s in (-1, shard)]
    empty = pa.table({"size": pa.array([], pa.int32()), "gram": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    parts = [t if t.num_columns else empty for t in parts]
    out = []
    for k in range(ORDER + 1):
        source = parts[0] if k < DEALT else parts[1]
        own = np.searchsorted(source.column("size").to_numpy(), (k, k + 1))
        gram, n = (source.column(c).slice(own[0], own[1] - own[0]).to_numpy() for c in ("gram", "n"))
        out.append((gram.view(np.uint64), n))
    return Trie(out)


def build_shards(spark: SparkSession, folder: str, shards: int) -> None:
    """Makes the trie of each shard once, for all tasks that will read it; one task a shard."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = shared_file_system(folder)
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                trial = f"{root}/trie-{shard}.{TaskContext.get().taskAttemptId()}.tmp"
                with fs.open_output_stream(trial) as out:
                    read_shard(folder, shard).save(out)
                name = f"{root}/trie-{shard}.bin"
                if fs.get_file_info(name).type != pa.fs.FileType.NotFound:  # left by an earlier attempt, the same
                    fs.delete_file(name)
                fs.move(trial, name)
        yield from ()

    spark.range(shards).repartition(shards, "id").mapInArrow(build, "shard long").write.format("noop").mode("overwrite").save()


def built_shard(folder: str, shard: int) -> Trie:
    fs, root = shared_file_system(folder)
    with fs.open_input_stream(f"{root}/trie-{shard}.bin") as file:
        return Trie.load(file)


class Counts:
    """Sorted distinct grams with their numbers, from runs that are merged when they hold MOST_HELD rows together."""

    def __init__(self):
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []
        self.rows = 0

    def add(self, keys: np.ndarray) -> None:
        keys.sort()
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        self.runs.append((keys[first], np.diff(np.append(first, len(keys)))))
        self.rows += len(first)

    def merge(self) -> None:
        keys, n = (np.concatenate(x) for x in zip(*self.runs, strict=True)) if self.runs else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.runs = []
        order = np.argsort(keys, kind="stable")  # of sorted runs: merges them
        keys, n = keys[order], n[order]
        del order
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        self.runs = [(keys[first], np.add.reduceat(n, first) if len(first) else n)]
        self.rows = len(first)

    def taken(self) -> Iterator[pa.RecordBatch]:
        """What is held, which is then forgotten."""
        if self.runs:
            self.merge()
            keys, n = self.runs.pop()
            self.rows = 0
            for a in range(0, len(keys), HANDED):
                yield pa.RecordBatch.from_pydict({"gram": keys[a : a + HANDED].view(np.int64), "n": n[a : a + HANDED]})


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = Counts()
    for batch in batches:
        for documents in documents_of(batch.column(0)):
            held.add(grams_of(documents))
            if held.rows >= MOST_HELD:
                held.merge()
                if held.rows > MOST_HELD * 3 // 4:
                    yield from held.taken()
    yield from held.taken()


def train(texts: DataFrame) -> tuple[str, int]:
    """Counts the grams of all texts; the folder of the shards, and their number."""
    # tasks have merged their grams: dealt as they are, and added up behind the shuffle only
    counted = texts.mapInArrow(count_grams, "gram long, n long").repartition("gram")
    top = stored(counted.groupBy("gram").agg(F.sum("n").alias("n")), "ppm-grams")
    tables = [top]
    for k in range(ORDER - 1, -1, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1).cast("long"))
        tables.insert(0, stored(tables[0].groupBy(shorter.alias("gram")).agg(F.sum("n").alias("n")), "ppm-grams"))
    every = tables[0].select(F.lit(0).alias("size"), "gram", "n")
    for k, t in enumerate(tables[1:], 1):
        every = every.unionByName(t.select(F.lit(k).alias("size"), "gram", "n"))
    shards = max(1, math.ceil(every.count() / SHARD_GRAMS))
    last = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * DEALT) - 1).cast("long"))
    shard = F.when(F.col("size") < DEALT, -1).otherwise((last * MIX % PRIME % shards).cast("int"))
    folder = new_folder(texts.sparkSession, "ppm-shards")
    sorted_ = every.withColumn("shard", shard).repartition(shards + 1, "shard").sortWithinPartitions("shard", "size", "gram")
    sorted_.write.partitionBy("shard").parquet(folder)
    build_shards(texts.sparkSession, folder, shards)
    return folder, shards


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []

    def merged() -> pa.Table:
        return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])

    for batch in batches:
        for parts in batched(documents_of(batch.column(0)), TOGETHER):
            words, _ = words_of(together(parts))
            n = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
            held.append(pa.table({"word": words.dictionary, "n": n}))
            if sum(len(t) for t in held) > MOST_WORDS:
                held = [merged()]
                if len(held[0]) > MOST_WORDS // 2:
                    yield from held.pop().to_batches(HANDED)
    if held:
        yield from merged().to_batches(HANDED)


def buffered(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[list[pa.RecordBatch]]:
    """Some batches together: as many as hold `least` bytes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= least:
            yield held
            held = []
    if held:
        yield held


def unigrams(rows: range, ids: pa.Array, held: pa.Array, documents: Documents, scores: np.ndarray,
             hot: tuple[pa.Array, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A row per document, and one for each of its words that is not among the frequent ones (hot: these, and their logarithms)."""
    words, owner = words_of(documents)
    n, index = len(rows), words.indices.to_numpy()
    logs = np.append(hot[1], np.nan)[pc.index_in(words.dictionary, value_set=hot[0]).fill_null(len(hot[1])).to_numpy()][index]
    is_hot = ~np.isnan(logs)
    sums = np.bincount(owner[is_hot], weights=logs[is_hot], minlength=n)
    each, rare_n = np.unique(owner[~is_hot] * len(words.dictionary) + index[~is_hot], return_counts=True)
    rare_row, rare_word = np.divmod(each, max(1, len(words.dictionary)))
    yield pa.RecordBatch.from_arrays([
        pa.array(rows, pa.int64()), ids, held, pa.array(np.bincount(owner, minlength=n) + 1), pa.array(np.bincount(owner[is_hot], minlength=n)),
        pa.array(sums.astype(np.float64)), pa.array(scores), pa.nulls(n, pa.binary()),
    ], names=SCORED)
    k = len(each)
    yield pa.RecordBatch.from_arrays([
        pa.array(rare_row + rows.start), pa.nulls(k, ids.type), pa.nulls(k, pa.bool_()), pa.array(rare_n, pa.int64()),
        pa.nulls(k, pa.int64()), pa.nulls(k, pa.float64()), pa.nulls(k, pa.float64()), words.dictionary.take(pa.array(rare_word)),
    ], names=SCORED)


def scorer(trie: str, shards: int, frequent: str):
    """Scores batches of ids, marks and texts."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = read_parts(frequent, ["word", "n"])
        hot = pa.array([], pa.binary()), np.zeros(0)
        if table.num_columns:
            hot = table.column(0).combine_chunks(), np.log10(table.column(1).to_numpy() + 0.1)
        row = TaskContext.get().partitionId() << 40
        only = [built_shard(trie, 0)] if shards == 1 else []  # goes with the task
        for held in buffered(batches, BUFFER):
            parts = [list(documents_of(batch.column(2))) for batch in held]
            keys, logs = gram_logs([documents for part in parts for documents in part], trie, shards, only)
            for batch, part in zip(held, parts, strict=True):
                ids, marks, at = batch.column(0), batch.column(1), 0
                for some in batched(part, TOGETHER):
                    z = at + sum(len(lengths) for _, lengths in some)
                    scores = np.concatenate([sums_of(documents, keys, logs) for documents in some])
                    yield from unigrams(range(row + at, row + z), ids[at:z], marks[at:z], together(some), scores, hot)
                    at = z
                row += at

    return score


def sums_of(documents: Documents, keys: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """The sum of the logarithms of each document's grams. keys: sorted, all grams are among them."""
    own, lengths = grams_of(documents), documents[1]
    order = np.argsort(own)
    own = own[order]
    first = np.concatenate(([True], own[1:] != own[:-1]))
    each = logs[np.searchsorted(keys, own[first])][np.cumsum(first) - 1]
    return np.bincount(np.repeat(np.arange(len(lengths)), lengths)[order], weights=each, minlength=len(lengths))


def distinct_grams(parts: list[Documents]) -> np.ndarray:
    """The distinct grams of some documents, sorted."""
    known, runs, rows = np.zeros(0, np.uint64), [], 0

    def sorted_once(keys: np.ndarray) -> np.ndarray:
        keys.sort()
        return keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys

    for documents in parts:
        runs.append(sorted_once(grams_of(documents)))
        rows += len(runs[-1])
        if rows >= MOST_HELD // 2:
            known, runs, rows = sorted_once(np.concatenate((known, *runs))), [], 0
    return sorted_once(np.concatenate((known, *runs)))


def gram_logs(parts: list[Documents], trie: str, shards: int, models: list[Trie]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of some documents, sorted, and log10 of the probability of their last byte; one shard at a time.

    models: the shards, or none if they are to be read in turn."""
    keys = distinct_grams(parts)
    logs = np.zeros(len(keys))
    home = np.concatenate([in_shard(keys[a : a + AT_ONCE], shards).astype(np.int32) for a in range(0, len(keys), AT_ONCE)] or [np.zeros(0, np.int32)])
    for shard in range(shards):
        own, model = np.flatnonzero(home == shard).astype(np.int32), models[shard] if models else built_shard(trie, shard)
        for a in range(0, len(own), AT_ONCE):
            part = own[a : a + AT_ONCE]
            logs[part] = model.score(keys[part])
        del model
    return keys, logs


SCORED = ["row", "id", "held_out", "n", "known", "sum", "score", "word"]


def in_shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each gram, by the last DEALT bytes of its context."""
    last = ((keys >> np.uint64(8)) & np.uint64((1 << 8 * DEALT) - 1)).astype(np.int64)
    return last * MIX % PRIME % shards


def ppm_scores(docs: DataFrame, id_column: str = "doc_id", text: str = "text", hot_words: int = HOT_WORDS) -> DataFrame:
    """One row per document: held_out, n_tokens, n_known, train_tokens, base_score, score (both log10)."""
    rows = docs.select(F.col(id_column).alias("id"), held_out(id_column).alias("held_out"), F.col(text).alias("text"))
    training = rows.filter(~F.col("held_out"))
    trie, shards = train(training.select("text"))
    counts = training.select("text").mapInArrow(count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = stored(counts, "ppm-words")
    ends = training.select(F.count("*")).first()[0]
    sizes = vocabulary.groupBy(F.floor(F.log2("n")).cast("int").alias("b")).agg(F.count("*").alias("k"), F.sum("n").alias("n")).collect()
    train_tokens = sum(r["n"] for r in sizes) + ends
    distinct = sum(r["k"] for r in sizes) + (ends > 0)
    least, room = 63, hot_words  # words with at least 2**least occurrences are frequent
    for r in sorted(sizes, key=lambda r: -r["b"]):
        room -= r["k"]
        if room < 0:
            break
        least = r["b"]
    frequent = new_folder(docs.sparkSession, "ppm-frequent")
    is_hot = F.col("n") >= F.lit(1 << least).cast("long") if least < 63 else F.lit(False)
    vocabulary.filter(is_hot).write.parquet(frequent)

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"row long, id {kind}, held_out boolean, n long, known long, sum double, score double, word binary"
    scored = stored(rows.mapInArrow(scorer(trie, shards, frequent), schema), "ppm-scores")
    rare = scored.filter("word is not null").select("row", "word", F.col("n").alias("times"))
    met = rare.join(vocabulary.filter(~is_hot), "word", "left").withColumn("c", F.coalesce("n", F.lit(0)))
    met = met.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("c") + 0.1)).alias("rare_sum"),
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
    )
    norm = math.log10(train_tokens + 0.1 * (distinct + 1))
    base = F.col("sum") + F.coalesce("rare_sum", F.lit(0.0)) + F.lit(math.log10(ends + 0.1)) - F.col("n") * F.lit(norm)
    known = F.col("known") + F.coalesce("rare_known", F.lit(0)) + F.lit(int(ends > 0))
    return scored.filter("word is null").join(met, "row", "left").select(
        F.col("id").alias(id_column), "held_out", F.col("n").alias("n_tokens"), known.alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
    )

"""Token ids in files of wavelet matrices.

A shard is one file: the ids of consecutive documents as a wavelet matrix, that is one plane of bits per bit of the code,
each plane holding the codes in the order left by sorting (stably) on the bits above. With counts of ones at fixed
distances (rank), any token, the number of occurrences of an id before a place, and the place of its k-th occurrence
are found from the planes alone, without decoding the shard. Codes are positions in the shard's own
sorted list of distinct ids, so a shard has only as many planes as that list needs. Planes are compressed one by one.

    file: magic, header length (4 bytes), header (JSON), then the parts it lists, each compressed with zstandard
    parts: symbols (u4), lengths of documents (u4), plane 0 (highest bit) ... plane n

Writing: documents are range partitioned by id and sorted; each task encodes its documents and writes a file whenever
`shard_tokens` ids are gathered, at the end of a document. A file is written under a temporary name and renamed, and its name
follows from partition and number, so a repeated task writes the same file again. Reading goes through Spark's
binary file source.

Defined cases: null and empty texts are documents of the end id alone. Null ids come first in the order. Repeated ids and rows are
documents of their own, equal ids in the order of their texts. Other columns are not read. Empty tables give no files and an empty result.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantspark.llm.common import shared_file_system, stored
from plantspark.llm.encoding import encoder

MAGIC = b"WVMX0001"
STEP = 512  # bits between two counts


class Plane:
    """Bits with rank and select."""

    def __init__(self, packed: np.ndarray, n: int):
        self.packed, self.n = packed, n
        ones = np.bitwise_count(packed).astype(np.int64)
        pad = -len(ones) % (STEP // 8)
        blocks = np.pad(ones, (0, pad)).reshape(-1, STEP // 8).sum(axis=1)
        self.before = np.concatenate(([0], np.cumsum(blocks)))
        self.zeros = n - int(self.before[-1])

    def bit(self, i: int) -> int:
        return int(self.packed[i >> 3] >> (7 - (i & 7)) & 1)

    def rank(self, bit: int, i: int) -> int:
        """Bits equal to `bit` before place i."""
        block, byte = i // STEP, i >> 3
        ones = int(self.before[block]) + int(np.bitwise_count(self.packed[block * STEP // 8 : byte]).sum(dtype=np.int64))
        if i & 7:
            ones += int(self.packed[byte] >> (8 - (i & 7))).bit_count()
        return ones if bit else i - ones

    def select(self, bit: int, k: int) -> int:
        """Place of the k-th (from 0) bit equal to `bit`."""
        counts = self.before if bit else np.minimum(np.arange(len(self.before)) * STEP, self.n) - self.before
        block = int(np.searchsorted(counts, k, side="right")) - 1
        a = block * STEP
        bits = np.unpackbits(self.packed[a // 8 : (a + STEP) // 8])[: self.n - a]
        return a + int(np.flatnonzero(bits == bit)[k - int(counts[block])])


class WaveletMatrix:
    """Ids with access, count and lookup."""

    def __init__(self, symbols: np.ndarray, planes: list[np.ndarray], n: int):
        self.symbols, self.packed, self.n = symbols, planes, n
        self._planes: list[Plane] | None = None

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        seen = np.zeros(int(ids.max()) + 1 if len(ids) else 0, dtype=bool)
        seen[ids] = True
        symbols = np.flatnonzero(seen).astype("<u4")
        code_of = np.zeros(len(seen), dtype=np.uint16 if len(symbols) <= 1 << 16 else np.uint32)
        code_of[symbols] = np.arange(len(symbols))
        codes, planes = code_of[ids], []
        for level in reversed(range(max(0, len(symbols) - 1).bit_length())):
            ones = (codes & codes.dtype.type(1 << level)) != 0
            planes.append(np.packbits(ones))
            codes = np.concatenate((codes[~ones], codes[ones]))
        return cls(symbols, planes, len(ids))

    @property
    def planes(self) -> list[Plane]:
        if self._planes is None:
            self._planes = [Plane(p, self.n) for p in self.packed]
        return self._planes

    def access(self, i: int) -> int:
        code = 0
        for p in self.planes:
            bit = p.bit(i)
            code = code << 1 | bit
            i = p.rank(bit, i) + (p.zeros if bit else 0)
        return int(self.symbols[code])

    def _code(self, token: int) -> int | None:
        at = int(np.searchsorted(self.symbols, token))
        return at if at < len(self.symbols) and self.symbols[at] == token else None

    def _range(self, code: int, i: int) -> tuple[int, int]:
        """Where the occurrences of the code before place i stand after the last plane."""
        a, z = 0, i
        for level, p in zip(reversed(range(len(self.planes))), self.planes, strict=True):
            bit = code >> level & 1
            a, z = (p.rank(bit, x) + (p.zeros if bit else 0) for x in (a, z))
        return a, z

    def count(self, token: int, before: int | None = None) -> int:
        """Occurrences of the id before a place (of all ids, if none is given)."""
        code = self._code(token)
        if code is None:
            return 0
        a, z = self._range(code, self.n if before is None else before)
        return z - a

    def find(self, token: int, k: int) -> int | None:
        """Place of the k-th occurrence (from 0) of the id."""
        code = self._code(token)
        if code is None or not 0 <= k < self.count(token):
            return None
        at = self._range(code, 0)[0] + k
        for level, p in enumerate(reversed(self.planes)):
            bit = code >> level & 1
            at = p.select(bit, at - p.zeros if bit else at)
        return at

    def decode(self) -> np.ndarray:
        """All ids: the planes are undone from the last to the first."""
        codes = np.zeros(self.n, dtype=np.uint16 if len(self.symbols) <= 1 << 16 else np.uint32)
        for level, packed in enumerate(reversed(self.packed)):
            ones = np.unpackbits(packed, count=self.n).view(bool)
            zeros = self.n - int(np.count_nonzero(ones))
            was = np.empty_like(codes)
            was[~ones] = codes[:zeros]
            was[ones] = codes[zeros:] | codes.dtype.type(1 << level)
            codes = was
        return self.symbols[codes] if self.n else np.zeros(0, dtype="<u4")


def to_file(matrix: WaveletMatrix, lengths: list[int], first: int, part: int, number: int, docs: list) -> bytes:
    packer = zstandard.ZstdCompressor(level=1)
    parts = [packer.compress(x.tobytes()) for x in (matrix.symbols, np.array(lengths, dtype="<u4"), *matrix.packed)]
    head = {"n": matrix.n, "docs": docs, "first": first, "part": part, "number": number, "parts": [len(p) for p in parts]}
    raw = json.dumps(head).encode()
    return MAGIC + len(raw).to_bytes(4, "little") + raw + b"".join(parts)


def from_file(content: bytes) -> tuple[dict, np.ndarray, WaveletMatrix]:
    """Header, lengths of documents, matrix."""
    if content[:8] != MAGIC:
        raise ValueError("not a token file")
    size = int.from_bytes(content[8:12], "little")
    head, at, parts = json.loads(content[12 : 12 + size]), 12 + size, []
    for length in head["parts"]:
        parts.append(zstandard.ZstdDecompressor().decompress(content[at : at + length]))
        at += length
    planes = [np.frombuffer(p, dtype=np.uint8) for p in parts[2:]]
    return head, np.frombuffer(parts[1], dtype="<u4"), WaveletMatrix(np.frombuffer(parts[0], dtype="<u4"), planes, head["n"])


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, id_column: str = "doc_id",
                      text: str = "text", shard_tokens: int = 1 << 20) -> DataFrame:
    """Writes the shards into the folder, a path that all executors share; returns path, part, number, n_tokens."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text).alias("text"))
    order = [F.col("doc").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order, F.col("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = shared_file_system(folder)
        fs.create_dir(root, recursive=True)
        encode, task = encoder(tokenizer).encode_batch, TaskContext.get()
        part, number, first = task.partitionId(), 0, 0
        docs_, arrays, total = [], [], 0
        end = np.array([end_id], dtype="<u4")

        def flush() -> pa.RecordBatch:
            nonlocal docs_, arrays, total, number, first
            lengths = [len(a) + 1 for a in arrays]
            ids = np.concatenate([x for a in arrays for x in (a, end)])
            content = to_file(WaveletMatrix.build(ids), lengths, first, part, number, docs_)
            name = f"{root}/shard-{part:06d}-{number:06d}.wvm"
            with fs.open_output_stream(trial := f"{name}.{task.taskAttemptId()}.tmp") as out:
                out.write(content)
            if fs.get_file_info(name).type != pa.fs.FileType.NotFound:  # left by an earlier attempt
                fs.delete_file(name)
            fs.move(trial, name)
            row = pa.RecordBatch.from_pydict({"path": [name], "part": pa.array([part], pa.int64()), "number": pa.array([number], pa.int64()), "n_tokens": pa.array([total], pa.int64())})
            number, first = number + 1, first + total
            docs_, arrays, total = [], [], 0
            return row

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1)), strict=True):
                docs_.append(doc)
                arrays.append(ids)
                total += len(arrays[-1]) + 1
                if total >= shard_tokens:
                    yield flush()
        if docs_:
            yield flush()

    return rows.mapInArrow(write, "path string, part long, number long, n_tokens long")


def read_token_files(spark: SparkSession, folder: str, shards: DataFrame) -> DataFrame:
    """One row per document of the listed shards: doc_id, start, n_tokens, ids_crc32."""
    totals = {r["part"]: r["n"] for r in shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    starts, total = [], 0
    for part in sorted(totals):  # one row per task that wrote
        starts.append((part, total))
        total += totals[part]
    first = spark.createDataFrame(starts or [(0, 0)], "part long, base long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                head, lengths, matrix = from_file(content.as_py())
                raw = matrix.decode().astype("<u4", copy=False)
                ends = np.cumsum(lengths, dtype=np.int64)
                begins = ends - lengths
                crc = [zlib.crc32(raw[a:z]) for a, z in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(head["docs"], pa.int64()), "part": pa.array([head["part"]] * len(crc), pa.int64()),
                    "inside": pa.array(begins + head["first"]), "n_tokens": pa.array(lengths.astype(np.int64)), "ids_crc32": pa.array(crc, pa.int64()),
                })

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wvm").load(folder).select("content")
    found = files.mapInArrow(read, "doc_id long, part long, inside long, n_tokens long, ids_crc32 long")
    return found.join(F.broadcast(first), "part").select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_file_digests(docs: DataFrame, folder: str, tokenizer: str, **options) -> DataFrame:
    """Writes the files and reads them back. A folder without rows has no files."""
    shards = stored(write_token_files(docs, folder, tokenizer, **options), "token-shards")
    if not shards.limit(1).count():
        return docs.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_token_files(docs.sparkSession, folder, shards)

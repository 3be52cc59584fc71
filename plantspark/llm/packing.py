"""Packing documents into fixed windows of token ids, with bounded space.

Each task streams its documents. A document's ids are followed by the end id and cut into full windows and a rest. A task
keeps a fixed number of open windows; a rest goes to the open window in which it leaves the least room (best fit). If it
fits in none, the fullest window is emitted: a gap of at least `least_cut` ids is filled with the head of the rest (cuts are
free), a smaller one is padding. Windows still open when a task's rows end are merged: those of 16 tasks at a time go through the same
packer as units, round by round, until one group is left, whose last windows are cut into each other.

Memory per task is the open windows and one batch of texts, whatever the input. Texts are not shuffled; only open windows
travel.

Defined cases: a null or empty text is a document of the end id alone. Repeated ids and rows are documents of their own. Other columns
are not read. A very long text is cut into full windows as it is encoded. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantspark.llm.common import stored
from plantspark.llm.encoding import encoder

NAMES = ["doc", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids", "part", "open"]
#: Windows of so many tasks or groups are merged at a time.
MERGE = 16
#: Bytes of texts that are encoded at a time; larger strips take more memory, and less time, as equal chunks are encoded once a strip.
STRIP = 2 << 20


@dataclass(frozen=True)
class Packing:
    """width: ids in a window. open_windows: kept per task. least_cut: smallest piece that a cut may make."""

    width: int = 2048
    open_windows: int = 32
    least_cut: int = 48


@dataclass
class Piece:
    doc: object
    start: int
    ids: np.ndarray
    doc_tokens: int


@dataclass
class Open:
    used: int = 0
    pieces: list[Piece] = field(default_factory=list)

    def add(self, pieces: list[Piece]) -> None:
        self.pieces += pieces
        self.used += sum(len(p.ids) for p in pieces)


class Packer:
    """Best fit into a fixed number of open windows. `put` returns the windows that it closes."""

    def __init__(self, spec: Packing):
        self.spec, self.open = spec, []

    def put(self, pieces: list[Piece]) -> list[Open]:
        """pieces: a unit of at most one window, kept together unless it is cut to fill an emitted window."""
        size = sum(len(p.ids) for p in pieces)
        fits = [w for w in self.open if w.used + size <= self.spec.width]
        if fits:
            best = max(fits, key=lambda w: w.used)
            best.add(pieces)
            if best.used < self.spec.width:
                return []
            self.open.remove(best)
            return [best]
        closed = []
        if len(self.open) >= self.spec.open_windows:
            fullest = max(self.open, key=lambda w: w.used)
            self.open.remove(fullest)
            pieces = self.fill(fullest, pieces, self.spec.least_cut)
            closed.append(fullest)
        if pieces:
            fresh = Open()
            fresh.add(pieces)
            (closed if fresh.used == self.spec.width else self.open).append(fresh)
        return closed

    def fill(self, window: Open, pieces: list[Piece], least: int) -> list[Piece]:
        """Moves the head of the pieces into the window's gap; what is left of them."""
        rest = []
        for p in pieces:
            gap = self.spec.width - window.used
            if len(p.ids) <= gap:
                window.add([p])
            elif gap >= max(1, least):
                window.add([Piece(p.doc, p.start, p.ids[:gap], p.doc_tokens)])
                rest.append(Piece(p.doc, p.start + gap, p.ids[gap:], p.doc_tokens))
            else:
                rest.append(p)
        return rest

    def finish(self) -> list[Open]:
        """Cuts the open windows into each other, fullest first, so that all but the last are full."""
        closed: list[Open] = []
        now = Open()
        for w in sorted(self.open, key=lambda w: -w.used):
            rest = self.fill(now, w.pieces, 1)
            if now.used == self.spec.width:
                closed.append(now)
                now = Open()
                now.add(rest)
        self.open = []
        return closed + [now] * bool(now.used)


def schema(kind: str) -> str:
    return (
        f"doc {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
        "ids binary, part long, open boolean"
    )


class Rows:
    """Collects pieces as columns of the schema."""

    def __init__(self, kind: pa.DataType, with_ids: bool):
        self.kind, self.with_ids = kind, with_ids
        self.data: list[tuple] = []

    def window(self, window: Open, sequence: int, part: int, is_open: bool) -> None:
        at = 0
        for p in window.pieces:
            raw = p.ids.astype("<u4").tobytes()
            ids = raw if self.with_ids or is_open else None
            self.data.append((p.doc, p.start, len(p.ids), zlib.crc32(raw), p.doc_tokens, sequence, at, ids, part, is_open))
            at += len(p.ids)

    def table(self) -> pa.RecordBatch:
        columns = list(zip(*self.data, strict=True)) if self.data else [()] * 10
        kinds = [self.kind, *[pa.int64()] * 6, pa.binary(), pa.int64(), pa.bool_()]
        self.data = []
        return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=NAMES)


def merger(level: int, last: bool, spec: Packing, with_ids: bool):
    """Packs the open windows of one group; the last group's windows are all closed."""

    def merge(group: pa.Table) -> pa.Table:
        units: dict[int, list[tuple]] = {}
        kind = group.schema.field("doc").type
        columns = [group.column(c).to_pylist() for c in ("sequence_id", "offset", "doc", "start", "ids", "doc_tokens")]
        for sequence, at, *piece in zip(*columns, strict=True):
            units.setdefault(sequence, []).append((at, piece))
        part, number, packer = group.column("part")[0].as_py(), 0, Packer(spec)
        out, closed = Rows(kind, with_ids), []
        ready = []
        for _, unit in sorted(units.items()):
            pieces = [p for _, p in sorted(unit, key=lambda x: x[0])]
            ready.append([Piece(doc, start, np.frombuffer(ids, dtype="<u4"), n) for doc, start, ids, n in pieces])
        for unit in sorted(ready, key=lambda u: -sum(len(p.ids) for p in u)):
            closed += packer.put(unit)
        closed += packer.finish() if last else []
        for is_open, windows in ((False, closed), (True, packer.open)):
            for w in windows:
                out.window(w, level << 58 | part << 31 | number, part, is_open)
                number += 1
        return pa.Table.from_batches([out.table()])

    return merge


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, id_column: str = "doc_id", text: str = "text",
         spec: Packing = Packing(), with_ids: bool = True) -> DataFrame:
    """One row per piece: id_column, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for,
    ids (little-endian unsigned 32-bit). A sequence is its pieces by offset; what is short of `width` is padding."""
    rows = docs.select(F.col(id_column).alias("doc"), F.col(text).alias("text"))
    kind = rows.schema["doc"].dataType

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer, part, number = encoder(tokenizer).encode_batch, Packer(spec), TaskContext.get().partitionId(), 0
        out: Rows | None = None
        for batch in batches:
            out = out or Rows(batch.schema.field(0).type, with_ids)
            for doc, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1), STRIP), strict=True):
                ids = np.append(ids, np.uint16(end_id) if end_id < 1 << 16 else np.uint32(end_id))
                closed = []
                for at in range(0, len(ids), spec.width):
                    closed += packer.put([Piece(doc, at, ids[at : at + spec.width], len(ids))])
                for w in closed:
                    out.window(w, part << 31 | number, part, False)
                    number += 1
                if len(out.data) >= 512:
                    yield out.table()
            del batch  # before the next one comes
            pa.default_memory_pool().release_unused()
        if out:
            for w in packer.open:
                out.window(w, part << 31 | number, part, True)
                number += 1
            yield out.table()

    made = stored(rows.mapInArrow(stream, schema(kind.simpleString())), "packing")
    done, level = [made.filter("not open")], 0
    left = made.filter("open")
    while True:
        groups = left.agg(F.max("part")).first()[0]
        if groups is None:
            break
        level, last = level + 1, groups < MERGE

        grouped = left.withColumn("part", F.floor(F.col("part") / MERGE)).groupBy("part")
        merged = stored(grouped.applyInArrow(merger(level, last, spec, with_ids), schema(kind.simpleString())), "packing-merge")
        done.append(merged.filter("not open"))
        left = merged.filter("open")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    names = [F.col("doc").alias(id_column), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return out.select(*names, *["ids"] * with_ids)

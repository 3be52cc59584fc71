"""Helpers shared by the operators: tables in the shared folder, row keys, words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantspark.session import new_folder

#: A word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Key sets up to this many rows (16 bytes each) may be broadcast.
BROADCAST_KEYS = 500_000

#: Columns that tell a row of documents; rows equal in both are copies of one row.
KEY = ["_key_a", "_key_b"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage, and lost executors lose nothing."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a shared path, for code that runs inside tasks."""
    return pa.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def read_parts(uri: str, columns: list[str], may_miss: bool = False) -> pa.Table:
    """A table of bounded size that Spark has written to the shared folder, read inside a task. may_miss: a partition
    without rows has no folder, and gives a table without columns."""
    fs, path = shared_file_system(uri)
    found = fs.get_file_info(pa.fs.FileSelector(path, allow_not_found=may_miss, recursive=True))
    names = sorted(f.path for f in found if f.path.endswith(".parquet"))
    tables = [pq.read_table(n, columns=columns, filesystem=fs) for n in names]
    return pa.concat_tables(tables) if tables else pa.table({})


def with_key(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds a 128-bit key of id and text; null and empty texts differ."""
    a, b, none = F.col(id_column), F.col(text), F.col(text).isNull()
    return df.withColumns({KEY[0]: F.xxhash64(a, b, none), KEY[1]: F.xxhash64(F.lit("second"), b, none, a)})


def joined(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join with a stored right side, broadcast only if it holds at most BROADCAST_KEYS rows."""
    small = right.count() <= BROADCAST_KEYS
    return left.join(F.broadcast(right) if small else right, on, how)


def schema_text(df: DataFrame, without: str = "") -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != without)


def map_texts(rows: DataFrame, text: str, make: Callable[[], Callable[..., dict[str, pa.Array]]], schema: str,
              as_list: bool = True) -> DataFrame:
    """Replaces the column `text` by columns made from it; the others pass as they are, nulls and large numbers included.

    make: called once per task, gives the function from the texts of a batch, as a list or as an Arrow array, to the new columns."""
    names = [c for c in rows.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_texts = make()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            new = of_texts(texts.to_pylist() if as_list else texts)
            old = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*old, *new.values()], names=[*names, *new])

    return rows.mapInArrow(run, ", ".join(x for x in (schema_text(rows, text), schema) if x))

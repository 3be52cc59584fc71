"""From raw documents to packed windows of token ids: five stages, each of which calls one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written to the shared folder and read again as the
docs of the next one. All but the last return the columns of `documents`. Rows are followed by a 128-bit key of id and
text, so repeated ids are no obstacle; rows equal in both are copies of one row. Where keys of rows to drop or keep are
few (checked), they are broadcast; otherwise the texts meet them in a shuffle join.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantspark.llm import language_id, line_dedup, mixing, packing, simhash
from plantspark.llm.common import KEY, joined, read_table, stored, with_key

#: The key under names that operators don't use themselves.
ROW = ["row_a", "row_b"]


def rowed(docs: DataFrame) -> DataFrame:
    return with_key(docs).withColumnsRenamed(dict(zip(KEY, ROW, strict=True)))


def once(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """docs without copies of a row; rows: a stored table with the key of every row, which tells whether there are any."""
    copies = rows.groupBy(*ROW).agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
    return docs.dropDuplicates(ROW) if copies else docs


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no known language."""
    keyed = rowed(docs)
    records = keyed.select(*ROW, "text", F.col("lang").alias("declared"), F.col("source").alias("host"))
    rejected = stored(language_id.identify(records).filter(~F.col("kept")).select(*ROW).distinct(), "pipeline-rejected")
    return joined(keyed, rejected, ROW, "left_anti").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts later occurrences of three lines in a row out of the texts."""
    out = line_dedup.remove_repeated_windows(docs)
    count = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", count).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group."""
    keyed = rowed(docs)
    groups = stored(simhash.simhash_groups(keyed, width=3, radius=2, carry=ROW), "pipeline-groups")
    first = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root")
    first = first.agg(F.min_by(ROW[1], ROW[0]).alias(ROW[1]), F.min(ROW[0]).alias(ROW[0]))
    kept = joined(keyed, stored(first.select(*ROW), "pipeline-first"), ROW, "left_semi")
    return once(kept, groups).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix says, none to three times."""
    keyed = rowed(docs)
    mixed = stored(mixing.mix(keyed, carry=ROW), "pipeline-mix")
    copies = mixed.groupBy(*ROW).agg(F.sum("copies").alias("_copies")).filter("_copies > 0")
    taken = joined(once(keyed, mixed), stored(copies, "pipeline-copies"), ROW, "inner")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids and their places in windows."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


STAGES = [
    ("language id", identify_language),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: Draws, hashes and tokenizers can't be written in SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stored(stage(spark, out, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return out

"""Line dedup by overlapping windows of three lines, in DataFrame operations only.

Every three consecutive lines of a text make a window, known by a 128-bit hash. A window that occurs more than once in the
table stays where it occurs first (smallest id, then smallest key of the row, then smallest position) and goes elsewhere: all lines
that a later occurrence covers are removed. Later windows overlap, so their positions are merged before lines are
cut. Every removed line has an equal one at an earlier place, and the earliest of them is never removed.

Texts are not shuffled for the search: windows travel as hashes, occurrences of one window are combined in each task
before they meet, and the join back is one that Spark splits where a window is very common. `again` marks windows
that repeat inside their own text; it is found without any shuffle.

Defined cases: ids are whole numbers; null ids come last in the order. Different texts under one id, or without an id, are
ordered by the 128-bit key of id and text, and lose what an earlier one has. Rows equal in id and text are copies of one row: they
don't remove each other's windows, and all get the same result. A null text stays null and has no lines;
texts under three lines have no windows and stay whole. A text that loses all lines becomes empty. Other columns are kept
as they are, except that columns named n_lines or n_removed are replaced by the results; names that start with an underscore
are taken. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantspark.llm.common import KEY, stored, with_key

WINDOW = 3
LAST = 9223372036854775807


def lines_of(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def windows(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """One row per window: the key of its row, order of the document, whether that has no id, position, hash, `again`."""
    n = F.size("_lines")

    def window(i: Column) -> Column:
        lines = [F.element_at("_lines", i + k + 1) for k in range(WINDOW)]
        return F.struct(F.xxhash64(*lines).alias("h1"), F.xxhash64(F.lit("second"), *lines).alias("h2"), i.alias("pos"))

    def mark(x: Column, i: Column) -> Column:
        before = F.element_at("_windows", F.greatest(i, F.lit(1)))
        again = (i > 0) & (before["h1"] == x["h1"]) & (before["h2"] == x["h2"])
        return F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"), x["pos"].alias("pos"), again.alias("again"))

    order = F.coalesce(F.col(id_column).cast("long"), F.lit(LAST)).alias("_order")
    none = F.col(id_column).isNull().alias("_none")
    rows = docs.select(*KEY, order, none, lines_of(text).alias("_lines")).filter(n >= WINDOW)
    rows = rows.select(*KEY, "_order", "_none", F.array_sort(F.transform(F.sequence(F.lit(0), n - WINDOW), window)).alias("_windows"))
    return rows.select(*KEY, "_order", "_none", F.inline(F.transform("_windows", mark)))


def remove_repeated_windows(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with later occurrences cut from `text`, and the columns n_lines and n_removed (long)."""
    keyed = with_key(docs, id_column, text)
    found = stored(windows(keyed, id_column, text), "line-windows")
    first = found.groupBy("h1", "h2").agg(F.min("_order").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    early = (F.col("_order") == F.col("_first")).alias("_early")
    met = stored(found.join(first, ["h1", "h2"]).select(*KEY, "_none", "h1", "h2", "pos", early), "line-repeats")
    elsewhere = met.filter("not _early").select(*KEY, "pos")
    tied = met.filter("_early").withColumn("_row", F.struct("_none", *KEY))
    owners = tied.groupBy("h1", "h2").agg(F.min("_row").alias("_owner"), F.max("_row").alias("_last"))
    owners = stored(owners.filter(F.col("_owner") < F.col("_last")).select("h1", "h2", "_owner"), "line-owners")  # none if ids are unique
    tied = tied.join(owners, ["h1", "h2"]).filter(F.col("_row") > F.col("_owner")).select(*KEY, "pos")
    later = elsewhere.unionByName(tied).unionByName(found.filter("again").select(*KEY, "pos"))
    starts = later.groupBy(*KEY).agg(F.collect_set("pos").alias("_starts"))
    covered = F.array_distinct(F.flatten(F.transform("_starts", lambda p: F.array(*[p + k for k in range(WINDOW)]))))
    starts = starts.select(*KEY, covered.alias("_covered"))

    n = F.when(F.col(text).isNull(), 0).otherwise(F.size(lines_of(text))).cast("long")
    out = keyed.join(starts, KEY, "left").withColumns({
        "n_lines": n, "n_removed": F.when(F.col("_covered").isNull(), 0).otherwise(F.size("_covered")).cast("long"),
    })
    left = F.array_except(F.sequence(F.lit(0), F.col("n_lines").cast("int") - 1), "_covered")
    rest = F.array_join(F.transform(left, lambda p: F.element_at(lines_of(text), p + 1)), "\n")
    return out.withColumn(text, F.when(F.col("_covered").isNull(), F.col(text)).otherwise(rest)).drop(*KEY, "_covered")


ORACLE_SQL = """
WITH lines AS (
  SELECT doc_id, text, CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS ls FROM documents
), win AS (
  SELECT doc_id, pos, ls[pos + 1] AS a, ls[pos + 2] AS b, ls[pos + 3] AS c
  FROM (SELECT doc_id, ls, unnest(range(0, greatest(0, len(ls) - 2))) AS pos FROM lines)
), ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS rn FROM win
), covered AS (
  SELECT doc_id, list(DISTINCT p) AS cov
  FROM (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS p FROM ranked WHERE rn > 1) GROUP BY doc_id
)
SELECT l.doc_id,
       CAST(len(ls) AS BIGINT) AS n_lines,
       CAST(coalesce(len(cov), 0) AS BIGINT) AS n_removed,
       CASE WHEN cov IS NULL THEN text ELSE coalesce(array_to_string(
         list_transform(list_filter(range(0, len(ls)), lambda p: NOT list_contains(cov, p)), lambda p: ls[p + 1]), chr(10)), '') END AS text
FROM lines l LEFT JOIN covered c ON l.doc_id = c.doc_id
"""

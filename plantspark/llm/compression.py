"""Compression bands: texts are kept if zstandard shrinks them as much as prose of their length.

A text that shrinks far more than prose repeats itself, one that hardly shrinks is noise. What is usual
depends on the length, because a short text leaves the compressor little to refer to, so every limit is
given per power of two of the UTF-8 length. The ratio is taken over the whole text and over chunks of a
fixed size, so that a repetitive part inside a long text is seen as well.

The lower limits are fitted at run time, where labels are given: on all labelled good texts that pass the base rules; copies
count once. Per class of length, the limit lies under a low quantile (TAIL) of
their ratios by their spread (from there to the median), and by more of it the fewer they are. So it isn't at the smallest ratio
that happened to be seen. Classes with under FEWEST labelled good texts, and tables without labels, have the limits
of BANDS; a fitted limit is below that only if a labelled good text is. An id counts as good if all its labels are.

Null texts count as texts without words. Rows are judged one by one: repeated ids and rows each get their own
result, and an empty table gives an empty result. Only the id and the text are read, so other columns may
have any name.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantspark.llm.common import WORD, joined, map_texts, stored

SYMBOLS = "#*$%&|<>"
#: Smallest and largest ratio of prose by floor(log2(bytes)), at compression level 3; lengths outside use the nearest entry.
#: Wide, not fitted to any table: the upper limits lie below the ratio of random characters.
BANDS = {
    3: (0.90, 2.60), 4: (0.90, 1.90), 5: (0.80, 1.50), 6: (0.60, 1.30), 7: (0.42, 1.08), 8: (0.45, 0.88),
    9: (0.43, 0.78), 10: (0.41, 0.70), 11: (0.39, 0.64), 12: (0.37, 0.60), 13: (0.36, 0.57), 14: (0.35, 0.55),
    15: (0.34, 0.54), 16: (0.32, 0.54), 17: (0.30, 0.54),
}
#: Labelled good texts that a class needs; the quantile.
FEWEST, TAIL = 30, 0.01
#: Ratios are counted in bins of 1 / BINS before the few bins that hold a quantile are sorted.
BINS = 4096
#: The margin under the quantile is 1 + FEW / sqrt(texts) spreads.
FEW = 20


@dataclass(frozen=True)
class Limits:
    """level: of the compressor. chunk_bytes: size of a chunk; a last chunk under half of it joins the one
    before. bad_share: share of a text's chunks outside their band above which the text is rejected."""

    level: int = 3
    chunk_bytes: int = 2048
    bad_share: float = 0.34
    min_words: int = 10
    repeat_percent: int = 20


def length_class(n_bytes: int) -> int:
    return min(max(n_bytes.bit_length() - 1, min(BANDS)), max(BANDS))


def inside(n_bytes: int, ratio: float, bands: dict = BANDS) -> bool:
    low, high = bands[length_class(n_bytes)]
    return low <= ratio <= high


def lower_limit(wide: float, n: int, smallest: float, tail: float, middle: float) -> float:
    """wide: the limit without labels. The others are of n labelled good texts: smallest ratio, low quantile, median."""
    if n < FEWEST:
        return wide
    limit = tail - (middle - tail) * (1 + FEW / math.sqrt(n))
    return limit if smallest < wide else max(limit, wide)


def repeated_words(words: list[str], width: int = 5) -> int:
    """Words that lie in a window of `width` words found twice or more, the first one included."""
    if len(words) <= width:
        return 0
    index: dict[str, int] = {}
    codes = np.array([index.setdefault(w, len(index)) for w in words], dtype=np.int64)
    n = len(words) - width + 1
    bits = max(1, len(index).bit_length())
    if bits * width <= 63:
        keys = np.zeros(n, dtype=np.int64)
        for i in range(width):
            keys = (keys << bits) | codes[i : n + i]
    else:  # exact for any vocabulary: prefixes are numbered anew for each further word
        keys = codes[:n]
        for i in range(1, width):
            keys = np.unique((keys << 32) | codes[i : n + i], return_inverse=True)[1].astype(np.int64)
    order = np.sort(keys)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    starts = np.isin(keys, twice)
    return int((np.convolve(starts, np.ones(width, dtype=np.int64)) > 0).sum())


def chunks(raw: bytes, size: int) -> list[bytes]:
    cuts = list(range(0, len(raw), size))
    if len(cuts) > 1 and len(raw) - cuts[-1] < size // 2:
        cuts.pop()
    return [raw[a:b] for a, b in pairwise([*cuts, len(raw)])]


def measure(text: str | None, limits: Limits, packer: zstandard.ZstdCompressor, word=re.compile(WORD)) -> tuple:
    """What does not depend on the limits of the classes; last the compressed sizes of the chunks."""
    text = text or ""
    words = word.findall(text)
    lines = [line for line in text.split("\n") if line.strip(" \t\n\v\f\r")]
    repeats = repeated_words(words)
    failed = len(words) < limits.min_words or 100 * repeats > limits.repeat_percent * len(words)
    raw = text.encode()
    size = len(packer.compress(raw)) if raw else 0
    pieces = chunks(raw, limits.chunk_bytes) if raw else []
    packed = [size] if len(pieces) == 1 else [len(packer.compress(p)) for p in pieces]
    return (
        len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeats,
        failed, len(raw), size / len(raw) if raw else None, len(pieces), packed,
    )


def verdict(failed: bool, n_bytes: int, ratio: float | None, packed: list[int], limits: Limits, bands: dict) -> tuple[bool, int]:
    """kept, and the number of chunks outside their band. packed: compressed sizes of the chunks."""
    sizes = [limits.chunk_bytes] * (len(packed) - 1)
    sizes.append(n_bytes - sum(sizes))
    bad = sum(not inside(n, p / n, bands) for n, p in zip(sizes, packed, strict=False))
    return not failed and ratio is not None and inside(n_bytes, ratio, bands) and bad <= limits.bad_share * len(packed), bad


COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "n_bytes long, zstd_ratio double, n_chunks long, packed array<long>"
)
RESULT = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_bytes", "zstd_ratio",
    "n_chunks", "n_bad_chunks",
]


def measured(rows: DataFrame, text: str, limits: Limits) -> DataFrame:
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    kind_of = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "array<long>": pa.list_(pa.int64())}
    kinds = [kind_of[c.split()[1]] for c in COLUMNS.split(", ")]

    def make():
        packer = zstandard.ZstdCompressor(level=limits.level)

        def judge(texts: list) -> dict[str, pa.Array]:
            columns = list(zip(*[measure(t, limits, packer) for t in texts], strict=True)) or [()] * len(names)
            return {n: pa.array(c, type=k) for n, c, k in zip(names, columns, kinds, strict=True)}

        return judge

    return map_texts(rows, text, make, COLUMNS)


def judged(rows: DataFrame, limits: Limits, bands: dict) -> DataFrame:
    """Rows of `measured`, with kept and n_bad_chunks in the place of the compressed sizes."""
    needed = ["base_failed", "n_bytes", "zstd_ratio"]

    def make():
        def judge(packed: list) -> dict[str, pa.Array]:
            kept, bad = zip(*[verdict(*p, limits, bands) for p in packed], strict=True) if packed else ((), ())
            return {"kept": pa.array(kept, pa.bool_()), "n_bad_chunks": pa.array(bad, pa.int64())}

        return lambda facts: judge([(f["base_failed"], f["n_bytes"], f["zstd_ratio"], f["packed"]) for f in facts])

    facts = rows.withColumn("packed", F.struct(*needed, "packed"))
    return map_texts(facts, "packed", make, "kept boolean, n_bad_chunks long")


def quantiles(rows: DataFrame, shares: list[float]) -> dict[int, tuple[int, float, list[float]]]:
    """Per class `at`: the number of rows, the smallest zstd_ratio, and exact quantiles (interpolated, as `percentile` does).

    The driver gets numbers per bin, of which there are as many whatever the rows; only the bins that hold a wanted rank are sorted."""
    values = stored(rows.groupBy("at", "zstd_ratio").agg(F.count("*").alias("k")), "bands-ratios")
    values = values.withColumn("bin", F.floor(F.col("zstd_ratio") * BINS))
    counts: dict[int, list[tuple[int, int, float]]] = {}
    for r in values.groupBy("at", "bin").agg(F.sum("k").alias("n"), F.min("zstd_ratio").alias("low")).collect():
        counts.setdefault(r["at"], []).append((r["bin"], r["n"], r["low"]))
    wanted = []
    for at, bins in counts.items():
        bins.sort()
        ends = list(accumulate(n for _, n, _ in bins))
        for share in shares:
            place = (ends[-1] - 1) * share
            for rank in {math.floor(place), math.ceil(place)}:
                i = bisect_right(ends, rank)
                wanted.append((at, bins[i][0], rank, rank - (ends[i] - bins[i][1])))
    if not wanted:
        return {}
    asked = rows.sparkSession.createDataFrame(wanted, "at int, bin long, rank long, inside long").distinct()
    few = values.join(F.broadcast(asked.select("at", "bin").distinct()), ["at", "bin"], "left_semi")
    upto = F.sum("k").over(Window.partitionBy("at", "bin").orderBy("zstd_ratio"))
    found = few.withColumn("upto", upto).join(F.broadcast(asked), ["at", "bin"])
    found = found.filter("inside < upto and inside >= upto - k").select("at", "rank", "zstd_ratio").collect()
    ratio = {(r["at"], r["rank"]): r["zstd_ratio"] for r in found}

    def between(at: int, place: float) -> float:
        low, high = math.floor(place), math.ceil(place)
        a, z = ratio[at, low], ratio[at, high]
        return a if a == z else (high - place) * a + (place - low) * z

    sizes = {at: sum(n for _, n, _ in bins) for at, bins in counts.items()}
    return {at: (n, counts[at][0][2], [between(at, (n - 1) * share) for share in shares]) for at, n in sizes.items()}


def facts_of(docs: DataFrame, id_column: str, text: str, limits: Limits) -> DataFrame:
    """_id, _hash (of the text) and what `measure` finds."""
    return measured(docs.select(F.col(id_column).alias("_id"), F.xxhash64(text).alias("_hash"), F.col(text).alias("_text")), "_text", limits)


def bands_from(facts: DataFrame, labels: DataFrame, id_column: str) -> dict:
    """BANDS with lower limits from all labelled good texts among the measured."""
    good = labels.groupBy(F.col(id_column).alias("_id")).agg(F.min("quality").alias("_quality"))
    good = stored(good.filter("_id is not null and _quality = 1").select("_id"), "bands-good")
    rows = facts.filter("n_bytes > 0 and not base_failed").select("_id", "_hash", "n_bytes", "zstd_ratio")
    rows = joined(rows, good, ["_id"], "left_semi").select("_hash", "n_bytes", "zstd_ratio").distinct()
    bits = F.length(F.bin("n_bytes")) - 1
    rows = rows.select(F.least(F.greatest(bits, F.lit(min(BANDS))), F.lit(max(BANDS))).alias("at"), "zstd_ratio")
    found = quantiles(rows, [TAIL, 0.5])
    low = {at: lower_limit(BANDS[at][0], n, smallest, tail, middle) for at, (n, smallest, (tail, middle)) in found.items()}
    return {at: (low.get(at, wide), high) for at, (wide, high) in BANDS.items()}


def fitted(docs: DataFrame, labels: DataFrame, id_column: str, text: str, limits: Limits) -> dict:
    """BANDS with lower limits from all labelled good texts. Texts are not shuffled, only what was measured on them."""
    return bands_from(stored(facts_of(docs, id_column, text, limits), "bands-facts"), labels, id_column)


def compression_bands(docs: DataFrame, id_column: str = "doc_id", text: str = "text", limits: Limits = Limits(),
                      labels: DataFrame | None = None) -> DataFrame:
    """One row per document: the counts, the ratios, and `kept`. No shuffle of texts; one text is held at a time.

    labels: id_column and quality (1 for good), which the lower limits are fitted on. Every text is measured once; with labels,
    what was measured is stored, for the fit and the verdicts."""
    facts = facts_of(docs, id_column, text, limits)
    if labels is not None:
        facts = stored(facts, "bands-facts")
    found = judged(facts, limits, BANDS if labels is None else bands_from(facts, labels, id_column))
    return found.select(F.col("_id").alias(id_column), *RESULT)

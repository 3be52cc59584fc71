"""Language identification by fusing evidence with Bayes' rule.

For every record four kinds of evidence on its language are multiplied, as if independent given the language:

- text: byte trigrams of the letters, a naive Bayes model with one class per language and one, `und`, for text that is no known
  language, in which every trigram is equally likely. The model is fitted on about FIT_ROWS declared records per language.
- declared: the language that markup or metadata declares. How far to trust it is counted over all records:
  P(declared | language), smoothed.
- address suffix: the last label of the host (`fr`, `com`); P(suffix | language), counted the same way.
- host prior: the mix of languages on a host, smoothed towards its domain (the last two labels), that towards its suffix, and that towards
  the whole table. The counts are sums of text posteriors, made by grouped aggregates, without the record itself.

A record gets the language with the largest posterior. It is rejected (`kept` is false) if that is `und` or below
`least`. The share of trigrams counted is bounded (`most_grams`), because neighbouring trigrams depend on each other: beyond that
number a long text speaks with the weight of its first statistics, the average over all of its trigrams.

Only small columns are shuffled: texts become one row of log likelihoods each, and hosts are joined by equi-joins.

Defined cases: null or empty texts, and texts without letters, give no text evidence but are `und` by the rule that a record
without a trigram has no language; they are rejected. Null declared values, addresses and hosts give no evidence. Repeated ids and rows are judged
one by one. Other columns are not read. Empty tables give empty results; a table without any declared language has
only `und`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantspark.llm.common import KEY, map_texts, stored, with_key

LANGUAGES = ("de", "en", "es", "fr")
UNKNOWN = "und"
#: Records per language on which the text model is fitted.
FIT_ROWS = 2000
SLOTS = 1 << 16
MOST_GRAMS = 200.0
#: Prior weight of `und`; strength of each level of the host prior; smoothing of declared values and suffixes.
UNKNOWN_PRIOR, STRENGTH, SMOOTH = 0.002, 5.0, 1.0
#: Trigrams of an unknown script or of noise spread over so many values.
NOISE_GRAMS = 1 << 13


def trigrams(text: str | None) -> np.ndarray:
    """Slots of the byte trigrams of the lower-cased words; everything but letters counts as one space."""
    raw = (text or "").lower().encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, dtype=np.uint8)
    letter = ((data >= 97) & (data <= 122)) | (data >= 128)
    data = np.where(letter, data, np.uint8(32))
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = letter[1:] | letter[:-1]
    data = np.concatenate(([32], data[keep], [32])).astype(np.uint32)
    if not letter.any():
        return np.zeros(0, dtype=np.int64)
    code = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def fit(records: DataFrame, languages: tuple[str, ...], rows: int) -> np.ndarray:
    """Log likelihood of each slot per language, from about `rows` records of each."""
    known = records.filter(F.col("declared").isin(*languages) & F.col("text").isNotNull())
    sizes = {r["declared"]: r["n"] for r in known.groupBy("declared").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0)
    for language, n in sizes.items():  # about `rows` of each, chosen by a hash, whatever their number
        share = F.when(F.col("declared") == language, int(min(1.0, rows / n) * (1 << 30))).otherwise(share)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros((len(languages), SLOTS), dtype=np.int64)
        for batch in batches:
            for language, text in zip(batch["declared"], batch["text"], strict=True):
                table[languages.index(language)] += np.bincount(trigrams(text), minlength=SLOTS)
        at, slot = np.nonzero(table)
        yield pd.DataFrame({"language": at, "slot": slot, "n": table[at, slot]})

    sample = known.filter(F.pmod(F.xxhash64(*KEY), F.lit(1 << 30)) < share).select("declared", "text")
    counts = sample.mapInPandas(count, "language long, slot long, n long").groupBy("language", "slot").agg(F.sum("n").alias("n"))
    found = counts.toPandas()  # at most len(languages) * SLOTS rows
    table = np.full((len(languages), SLOTS), 0.5)
    table[found["language"].to_numpy(dtype=int), found["slot"].to_numpy(dtype=int)] += found["n"].to_numpy()
    return np.log(table / table.sum(axis=1, keepdims=True))


def text_evidence(records: DataFrame, model: np.ndarray, languages: tuple[str, ...], most: float) -> DataFrame:
    """The records without their text, with `grams` and `text_log`: a log likelihood per language and for `und`."""
    classes = len(languages) + 1
    table = np.ascontiguousarray(model.T.astype(np.float32))

    def make():
        def read(texts: list) -> dict[str, pa.Array]:
            logs, sizes = [], []
            for text in texts:
                slots = trigrams(text)
                mean = table[slots].mean(axis=0, dtype=np.float64) if len(slots) else np.zeros(classes - 1)
                logs.append(np.append(mean, -np.log(NOISE_GRAMS)) * min(float(len(slots)), most))
                sizes.append(len(slots))
            return {"grams": pa.array(sizes, pa.int64()), "text_log": pa.array(logs, pa.list_(pa.float64()))}

        return read

    return map_texts(records, "text", make, "grams long, text_log array<double>")


def normalised(logs: Column) -> Column:
    """Probabilities from logs."""
    top = F.array_max(logs)
    powers = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def added(*arrays: Column) -> Column:
    """Sums by position; a null array adds nothing."""
    out = arrays[0]
    for more in arrays[1:]:
        out = F.when(more.isNull(), out).otherwise(F.zip_with(out, more, lambda a, b: a + b))
    return out


def sums(classes: int, name: str = "p") -> Column:
    return F.array(*[F.sum(F.element_at(name, i + 1)) for i in range(classes)])


def conditional(records: DataFrame, column: str, classes: int) -> DataFrame:
    """column, `column`_log: log P(value | language) from posteriors summed over all records, smoothed over the values."""
    counts = records.filter(F.col(column).isNotNull()).groupBy(column).agg(sums(classes).alias("n"))
    totals = counts.agg(F.array(*[F.sum(F.element_at("n", i + 1)) for i in range(classes)]).alias("t"), F.count("*").alias("k"))
    counts = stored(counts, f"language-{column}")
    total = counts.agg(sums(classes, "n").alias("t"), F.count("*").alias("k")).first()
    totals = F.array(*[F.lit(float(t or 0.0)) for t in total["t"]])
    log = F.zip_with("n", totals, lambda n, t: F.log((n + SMOOTH) / (t + SMOOTH * total["k"])))
    return counts.select(column, log.alias(f"{column}_log"))


def small_join(left: DataFrame, right: DataFrame, on: str, limit: int = 100_000) -> DataFrame:
    """Left join; the right side is broadcast only up to `limit` rows."""
    few = right.count() <= limit
    return left.join(F.broadcast(right) if few else right, on, "left")


def host_priors(records: DataFrame, classes: int, start: list[float]) -> DataFrame:
    """host, host_n (summed posteriors of the host), domain_p (what it is smoothed towards)."""
    hosts = stored(
        records.filter("host is not null").groupBy("host", "domain", "suffix").agg(sums(classes).alias("host_n")), "language-hosts"
    )

    def smoothed(rows: DataFrame, key: str, parent: Column) -> DataFrame:
        total = F.aggregate("n", F.lit(0.0), lambda a, b: a + b)
        return rows.withColumn(f"{key}_p", F.zip_with("n", parent, lambda n, p: (n + STRENGTH * p) / (total + STRENGTH))).drop("n")

    table = [float(x or 0.0) for x in hosts.agg(sums(classes, "host_n").alias("n")).first()["n"]]
    whole = F.array(*[F.lit((n + STRENGTH * p) / (sum(table) + STRENGTH)) for n, p in zip(table, start, strict=True)])
    by_suffix = hosts.groupBy("suffix").agg(sums(classes, "host_n").alias("n"))
    by_suffix = stored(smoothed(by_suffix, "suffix", whole), "language-suffixes")
    by_domain = hosts.groupBy("domain", "suffix").agg(sums(classes, "host_n").alias("n"))
    by_domain = small_join(by_domain, by_suffix, "suffix")
    by_domain = stored(smoothed(by_domain, "domain", F.col("suffix_p")).select("domain", "domain_p"), "language-domains")
    return stored(small_join(hosts, by_domain, "domain").select("host", "host_n", "domain_p"), "language-priors")


def identify(records: DataFrame, languages: tuple[str, ...] = LANGUAGES, fit_rows: int = FIT_ROWS,
             most_grams: float = MOST_GRAMS, least: float = 0.5) -> DataFrame:
    """records: id columns, text, declared, host (nulls allowed). Returns the records without their text and with
    language, posterior, evidence (log likelihoods of the text), grams, kept."""
    classes = len(languages) + 1
    names = F.array(*map(F.lit, [*languages, UNKNOWN]))
    start = [(1 - UNKNOWN_PRIOR) / len(languages)] * len(languages) + [UNKNOWN_PRIOR]
    ids = [c for c in records.columns if c not in ("text", "declared", "host")]
    rows = with_key(records.withColumn("_id", F.struct(*ids)), "_id", "text").drop("_id")
    labels = F.split("host", "\\.")
    rows = rows.withColumns({
        "declared": F.lower(F.substring_index(F.trim("declared"), "-", 1)), "suffix": F.element_at(labels, -1),
        "domain": F.when(F.size(labels) > 1, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(F.col("host")),
    })
    model = fit(rows, languages, fit_rows)
    read = text_evidence(rows, model, languages, most_grams)
    prior = F.array(*[F.lit(float(np.log(p))) for p in start])
    read = stored(read.drop(*KEY).withColumn("p", normalised(added(F.col("text_log"), prior))), "language-text")

    fused = small_join(read, conditional(read, "declared", classes), "declared")
    fused = small_join(fused, conditional(read, "suffix", classes), "suffix")
    fused = small_join(fused, host_priors(read, classes, start), "host")
    others = F.zip_with("host_n", "p", lambda n, p: F.greatest(n - p, F.lit(0.0)))
    weight = F.aggregate("others", F.lit(0.0), lambda a, b: a + b) + STRENGTH
    fused = fused.withColumn("others", others)
    host = F.zip_with("others", "domain_p", lambda n, p: F.log((n + STRENGTH * p) / weight))
    host = F.when(F.col("host").isNull(), prior).otherwise(host)
    fused = fused.withColumn("posteriors", normalised(added(F.col("text_log"), host, F.col("declared_log"), F.col("suffix_log"))))
    best = F.array_max("posteriors")
    language = F.when(F.col("grams") == 0, F.lit(UNKNOWN)).otherwise(F.element_at(names, F.array_position("posteriors", best).cast("int")))
    out = fused.select(*ids, "declared", "host", language.alias("language"), best.alias("posterior"), F.col("text_log").alias("evidence"), "grams")
    return out.withColumn("kept", (F.col("language") != UNKNOWN) & (F.col("posterior") >= least))


def page_records(pages: DataFrame) -> DataFrame:
    """page_id, text, declared, host of raw pages: visible text, the markup's language, the address's host."""
    html = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    declared = F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]+)", 1)
    host = F.regexp_extract(F.lower("url"), r"^[a-z]+://(?:[^/@?#]*@)?([^/:?#]+)", 1)
    return pages.select(
        "page_id", F.regexp_replace(html, r"<[^>]*>|&[a-zA-Z#0-9]+;", " ").alias("text"),
        F.when(declared != "", declared).alias("declared"), F.when(host != "", host).alias("host"),
    )


def document_records(docs: DataFrame) -> DataFrame:
    """doc_id, text, declared, host of documents; a source is the host of its documents."""
    return docs.select("doc_id", "text", F.col("lang").alias("declared"), F.col("source").alias("host"))

"""Audit of filters in every order of application, with the Hart-Mas-Colell potential.

Five filters fail documents on their text. For a part of the table (its documents of one language) the removal game has
as players the filters and as worth of a coalition the number of documents that fail at least one of its members. A
coalition is a number of five bits. What a step of an order keeps and removes are worths and differences of worths of
two coalitions: the filters before the step, and those with its own.

The potential P of a game is 0 for nobody, and for a coalition S the mean over its members i of P(S without i), plus
worth(S) / |S|. It is computed over the 32 coalitions in the order of their numbers, times 60, which makes every
value an integer. The Shapley value of a filter is P(all) - P(all without it); over the 120 orders it removes 120 times
that.

Every text is read once, in Arrow batches, and becomes a mask of the filters that it fails by itself and a 128-bit
BLAKE2 digest. Copies are then counted, not listed: rows of one text, part, mask and labels become one row before a shuffle by
text, so a text that fills a third of the table costs what any other does. The parts end as 32 numbers each.

Defined cases: a null text is empty. A null language belongs to the part of the empty string. A row without id is no copy of
another (no id is smaller), and none is a copy of it. Rows equal in id and text are not copies of each other, but each of
one with a smaller id. A document with several labels is good if one says quality 1, toxic if one says toxic 1; labels without id
belong to none. Other columns are not read. An empty table has no parts, so the result is empty.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import blake2b
from itertools import permutations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantspark.llm.common import joined, map_texts, stored

FILTERS = "ABCDE"
#: Fewer words than this fail A; a smaller percentage of distinct words fails B; a larger one of capitals fails C.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3
CAPITALS, SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
#: 60 is divisible by the size of every coalition, and so are the sums of values so far.
SCALE = 60
COPY = 1 << FILTERS.index("E")
ALL = (1 << len(FILTERS)) - 1


def masks() -> Callable[[pa.Array], dict[str, pa.Array]]:
    def own(raw: bytes, points: int) -> int:
        words = raw.split()  # of bytes: at the six white-space characters
        failed = (
            len(words) < LEAST_WORDS,
            100 * len(set(words)) < LEAST_DISTINCT * len(words),
            100 * (len(raw) - len(raw.translate(None, CAPITALS))) > MOST_CAPITALS * points,
            len(raw) != len(raw.translate(None, SYMBOLS)),
        )
        return sum(1 << i for i, f in enumerate(failed) if f)

    def of_texts(texts: pa.Array) -> dict[str, pa.Array]:
        texts = texts.fill_null("")
        points = pc.utf8_length(texts).to_pylist()
        found, digests = [], []
        for value, n in zip(texts.cast(pa.binary()), points, strict=True):
            raw = value.as_py()
            found.append(own(raw, n))
            digests.append(blake2b(raw, digest_size=16).digest())
        return {"mask": pa.array(found, pa.int32()), "digest": pa.array(digests, pa.binary())}

    return of_texts


def facts(docs: DataFrame, id_column: str, text: str, part: str) -> DataFrame:
    """id, part, mask (of the filters that look at one text), digest: a row per document."""
    named = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"), F.col(text).alias("text"))
    return map_texts(named, "text", masks, "mask int, digest binary", as_list=False)


def labelled(rows: DataFrame, labels: DataFrame, id_column: str) -> DataFrame:
    """Adds good and toxic, 0 or 1."""
    says = [F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]
    known = labels.filter(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("id")).agg(*says)
    known = stored(known.filter("good + toxic > 0"), "audit-labels")
    out = joined(rows.filter("id is not null"), known, ["id"], "left").unionByName(rows.filter("id is null"), allowMissingColumns=True)
    return out.fillna(0, ["good", "toxic"])


def counted(rows: DataFrame) -> DataFrame:
    """Documents by part and mask, now with the bit of copies: n, good, toxic."""
    kind = ["digest", "part", "mask", "good", "toxic"]
    same = rows.groupBy(*kind, "id").agg(F.count("*").alias("n"))
    # of each kind the rows with the smallest id, and all others
    same = same.groupBy(*kind).agg(
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first"),
        F.sum(F.when(F.col("id").isNotNull(), F.col("n")).otherwise(0)).alias("n"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("without_id"),
    )
    least = F.min("first.id").over(Window.partitionBy("digest"))  # as many rows as a text has kinds
    kept = F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    same = same.withColumn("least", least).withColumn("kept", kept)
    split = F.explode(
        F.array(
            F.struct(F.lit(0).alias("copy"), (F.col("kept") + F.col("without_id")).alias("n")),
            F.struct(F.lit(COPY).alias("copy"), (F.col("n") - F.col("kept")).alias("n")),
        )
    )
    same = same.select("part", "mask", "good", "toxic", split.alias("x")).filter("x.n > 0")
    return same.groupBy("part", F.col("mask").bitwiseOR(F.col("x.copy")).alias("mask")).agg(
        F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("good")).alias("good"), F.sum(F.col("x.n") * F.col("toxic")).alias("toxic")
    )


def worths(cells: DataFrame) -> DataFrame:
    """A row per part: total, and of each coalition (by number) the documents it removes, the good and the toxic ones."""
    held = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"), F.sum("n").alias("total"))

    def of_coalitions(what: str) -> Column:
        def worth(coalition: Column) -> Column:
            zero = F.lit(0).cast("long")
            return F.aggregate("cells", zero, lambda sum_, c: sum_ + F.when(c["mask"].bitwiseAND(coalition) != 0, c[what]).otherwise(zero))

        return F.transform(F.sequence(F.lit(0), F.lit(ALL)), worth)

    return held.select("part", "total", *[of_coalitions(c).alias(f"v_{c}") for c in ("n", "good", "toxic")])


def potentials(worth: str) -> Column:
    """SCALE times the potential of each coalition."""

    def step(found: Column, coalition: Column) -> Column:
        inside = [coalition.bitwiseAND(F.lit(1 << i)) != 0 for i in range(len(FILTERS))]
        size = sum((F.when(x, 1).otherwise(0) for x in inside), F.lit(0))
        below = [F.when(x, F.get(found, coalition.bitwiseXOR(F.lit(1 << i)))).otherwise(0) for i, x in enumerate(inside)]
        total = sum(below, F.get(F.col(worth), coalition) * SCALE)
        return F.concat(found, F.array((total / size).cast("long")))

    start = F.array(F.lit(0).cast("long"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ALL)), start, step)


def audit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """A row per part, filter_order (each order of the five letters) and step (1 to 5): kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley."""
    rows = stored(facts(docs, id_column, text, part), "audit-facts")
    games = worths(counted(labelled(rows, labels, id_column)))
    games = stored(games.withColumn("potential", potentials("v_n")), "audit-games")

    orders = F.explode(F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)]))
    steps = games.withColumn("filter_order", orders).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))

    def coalition(letters: Column) -> Column:
        return sum((F.when(F.instr(letters, x) > 0, 1 << i).otherwise(0) for i, x in enumerate(FILTERS)), F.lit(0))

    order = F.col("filter_order")
    steps = steps.withColumns({
        "_own": coalition(F.substring(order, F.col("step"), F.lit(1))),
        "_before": coalition(F.substring(order, F.lit(1), F.col("step") - 1)),
    }).withColumn("_after", F.col("_before").bitwiseOR(F.col("_own")))

    def at(array: str, coalition_: Column) -> Column:
        return F.get(F.col(array), coalition_)

    own, before, after, others = F.col("_own"), F.col("_before"), F.col("_after"), F.lit(ALL).bitwiseXOR(F.col("_own"))
    gone = at("v_n", after) - at("v_n", before)
    orders_n = len(list(permutations(FILTERS)))
    return steps.select(
        "part", "filter_order", "step",
        (F.col("total") - at("v_n", after)).alias("kept"),
        gone.alias("removed"),
        (at("v_n", own) - gone).alias("redundant"),
        (at("v_n", F.lit(ALL)) - at("v_n", others)).alias("unique_fails"),
        (at("v_good", after) - at("v_good", before)).alias("good_lost"),
        (at("v_toxic", after) - at("v_toxic", before)).alias("toxic_lost"),
        ((at("potential", F.lit(ALL)) - at("potential", others)) * (orders_n // SCALE)).alias("shapley"),
    )


#: DuckDB SQL for the rows of `audit` over documents and labels; it walks all orders instead of taking potentials.
ORACLE_SQL = r"""
with texts as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents),
said as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels where doc_id is not null group by doc_id),
least as (select text, min(doc_id) as first from texts group by text),
failed as (
  select t.part, coalesce(s.good, 0) as good, coalesce(s.toxic, 0) as toxic,
         len(words) < 200 as a,
         100 * len(list_distinct(words)) < 50 * len(words) as b,
         100 * len(regexp_extract_all(t.text, '[A-Z]')) > 3 * length(t.text) as c,
         regexp_matches(t.text, '[#$%&*|]') as d,
         coalesce(t.doc_id > l.first, false) as e
  from texts t join least l on t.text = l.text left join said s on t.doc_id = s.doc_id),
cells as (
  select part, a::int + 2 * b::int + 4 * c::int + 8 * d::int + 16 * e::int as mask, count(*) as n, sum(good) as good, sum(toxic) as toxic
  from failed group by all),
letters as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) as x(letter, bit)),
orders as (
  select p.letter || q.letter || r.letter || s.letter || t.letter as filter_order
  from letters p, letters q, letters r, letters s, letters t
  where p.bit | q.bit | r.bit | s.bit | t.bit = 31),
steps as (
  select filter_order, step, x.letter, x.bit,
         (select coalesce(sum(bit), 0) from letters where contains(substr(filter_order, 1, step - 1), letter)) as before
  from orders, range(1, 6) as k(step), letters x where x.letter = substr(filter_order, step, 1)),
counts as (
  select part, filter_order, step::int as step, letter,
         sum(case when mask & (before::int | bit) = 0 then n else 0 end) as kept,
         sum(case when mask & bit <> 0 and mask & before::int = 0 then n else 0 end) as removed,
         sum(case when mask & bit <> 0 and mask & before::int <> 0 then n else 0 end) as redundant,
         sum(case when mask = bit then n else 0 end) as unique_fails,
         sum(case when mask & bit <> 0 and mask & before::int = 0 then good else 0 end) as good_lost,
         sum(case when mask & bit <> 0 and mask & before::int = 0 then toxic else 0 end) as toxic_lost
  from cells, steps group by all)
select part, filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
       unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
       (sum(removed) over (partition by part, letter))::bigint as shapley
from counts
"""

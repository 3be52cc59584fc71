"""Raw bus messages: (topic, payload, arrived_at), as a table or a stream, and their first decoding."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plantspark.schemas import MESSAGE

# The topics a plant publishes on; `+` stands for one level.
TOPICS = ["/plant/data/+", "/plant/tracking/+", "/plant/alerts/+"]

# Files and bus records that one micro-batch takes from a backlog.
FILES_PER_BATCH, OFFSETS_PER_BATCH = 1000, 5_000_000

# Numbers that JSON does not have, where a value stands; some senders write them.
NOT_JSON = r"(?<=[:\\[,\\s])(-?Infinity|NaN)(?=[,}\\]\\s])"

# JSON types that count as numbers, besides decimals of any size; booleans are 1 and 0.
NUMERIC = "'BIGINT', 'DOUBLE', 'FLOAT', 'BOOLEAN'"


def read_messages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Stored messages as a batch."""
    return spark.read.format(fmt).schema(MESSAGE).load(path)


def message_stream(spark: SparkSession, path: str, fmt: str = "parquet", max_files: int = FILES_PER_BATCH) -> DataFrame:
    """Stored messages as a stream that follows new files; a backlog is taken in portions of `max_files`."""
    return spark.readStream.format(fmt).schema(MESSAGE).option("maxFilesPerTrigger", max_files).load(path)


def bus_options(servers: str, topic: str, max_offsets: int = OFFSETS_PER_BATCH, starting: str = "earliest") -> dict[str, str]:
    """Options of a Kafka reader for the bus topic; a backlog is taken in portions."""
    return {
        "kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting,
        "maxOffsetsPerTrigger": str(max_offsets), "failOnDataLoss": "true",
    }


def bus_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Messages of a Kafka topic as a stream; needs Spark's Kafka package on the cluster."""
    return from_bus_records(spark.readStream.format("kafka").options(**bus_options(servers, topic, **options)).load())


def from_bus_records(records: DataFrame) -> DataFrame:
    """Rows of a Kafka-style source (key = plant topic, value = payload) as messages."""
    return records.select(
        F.col("key").cast("string").alias("topic"),
        F.col("value").cast("string").alias("payload"),
        F.col("timestamp").alias("arrived_at"),
    )


def topic_matches(topic: Column, pattern: str) -> Column:
    """Whether a topic fits a subscription pattern, where `+` is exactly one level."""
    levels = [r"[^/]*" if level == "+" else re.escape(level) for level in pattern.split("/")]
    return topic.rlike("^" + "/".join(levels) + "$")


def subscribed(messages: DataFrame, patterns: list[str] | None = None) -> DataFrame:
    """Messages on any of the subscribed topics."""
    wanted = F.lit(False)
    for pattern in patterns or TOPICS:
        wanted = wanted | topic_matches(F.col("topic"), pattern)
    return messages.where(wanted)


def _is_numeric(kind: str) -> str:
    return f"({kind} in ({NUMERIC}) or startswith({kind}, 'DECIMAL'))"


def entry(value: str) -> str:
    """Variant as (kind, text, number): JSON type, text form, value if it is a number; NULL for no variant."""
    kind = f"schema_of_variant({value})"
    return (
        f"if({value} is null, null, named_struct('kind', {kind}, 'text', try_variant_get({value}, '$', 'string'),"
        f" 'number', if({_is_numeric(kind)}, try_variant_get({value}, '$', 'double'), null)))"
    )


def _mended(payload: str) -> str:
    """A payload that is no JSON only because of NaN or an infinity is read with null in their place."""
    return f"if({payload} rlike '{NOT_JSON}', try_parse_json(regexp_replace({payload}, '{NOT_JSON}', 'null')), null)"


def numeric_fields(body: str = "body") -> str:
    """Map of the numeric and boolean entries of a decoded body, as doubles."""
    return (
        f"map_filter(transform_values({body}, (name, v) -> if({_is_numeric('schema_of_variant(v)')},"
        f" try_variant_get(v, '$', 'double'), null)), (name, n) -> n is not null)"
    )


def made_once(rows: DataFrame, keep: list[str], **columns: str) -> DataFrame:
    """Adds columns that come out of a generator, below which filters are not moved: each use would make them again."""
    inside = ", ".join(f"'{name}', {expression}" for name, expression in columns.items())
    return rows.selectExpr(*keep, f"inline(array(named_struct({inside})))")


def decode(messages: DataFrame) -> DataFrame:
    """Parses payloads once, keeping JSON types apart: the text "5" is no number, null is not absent.

    Adds `readable` (it is JSON), `is_object`, `entity`, `event` and `stamp` as structs (kind, text,
    number) with the kind VOID for a JSON null; `data`, a variant, and its `data_kind`; and its entries as the map `body` of
    raw values. Nothing of that is made for a query that does not ask for it, but for the parsing.
    """
    keep = messages.columns
    parsed = made_once(messages, keep, _body=f"coalesce(try_parse_json(payload), {_mended('payload')})")
    head = {"entity": "entity", "event": "event", "stamp": "timestamp"}
    split = parsed.selectExpr(
        *keep, "_body is not null as readable",
        *[f"try_variant_get(_body, '$.{key}', 'variant') as {name}" for name, key in head.items()],
        "try_variant_get(_body, '$.data', 'variant') as data",
        "try_variant_get(_body, '$.data', 'map<string,variant>') as body",
    )
    return split.selectExpr(
        *keep, "readable",
        "readable and substr(ltrim(' \t\r\n', payload), 1, 1) = '{' as is_object",
        *[f"{entry(name)} as {name}" for name in head],
        "body", "data",
        "if(body is not null, if(size(body) > 0, 'OBJECT', 'OBJECT<>'), schema_of_variant(data)) as data_kind",
    )


def with_entries(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds entries of the data as structs (kind, text, number), named `entry_<key>`; NULL where the key is absent."""
    raw = rows.selectExpr("*", *[f"try_variant_get(data, '$.{key}', 'variant') as _{key}" for key in keys])
    return raw.selectExpr(*rows.columns, *[f"{entry(f'_{key}')} as entry_{key}" for key in keys])


def route(decoded: DataFrame, deposit_as_piece: bool = True) -> DataFrame:
    """Adds `kind`: sensor, piece, machine, unknown, or bad_json.

    `deposit_as_piece` sends deposits of a known piece to piece tracking, where the production
    reports look for them; without it only the entity `piece` does.
    """
    is_piece = "(entity.kind = 'STRING' and entity.text = 'piece')"
    if deposit_as_piece:
        is_piece += " or (event.text = 'deposit' and try_variant_get(data, '$.piece_id', 'string') <> '')"
    return decoded.selectExpr(
        "*",
        f"""case when not readable then 'bad_json' when contains(topic, '/plant/data/') then 'sensor'
          when contains(topic, '/plant/tracking/') and ({is_piece}) then 'piece'
          when contains(topic, '/plant/tracking/') then 'machine' else 'unknown' end as kind""",
    )

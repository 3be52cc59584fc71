"""Routed messages to typed measurement rows, and the reasons why some are refused."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plantspark.functions.numbers import gibibytes, number_from_text
from plantspark.functions.plant import event_status, machine_type, piece_material, station_distance
from plantspark.functions.rules import DEFAULTS, Thresholds, anomalies, described
from plantspark.functions.stamps import parse_timestamp
from plantspark.schemas import SENSOR_FIELDS
from plantspark.sources.messages import made_once, numeric_fields, with_entries

#: Entries of the data that decide whether a message is refused.
JUDGED = ["piece_id", "duration", "tool_wear", "cycle_time"]
MADE_BY_DECODE = [
    "readable", "is_object", "entity", "event", "stamp", "body", "data", "data_kind", "kind", "reason",
    *[f"entry_{key}" for key in JUDGED],
]


def _data(key: str) -> str:
    """Entry of the message's data: a struct (kind, text, number), NULL when the key is absent. See `with_entries`."""
    return f"entry_{key}"


def _is_text(entry: str) -> str:
    return f"coalesce({entry}.kind = 'STRING', false)"


def _text(entry: str, null_text: str | None = None) -> str:
    """Value as tag text. A JSON null gives `null_text`; a missing key always gives NULL."""
    of_null = "null" if null_text is None else f"'{null_text}'"
    return f"case {entry}.kind when 'VOID' then {of_null} when 'BOOLEAN' then initcap({entry}.text) else {entry}.text end"


def _falsy(entry: str) -> str:
    """Absent, null, empty or zero."""
    empty = f"{entry}.kind = 'VOID' or {entry}.text in ('', '[]', '{{}}') or {entry}.number = 0"
    return f"({entry} is null or coalesce({empty}, false))"


def _float(entry: str) -> str:
    """Number, boolean or number text as a double; NULL for anything else."""
    return f"coalesce({entry}.number, if({entry}.kind = 'STRING', {number_from_text(entry + '.text')}, null))"


def _uncastable(entry: str) -> str:
    """The key is there but its value is no number."""
    return f"({entry} is not null and {_float(entry)} is null)"


def _first_reason(*cases: tuple[str, str]) -> str:
    return "case " + " ".join(f"when {broken} then '{reason}'" for broken, reason in cases) + " end"


def reject_reason() -> str:
    """Why a routed message cannot become a row; NULL when it can."""
    no_object = ("not is_object", "not_object")
    no_entity = (_falsy("entity"), "missing_entity")
    no_event = (_falsy("event"), "missing_event")
    bad_event = (f"not {_is_text('event')}", "bad_event")
    bad_stamp = (f"not {_falsy('stamp')} and not {_is_text('stamp')}", "bad_timestamp")
    no_data = ("data_kind is null or data_kind in ('VOID', 'OBJECT<>')", "missing_data")
    bad_data = ("not startswith(data_kind, 'OBJECT')", "bad_data")
    sensor = _first_reason(
        no_object, no_entity, no_data, bad_stamp, (f"not {_is_text('entity')}", "bad_entity"), bad_data,
    )
    machine = _first_reason(
        no_object, no_entity, no_event, bad_stamp, bad_data,
        (_uncastable(_data("duration")), "bad_duration"), bad_event,
        (_uncastable(_data("tool_wear")), "bad_tool_wear"),
        (f"event.text = 'processing_end' and {_uncastable(_data('cycle_time'))}", "bad_cycle_time"),
    )
    piece = _first_reason(
        no_object, no_event, no_data, bad_stamp, bad_data,
        (_falsy(_data("piece_id")), "missing_piece_id"), (f"not {_is_text(_data('piece_id'))}", "bad_piece_id"),
        bad_event, (f"not endswith(event.text, 'start') and {_uncastable(_data('duration'))}", "bad_duration"),
    )
    return (
        f"case kind when 'bad_json' then 'bad_json' when 'unknown' then 'unknown_topic'"
        f" when 'sensor' then {sensor} when 'machine' then {machine} else {piece} end"
    )


def check(routed: DataFrame) -> DataFrame:
    """Adds `reason`, NULL for messages that can be normalised, and the entries it was found from."""
    rows = with_entries(routed, JUDGED)
    return made_once(rows, [c for c in rows.columns if c != "kind"], kind="kind", reason=reject_reason())


def stamped(rows: DataFrame) -> DataFrame:
    """Adds `_time`, the stamp or else the arrival, and `ts_defaulted`, whether it was the arrival."""
    read = f"if({_is_text('stamp')}, {parse_timestamp('stamp.text')}, null)"
    return rows.selectExpr("*", f"{read} as _stamp").selectExpr(
        "*", "coalesce(_stamp, arrived_at) as _time", "_stamp is null as ts_defaulted",
    ).drop("_stamp")


def accepted(checked: DataFrame, kind: str) -> DataFrame:
    """Sound messages of one kind; those on other topics are dropped before they are parsed."""
    topic = "/plant/data/" if kind == "sensor" else "/plant/tracking/"
    return checked.where(f"contains(topic, '{topic}') and kind = '{kind}' and reason is null")


def rejects(checked: DataFrame) -> DataFrame:
    return checked.where("reason is not null").select("topic", "payload", "arrived_at", "reason")


def numeric_fields_long(decoded: DataFrame) -> DataFrame:
    """One row per numeric entry of the data: `_field`, `_value`."""
    keep = [c for c in decoded.columns if c not in MADE_BY_DECODE]
    return decoded.select(*keep, F.explode(F.expr(numeric_fields())).alias("_field", "_value"))


def sensor_readings(checked: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Rows of `sensor_data`: tags, declared fields, other numeric fields, anomalies."""
    declared = ", ".join(f"'{f}'" for f in SENSOR_FIELDS)
    rows = stamped(accepted(checked, "sensor")).selectExpr(
        "_time", "entity.text as machine", f"{numeric_fields()} as numbers", "ts_defaulted",
    )
    wide = rows.selectExpr(
        "_time", "machine", f"{machine_type('machine')} as machine_type", "'workshop_A' as location",
        *[f"try_element_at(numbers, '{f}') as {f}" for f in SENSOR_FIELDS],
        f"map_filter(numbers, (name, v) -> name not in ({declared})) as extra_fields",
        "ts_defaulted",
    )
    return wide.selectExpr(
        "_time", "machine", "machine_type", "location", *SENSOR_FIELDS, "extra_fields",
        f"transform({anomalies(limits=limits)}, a -> {described('a')}) as anomalies", "ts_defaulted",
    )


def machine_events(checked: DataFrame, null_text: str | None = None) -> DataFrame:
    """Rows of `machine_events`; `null_text` is what a tag that is JSON null is written as."""
    event, status = "event.text", _data("status")
    given = f"if({status} is not null, {_text(status)}, 'unknown')"
    return stamped(with_entries(accepted(checked, "machine"), ["tool", "status"])).selectExpr(
        "_time",
        f"{_text('entity')} as machine",
        f"{event} as event_type",
        f"{_text(_data('piece_id'), null_text)} as piece_id",
        f"{_text(_data('tool'), null_text)} as tool",
        f"coalesce({_float(_data('duration'))}, if(contains({event}, 'start'), 0d, null)) as duration",
        f"{event_status(event, given)} as status",
        f"{_float(_data('tool_wear'))} as tool_wear",
        f"if({event} = 'processing_end', {_float(_data('cycle_time'))}, null) as cycle_time",
        "ts_defaulted",
    )


def piece_movements(checked: DataFrame, null_text: str | None = None) -> DataFrame:
    """Rows of `piece_tracking`."""
    event, piece = "event.text", f"{_data('piece_id')}.text"
    origin, target, priority = _data("from"), _data("to"), _data("priority")
    distance = station_distance(_text(origin, "None"), _text(target, "None"))
    return stamped(with_entries(accepted(checked, "piece"), ["from", "to", "priority"])).selectExpr(
        "_time",
        f"{piece} as piece_id",
        f"{event} as event_type",
        f"{_text(origin, null_text)} as from_station",
        f"{_text(target, null_text)} as to_station",
        f"{piece_material(piece)} as material",
        f"if(endswith({event}, 'start'), 0d, {_float(_data('duration'))}) as duration",
        f"if({origin} is not null and {target} is not null, {distance}, null) as distance",
        "cast(null as string) as operator",
        f"cast(if({priority} is null, 3, {_float(priority)}) as bigint) as priority",
        "ts_defaulted",
    )


def system_samples(samples: DataFrame) -> DataFrame:
    """Rows of `system_tracking` from host samples; a metric that was not taken counts as 0.

    Memory arrives in bytes (`memory_total`, `memory_available`) and leaves in GiB.
    """
    return samples.selectExpr(
        "_time",
        "'event_processor' as component",
        "'system_resources' as metric_type",
        "'info' as severity",
        "coalesce(round(cpu, 2), 0d) as cpu",
        f"coalesce({gibibytes('memory_available')}, 0d) as free_memory",
        f"coalesce({gibibytes('memory_total')}, 0d) as ram",
        "cast(coalesce(errors, 0) as bigint) as errors",
        "coalesce(round(memory_used_percent, 2), 0d) as memory_used_percent",
        "coalesce(uptime_seconds, 0d) as uptime_seconds",
    )

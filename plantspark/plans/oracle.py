"""The same results in ANSI SQL over the benchmark tables, one text per catalogue entry.

Figures are shifted and rounded as in the catalogue.
"""

from __future__ import annotations

START, STOP = "timestamp '2024-01-01 00:00:00'", "timestamp '2024-01-31 00:00:00'"
RANGE = f"_time >= {START} and _time < {STOP}"
_STATION = " when 0 then 'Warehouse' when 1 then 'Saw1' when 2 then 'Milling1' when 3 then 'Milling2' else 'Lathe1' end"

VIEWS = {
    "base": """
select event_id, ts as _time, user_id, event_type, value, cast(json_extract_string(props, '$.k') as int) as k,
  case user_id % 4 when 0 then 'Milling1' when 1 then 'Milling2' when 2 then 'Lathe1' else 'Saw1' end as machine,
  case when user_id % 4 < 2 then 'Milling' when user_id % 4 = 2 then 'Lathe' else 'Saw' end as machine_type
from events""",
    "sensor_wide": """
select event_id, _time, machine, machine_type, 'workshop_A' as location,
  20.0e0 + value/4 as temperature, value/50 as power,
  case when machine_type = 'Milling' then value/100 end as vibration_level,
  case when machine_type in ('Milling','Lathe') then value*10 end as rpm_spindle
from base""",
    "sensor_long": """
select event_id, _time, machine, machine_type,
  case event_type when 'view' then 'temperature' when 'click' then 'power' when 'error' then 'vibration_level'
    when 'purchase' then 'rpm_spindle' else 'feed_rate' end as _field,
  value as _value
from base""",
    "machine_events": """
select event_id, _time, machine,
  case event_type when 'click' then 'processing_start' when 'purchase' then 'processing_end'
    when 'signup' then 'setup_start' when 'view' then 'setup_end' else 'deposit' end as event_type,
  concat('PZ', lpad(cast(k as varchar(10)), 3, '0')) as piece_id,
  case k % 7 when 0 then 'TM10' when 1 then 'TM25' when 2 then 'TM12' when 3 then 'TM30'
    when 4 then 'TL05' when 5 then 'TL08' end as tool,
  (value % 100)/100 as tool_wear, case when event_type = 'purchase' then value/10 end as cycle_time
from base""",
    "piece_tracking": f"""
select event_id, _time, concat('PZ', lpad(cast(k as varchar(10)), 3, '0')) as piece_id,
  case event_type when 'click' then 'move_start' when 'signup' then 'move_start'
    when 'view' then 'deposit' else 'move_end' end as event_type,
  case k % 5{_STATION} as from_station,
  case (k + 1 + user_id % 4) % 5{_STATION} as to_station,
  value/10 as duration, 1 + k % 5 as priority
from base""",
    "system_tracking": """
select event_id, _time,
  case user_id % 3 when 0 then 'event_processor' when 1 then 'mqtt_broker' else 'database' end as component,
  case k % 3 when 0 then 'system_resources' when 1 then 'health' else 'error' end as metric_type,
  case event_type when 'error' then 'error' when 'view' then 'warning' else 'info' end as severity,
  value % 100 as cpu, 8.0e0 - k/20.0e0 as free_memory, 8.0e0 as ram, cast(k as bigint) as errors,
  k * 1.0e0 as memory_used_percent, value * 60 as uptime_seconds
from base""",
    "alert": """
select event_id, _time, 'temperature_alerts' as _measurement, machine,
  case when temperature > 90 then 'critical' else 'warning' end as severity, 'temperature' as rule,
  concat(case when temperature > 90 then 'Critical' else 'High' end, ' temperature: ', temperature, '°C') as message,
  temperature as value
from sensor_wide where temperature > 80
union all
select event_id, _time, 'vibration_alerts', machine,
  case when vibration_level > 3 then 'critical' else 'warning' end, 'vibration',
  concat(case when vibration_level > 3 then 'Critical' else 'High' end, ' vibration: ', vibration_level, 'g'),
  vibration_level
from sensor_wide where vibration_level > 2.5
union all
select event_id, _time, 'system_alerts', machine,
  case when power > 8 then 'critical' else 'warning' end, 'power',
  concat(case when power > 8 then 'Critical power consumption' when power > 5 then 'High power consumption'
    else 'Suspiciously low power' end, ': ', power, 'kW'),
  power
from sensor_wide where power > 5 or power < 0.1
union all
select event_id, _time, 'system_alerts', machine, 'warning', 'rpm',
  concat('Abnormal RPM for ', lower(machine_type), ': ', rpm_spindle), rpm_spindle
from sensor_wide
where (machine_type = 'Milling' and (rpm_spindle > 4000 or rpm_spindle < 1000))
   or (machine_type = 'Lathe' and (rpm_spindle > 3000 or rpm_spindle < 500))""",
    # What each message says, without its JSON.
    "msg": f"""
select b.*, _time + interval 1 second as arrived_at,
  case k % 4 when 0 then date_trunc('second', _time) when 3 then _time + interval 1 second else _time end as stamped,
  k % 4 = 3 as ts_defaulted,
  case when event_type = 'error' and k % 3 = 2 then concat('/plant/alerts/', machine)
    when event_type in ('view', 'error') then concat('/plant/data/', machine)
    when event_type = 'signup' then '/plant/tracking/piece'
    else concat('/plant/tracking/', machine) end as topic,
  case when event_type = 'error' and k % 3 = 0 then 'bad_json' when event_type = 'error' and k % 3 = 2 then 'unknown'
    when event_type in ('view', 'error') then 'sensor' when event_type = 'signup' then 'piece' else 'machine' end as kind,
  case when event_type = 'error' then
    case k % 3 when 0 then 'bad_json' when 1 then 'missing_data' else 'unknown_topic' end end as reason,
  case event_type when 'click' then 'processing_start' when 'purchase' then 'processing_end'
    when 'signup' then 'move_end' end as event,
  concat('PZ', lpad(cast(k as varchar(10)), 3, '0')) as piece,
  case k % 5{_STATION} as origin, case (k + 1 + user_id % 4) % 5{_STATION} as target,
  20.0e0 + value/4 as temperature, value/50 as power,
  case when machine_type = 'Milling' then value/100 end as vibration_level,
  case when machine_type in ('Milling','Lathe') then value*10 end as rpm_spindle
from base b""",
    "distance": """
select * from (values ('Warehouse','Saw1',30.0e0), ('Saw1','Milling1',25.0e0), ('Saw1','Milling2',35.0e0),
  ('Saw1','Lathe1',40.0e0), ('Milling1','Warehouse',45.0e0), ('Milling2','Warehouse',50.0e0),
  ('Lathe1','Warehouse',55.0e0)) as d(a, b, metres)""",
    "metres": """
select a, b, metres from distance union all select b, a, metres from distance""",
    "pairs": """
select * from (
  select event_id, _time, machine, event_type,
    lag(event_type) over w as event_before, lag(_time) over w as start_time
  from machine_events window w as (partition by machine order by _time, event_id))
where event_type = 'processing_end' and event_before = 'processing_start'""",
    "gaps": """
select * from (
  select event_id, _time, machine,
    cast(floor(epoch(_time - lag(_time) over (partition by machine order by _time, event_id))) as bigint) as elapsed
  from sensor_wide)
where elapsed > 10""",
    "all_fields": """
select * from (
  select stamped as _time, machine, machine_type,
    unnest(['temperature', 'power', 'vibration_level', 'rpm_spindle', 'coolant_level', 'door_open']) as _field,
    unnest([temperature, power, vibration_level, rpm_spindle, cast(k as double),
      case when k % 2 = 0 then 1.0e0 else 0.0e0 end]) as _value
  from msg where kind = 'sensor' and reason is null)
where _value is not null""",
    "counts": """
select 'sensor_data' as _measurement,
  count(temperature) + count(power) + count(vibration_level) + count(rpm_spindle) as records from sensor_wide
union all select 'machine_events', count(tool_wear) + count(cycle_time) from machine_events
union all select 'piece_tracking', count(duration) + count(priority) from piece_tracking
union all select 'system_tracking', count(cpu) + count(free_memory) + count(ram) + count(errors)
  + count(memory_used_percent) + count(uptime_seconds) from system_tracking""",
    # Last end of a range that a watermark one hour behind the newest event has passed.
    "closed": """
select max(ts) - interval 1 hour as upto from events""",
}
NEEDS = {
    "base": [], "sensor_wide": ["base"], "sensor_long": ["base"], "machine_events": ["base"],
    "piece_tracking": ["base"], "system_tracking": ["base"], "alert": ["sensor_wide"], "msg": ["base"],
    "all_fields": ["msg"], "distance": [], "metres": ["distance"], "pairs": ["machine_events"], "gaps": ["sensor_wide"],
    "counts": ["sensor_wide", "machine_events", "piece_tracking", "system_tracking"], "closed": [],
}


def over(views: str, sql: str) -> str:
    """The query with the views it needs as leading CTEs."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS[name]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in views.split():
        add(name)
    ctes = ",\n".join(f"{name} as ({VIEWS[name]})" for name in ordered)
    return f"with {ctes}\n{sql}"


def _bucket(every: str) -> str:
    return f"time_bucket(interval {every}, _time, timestamp '1970-01-01')"


def _window_end(every: str) -> str:
    return f"least({_bucket(every)} + interval {every}, {STOP})"


_HOUR_END = "time_bucket(interval 1 hour, _time, timestamp '1970-01-01') + interval 1 hour"
_ALERT = "event_id, machine, rule, severity, message, value"
_PLACED = "from piece_tracking p left join metres m on m.a = p.from_station and m.b = p.to_station"
_MOVING = """
select event_id, _time, {tags}, round(mean + 3.7e-10, 6) as {value} from (
  select *, avg({value}) over w as mean, count(*) over w as seen,
    count(*) over (partition by {by}) as total,
    row_number() over (partition by {by} order by _time, event_id) as rn
  from {table}{where}
  window w as (partition by {by} order by _time, event_id rows between 9 preceding and current row))
where (seen = 10{short})"""
_SHORT = " or (total < 10 and rn = total)"
_LONG = "machine, machine_type, _field"


def _violations(measurement: str, table: str, checks: list[tuple[str, str, str]]) -> str:
    return "\nunion all ".join(
        f"select '{measurement}' as _measurement, '{column}' as \"column\", '{rule}' as rule,"
        f" count(*) filter (where {broken}) as violations from {table}"
        for column, rule, broken in checks
    )


def _availability(by: str, start: str, stop: str, days: int) -> str:
    return f"""
, e as (select *, lag(event_type) over w as before, lag(_time) over w as since, row_number() over w as from_start,
    row_number() over (partition by {by} order by _time desc, event_id desc) as from_end
  from machine_events where _time >= {start} and _time < {stop} window w as (partition by {by} order by _time, event_id)),
busy as (select machine, epoch(_time - since) as seconds from e
    where event_type = 'processing_end' and before = 'processing_start'
  union all select machine, epoch(_time - {start}) from e where event_type = 'processing_end' and from_start = 1
  union all select machine, epoch({stop} - _time) from e where event_type = 'processing_start' and from_end = 1)
select machine, round(sum(seconds) / ({days} * 86400) * 100 + 3.7e-10, 6) as availability_pct from busy group by machine"""


def _outside(column: str, low: str, high: str) -> tuple[str, str, str]:
    return column, "range", f"{column} < {low} or {column} > {high}"


def _not_in(column: str, values: str) -> tuple[str, str, str]:
    return column, "allowed_values", f"{column} not in ({values})"


_MACHINES = "'Milling1','Milling2','Lathe1','Saw1'"
_STATIONS = "'Warehouse','Saw1','Milling1','Milling2','Lathe1'"
_PIECE = ("piece_id", "pattern", "not regexp_full_match(piece_id, 'PZ[0-9]{3}')")

_NEAREST = """
select event_id, _time, machine, piece_id, event_type, start_time,
  round(epoch(_time - start_time) + 3.7e-10, 6) as seconds
from (
  select event_id, _time, machine, piece_id, event_type,
    max(case when event_type = 'processing_start' then _time end)
      over (partition by machine, piece_id order by _time range between unbounded preceding and current row) as start_time
  from machine_events)
where event_type = 'processing_end' and start_time >= _time - interval 10 days"""

ORACLE: dict[str, str] = {
    "topic_filter": over("msg", """
select concat('/plant/', split_part(topic, '/', 3), '/+') as subscription, topic, count(*) as messages
from msg group by all"""),
    "decode_envelope": over("msg", """
select arrived_at, case when event_type = 'signup' then 'piece' else machine end as entity, event,
  cast(case event_type when 'view' then 6 + case machine_type when 'Milling' then 2 when 'Lathe' then 1 else 0 end
    when 'click' then 2 when 'purchase' then 3 when 'signup' then 4 else 0 end as bigint) as entries
from msg where kind <> 'bad_json'"""),
    "route_messages": over("msg", "select kind, topic, count(*) as messages from msg group by all"),
    "parse_timestamp": over("msg", "select arrived_at, stamped as _time, ts_defaulted from msg where reason is null"),
    "normalise_sensor": over("msg", """
select stamped as _time, machine, machine_type, 'workshop_A' as location, temperature, power, vibration_level,
  rpm_spindle, k * 1.0e0 as coolant_level, case when k % 2 = 0 then 1.0e0 else 0.0e0 end as door_open,
  cast(2 as bigint) as extra_count
from msg where kind = 'sensor' and reason is null"""),
    "numeric_fields_long": over("msg", """
,
sound as (select * from msg where kind = 'sensor' and reason is null)
select arrived_at, 'temperature' as _field, temperature as _value from sound
union all select arrived_at, 'power', power from sound
union all select arrived_at, 'vibration_level', vibration_level from sound where vibration_level is not null
union all select arrived_at, 'rpm_spindle', rpm_spindle from sound where rpm_spindle is not null
union all select arrived_at, 'coolant_level', k * 1.0e0 from sound
union all select arrived_at, 'door_open', case when k % 2 = 0 then 1.0e0 else 0.0e0 end from sound"""),
    "normalise_machine_event": over("msg", """
select stamped as _time, machine, event as event_type, piece as piece_id,
  case when machine <> 'Saw1' then 'TM10' end as tool,
  case when event_type = 'click' then 0.0e0 end as duration,
  case when event_type = 'click' then 'active' else 'completed' end as status,
  cast(null as double) as tool_wear, case when event_type = 'purchase' then value/10 end as cycle_time, ts_defaulted
from msg where kind = 'machine'"""),
    "event_duration_status": over("msg", """
select event as event_type, case when event_type = 'click' then 'active' else 'completed' end as status,
  case when event_type = 'click' then 0.0e0 end as duration, count(*) as events
from msg where kind = 'machine' group by all"""),
    "optional_tags": over("msg", """
select machine, case when machine = 'Saw1' then 'None' else 'TM10' end as tool, count(*) as events
from msg where kind = 'machine' group by all"""),
    "normalise_piece_tracking": over("msg metres", """
select stamped as _time, piece as piece_id, event as event_type, origin as from_station, target as to_station,
  case when piece like 'PZ00%' then 'steel' when piece like 'PZ01%' then 'alu' end as material,
  value/10 as duration, coalesce(m.metres, 30.0e0) as distance, cast(3 as bigint) as priority, ts_defaulted
from msg left join metres m on m.a = origin and m.b = target where kind = 'piece'"""),
    "reject_invalid": over("msg", "select topic, arrived_at, reason from msg where reason is not null"),
    "machine_type": over("base", """
select machine, machine_type as derived_type, count(*) as readings from base group by all"""),
    "piece_material": over("piece_tracking", """
select piece_id, case when piece_id like 'PZ00%' then 'steel' when piece_id like 'PZ01%' then 'alu' end as material,
  count(*) as movements from piece_tracking group by all"""),
    "station_distance": over("piece_tracking metres", f"""
select from_station, to_station, count(*) as movements, round(sum(coalesce(m.metres, 30.0e0)) + 3.7e-10, 6) as metres
{_PLACED} group by all"""),
    "to_long": over("sensor_wide", """
select event_id, _time, machine, 'temperature' as _field, temperature as _value from sensor_wide
union all select event_id, _time, machine, 'power', power from sensor_wide
union all select event_id, _time, machine, 'vibration_level', vibration_level from sensor_wide
  where vibration_level is not null
union all select event_id, _time, machine, 'rpm_spindle', rpm_spindle from sensor_wide
  where rpm_spindle is not null"""),
    "dedup_points": over("alert", """
,
ranked as (select *, list_position(['temperature', 'vibration', 'power', 'rpm'], rule) as written from alert)
select _measurement, machine, severity, 'anomaly' as alert_type, _time, arg_max(rule, written) as rule,
  arg_max(value, written) as value
from ranked group by all"""),
    "anomaly_temperature": over("alert", f"select {_ALERT} from alert where rule = 'temperature'"),
    "anomaly_vibration": over("alert", f"select {_ALERT} from alert where rule = 'vibration'"),
    "anomaly_power": over("alert", f"select {_ALERT} from alert where rule = 'power'"),
    "anomaly_rpm": over("alert", f"select {_ALERT} from alert where rule = 'rpm'"),
    "anomaly_array": over("alert", """
select s.event_id, count(a.rule) as n,
  coalesce(string_agg(a.rule, ',' order by list_position(['temperature', 'vibration', 'power', 'rpm'], a.rule)), '')
    as rules
from sensor_wide s left join alert a on a.event_id = s.event_id group by s.event_id"""),
    "anomaly_custom_thresholds": over("sensor_wide", """
,
hit as (
  select 'temperature' as rule, case when temperature > 75 then 'critical' else 'warning' end as severity
  from sensor_wide where temperature > 60
  union all select 'vibration', case when vibration_level > 2 then 'critical' else 'warning' end
  from sensor_wide where vibration_level > 1.5
  union all select 'power', case when power > 4.5 then 'critical' else 'warning' end
  from sensor_wide where power > 3 or power < 0.1
  union all select 'rpm', 'warning' from sensor_wide
  where (machine_type = 'Milling' and (rpm_spindle > 4000 or rpm_spindle < 1000))
     or (machine_type = 'Lathe' and (rpm_spindle > 3000 or rpm_spindle < 500)))
select rule, severity, count(*) as alerts from hit group by all"""),
    "anomaly_stats": over("alert", """
select 3 * (select count(*) from events) as processed_count, count(distinct event_id) as anomaly_count,
  round(count(distinct event_id) / greatest(3 * (select count(*) from events), 1) + 3.7e-10, 6) as anomaly_rate
from alert"""),
    "alerts_routed": over("alert", "select *, 'anomaly' as alert_type, false as resolved from alert"),
    "alert_counts": over("alert", """
select _measurement, machine, severity, count(*) as alerts, max(value) as max_value from alert group by all"""),
    "range_scan": over("sensor_wide", f"""
select event_id, _time, machine, temperature from sensor_wide
where _time >= {START} and _time < {STOP} - interval 1 day"""),
    "filter_eq": over("sensor_long", f"""
select * from sensor_long where _field = 'temperature' and machine = 'Milling1' and {RANGE}"""),
    "filter_regex": over("sensor_long", "select * from sensor_long where regexp_matches(_field, 'temperature|power')"),
    "sum_by": over("sensor_long", f"select {_LONG}, round(sum(_value) + 3.7e-10, 6) as _value from sensor_long group by all"),
    "count_by": over("sensor_long", f"select {_LONG}, count(_value) as _value from sensor_long group by all"),
    "mean_by": over("sensor_long", f"select {_LONG}, round(avg(_value) + 3.7e-10, 6) as _value from sensor_long group by all"),
    "last_by": over("sensor_long", f"""
select event_id, _time, {_LONG}, _value from sensor_long
qualify row_number() over (partition by {_LONG} order by _time desc, event_id desc) = 1"""),
    "first_by": over("sensor_long", f"""
select event_id, _time, {_LONG}, _value from sensor_long
qualify row_number() over (partition by {_LONG} order by _time, event_id) = 1"""),
    "limit_per_series": over("sensor_long", f"""
select event_id, _time, {_LONG}, _value from sensor_long where machine = 'Milling1' and {RANGE}
qualify row_number() over (partition by {_LONG} order by _time, event_id) <= 100"""),
    "keep_columns": over("sensor_long", "select machine, count(_value) as _value from sensor_long group by machine"),
    "pivot_fields": over("sensor_long", """
select _time, machine, max(_value) filter (where _field = 'temperature') as temperature,
  max(_value) filter (where _field = 'power') as power,
  max(_value) filter (where _field = 'vibration_level') as vibration_level,
  max(_value) filter (where _field = 'rpm_spindle') as rpm_spindle,
  max(_value) filter (where _field = 'feed_rate') as feed_rate
from sensor_long group by _time, machine"""),
    "window_mean_30s": over("sensor_wide", f"""
,
m as (select machine, machine_type, location, {_window_end('30 seconds')} as w, avg(temperature) as t
  from sensor_wide where {RANGE} group by all)
select machine, machine_type, location, w as _time, round(t + 3.7e-10, 6) as temperature,
  case when t >= 85 then 'red' when t >= 70 then 'yellow' else 'green' end as band from m"""),
    "window_mean_1h": over("sensor_wide", f"""
select machine, machine_type, location, {_window_end('1 hour')} as _time, round(avg(temperature) + 3.7e-10, 6) as temperature
from sensor_wide where {RANGE} group by machine, machine_type, location, {_window_end('1 hour')}"""),
    "window_mean_long_1d": over("sensor_long", f"""
select {_LONG}, {_window_end('1 day')} as _time, round(avg(_value) + 3.7e-10, 6) as _value
from sensor_long where {RANGE} group by {_LONG}, {_window_end('1 day')}"""),
    "window_sum_1d": over("machine_events", f"""
select machine, {_window_end('1 day')} as _time, round(sum(cycle_time) + 3.7e-10, 6) as cycle_time
from machine_events where event_type = 'processing_end' and {RANGE} group by machine, {_window_end('1 day')}"""),
    "window_count_1h": over("machine_events", f"""
select machine, event_type, piece_id, tool, {_window_end('1 hour')} as _time, count(*) as _value
from machine_events where event_type = 'processing_end' and {RANGE}
group by machine, event_type, piece_id, tool, {_window_end('1 hour')}"""),
    "elapsed_seconds": over("sensor_long", """
select * from (select event_id, _time, machine, _field, cast(floor(epoch(
    _time - lag(_time) over (partition by machine, _field order by _time, event_id))) as bigint) as elapsed
  from sensor_long) where elapsed is not null"""),
    "moving_average": over("sensor_long", _MOVING.format(
        tags=_LONG, by=_LONG, value="_value", table="sensor_long", where="", short=_SHORT)),
    "cycle_time_pairs": over("pairs", """
select event_id, _time, machine, event_type, start_time, round(epoch(_time - start_time) + 3.7e-10, 6) as seconds from pairs"""),
    "machine_temperature": over("sensor_wide", f"""
select event_id, _time, machine, machine_type, location, temperature from sensor_wide
where machine = 'Milling1' and {RANGE}"""),
    "temperature_all": over("sensor_wide", f"""
select event_id, _time, machine, machine_type, location, temperature from sensor_wide where {RANGE}"""),
    "machine_all_sensors": over("sensor_wide", f"""
select event_id, _time, machine, machine_type, location, temperature, power, rpm_spindle, vibration_level
from sensor_wide where machine = 'Milling1' and {RANGE}"""),
    "power_by_machine": over("sensor_wide", f"""
select event_id, _time, machine, machine_type, location, power from sensor_wide where {RANGE}
order by machine, _time"""),
    "processing_time_total": over("machine_events", f"""
select machine, round(sum(cycle_time) + 3.7e-10, 6) as cycle_time from machine_events
where event_type = 'processing_end' and {RANGE} group by machine"""),
    "machine_availability_counts": over("machine_events", f"""
select machine, event_type, count(*) as events from machine_events
where regexp_matches(event_type, 'processing_') and {RANGE} group by all"""),
    "cycle_time_mean": over("machine_events", f"""
select machine, round(avg(cycle_time) + 3.7e-10, 6) as cycle_time from machine_events
where event_type = 'processing_end' and {RANGE} group by machine"""),
    "high_temperature": over("sensor_wide", f"""
select event_id, _time, machine, machine_type, location, temperature from sensor_wide
where temperature > 80 and {RANGE}"""),
    "high_vibration": over("sensor_wide", f"""
select event_id, _time, machine, machine_type, location, vibration_level from sensor_wide
where vibration_level > 2.5 and {RANGE}"""),
    "high_power": over("sensor_wide", f"""
select event_id, _time, machine, machine_type, location, power from sensor_wide where power > 5 and {RANGE}"""),
    "tool_wear_last": over("machine_events", f"""
select event_id, _time, machine, tool, tool_wear from machine_events where tool_wear > 0.8 and {RANGE}
qualify row_number() over (partition by machine, tool order by _time desc, event_id desc) = 1"""),
    "piece_traceability": over("piece_tracking", f"""
select * from piece_tracking where piece_id = 'PZ001' and {RANGE} order by _time"""),
    "pieces_in_production": over("machine_events", f"""
select * from machine_events where event_type = 'processing_start' and {RANGE}
qualify row_number() over (partition by piece_id order by _time desc, event_id desc) = 1"""),
    "transport_time_mean": over("piece_tracking", f"""
select from_station, to_station, round(avg(duration) + 3.7e-10, 6) as mean_duration from piece_tracking
where event_type = 'move_end' and {RANGE} group by all"""),
    "production_by_material": over("piece_tracking", f"""
select case when piece_id like 'PZ00%' then 'steel' when piece_id like 'PZ01%' then 'alu' end as material,
  count(*) as _value from piece_tracking where event_type = 'deposit' and {RANGE} group by all"""),
    "daily_production": over("piece_tracking", f"""
select case when piece_id like 'PZ00%' then 'steel' when piece_id like 'PZ01%' then 'alu' end as material,
  count(*) as pieces_completed from piece_tracking where event_type = 'deposit' and {RANGE} group by all"""),
    "processor_performance": over("system_tracking", f"""
select event_id, _time, component, metric_type, severity, cpu, free_memory, memory_used_percent, uptime_seconds
from system_tracking where component = 'event_processor' and {RANGE}"""),
    "system_health_last": over("system_tracking", f"""
select * from system_tracking where metric_type = 'health' and {RANGE}
qualify row_number() over (partition by component order by _time desc, event_id desc) = 1"""),
    "errors_by_component": over("system_tracking", f"""
select component, cast(sum(errors) as bigint) as errors from system_tracking where {RANGE} group by component"""),
    "machine_efficiency": over("machine_events", f"""
select machine, round(sum(tool_wear) + 3.7e-10, 6) as tool_wear, round(sum(cycle_time) + 3.7e-10, 6) as cycle_time
from machine_events where regexp_matches(event_type, 'processing') and {RANGE} group by machine"""),
    "temperature_mean_by_machine": over("sensor_wide", f"""
select machine, round(avg(temperature) + 3.7e-10, 6) as mean_temperature from sensor_wide where {RANGE} group by machine"""),
    "temperature_trend": over("sensor_wide", _MOVING.format(
        tags="machine, machine_type, location", by="machine", value="temperature", table="sensor_wide",
        where=f" where machine = 'Milling1' and {RANGE}", short=_SHORT)),
    "temperature_power_pivot": over("sensor_wide", f"""
select event_id, _time, machine, machine_type, location, temperature, power from sensor_wide
where machine = 'Milling1' and {RANGE}"""),
    "panel_power": over("sensor_wide", f"""
select machine, machine_type, location, {_window_end('30 seconds')} as _time, round(avg(power) + 3.7e-10, 6) as power
from sensor_wide where {RANGE} group by machine, machine_type, location, {_window_end('30 seconds')}"""),
    "pieces_processed": over("machine_events", f"""
select count(*) as processing_ends, count(distinct piece_id) as pieces from machine_events
where event_type = 'processing_end' and {RANGE}"""),
    "critical_alerts": over("alert", f"""
,
c as (select count(*) as critical_alerts from alert where severity = 'critical' and {RANGE})
select critical_alerts, case when critical_alerts >= 10 then 'red' when critical_alerts >= 5 then 'yellow'
  else 'green' end as band from c"""),
    "recent_alerts": over("alert", f"""
select _time, machine, severity, case severity when 'critical' then '🔴 CRITICAL' else '🟡 WARNING' end as label,
  message from alert where {RANGE} order by _time desc, machine desc, rule desc limit 20"""),
    "system_performance": over("system_tracking", f"""
select component, metric_type, severity, {_window_end('30 seconds')} as _time, round(avg(cpu) + 3.7e-10, 6) as cpu,
  round(avg(memory_used_percent) + 3.7e-10, 6) as memory_used_percent
from system_tracking where {RANGE} group by component, metric_type, severity, {_window_end('30 seconds')}"""),
    "distinct_machines": over("base", f"select distinct machine as _value from base where {RANGE}"),
    "threshold_band": over("sensor_wide", """
select machine, 'temperature' as _field, case when temperature >= 85 then 'red' when temperature >= 70 then 'yellow'
  else 'green' end as band, count(*) as readings from sensor_wide group by all
union all select machine, 'power', case when power >= 8 then 'red' when power >= 5 then 'yellow' else 'green' end,
  count(*) from sensor_wide group by all"""),
    "legend_summary": over("sensor_wide", """
select machine, 'temperature' as _field, arg_max(temperature, (_time, event_id)) as last_value,
  max(temperature) as max_value, round(avg(temperature) + 3.7e-10, 6) as mean_value from sensor_wide group by machine
union all select machine, 'power', arg_max(power, (_time, event_id)), max(power), round(avg(power) + 3.7e-10, 6)
  from sensor_wide group by machine"""),
    "severity_label": over("alert", """
select severity, case severity when 'critical' then '🔴 CRITICAL' else '🟡 WARNING' end as label, count(*) as alerts
from alert group by all"""),
    "filter_machines": over("sensor_wide", """
select event_id, _time, machine, temperature, power from sensor_wide where machine in ('Milling2', 'Saw1')"""),
    "availability_pct": over("machine_events", _availability("machine", START, STOP, 30)),
    "availability_by_tool": over("machine_events", _availability(
        "machine, piece_id, tool", "timestamp '2024-01-10 00:00:00'", "timestamp '2024-01-20 00:00:00'", 10)),
    "temperature_power_corr": over("sensor_long", f"""
, w as (select machine, avg(_value) filter (where _field = 'temperature') as a, avg(_value) filter (where _field = 'power') as b
  from sensor_long where {RANGE} group by machine, {_bucket('1 hour')})
select machine, round(corr(a, b) + 3.7e-10, 6) as correlation, count(*) filter (where a is not null and b is not null) as windows
from w group by machine"""),
    "machine_status": over("machine_events", f"""
select event_id, _time, machine, event_type, case when event_type like '%start' then 'active'
  when event_type like '%end' then 'completed' else 'unknown' end as status
from machine_events where {RANGE} qualify row_number() over (partition by machine order by _time desc, event_id desc) = 1"""),
    "tool_wear_trend": over("machine_events", f"""
select machine, tool, round(regr_slope(tool_wear, epoch(_time - {START}) / 3600) + 3.7e-10, 6) as wear_per_hour,
  count(*) as readings from machine_events where tool is not null and {RANGE} group by machine, tool"""),
    "measurement_counts": over("counts", "select * from counts"),
    "measurement_counts_decoded": over("msg all_fields", """
select 'sensor_data' as _measurement, count(*) as records from all_fields
union all select 'machine_events', count(*) + count(*) filter (where event = 'processing_start')
  + count(*) filter (where event = 'processing_end') from msg where kind = 'machine'
union all select 'piece_tracking', 3 * count(*) from msg where kind = 'piece'
union all select 'system_tracking', 0"""),
    "to_long_all_fields": over("all_fields", "select _time, machine, _field, _value from all_fields"),
    "machine_all_fields": over("msg", f"""
select stamped as _time, machine, machine_type, 'workshop_A' as location, temperature, power, vibration_level, rpm_spindle,
  cast(k as double) as coolant_level, case when k % 2 = 0 then 1.0e0 else 0.0e0 end as door_open
from msg where kind = 'sensor' and reason is null and machine = 'Milling1' and stamped >= {START} and stamped < {STOP}"""),
    "rollup_hourly_all_fields": over("all_fields", f"""
select machine, machine_type, 'workshop_A' as location, _field, {_window_end('1 hour')} as _time,
  round(avg(_value) + 3.7e-10, 6) as _value
from all_fields where {RANGE} group by machine, machine_type, _field, {_window_end('1 hour')}"""),
    "rollup_rerun": over("sensor_wide", f"""
select machine, machine_type, location, {_window_end('1 hour')} as _time, round(avg(temperature) + 3.7e-10, 6) as temperature
from sensor_wide where {RANGE} and machine <> 'Saw1' and _time < timestamp '2024-01-20 00:00:00'
group by machine, machine_type, location, {_window_end('1 hour')}"""),
    "compacted_batches": over("sensor_wide", """
select cast(_time as date) as event_date, machine, count(*) as readings, round(sum(temperature) + 3.7e-10, 6) as temperature,
  max(_time) as last_time, 1 as folders
from sensor_wide group by 1, 2"""),
    "limit_per_series_2000": over("sensor_wide", """
select event_id, _time, machine, temperature from sensor_wide
qualify row_number() over (partition by machine order by _time desc, event_id desc) <= 2000"""),
    "gap_detection_field": over("base", """
select * from (
  select event_id, _time, machine,
    cast(floor(epoch(_time - lag(_time) over (partition by machine order by _time, event_id))) as bigint) as elapsed
  from base where event_type = 'view' and value is not null)
where elapsed > 10"""),
    "missing_stores": "select unnest(['historical_data', 'system_metrics']) as name",
    "volume_report": over("counts", """
,
t as (select cast(sum(records) as bigint) as total_records, count(*) filter (where records = 0) as empty_measurements
  from counts)
select *, case when total_records < 1000 then 'increase frequency' when total_records > 100000 then 'retention'
  else 'ok' end as advice from t"""),
    "completeness_by_machine": over("sensor_wide", f"""
select machine, count(temperature) as readings from sensor_wide where {RANGE} group by machine"""),
    "gap_detection": over("gaps", "select * from gaps"),
    "gap_summary": over("gaps", """
select machine, count(*) as gaps, max(elapsed) as longest_seconds from gaps group by machine"""),
    "tag_combinations": over("base", "select distinct machine, machine_type, false as has_missing_tag from base"),
    "missing_tables": over("counts alert", """
,
expected as (select unnest(['sensor_data', 'machine_events', 'piece_tracking', 'system_tracking', 'system_metrics',
  'temperature_alerts', 'vibration_alerts', 'system_alerts']) as _measurement)
select _measurement from expected except
(select _measurement from counts where records > 0 union select _measurement from alert)"""),
    "schema_violations": over("sensor_wide machine_events piece_tracking system_tracking", "\nunion all ".join([
        _violations("sensor_data", "sensor_wide", [
            _not_in("machine", _MACHINES), _not_in("machine_type", "'Milling','Lathe','Saw'"),
            _not_in("location", "'workshop_A','workshop_B'"),
            _outside("temperature", "20", "100"), _outside("power", "0", "10"),
            _outside("rpm_spindle", "1000", "4000"),
            ("rpm_spindle", "machine_type", "rpm_spindle is not null and machine_type not in ('Milling','Lathe')"),
            _outside("vibration_level", "0", "5"),
            ("vibration_level", "machine_type", "vibration_level is not null and machine_type <> 'Milling'"),
        ]),
        _violations("machine_events", "machine_events", [
            _not_in("machine", _MACHINES),
            _not_in("event_type", "'setup_start','setup_end','processing_start','processing_end'"), _PIECE,
            _not_in("tool", "'TM10','TM25','TM12','TM30','TL05','TL08'"), _outside("tool_wear", "0", "1"),
        ]),
        _violations("piece_tracking", "piece_tracking", [
            _PIECE, _not_in("event_type", "'move_start','move_end','deposit'"),
            _not_in("from_station", _STATIONS), _not_in("to_station", _STATIONS), _outside("priority", "1", "5"),
        ]),
        _violations("system_tracking", "system_tracking", [
            _not_in("component", "'event_processor','mqtt_broker','database'"),
            _not_in("metric_type", "'system_resources','health','error'"),
            _not_in("severity", "'info','warning','error'"), _outside("cpu", "0", "100"),
        ]),
    ])),
    "rollup_hourly": over("sensor_wide", f"""
select machine, machine_type, location, {_window_end('1 hour')} as _time, round(avg(temperature) + 3.7e-10, 6) as temperature,
  round(avg(power) + 3.7e-10, 6) as power, round(avg(vibration_level) + 3.7e-10, 6) as vibration_level,
  round(avg(rpm_spindle) + 3.7e-10, 6) as rpm_spindle
from sensor_wide where {RANGE} group by machine, machine_type, location, {_window_end('1 hour')}"""),
    "rollup_daily": over("machine_events", f"""
select machine, event_type, piece_id, tool, {_window_end('1 day')} as _time, round(sum(cycle_time) + 3.7e-10, 6) as cycle_time
from machine_events where event_type = 'processing_end' and {RANGE}
group by machine, event_type, piece_id, tool, {_window_end('1 day')}"""),
    "machine_efficiency_1h": over("machine_events", f"""
select machine, {_window_end('1 hour')} as _time, round(sum(cycle_time) + 3.7e-10, 6) as cycle_time, count(*) as pieces
from machine_events where event_type = 'processing_end' and {RANGE} group by machine, {_window_end('1 hour')}"""),
    "retention_filter": over("base", f"""
select event_id, _time, machine from base where _time >= {STOP} - interval 7 days"""),
    **dict.fromkeys(["message_stats", "stream_ingest_statistics"], over("msg", """
,
c as (select count(*) filter (where kind <> 'bad_json') as messages_received,
    count(*) filter (where reason is null) as messages_processed,
    count(*) filter (where reason = 'missing_data') as errors,
    count(*) filter (where reason = 'unknown_topic') as unknown_topics,
    min(arrived_at) as first_message_at, max(arrived_at) as last_message_at from msg)
select *, round(messages_processed / greatest(floor(epoch(last_message_at - first_message_at)), 1) + 3.7e-10, 6)
  as processing_rate from c""")),
    "write_stats": over("alert machine_events piece_tracking system_tracking", "\nunion all ".join(
        f"select '{name}' as _table, count(*) as points_written, max(_time) as last_time from {view}"
        for name, view in {
            "sensor_data": "sensor_wide", "machine_events": "machine_events", "piece_tracking": "piece_tracking",
            "system_tracking": "system_tracking", "alerts": "alert",
        }.items()
    )),
    "system_tracking_fill": over("system_tracking", """
select _time, 'event_processor' as component, 'system_resources' as metric_type, 'info' as severity,
  case when errors % 10 = 0 then 0.0e0 else round(cpu, 2) end as cpu, round(free_memory, 2) as free_memory,
  case when errors % 7 = 0 then 0.0e0 else ram end as ram,
  cast(case when errors % 5 = 0 then 0 else errors end as bigint) as errors,
  memory_used_percent, round(uptime_seconds + 3.7e-10, 6) as uptime_seconds
from system_tracking"""),
    "stream_ingest_route": over("msg alert", """
,
found as (select a.event_id, a.rule from alert a join msg on msg.event_id = a.event_id
  where msg.kind = 'sensor' and msg.reason is null)
select 'sensor_data' as _table, stamped as _time, machine as name, cast(count(found.rule) as varchar) as detail
from msg left join found on found.event_id = msg.event_id
where kind = 'sensor' and reason is null group by msg.event_id, stamped, machine
union all select 'machine_events', stamped, machine, event from msg where kind = 'machine'
union all select 'piece_tracking', stamped, piece, target from msg where kind = 'piece'
union all select 'alerts', stamped, machine, found.rule from msg join found on found.event_id = msg.event_id
union all select 'rejects', arrived_at, topic, reason from msg where reason is not null"""),
    "alerts_stream": over("alert", "select *, 'anomaly' as alert_type, false as resolved from alert"),
    "stream_window_mean": over("sensor_long closed", f"""
select {_LONG}, {_HOUR_END} as _time, round(avg(_value) + 3.7e-10, 6) as _value, count(_value) as readings
from sensor_long where {_HOUR_END} <= (select upto from closed) group by {_LONG}, {_HOUR_END}"""),
    "stream_distinct_points": over("sensor_wide", "select event_id, _time, machine, temperature from sensor_wide"),
    "stream_gaps": over("gaps", "select * from gaps"),
    "stream_moving_average": over("sensor_long", _MOVING.format(
        tags=_LONG, by=_LONG, value="_value", table="sensor_long", where="", short="")),
    "stream_cycle_time": over("pairs", """
select event_id, _time, machine, event_type, start_time, round(epoch(_time - start_time) + 3.7e-10, 6) as seconds
from pairs"""),
    "nearest_starts": over("machine_events", _NEAREST),
    "stream_nearest_starts": over("machine_events", _NEAREST),
    "stream_live_windows": over("sensor_long", f"""
select {_LONG}, {_HOUR_END} as _time, round(avg(_value) + 3.7e-10, 6) as _value, count(_value) as readings
from sensor_long group by {_LONG}, {_HOUR_END}"""),
    "stream_last_rows": over("sensor_wide", """
select event_id, _time, machine, temperature from sensor_wide
qualify row_number() over (partition by machine order by _time desc, event_id desc) = 1"""),
    "stream_merged_points": over("sensor_wide", """
select machine, date_trunc('minute', _time) as _time,
  arg_max(temperature, event_id) filter (event_id % 2 = 0 and temperature is not null) as temperature,
  arg_max(power, event_id) filter (event_id % 3 = 0 and power is not null) as power
from sensor_wide group by 1, 2"""),
    "stream_gaps_on_arrival": over("gaps", "select * from gaps"),
    "stream_moving_average_on_arrival": over("sensor_long", _MOVING.format(
        tags=_LONG, by=_LONG, value="_value", table="sensor_long", where="", short="")),
    "alerts_limits_over_time": over("sensor_wide", """
, limited as (
  select *,
    case when machine = 'Milling1' and _time >= timestamp '2024-01-16 00:00:00' then 35.0
      when machine = 'Milling1' and _time >= timestamp '2024-01-01 00:00:00' then 30.0 else 80.0 end as warn,
    case when machine = 'Milling1' and _time >= timestamp '2024-01-16 00:00:00' then 42.0
      when machine = 'Milling1' and _time >= timestamp '2024-01-01 00:00:00' then 40.0
      when machine = 'Saw1' and _time >= timestamp '2024-01-10 00:00:00' then 85.0 else 90.0 end as crit,
    case when machine = 'Milling1' and _time >= timestamp '2024-01-01 00:00:00' and _time < timestamp '2024-01-16 00:00:00'
      then 0.5 else 2.5 end as shakes
  from sensor_wide)
select event_id, machine, 'temperature' as rule, case when temperature > crit then 'critical' else 'warning' end as severity,
  temperature as value from limited where temperature > least(warn, crit)
union all
select event_id, machine, 'vibration', case when vibration_level > 3 then 'critical' else 'warning' end, vibration_level
from limited where vibration_level > shakes
union all
select event_id, machine, 'power', case when power > 8 then 'critical' else 'warning' end, power
from limited where power > 5 or power < 0.1
union all
select event_id, machine, 'rpm', 'warning', rpm_spindle from limited
where (machine_type = 'Milling' and (rpm_spindle > 4000 or rpm_spindle < 1000))
   or (machine_type = 'Lathe' and (rpm_spindle > 3000 or rpm_spindle < 500))"""),
    "stream_system_samples": over("system_tracking", """
select 'event_processor' as component, 'system_resources' as metric_type, 'info' as severity, count(*) as samples,
  cast(sum(errors) as bigint) as errors, sum(ram) as ram, max(_time) as last_time
from system_tracking"""),
    "stream_write_errors": """
select 'stores' as query, 1::bigint as batches, count(*)::bigint as rows_written, 0::bigint as write_errors, true as has_written,
  null::boolean as says_why from events
union all select 'fails', 0, 0, 1, false, true""",
}

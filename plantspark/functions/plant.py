"""Facts derived from machine, piece and station names."""

from __future__ import annotations

from plantspark.schemas import DEFAULT_DISTANCE, STATION_DISTANCES


def machine_type(machine: str = "machine") -> str:
    """Type named inside the machine's name, whatever the case; first match wins."""
    return (
        f"case when contains(lower({machine}), 'milling') then 'Milling'"
        f" when contains(lower({machine}), 'lathe') then 'Lathe'"
        f" when contains(lower({machine}), 'saw') then 'Saw' else 'Unknown' end"
    )


def piece_material(piece_id: str = "piece_id") -> str:
    """Material by piece number range; NULL when the range says nothing."""
    return f"case when startswith({piece_id}, 'PZ00') then 'steel' when startswith({piece_id}, 'PZ01') then 'alu' end"


def station_distance(origin: str = "from_station", target: str = "to_station") -> str:
    """Metres between two stations, either way round; other pairs get the default."""
    both_ways = [
        f"'{x}|{y}', {metres}d" for (a, b), metres in STATION_DISTANCES.items() for x, y in ((a, b), (b, a))
    ]
    known = f"try_element_at(map({', '.join(both_ways)}), concat({origin}, '|', {target}))"
    return f"coalesce({known}, {DEFAULT_DISTANCE}d)"


def event_status(event_type: str, given: str) -> str:
    """`..start` is active, `..end` completed, anything else keeps the given status."""
    return (
        f"case when endswith({event_type}, 'start') then 'active'"
        f" when endswith({event_type}, 'end') then 'completed' else {given} end"
    )

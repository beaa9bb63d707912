"""Extension surface: what an acquisition system donates. Parsers and assemblers are functions of DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

Transform = Callable[[DataFrame], DataFrame]


@dataclass
class System:
    """Everything one acquisition system brings along."""

    name: str
    parsers: dict[str, Transform] = field(default_factory=dict)
    event_codes: dict[str, tuple[int, ...]] = field(default_factory=dict)
    runtime: Transform | None = None
    assembler: Callable[..., DataFrame] | None = None
    admission: dict[str, tuple[str, ...]] = field(default_factory=dict)
    descriptions: dict[str, str] = field(default_factory=dict)


_SYSTEMS: dict[str, System] = {}


def donate(system: System) -> System:
    """Register a system; a second one of the same name, or one with gaps, is refused."""
    if system.name in _SYSTEMS:
        raise ValueError(f"system {system.name} is registered already")
    gaps = coverage_gaps(system)
    if gaps:
        raise ValueError(f"system {system.name} lacks {', '.join(gaps)}")
    _SYSTEMS[system.name] = system
    return system


def coverage_gaps(system: System) -> list[str]:
    """What is missing: every part, and event codes for every parser and a parser for all codes."""
    gaps = [part for part in ("parsers", "runtime", "assembler", "admission", "descriptions") if not getattr(system, part)]
    gaps += [f"event codes of {name}" for name in sorted(set(system.parsers) - set(system.event_codes))]
    return gaps + [f"a parser of {name}" for name in sorted(set(system.event_codes) - set(system.parsers))]


def parsed(events: DataFrame, system: str, module: str) -> DataFrame:
    """The donated parser of a module, applied to the events it reads."""
    found = _SYSTEMS[system]
    return events.filter(events["event"].isin(*found.event_codes[module])).transform(found.parsers[module])


def systems() -> list[str]:
    return sorted(_SYSTEMS)

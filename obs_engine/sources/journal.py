"""Periods that tables built from others still have to be rebuilt for.

They are noted before a table changes and forgotten after what depends on it was rebuilt, so a
load that was stopped in between leaves them for the next one.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

from obs_engine.sources.publish import delete, entries, read_text, write_text

JOURNAL = "_journal"


@dataclass(frozen=True)
class Pending:
    """Noted periods (None: all of them) and the names of the notes."""

    periods: frozenset | None
    notes: tuple[str, ...]


def note(spark: SparkSession, root: str, periods: list | None) -> None:
    """Note periods that are about to change, None for all."""
    if periods is None or periods:
        text = json.dumps(None if periods is None else sorted(periods))
        write_text(spark, f"{root}/{JOURNAL}/{uuid.uuid4().hex}.json", text)


def pending(spark: SparkSession, root: str) -> Pending:
    notes = [n for n in entries(spark, f"{root}/{JOURNAL}") if n.endswith(".json")]
    found = [json.loads(read_text(spark, f"{root}/{JOURNAL}/{n}")) for n in notes]
    whole = any(periods is None for periods in found)
    periods = None if whole else frozenset(p for periods in found for p in periods)
    return Pending(periods, tuple(notes))


def forget(spark: SparkSession, root: str, done: Pending) -> None:
    for name in done.notes:
        delete(spark, f"{root}/{JOURNAL}/{name}")

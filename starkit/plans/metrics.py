"""What a build reports about each table."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TableMetrics:
    table: str
    rows: int | None  # None where nothing was counted
    seconds: float
    # Lookup keys with several rows, each of which multiplies fact rows.
    fanout_keys: int = 0

"""The platform's settings file: ``name=value`` lines, ``#`` for comments."""

from __future__ import annotations

from pathlib import Path

# Fixed defaults of the platform: time between checkpoints in ms, rows and ms
# between inserts.
CHECKPOINT_INTERVAL_MS = 30_000
INSERT_ROWS = 20
INSERT_INTERVAL_MS = 5_000


def read_settings(path: str) -> dict[str, str]:
    """Settings of a job; a later line replaces an earlier one."""
    settings = {}
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        line = line.strip()
        if line and not line.startswith("#") and "=" in line:
            name, value = line.split("=", 1)
            settings[name.strip()] = value.strip()
    return settings


def insert_rows(settings: dict[str, str]) -> int:
    """Rows per database insert."""
    return int(settings.get("clickhouse.batch.size", INSERT_ROWS))


def insert_interval_ms(settings: dict[str, str]) -> int:
    """Longest time between inserts: the trigger of jobs that only write."""
    return int(settings.get("clickhouse.batch.interval", INSERT_INTERVAL_MS))

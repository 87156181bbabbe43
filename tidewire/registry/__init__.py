"""Registered queries over the driver's tables, each with its SQL where it has one.

The tables hold no messages of the domain, so they stand in for it: documents are the messages
(language as country), events the stream (event type as topic). Lexicons are word fragments that
occur in them.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Entry(NamedTuple):
    query: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def all_entries() -> dict[str, Entry]:
    from tidewire.registry import counts, incremental, messages, streams, time_series

    entries: dict[str, Entry] = {}
    for module in (messages, counts, time_series, streams, incremental):
        repeated = entries.keys() & module.ENTRIES.keys()
        if repeated:
            raise ValueError(f"registered twice: {sorted(repeated)}")
        entries.update(module.ENTRIES)
    return entries

"""What a running query tells (R5, R6), and how a batch runner slows down."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql.streaming import StreamingQuery


def stage_events(query: StreamingQuery) -> list[dict]:
    """The batches of a query so far as events: number, rows in, seconds."""
    return [{"batch": p["batchId"], "rows": p["numInputRows"], "seconds": p["batchDuration"] / 1000} for p in map(json.loads, (x.json if isinstance(x.json, str) else json.dumps(x.json) for x in query.recentProgress))]


def event_lines(events: Iterable[dict]) -> str:
    """Events as lines of a server-sent stream."""
    return "".join(f"data: {json.dumps(e, sort_keys=True)}\n\n" for e in events)


def next_limit(limit: int, failed: int, done: int, least: int = 1, most: int = 64, bad: float = 0.2) -> int:
    """Half the limit after too many failures, one more after none."""
    if done and failed / done > bad:
        return max(least, limit // 2)
    return min(most, limit + 1) if not failed else limit

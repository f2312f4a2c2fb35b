"""Reading a streaming query's progress: state size, late rows, watermark."""

from __future__ import annotations

from collections import deque

from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def state_rows(progress: dict, operator: str | None = None) -> int:
    """Total state rows of the operators in one progress record (optionally one kind,
    e.g. 'symmetricHashJoin' or 'stateStoreSave')."""
    return sum(
        int(op.get("numRowsTotal", 0))
        for op in progress.get("stateOperators", [])
        if operator is None or op.get("operatorName") == operator
    )


def dropped_by_watermark(progress: dict) -> int:
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for op in progress.get("stateOperators", []))


def watermark(progress: dict) -> str | None:
    return progress.get("eventTime", {}).get("watermark")


def history(q: StreamingQuery) -> list[dict]:
    return [p for p in q.recentProgress]


class ProgressLog(StreamingQueryListener):
    """Keeps the newest ``keep`` progress records of all queries, and the number of late rows
    over all of them (for tests and monitoring)."""

    def __init__(self, keep: int = 1000):
        self.records: deque[dict] = deque(maxlen=keep)
        self._late = 0

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        import json

        record = json.loads(event.progress.json)
        self.records.append(record)
        self._late += dropped_by_watermark(record)

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass

    def late_rows(self) -> int:
        return self._late

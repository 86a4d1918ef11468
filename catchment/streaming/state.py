"""Keyed state of the streams, held by the engine's state store (RocksDB, as `build_session` sets it)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ListState

#: Stands for a missing whole number on the way through pandas, which would turn the column into floats.
NONE = -(1 << 62)


def _put(state: ListState, rows: list[tuple]) -> None:
    """A list state doesn't take an empty list."""
    if rows:
        state.put(rows)
    else:
        state.clear()


class CircuitOfKey(StatefulProcessor):
    """Decides whether each request of a key started while a ban was open.

    Requests wait until the watermark has passed their start; then every 429 that came back before is known. Of the bans,
    those that came back beyond the watermark stay, and the newest one below it while it is open. Rows are (start_ms,
    tie, http_status, is_request, ban_ms); a row may be a request, a ban, or both.
    """

    def __init__(self, key: str, ban_ms: int) -> None:
        self.key, self.ban_ms = key, ban_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "start_ms long, tie string, http_status long")
        self.bans = handle.getListState("bans", "finish_ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        first = None
        for some in rows:
            known = some.loc[some["ban_ms"] != NONE, "ban_ms"]
            if len(known):
                self.bans.appendList([(int(at),) for at in known.unique()])
            requests = some[some["is_request"]]
            late = requests["start_ms"] < watermark
            if late.any():
                yield self._told(key, requests[late], None)
            requests = requests[~late]
            if len(requests):
                self.waiting.appendList(list(zip(map(int, requests["start_ms"]), requests["tie"], map(int, requests["http_status"]), strict=True)))
                first = int(requests["start_ms"].min()) if first is None else min(first, int(requests["start_ms"].min()))
        if first is not None:
            self.handle.registerTimer(first)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        waiting = pd.DataFrame(list(self.waiting.get()), columns=["start_ms", "tie", "http_status"])
        due = waiting["start_ms"] <= watermark
        if not due.any():
            return
        bans = np.unique(np.array([at for (at,) in self.bans.get()], np.int64))
        yield self._told(key, waiting[due], bans)
        rest = waiting[~due]
        _put(self.waiting, [(int(start), tie, int(status)) for start, tie, status in rest.itertuples(index=False)])
        if len(rest):
            self.handle.registerTimer(int(rest["start_ms"].min()))
        # Requests to come start at the watermark or later.
        below = int(np.searchsorted(bans, watermark))
        kept = bans[below - 1 :] if below and bans[below - 1] + self.ban_ms > watermark else bans[below:]
        _put(self.bans, [(int(at),) for at in kept])

    def _told(self, key, requests: pd.DataFrame, bans: np.ndarray | None) -> pd.DataFrame:
        """Decisions on requests; late ones, for which bans may be gone, have none."""
        start = requests["start_ms"].to_numpy(np.int64)
        status = requests["http_status"]
        told = pd.DataFrame({self.key: key[0], "tie": requests["tie"], "start_ms": start, "http_status": status.where(status != NONE).astype("Int64")})
        told["is_late"] = bans is None
        if bans is None or not len(bans):
            told["circuit_open"], told["ban_until_ms"] = None if bans is None else False, pd.array([None] * len(told), "Int64")
            return told
        last = np.searchsorted(bans, start) - 1
        until = bans[np.maximum(last, 0)] + self.ban_ms
        is_open = (last >= 0) & (start < until)
        told["circuit_open"] = is_open
        told["ban_until_ms"] = pd.array(np.where(is_open, until, 0), "Int64")
        told.loc[~is_open, "ban_until_ms"] = pd.NA
        return told

    def close(self) -> None:
        pass


class AttemptsOfJob(StatefulProcessor):
    """Counts a job's attempts up to a cap; an event that comes again counts once. Rows are (event_id, event_type, at_ms).

    A success is final, whatever comes before or after it. Only as many event ids are held as the cap allows, and a job
    is forgotten when the watermark is `remember_ms` beyond its newest event.
    """

    def __init__(self, max_attempts: int, remember_ms: int) -> None:
        self.max_attempts, self.remember_ms = max_attempts, remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "event_id string", "attempt int")
        self.facts = handle.getValueState("facts", "attempts int, has_succeeded boolean, newest_ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        old = tuple(self.facts.get()) if self.facts.exists() else None
        attempts, won, newest = old or (0, False, NONE)
        for some in rows:
            newest = max(newest, int(some["at_ms"].max()))
            won = won or bool((some["event_type"] == "succeeded").any())
            if attempts >= self.max_attempts:
                continue
            for event in some.loc[some["event_type"] == "started", "event_id"].drop_duplicates():
                if attempts < self.max_attempts and not self.seen.containsKey((event,)):
                    attempts += 1
                    self.seen.updateValue((event,), (attempts,))
        if old != (attempts, won, newest):
            self.facts.update((attempts, won, newest))
            if newest != NONE and (old is None or newest > old[2]):
                self.handle.registerTimer(newest + self.remember_ms)
        if old is None or old[:2] != (attempts, won):
            yield pd.DataFrame({"job_id": [key[0]], "attempts": [attempts], "has_succeeded": [won], "state": [state_of(attempts, won, self.max_attempts)]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.facts.exists() and self.facts.get()[2] + self.remember_ms <= timerValues.getCurrentWatermarkInMs():
            self.facts.clear()
            self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def state_of(attempts: int, won: bool, max_attempts: int) -> str:
    return "succeeded" if won else "exhausted" if attempts >= max_attempts else "open"

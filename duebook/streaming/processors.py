"""Keyed state machines.  Their state has a fixed size for each key, however many rows it has."""

from collections.abc import Iterator
from itertools import batched

import pandas as pd
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from duebook import constants as K

RETRY_OUTPUT = """notification_id bigint, notification_status string, retry_count int,
  changed_micros bigint, next_retry_micros bigint, is_final boolean"""
RETRY_ROW = Row(
    "notification_id", "notification_status", "retry_count", "changed_micros", "next_retry_micros", "is_final",
)
STUCK_OUTPUT = "entity_id bigint, stuck_since timestamp, detected_at timestamp"

DELAY = pd.Timedelta(K.RETRY_DELAY)
LIMIT = pd.Timedelta(K.STALE_AFTER)
ORDER = ["attempt_at", "attempt_id"]
WIDTH = 2 + 2 * (1 + K.MAX_RETRY_COUNT)  # numbers kept of a notification: id, next look, success, failures


def compact_attempts(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per chunk and notification: the first success and the first failures that can count."""
    for chunk in chunks:
        ordered = chunk.sort_values(ORDER)
        parts = ordered.groupby(["notification_id", "delivered"], sort=False)
        place = parts.cumcount()
        yield ordered[(place == 0) | (~ordered["delivered"] & (place < K.MAX_RETRY_COUNT))]


def _millis(t: pd.Timestamp) -> int:
    return t.value // 1_000_000


def _micros_of(d: pd.Timedelta) -> int:
    return d.value // 1000


def _ordered(attempts) -> list[tuple]:
    return sorted(set(attempts))


def retry_state(sent, failures):
    """Status, number of failures, time of the last change and of the next retry of a notification.

    `sent` is its first success or None, `failures` its first failures in order; attempts are
    pairs (microseconds, id).
    """
    counted = [f for f in failures if sent is None or f < sent]
    if len(counted) == K.MAX_RETRY_COUNT:
        return "DEAD", len(counted), counted[-1][0], None
    if sent is not None:
        return "SENT", len(counted), sent[0], None
    return "RETRY", len(counted), counted[-1][0], counted[-1][0] + _micros_of(DELAY)


class RetryMachine(StatefulProcessor):
    """Keeps the first success and the first failures of each notification of a group.

    A notification has a fixed number of values in its group, with the time at which it is to be
    looked at next; the group has one timer, for the least of these.  So the exchanges with the
    state store grow with the groups that a batch touches and not with its notifications.

    A notification that was sent or is dead leaves the state when the watermark has passed the
    attempt that ended it: no earlier attempt can come any more.  Then its row goes out once
    more, as final.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("group", "notifications array<bigint>")

    def _load(self) -> dict:
        """Notification -> (time of the next look or None, first success or None, first failures)."""
        values, out = self.kept.get() or ((),), {}
        for number, look, *places in batched(values[0], WIDTH):
            sent, *failures = [None if at is None else (at, i) for at, i in batched(places, 2)]
            out[number] = look, sent, [f for f in failures if f]
        return out

    def _store(self, before: int | None, group: dict) -> None:
        """Keep the group, whose timer was set to `before`: `WIDTH` numbers per notification."""
        values, none = [], (None, None)
        for number, (look, sent, failures) in group.items():
            values += number, look, *(sent or none), *[v for f in failures for v in f]
            values += none * (K.MAX_RETRY_COUNT - len(failures))
        if group:
            self.kept.update((values,))
        else:
            self.kept.clear()
        timer = _next_look(group)
        if timer != before:
            if before is not None:
                self.handle.deleteTimer(before)
            if timer is not None:
                self.handle.registerTimer(timer)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        """Failures so far, all at the time of the last one; their ids come before any attempt's."""
        group = {}
        for row in initialState["open"]:
            at, n = row["at"], row["failures"]
            failures = [(at, i - n - 1) for i in range(min(n, K.MAX_RETRY_COUNT))]
            group[row["notification_id"]] = (at + _micros_of(DELAY)) // 1000, None, failures
        self._store(None, group)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        group = self._load()
        before, changed = _next_look(group), set()
        for row in rows:
            number, attempt = row["notification_id"], (row["attempt_micros"], row["attempt_id"])
            look, sent, failures = group.get(number, (None, None, []))
            if row["delivered"]:
                sent = attempt if sent is None else min(sent, attempt)
            else:
                failures = _ordered([*failures, attempt])[: K.MAX_RETRY_COUNT]
            group[number] = look, sent, failures
            changed.add(number)
        found = []
        for number in changed:
            _, sent, failures = group[number]
            status, count, at, due = retry_state(sent, failures)
            group[number] = (at if due is None else due) // 1000, sent, failures
            found.append(RETRY_ROW(number, status, count, at, due, False))
        self._store(before, group)
        yield from found

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        group, found = self._load(), []
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        for number, (look, sent, failures) in list(group.items()):
            if look is None or look > now:
                continue
            status, count, at, due = retry_state(sent, failures)
            if due is None:
                del group[number]
                found.append(RETRY_ROW(number, status, count, at, due, True))
            else:
                group[number] = None, sent, failures
                found.append(RETRY_ROW(number, "RETRY_DUE", count, at, due, False))
        self._store(None, group)
        yield from found

    def close(self) -> None:
        pass


def _next_look(group: dict) -> int | None:
    return min((look for look, _, _ in group.values() if look is not None), default=None)


class StuckDetector(StatefulProcessor):
    """Keeps the last change of an entity and a timer for the end of the staleness limit."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "last_at bigint, last_status string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # One row per slice of time, so a batch holds as many rows as it spans slices.
        slices = pd.concat(list(rows)).sort_values("slice_end")
        stored = self.last.get() if self.last.exists() else None
        previous = (pd.Timestamp(stored[0] * 1000), stored[1]) if stored else None
        stuck = []
        for s in slices.itertuples(index=False):
            if previous and previous[1] == "PROCESSING" and s.first_at - previous[0] > LIMIT:
                stuck.append(previous[0])
            previous = (s.last_at, s.last_status)
        self.last.update((int(pd.Timestamp(previous[0]).value // 1000), previous[1]))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if previous[1] == "PROCESSING":
            # The next slice has to be complete before silence means stuck.
            self.handle.registerTimer(_millis(slices["slice_end"].iloc[-1] + LIMIT))
        if stuck:
            yield pd.DataFrame(
                {"entity_id": key[0], "stuck_since": stuck, "detected_at": [t + LIMIT for t in stuck]}
            )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = pd.Timestamp(self.last.get()[0] * 1000)
        self.last.update((int(at.value // 1000), "REPORTED"))
        yield pd.DataFrame({"entity_id": [key[0]], "stuck_since": [at], "detected_at": [at + LIMIT]})

    def close(self) -> None:
        pass

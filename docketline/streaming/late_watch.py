"""Change detection when snapshots arrive late or out of order.

``watch.change_stream`` judges each snapshot when it arrives, so one that comes
after its successor is dropped there. Here every path keeps its snapshots that are
younger than the watermark in map state, in the order of their versions. A batch
puts its rows in, judges the rows whose predecessor they changed again, and emits
only what differs from what was said before: ``+1`` for a snapshot that fires now,
``-1`` for one that no longer does. The sum by snapshot is the batch result
(``watch.changes``) for every arrival order in which no snapshot is later than the
watermark allows.

Snapshots that the watermark has passed can't get another predecessor; they are
folded into one small value a path (seen, last hash, last version), by the rows that come or by
an event-time timer where none come. So state is bounded by the snapshots of the
delay, and one value a path that was ever seen. Spark itself drops rows behind
the watermark. Repeated versions count once. Needs a RocksDB state store
(``STATE_STORE``), which is the session's setting to make.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

OUTPUT_SCHEMA = "path string, ts timestamp, event_id bigint, md5 string, change int"
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class LateChanges(StatefulProcessor):
    """State of a path: ``base`` for what the watermark has passed, ``open`` for
    (version) -> (hash, whether it fires)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.base = handle.getValueState("base", "last string, us bigint, event_id bigint")
        self.open = handle.getMapState("open", "us bigint, event_id bigint", "md5 string, fires boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        base = self.base.get()
        held = {tuple(k): tuple(v) for k, v in self.open.iterator()}
        order = sorted(held)
        dirty = []
        for pdf in rows:
            for us, event_id, md5 in zip(pdf["us"], pdf["event_id"], pdf["md5"]):
                version = (int(us), int(event_id))
                if version not in held and (base is None or version > (base[1], base[2])):
                    held[version] = (None if pd.isna(md5) else md5, None)
                    insort(order, version)
                    dirty.append(version)
        out, judged = [], -1
        for version in sorted(dirty):
            at = bisect_left(order, version)
            if at <= judged:
                continue
            # from here on, until a snapshot that has a hash and stays as it was
            last, seen = self._before(order, held, at, base)
            while at < len(order):
                v = order[at]
                md5, fired = held[v]
                fires = seen and md5 is not None and md5 != last
                if fires != bool(fired):
                    out.append((key[0], pd.Timestamp(v[0], unit="us"), v[1], md5, 1 if fires else -1))
                if fires != fired:
                    held[v] = (md5, fires)
                    self.open.updateValue(v, (md5, fires))
                judged, at = at, at + 1
                if md5 is not None and fired is not None:
                    break
                last, seen = md5 if md5 is not None else last, True
        self._fold(order, held, timerValues.getCurrentWatermarkInMs())
        yield pd.DataFrame(out, columns=["path", "ts", "event_id", "md5", "change"])

    @staticmethod
    def _before(order: list, held: dict, at: int, base) -> tuple[str | None, bool]:
        """(last hash, whether anything was seen) before a place."""
        for v in reversed(order[:at]):
            if held[v][0] is not None:
                return held[v][0], True
        return (base[0] if base else None), bool(base) or at > 0

    def _fold(self, order: list, held: dict, watermark_ms: int) -> None:
        """Put what the watermark has passed into ``base``; ask to be called when
        it passes the rest."""
        done = [v for v in order if v[0] <= watermark_ms * 1000]
        if done:
            base = self.base.get()
            hashes = [held[v][0] for v in done if held[v][0] is not None]
            self.base.update((hashes[-1] if hashes else base[0] if base else None, *done[-1]))
            for v in done:
                self.open.removeKey(v)
        if len(done) < len(order):
            at = order[-1][0] // 1000 + 1
            if at not in set(self.handle.listTimers()):
                for old in list(self.handle.listTimers()):
                    self.handle.deleteTimer(old)
                self.handle.registerTimer(at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = {tuple(k): tuple(v) for k, v in self.open.iterator()}
        self._fold(sorted(held), held, timerValues.getCurrentWatermarkInMs())
        return iter(())

    def close(self) -> None:
        pass


def late_change_stream(watch_stream: DataFrame, delay: str) -> DataFrame:
    """(path, ts, event_id, md5) snapshots in any order within ``delay`` -> the
    snapshots that fire, with ``change`` +1 or, where a later arrival took it
    back, -1."""
    rows = watch_stream.withWatermark("ts", delay).select("path", "ts", "event_id", "md5", F.unix_micros("ts").alias("us"))
    return rows.groupBy("path").transformWithStateInPandas(LateChanges(), OUTPUT_SCHEMA, "Append", "EventTime")


def net_changes(emitted: DataFrame) -> DataFrame:
    """What stands after all corrections, one row a snapshot."""
    return (emitted.groupBy("path", "ts", "event_id", "md5").agg(F.sum("change").alias("net")).where("net > 0").drop("net"))

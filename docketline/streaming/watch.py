"""Change detection on file snapshots (the watcher's trigger rule).

Rule: the first observation of a path is a silent baseline; later an
observation fires when its hash is non-null and differs from the last
non-null hash seen before it; a missing file (NULL hash) neither fires nor
resets. A → B → A fires twice, which is why this is keyed state and not
``dropDuplicates``.

``changes`` is the batch form (skew-safe ordered scan); ``change_stream``
runs the same rule incrementally with ``applyInPandasWithState``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from docketline.operators.ordered import previous_non_null

OUTPUT_SCHEMA = "path string, ts timestamp, event_id bigint, md5 string"
STATE_SCHEMA = "seen boolean, last_md5 string, last_ts timestamp, last_id bigint"


def changes(watch: DataFrame, key: str = "path", order: tuple[str, ...] = ("ts", "event_id"),
            value: str = "md5") -> DataFrame:
    """Observations that fire (batch form)."""
    p = previous_non_null(watch, key, list(order), value, "_prev", first_flag="_first")
    fired = (~F.col("_first") & F.col(value).isNotNull()
             & (F.col("_prev").isNull() | (F.col(value) != F.col("_prev"))))
    return p.where(fired).drop("_prev", "_first")


def _fire(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Per path and micro-batch: apply the rule in version order, carrying
    (seen, last non-null hash) in state. Rows at or before the stored version
    (replays) are ignored."""
    pdf = pd.concat(list(batches), ignore_index=True).sort_values(["ts", "event_id"])
    if state.exists:
        seen, last, last_ts, last_id = state.get
    else:
        seen, last, last_ts, last_id = False, None, None, None
    out = []
    for row in pdf.itertuples(index=False):
        if last_ts is not None and (row.ts, row.event_id) <= (pd.Timestamp(last_ts), last_id):
            continue
        h = None if pd.isna(row.md5) else row.md5
        if seen and h is not None and h != last:
            out.append((key[0], row.ts, row.event_id, h))
        if h is not None:
            last = h
        seen = True
        last_ts, last_id = row.ts, int(row.event_id)
    state.update((seen, last, last_ts, last_id))
    yield pd.DataFrame(out, columns=["path", "ts", "event_id", "md5"])


def change_stream(watch_stream: DataFrame) -> DataFrame:
    """Streaming form: (path, ts, event_id, md5) rows in, fired rows out.

    State is one small row per path and survives restarts through the query
    checkpoint. Within a micro-batch, rows of one path are ordered by version.
    """
    return watch_stream.groupBy("path").applyInPandasWithState(
        _fire, OUTPUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)

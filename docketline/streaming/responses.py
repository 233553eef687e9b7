"""Streaming model responses: event-stream chunks → one response per request.

Chunks arrive as rows (request_id, chunk_no, line, done), in any order; ``done``
marks the last chunk of a request (the landing side sets it when the connection
closes). Contents are decoded in the JVM. The state of an open request is a map
from chunk number to content and one small row of counts, so a chunk is written
once when it comes and read once when its request is folded, however many batches
that takes.

A request is whole when its last chunk is there and no number before it is missing;
then its response is emitted and its chunks are removed. When nothing came for
``timeout_ms``, the answer is an error, never the part seen so far: the stream was
cut, or a chunk number is missing. Either way a mark stays for ``mark_ms``, for
which late and repeated chunks of the request are ignored; the state store removes
it after that.

Needs a RocksDB state store (``late_watch.STATE_STORE``). With timers Spark runs
a micro-batch without data now and then, so drive the query with a
``processingTime`` trigger.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from docketline.functions import text as T

OUTPUT_SCHEMA = "request_id string, response string"
BROKEN_STREAM = "Error: Stream ended early"
MISSING_CHUNK = "Error: Missing chunk {}"


class ChunkFold(StatefulProcessor):
    def __init__(self, timeout_ms: int, mark_ms: int, first_chunk: int | None):
        self.timeout_ms, self.mark_ms, self.first_chunk = timeout_ms, mark_ms, first_chunk

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getMapState("chunks", "no bigint", "content string")
        self.counts = handle.getValueState("counts", "n bigint, least bigint, last bigint, timer bigint")
        self.closed = handle.getValueState("closed", "mark boolean", self.mark_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if self.closed.exists():
            for _ in rows:
                pass
            yield _out(key[0])
            return
        n, least, last, timer = self.counts.get() if self.counts.exists() else (0, None, None, None)
        for pdf in rows:
            for no, content, done in zip(pdf["chunk_no"], pdf["content"], pdf["done"]):
                no = int(no)
                if not self.chunks.containsKey((no,)):
                    n, least = n + 1, no if least is None else min(least, no)
                self.chunks.updateValue((no,), (None if pd.isna(content) else content,))
                if done:
                    last = no if last is None else max(last, no)
        start = least if self.first_chunk is None else self.first_chunk
        if timer is not None:
            self.handle.deleteTimer(timer)
        if last is not None and n == last - start + 1:
            yield _out(key[0], self._fold())
            self._close()
        else:
            timer = timerValues.getCurrentProcessingTimeInMs() + self.timeout_ms
            self.handle.registerTimer(timer)
            self.counts.update((n, least, last, timer))
            yield _out(key[0])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        _, least, last, _ = self.counts.get()
        answer = BROKEN_STREAM
        if last is not None:
            held = {k[0] for k in self.chunks.keys()}
            start = least if self.first_chunk is None else self.first_chunk
            answer = MISSING_CHUNK.format(next(i for i in range(start, last + 1) if i not in held))
        self._close()
        yield _out(key[0], answer)

    def _fold(self) -> str:
        text = "".join(c for _, c in sorted((k[0], v[0]) for k, v in self.chunks.iterator() if v[0] is not None))
        return text.strip() if text else T.NO_CONTENT_RESPONSE

    def _close(self) -> None:
        self.chunks.clear()
        self.counts.clear()
        self.closed.update((True,))

    def close(self) -> None:
        pass


def _out(request_id: str, *answers: str) -> pd.DataFrame:
    return pd.DataFrame({"request_id": [request_id] * len(answers), "response": list(answers)}, dtype=object)


def sse_fold_stream(chunks: DataFrame, timeout_ms: int = 10 * 60 * 1000, mark_ms: int = 24 * 60 * 60 * 1000,
                    first_chunk: int | None = None) -> DataFrame:
    """Streaming form of ``inference.sse_fold`` (same fold rule). ``first_chunk`` is
    the number every request starts with; if not given, the least one seen is."""
    decoded = chunks.select("request_id", "chunk_no", T.sse_content("line").alias("content"),
                            F.coalesce(F.col("done"), F.lit(False)).alias("done"))
    return decoded.groupBy("request_id").transformWithStateInPandas(
        ChunkFold(timeout_ms, mark_ms, first_chunk), OUTPUT_SCHEMA, "Append", "ProcessingTime")

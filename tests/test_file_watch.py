"""Files that change in place: what fires, and what a restart does."""

import os
import tempfile

import pytest

from docketline.streaming.file_watch import WatchReader, content_hash, observations, run_on_change
from docketline.streaming.watch import change_stream

A, B = "ID\n1\n\n 2 \n", "ID\n3\n"


def put(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_content_fires_not_names(spark):
    d = tempfile.mkdtemp(prefix="fw-")
    path, late, ck = os.path.join(d, "list.csv"), os.path.join(d, "late.csv"), os.path.join(d, "ck")
    put(path, A)
    fired = []

    def start():
        stream = change_stream(observations(spark, [path, late]))
        return stream.writeStream.foreachBatch(lambda df, i: fired.extend((r.path, r.md5) for r in df.collect())).option("checkpointLocation", ck).start()

    q = start()
    hashes = {}

    def step(text, at=path):
        os.remove(at) if text is None else put(at, text)
        hashes[text] = content_hash(at)
        before = len(fired)
        q.processAllAvailable()
        return [h for _, h in fired[before:]]

    try:
        q.processAllAvailable()
        assert fired == []  # the baseline is silent
        assert step(B) == [hashes[B]] and step(A) == [hashes[A]]  # A, B, A fires twice
        assert step(A) == []  # written again, same content
        assert step(None) == []  # missing: doesn't fire
        assert step(A) == []  # nor reset
        assert step(B) == [hashes[B]]
        assert step(A, late) == [hashes[A]]  # was missing at the baseline, so this is a change
        q.stop()
        n = len(fired)
        q = start()
        q.processAllAvailable()
        assert len(fired) == n  # a restart replays nothing
        q.stop()
        put(path, A)  # changed while the query is down
        q = start()
        q.processAllAvailable()
        assert [h for _, h in fired[n:]] == [content_hash(path)]
        assert step(B) == [hashes[B]]
    finally:
        q.stop()


def test_work_list_that_is_replaced(spark):
    d = tempfile.mkdtemp(prefix="fw-")
    path, ck, seen = os.path.join(d, "list.csv"), os.path.join(d, "ck"), []
    put(path, A)

    def run():
        run_on_change(spark, [path], lambda ids, i: seen.append(sorted(r.ID for r in ids.collect())), ck, once=True).awaitTermination(60)

    for text in (A, B, B, A):
        put(path, text)
        run()
    assert seen == [["3"], ["1", "2"]]


def test_offsets_alone_give_the_rows():
    r = WatchReader(["b", "a", "a"])
    assert r.latestOffset() == {"a": None, "b": None}
    part = r.partitions({"a": "1", "b": None}, {"a": "2", "b": None})
    assert [list(r.read(p)) for p in part] == [[("a", "2")]] == [list(r.read(p)) for p in part]
    assert r.partitions({"a": "1"}, {"a": "1"}) == []
    with pytest.raises(Exception):
        content_hash("nosuchscheme://x/y")

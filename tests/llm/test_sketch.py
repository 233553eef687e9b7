"""The frequency sketch doesn't depend on how many tasks count."""

import numpy as np
import pytest

from docketline.llm.common import materialize
from docketline.llm.signature_tree import SKETCH_BITS, SKETCH_FAN, _sketch


def test_sketch_is_the_same_for_any_number_of_tasks(spark):
    rng = np.random.default_rng(1)
    often = rng.integers(0, 2**64, 3, np.uint64)
    rows = [(np.sort(np.concatenate((often, rng.integers(0, 2**64, 4, np.uint64)))).tobytes(),) for _ in range(120)]
    one, many = (materialize(spark.createDataFrame(rows, "tokens binary").repartition(n), "sketch-test") for n in (1, 2 * SKETCH_FAN + 8))
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a task for each file
    try:
        assert many.rdd.getNumPartitions() > 2 * SKETCH_FAN
        got = _sketch(many)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert (got == _sketch(one)).all()
    assert (got[(often >> np.uint64(44)).astype(np.int64)] > 0).all() and (got > 0).sum() == len(often)


@pytest.mark.parametrize("tasks", [1, 5])
def test_the_driver_gets_a_byte_a_bucket(spark, monkeypatch, tasks):
    """Counts stay in tasks; the classes are those of the counts of the whole table."""
    rng = np.random.default_rng(2)
    often = rng.integers(0, 2**64, 4, np.uint64)
    sets = [np.sort(np.concatenate((often[:1 + i % 4], rng.integers(0, 2**64, 5, np.uint64)))) for i in range(200)]
    df = materialize(spark.createDataFrame([(s.tobytes(),) for s in sets], "tokens binary").repartition(tasks), "sketch-bytes")
    seen, real = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: seen.append(real(self)) or seen[-1])
    got = _sketch(df)
    monkeypatch.undo()
    total = np.bincount((np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS)
    usual = total.mean()
    want = np.where(total > 3 * usual + 16, 1 + np.log2(np.maximum(total / (usual + 4), 1)), 0).astype(np.uint8)
    assert (got == want).all() and got.any()
    assert sum(len(v) for rows in seen for r in rows for v in r if isinstance(v, bytes | bytearray)) <= 1 << SKETCH_BITS

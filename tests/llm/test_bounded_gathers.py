"""What groups and the driver hold does not grow with the number of tasks."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docketline.llm import masked_lm, url_filter


@pytest.mark.parametrize("tasks", [1, 2, 16, 17, 40])
def test_sums_of_slices(spark, tasks, monkeypatch):
    """Arrays of any number of tasks, added a few at a time, give their sum."""
    monkeypatch.setattr(masked_lm, "FAN", 4)
    size = 1000

    def run(batches):
        from pyspark import TaskContext
        for _ in batches:
            pass
        yield masked_lm._slices(np.arange(size) * (TaskContext.get().partitionId() + 1))

    df = spark.range(tasks * 3).repartition(tasks).mapInArrow(run, masked_lm._SLICE_DDL)
    got = masked_lm._sum_slices(df, np.int64, tasks)
    assert got.tolist() == (np.arange(size) * (tasks * (tasks + 1) // 2)).tolist()


def test_no_arrays_no_sum(spark):
    df = spark.range(5).mapInArrow(lambda b: (pa.RecordBatch.from_pylist([], schema=pa.schema([("slice", pa.int32()), ("turn", pa.int32()), ("part", pa.binary())])) for _ in b),
                                   masked_lm._SLICE_DDL)
    assert len(masked_lm._sum_slices(df, np.float64, 8)) == 0


def test_labelled_urls_are_the_least_by_hash(spark, monkeypatch):
    """The sample behind the counted threshold is that of a full sort."""
    seen = []
    real = url_filter.fit

    def spy(rows, *a):
        seen.append(rows)
        return real(rows, *a)

    monkeypatch.setattr(url_filter, "fit", spy)
    urls = [(i, f"http://h{i}.{'net' if i % 2 else 'org'}/{'' if i % 2 else 'fr/'}p{i}") for i in range(3000)] + [(9000, "http://free.xyz/a"), (9001, None)]
    df = spark.createDataFrame(urls, "page_id long, url string").repartition(30)
    out = url_filter.judge(df, max_train=200).collect()
    parts = [(h, p) for h, p, _ in seen[0]]
    every = df.select(url_filter.host_of(F.col("url")).alias("h"), url_filter.path_of(F.col("url")).alias("p")).where("h like 'h%'").distinct()
    want = [tuple(r) for r in every.orderBy(F.xxhash64("h", "p"), "h", "p").limit(200).collect()]
    assert parts == want and len(parts) == 200
    for r in out:
        assert (r["judged"]["p_block"] is None) == (r["judged"]["rule"] is not None)


def test_scoring_goes_in_steps_that_stay_in_the_cache(monkeypatch):
    """Log-probabilities are those of the whole softmax, worked out a batch at a time."""
    rng = np.random.default_rng(3)
    net = masked_lm.Network.start(np.ones(masked_lm.CLASSES))
    n = 3 * masked_lm.BATCH + 17
    context = rng.integers(0, 1 << masked_lm.CONTEXT_BITS, (n, 2 * masked_lm.SIDE)).astype(np.int32)
    target = rng.integers(0, masked_lm.CLASSES, n)
    table, b, w, c = (p.astype(np.float64) for p in net.parts)
    z = np.tanh(sum(table[context[:, k] + (k << masked_lm.CONTEXT_BITS)] for k in range(2 * masked_lm.SIDE)) + b) @ w + c
    want = z[np.arange(n), target] - np.log(np.exp(z).sum(axis=1))
    seen, real = [], masked_lm.Network.forward
    monkeypatch.setattr(masked_lm.Network, "forward", lambda self, x: seen.append(len(x)) or real(self, x))
    assert np.allclose(net.log_probs(context, target), want, atol=1e-5)
    assert max(seen) == masked_lm.BATCH and sum(seen) == n


def test_a_worker_gives_freed_memory_back():
    """What a stage leaves in a worker's heap doesn't add to the next stage's."""
    import ctypes
    from pathlib import Path

    from docketline.llm.common import give_back

    if not hasattr(ctypes.CDLL(None), "malloc_trim"):
        pytest.skip("another C library")

    def held():
        return int(Path("/proc/self/statm").read_text().split()[1]) * 4096 / 1e6

    many = [bytes(2000) for _ in range(60_000)]
    last = bytes(2000)  # keeps the end of the heap in use
    del many
    full = held()
    give_back()
    assert full - held() > 50 and last


def test_joins_of_cells_read_the_chosen_classes_only(spark, monkeypatch):
    """Registers of classes that share no band with another aren't exchanged for cells."""
    from docketline.llm import hyper_minhash

    seen, real = [], hyper_minhash._join_cells
    monkeypatch.setattr(hyper_minhash, "_join_cells", lambda cells, known, *a: seen.append(known.count()) or real(cells, known, *a))
    texts = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(40)]
    texts += [texts[0] + " more", texts[1] + " more"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: r["component"] for r in hyper_minhash.near_duplicates(df).collect()}
    assert got == {i: {40: 0, 41: 1}.get(i, i) for i in range(42)}
    assert seen and max(seen) < 10


def test_the_driver_gives_back_what_the_packing_search_held(spark, monkeypatch):
    """The driver lives on after packing; what the search leaves in its heap adds to what other stages need."""
    import json

    from docketline.llm import packing

    seen, solve = [], packing.solve
    spec = json.dumps({"added_tokens": [], "model": {"vocab": {c: i + 3 for i, c in enumerate(packing.byte_alphabet())}}})
    monkeypatch.setattr(packing, "pieces", lambda docs, *a: docs)
    monkeypatch.setattr(packing, "solve", lambda *a: seen.append("search") or solve(*a))
    monkeypatch.setattr(packing, "give_back", lambda: seen.append("back"))
    cut = spark.createDataFrame([(i, 0, 0, 3, 7, 0, i) for i in range(4)], packing._PIECES)
    got = packing.pack(cut, spec, capacity=8).collect()
    assert seen == ["search", "back"]
    assert sorted((r["doc_id"], r["length"]) for r in got) == [(i, 3) for i in range(4)]


def test_cells_are_verified_from_written_tables(spark, monkeypatch):
    """The exchanges that find pairs and cells aren't in the plan that exchanges the sets."""
    from docketline.llm import signature_tree

    seen, real = [], signature_tree._join_cells

    def spy(cells, *a):
        seen.append(cells._jdf.queryExecution().executedPlan().toString().count("Exchange "))
        return real(cells, *a)

    monkeypatch.setattr(signature_tree, "_join_cells", spy)
    texts = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(40)]
    texts += [texts[0] + " more", texts[1] + " more"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: r["component"] for r in signature_tree.link_components(df).collect()}
    assert got == {i: {40: 0, 41: 1}.get(i, i) for i in range(42)}
    assert len(seen) == 2 and seen[1] <= 1

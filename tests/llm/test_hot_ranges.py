"""Bytes of the hash ranges that the Jaccard join deals shingles and ids to."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketline.llm import signature_tree
from docketline.llm.common import prepare


@pytest.mark.parametrize("equal", ["", "the same few words over and over in a short text"])
def test_no_range_is_hot(spark, equal):
    """With 30 % of the texts empty or equal, the largest range has at most twice the median."""
    prepare(spark)
    rng = np.random.default_rng(0)
    words = np.array([f"w{i}" for i in range(5000)])
    texts = [equal if i % 10 < 3 else " ".join(rng.choice(words, 9)) for i in range(20_000)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(4)
    dealt = df.mapInArrow(signature_tree._postings(64), signature_tree._PARTS_DDL)
    size = sum((F.octet_length(c) for c in ("cls", "counts", "tokens", "ids", "id_cls", "id_n", "id_null")), F.lit(0))
    sizes = [r["b"] for r in dealt.groupBy("part").agg(F.sum(size).alias("b")).collect()]
    assert len(sizes) == 64 and max(sizes) <= 2 * np.median(sizes)


def test_copies_send_their_shingles_once_a_buffer(spark):
    prepare(spark)
    df = spark.createDataFrame([(i, "one two three four five six seven") for i in range(1000)], "id long, text string").coalesce(1)
    rows = df.mapInArrow(signature_tree._postings(64), signature_tree._PARTS_DDL)
    assert rows.select(F.sum(F.octet_length("tokens"))).first()[0] == 3 * 4
    assert rows.select(F.sum(F.octet_length("ids"))).first()[0] == 1000 * 8

"""One document of each component stays, however full the bit table is."""

import pytest
from pyspark.sql import functions as F

from docketline.llm import signature_tree


@pytest.mark.parametrize("bits", [signature_tree.BLOOM_BITS, 32768])
def test_leaders_stay_whatever_the_bit_table_lets_through(spark, monkeypatch, bits):
    monkeypatch.setattr(signature_tree, "BLOOM_BITS", bits)
    n = 3000  # ids far apart, every third text a copy of the text before it
    text = F.when(F.col("id") % 3 == 2, F.col("id") - 1).otherwise(F.col("id"))
    words = F.concat_ws(" ", *[F.md5(F.concat(text.cast("string"), F.lit(f"-{i}"))) for i in range(12)])
    docs = spark.range(n).select((F.col("id") * 7919).alias("doc_id"), words.alias("text"), F.lit("x").alias("gone_id"))
    odd = spark.createDataFrame([(None, None, "x"), (-1, "", "x")], "doc_id long, text string, gone_id string")
    kept = signature_tree.drop_near_copies(docs.union(odd))
    assert kept.columns == docs.columns
    got = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert len(got) == len(set(got))
    assert set(got) == {7919 * i for i in range(n) if i % 3 != 2} | {None, -1}


def test_bit_table_holds_all_its_ids(spark, monkeypatch):
    monkeypatch.setattr(signature_tree, "BLOOM_BITS", 65536)
    ids = spark.range(0, 40000, 7).select("id").union(spark.createDataFrame([(None,)], "id long"))
    among = signature_tree._among(ids)
    assert ids.where(~among(F.col("id"))).isEmpty()
    assert spark.range(10**6, 10**6 + 20000).where(among(F.col("id"))).count() < 6000
    nobody = signature_tree._among(ids.where("id < 0"))
    assert ids.where(nobody(F.col("id"))).isEmpty()


def test_one_row_of_each_component_stays_with_null_and_repeated_ids(spark):
    def text(k, n=30):
        return " ".join(f"t{k}w{i}" for i in range(n))

    rows = [(3, text(1)), (7, text(2)), (7, text(1) + " end"), (7, text(2).upper()), (9, text(5)),
            (None, text(3)), (None, text(3) + " end"), (None, text(4)), (None, text(4)), (None, text(5)), (8, ""), (8, ""), (8, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r["doc_id"], r["text"]) for r in signature_tree.drop_near_copies(docs).collect()]
    words = sorted((i or 0, (t or "").lower()[:4]) for i, t in got)
    assert words == [(0, ""), (0, "t3w0"), (0, "t4w0"), (3, "t1w0"), (7, "t2w0"), (8, ""), (8, ""), (9, "t5w0")]

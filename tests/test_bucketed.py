"""A bucketed ledger is not exchanged, neither in joins nor in groupings."""

import re
import tempfile

from pyspark.sql import functions as F

from docketline import sinks
from docketline.operators import joins


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ledger_side_has_no_exchange(spark):
    d = tempfile.mkdtemp(prefix="bk-")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(5000).select(F.col("id").cast("string").alias("ID"), (F.col("id") % 7).alias("version"), F.lit("x").alias("v"))
        ledger = sinks.bucketed(rows.union(rows.where("ID < 100")), ["ID"], f"{d}/ledger", "bucketed_ledger_test")
        plain = spark.read.parquet(f"{d}/ledger")
        todo = spark.range(4000, 6000).select(F.col("id").cast("string").alias("ID"))
        todo.write.parquet(f"{d}/todo")
        todo = spark.read.parquet(f"{d}/todo")
        for op in (joins.unprocessed, joins.already_processed):
            text = plan(op(todo, ledger))
            assert len(re.findall(r"Exchange hashpartitioning", text)) == 1, text
            side = text[text.index("Exchange hashpartitioning"):]
            assert "todo" in side[:side.index("FileScan") + 600] and "Bucketed: true" in text
            assert sorted(r.ID for r in op(todo, ledger).collect()) == sorted(r.ID for r in op(todo, plain).collect())
        last = joins.last_wins(ledger, ["ID"], "version", ["v"])
        assert "Exchange" not in plan(last) and last.count() == 5000
        updated = joins.update_join(todo.withColumn("v", F.lit("old")), last, ["ID"], "v", "v")
        assert len(re.findall(r"Exchange hashpartitioning", plan(updated))) == 1
        assert updated.where("matched").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS bucketed_ledger_test")

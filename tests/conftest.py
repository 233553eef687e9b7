import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from docketline.session import build_session
    ckpt = tempfile.mkdtemp(prefix="docketline-test-ckpt-")
    s = build_session(master="local[*]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


def one_col(spark, values, fn, schema="x string"):
    """Apply a Column function to a list of values; returns the results."""
    from pyspark.sql import functions as F
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col(schema.split()[0]))).collect()]

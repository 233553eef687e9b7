"""CLI: python tests/run_oracles.py [sf_dir] [name ...] — prints one line per query."""
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle_compare import compare, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from docketline.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = build_session(master="local[8]", shuffle_partitions=8)
con = duck(sf)
qs, sqls = entry.queries(), entry.oracle_sql()
bad = 0
for name in names or list(qs):
    if name not in sqls:
        df = qs[name](spark, sf)
        print(f"{name:24s} rows-only {df.count()}")
        continue
    try:
        r = compare(spark, con, name, qs[name], sqls[name], sf)
    except Exception as e:  # report and go on
        bad += 1
        print(f"{name:24s} ERROR {type(e).__name__}: {str(e)[:400]}")
        continue
    ok = r["rows_ok"] and r["hash_ok"]
    bad += not ok
    print(f"{name:24s} {'OK ' if ok else 'BAD'} rows={r['rows']} spark={r['spark_s']}s duck={r['duck_s']}s"
          + ("" if ok else f" {dict((k, v) for k, v in r.items() if k not in ('name', 'rows'))}"))
print("failures:", bad)

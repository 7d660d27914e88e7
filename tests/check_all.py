"""Compares all registered queries with DuckDB at one scale: python tests/check_all.py DIR [NAME ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import connect, differences  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from admetrics.session import get_session  # noqa: E402

sf_dir, names = sys.argv[1], sys.argv[2:] or list(queries())
spark = get_session(
    master="local[8]",
    **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    **{"spark.ui.showConsoleProgress": "false"},
)
spark.sparkContext.setLogLevel("ERROR")
con = connect(sf_dir)
bad = 0
for name in names:
    start = time.time()
    try:
        found = differences(spark, con, sf_dir, name) if name in oracle_sql() else ["no oracle"]
    except Exception as error:  # report and go on with the next query
        found = [repr(error)[:600]]
    bad += bool(found)
    print(f"{name:32s} {time.time() - start:6.2f}s {'ok' if not found else found}", flush=True)
print("without oracle:", sorted(set(queries()) - set(oracle_sql())), "failed:", bad)

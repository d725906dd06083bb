"""Run registered queries in Spark and their SQL in DuckDB; print a summary.

usage: python tools/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sentispark.plans.catalog import load_all  # noqa: E402
from sentispark.plans.compare import compare, duckdb_connection  # noqa: E402
from sentispark.session import get_spark  # noqa: E402


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    reg = load_all()
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duckdb_connection(sf)
    bad = 0
    for name, spec in reg.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = spec.build(spark, sf)
            if spec.sql:
                res = compare(df, con, spec.sql)
                ok = res["values_match"] and res["spark_rows"] == res["oracle_rows"]
            else:
                res = {"spark_rows": df.count()}
                ok = True
        except Exception as e:  # report and continue
            res, ok = {"error": repr(e)[:600]}, False
        bad += not ok
        res["sec"] = round(time.time() - t0, 2)
        print(("OK  " if ok else "BAD ") + name, json.dumps(res, default=str)[:900], flush=True)
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

"""Compare every registered query with its SQL: python tests/check_all.py [folder] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from oracle import connect, normalized, type_mismatches  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from layerloom.session import build_session  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql = oracle_sql()
    bad = 0
    for name, build in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.monotonic()
        try:
            df = build(spark, folder)
            names, rows = normalized(df.columns, df.collect())
        except Exception as error:
            print(f"FAIL  {name}: {str(error)[:600]}")
            bad += 1
            continue
        seconds = time.monotonic() - started
        if name not in sql:
            print(f"rows  {name}: {len(rows)} ({seconds:.1f}s)")
            continue
        try:
            cursor = con.execute(sql[name])
            described = cursor.description
            other_names, other = normalized([d[0] for d in described], cursor.fetchall())
        except Exception as error:
            print(f"SQL   {name}: {str(error)[:600]}")
            bad += 1
            continue
        types = type_mismatches(df, described)
        if names != other_names:
            print(f"COLS  {name}: {names} vs {other_names}")
            bad += 1
        elif rows != other:
            ours, theirs = set(rows) - set(other), set(other) - set(rows)
            print(f"DIFF  {name}: {len(rows)} vs {len(other)}\n   ours   {sorted(ours)[:2]}\n   theirs {sorted(theirs)[:2]}")
            bad += 1
        else:
            print(f"ok    {name}: {len(rows)} ({seconds:.1f}s)" + (f"   types: {types}" if types else ""))
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main())

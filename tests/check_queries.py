"""Run registered queries against DuckDB: python -m tests.check_queries [sf_dir] [name part ...]."""

from __future__ import annotations

import sys
import time

from tests.compare import connect, differences
from veldtab.session import local_session


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = local_session()
    con = connect(sf)
    oracles = entry.oracle_sql()
    bad = 0
    for label, fn in entry.queries().items():
        if wanted and not any(w in label for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            if label in oracles:
                problem = differences(df, con, oracles[label])
            else:
                rows = df.collect()
                problem = None if rows else "no rows"
                if not problem:
                    print(f"   {label}: {len(rows)} rows, first {str(rows[0])[:200]}")
        except Exception as exc:  # report and go on with the next query
            problem = f"{type(exc).__name__}: {str(exc)[:700]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {label} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

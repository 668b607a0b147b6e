"""Command line of the engine (X10, X11): ``spark-submit -m spanloom.cli run bm25_topk --tables DIR --out DIR``.

list: the queries. run: one query as Parquet. check: queries without rows, or that fail, on a folder of tables.
"""

from __future__ import annotations

import argparse

from spanloom.plans.registry import QUERIES
from spanloom.session import session


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="spanloom")
    what = parser.add_subparsers(dest="what", required=True)
    what.add_parser("list")
    run = what.add_parser("run")
    run.add_argument("query", choices=sorted(QUERIES))
    run.add_argument("--tables", required=True)
    run.add_argument("--out", required=True)
    check = what.add_parser("check")
    check.add_argument("--tables", required=True)
    given = parser.parse_args(argv)
    if given.what == "list":
        print("\n".join(f"{name}: {(f.__doc__ or '').strip()}" for name, f in sorted(QUERIES.items())))
        return 0
    spark = session("spanloom")
    if given.what == "run":
        QUERIES[given.query](spark, given.tables).write.mode("overwrite").parquet(given.out)
        return 0
    failed = 0
    for name, f in sorted(QUERIES.items()):
        try:
            print(name, f(spark, given.tables).count())
        except Exception as e:  # the report names every failure
            failed += 1
            print(name, "failed:", str(e).splitlines()[0])
    return min(failed, 1)


if __name__ == "__main__":
    raise SystemExit(main())

"""python -m cubelattice list | run NAME DIR [ROWS] | csv NAME DIR OUT: the registered cube queries."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from cubelattice.plans.registry import QUERIES


def main(args: list[str]) -> int:
    if args[:1] == ["list"]:
        print(*sorted(QUERIES), sep="\n")
        return 0
    if len(args) < 3 or args[0] not in ("run", "csv") or args[1] not in QUERIES:
        print(__doc__, file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("cubelattice").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    found = QUERIES[args[1]](spark, args[2])
    if args[0] == "run":
        found.show(int(args[3]) if len(args) > 3 else 20, truncate=False)
    else:
        found.write.option("header", True).csv(args[3])
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

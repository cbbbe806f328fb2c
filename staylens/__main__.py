"""Rebuild everything: spark-submit -m style entry.

usage: python -m staylens SOURCE_ROOT OUT_ROOT NOW
       NOW is the clock time freshness is measured against, as 'YYYY-MM-DD HH:MM:SS'
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from staylens.plans.build import rebuild


def main(argv: list[str]) -> int:
    if len(argv) != 3:
        print(__doc__)
        return 2
    spark = SparkSession.builder.appName("staylens").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    checks, fresh = rebuild(spark, *argv)
    fresh.show(truncate=False)
    failed = checks.filter("status = 'fail'")
    failures = failed.count()
    failed.show(failures or 1, truncate=False)
    # Stale sources are reported, failed checks stop the run.
    return 1 if failures else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))

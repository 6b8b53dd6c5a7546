"""Print the shuffle/join/window/scan skeleton of each headline query's plan.

Usage: python scripts/explain_plans.py [sf_dir] > docs/plans.txt
Only operator lines that matter at scale are kept: exchanges (shuffles),
joins, windows, aggregates, sorts and scans with their pushed filters and
read schema.
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from eventsieve.plans import catalog  # noqa: E402
from eventsieve.session import get_spark  # noqa: E402

KEEP = re.compile(r"Exchange|Join|Window|HashAggregate|SortAggregate|TakeOrdered|Sort \[|FileScan|InMemoryTableScan|Union")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    for name in HEADLINE:
        buf = io.StringIO()
        with redirect_stdout(buf):
            catalog.SQL_CHECKED[name](spark, sf).explain("simple")
        print(f"===== {name}")
        for line in buf.getvalue().splitlines():
            if KEEP.search(line):
                line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "Location: ...", line)
                line = re.sub(r"#\d+L?", "", line)
                print(line[:260])


if __name__ == "__main__":
    main()

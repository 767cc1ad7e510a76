"""Print the formatted physical plan of registered checks.
Usage: python scripts/show_plans.py [sf_dir] name [name ...]"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flagstone.plans import suite  # noqa: E402
from flagstone.session import build_session  # noqa: E402


def main():
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    spark = build_session("local[4]", 8)
    for name in args:
        print(f"===== {name}")
        suite.QUERIES[name](spark, sf).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()

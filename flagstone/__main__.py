"""Command line: run the configured vendors' deliveries.

    spark-submit -m flagstone -c config.json -v first,second [-y 2019]
    python -m flagstone -c config.json -v first --input ... --output ...

The session comes from ``spark-submit`` / the environment
(``SparkSession.builder.getOrCreate()``); cluster settings stay there.
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from .plans.delivery import run_vendors
from .session import SESSION_CONF
from .sources.delivery import load_config


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="flagstone", description="Run data-quality rules over deliveries.")
    p.add_argument("-c", "--config", required=True, help="JSON rule configuration")
    p.add_argument("-v", "--vendors", required=True, help="comma-separated vendor names")
    p.add_argument("-y", "--year", help="specification year (accepted, not used)")
    p.add_argument("--input", help="delivery folder (default: from the configuration)")
    p.add_argument("--output", help="output folder (default: from the configuration)")
    p.add_argument("--database", help="catalog database for _RAW / _QC tables (default: from the configuration, else Parquet files)")
    p.add_argument("--single-file", action="store_true", help="write each flagged table as one CSV file too, as far as its parts are small enough to be joined")
    p.add_argument("--multi-line", action="store_true", help="cells may hold quoted line breaks (a file is then one task)")
    p.add_argument("--resume", action="store_true", help="go on where an earlier run to the same output ended")
    return p.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None) -> int:
    args = parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(name)s: %(message)s")
    cfg = load_config(args.config)
    spark = spark or SparkSession.builder.appName("flagstone").config(map=SESSION_CONF).getOrCreate()
    results = run_vendors(
        spark,
        cfg,
        args.vendors,
        input_loc=args.input,
        output_loc=args.output,
        database=args.database,
        single_file=args.single_file,
        multi_line=args.multi_line,
        resume=args.resume,
    )
    for vendor, res in results.items():
        for name, path in sorted(res.outputs.items()):
            print(f"{vendor}\t{name}\t{path}")
    for vendor, error in results.failed.items():
        print(f"{vendor}\tfailed\t{error}", file=sys.stderr)
    return 0 if results and not results.failed else 1


if __name__ == "__main__":
    sys.exit(main())

"""Full refresh from the command line.

    python -m tierlake --panel p.csv --outbreak o.csv --capacity c.csv [--variant demo] [--prefix x_]

On a cluster: spark-submit --py-files tierlake.zip tierlake/__main__.py with the same arguments.
"""

from __future__ import annotations

import argparse

from tierlake.plans.lake_reports import lake_reports
from tierlake.plans.refresh import Inputs, Refresh
from tierlake.session import build_session
from tierlake.sinks.tables import Lake


def main() -> None:
    parser = argparse.ArgumentParser(prog="tierlake")
    parser.add_argument("--panel", required=True, help="entity and year indicators, comma-separated")
    parser.add_argument("--outbreak", required=True, help="entity, province and date counts, comma-separated")
    parser.add_argument("--capacity", required=True, help="capacity file, a column per year unless --long")
    parser.add_argument("--long", action="store_true", help="the capacity file has one row per entity and year")
    parser.add_argument("--separator", help="separator of the capacity file, | by default")
    parser.add_argument("--trailing", action="store_true", help="every row of a wide file ends with a separator")
    parser.add_argument("--variant", choices=("full", "demo"), default="full")
    parser.add_argument("--prefix", default="", help="put before the four database names")
    parser.add_argument("--rows", type=int, default=50, help="rows of each report to print")
    args = parser.parse_args()

    run = Refresh(Lake(build_session(), args.prefix), args.variant)
    if args.separator:
        run.capacity = run.capacity.with_options(separator=args.separator)
    wide = None if args.long else {"trailing_separator": args.trailing}
    checked = run.run(Inputs(args.panel, args.outbreak, args.capacity, wide))
    for name, rows in (lake_reports(run) | {"reconciliation": checked}).items():
        print(name)
        rows.show(args.rows, truncate=False)


if __name__ == "__main__":
    main()

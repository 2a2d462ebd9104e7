"""Command line: load one month of trips, or the zone list.

python -m tripmill.plans.cli --month 2025-01 --landing DIR --warehouse DIR
python -m tripmill.plans.cli --zones --landing DIR --warehouse DIR
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from tripmill.contracts import ZONE_FILE_NAME, trip_file_name
from tripmill.plans.warehouse import Warehouse
from tripmill.session import build_session
from tripmill.streaming.arrivals import ingest_month, ingest_zones


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Load landed files into the warehouse")
    what = parser.add_mutually_exclusive_group(required=True)
    what.add_argument("--month", help="month to load, as YYYY-MM")
    what.add_argument("--zones", action="store_true", help="load the zone list")
    parser.add_argument("--landing", required=True, help="folder the files arrive in")
    parser.add_argument("--warehouse", required=True, help="root folder of the tables")
    parser.add_argument("--prefix", default="", help="prefix of the database names")
    chosen = parser.parse_args(arguments)

    file_name = ZONE_FILE_NAME if chosen.zones else trip_file_name(chosen.month)
    warehouse = Warehouse(build_session("load"), chosen.warehouse, chosen.prefix)
    warehouse.create()
    if chosen.zones:
        rows = ingest_zones(warehouse, chosen.landing)
    else:
        rows = ingest_month(warehouse, chosen.landing, chosen.month)
    print(f"{file_name}: {rows} rows")


if __name__ == "__main__":
    main()

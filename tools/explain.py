"""Print the formatted physical plans of the headline queries.

    python tools/explain.py [sf_dir]

Shows what the README claims: pushed filters and pruned read schemas on the
inventory scan, partial aggregates before each shuffle, bounded broadcasts,
and the single-scan report merge.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from scanlake import fixtures as fx  # noqa: E402
from scanlake.operators import domains as dom  # noqa: E402
from scanlake.operators import reports as rp  # noqa: E402
from scanlake.operators import select as sel  # noqa: E402
from scanlake.operators import views as vw  # noqa: E402
from scanlake.session import build_session, new_path  # noqa: E402
from scanlake.sources import reports as srp  # noqa: E402
from scanlake.sources.scanners import parse_lines, read_scan_lines  # noqa: E402
from scanlake.store import Inventory, ingest  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    inv = Inventory(spark, new_path(spark, "explain_inventory"))
    inv.append(ingest(spark, fx.big_capture(spark, sf), "masscan"))
    store = inv.read()
    reports = fx.report_set(spark, sf)
    shown = {
        "parse (S1+S6)": parse_lines(read_scan_lines(spark, fx.big_capture(spark, sf)), "masscan"),
        "host listing (A1+P2)": vw.host_listing(store).orderBy(F.col("ip_num").asc_nulls_last()),
        "port listing (A2+P3)": vw.port_listing(store),
        "cidr, few selectors (F3)": sel.select_hosts(spark, store, "10.1.0.0/16,10.42.3.7"),
        "latest domains (A3)": dom.latest_domains(store),
        "merge xml (R2)": rp.merge_xml(spark, rp.reports_by_host(spark, srp.report_catalog(spark, reports), "all"),
                                       None, [reports]),
    }
    for title, df in shown.items():
        print(f"\n======== {title}")
        df.explain("formatted")


if __name__ == "__main__":
    main()

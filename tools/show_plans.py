"""Print the formatted physical plan of registered queries and a one-line summary of each.

Usage: python tools/show_plans.py [sf_dir] [query ...]
Summary: exchanges (shuffles), join strategies, aggregate kinds, scans with pushed filters.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)] or ["fct_reservations", "agg_property_performance",
                                                          "dim_guests", "warehouse_checks"]
    from innflow.plans.catalog import QUERIES
    from innflow.session import local_session

    spark = local_session(8)
    for name in names:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[name](spark, sf_dir).explain("formatted")
        plan = buf.getvalue()
        tree = plan.split("\n\n")[0]
        count = lambda pat: len(re.findall(pat, tree))
        print(f"== {name}: exchanges={count(r'Exchange [(]')} broadcast_exchanges={count(r'BroadcastExchange')} "
              f"smj={count(r'SortMergeJoin')} bhj={count(r'BroadcastHashJoin')} "
              f"hash_agg={count(r'HashAggregate')} sort_agg={count(r'SortAggregate')} "
              f"scans={count(r'Scan parquet')} pushed_filters={plan.count('PushedFilters: [I')}")
        if os.environ.get("FULL"):
            print(plan)


if __name__ == "__main__":
    main()

"""Write PLANS.md: formatted physical plans of the headline operators.

Usage: python tests/plan_report.py [sf_dir]   (default /root/testdata/sf0.01)
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEADLINE = [
    ("sn4_silver_trips", "Silver transform: one narrow stage, rules pushed to the scan"),
    ("mt1_daily_trip_revenue", "Aggregate the fact by date key, then join the small dimension"),
    ("mt5_airport_trip_summary", "Two-role zone join on a size-checked broadcast, partial aggregation"),
    ("aq4_top_pickup_zones", "Top-k per month: the window sees aggregated rows only"),
    ("pf_profile_one_pass", "PF1-PF4 in one scan and one grouped aggregate"),
    ("qt_core_assertions", "Assertions: at most three passes per table"),
]


def _condense(text: str) -> str:
    """The operator tree, then for each scan its pushed filters and schema."""
    tree, _, details = text.partition("\n\n\n")
    keep, in_scan = [], False
    for line in details.splitlines():
        if line.startswith("("):
            in_scan = "Scan" in line
            if in_scan:
                keep.append(line)
        elif in_scan and line.split(":")[0] in ("PushedFilters", "PartitionFilters",
                                                "ReadSchema", "Location"):
            keep.append("  " + line)
    return (tree.strip() + "\n\n" + "\n".join(keep)).strip()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as E
    from fareflow.session import local_session
    spark = local_session(8, 8)
    out = ["# Physical plans of the headline operators", "",
           f"Generated by `python tests/plan_report.py` at `{sf}` (`local[8]`, AQE on; "
           "plans shown before execution).", ""]
    for name, why in HEADLINE:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            E.queries()[name](spark, sf).explain("formatted")
        out += [f"## {name}", "", why + ".", "", "```", _condense(buf.getvalue()), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()

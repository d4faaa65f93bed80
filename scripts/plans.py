"""Write PLANS.md: the physical plan (explain "formatted", operator tree and
scan details) of the headline queries at a given scale."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NAMES = ["advice_by_pivot", "pivot_filter", "kpis", "describe_readings", "corr_lineitem",
         "hist_volume", "box_sensors", "latest_n", "series_long", "yield_trend"]


def tree_and_scans(text: str) -> str:
    """Operator tree, plus the scan details (columns read, pushed filters) and
    the partitioning of every exchange."""
    tree, rest = text.split("\n\n", 1) if "\n\n" in text else (text, "")
    details = []
    for block in rest.split("\n\n"):
        block = block.strip()
        head = block.split("\n", 1)[0]
        if "Scan parquet" in head:
            keep = [head] + [ln for ln in block.split("\n")[1:]
                             if re.match(r"^(ReadSchema|PushedFilters|DataFilters)", ln)]
            details.append("\n".join(keep))
        elif "Exchange" in head:
            keep = [head] + [ln for ln in block.split("\n")[1:] if ln.startswith("Arguments")]
            details.append("\n".join(keep))
    return tree.strip() + ("\n\n" + "\n\n".join(details) if details else "")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from campo.plans.queries import QUERIES
    from campo.session import build_session
    spark = build_session("campo-plans", master="local[8]", shuffle_partitions=16)
    out = ["# Physical plans of the headline queries", "",
           f"`explain(\"formatted\")` at `{sf_dir}`, local[8], 16 shuffle partitions, AQE on "
           "(initial plans; AQE may coalesce partitions or switch joins at run time). "
           "Generated by `scripts/plans.py`.", ""]
    for name in NAMES:
        df = QUERIES[name](spark, sf_dir)
        text = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        out += [f"## {name}", "", "```", tree_and_scans(text), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()

"""Write the physical plan trees of key queries to docs/PLANS.md (sf0.001 inputs).

    python tools/dump_plans.py
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

NOTES = {
    "hour_rollup": "Flagship. One parquet scan with pruned columns; the enrichment is one codegen'd projection "
                   "(no Python). Region tags are worked out on distinct points, against broadcast polygon edges, and "
                   "joined back on the coordinates; AQE picks the join. Partial HashAggregate before the exchange on "
                   "start_hour, so a hot hour is pre-aggregated per task.",
    "trip_enrich": "The geodesic kernel (the one ArrowEvalPython) runs above the aggregation to distinct coordinate "
                   "pairs, never per trip.",
    "region_tag": "Distinct points are tagged by an equi-join on latitude band with the exploded polygon edges; "
                  "crossings are summed per (point, region). No CartesianProduct or NestedLoopJoin.",
    "partition_stats": "All 9 columns x 5 statistics in one partial + final aggregation keyed by ptd, then "
                       "an explode to long form.",
    "partition_quartiles": "Last step only: the sorted (value, count) table and its block table are stored by then. The "
                           "values meet the few wanted blocks by (group, task), never by their group alone.",
    "dbscan_sweep": "Last step only: cells, degrees, thresholds and components of cells are stored by then.",
    "station_share": "Per-side counts are pre-aggregated before the union; the total arrives through a scalar "
                     "subquery (no cross join).",
    "corr_matrix": "One aggregation with one function per pair: no expansion of rows, one row per task to the end.",
}


def main() -> None:
    from tripflow.plans.catalog import plan_text
    from tripflow.queries import QUERIES
    from tripflow.session import build_local_session

    spark = build_local_session(4, shuffle_partitions=8)
    out = ["# Physical plans of key queries", "",
           "Generated by `tools/dump_plans.py` on sf0.001 (`explain('formatted')`, tree part only).", ""]
    for key, note in NOTES.items():
        text = plan_text(QUERIES[key](spark, "/root/testdata/sf0.001"), "formatted")
        tree = text.split("\n\n")[0]
        out += [f"## {key}", "", note, "", "```", tree.strip(), "```", ""]
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()

"""Print the physical plans (explain "formatted") of the main queries.

usage: python scripts/explain_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans import catalog as C  # noqa: E402
from tessera.session import local_session  # noqa: E402

SHOW = [
    ("label_filter", "labels and the filter are Catalyst expressions; only two columns are read"),
    ("pipeline_records_kernel", "the whole chain: scan -> one Arrow stage -> explode; no Exchange"),
    ("batch_assign_scaled", "bucketed global rank: counts per (split, bucket), offsets joined as Spark picks by size"),
    ("metadata_summary", "one grouping-sets aggregate with map-side partial aggregation"),
    ("dataset_statistics_kernel", "per-image partial sums in NumPy, then a tiny aggregate"),
]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    print("# Physical plans\n")
    print(f"Generated by `scripts/explain_plans.py` on `{os.path.basename(sf)}` (local[8], AQE on).\n")
    for key, note in SHOW:
        df = C.QUERIES[key](spark, sf)
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        head, _, rest = plan.partition("\n\n(1)")
        scan = ("(1)" + rest).split("\n\n")[0]
        print(f"## `{key}`\n\n{note}.\n\n```\n{head.strip()}\n\n{scan.strip()}\n```\n")


if __name__ == "__main__":
    main()

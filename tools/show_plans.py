"""Print formatted physical plans of the key operators (for PLANS.md).

Usage: python tools/show_plans.py [sf_dir] [broadcast_cap]
``broadcast_cap`` below the member / item row counts shows the plan those tables get at cluster scale.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from goldleaf.operators import marts, quality  # noqa: E402
from goldleaf.operators.denorm import denormalize  # noqa: E402
from goldleaf.operators.star import build_star  # noqa: E402
from goldleaf.operators.upsert import merge_rows  # noqa: E402
from goldleaf.session import build_session  # noqa: E402
from goldleaf.sources.lake import materialize  # noqa: E402
from goldleaf.sources.retail_views import read_test_table, retail_source_views  # noqa: E402


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    cap = int(argv[2]) if len(argv) > 2 else 500
    spark = build_session("plans", "local[8]", {"spark.sql.shuffle.partitions": "8"})
    v = retail_source_views(spark, sf)
    silver = denormalize(v, max_broadcast_rows=cap)
    print(f"### silver (broadcast cap {cap} rows)")
    silver.explain("formatted")
    written = materialize(silver, "plans-silver")
    star = build_star(written)
    print("### referential integrity (all six keys, one aggregate + one join)")
    quality.referential_integrity_checks(star["fact_order"], star).explain("formatted")
    print("### monthly revenue, line grain")
    marts.monthly_revenue(star["fact_order"], star["dim_date"], "line").explain("formatted")
    orders = read_test_table(spark, sf, "orders")
    print("### keyed upsert, increment keys broadcast")
    merge_rows(orders, orders.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")),
               ["o_orderkey"], True).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)

"""Write PLANS.md: the final (post-AQE) physical plans of key queries.

    python scripts/plans.py [sf_dir]

Each query runs once (noop sink is not used: the plan is read from the
executed DataFrame so AQE's runtime decisions are visible).
"""

from __future__ import annotations

import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from gridlake.plans.registry import all_queries  # noqa: E402
from gridlake.session import build_session  # noqa: E402

KEY_QUERIES = {
    "gold_daily": "Top-1 per key is a partial WindowGroupLimit before the only exchange on (region, delivery_ts); the daily aggregate is partial + final hash aggregation; the scan reads 3 columns.",
    "bronze_merge": "Three loads folded with the revision-aware merge: each merge is one ranking (one exchange) over stored + incoming rows.",
    "changed_prices": "Range partitioning on (key, version) splits a hot key across tasks; the partition-boundary table is broadcast (one row per partition).",
    "pulse_windows": "The per-region newest hour is broadcast (runtime size); each row is exploded into its windows once, then one aggregation.",
    "serving_hourly": "Upsert = anti-join on the key + union; both sides hold one row per key.",
    "dead_letters": "Each message is parsed once (Generate barrier), the reject filter is code-generated.",
    "news_merge": "Feeds are parsed once per query (the headline shuffle is reused by both runs); one Python UDF node.",
    "sample_document": "Top-168 per region is a partial WindowGroupLimit; the collected arrays are bounded by 168.",
    "bi_worst_days": "Top-3 is TakeOrderedAndProject (per-partition top-k, then a final merge).",
}


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    spark = build_session("gridlake-plans", master="local[8]", shuffle_partitions=8)
    queries = all_queries()
    out = [
        "# Physical plans",
        "",
        f"Final plans after adaptive execution, `{sf_dir}`, `local[8]`, generated by `scripts/plans.py`.",
        "",
    ]
    for name, note in KEY_QUERIES.items():
        df = queries[name].fn(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        out += [f"## {name}", "", note, "", "```", plan.rstrip(), "```", ""]
    (ROOT / "PLANS.md").write_text("\n".join(out), encoding="utf-8")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])

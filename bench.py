"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  folder of the test tables (default sf0.1)
BENCH_CPUS    local threads (default 8)

The derived transactions and rules are written once before timing, as they would be
stored tables. Each query runs twice, writing to the noop sink; the faster run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledger_spark.plans.registry import queries  # noqa: E402
from ledger_spark.session import build_session  # noqa: E402
from ledger_spark.sources import fixtures  # noqa: E402

HEADLINE = (
    "cleanse_transactions",
    "apply_rules",
    "match_rules",
    "backfill_rule_scores",
    "transaction_intervals",
    "recurring_candidates",
    "harmonize_recurring",
    "merchant_batch",
    "pattern_batch",
    "parse_decisions",
    "apply_merchant_decisions",
    "learn_all_rules",
    "rule_conflicts",
    "dq_inconsistent_recurring",
    "apply_fallback",
    "full_categorization",
)
RUNS = 2


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "ledger-spark-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # The test files are tiny: small row groups and splits let all threads take part.
            "spark.hadoop.parquet.block.size": "1048576",
            "spark.sql.files.maxPartitionBytes": "1m",
            "spark.sql.files.openCostInBytes": "0",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    for derive in (fixtures.transactions, fixtures.transactions_unlabelled, fixtures.rules):
        derive(spark, folder)

    registered = queries()
    seconds = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(RUNS):
            start = time.perf_counter()
            registered[name](spark, folder).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.registry import QUERIES  # noqa: E402
from statuslight.session import build_session  # noqa: E402

HEADLINE = [
    "engagements", "month_spine", "slack_bundle", "docs_bundle", "meetings_bundle", "comments_bundle", "tasks_bundle",
    "tasks_bundle_in_parts", "task_epics", "financial_grains", "financial_grains_corrected", "running_financials_global",
    "financial_bundle", "assemble_prompt", "parse_status_response", "status_report", "chunk_documents", "parse_chunks",
    "html_to_chunks", "embed_chunks", "vector_topk", "vector_topk_by_deal", "vector_topk_ivf", "rag_context",
    "engagement_details_from_documents", "replicate_table",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", "bench",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for key in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[key] = round(time.perf_counter() - start, 3)
        print(f"{key} {seconds[key]}", file=sys.stderr, flush=True)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(sf.group(1)) if sf else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm the JVM and once timed, written to the no-op sink
so that every column is computed.
"""

from __future__ import annotations

import json
import os
import time

from tuneweave.plans import registry
from tuneweave.session import build_session

HEADLINE = [
    "filter_language",
    "token_count",
    "cutoff_tokens",
    "sample_n",
    "split_exact",
    "render_qwen",
    "prepared_instructions",
    "prepared_chat",
    "preprocess_summary",
    "load_jsonl_strict",
    "pack_membership",
    "pack_blocks",
    "step_plan",
    "detect_language",
    "unigram_scores",
    "perplexity",
    "eval_prompts",
    "read_log_records",
    "log_tail_chars",
    "metric_scalars",
    "metric_latest",
    "training_summary",
    "next_run_index",
    "latest_checkpoint",
    "resolve_resume",
    "attempt_rollup",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    found = registry.queries()
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            found[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, warm",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_QUERIES (comma-separated names, or ``all``) choose what is run."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sluice.catalogue import load  # noqa: E402
from sluice.session import local_session  # noqa: E402

HEADLINE = (
    "typed_dedup_counts", "num_shape", "dt_shape", "scan_normalise", "style_detect", "merge_duplicate_columns",
    "batch_plan", "uid_repair", "uid_confirm", "value_map", "label_rule", "label_fill", "numeric_validate",
    "categorical_validate", "coalesce_priority", "lookup_earliest", "dedup_visit", "dedup_patient",
    "merge_column_groups", "pii_redact_text", "pii_gate", "scrub_terms", "nearest_match", "nearest_times",
    "running_numbers", "primary_form", "episode_births", "episode_babies", "episode_link", "skip_conditions",
    "reason_codes", "reason_summary", "reason_long", "flatten_scripts", "dictionary_build", "option_order",
    "consensus_fields",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), name="sluice-bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load()
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(queries) if chosen == "all" else [n for n in chosen.split(",") if n] or list(HEADLINE)
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    print(json.dumps({"metric": "headline queries, wall seconds in total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from blockloom import build_session
from blockloom.queries import QUERIES

#: The stages of both corpus paths, and what is reported about them.
HEADLINE = (
    "scan_lines build_vocab encode decode_tokens pack_blocks pack_scope mask_labels truncate_head_tail downsample "
    "mix_sources split_fraction shuffle_rows stats_totals pad_batch token_accuracy chat_prompts text_offsets "
    "low_rank_update pretraining_mix"
).split()
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        runs = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        # The first run warms the JVM up.
        seconds[name] = round(statistics.median(runs[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of median warm runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()

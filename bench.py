"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run twice and its whole result is computed each time; the second run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tideline.plans import catalogue  # noqa: E402
from tideline.session import build_session, discard  # noqa: E402

HEADLINES = [
    "hourly_tips", "hourly_tips_max", "hourly_tips_all_cumulative", "word_count", "rolling_maxby",
    "rolling_sum", "rolling_reduce", "tbl_group_agg", "tbl_group_lineitem", "win_tumble_count",
    "win_reduce_min", "win_session", "win_count_sliding", "tbl_over_rows", "sql_over_rows",
    "win_process_meta", "watermark_replay", "allowed_lateness_firings", "late_side_output",
    "retract_changelog", "state_key_count", "state_temp_jump", "rise_alert",
    "broadcast_pattern_ref", "broadcast_pattern_strict", "control_filter_keyed", "dedup_ttl",
    "dedup_forever", "parse_sensor", "flatmap_split", "udf_hashcode", "connect_comap",
    "lateral_split", "sql_udaf_avg", "stream_hourly_tips_max", "stream_temp_jump",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        app="bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.python.unix.domain.socket.enabled": "true",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINES
    seconds = {}
    for name in wanted:
        for _ in range(2):
            start = time.perf_counter()
            catalogue.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
            discard(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

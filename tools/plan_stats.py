"""Physical-plan shape per registered key: exchanges, scans, joins, pushed filters.

    python tools/plan_stats.py [sf_dir] [key-substring ...]

Reads ``explain("formatted")`` of each key's DataFrame (nothing executed
beyond what building the DataFrame needs) and prints one line per key.
Counts are of AQE's initial plan.  An exchange listed for two branches runs
twice unless both are identical, and few are.
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SKIP = ("stg_events_incremental", "stg_events_stream", "dim_users_stream")


def shape(df) -> dict:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head = text.split("\n\n(1)")[0]
    return {
        "shuffles": len(re.findall(r"(?<![A-Za-z])Exchange \(\d+\)", head)),
        "broadcasts": len(re.findall(r"BroadcastExchange \(\d+\)", head)),
        "scans": len(re.findall(r"Scan parquet", head)),
        "smj": head.count("SortMergeJoin"),
        "bhj": head.count("BroadcastHashJoin"),
        "windows": len(re.findall(r"(?<![A-Za-z])Window \(\d+\)", head)),
        "sort_aggs": len(re.findall(r"SortAggregate \(\d+\)", head)),
        "hash_aggs": len(re.findall(r"HashAggregate \(\d+\)", head)),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    filters = [a for a in argv[1:] if not a.startswith("/")]
    from tidemark.plans.registry import queries
    from tidemark.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8)
    for key, fn in sorted(queries().items()):
        if key.removesuffix("_o") in SKIP or (filters and not any(f in key for f in filters)):
            continue
        s = shape(fn(spark, sf_dir))
        print(f"{key:28s} " + " ".join(f"{k}={v}" for k, v in s.items()))


if __name__ == "__main__":
    main(sys.argv)

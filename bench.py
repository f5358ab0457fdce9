"""Time the headline queries; prints one JSON line."""
import json
import os
import statistics
import sys
import time

from oppflow.catalog import QUERIES
from oppflow.session import local_session

HEADLINE = [
    "keywords_by_state", "d5_tag_records", "e4_key_terms", "b19_canonical_record", "c2_first_wins_in_batch", "c3_drop_seen",
    "e6_vocabulary", "e8_top_terms", "e9_top_terms_by_state", "e14_top_phrases", "e15_gap_terms",
    "f1_overview", "f2_state_breakdown", "f4_top_recipients", "g1_cumulative_counts",
    "h6_members_by_pattern", "i7_fold_preferences", "b4_nih_reporter", "b10_table_rows", "b13_strategy_per_page",
    "b11_links_on_pages", "j1_search",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores)
    # the first query of a session also pays for class loading
    QUERIES[names[0]](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        taken = []
        for _ in range(repeat):
            began = time.time()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.time() - began)
        seconds[name] = round(statistics.median(taken), 3)
    print(json.dumps({
        "metric": "total seconds of headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

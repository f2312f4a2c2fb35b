"""Print the physical plans of the core queries (static and, after running,
AQE's final plan), condensed to operator lines plus scan details.

Usage: python tools/plans.py [sf_dir] > docs/PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

CORE = [
    ("join_price_sentiment_hourly", "pipeline: scan → score → two windowed aggregates → join on (ticker, window)"),
    ("score_lexicon", "map-form scoring: one projection, no Python"),
    ("score_lexicon_join", "join-form scoring: counted lexicon broadcast, per-text sum"),
    ("dash_latest50", "global newest 50"),
    ("dash_latest50_per_ticker", "newest 50 per ticker"),
    ("an_direction_agreement", "calendar neighbours in one pass (explode + groupBy)"),
    ("an_watchlist_compare", "watchlist filter pushed to the scan"),
]


def condense(plan: str) -> str:
    keep = []
    for line in plan.splitlines():
        s = line.rstrip()
        if not s:
            continue
        s = re.sub(r"#\d+L?", "", s)
        s = re.sub(r"\[plan_id=\d+\]", "", s)
        if "FileScan" in s:
            head = s[: s.index("FileScan")] + s[s.index("FileScan"):].split(" Batched")[0]
            pushed = re.search(r"PushedFilters: \[[^\]]*\]", s)
            schema = re.search(r"ReadSchema: \S+", s)
            keep.append(head)
            pad = " " * (len(head) - len(head.lstrip()) + 4)
            for m in (pushed, schema):
                if m:
                    keep.append(pad + m.group(0))
            continue
        if len(s) > 160:
            s = s[:157] + "..."
        keep.append(s)
    return "\n".join(keep)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from moodtick.plans import catalog
    from moodtick.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plans of the core queries\n")
    print(f"Generated by `python tools/plans.py {sf_dir}` (local[8], 8 shuffle partitions, AQE on, static")
    print("broadcast off). Expression ids and plan ids are stripped; long lines are cut.\n")
    for name, what in CORE:
        df = catalog.QUERIES[name](spark, sf_dir)
        static = df._jdf.queryExecution().executedPlan().toString()
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString()
        final = final.split("+- == Initial Plan ==")[0]
        print(f"## {name}\n\n{what}\n")
        print("Static plan:\n\n```\n" + condense(static) + "\n```\n")
        print("Final plan (after AQE):\n\n```\n" + condense(final) + "\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()

"""Print the physical plan of registered views (formatted), or a digest of the lines
that matter for scale: scans (ReadSchema, PushedFilters, PartitionFilters), exchanges,
join strategies, aggregates and codegen stages.

usage: python scripts/explain_plans.py [sf_dir] [--full] name ...
"""
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mixlens.plans.catalog import QUERIES  # noqa: E402
from mixlens.session import get_session  # noqa: E402

KEEP = re.compile(r"(Scan parquet|ReadSchema|PushedFilters|PartitionFilters|Exchange|HashJoin|SortMergeJoin|"
                  r"BroadcastExchange|HashAggregate|Window|Expand|WholeStageCodegen|TakeOrdered|Generate|"
                  r"MapInPandas|InMemory|AQEShuffleRead)")


def main():
    args = [a for a in sys.argv[1:] if a != "--full"]
    full = "--full" in sys.argv
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = get_session("local[8]", 8)
    for name in names:
        df = QUERIES[name](spark, sf)
        df.collect()      # final adaptive plan
        plan = df._jdf.queryExecution().executedPlan().toString() if not full else None
        print(f"==== {name}")
        if full:
            df.explain("formatted")
        else:
            for line in plan.splitlines():
                if KEEP.search(line):
                    print(line[:220])


if __name__ == "__main__":
    main()

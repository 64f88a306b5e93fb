"""Physical-plan summary of every registered query (PLANS.md).

Run: ``python -m tests.plan_summary /root/testdata/sf0.01 > PLANS.md``.
Counts come from the static physical plans (AQE off, exchange reuse on);
reused exchanges are not counted again.
"""

from __future__ import annotations

import re
import sys

OPERATORS = [
    ("shuffle", r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)"),
    ("broadcast", r"BroadcastExchange"),
    ("SMJ", r"SortMergeJoin"),
    ("BHJ", r"BroadcastHashJoin"),
    ("hash agg", r"HashAggregate"),
    ("sort agg", r"SortAggregate"),
    ("group limit", r"WindowGroupLimit"),
    ("window", r"\bWindow\b"),
    ("python", r"ArrowEvalPython|BatchEvalPython"),
    ("cartesian/NLJ", r"CartesianProduct|NestedLoopJoin"),
]
STREAMING = {"stream_dedup", "stream_seen_table", "stream_bloom_seen_table", "stream_file_arrivals", "stream_keyed_state"}


def summarise(plan: str) -> list[int]:
    lines = [line for line in plan.splitlines() if "ReusedExchange" not in line]
    text = "\n".join(lines)
    return [len(re.findall(p, text)) for _, p in OPERATORS]


def main(argv: list[str]) -> None:
    sys.path.insert(0, ".")
    from twinsift.registry import oracle_sql, queries
    from twinsift.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    qs, sql = queries(), oracle_sql()
    print("# PLANS — physical operators per registered query\n")
    print(f"Static physical plans at `{sf_dir}` (AQE off so the plan is fixed; exchange reuse on, reused")
    print("exchanges not counted). At run time AQE may turn a sort-merge join into a broadcast join from")
    print("measured sizes, coalesce partitions and split skewed ones. Streaming queries are")
    print("planned per micro-batch and are not listed. `oracle`: sql = DuckDB oracle, rows = rows-only.")
    print("`sort agg` appears where a group keeps a string minimum or maximum (first/last member) or builds")
    print("a Bloom bitmap: Spark's hash aggregate cannot hold such buffers. It still aggregates partially before the")
    print("shuffle. `group limit` counts the partial and final WindowGroupLimit of keep-one plans.\n")
    print("| query | oracle | " + " | ".join(name for name, _ in OPERATORS) + " |")
    print("| --- | --- | " + " | ".join("---" for _ in OPERATORS) + " |")
    for name in sorted(qs):
        if name in STREAMING:
            continue
        df = qs[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = summarise(plan)
        print(f"| {name} | {'sql' if name in sql else 'rows'} | " + " | ".join(str(c) for c in counts) + " |")


if __name__ == "__main__":
    main(sys.argv[1:])

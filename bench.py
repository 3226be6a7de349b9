"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores.
Every query runs to a sink that discards rows, once to warm up and ``RUNS`` times
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from parity import direct as D  # noqa: E402
from parity import standins as S  # noqa: E402
from parity.queries import LINE_TAGS, QUERIES, quantities  # noqa: E402
from worklens.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3

HEADLINE = [
    "issue_daily",
    "classification_extract",
    "stage_history",
    "time_per_object",
    "task_rollup",
    "latest_version",
    "distinct_by_tag",
    "share_of_total",
]

PLAIN = {
    "issue_daily": lambda s, d: D.issue_daily(S.issues(s, d), S.ISSUE_PAIRS, S.FIRST_YEAR_LINES, S.TAGS),
    "stage_history": lambda s, d: D.stage_history(
        S.stage_logs(s, d), S.EVENT_PAIRS, S.FIRST_YEAR_EVENTS, S.LABELS
    ),
    "time_per_object": lambda s, d: D.time_per_object(
        S.time_stats(s, d), S.TIME_PAIRS, S.CLASSES, S.TYPES
    ),
    "task_rollup": lambda s, d: D.task_rollup(S.task_sessions(s, d), S.TIME_PAIRS),
    "classification_extract": lambda s, d: D.classification_extract(
        S.classifications(s, d), S.ANSWER_PAIRS
    ),
    "latest_version": lambda s, d: D.latest_version(S.table(s, d, "events")),
    "distinct_by_tag": lambda s, d: D.distinct_by_tag(S.table(s, d, "lineitem"), LINE_TAGS),
    "share_of_total": lambda s, d: D.share_of_total(quantities(s, d)),
}


def run(spark, query) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def best(spark, query) -> float:
    return round(min(run(spark, query) for _ in range(RUNS)), 3)


def main() -> None:
    spark = local_session(
        CPUS, "bench", spark__sql__shuffle__partitions=CPUS, spark__driver__memory="8g"
    )
    for query in [*(QUERIES[name] for name in HEADLINE), *PLAIN.values()]:
        run(spark, query)  # warm up
    queries = {name: best(spark, QUERIES[name]) for name in HEADLINE}
    plain = {name: best(spark, query) for name, query in PLAIN.items()}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of best runs",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "plain_shapes": plain,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

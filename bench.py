"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sessionlake import fixtures, schemas  # noqa: E402
from sessionlake.operators.facts import conform_fact  # noqa: E402
from sessionlake.operators.quality import audit_batch  # noqa: E402
from sessionlake.operators.sessions import assemble_sessions, valid_sessions  # noqa: E402
from sessionlake.plans.queries import CATALOGUE  # noqa: E402
from sessionlake.session import build_session, new_folder  # noqa: E402
from sessionlake.streaming import ingest  # noqa: E402

# Queries over the test tables, from the catalogue.
HEADLINES = (
    "assemble_sessions_bulk",
    "assemble_sessions_string_max",
    "time_dim_holidays",
    "merge_time_dim",
    "star_view",
    "star_view_bulk",
    "session_numbers",
    "audit_by_bucket",
    "files_added",
    "new_commits",
    "as_of",
    "duplicate_keys",
    "surrogate_ids",
    "delimited_load",
    "encode_decode_events",
    "read_at_commit",
    "publish",
    "publish_in_two",
    "stream_ingest",
    "fact_load_idempotent",
    "load_in_two",
    "load_from_partials",
    "session_numbers_in_two",
    "changes_between",
    "document_schema",
    "stream_to_star",
)

# Operators over the bulk events as they lie in the lake, staged once beforehand.
LAKE_WIDTH = 10_000
FROM_LAKE = {
    "lake_assemble_sessions": lambda lake: assemble_sessions(lake),
    "lake_assemble_sessions_string": lambda lake: assemble_sessions(lake, "string"),
    "lake_facts": lambda lake: conform_fact(valid_sessions(assemble_sessions(lake))),
    "lake_audit": lambda lake: audit_batch(lake, by=[schemas.BUCKET_COLUMN]),
}
REPEATS = int(os.environ.get("BENCH_REPEATS", "1"))


def _best(build) -> float:
    """Best of some runs, after an unmeasured one that pays for loading and compiling."""
    times = []
    for _ in range(REPEATS + 1):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(min(times[1:]), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or [*HEADLINES, *FROM_LAKE]
    seconds = {}
    for name in chosen:
        if name in CATALOGUE:
            seconds[name] = _best(lambda name=name: CATALOGUE[name](spark, sf_dir))
    if any(name in FROM_LAKE for name in chosen):
        root = new_folder(spark, "bench-lake")
        ingest.batch_writer(root, LAKE_WIDTH)(fixtures.m2_events(spark, sf_dir), 0)
        for name in chosen:
            if name in FROM_LAKE:
                seconds[name] = _best(
                    lambda name=name: FROM_LAKE[name](ingest.staged_events(spark, root))
                )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds, best of repeated warm runs per query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

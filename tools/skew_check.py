"""Measure how work spreads over tasks when one user and one item are hot.

    python tools/skew_check.py [sf_dir] [event_log_dir] > SKEW.md

Derives ratings from the nation mapping in which one user and one item
each hold about a third of all rows (chosen by a hash of the row, so the
input is deterministic), runs the headline plans, and reads Spark's event
log (written to `event_log_dir`, a scratch folder) for the shuffle-read
records of every task. A stage whose largest task reads a large share of
the rows would mean a hot key went to one task.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import statistics
import sys
import tempfile
from pathlib import Path

import zstandard

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from tastes.operators import favourites  # noqa: E402
from tastes.params import TasteParams  # noqa: E402
from tastes.plans import contrarian_tastes, materialize  # noqa: E402
from tastes.schemas import CUSTOMER_ID, MOVIE_ID  # noqa: E402
from tastes.session import local_session  # noqa: E402
from tastes.sources.tables import nation_ratings, nation_titles  # noqa: E402

HOT_USER = -1
HOT_ITEM = 0


def skewed(ratings):
    bucket = F.abs(F.xxhash64(*ratings.columns)) % 3
    return ratings.select(
        F.when(bucket == 1, F.lit(HOT_ITEM)).otherwise(F.col(MOVIE_ID)).alias(MOVIE_ID),
        F.when(bucket == 2, F.lit(HOT_USER).cast("bigint"))
        .otherwise(F.col(CUSTOMER_ID))
        .alias(CUSTOMER_ID),
        "rating",
        "ratingDate",
    )


def read_events(log_dir: str):
    events = []
    for f in sorted(glob.glob(log_dir + "/**/*", recursive=True)):
        if os.path.isdir(f) or "appstatus" in f:
            continue
        raw = Path(f).read_bytes()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        events += [json.loads(line) for line in raw.decode().splitlines()]
    return events


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if len(argv) > 0 else "/root/testdata/sf0.1"
    log_dir = argv[1] if len(argv) > 1 else tempfile.mkdtemp(prefix="tastes-events-")
    # Coalescing is off so that every stage keeps its 8 hash partitions and
    # the spread of rows over them is visible (AQE would merge small ones).
    spark = local_session(
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        }
    )
    ratings = materialize(spark, skewed(nation_ratings(spark, sf_dir)), "skewed")
    titles = nation_titles(spark, sf_dir)
    total = ratings.count()
    hot_user = ratings.where(F.col(CUSTOMER_ID) == HOT_USER).count()
    hot_item = ratings.where(F.col(MOVIE_ID) == HOT_ITEM).count()
    p = TasteParams(min_ratings=50, top_items=5, top_users=25)

    cases = {
        "whole question, rescan": lambda: contrarian_tastes(
            ratings, titles, p, share_ratings=False
        ),
        "whole question, shared": lambda: contrarian_tastes(ratings, titles, p, share_ratings=True),
        "favourites, all users": lambda: favourites(ratings, titles),
    }
    jobs = {}
    for name, make in cases.items():
        spark.sparkContext.setJobGroup(name, name)
        make().write.format("noop").mode("overwrite").save()
        jobs[name] = name
    spark.stop()

    group_of_job, stages_of_job = {}, {}
    reads = collections.defaultdict(list)
    for ev in read_events(log_dir):
        kind = ev["Event"]
        if kind == "SparkListenerJobStart":
            props = ev.get("Properties") or {}
            group_of_job[ev["Job ID"]] = props.get("spark.jobGroup.id")
            stages_of_job[ev["Job ID"]] = ev["Stage IDs"]
        elif kind == "SparkListenerTaskEnd":
            m = ev.get("Task Metrics") or {}
            n = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            reads[ev["Stage ID"]].append(n)
    stage_group = {
        s: group_of_job[j] for j, ss in stages_of_job.items() for s in ss if group_of_job.get(j)
    }

    print("# Skew check\n")
    print(
        f"Input: {total:,} ratings derived from `{sf_dir}` (nation mapping); the hot "
        f"user holds {hot_user:,} rows ({hot_user / total:.0%}), the hot item "
        f"{hot_item:,} ({hot_item / total:.0%}). Produced by `tools/skew_check.py` on "
        "`local[*]` with 8 shuffle partitions and AQE's partition coalescing off (so "
        "the spread over partitions shows); shuffle records read per task come from "
        "Spark's event log. Single-task stages read the output of a limit or a "
        "global aggregate.\n"
    )
    print("| Plan | Stage | Tasks | Records read | Largest task | Median task | Largest / total |")
    print("| --- | --- | ---: | ---: | ---: | ---: | ---: |")
    for stage in sorted(reads):
        group = stage_group.get(stage)
        counts = reads[stage]
        if group not in jobs or sum(counts) == 0:
            continue
        read = sum(counts)
        print(
            f"| {group} | {stage} | {len(counts)} | {read:,} | {max(counts):,} | "
            f"{int(statistics.median(counts)):,} | {max(counts) / read:.0%} |"
        )


if __name__ == "__main__":
    main(sys.argv[1:])

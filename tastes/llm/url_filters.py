"""URL filters with dates: which list entries held when a page was fetched.

List entries are dated events: an `add` opens an entry, a `remove` closes
it. Events become validity intervals [from, to), and an as-of join finds, for
every capture, the intervals of its host and parent domains that hold on the
day of the fetch. The longest pattern decides, and of equal ones an `allow`
before a `block`, then the first list name.

Only DataFrame functions. Captures are reduced to different (host, day)
pairs before the join, so a host with a third of all captures is a few
hundred rows; intervals are dealt over `BUCKET_DAYS`-day buckets of time, so
the join is on equal (pattern, bucket) and a pattern with many intervals
meets only those of the bucket. Events of one pattern, list and day are
merged first (a `remove` wins), which bounds a pattern's history by its days.

Captures without a URL, a host or a fetch day match nothing and are allowed.
Events without a pattern, a day or a known action are ignored. Repeated rows
give repeated results. An empty list allows everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastes.llm.common import Scratch, free_name

BUCKET_DAYS = 32
HOST_PATTERN = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def host_of(url: Column) -> Column:
    """Lower-case host of a URL, null where there is none."""
    host = F.lower(F.regexp_extract(url, HOST_PATTERN, 1))
    return F.when(host != "", host)


def _day(date: Column) -> Column:
    return F.unix_date(date.cast("date"))


def validity(events: DataFrame) -> DataFrame:
    """Intervals (list_name, pattern, verdict, start, stop) in days; stop null: open.

    `events` has list_name, pattern, verdict (block or allow), action (add or
    remove) and effective (a date). An add while the entry is open changes
    nothing unless its verdict differs.
    """
    daily = (
        events.where("pattern is not null and effective is not null and action in ('add', 'remove')")
        .groupBy("list_name", "pattern", _day(F.col("effective")).alias("start"))
        .agg(
            F.max(F.col("action") == "remove").alias("closed"),
            F.min("verdict").alias("verdict"),
        )
        .withColumn("verdict", F.when(~F.col("closed"), F.col("verdict")))
    )
    history = Window.partitionBy("list_name", "pattern").orderBy("start")
    changed = daily.withColumn("before", F.lag("verdict").over(history)).where(
        ~F.col("verdict").eqNullSafe(F.col("before"))
    )
    return (
        changed.withColumn("stop", F.lead("start").over(history))
        .where("verdict is not null")
        .select("list_name", "pattern", "verdict", "start", "stop")
    )


def filter_urls(
    captures: DataFrame,
    events: DataFrame,
    fetched: str = "fetched",
    scratch: Scratch | None = None,
) -> DataFrame:
    """`captures` with host, verdict, list_name, pattern and listed (since when).

    `captures` has a `url` and the date column `fetched`. Columns of its own
    that are called like the five stay; the added ones then get underscores in
    front. Without captures the result is empty.
    """
    scratch = scratch or Scratch(captures.sparkSession, "urls")
    names = captures.columns
    host, day = free_name("host", names), free_name("_day", names)
    seen = captures.withColumns({host: host_of(F.col("url")), day: _day(F.col(fetched))})
    pairs = (
        seen.select(F.col(host).alias("host"), F.col(day).alias("day"))
        .where("host is not null and day is not null")
        .distinct()
    )
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    keys = pairs.withColumn("pattern", F.explode(suffixes)).withColumn(
        "bucket", F.floor(F.col("day") / BUCKET_DAYS)
    )
    last = pairs.select(F.max("day")).scalar()  # open intervals end with the captures
    spans = validity(events).where(F.col("start") <= last)
    bucket = F.sequence(
        F.floor(F.col("start") / BUCKET_DAYS),
        F.floor(F.least(F.coalesce(F.col("stop") - 1, last), last) / BUCKET_DAYS),
    )
    spans = spans.withColumn("bucket", F.explode(bucket))
    held = keys.join(spans, ["pattern", "bucket"]).where(
        (F.col("start") <= F.col("day"))
        & (F.col("stop").isNull() | (F.col("day") < F.col("stop")))
    )
    # The least of (-length, verdict, list): 'allow' sorts before 'block'.
    best = held.groupBy("host", "day").agg(
        F.min(
            F.struct(
                (-F.length("pattern")).alias("rank"), "verdict", "list_name", "pattern", "start"
            )
        ).alias("best")
    )
    # Reread, so that the join has a bare scan on either side and adaptive
    # execution can split a host and day that hold most captures.
    found = free_name("_best", [*names, host, day])
    best = scratch.save(best, "best").toDF(host, day, found)
    added = {
        "verdict": F.coalesce(F.col(found)["verdict"], F.lit("allow")),
        "list_name": F.col(found)["list_name"],
        "pattern": F.col(found)["pattern"],
        "listed": F.date_from_unix_date(F.col(found)["start"]),
    }
    return seen.join(best, [host, day], "left").select(
        *(F.col(f"`{n}`") for n in names),
        F.col(host),
        *(value.alias(free_name(name, names)) for name, value in added.items()),
    )

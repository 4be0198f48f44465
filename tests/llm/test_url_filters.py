from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F
from test_joins import final_plan

from tastes.llm.url_filters import filter_urls, validity

DAY0 = dt.date(2023, 12, 20)
EVENTS = "list_name string, pattern string, verdict string, action string, effective date"


def day(n):
    return None if n is None else DAY0 + dt.timedelta(days=n)


def brute(host, when, events):
    if host is None or when is None:
        return "allow", None, None
    found = []
    for name, pattern in {(e[0], e[1]) for e in events if e[1]}:
        if host != pattern and not host.endswith("." + pattern):
            continue
        state = None
        past = [e for e in events if e[:2] == (name, pattern) and e[4] and e[4] <= when and e[3] in ("add", "remove")]
        for d in sorted({e[4] for e in past}):
            today = [e for e in past if e[4] == d]
            state = None if any(e[3] == "remove" for e in today) else min(e[2] for e in today)
        if state:
            found.append((-len(pattern), state, name, pattern))
    return (min(found)[1], min(found)[2], min(found)[3]) if found else ("allow", None, None)


def test_equals_brute_force(spark):
    rng = random.Random(3)
    names = ["com", "a.com", "b.a.com", "c.b.a.com", "x.org", "org", "y.x.org"]
    events = [
        (rng.choice("LM"), rng.choice([*names, None]), rng.choice(["block", "allow"]),
         rng.choice(["add", "add", "remove", "odd"]), day(rng.choice([*range(200), None])))
        for _ in range(120)
    ]
    captures = [
        (i, rng.choice([None, "", "nothing", "ftp://" + rng.choice(names), f"HTTPS://u:p@{rng.choice(names).upper()}:80/p?q#f"]),
         day(rng.choice([*range(220), None])))
        for i in range(600)
    ]
    df = spark.createDataFrame(captures, "page_id long, url string, fetched date").withColumns(
        {c: F.lit("x") for c in ("start", "stop", "rank", "n", "best", "_day", "day", "pattern")}
    )
    found = filter_urls(df, spark.createDataFrame(events, EVENTS)).collect()
    assert len(found) == len(captures)
    for r in found:
        assert (r.verdict, r.list_name, r["_pattern"]) == brute(r.host, r.fetched, events), r


def test_intervals(spark):
    events = [("L", "p", "block", a, day(n)) for a, n in (("add", 1), ("add", 3), ("remove", 5), ("remove", 6), ("add", 9))]
    found = validity(spark.createDataFrame(events, EVENTS)).collect()
    first = (DAY0 - dt.date(1970, 1, 1)).days
    assert sorted((r.start - first, r.stop and r.stop - first) for r in found) == [(1, 5), (9, None)]


def test_empty_tables_and_repeats(spark):
    captures = spark.createDataFrame([(1, "http://p/", day(1))] * 3, "page_id long, url string, fetched date")
    events = spark.createDataFrame([("L", "p", "block", "add", day(0))] * 2, EVENTS)
    assert [r.verdict for r in filter_urls(captures, events).collect()] == ["block"] * 3
    assert [r.verdict for r in filter_urls(captures, events.limit(0)).collect()] == ["allow"] * 3
    assert filter_urls(captures.limit(0), events).count() == 0


def test_no_python_in_the_plan(spark):
    captures = spark.createDataFrame([(1, "http://p/", day(1))], "page_id long, url string, fetched date")
    events = spark.createDataFrame([("L", "p", "block", "add", day(0))], EVENTS)
    plan = filter_urls(captures, events)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_hot_host_and_day_is_split(spark, shuffled_joins):
    captures = spark.range(0, 60000, 1, 6).selectExpr(
        "id as page_id",
        "if(id % 2 = 0, 'http://hot.com/', concat('http://h', id % 5000, '.com/')) as url",
        "if(id % 2 = 0, date'2024-01-01', date_add(date'2024-01-01', int(id % 90))) as fetched",
    )
    events = spark.createDataFrame([("L", "hot.com", "block", "add", day(0))], EVENTS)
    found = filter_urls(captures, events)
    assert "skew=true" in final_plan(found)
    assert found.where("verdict = 'block'").count() == 30000

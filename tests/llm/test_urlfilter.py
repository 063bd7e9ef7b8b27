import datetime
import random

import pytest
from pyspark.sql import functions as F

from adpulse.llm import queries, urlfilter

START = datetime.date(2024, 1, 1)


def _day(k):
    return START + datetime.timedelta(days=k)


def _brute(captures, entries):
    """Replays the list up to the day of every capture."""
    found = []
    for page, host, day in captures:
        hits = []
        state = {}
        for domain, category, on, action in sorted(
            entries, key=lambda e: (e[2], e[3] == "add")
        ):
            if on > day:
                break
            last = state.get((domain, category))
            state[domain, category] = on if action == "add" else None
            del last
        for (domain, category), since in state.items():
            if since and host and (host == domain or host.endswith("." + domain)):
                hits.append((domain, category, since))
        if hits:
            longest = max((h[0] for h in hits), key=len)
            kinds = ",".join(sorted({h[1] for h in hits}))
            found.append((page, True, longest, kinds, max(h[2] for h in hits)))
        else:
            found.append((page, False, None, None, None))
    return sorted(found)


@pytest.mark.parametrize("seed", range(3))
def test_matches_a_replay_of_the_list(spark, seed):
    draw = random.Random(seed)
    domains = ["x.org", "a.x.org", "b.a.x.org", "y.com", "c.y.com"]
    entries = [
        (draw.choice(domains), draw.choice(["ads", "spam"]), _day(draw.randrange(400)),
         draw.choice(["add", "remove"]))
        for _ in range(60)
    ]
    captures = [
        (k, draw.choice([*domains, "z.b.a.x.org", "other.net"]), _day(draw.randrange(-5, 420)))
        for k in range(300)
    ]
    rows = spark.createDataFrame(
        [(k, f"https://u:p@{host.upper()}.:80/p?q#f", day) for k, host, day in captures],
        "page_id long, url string, day date",
    )
    listed = spark.createDataFrame(entries, "domain string, category string, day date, action string")
    got = urlfilter.filtered(rows, listed).select(
        "page_id", "blocked", "matched", "categories", "listed_on"
    )
    assert sorted(map(tuple, got.collect())) == _brute(captures, entries)


def test_hosts(spark):
    cases = {
        "https://A.b.C/x": "a.b.c",
        "http://user:pw@h.org:8080?x": "h.org",
        "ftp://h.org.": "h.org",
        "http://1.2.3.4/": "1.2.3.4",
        "//h.org/x": None,
        "h.org/x": None,
        "http:///x": None,
        "": None,
        None: None,
    }
    rows = spark.createDataFrame([(url,) for url in cases], "url string")
    got = {row["url"]: row["h"] for row in rows.select("url", urlfilter.host_of("url").alias("h")).collect()}
    assert got == cases
    above = spark.createDataFrame([("a.b.c.d",), ("x",), ("1.2.3.4",), ("b.c",)], "h string")
    got = {row["h"]: row["d"] for row in above.select("h", urlfilter.domains_above("h").alias("d")).collect()}
    assert got == {
        "a.b.c.d": ["a.b.c.d", "b.c.d", "c.d"], "x": ["x"], "1.2.3.4": ["1.2.3.4"], "b.c": ["b.c"]
    }


def test_nulls_repeats_clashes_and_empty(spark):
    captures = spark.createDataFrame(
        [(1, "http://x.org/", _day(5), "c"), (1, "http://x.org/", _day(5), "c"),
         (2, None, _day(5), "c"), (3, "http://x.org/", None, "c")],
        "page_id long, url string, day date, matched string",
    ).withColumn("host", F.lit("clash")).withColumn("domain", F.lit("clash"))
    entries = spark.createDataFrame(
        [("x.org", "ads", _day(1), "add"), ("x.org", "ads", _day(1), "add"),
         ("x.org", "ads", _day(1), "remove"), (None, "ads", _day(1), "add"),
         ("x.org", None, _day(1), "add"), ("x.org", "ads", None, "add")],
        "domain string, category string, day date, action string",
    )
    rows = urlfilter.filtered(captures, entries).select("page_id", "blocked", "matched", "domain")
    assert sorted(map(tuple, rows.collect()), key=str) == [
        (1, True, "x.org", "clash"), (1, True, "x.org", "clash"),
        (2, False, None, "clash"), (3, False, None, "clash"),
    ]
    none = urlfilter.filtered(captures.limit(0), entries)
    assert none.collect() == []
    assert not any(row["blocked"] for row in urlfilter.filtered(captures, entries.limit(0)).collect())


def test_query_blocks_some_and_changes_over_time(spark):
    rows = queries.op6_url_filter(spark, "/root/testdata/sf0.01").collect()
    assert {row["blocked"] for row in rows} == {True, False}
    by_host: dict = {}
    for row in rows:
        by_host.setdefault(row["host"], set()).add(row["blocked"])
    assert any(len(found) == 2 for found in by_host.values())

"""Operator 8: URL filters by dated lists, each capture judged by the entries of its day.

DataFrame functions only. A list is a table of dated entries: from `day` on, `pattern` is listed or
no longer listed. Entries become validity intervals, intervals are laid over periods of `PERIOD_DAYS`, and
captures meet the intervals of their own pattern and period only, as an as-of join. So neither a pattern
with a long history nor a period with many captures makes many pairs.

A pattern is a domain, which covers its subdomains, or a host and the first part of a path. The
longest pattern that is in force names the match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rallybook.llm.columns import unused

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+(/[^/?#]+)"
PERIOD_DAYS = 90


def period(day: Column) -> Column:
    return F.floor(F.unix_date(day) / PERIOD_DAYS)


def intervals(entries: DataFrame) -> DataFrame:
    """`pattern`, `since` and `until` (null: still) of every stretch in which a pattern is listed.

    Of several entries for a pattern and day, one that lists it prevails. Entries without a pattern,
    day or state are left out. Patterns are compared in lower case.
    """
    known = entries.where("pattern is not null and day is not null and listed is not null")
    days = known.groupBy(F.lower("pattern").alias("pattern"), "day").agg(F.bool_or("listed").alias("listed"))
    days = days.withColumn("period", period(F.col("day")))
    # The next entry is in the same period, or the first of a later one: no history is one task.
    firsts = days.groupBy("pattern", "period").agg(F.min("day").alias("first"))
    later = F.lead("first").over(Window.partitionBy("pattern").orderBy("period"))
    firsts = firsts.select("pattern", "period", later.alias("later"))
    following = F.lead("day").over(Window.partitionBy("pattern", "period").orderBy("day"))
    days = days.withColumn("following", following).join(firsts, ["pattern", "period"])
    return days.where("listed").select(
        "pattern", F.col("day").alias("since"), F.coalesce("following", "later").alias("until")
    )


def patterns_of(url: Column) -> Column:
    """Every pattern that would cover the URL."""
    host = F.lower(F.regexp_extract(url, HOST, 1))
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    path = F.lower(F.regexp_extract(url, PATH, 1))
    with_path = F.when(path != "", F.array(F.concat(host, path))).otherwise(F.array().cast("array<string>"))
    return F.when(host != "", F.concat(domains, with_path)).otherwise(F.array().cast("array<string>"))


def filtered(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """All rows and columns of `captures` (`url`, `day`) with `host`, `n_active` (patterns in force that
    cover the URL that day), `matched` (the longest of them, the last in order among equals) and
    `blocked`; earlier columns of these names are replaced.

    An interval holds from its first day to the day before the next entry. A null or unreadable URL
    has no host and is not blocked, nor is a capture without a day. Repeated rows get the same
    answer each. Empty tables: no rows, or nothing blocked. Other columns may have any name.
    """
    captures = captures.drop("host", "n_active", "matched", "blocked")
    seen = captures.where("url is not null and day is not null").select("url", "day").distinct()
    keys = seen.withColumn("pattern", F.explode(F.array_distinct(patterns_of(F.col("url")))))
    keys = keys.withColumn("period", period(F.col("day")))
    # Intervals are laid over the periods that captures are of, however long they last: two values.
    first, last = (F.lit(day).cast("date") for day in captures.agg(F.min("day"), F.max("day")).first())
    begin = F.greatest(F.col("since"), first)
    end = F.least(F.coalesce(F.date_sub("until", 1), last), last)
    held = intervals(entries).where((begin <= end) & first.isNotNull())
    held = held.withColumn("period", F.explode(F.sequence(period(begin), period(end))))
    met = keys.join(held, ["pattern", "period"])
    met = met.where("day >= since and (until is null or day < until)")
    longest = F.max(F.struct(F.length("pattern").alias("n"), "pattern"))["pattern"]
    found = met.groupBy("url", "day").agg(F.count("*").alias("n_active"), longest.alias("matched"))
    url, day = unused("_url", captures.columns), unused("_day", captures.columns)
    named = found.withColumnsRenamed({"url": url, "day": day})
    out = captures.join(named, (F.col("url") == F.col(url)) & (F.col("day") == F.col(day)), "left")
    host = F.nullif(F.lower(F.regexp_extract("url", HOST, 1)), F.lit(""))
    return out.select(
        *[F.col(c) for c in captures.columns],
        host.alias("host"),
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        "matched",
        F.col("matched").isNotNull().alias("blocked"),
    )


# The given pages as captures and their hosts as a list with a history. Days count from 1970; the
# text is the same for Spark and for the oracle.
CAPTURES_SQL = "select page_id, url, cast(18262 + (page_id * 37) % 1800 as int) as n from {pages}"
HOSTS_SQL = r"""
select host, min(page_id) as m
from (select page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) as host
      from {pages}) h
where host <> '' group by host
"""
ENTRIES_SQL = """
select host as pattern, cast(18262 + (m * 53) % 1500 as int) as n, true as listed from hosts where m % 3 = 0
union all
select host, cast(18462 + (m * 53) % 1500 + m % 300 as int), false from hosts where m % 3 = 0
union all
select regexp_extract(host, '([^.]+[.][^.]+)$', 1), cast(18262 + (m * 7) % 1800 as int), m % 2 = 0
from hosts where m % 5 = 1
union all
select host || '/en', cast(18262 + (m * 11) % 900 as int), true from hosts where m % 7 = 2
"""

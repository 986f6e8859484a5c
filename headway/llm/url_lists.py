"""URL filtering by dated lists, with DataFrame operations alone.

Dated entries that put a host on a list or take it off become validity intervals. Every distinct host and day of the
captures is compared with the intervals of the host and of each domain above it that are valid on that day. The join
is on the name and a bucket of days, so neither a host that is captured very often nor a long list history is
multiplied: captures are reduced to host and day before, and an interval stands in each bucket once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days of a bucket.
BUCKET_DAYS = 32
ADD, REMOVE = "add", "remove"
BLOCK, ALLOW = "block", "allow"


def host_of(url: Column) -> Column:
    """The lower-cased host without user, port and trailing dots; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*?)\.*(?::[0-9]*)?(?:[/?#]|$)", 1))


def names_above(host: Column) -> Column:
    """The host and every domain above it; an address of numbers has none above."""
    labels = F.split(host, r"\.")
    above = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".")
    )
    return F.when(host.rlike(r"^[0-9.]+$"), F.array(host)).otherwise(above)


def validity(entries: DataFrame) -> DataFrame:
    """(name, list, kind, since, until): the intervals, until exclusive or null, in which dated entries
    (name, list, kind, day, action) are in force.

    Days that repeat an entry's state change nothing; of an addition and a removal on one day the addition counts. So
    a name's history on a list has at most one row a day, whatever the number of its entries. Entries with a null
    take no part.
    """
    given = entries.select(F.lower("name").alias("name"), "list", "kind", "day", "action").dropna()
    days = given.groupBy("name", "list", "kind", "day").agg(F.max((F.col("action") == ADD).cast("int")).alias("on"))
    history = Window.partitionBy("name", "list", "kind").orderBy("day")
    changes = days.withColumn("was", F.coalesce(F.lag("on").over(history), F.lit(0))).where("on <> was")
    until = F.lead("day").over(history)
    return changes.withColumn("until", until).where("on = 1").select("name", "list", "kind", F.col("day").alias("since"), "until")


def _bucket(day: Column) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / BUCKET_DAYS)


def judged(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """For every row of captures (page_id, url, fetched_on) its host, whether it is blocked, and by what: rule and
    lists. Of the entries valid on the day, the one with the longest name decides, allowing before blocking; lists are
    all lists with a valid entry, sorted and joined by commas.

    A null or unreadable url has an empty host, a null day no valid entry; neither is blocked. Repeated rows come back
    as often as they came. Other columns of both tables aren't read.
    """
    rows = captures.select("page_id", "url", "fetched_on", host_of(F.col("url")).alias("host"))
    asked = rows.where("host <> '' and fetched_on is not null").select("host", "fetched_on").distinct()
    last = rows.agg(F.max("fetched_on")).first()[0]
    valid = validity(entries)
    end = F.least(F.coalesce(F.date_sub("until", 1), F.lit(last).cast("date")), F.lit(last).cast("date"))
    spread = valid.where(F.col("since") <= end).withColumn("bucket", F.explode(F.sequence(_bucket(F.col("since")), _bucket(end))))
    wanted = asked.select("host", "fetched_on", F.explode(names_above(F.col("host"))).alias("name"), _bucket(F.col("fetched_on")).alias("bucket"))
    active = wanted.join(spread, ["name", "bucket"])
    active = active.where((F.col("since") <= F.col("fetched_on")) & (F.col("until").isNull() | (F.col("fetched_on") < F.col("until"))))
    rank = F.struct(F.length("name").alias("size"), (F.col("kind") == ALLOW).alias("allows"))
    found = active.groupBy("host", "fetched_on").agg(
        F.max_by(F.struct("name", "kind"), rank).alias("top"), F.array_join(F.sort_array(F.collect_set("list")), ",").alias("lists")
    )
    out = rows.join(found, ["host", "fetched_on"], "left")
    return out.select(
        "page_id",
        "url",
        "fetched_on",
        "host",
        F.coalesce(F.col("top.kind") == BLOCK, F.lit(False)).alias("blocked"),
        F.col("top.name").alias("rule"),
        F.coalesce("lists", F.lit("")).alias("lists"),
    )

"""Temporal URL list join (operator 8), DataFrame functions only.

Dated list entries (pattern, list, action "add" or "remove", day) become validity
intervals: an add holds until the next remove of the same pattern and list. A capture is
matched with the entries of its host and of every parent domain that were in force on
the day it was fetched; the longest pattern decides, then the list's name, then the
latest start.

Captures are first reduced to distinct (host, day), which is what a verdict depends on.
Each side of the as-of join is dealt with a salt, so a host that holds a third of all
captures is spread over many tasks.

Defined cases: a null or hostless url, or a null day, matches nothing; entries with a null
pattern, list or day are ignored; adds repeated while in force, and removes without an add,
change nothing; on one day removes come before adds; an empty list blocks nothing; repeated
captures and null ids are judged like any other; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 16


def host(url: Column) -> Column:
    """Lower-case host of a URL without user, port and trailing dot; null if there is none."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    found = F.regexp_replace(found, r"\.$", "")
    return F.when(found != "", found)


def intervals(entries: DataFrame) -> DataFrame:
    """pattern, list, valid_from (included), valid_to (excluded, null while in force)."""
    rows = entries.select(F.lower("pattern").alias("pattern"), "list", "action", "day").dropna().distinct()
    turns = (rows.withColumn("rank", F.when(F.col("action") == "remove", 0).otherwise(1))
             .withColumn("previous", F.lag("action").over(Window.partitionBy("pattern", "list").orderBy("day", "rank")))
             .where("action in ('add', 'remove') and (previous is null and action = 'add' or previous != action)"))
    ahead = F.lead("day").over(Window.partitionBy("pattern", "list").orderBy("day", "rank"))
    return turns.withColumn("valid_to", ahead).where("action = 'add'").select("pattern", "list", F.col("day").alias("valid_from"), "valid_to")


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Per capture (id, url, day): host, blocked, and the deciding pattern, list, valid_from, valid_to."""
    rows = captures.select("id", "url", "day", host(F.col("url")).alias("host"))
    seen = rows.where("host is not null and day is not null").select("host", "day").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    asked = (seen.select("host", "day", F.explode(suffixes).alias("pattern"))
             .withColumn("salt", F.pmod(F.xxhash64("host", "day"), F.lit(SALTS)).cast("int")))
    valid = intervals(entries).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    held = asked.join(valid, ["pattern", "salt"]).where("valid_from <= day and (valid_to is null or day < valid_to)")
    first = held.groupBy("host", "day").agg(F.min(F.struct(
        (-F.length("pattern")).alias("short"), "list", (-F.datediff("valid_from", F.lit("1970-01-01"))).alias("age"), "pattern", "valid_from", "valid_to")).alias("e"))
    first = first.select(F.col("host").alias("ehost"), F.col("day").alias("eday"), "e.pattern", "e.list", "e.valid_from", "e.valid_to")
    return (rows.join(first, (F.col("host") == F.col("ehost")) & (F.col("day") == F.col("eday")), "left")
            .select("id", "url", "day", "host", F.col("pattern").isNotNull().alias("blocked"), "pattern", "list", "valid_from", "valid_to"))

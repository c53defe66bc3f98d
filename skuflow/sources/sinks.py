"""Row counts, result sinks and the dashboard JSON payload.

Results are written by the executors (``DataFrame.write``); nothing is pulled
through the driver.  Paths are whatever the caller passes - on a cluster a
shared filesystem or object store.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skuflow.operators.prefix import running_totals
from skuflow.sources.model import Model
from skuflow.sources.schemas import LOAD_ORDER


def row_counts(m: Model) -> DataFrame:
    """One row per model table with its row count (load order preserved)."""
    parts = [m.table(t).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(i).alias("load_order"), F.lit(t).alias("table_name"), "row_count")
             for i, t in enumerate(LOAD_ORDER)]
    return reduce(DataFrame.unionByName, parts)


def write_results(results: dict[str, DataFrame], path: str, fmt: str = "csv") -> list[str]:
    """One output per named result (CSV with header, or Parquet), full overwrite."""
    written = []
    for name, df in results.items():
        w = df.write.mode("overwrite")
        if fmt == "csv":
            w.option("header", True).csv(f"{path}/{name}")
        else:
            w.format(fmt).save(f"{path}/{name}")
        written.append(f"{path}/{name}")
    return written


def write_feeds(feeds: dict[str, tuple[DataFrame, list]], path: str, rows_per_file: int = 0) -> DataFrame:
    """Each feed as ordered JSON lines, with an index of its files; returns the index.

    ``feeds`` gives each feed with its order (columns, unique together). Rows are dealt by range
    of the order and sorted within a task, so the part files of ``{path}/{feed}`` in the order of
    their names are the feed; no task or driver holds a whole one. The index
    (``{path}/_index``: feed, file, rows, and the row number at which the file begins) is counted
    on the written files. ``rows_per_file`` cuts files further.
    """
    index = []
    for name, (df, order) in feeds.items():
        write = df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite")
        if rows_per_file:
            write = write.option("maxRecordsPerFile", rows_per_file)
        write.json(f"{path}/{name}")
        files = df.sparkSession.read.text(f"{path}/{name}").groupBy(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"))
        index.append(files.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("feed"), "file", "rows"))
    before = Window.partitionBy("feed").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)   # one row per file
    out = reduce(DataFrame.unionByName, index).withColumn("begins", F.coalesce(F.sum("rows").over(before), F.lit(0)).cast("long"))
    out.coalesce(1).write.mode("overwrite").json(f"{path}/_index")
    return out.sparkSession.read.schema("feed string, file string, rows bigint, begins bigint").json(f"{path}/_index")


def feed_lines(feeds: dict[str, tuple[DataFrame, list]]) -> DataFrame:
    """The feeds as the lines of one JSON object, feed -> array of rows: feed_no, position, line.

    Rows are numbered by ``prefix.running_totals``; a line's comma depends on its own number only.
    """
    spark = next(iter(feeds.values()))[0].sparkSession
    parts = []
    for i, (name, (df, order)) in enumerate(feeds.items()):
        keys = [(c, False) if isinstance(c, str) else c for c in order]
        numbered = running_totals(df.withColumn("_one", F.lit(1)), keys, "_one", rank_col="_at", cum_col="_cum")
        text = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
        rows = numbered.select(F.col("_at").alias("position"), F.concat(F.when(F.col("_at") > 1, ",").otherwise(""), text).alias("line"))
        head = ("{" if i == 0 else ",") + json.dumps(name) + ": ["
        tail = "]" + ("}" if i == len(feeds) - 1 else "")
        ends = spark.createDataFrame([(0, head), ((1 << 63) - 1, tail)], "position bigint, line string")
        parts.append(rows.union(ends).select(F.lit(i).alias("feed_no"), "position", "line"))
    return reduce(DataFrame.unionByName, parts)


def write_payload(feeds: dict[str, tuple[DataFrame, list]], path: str) -> None:
    """All feeds as one JSON document, in text files that are its parts in the order of their names."""
    feed_lines(feeds).repartitionByRange("feed_no", "position").sortWithinPartitions("feed_no", "position").select("line").write.mode("overwrite").text(path)

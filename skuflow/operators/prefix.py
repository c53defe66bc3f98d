"""Exact global running sums and row numbers without a single-task window.

``Window.orderBy`` with no ``partitionBy`` moves every row into one task.  Here
``repartitionByRange`` cuts the ordered input into contiguous key ranges, whose
number follows the data (AQE joins small neighbours), and the range of each row
is written with it into a reliable checkpoint, so a recomputation after a lost
executor cannot cut differently.  Per-range counts and sums (one row per range)
give each range its offset; the running sum inside a range is an ordinary
partitioned window.  Sums are exact on integer/decimal inputs, so the result does
not depend on how the ranges are cut.  Every size takes this one path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skuflow.session import ensure_checkpoint_dir


def running_totals(df: DataFrame, keys: list[tuple[str, bool]], value: str, *,
                   rank_col: str = "rank", cum_col: str = "cum_value",
                   total_col: str | None = None, count_col: str | None = None,
                   ranges: int | None = None) -> DataFrame:
    """Add a 1-based ``rank_col`` and inclusive running sum ``cum_col`` of ``value``.

    ``total_col`` / ``count_col`` optionally carry the grand total of ``value``
    and the row count on every row (no second pass over the input).

    ``keys`` is the total order, e.g. ``[("revenue", True), ("product_id", False)]``
    (descending revenue, ascending id); it must be unique per row.  ``ranges``
    fixes the number of key ranges; by default Spark chooses it from the data.
    """
    order = [F.col(n).desc() if d else F.col(n).asc() for n, d in keys]
    ensure_checkpoint_dir(df.sparkSession)
    cut = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    placed = cut.withColumn("_range", F.spark_partition_id()).checkpoint(eager=True)

    per_range = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s"))
    # one row per range: windows over them are bounded by the number of partitions
    every = Window.partitionBy(F.lit(0))
    before = every.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        "_range",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
        F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s_before"),
        F.sum("_s").over(every).alias("_s_all"),
        F.sum("_n").over(every).alias("_n_all"),
    )
    w = Window.partitionBy("_range").orderBy(*order)
    out = (
        placed.join(F.broadcast(offsets), "_range")
        .withColumn(rank_col, (F.row_number().over(w) + F.col("_n_before")).cast("long"))
        .withColumn(cum_col, F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0))
                    + F.col("_s_before"))
    )
    if total_col:
        out = out.withColumn(total_col, F.col("_s_all"))
    if count_col:
        out = out.withColumn(count_col, F.col("_n_all"))
    return out.drop("_range", "_n_before", "_s_before", "_s_all", "_n_all")


def tied_ranks(df: DataFrame, value: str, tie_break: list[str], *, fewer_col: str = "fewer", ties_col: str = "ties",
               count_col: str = "n", ranges: int | None = None) -> DataFrame:
    """Add for every row how many rows have a lesser ``value``, how many an equal one, and how many rows there are.

    Rows are cut into ranges by (value, ``tie_break``), so a value that half of all rows share is
    spread over many ranges. Counts are made within a range; only the least and the largest value
    of a range can go on in its neighbours, and their counts, at most two rows per range, are
    added up apart. NULL is the least value.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = [F.col(value), *(F.col(c) for c in tie_break)]
    cut = df.repartitionByRange(ranges, *keys) if ranges else df.repartitionByRange(*keys)
    placed = cut.withColumn("_range", F.spark_partition_id()).checkpoint(eager=True)
    within = Window.partitionBy("_range").orderBy(F.col(value).asc_nulls_first())
    placed = placed.withColumn("_less", F.rank().over(within) - 1).withColumn("_same", F.count(F.lit(1)).over(Window.partitionBy("_range", value)))
    place = F.struct(F.col(value).isNotNull().alias("known"), F.col(value).alias("v"))
    per_range = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_lo"), F.max(place).alias("_hi"))
    every = Window.partitionBy(F.lit(0))                                 # one row per range
    offsets = per_range.select("_range", "_lo", "_hi", F.sum("_n").over(every).alias("_all"),
                               F.coalesce(F.sum("_n").over(every.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    placed = placed.join(F.broadcast(offsets), "_range")
    border = (placed.where((place == F.col("_lo")) | (place == F.col("_hi"))).groupBy("_range", F.col(value).alias("_value"))
              .agg(F.count(F.lit(1)).alias("_c"), F.min(F.col("_before") + F.col("_less")).alias("_f"))
              .groupBy("_value").agg(F.sum("_c").alias("_ties"), F.min("_f").alias("_fewer")))
    out = placed.join(F.broadcast(border), F.col(value).eqNullSafe(F.col("_value")), "left")
    return out.select(*df.columns, F.coalesce("_fewer", F.col("_before") + F.col("_less")).cast("long").alias(fewer_col),
                      F.coalesce("_ties", "_same").cast("long").alias(ties_col), F.col("_all").cast("long").alias(count_col))

"""Scalar building blocks as native Column expressions.

Money is carried as BIGINT cents per row and summed as DECIMAL(38,0) so that
totals are exact and order-independent at any scale; doubles appear only in
the final projection.  Ratios are NULL (never NaN, never an ANSI error) when
the denominator is zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "EXACT", "exact", "money_sum", "dollars", "safe_div", "round_ratio",
    "round_half_even", "round_half_up", "date_key", "year_month", "pct",
    "pearson", "money_label", "money_axis_label", "to_date_col", "scalar_row",
]

EXACT = "decimal(38,0)"
# Fixed value: the fiscal year starts in July.
FISCAL_START_MONTH = 7


def exact(c: Column) -> Column:
    """Widen an integer column to DECIMAL(38,0) (no overflow on totals)."""
    return c.cast(EXACT)


def money_sum(c: Column) -> Column:
    """Exact sum of integer cents; partial aggregation still applies."""
    return F.sum(exact(c))


def dollars(cents: Column) -> Column:
    """Cents (integer or decimal) to dollars as a double, rounded once."""
    return cents.cast("double") / F.lit(100)


def safe_div(num: Column, den: Column) -> Column:
    """num / den as double, NULL on a zero or NULL denominator."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def _idiv(a: Column, b: Column) -> Column:
    """Exact floor division of non-negative decimals (a - a mod b is a multiple of b)."""
    return ((a - F.pmod(a, b)) / b).cast("long")


def round_ratio(num: Column, den: Column, digits: int = 2) -> Column:
    """num/den rounded half away from zero to ``digits`` decimals, exactly.

    Both operands are integers (counts or cents); the rounding is done in
    integer arithmetic so the result does not depend on float evaluation
    order.  NULL when den is 0.
    """
    scale = 10 ** digits
    n = exact(num)
    d = F.nullif(exact(den), F.lit(0).cast(EXACT))
    mag = _idiv(F.abs(n) * F.lit(2 * scale).cast(EXACT) + d, d * F.lit(2).cast(EXACT))
    signed = F.when(n < 0, -mag).otherwise(mag)
    return signed.cast("double") / F.lit(scale)


def round_half_even(x: Column, digits: int) -> Column:
    """pandas/numpy ``round``: half-to-even on the scaled double."""
    scale = 10 ** digits
    return F.rint(x * F.lit(float(scale))) / F.lit(float(scale))


def round_half_up(x: Column, digits: int) -> Column:
    """SQL ``ROUND`` on a double (half away from zero)."""
    return F.round(x, digits)


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    """100 * num / den rounded exactly (num, den integers)."""
    return round_ratio(exact(num) * F.lit(100).cast(EXACT), den, digits)


def date_key(d: Column) -> Column:
    """yyyymmdd integer key of a date."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def fiscal_year(d: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    """The fiscal year a date lies in, named after the calendar year in which it ends."""
    return F.year(d) if start_month == 1 else F.when(F.month(d) < start_month, F.year(d)).otherwise(F.year(d) + 1)


def year_month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def pearson(x: Column, y: Column) -> Column:
    """Pearson r of two integer columns; NULL (not an error) when either side is constant.

    The moments are exact sums (x, y, xx, yy, xy as DECIMAL) and are divided once, at the end,
    so the bits do not depend on how the rows are partitioned. Scale fractions to integers first
    (r does not change). Pairs with a NULL are left out.
    """
    both = x.isNotNull() & y.isNotNull()
    ex, ey = F.when(both, x).cast("long").cast("decimal(19,0)"), F.when(both, y).cast("long").cast("decimal(19,0)")
    n = F.count_if(both).cast(EXACT)
    sx, sy = F.sum(ex).cast(EXACT), F.sum(ey).cast(EXACT)
    sxx, syy, sxy = F.sum((ex * ex).cast(EXACT)), F.sum((ey * ey).cast(EXACT)), F.sum((ex * ey).cast(EXACT))
    spread = F.sqrt((n * sxx - sx * sx).cast("double")) * F.sqrt((n * syy - sy * sy).cast("double"))
    return (n * sxy - sx * sy).cast("double") / F.nullif(spread, F.lit(0.0))


def money_label(x: Column) -> Column:
    """Money in a text: $1.2M from a million on, else whole dollars with separators ($4,321); half-even."""
    return (F.when(F.abs(x) >= 1e6, F.format_string("$%,.1fM", round_half_even(x / F.lit(1e6), 1)))
            .when(x.isNotNull(), F.format_string("$%,.0f", F.rint(x))))


def money_axis_label(x: Column) -> Column:
    """Money on an axis: $1.2M, $4K, $900; half-even."""
    return (F.when(F.abs(x) >= 1e6, F.format_string("$%.1fM", round_half_even(x / F.lit(1e6), 1)))
            .when(F.abs(x) >= 1e3, F.format_string("$%.0fK", F.rint(x / F.lit(1e3))))
            .when(x.isNotNull(), F.format_string("$%.0f", F.rint(x))))


def to_date_col(c: Column) -> Column:
    """Text or timestamp to DATE (ISO-8601 text is the reference's storage form)."""
    return F.to_date(c)


def scalar_row(one_row: DataFrame) -> Column:
    """A one-row aggregate as ONE struct-valued scalar subquery.

    Attach it once as a column (``df.withColumn("s", scalar_row(agg))``) and
    read fields with ``F.col("s.field")``: every occurrence of a subquery
    expression in a plan is executed separately, so it must appear once.
    """
    return one_row.select(F.struct(*one_row.columns).alias("r")).scalar()


def sort_bounded(df: DataFrame, *cols) -> DataFrame:
    """Order a result whose size is bounded by a small dimension.

    For outputs with one row per warehouse / category / status / class / month
    a single final task sorts them; a global ``orderBy`` would add a
    range-partitioning exchange and a sampling job for a handful of rows.
    Unbounded outputs (per position, per supplier, per line) use ``orderBy``.
    """
    return df.coalesce(1).sortWithinPartitions(*cols)

"""Exact quantiles of any integral or date column, without sorting its rows.

The k-th least value is found by narrowing: a pass counts the rows of ``BUCKETS`` equal parts of
the interval that still holds it, with partial aggregation on the executors, and the part with
the k-th row becomes the next interval; a column of 64-bit values needs at most seven passes, one
of a million distinct values two. Only the counts of one pass, at most BUCKETS rows per wanted
value, reach the driver. No value is buffered, and a hot value costs nothing extra.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1024
#: Differences of 64-bit values.
_WIDE = "decimal(20,0)"


def kth_least(df: DataFrame, column: str, ranks: Sequence[int], buckets: int = BUCKETS) -> list[int]:
    """The values at the given places (0 is the least) of the column's sorted non-null values."""
    value = F.col(column).cast(_WIDE)
    ends = df.agg(F.min(column).cast("long"), F.max(column).cast("long"), F.count(column)).first()
    if any(not 0 <= k < ends[2] for k in ranks):
        raise ValueError(f"{ends[2]} values have no place {max(ranks, default=0)}")
    # each wanted place: the interval that holds it, and its place among the rows of the interval
    wanted = {k: (ends[0], ends[1], k) for k in ranks}
    while open_ := {(lo, hi) for lo, hi, _ in wanted.values() if lo < hi}:
        spans = sorted(open_)
        parts = []
        for i, (lo, hi) in enumerate(spans):
            width = F.lit(str(-(-(hi - lo + 1) // buckets))).cast(_WIDE)
            far = value - F.lit(lo).cast(_WIDE)
            part = ((far - F.pmod(far, width)) / width).cast("long")
            parts.append(F.when(value.between(lo, hi), F.struct(F.lit(i).alias("i"), part.alias("b"))))
        counts = df.select(F.explode(F.array_compact(F.array(*parts))).alias("p")).groupBy("p.i", "p.b").agg(F.count(F.lit(1)).alias("n")).collect()
        by_span: dict[int, list[tuple[int, int]]] = {}
        for r in counts:
            by_span.setdefault(r["i"], []).append((r["b"], r["n"]))
        for k, (lo, hi, place) in wanted.items():
            if lo == hi:
                continue
            width = -(-(hi - lo + 1) // buckets)
            for b, n in sorted(by_span[spans.index((lo, hi))]):
                if place < n:
                    wanted[k] = (lo + b * width, min(lo + (b + 1) * width - 1, hi), place)
                    break
                place -= n
    return [wanted[k][0] for k in ranks]


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> DataFrame:
    """For each share q: the values below and above place q * (n - 1), and their linear interpolation.

    Columns share, lower, upper (as the column's type), value (double; days since 1970 for dates).
    NULLs are left out; without values there are no rows.
    """
    kind = df.schema[column].dataType
    if not isinstance(kind, (T.IntegralType, T.DateType)):
        raise ValueError(f"{column} is neither integral nor a date")
    rows = df.select((F.unix_date(column) if isinstance(kind, T.DateType) else F.col(column)).alias("v"))
    n = rows.agg(F.count("v")).first()[0]
    schema = "share double, lower long, upper long, value double"
    found = []
    if n:
        places = [Fraction(str(q)) * (n - 1) for q in shares]
        ranks = sorted({f(p) for p in places for f in (math.floor, math.ceil)})
        at = dict(zip(ranks, kth_least(rows, "v", ranks)))
        for q, p in zip(shares, places):
            lower, upper = at[math.floor(p)], at[math.ceil(p)]
            found.append((float(q), lower, upper, float(lower + (upper - lower) * (p - math.floor(p)))))
    out = df.sparkSession.createDataFrame(found, schema)
    typed = (lambda c: F.date_from_unix_date(F.col(c).cast("int"))) if isinstance(kind, T.DateType) else (lambda c: F.col(c).cast(kind))
    return out.select("share", typed("lower").alias("lower"), typed("upper").alias("upper"), "value")

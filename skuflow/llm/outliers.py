"""Quality rules by robust multivariate outliers (operator 7), DataFrame functions only.

Base statistics of a text give a base rule; documents that pass it are judged per
language and source by their transformed statistics: log words, log mean word length,
log share of signs, twice the share of repeated words. Centre and covariance of each group
are minimum-covariance-determinant estimates: from a start of medians and quartile
ranges, concentration steps take the mean and covariance of the ``SUBSET`` of rows with
the least Mahalanobis distance, until nothing changes (at most STEPS times). Every group's
estimate is drawn towards its language's, and that towards the whole table's, as if the
parent gave it PRIOR more rows: n of n + PRIOR parts are its own, at every size. A document is
rejected if its squared distance exceeds ``CUTOFF``.

Statistics are taken to six decimals and summed as whole numbers, and quantiles are counted in
bins of a fixed width, so estimates do not depend on how the rows are partitioned. Per step,
rows are only aggregated to one row per group (or bin of a group); each text is read once.

Defined cases: a null or empty text has no words and fails the base rule; null lang and
source are groups like others; equal rows tie and are judged alike; a constant statistic
has the least variance ``FLOOR``; an empty table gives no rows; null ids and other columns
are harmless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skuflow.llm.common import stage

PRIOR, SUBSET, STEPS, FLOOR = 200, 0.75, 12, 0.02
#: Widths of the bins in which quantiles of statistics, and of the logarithm of 1 + distance, are counted.
BIN, FAR_BIN = 1e-4, 1e-4
_WHOLE = "decimal(38,0)"
#: Squared distance that one in a million clean (normal, 4 dimensions) documents exceeds.
CUTOFF = 33.4
#: Variance of the inner 75 % of a 4-dimensional normal is short by this factor.
CONSISTENCY = 1.486
_X = ("x1", "x2", "x3", "x4")
_SPACE = r"[\x20\x09-\x0D]"


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of whole texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), text.alias("t"))
    rows = rows.select("doc_id", "lang", "source", F.regexp_extract_all("t", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("w"),
                       (F.length("t") - F.length(F.regexp_replace("t", r"[#*$%&|<>]", ""))).cast("bigint").alias("n_symbols"),
                       F.expr(r"filter(split(t, '\n', -1), x -> rlike(x, '[^\\x20\\x09-\\x0D]'))").alias("lines"))
    rows = rows.select("doc_id", "lang", "source", "n_symbols", F.size("w").cast("bigint").alias("n_words"),
                       F.length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
                       (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
                       # a window is known by the hash of its three words
                       F.expr("if(size(w) < 3, array(), zip_with(zip_with(w, slice(w, 2, size(w)), (a, b) -> struct(a, b)), "
                              "slice(w, 3, size(w)), (p, c) -> if(c is null, null, xxhash64(p.a, p.b, c))))").alias("h"))
    rows = rows.withColumn("h", F.expr("if(size(h) > 2, slice(h, 1, size(h) - 2), cast(array() as array<bigint>))"))
    ranked = rows.withColumn("s", F.expr("if(size(array_distinct(h)) = size(h), cast(array() as array<struct<v:bigint,i:int>>), "
                                         "array_sort(transform(h, (v, i) -> struct(v, i))))")).drop("h")
    # windows equal to a neighbour in hash order, then back in text order
    sided = ranked.select("*", F.expr("concat(array(cast(null as struct<v:bigint,i:int>)), s)").alias("before"), F.expr("slice(s, 2, size(s))").alias("after"))
    twice = sided.withColumn("r", F.expr(
        "array_sort(transform(filter(arrays_zip(s, before, after), "
        "z -> z.s is not null and (z.s.v <=> z.before.v or z.s.v <=> z.after.v)), z -> z.s.i))")).drop("s", "before", "after")
    return twice.withColumn("n_repeat_words", F.expr(
        "aggregate(zip_with(r, slice(r, 2, size(r)), (a, b) -> coalesce(least(b - a, 3), 3)), 0L, (t, x) -> t + x)")).drop("r")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _distance(x: list[Column]) -> Column:
    """Squared Mahalanobis distance by the group's centre (m1..) and Cholesky factor (l11..)."""
    y: list[Column] = []
    for i in range(1, 5):
        rest = x[i - 1] - F.col(f"m{i}")
        for j in range(1, i):
            rest = rest - F.col(f"l{i}{j}") * y[j - 1]
        y.append(rest / F.col(f"l{i}{i}"))
    return sum((v * v for v in y[1:]), y[0] * y[0])


def _with_factor(groups: DataFrame) -> DataFrame:
    """The Cholesky factor l.. of the covariances c.. (a least variance given the preceding statistics keeps it regular)."""
    for i in range(1, 5):
        for j in range(1, i + 1):
            rest = F.col(f"c{i}{j}")
            for k in range(1, j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            groups = groups.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(FLOOR))) if i == j else rest / F.col(f"l{j}{j}"))
    return groups


def _groups(rows: DataFrame) -> DataFrame:
    """Each row three times: for all, for its language, for its language and source (``g``)."""
    return rows.withColumn("g", F.explode(F.array(F.lit("all"), F.to_json(F.array("lang")), F.to_json(F.array("lang", "source")))))


def _counted(bins: DataFrame, shares: list[float]) -> DataFrame:
    """Per group and name: the least bin that has each share of the rows up to it (b0, b1, ..)."""
    counts = bins.groupBy("g", "name", "bin").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("g", "name")
    upto = F.sum("n").over(whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.select("g", "name", "bin", upto.alias("upto"), F.sum("n").over(whole).alias("all"))
    return placed.groupBy("g", "name").agg(*(
        F.min(F.when(F.col("upto") >= F.ceil(F.lit(q) * F.col("all")), F.col("bin"))).alias(f"b{i}") for i, q in enumerate(shares)))


def _moments(rows: DataFrame) -> DataFrame:
    """Per group: n, centre m1.. and covariances c11.. from exact sums of the statistics in millionths."""
    q = [F.rint(F.col(x) * 1e6).cast("long") for x in _X]
    sums = rows.groupBy("g").agg(
        F.count("*").alias("n"), *(F.sum(v.cast(_WHOLE)).alias(f"s{i}") for i, v in enumerate(q, 1)),
        *(F.sum((q[i - 1] * q[j - 1]).cast(_WHOLE)).alias(f"s{i}{j}") for i in range(1, 5) for j in range(1, i + 1)))
    n = F.col("n").cast(_WHOLE)
    return sums.select("g", *(((F.col(f"s{i}").cast("double") / F.col("n")) / 1e6).alias(f"m{i}") for i in range(1, 5)), *(
        ((n * F.col(f"s{i}{j}") - F.col(f"s{i}") * F.col(f"s{j}")).cast("double") / (F.col("n").cast("double") * F.col("n")) / 1e12 * CONSISTENCY)
        .alias(f"c{i}{j}") for i in range(1, 5) for j in range(1, i + 1)))


_M = [f"m{i}" for i in range(1, 5)]
_C = [f"c{i}{j}" for i in range(1, 5) for j in range(1, i + 1)]


def determinants(rows: DataFrame) -> DataFrame:
    """Per group g: n (its rows), centre m1.. and covariances c11.. of the minimum covariance determinant."""
    bins = rows.select("g", F.explode(F.array(*(F.struct(F.lit(x).alias("name"), F.floor(F.col(x) / BIN).alias("bin")) for x in _X))).alias("b")).select("g", "b.*")
    start = _counted(bins, [0.25, 0.5, 0.75]).groupBy("g").agg(
        *(F.max(F.when(F.col("name") == x, (F.col("b1") + 0.5) * BIN)).alias(f"m{i}") for i, x in enumerate(_X, 1)),
        *(F.max(F.when(F.col("name") == x, F.pow((F.col("b2") - F.col("b0")) * BIN / 1.349, 2))).alias(f"c{i}{i}") for i, x in enumerate(_X, 1)))
    groups = stage(start.select("g", *_M, *(F.col(c) if c[1] == c[2] else F.lit(0.0).alias(c) for c in _C)), "centres")
    mark = None
    for _ in range(STEPS):
        placed = rows.join(_with_factor(groups), "g").select("g", *_X, F.floor(F.log1p(_distance([F.col(x) for x in _X])) / FAR_BIN).alias("bin"))
        radii = _counted(placed.select("g", F.lit("d").alias("name"), "bin"), [SUBSET]).select("g", F.col("b0").alias("far"))
        groups = stage(_moments(placed.join(radii, "g").where("bin <= far")), "centres")
        now = groups.agg(F.bit_xor(F.xxhash64("g", *_M, *_C))).first()
        if now == mark:
            break
        mark = now
    return groups.join(rows.groupBy("g").agg(F.count("*").alias("n")), "g")


def estimates(rows: DataFrame) -> DataFrame:
    """Per language and source (lang, source, with the rows of ``rows``): centre m1.. and factor l11.., drawn towards their parents."""
    found = stage(determinants(stage(_groups(rows).select("g", *_X), "groups")), "determinants")

    def drawn(own: DataFrame, parent: DataFrame) -> DataFrame:
        weight = F.col("n") / (F.col("n") + PRIOR)
        both = own.join(parent.select(F.col("g").alias("pg"), *(F.col(c).alias(f"p{c}") for c in (*_M, *_C))), F.col("parent") == F.col("pg"))
        return both.select("g", "n", *(c for c in ("lang", "source") if c in own.columns),
                           *((weight * F.col(c) + (1 - weight) * F.col(f"p{c}")).alias(c) for c in (*_M, *_C)))

    names = rows.select("lang", "source").distinct().select("lang", "source", F.to_json(F.array("lang")).alias("glang"), F.to_json(F.array("lang", "source")).alias("gboth"))
    langs = names.select(F.col("glang").alias("g")).distinct().join(found, "g").withColumn("parent", F.lit("all"))
    langs = drawn(langs, found.where("g = 'all'"))
    both = names.withColumnRenamed("gboth", "g").join(found, "g").withColumnRenamed("glang", "parent")
    return _with_factor(drawn(both, langs)).drop("g", "n")


def judge(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Per document: the base statistics, base_failed, distance (null where the base rule failed), kept."""
    found = statistics(docs).withColumn("base_failed", base_failed())
    n, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    found = stage(found.select(
        "*", F.log1p("n_words").alias("x1"), F.log(chars / n).alias("x2"), F.log1p(100 * F.col("n_symbols") / chars).alias("x3"),
        (2 * F.col("n_repeat_words") / n).alias("x4")), "statistics")
    passed = found.where("not base_failed")
    centres = stage(estimates(passed), "estimates").withColumnsRenamed({"lang": "glang", "source": "gsource"})
    judged = passed.join(centres, passed["lang"].eqNullSafe(centres["glang"]) & passed["source"].eqNullSafe(centres["gsource"]))
    judged = judged.withColumn("distance", _distance([F.col(x) for x in _X]))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    failed = found.where("base_failed").select(*columns, F.lit(None).cast("double").alias("distance"))
    return judged.select(*columns, "distance").union(failed).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True)))

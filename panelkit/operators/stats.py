"""Descriptive statistics and tests.

Rules followed throughout: aggregates are algebraic (partial aggregation
map-side); quantiles go through ``exact_quantiles`` (bounded buffers);
global scalars (min/max/mean) are scalar subqueries, never a window without
a partition; ordering-dependent statistics (ranks, Q-Q positions) use a
bucketed prefix sum over distinct values instead of a global window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.normal import erfc, normal_quantile
from panelkit.operators.quantiles import exact_quantiles
from panelkit.session import materialize
from panelkit.operators.util import fitted


# ------------------------------------------------------------------ counts
def member_counts(df: DataFrame, dims: list[str]) -> DataFrame:
    """A1: rows per member of each dimension, one pass (dimension, member, n)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("member"))
                                for d in dims if d in df.columns])).alias("_d")
    return (df.select(pairs).select("_d.*").groupBy("dimension", "member")
              .agg(F.count(F.lit(1)).alias("n")))


def panel_shape(df: DataFrame, entity: str, period: str) -> DataFrame:
    """A2: row count, distinct counts and the sorted period list (bounded by
    the number of periods)."""
    return df.agg(
        F.count(F.lit(1)).alias("n_filas"),
        F.count_distinct(entity).alias("n_provincias"),
        F.count_distinct(period).alias("n_periodos"),
        F.sort_array(F.collect_set(period)).alias("periodos"),
        F.min(period).alias("periodo_min"),
        F.max(period).alias("periodo_max"),
    )


def coverage(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per column non-null count, null count, % null (1 dp) and
    % filled — one aggregation over all columns, then unpivot."""
    cols = cols or df.columns
    n = F.count(F.lit(1))
    aggs = [n.alias("_n")] + [F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("columna"), F.col(f"_c{i}").alias("no_nulos")) for i, c in enumerate(cols)
    ])).alias("_r")
    long = one.select("_n", rows).select("_n", "_r.*")
    return long.select(
        "columna", "no_nulos",
        (F.col("_n") - F.col("no_nulos")).alias("nulos"),
        F.round(F.try_divide((F.col("_n") - F.col("no_nulos")) * 100.0, F.col("_n")), 1).alias("pct_nulos"),
        F.try_divide(F.col("no_nulos") * 100.0, F.col("_n")).alias("pct_cobertura"),
    )


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A4: the columns that have nulls, most first, with the null cells of the
    whole table and their share (1 dp)."""
    cov = materialize(coverage(df, cols))  # a row per column
    total = fitted(cov, nulls=F.sum("nulos"), cells=F.sum(F.col("nulos") + F.col("no_nulos")))
    share = round(total["nulls"] * 100.0 / total["cells"], 1) if total["cells"] else None
    place = F.row_number().over(Window.orderBy(F.desc("pct_nulos"), F.desc("nulos"), "columna"))
    return cov.where("nulos > 0").select("columna", "nulos", "pct_nulos", place.alias("puesto"),
                                         F.lit(total["nulls"]).cast("long").alias("celdas_nulas"), F.lit(share).cast("double").alias("pct_celdas"))


def null_matrix(df: DataFrame, row: str, col: str, value_cols: list[str]) -> DataFrame:
    """A5: null cells per (row, col) cell, in long form."""
    nulls = sum((F.col(c).isNull().cast("int") for c in value_cols), F.lit(0))
    return df.groupBy(row, col).agg(F.sum(nulls).cast("bigint").alias("nulos"))


# ------------------------------------------------------------------ moments
def group_stats(df: DataFrame, by: list[str], value: str, dp: int | None = None) -> DataFrame:
    """N, mean, sample std, min, max and the mean ± std band."""
    v = F.col(value)
    out = df.groupBy(*by).agg(
        F.count(v).alias("n"), F.avg(v).alias("media"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("minimo"), F.max(v).alias("maximo"))
    out = out.withColumns({"banda_inf": F.col("media") - F.col("std"),
                           "banda_sup": F.col("media") + F.col("std")})
    if dp is not None:
        out = out.select(*by, "n", *[F.round(c, dp).alias(c) for c in
                                      ("media", "std", "minimo", "maximo", "banda_inf", "banda_sup")])
    return out


def pivot_matrix(df: DataFrame, row: str, col: str, value: str, members: list[str],
                 agg=F.avg) -> DataFrame:
    """Row x col matrix with an explicit member list (no distinct job)."""
    return df.groupBy(row).pivot(col, members).agg(agg(value))


def conditional_gap(df: DataFrame, by: list[str], member_col: str, a: str, b: str, value: str,
                    name: str, where: Column | None = None) -> DataFrame:
    """avg(value | member a) - avg(value | member b) per group;
    a group missing either member gives null (index-aligned subtraction)."""
    d = df if where is None else df.where(where)
    m = F.col(member_col)
    return d.groupBy(*by).agg(
        (F.avg(F.when(m == a, F.col(value))) - F.avg(F.when(m == b, F.col(value)))).alias(name))


def describe(df: DataFrame, cols: list[str], dp: int | None = 2) -> DataFrame:
    """Count, mean, std, min, quartiles, max per column (long format)."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("columna"), F.col(c).cast("double").alias("valor")) for c in cols
    ])).alias("_r")).select("_r.*")
    basic = long.groupBy("columna").agg(
        F.count("valor").alias("count"), F.avg("valor").alias("mean"), F.stddev_samp("valor").alias("std"),
        F.min("valor").alias("min"), F.max("valor").alias("max"))
    qs = exact_quantiles(long, ["columna"], "valor", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    out = basic.join(qs, "columna", "left")
    cols_out = ["mean", "std", "min", "q25", "q50", "q75", "max"]
    if dp is not None:
        # as array libraries round: the scaled double half to even, not its decimal digits
        out = out.select("columna", "count", *[(F.rint(F.col(c) * 10.0 ** dp) / 10.0 ** dp).alias(c) for c in cols_out])
    return out


def box_stats(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Quartiles and Tukey whiskers (most extreme value inside
    1.5·IQR) per group.  Quartiles first, then one more aggregation over the
    rows joined to their group's fences."""
    q = exact_quantiles(df, by, value, {"q1": 0.25, "mediana": 0.5, "q3": 0.75})
    q = q.withColumns({"iqr": F.col("q3") - F.col("q1")})
    q = q.withColumns({"lim_inf": F.col("q1") - 1.5 * F.col("iqr"),
                       "lim_sup": F.col("q3") + 1.5 * F.col("iqr")})
    v = F.col(value)
    j = df.select(*by, value).where(v.isNotNull()).join(q, by)
    inside = v.between(F.col("lim_inf"), F.col("lim_sup"))
    agg = j.groupBy(*by).agg(
        F.min(F.when(inside, v)).alias("bigote_inf"), F.max(F.when(inside, v)).alias("bigote_sup"),
        F.count_if(~inside).alias("n_atipicos"), F.count(F.lit(1)).alias("n"))
    return q.join(agg, by)


def histogram(df: DataFrame, value: str, bins: int = 25) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed; empty bins are
    kept with count 0.  min/max are scalar subqueries."""
    v = F.col(value)
    d = df.where(v.isNotNull())
    lim = fitted(d, lo=F.min(v), hi=F.max(v))
    lo, hi = F.lit(lim["lo"]).cast("double"), F.lit(lim["hi"]).cast("double")
    width = (hi - lo) / bins
    idx = F.least(F.floor(F.try_divide(v - lo, width)), F.lit(bins - 1))
    idx = F.coalesce(idx, F.lit(0)).cast("int")
    counts = d.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = (df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
             .withColumns({"desde": lo + F.col("bin") * width, "hasta": lo + (F.col("bin") + 1) * width}))
    return grid.join(counts, "bin", "left").select("bin", "desde", "hasta",
                                                   F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


# ------------------------------------------------------------ correlation
def corr_long(df: DataFrame, cols: list[str], listwise: bool = False) -> DataFrame:
    """Pearson r for every pair (lower triangle incl. diagonal), one
    aggregation.  Pair-wise complete by default; list-wise drops rows with
    any null first."""
    d = df.select(*cols)
    if listwise:
        d = d.dropna()
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[: i + 1]]
    one = d.agg(*[F.corr(a, b).alias(f"_r{k}") for k, (a, b) in enumerate(pairs)],
                *[F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1)).alias(f"_n{k}")
                  for k, (a, b) in enumerate(pairs)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"), F.col(f"_r{k}").alias("r"),
                 F.col(f"_n{k}").alias("n")) for k, (a, b) in enumerate(pairs)
    ])).alias("_p")
    return one.select(rows).select("_p.*")


def trend_lines(df: DataFrame, y: str, xs: list[str]) -> DataFrame:
    """Least-squares line y = a + b·x per variable (rows with both values)."""
    one = df.agg(*[F.regr_slope(F.col(y), F.col(x)).alias(f"_b{i}") for i, x in enumerate(xs)],
                 *[F.regr_intercept(F.col(y), F.col(x)).alias(f"_a{i}") for i, x in enumerate(xs)],
                 *[F.regr_count(F.col(y), F.col(x)).alias(f"_n{i}") for i, x in enumerate(xs)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(x).alias("variable"), F.col(f"_b{i}").alias("pendiente"),
                 F.col(f"_a{i}").alias("intercepto"), F.col(f"_n{i}").alias("n")) for i, x in enumerate(xs)
    ])).alias("_t")
    return one.select(rows).select("_t.*")


def iqr_outliers(df: DataFrame, value: str, k: float = 1.5) -> DataFrame:
    """Rows outside the Tukey fences, with fences, side and the overall
    outlier share.  Quartiles are one scalar-sized aggregate."""
    v = F.col(value)
    d = df.where(v.isNotNull())
    q = exact_quantiles(d, [], value, {"q1": 0.25, "q3": 0.75})
    qs = q.first()
    if qs is None or qs["q1"] is None:  # no value, no fences
        return d.where(F.lit(False)).withColumns({"lado": F.lit(""), "limite_inf": F.lit(0.0), "limite_sup": F.lit(0.0), "pct_atipicos": F.lit(0.0)})
    q1, q3 = qs["q1"], qs["q3"]
    lo = F.lit(q1 - k * (q3 - q1))
    hi = F.lit(q3 + k * (q3 - q1))
    cnt = fitted(d, o=F.count_if((v < lo) | (v > hi)), n=F.count(F.lit(1)))
    n_out, n_all = F.lit(cnt["o"]), F.lit(cnt["n"])
    return (d.where((v < lo) | (v > hi))
             .withColumns({"lado": F.when(v > hi, F.lit("alto")).otherwise(F.lit("bajo")),
                           "limite_inf": lo, "limite_sup": hi,
                           "pct_atipicos": n_out * 100.0 / n_all}))


# ------------------------------------------------------- ranks without a global window
#: Rows that one array of a tied value makes.
TIED = 10_000


def prefix_counts(counts: DataFrame, value: str, count_cols: list[str], ranges: int | None = None) -> DataFrame:
    """For a table with one row per distinct ``value`` and count columns,
    add ``below_<c>`` = sum of ``c`` over all smaller values.

    Distributed prefix sum: the values are dealt by range into as many
    partitions as Spark makes for their size (or ``ranges``), the totals of the
    ranges are summed up over those few rows, and the running sum inside a range
    is a window of that range alone.  No window ever spans all values."""
    dealt = counts.repartitionByRange(ranges, value) if ranges else counts.repartitionByRange(value)
    d = materialize(dealt.withColumn("_range", F.spark_partition_id()))
    tot = d.groupBy("_range").agg(*[F.sum(c).alias(f"_t_{c}") for c in count_cols])
    wb = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    tot = tot.select("_range", *[F.coalesce(F.sum(f"_t_{c}").over(wb), F.lit(0)).alias(f"_o_{c}") for c in count_cols])
    wi = Window.partitionBy("_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    d = d.join(F.broadcast(tot), "_range")  # one row per partition
    return d.select(*counts.columns, *[
        (F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(wi), F.lit(0))).alias(f"below_{c}") for c in count_cols])


def rank_sum_test(df: DataFrame, value: str, group: Column, ranges: int | None = None) -> DataFrame:
    """Mann-Whitney U (two-sided, normal approximation with tie and
    continuity correction).  ``group`` is a boolean column: True = sample 1.

    Tie-aware mid-ranks come from value-level counts: rank sum of sample 1 =
    Σ c1(v)·(below(v) + (t(v)+1)/2)."""
    v = F.col(value)
    d = df.where(v.isNotNull() & group.isNotNull()).select(v.cast("double").alias("_v"), group.alias("_g"))
    counts = d.groupBy("_v").agg(F.count_if("_g").alias("c1"), F.count_if(~F.col("_g")).alias("c2"))
    counts = counts.withColumn("t", F.col("c1") + F.col("c2"))
    ranked = prefix_counts(counts, "_v", ["t"], ranges)
    mid = F.col("below_t") + (F.col("t") + 1) / 2.0
    s = ranked.agg(F.sum(F.col("c1") * mid).alias("r1"), F.sum("c1").alias("n1"), F.sum("c2").alias("n2"),
                   F.sum(F.pow(F.col("t"), 3) - F.col("t")).alias("ties"))
    n1, n2, n = F.col("n1"), F.col("n2"), F.col("n1") + F.col("n2")
    u1 = F.col("r1") - n1 * (n1 + 1) / 2.0
    mu = n1 * n2 / 2.0
    sigma = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    u = F.greatest(u1, n1 * n2 - u1)
    z = F.try_divide(u - mu - 0.5, sigma)
    return s.select(n1.cast("bigint").alias("n1"), n2.cast("bigint").alias("n2"), u1.alias("u1"),
                    (n1 * n2 - u1).alias("u2"), z.alias("z"))


def two_sided_p(z: Column) -> Column:
    """P(|Z| >= z) of a standard normal variable."""
    return erfc(z / math.sqrt(2))


def normality_jb(df: DataFrame, value: str) -> DataFrame:
    """X6 (re-aimed): Jarque-Bera from population skewness and excess
    kurtosis; p-value = exp(-JB/2) (chi-square with 2 d.o.f.)."""
    v = F.col(value)
    s = df.agg(F.count(v).alias("n"), F.skewness(v).alias("asimetria"), F.kurtosis(v).alias("curtosis"))
    jb = F.col("n") / 6.0 * (F.pow("asimetria", 2) + F.pow("curtosis", 2) / 4.0)
    return s.withColumns({"jb": jb, "p_valor": F.exp(-jb / 2.0)})


def qq_positions(df: DataFrame, value: str, ranges: int | None = None) -> DataFrame:
    """X7 part 1: order statistics with Filliben plotting positions
    (1 - 0.5^(1/n) for the first, 0.5^(1/n) for the last,
    (i - 0.3175)/(n + 0.365) in between).  A tied value makes its rows in runs
    of ``TIED``, so that no array grows with its number."""
    v = F.col(value)
    d = df.where(v.isNotNull())
    counts = d.groupBy(v.cast("double").alias("valor")).agg(F.count(F.lit(1)).alias("c"))
    ranked = prefix_counts(counts, "valor", ["c"], ranges)
    n = d.select(F.count(F.lit(1))).scalar()
    first, last_i = F.col("below_c") + 1, F.col("below_c") + F.col("c")
    runs = ranked.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("c") - 1) / TIED))))
    start = first + F.col("_run") * TIED
    pos = runs.select("valor", F.explode(F.sequence(start, F.least(start + (TIED - 1), last_i))).alias("i"))
    last = F.pow(F.lit(0.5), F.lit(1.0) / n)
    m = (F.when(F.col("i") == 1, 1 - last).when(F.col("i") == n, last)
          .otherwise((F.col("i") - 0.3175) / (n + 0.365)))
    return pos.select(F.col("i").cast("bigint").alias("i"), "valor", m.alias("p"))


def qq_points(df: DataFrame, value: str, ranges: int | None = None) -> DataFrame:
    """Theoretical normal quantile per order statistic."""
    return qq_positions(df, value, ranges).withColumn("teorico", normal_quantile(F.col("p")))


def kde_grid(df: DataFrame, value: str, points: int = 100, by: list[str] | None = None) -> DataFrame:
    """Gaussian kernel density on an evenly spaced grid between the
    group's min and max, Scott bandwidth h = std·n^(-1/5).

    Values are first counted per distinct value (partial aggregation), then
    each distinct value adds count × kernel to every grid point through an
    array (no join); the grid sums are combined map-side."""
    by = by or []
    v = F.col(value)
    d = df.where(v.isNotNull())
    stats = [F.min(v).alias("_lo"), F.max(v).alias("_hi"), F.count(v).alias("_n"), F.stddev_samp(v).alias("_sd")]
    vals = d.groupBy(*by, v.alias("_x")).agg(F.count(F.lit(1)).alias("_c"))
    if by:
        s = d.groupBy(*by).agg(*stats)
        j = vals.join(s, by)
    else:  # one group: the four statistics come back as one row of literals
        one = d.agg(*stats).first()
        j = vals.select("_x", "_c", *[F.lit(one[c]).alias(c) for c in ("_lo", "_hi", "_n", "_sd")])
    j = j.withColumn("_h", F.col("_sd") * F.pow(F.col("_n").cast("double"), -0.2))
    step = (F.col("_hi") - F.col("_lo")) / (points - 1)
    grid = F.sequence(F.lit(0), F.lit(points - 1))
    pts = j.select(*by, "_n", "_h", "_lo", step.alias("_step"), F.posexplode(F.transform(
        grid, lambda g: F.col("_c") * F.exp(-0.5 * F.pow((F.col("_lo") + g * step - F.col("_x")) / F.col("_h"), 2)))
    ).alias("k", "_w"))
    norm = 1.0 / math.sqrt(2 * math.pi)
    return pts.groupBy(*by, "k").agg(
        F.max(F.col("_lo") + F.col("k") * F.col("_step")).alias("x"),
        (F.sum("_w") * norm / (F.max("_n") * F.max("_h"))).alias("densidad"))

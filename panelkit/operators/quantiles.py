"""Exact order statistics and quantiles without collecting a group into one task.

``percentile``/``median`` keep every distinct value of a group in one buffer,
which does not hold when one group carries a large share of the rows.  Here a
group is a *cell* (an open range of values, at first all of them) that is
narrowed by counts:

* a cell of up to ``AT_ONCE`` values is sorted as one bounded array, and the
  wanted ranks are read from it;
* a larger cell gets ``CUTS`` cut points from a bounded sketch.  Its values are
  counted per cut and per gap between cuts (a partial aggregation, skew-safe),
  running counts over those few numbers say where each wanted rank lies, and
  either that is a cut itself or the gap is the next cell.

The sketch only chooses where to cut: the counts are exact, so a poor cut costs
a further round and never a wrong value, and a cut with many equal values ends
at once.  Each round divides the cells by about ``CUTS``; only values of open
cells are looked at again.

Ranks may leave out a *part* of a group (all periods but one): its counts are
subtracted, so no row is repeated for the parts that it does not belong to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.session import materialize

#: Values that are sorted at once, cut points of a larger cell, and rows up to which a counted table is broadcast.
AT_ONCE, CUTS, FEW = 10_000, 64, 10_000


def _bounded(df: DataFrame) -> DataFrame:
    """``df``, a materialised table, with a broadcast hint if it is counted to be small."""
    return F.broadcast(df) if df.limit(FEW + 1).count() <= FEW else df


def _joined(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Join on equal ``cols``, null equal to null."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in cols})
    cond = None
    for c in cols:
        one = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        cond = one if cond is None else cond & one
    return left.join(renamed, cond, how).drop(*[f"_r_{c}" for c in cols])


def _kth(sorted_values: Column, rank: Column) -> Column:
    return F.get(sorted_values, rank.cast("int"))


def order_values(df: DataFrame, group_cols: list[str], value_col: str, ranks: DataFrame, sizes: DataFrame,
                 part_col: str | None = None) -> DataFrame:
    """``ranks`` (group..., [_part], rank) with ``value``: the value of that rank
    (from 0) among the group's non-null values, without those of the part
    ``_part`` if ``part_col`` is given.  ``sizes``: (group..., _n), the number of
    those values, materialised."""
    g, part = list(group_cols), ["_part"] if part_col else []
    rows = df.select(*g, F.col(value_col).cast("double").alias("_v"), *([F.col(part_col).alias("_part")] if part else [])).where("_v IS NOT NULL")
    open_cells = sizes.select(*g, F.lit("").alias("_cell"), F.lit(None).cast("double").alias("_lo"), F.lit(None).cast("double").alias("_hi"), "_n")
    targets = ranks.select(*g, *part, "rank", F.col("rank").alias("_at"), F.lit("").alias("_cell"))
    whole, found = True, []
    while True:
        small = open_cells.where(F.col("_n") <= AT_ONCE)
        all_small = not open_cells.where(F.col("_n") > AT_ONCE).limit(1).count()
        if whole and all_small:  # every group is one array
            inside = rows.withColumn("_cell", F.lit(""))
        else:
            inside = _inside(rows, _bounded(materialize(small)), g)
        lists = inside.groupBy(*g, "_cell").agg(F.sort_array(F.collect_list(F.struct("_v", *part))).alias("_l"))
        hit = _joined(targets, lists, [*g, "_cell"])
        values = F.filter("_l", lambda x: ~x["_part"].eqNullSafe(F.col("_part"))) if part else F.col("_l")
        found.append(hit.select(*g, *part, "rank", _kth(F.transform(values, lambda x: x["_v"]), F.col("_at")).alias("value")))
        if all_small:
            break
        targets, open_cells, done = _narrowed(rows, open_cells.where(F.col("_n") > AT_ONCE), targets, g, part)
        found.append(done)
        whole = False
        if not open_cells.limit(1).count():
            break
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


def _inside(rows: DataFrame, cells: DataFrame, g: list[str]) -> DataFrame:
    """The values of each cell."""
    in_cell = (F.col("_lo").isNull() | (F.col("_v") > F.col("_lo"))) & (F.col("_hi").isNull() | (F.col("_v") < F.col("_hi")))
    return _joined(rows, cells, g).where(in_cell)


def _narrowed(rows: DataFrame, cells: DataFrame, targets: DataFrame, g: list[str], part: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One round over the large cells: targets and cells that go on, and the values found."""
    cells = materialize(cells)
    inside = _inside(rows, _bounded(cells), g)
    points = F.array(*(F.lit((i + 1) / (CUTS + 1)) for i in range(CUTS)))
    cuts = inside.groupBy(*g, "_cell").agg(F.array_sort(F.array_distinct(F.percentile_approx("_v", points, 20 * CUTS))).alias("_cuts"))
    cuts = materialize(_joined(cells, cuts, [*g, "_cell"]))
    # gap i is below cut i and has number 2i, the cut itself 2i + 1
    below = F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
    place = 2 * below + F.array_contains("_cuts", F.col("_v")).cast("int")
    counted = _inside(rows, _bounded(cuts), g).groupBy(*g, *part, "_cell", place.alias("_place")).agg(F.count(F.lit(1)).alias("_c"))
    counted = materialize(counted)

    def per_place(counts: DataFrame, keys: list[str], name: str) -> DataFrame:
        return counts.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_place", "_c"))).alias(name))

    totals = per_place(counted.groupBy(*g, "_cell", "_place").agg(F.sum("_c").alias("_c")), [*g, "_cell"], "_total")
    t = _joined(_joined(targets, cuts, [*g, "_cell"]), totals, [*g, "_cell"])
    of = lambda name, i: F.coalesce(F.try_element_at(F.col(name), i), F.lit(0))
    left = lambda i: of("_total", i)
    if part:
        t = _joined(t, per_place(counted, [*g, *part, "_cell"], "_own"), [*g, *part, "_cell"], "left")
        left = lambda i: of("_total", i) - F.when(F.col("_own").isNull(), F.lit(0)).otherwise(of("_own", i))
    # the place where the running count passes the rank, and what is before it
    start = F.struct(F.lit(-1).alias("place"), F.lit(0).cast("long").alias("before"))
    walk = F.aggregate(F.sequence(F.lit(0), 2 * F.size("_cuts")), start, lambda s, i: F.when(s["place"] >= 0, s).when(
        F.col("_at") < s["before"] + left(i), F.struct(i.alias("place"), s["before"].alias("before"))).otherwise(
        F.struct(s["place"].alias("place"), (s["before"] + left(i)).alias("before"))))
    t = materialize(t.withColumn("_w", walk).select(
        *g, *part, "rank", "_cell", "_lo", "_hi", "_cuts", F.col("_w.place").alias("_place"), (F.col("_at") - F.col("_w.before")).alias("_at"),
        of("_total", F.col("_w.place")).alias("_n")))
    is_cut, i = F.col("_place") % 2 == 1, F.floor(F.col("_place") / 2).cast("int")
    done = t.where(is_cut).select(*g, *part, "rank", F.get("_cuts", i).alias("value"))
    going = t.where(~is_cut).withColumns({
        "_cell": F.concat("_cell", F.lit("."), F.col("_place").cast("string")),
        "_lo": F.when(i > 0, F.get("_cuts", i - 1)).otherwise(F.col("_lo")),
        "_hi": F.when(i < F.size("_cuts"), F.get("_cuts", i)).otherwise(F.col("_hi"))})
    return (going.select(*g, *part, "rank", "_at", "_cell"), materialize(going.select(*g, "_cell", "_lo", "_hi", "_n").distinct()), done)


def between(low: Column, high: Column, position: Column) -> Column:
    """Linear interpolation (type 7).  Equal ends first: the difference of two infinities is no number."""
    return F.when(low == high, low).otherwise(low + (high - low) * (position - F.floor(position)))


def exact_quantiles(df: DataFrame, group_cols: list[str], value_col: str, probs: dict[str, float]) -> DataFrame:
    """One row per group with one column per named probability, interpolated
    linearly between the ranks around ``p * (n - 1)``.

    Nulls are ignored; a group with no non-null value is absent (callers
    left-join when they need every group)."""
    g = list(group_cols)
    if not g:
        return exact_quantiles(df.select(F.lit(0).alias("_g"), value_col), ["_g"], value_col, probs).drop("_g")
    values = df.select(*g, F.col(value_col).cast("double").alias("_v")).where("_v IS NOT NULL")
    sizes = materialize(values.groupBy(*g).agg(F.count(F.lit(1)).alias("_n")))
    if not sizes.where(F.col("_n") > AT_ONCE).limit(1).count():  # every group is one array
        lists = values.groupBy(*g).agg(F.sort_array(F.collect_list("_v")).alias("_l"))
        position = {n: F.lit(float(p)) * (F.size("_l") - 1) for n, p in probs.items()}
        return lists.select(*g, *(between(_kth(F.col("_l"), F.floor(p)), _kth(F.col("_l"), F.ceil(p)), p).alias(n) for n, p in position.items()))
    place = {n: F.lit(float(p)) * (F.col("_n") - 1) for n, p in probs.items()}
    ranks = sizes.select(*g, F.explode(F.array_distinct(F.flatten(F.array(*(F.array(F.floor(p), F.ceil(p)) for p in place.values()))))).alias("rank"))
    found = order_values(values, g, "_v", ranks, sizes)
    by_rank = found.groupBy(*g).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("_r"))
    out = _joined(sizes, by_rank, g)
    return out.select(*g, *(between(F.element_at("_r", F.floor(p)), F.element_at("_r", F.ceil(p)), p).alias(n) for n, p in place.items()))


def medians_without(df: DataFrame, group_cols: list[str], value_col: str, part_col: str, parts: list) -> DataFrame:
    """(group..., part, median): per group and part the median of the group's
    values outside the part.  Every row is counted once, whatever the number of
    parts; a part that holds all values of a group has no row."""
    g = list(group_cols)
    values = df.select(*g, F.col(part_col).alias("_part"), F.col(value_col).cast("double").alias("_v")).where("_v IS NOT NULL")
    per_part = materialize(values.groupBy(*g, "_part").agg(F.count(F.lit(1)).alias("_own")))
    sizes = materialize(per_part.groupBy(*g).agg(F.sum("_own").alias("_n")))
    wanted = sizes.withColumn("_part", F.explode(F.array(*map(F.lit, parts))))
    wanted = _joined(wanted, per_part, [*g, "_part"], "left").withColumn("_rest", F.col("_n") - F.coalesce("_own", F.lit(0))).where("_rest > 0")
    position = 0.5 * (F.col("_rest") - 1)
    ranks = wanted.select(*g, "_part", "_rest", F.explode(F.array_distinct(F.array(F.floor(position), F.ceil(position)))).alias("rank"))
    found = order_values(values, g, "_v", ranks, sizes, "_part").groupBy(*g, "_part").agg(
        F.min_by("value", "rank").alias("_a"), F.max_by("value", "rank").alias("_b"), F.min("rank").alias("_ra"), F.max("rank").alias("_rb"))
    middle = F.when((F.col("_ra") == F.col("_rb")) | (F.col("_a") == F.col("_b")), F.col("_a")).otherwise(F.col("_a") + (F.col("_b") - F.col("_a")) * 0.5)
    return found.select(*g, F.col("_part").alias(part_col), middle.alias("median"))


def exact_median(df: DataFrame, group_cols: list[str], value_col: str, alias: str) -> DataFrame:
    return exact_quantiles(df, group_cols, value_col, {alias: 0.5})

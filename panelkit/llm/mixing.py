"""Mixing sources to target weights by Pfair scheduling.

A source's target weight is a whole number ``w`` of the ``W`` parts that all
sources have together (``PARTS`` of them, but for rounding). Its block ``j`` is
released at slot ``floor(j * W / w)`` and due by ``ceil((j + 1) * W / w)``. Slot
by slot the released, unplaced block with the earliest deadline (ties: the
smaller source) is placed. All deadlines are met, so after any number of slots
every source is within less than one block of its target share of them.

The slots are dealt in frames that know nothing of each other. By slot ``T`` a
source has had the ``floor(w * T / W)`` blocks that are due and perhaps the one
whose window holds ``T``. Of these open blocks earliest deadline first has left
out as many as the shares, rounded up, exceed ``T``: the latest deadlines come
first, and one may be left out while no slot ``t`` up to ``T`` has more left-out
blocks that were released before ``t`` than the shares at ``t``, rounded up,
exceed ``t``. So a frame finds what every source has had at its first slot from
the weights alone, looking back over the open windows (no longer than a frame,
as a frame has at least as many slots as the smallest source's window), and is
then dealt by one fold over its slots (``aggregate`` on arrays, inside Spark).
Every block finds its slot by one join.

Within a source, documents stand in the order of the md5 of their id (then of
their text), and a block is ``block_chars`` characters of that order: a
document belongs to the block in which it starts. The running lengths come from
two levels (ranges of the md5, then within a range), so a source with a third
of all rows is dealt over many tasks. Once a source has run out its slots stay
empty and the others go on; no row is dropped or repeated.

All of it is DataFrame and SQL functions. Defined results: a null source is a
source of its own (sorted first), a null text has no characters, rows that
agree in id and text stand next to each other, an empty table gives an empty
result. Sources without a given weight (above 0 and finite) have no slot and
follow after the mix; given weights of absent sources are ignored, those of a
source named twice are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ROW, column_of, packed, small, stage

#: Least slots of a frame.
FRAME = 128
#: Parts that the target weights are whole numbers of; with up to 2**32 blocks a source all products fit 64 bits (beyond, Spark reports an overflow).
PARTS = 1 << 30
#: Slots that a fold appends to one array, and that one task deals.
CHUNK, TASK_SLOTS = 512, 1 << 14
BLOCK_CHARS = 1 << 16
#: Weights when none are given: size ** ALPHA, which raises small sources.
ALPHA = 0.5
#: First hex digits of the md5 that name a range of a source's order.
RANGE_DIGITS = 3

def target_weights(sizes: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """(source, weight) from (source, chars)."""
    return sizes.select("source", F.pow(F.col("chars").cast("double"), F.lit(alpha)).alias("weight"))


def frames_of(weights: DataFrame, frame: int = FRAME) -> DataFrame:
    """(all, w, total, at, upto): every frame's first slot and the slot after its last, the sources and their
    parts. Frames go on until every source has had its ``blocks``.
    ``weights`` (source, weight, blocks) has a row per source, of which there are few; they meet in one row."""
    given = weights.where("weight > 0 AND weight < double('Infinity')").groupBy("source").agg(F.sum("weight").alias("weight"), F.max("blocks").alias("blocks"))
    row = given.groupBy().agg(F.array_sort(F.collect_list(F.struct(F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNotNull().alias("given"),
                                                                   "source", "weight", "blocks"))).alias("all")).where("size(all) > 0")
    row = row.selectExpr("all", f"""transform(array(aggregate(all, 0D, (a, x) -> a + x.weight)), weight ->
      transform(all, x -> greatest(CAST(round(x.weight / weight * {PARTS}) AS BIGINT), 1L)))[0] AS w""")
    row = row.selectExpr("all", "w", "aggregate(w, 0L, (a, x) -> a + x) AS total")
    row = row.selectExpr("*", "array_max(zip_with(all, w, (x, part) -> (x.blocks * total + part - 1) DIV part)) AS slots", "(total - 1) DIV array_min(w) + 1 AS widest")
    row = stage(row.selectExpr("*", f"greatest({int(frame)}L, least(slots, widest)) AS width"), "parts")
    slots = row.agg(F.coalesce(F.max("slots"), F.lit(0))).first()[0]
    frames = row.selectExpr("all", "w", "total", "slots", "width", "explode(sequence(0L, (slots - 1) DIV width)) AS f")
    return frames.repartition(slots // TASK_SLOTS + 1, "f").selectExpr("all", "w", "total", "f * width AS at", "least((f + 1) * width, slots) AS upto")


def started(frames: DataFrame) -> DataFrame:
    """``frames`` with ``done``: the blocks that each source has had before the frame's first slot."""
    opened = """filter(transform(w, (x, i) -> IF(x * at % total = 0, NULL, struct(
      ((x * at DIV total + 1) * total + x - 1) DIV x AS due, i AS i, (x * at DIV total) * total DIV x AS released))), x -> x IS NOT NULL)"""
    # how far the rounded-up shares exceed each slot of the open windows, and the least of it from each release on
    over = "transform(sequence(low + 1, at), t -> aggregate(w, -t, (a, x) -> a + (x * t + total - 1) DIV total))"
    room = """transform(opened, x -> struct(x.released AS released,
      array_min(slice(over, CAST(x.released - low + 1 AS INT), CAST(at - x.released AS INT))) AS most))"""
    left_out = """aggregate(reverse(array_sort(opened)), struct(transform(room, r -> 0L) AS used, CAST(array() AS ARRAY<INT>) AS i),
      (s, x) -> IF(forall(zip_with(room, s.used, (r, n) -> r.released < x.released OR n < r.most), fits -> fits),
        struct(zip_with(room, s.used, (r, n) -> n + IF(r.released >= x.released, 1L, 0L)) AS used, concat(s.i, array(x.i)) AS i), s),
      s -> s.i)"""
    done = "transform(w, (x, i) -> x * at DIV total + IF(x * at % total = 0 OR array_contains(left_out, i), 0L, 1L))"
    # each name is bound once: a column used in a function of elements would be worked out again for each of them
    for name, value in (("left_out", left_out), ("room", room), ("over", over), ("low", "coalesce(array_min(opened.released), at - 1)"), ("opened", opened)):
        done = f"transform(array({value}), {name} -> {done})[0]"
    return frames.selectExpr("*", f"{done} AS done")


def block_slots(frames: DataFrame) -> DataFrame:
    """(source, block, slot) of every block that a source has, from ``frames_of``."""
    none = "CAST(array() AS ARRAY<STRUCT<i: INT, block: BIGINT>>)"
    # deadlines of the released blocks, and the source of the earliest
    place = """transform(array(transform(s.done, (d, i) -> IF(d * total DIV w[i] <= t, ((d + 1) * total + w[i] - 1) DIV w[i], NULL))), due ->
      transform(array(CAST(array_position(due, array_min(due)) - 1 AS INT)), k ->
        struct(transform(s.done, (d, i) -> IF(i = k, d + 1, d)) AS done, concat(s.out, array(struct(k AS i, s.done[k] AS block))) AS out))[0])[0]"""
    chunk = f"aggregate(sequence(at + c * {CHUNK}, least(upto, at + (c + 1) * {CHUNK}) - 1), struct(r.done AS done, {none} AS out), (s, t) -> {place})"
    dealt = f"""aggregate(sequence(0L, (upto - at - 1) DIV {CHUNK}), struct(done, {none} AS out),
      (r, c) -> transform(array({chunk}), s -> struct(s.done AS done, concat(r.out, s.out) AS out))[0], r -> r.out)"""
    cells = started(frames).selectExpr("all", "at", f"{dealt} AS dealt").selectExpr("all", "at", "posexplode(dealt) AS (place, cell)")
    return cells.where("cell.block < all[cell.i].blocks").selectExpr("all[cell.i].source AS source", "cell.block AS block", "at + place AS slot")


def order_key(doc_id: Column, text: Column) -> Column:
    """What the documents of a source are ordered by."""
    return F.concat(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")),
                    F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def schedule(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
             frame: int = FRAME, block_chars: int = BLOCK_CHARS, alpha: float = ALPHA) -> DataFrame:
    """Every row's place in the mix: (doc_id, source, chars, start_char, block, slot, key).
    The mix is ordered by (slot, source, start_char, key); ``weights`` is (source, weight)."""
    text = column_of(docs, text_col).cast("string")
    key = order_key(column_of(docs, id_col), text)
    rows = docs.select(column_of(docs, id_col).alias("doc_id"), column_of(docs, source_col).cast("string").alias("source"),
                       F.coalesce(F.length(text), F.lit(0)).cast("long").alias("chars"), key.alias("key"))
    rows = stage(rows.withColumn("range", F.substring("key", 1, RANGE_DIGITS)), "mix")

    # running lengths: of the ranges first, then within each
    ranges = stage(rows.groupBy("source", "range").agg(F.sum("chars").alias("chars")), "ranges")
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(F.col("source").alias("s"), F.col("range").alias("r"), F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("range_start"))
    within = Window.partitionBy("source", "range").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("chars").over(within), F.lit(0)))
    placed = placed.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r"))).drop("s", "r")
    placed = placed.withColumn("start_char", F.col("range_start") + F.col("before"))
    placed = placed.withColumn("block", F.expr(f"start_char DIV {int(block_chars)}"))

    sizes = ranges.groupBy("source").agg(F.sum("chars").alias("chars"))
    if weights is None:
        weights = target_weights(sizes, alpha)
    blocks = sizes.select(F.col("source").alias("s"), F.expr(f"chars DIV {int(block_chars)} + 1").alias("blocks"))
    weights = weights.join(blocks, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    cells = small(stage(block_slots(frames_of(weights, frame)), "slots")).select(F.col("source").alias("s"), F.col("block").alias("b"), "slot")
    placed = placed.join(cells, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")), "left")
    return placed.select("doc_id", "source", "chars", "start_char", "block", "slot", "key")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The rows of ``docs``, unchanged, sorted over all partitions into the order of the mix."""
    rows = packed(docs, key=order_key(column_of(docs, id_col), column_of(docs, text_col).cast("string")))
    places = schedule(docs, id_col=id_col, text_col=text_col, **params).groupBy("key").agg(F.min(F.struct(
        F.col("slot").isNull().alias("late"), "slot", F.col("source").isNotNull().alias("given"), "source", "start_char")).alias("place"))
    return rows.join(places, "key").orderBy("place", "key").select(f"{ROW}.*")

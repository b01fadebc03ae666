"""Conversation prefix trie from composable fingerprints.

Every conversation ``c`` is rebuilt from the head of its base ``c - c % 5`` (the
first ``h`` turns of it) and its own turns after the first ``h``, with ``h`` the
crc32 of its number modulo 9. The rebuilt turns are never written out: a turn
sequence is an element (n, g) of the monoid

    (n1, g1) . (n2, g2) = (n1 + n2, g1 + B**n1 * g2)        modulo p, per component

in which the element of one turn is (1, x) with ``x`` from the md5 of its role and
text. Every stored conversation gets the products of all its prefixes once, as
running sums of ``x * B**place``; the product of an own suffix is a difference of
two of them times a power of B, and a rebuilt prefix is base head . own suffix.
What moves is (conversation, depth, four 31-bit residues, a reference to the stored
turn), whatever the length of the texts.

Equality is verified, not trusted. The stored turns are grouped by md5 and
compared by role and text; and every prefix group is checked for one parent group
and one last turn (by its stored reference): by induction over the depth all
members of a group then hold the same turns. If a check fails, hashes and bases
are drawn anew and the fingerprints are made again.

Running sums go over the sorted table in two levels (runs of ``RUN`` turns, then
within a run), so one conversation with a third of all rows spreads over many
tasks. Sums over subtrees take log2(depth) rounds: in round k every node passes
what it has gathered to its ancestor 2**k levels up, which is the group of its own
representative at that depth, a join on unique (conversation, depth). The list of
the conversations that end in a node is joined piece by piece (``WIDTH`` numbers a
piece), and a SHA-256 is led over a node's pieces one after another; no list of a
node's members is ever held in one place.

Defined results: turns stand by number, null first; turns of one number in the
order of the md5 of their role and text. Null role or text is empty. A row
without conv_id belongs to no conversation and is not in the trie. Numbers may
be negative (``%`` keeps the sign: the base is the multiple of 5 towards zero).
Repeated rows are repeated turns. An empty table has no nodes. Other columns,
whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import column_of, stage

#: Modulus of each component (2**31 - 1: a product of two residues fits in 64 bits), and components.
P, COMPONENTS = (1 << 31) - 1, 4
BASE_EVERY, HEADS = 5, 9
RUN = 1024
WIDTH = 4096
#: 16-way digits of a place, so places below 2**40.
_DIGITS = 10


def bases(salt: int, p: int) -> list[int]:
    """One base per component, others for every salt."""
    return [int.from_bytes(hashlib.sha256(f"{salt} {k}".encode()).digest()[:8], "big") % (p - 2) + 2 for k in range(COMPONENTS)]


def power(base: int, exponent: Column, p: int) -> Column:
    """base ** exponent modulo p, for 0 <= exponent < 16 ** 10."""
    out = None
    for digit in range(_DIGITS):
        steps = F.array(*(F.lit(pow(base, k << (4 * digit), p)).cast("long") for k in range(16)))
        factor = F.element_at(steps, (F.shiftrightunsigned(exponent, 4 * digit).bitwiseAND(F.lit(15)) + 1).cast("int"))
        out = factor if out is None else out * factor % p
    return out


def head_length(conv: Column) -> Column:
    return (F.crc32(conv.cast("string").cast("binary")) % HEADS).cast("long")


def _content(role: Column, text: Column, salt: int) -> Column:
    """What a turn's md5 is taken of; its role cannot run into its text."""
    return F.concat(F.lit(f"{salt} " if salt else ""), F.length(role).cast("string"), F.lit(":"), role, text)


def _halves(md5: Column) -> list[Column]:
    return [F.conv(F.substring(md5, 1 + 16 * k, 15), 16, 10).cast("long") for k in range(2)]


def stored_turns(conversations: DataFrame, salt: int = 0, p: int = P, run: int = RUN) -> DataFrame:
    """Every row with its place (from 1) and the products of the prefixes before and through it:
    (conv, place, at, key, n_bytes, x, before, through), written. ``key``: two halves of the turn's md5."""
    role, text = (F.coalesce(column_of(conversations, c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(column_of(conversations, "conv_id").cast("long").alias("conv"), column_of(conversations, "turn").alias("turn"),
                                F.md5(_content(role, text, 0).cast("binary")).alias("order"),
                                F.md5(_content(role, text, salt).cast("binary")).alias("md5"), F.octet_length(text).cast("long").alias("n_bytes"))
    rows = rows.where("conv IS NOT NULL").repartitionByRange("conv", "turn", "order").sortWithinPartitions("conv", "turn", "order")
    rows = rows.select("conv", F.monotonically_increasing_id().alias("at"), F.struct(*(h.alias(f"k{i}") for i, h in enumerate(_halves(F.col("md5"))))).alias("key"), "n_bytes",
                       *(((F.conv(F.substring("md5", 1 + 8 * i, 8), 16, 10).cast("long") % p)).alias(f"x{i}") for i in range(COMPONENTS)))
    rows = stage(rows.withColumn("run", F.expr(f"at DIV {int(run)}")), "turns")

    # places: turns of the conversation's runs before this one, then the place within the run
    within = Window.partitionBy("conv", "run").orderBy("at")
    over_runs = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("conv", "run").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("conv", "run", F.coalesce(F.sum("n").over(over_runs), F.lit(0)).alias("earlier"))
    placed = rows.join(counts, ["conv", "run"]).withColumn("place", F.row_number().over(within) + F.col("earlier"))
    b = bases(salt, p)
    # the element of a turn at its place: x * B ** (place - 1)
    terms = [(F.col(f"x{i}") * power(b[i], F.col("place") - 1, p) % p).alias(f"x{i}") for i in range(COMPONENTS)]
    placed = stage(placed.select("conv", "run", "at", "place", "key", "n_bytes", *terms), "terms")
    sums = placed.groupBy("conv", "run").agg(*((F.sum(f"x{i}") % p).alias(f"x{i}") for i in range(COMPONENTS)))
    starts = sums.select("conv", "run", *(F.coalesce(F.sum(f"x{i}").over(over_runs), F.lit(0)).alias(f"s{i}") for i in range(COMPONENTS)))
    up_to = within.rowsBetween(Window.unboundedPreceding, 0)
    products = placed.join(starts, ["conv", "run"]).select(
        "conv", "place", "key", "n_bytes", *(f"x{i}" for i in range(COMPONENTS)), *(((F.sum(f"x{i}").over(up_to) + F.col(f"s{i}")) % p).alias(f"g{i}") for i in range(COMPONENTS)))
    return stage(products.select("conv", "place", "key", "n_bytes", F.array(*((F.col(f"g{i}") - F.col(f"x{i}") + p) % p for i in range(COMPONENTS))).alias("before"),
                                 F.array(*(f"g{i}" for i in range(COMPONENTS))).alias("through")), "products")


def turn_clash(conversations: DataFrame, salt: int = 0) -> bool:
    """Whether two different stored turns have one md5: the different turns are compared by role and text."""
    role, text = (F.coalesce(column_of(conversations, c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.select(F.md5(_content(role, text, salt).cast("binary")).alias("md5"), role.alias("role"), text.alias("text")).distinct()
    return turns.groupBy("md5").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count() > 0


def _packed(parts: list[Column]) -> Column:
    """Four residues below 2**31 in two numbers."""
    return F.struct(*((parts[k] * (1 << 31) + parts[k + 1]).alias(f"f{k // 2}") for k in range(0, COMPONENTS, 2)))


def rebuilt(turns: DataFrame, salt: int = 0, p: int = P) -> tuple[DataFrame, DataFrame]:
    """(conv, n_turns) of every rebuilt conversation, and a row per rebuilt prefix of one turn or more:
    (conv, depth, parent, f, key, n_bytes, turn_conv, turn_place), the last two a reference to the stored turn.
    ``f`` is the product of base head and own suffix, ``parent`` the same one turn earlier."""
    b = bases(salt, p)
    h = head_length(F.col("conv"))
    # per stored conversation: its length and the product of its own first h turns
    stored = stage(turns.groupBy("conv").agg(F.max("place").alias("len")), "lengths")
    own_heads = turns.where(F.col("place") == h).select("conv", F.col("through").alias("own_head"))
    convs = stored.join(own_heads, "conv", "left").select("conv", "len", "own_head", h.alias("h"), (F.col("conv") - F.col("conv") % BASE_EVERY).alias("base"))
    heads = turns.where(f"place < {HEADS} AND conv % {BASE_EVERY} = 0")
    # the base's head of exactly the length that is used: min(h, its length)
    base_len = stored.select(F.col("conv").alias("base"), F.col("len").alias("base_len"))
    convs = convs.join(base_len, "base", "left").withColumn("hb", F.least("h", F.coalesce("base_len", F.lit(0))))
    ends = heads.select(F.col("conv").alias("base"), F.col("place").alias("hb"), F.col("through").alias("base_head"))
    zero = F.array(*[F.lit(0).cast("long")] * COMPONENTS)
    convs = convs.join(ends, ["base", "hb"], "left").select(
        "conv", "len", "h", "base", "hb", F.coalesce("base_head", zero).alias("base_head"), F.coalesce("own_head", zero).alias("own_head"))
    convs = stage(convs, "convs")
    lengths = convs.select("conv", (F.col("hb") + F.greatest(F.col("len") - F.col("h"), F.lit(0))).alias("n_turns"))

    def residues(name: str) -> Column:
        return _packed([F.col(name)[k] for k in range(COMPONENTS)])

    from_base = heads.withColumnRenamed("conv", "base").join(convs.select("conv", "base", "hb"), "base").where("place <= hb")
    from_base = from_base.select("conv", F.col("place").alias("depth"), residues("before").alias("parent"), residues("through").alias("f"),
                                 "key", "n_bytes", F.col("base").alias("turn_conv"), F.col("place").alias("turn_place"))
    # own turns behind the head: (g - own head) moved from place h to place hb, behind the base's head
    own = turns.join(convs.select("conv", "h", "hb", "base_head", "own_head"), "conv").where("place > h")

    def moved(name: str) -> Column:
        out = []
        for k in range(COMPONENTS):
            back = F.element_at(F.array(*(F.lit(pow(pow(b[k], -1, p), d, p)).cast("long") for d in range(HEADS))), (F.col("h") - F.col("hb") + 1).cast("int"))
            own_part = (F.col(name)[k] - F.col("own_head")[k] + p) % p * back % p
            out.append((F.col("base_head")[k] + own_part) % p)
        return _packed(out)

    own = own.select("conv", (F.col("place") - F.col("h") + F.col("hb")).alias("depth"), moved("before").alias("parent"), moved("through").alias("f"),
                     "key", "n_bytes", F.col("conv").alias("turn_conv"), F.col("place").alias("turn_place"))
    return lengths, from_base.union(own)


def _prefix_groups(prefixes: DataFrame) -> DataFrame:
    """(depth, f, conv_id, n_convs, n_bytes, mixed, last_turn) of every group of equal prefixes; ``mixed``: its
    members differ in their parent's group or their last turn; ``last_turn``: the stored turn of the smallest member."""
    whole = [("parent.f0", "a"), ("parent.f1", "b"), ("key.k0", "c"), ("key.k1", "d"), ("n_bytes", "e")]
    rows = prefixes.select("depth", F.col("f.f0").alias("f0"), F.col("f.f1").alias("f1"), "conv", *(F.col(c).alias(a) for c, a in whole))
    out = rows.groupBy("depth", "f0", "f1").agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("e").alias("n_bytes"),
        *(F.min(a).alias(f"min_{a}") for _, a in whole), *(F.max(a).alias(f"max_{a}") for _, a in whole))
    mixed = F.lit(False)
    for _, a in whole:
        mixed = mixed | (F.col(f"min_{a}") != F.col(f"max_{a}"))
    return out.select("depth", "f0", "f1", "conv_id", "n_convs", "n_bytes", mixed.alias("mixed"))


def verified_prefixes(conversations: DataFrame, p: int = P, run: int = RUN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lengths and prefixes of ``rebuilt`` and the groups of equal prefixes, written, with fingerprints that
    hold every check. ``p`` (a prime) is the first modulus to be tried; after a failed check it is ``P``, with another salt."""
    salt = 0
    while True:
        if not turn_clash(conversations, salt):
            lengths, prefixes = rebuilt(stored_turns(conversations, salt, p, run), salt, p)
            prefixes = stage(prefixes, "prefixes")
            nodes = stage(_prefix_groups(prefixes), "groups")
            if not nodes.where("mixed").limit(1).count():
                return stage(lengths, "lengths"), prefixes, nodes.drop("mixed")
        salt, p = salt + 1, P


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of a node, which come one after another."""
    node, state = None, None
    for batch in batches:
        out = []
        for depth, conv, piece in zip(*(batch.column(c).to_pylist() for c in ("depth", "conv_id", "piece"))):
            if (depth, conv) != node:
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = (depth, conv), hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.encode())
        if out:
            yield _digest_batch(out)
    if node is not None:
        yield _digest_batch([(*node, state.hexdigest())])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    d, c, s = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(c, pa.int64()), pa.array(s, pa.string())], ["depth", "conv_id", "ends_sha256"])


def end_digests(ends: DataFrame, width: int = WIDTH) -> DataFrame:
    """(depth, conv_id, ends_sha256) from (depth, conv_id, conv): the digest of the comma-joined numbers in ascending order."""
    pieces = ends.withColumn("part", F.expr(f"(conv - pmod(conv, {int(width)})) DIV {int(width)}")).groupBy("depth", "conv_id", "part").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("piece"))
    pieces = pieces.repartition("depth", "conv_id").sortWithinPartitions("depth", "conv_id", "part")
    return pieces.select("depth", "conv_id", "piece").mapInArrow(_digests, "depth long, conv_id long, ends_sha256 string")


def trie(conversations: DataFrame, p: int = P, run: int = RUN, width: int = WIDTH) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and the
    stored turn it ends in (turn_conv_id, turn_place from 1; null for the root), by which its text can be looked up."""
    lengths, prefixes, nodes = verified_prefixes(conversations, p, run)
    root = lengths.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    top = F.lit(lengths.agg(F.min("conv")).first()[0]).cast("long")

    # group of every prefix, named by its smallest member; the root's prefix is of depth 0
    named = prefixes.select("conv", "depth", F.col("f.f0").alias("f0"), F.col("f.f1").alias("f1"), "turn_conv", "turn_place")
    named = named.join(nodes.select("depth", "f0", "f1", "conv_id"), ["depth", "f0", "f1"])
    named = stage(named.select("conv", "depth", "conv_id", "turn_conv", "turn_place"), "named")

    def above(rows: DataFrame, steps: int) -> DataFrame:
        """``rows`` (conv_id, depth >= steps, ...) with ``up``: the smallest member of the node ``steps`` higher."""
        inner = rows.where(F.col("depth") > steps).join(
            named.select(F.col("conv").alias("conv_id"), (F.col("depth") + steps).alias("depth"), F.col("conv_id").alias("up")), ["conv_id", "depth"])
        return inner.select(*rows.columns, "up").union(rows.where(F.col("depth") == steps).select(*rows.columns, top.alias("up")))

    own = nodes.select("conv_id", "depth", "n_convs", "n_bytes")
    own = stage(above(own, 1).union(root.select("conv_id", F.lit(0).cast("long").alias("depth"), "n_convs", F.lit(0).cast("long").alias("n_bytes"),
                                                F.lit(None).cast("long").alias("up"))), "nodes")
    children = own.where("depth > 0").groupBy(F.col("up").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    own = stage(own.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "children")

    gathered = own.select("conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                          ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"))
    deepest = own.agg(F.max("depth")).first()[0] or 0
    steps = 1
    while steps <= deepest:
        lifted = above(gathered, steps).select(F.col("up").alias("conv_id"), (F.col("depth") - steps).alias("depth"), "n_leaves", "saved_tokens")
        gathered = stage(gathered.union(lifted).groupBy("conv_id", "depth").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")), "sums")
        steps *= 2

    ends = lengths.where("n_turns > 0").join(named.select("conv", F.col("depth").alias("n_turns"), "conv_id"), ["conv", "n_turns"])
    ends = ends.select(F.col("n_turns").alias("depth"), "conv_id", "conv").union(
        lengths.where("n_turns = 0").select(F.lit(0).cast("long"), top, "conv"))
    last = named.where("conv = conv_id").select("conv_id", "depth", F.col("turn_conv").alias("turn_conv_id"), "turn_place")
    return (own.join(gathered, ["conv_id", "depth"]).join(end_digests(ends, width), ["conv_id", "depth"], "left").join(last, ["conv_id", "depth"], "left")
            .select("conv_id", "depth", F.col("up").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"), "turn_conv_id", "turn_place"))

"""Prefix trie of conversations and its subtree totals by parallel tree contraction.

``rebuilt`` replaces the first h turns of a conversation (0 to 5, by a hash of its id) by those of the first
conversation of its hundred; ``trie`` makes a node of every distinct sequence of first turns; ``subtree_totals`` adds up
values over all subtrees of any forest. A round of it rakes (a leaf's total is final and goes to its parent) and
compresses (of the chains of nodes with one child, every node whose id is less than its chain neighbours' is spliced out,
its value going up with its child's). About a third of a chain and all leaves go each round, so rounds grow with the
logarithm of the nodes, not with the depth. Spliced nodes then point to the child they had; pointers are doubled until
they reach raked nodes, whose totals give theirs.

A node is named by 128 bits: the exclusive or, over its turns, of a hash of place, role and text. Two sequences among n
nodes get one name with probability n**2 / 2**129. So texts are read once, are hashed and counted there, and are never
shuffled. Turns are sorted by ranges of (conversation, turn, ...) and numbered in runs, the rows of one conversation in
one range; what runs before a run amount to is added from one row per run. A conversation with a third of all turns is
spread over many tasks, and so are the members that end at one node: their ids are joined in pieces, range by range, and
only the pieces are hashed in order, as a stream.

Defined results: null roles and texts are empty; rows without a conversation id belong to none; equal turn numbers (null
first) go by role, the first 64 characters of the text and a digest of role and text, so repeated rows are as many turns;
the hundred of a negative id is counted towards 0; very long texts and conversations only cost their own length; an empty
table has no node, not even a root; other columns are not read.
"""

from __future__ import annotations

import math
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import Tables, partitions

HUNDRED = 100
HEADS = 6  # first turns that may be replaced: fewer than this many
PIECE = 4096  # ids joined into one text

_BEFORE = (Window.unboundedPreceding, -1)
_SO_FAR = (Window.unboundedPreceding, 0)


def _tag(lane: int, depth: Column, digest: Column) -> Column:
    return F.xxhash64(F.lit(lane), depth, digest)


def _xor(a: Column | str, b: Column | str) -> Column:
    return F.coalesce(a, F.lit(0).cast("long")).bitwiseXOR(F.coalesce(b, F.lit(0).cast("long")))


def sorted_turns(conversations: DataFrame, tables: Tables) -> DataFrame:
    """(conv_id, part, id, digest, chars), stored: turns in order of id, in runs (conv_id, part)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.substring(text, 1, 64).alias("start"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit("|"), role, text)).alias("digest"),
        F.length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("row"),
    )
    # The row number lets a range end between repeated rows.
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), "role", "start", "digest", "row"]
    ordered = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    part = F.spark_partition_id().alias("part")
    return tables.store(ordered.select("conv_id", part, F.monotonically_increasing_id().alias("id"), "digest", "chars"), "turns")


def rebuilt(conversations: DataFrame, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """Rows (conv_id, depth, a, b, pa, pb, chars), one per turn of a rebuilt conversation, with the names of its node and
    of the node above; and (conv_id, a, b), the node at which each conversation ends."""
    turns = sorted_turns(conversations, tables)
    across = Window.partitionBy("conv_id")
    runs = turns.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "part", F.coalesce(F.sum("n").over(across.orderBy("part").rowsBetween(*_BEFORE)), F.lit(0)).alias("before"),
        F.sum("n").over(across).alias("total"),
    )
    runs = tables.store(runs, "runs")
    convs = runs.where("before = 0").select(
        "conv_id", "total", (F.crc32(F.col("conv_id").cast("string")) % HEADS).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % HUNDRED).alias("base"),
    )
    bases = convs.select(F.col("conv_id").alias("of"), F.col("total").alias("base_total"))
    convs = convs.join(bases, F.col("base") == F.col("of"), "left").drop("of")
    convs = convs.withColumn("k", F.least("h", F.coalesce("base_total", F.lit(0)))).drop("base_total")
    convs = tables.store(convs, "convs")

    # Place of every turn, and its hash at the place it gets; the exclusive or runs over the turns that stay.
    known = runs.join(convs.select("conv_id", "h", "k"), "conv_id")
    in_run = Window.partitionBy("conv_id", "part").orderBy("id")
    placed = turns.join(known, ["conv_id", "part"]).withColumn("place", F.col("before") + F.row_number().over(in_run))
    stays = F.col("place") > F.col("h")
    placed = placed.withColumn("depth", F.when(stays, F.col("place") - F.col("h") + F.col("k")).otherwise(F.col("place")))
    placed = placed.withColumns({f"tag_{x}": _tag(i, F.col("depth"), F.col("digest")) for i, x in enumerate("ab")})
    runs_on = in_run.rowsBetween(*_SO_FAR)
    placed = placed.withColumns({f"run_{x}": F.bit_xor(F.when(stays, F.col(f"tag_{x}"))).over(runs_on) for x in "ab"})
    placed = placed.select("conv_id", "part", "depth", "chars", "tag_a", "tag_b", "run_a", "run_b", stays.alias("stays"), (F.col("place") == F.col("total")).alias("last"))
    placed = tables.store(placed, "placed")

    # First turns of each hundred's first conversation, at most HEADS - 1 of them: h of them go to every member of it.
    first = placed.where((F.col("conv_id") % HUNDRED == 0) & (F.col("depth") < HEADS))
    up = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(*_SO_FAR)
    heads = first.select(
        F.col("conv_id").alias("of"), "depth", "chars", *[F.bit_xor(f"tag_{x}").over(up).alias(x) for x in "ab"], "tag_a", "tag_b"
    )
    heads = tables.store(heads, "heads")
    above = [_xor(x, f"tag_{x}").alias(f"p{x}") for x in "ab"]
    given = convs.join(heads, (F.col("base") == F.col("of")) & (F.col("depth") <= F.col("h")))
    given = given.select("conv_id", "depth", "a", "b", *above, "chars")

    # Where a conversation's own turns begin, run by run.
    at = heads.select("of", F.col("depth").alias("at"), "a", "b")
    starts = convs.join(at, (F.col("base") == F.col("of")) & (F.col("k") == F.col("at")), "left")
    starts = tables.store(starts.select("conv_id", "total", "h", *[F.coalesce(x, F.lit(0)).alias(x) for x in "ab"]), "starts")
    own = placed.where("stays")
    of_runs = own.groupBy("conv_id", "part").agg(*[F.bit_xor(f"tag_{x}").alias(x) for x in "ab"])
    earlier = across.orderBy("part").rowsBetween(*_BEFORE)
    leads = of_runs.select("conv_id", "part", *[F.bit_xor(x).over(earlier).alias(f"lead_{x}") for x in "ab"])
    leads = leads.join(starts, "conv_id").select("conv_id", "part", *[_xor(f"lead_{x}", x).alias(f"lead_{x}") for x in "ab"])
    own = own.join(leads, ["conv_id", "part"]).withColumns({x: _xor(f"lead_{x}", f"run_{x}") for x in "ab"})
    own = tables.store(own.select("conv_id", "depth", "a", "b", *above, "chars", "last"), "own")

    ends = own.where("last").select("conv_id", "a", "b").union(starts.where("total <= h").select("conv_id", "a", "b"))
    return given.unionByName(own.drop("last")), ends


def _joined(batches):
    """(a, b, conv_id) in order: the ids of each (a, b) in texts of up to PIECE of them, with the first."""

    def rows(held):
        columns = list(zip(*held)) or [[]] * 4
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()])], names=["a", "b", "first", "ids"])

    name, ids, held = None, [], []
    for batch in batches:
        for a, b, i in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "conv_id"))):
            if (a, b) != name or len(ids) == PIECE:
                if ids:
                    held.append((*name, ids[0], ",".join(map(str, ids))))
                name, ids = (a, b), []
            ids.append(i)
        yield rows(held)
        held = []
    if ids:
        yield rows([(*name, ids[0], ",".join(map(str, ids)))])


def _hashed(batches):
    """(a, b, first, ids) in order: the digest of the joined ids of each (a, b), read as a stream."""

    def rows(held):
        columns = list(zip(*held)) or [[]] * 3
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 2 + [pa.string()])], names=["a", "b", "sha"])

    name, state, held = None, None, []
    for batch in batches:
        for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids"))):
            if (a, b) == name:
                state.update(b",")
            else:
                if name:
                    held.append((*name, state.hexdigest()))
                name, state = (a, b), sha256()
            state.update(ids.encode())
        yield rows(held)
        held = []
    if name:
        yield rows([(*name, state.hexdigest())])


def end_digests(ends: DataFrame) -> DataFrame:
    """(a, b, sha): SHA-256 of the ids that end at a node, ascending, with commas.

    The digest of a node is one stream by its definition, but what a task reads of it are pieces of ``PIECE`` ids.
    """
    count, order = partitions(ends.sparkSession), ["a", "b", "conv_id"]
    ranged = ends.select(*order).repartitionByRange(count, *order).sortWithinPartitions(*order)
    pieces = ranged.mapInArrow(_joined, "a long, b long, first long, ids string")
    streams = pieces.repartition(count, "a", "b").sortWithinPartitions("a", "b", "first")
    return streams.mapInArrow(_hashed, "a long, b long, sha string")


def subtree_totals(forest: DataFrame, values: list[str], tables: Tables) -> DataFrame:
    """(id, *values), stored: each value added up over the subtree of each node, for (id, parent, *values).

    A root's parent is null. ``up_<value>`` is what a node gives to its parent besides its own total: the values of
    the spliced nodes between the two.
    """
    ups = [f"up_{v}" for v in values]
    kids = forest.where("parent IS NOT NULL").groupBy(F.col("parent").alias("of")).agg(F.count(F.lit(1)).alias("n"))
    alive = forest.join(kids, F.col("id") == F.col("of"), "left").select(
        "id", "parent", F.coalesce("n", F.lit(0)).alias("n"), *values, *[F.lit(0).cast("long").alias(u) for u in ups]
    )
    alive = tables.store(alive, "alive-0")
    raked, spliced, made, rounds = [], [], ["alive-0"], 0
    while True:
        rounds += 1
        raked.append(alive.where("n = 0").select("id", *values))
        inner = alive.where("n > 0")
        if inner.isEmpty():
            break
        # Rake: totals of leaves go up; what has only one child left is part of a chain.
        gifts = alive.where("n = 0 AND parent IS NOT NULL").groupBy(F.col("parent").alias("to")).agg(
            *[F.sum(F.col(v) + F.col(u)).alias(f"gift_{v}") for v, u in zip(values, ups)]
        )
        rest = inner.where("parent IS NOT NULL").groupBy(F.col("parent").alias("of")).agg(
            F.count(F.lit(1)).alias("left"), F.min("id").alias("only")
        )
        inner = inner.join(gifts, F.col("id") == F.col("to"), "left").join(rest, F.col("id") == F.col("of"), "left")
        more = [(F.col(v) + F.coalesce(f"gift_{v}", F.lit(0))).alias(v) for v in values]
        inner = inner.select("id", "parent", F.coalesce("left", F.lit(0)).alias("n"), "only", *more, *ups)
        inner = tables.store(inner, f"inner-{rounds}")
        # Compress: no two of those that go are neighbours.
        chain = inner.where("n = 1 AND parent IS NOT NULL")
        below = chain.select(F.col("id").alias("lower"))
        losers = chain.join(below, F.col("only") == F.col("lower")).select(F.greatest("id", "lower").alias("id"))
        gone = chain.join(losers, "id", "left_anti").select(
            F.col("id").alias("gone"), F.col("only").alias("child"), F.col("parent").alias("above"),
            *[F.col(v).alias(f"gone_{v}") for v in values], *[F.col(u).alias(f"gone_{u}") for u in ups],
        )
        gone = tables.store(gone, f"gone-{rounds}")
        stay = inner.drop("only").join(gone.select(F.col("gone").alias("id")), "id", "left_anti")
        stay = stay.join(gone, F.col("id") == F.col("child"), "left")
        # Total of the spliced node: its child's total and these.
        extra = [(F.col(u) + F.col(f"gone_{v}")).alias(f"extra_{v}") for v, u in zip(values, ups)]
        given = [
            (F.col(u) + F.coalesce(F.col(f"gone_{v}") + F.col(f"gone_{u}"), F.lit(0))).alias(u) for v, u in zip(values, ups)
        ]
        above = F.when(F.col("gone").isNull(), F.col("parent")).otherwise(F.col("above")).alias("parent")
        alive = tables.store(stay.select("id", above, "n", *values, *given, "gone", *extra), f"alive-{rounds}")
        spliced.append(alive.where("gone IS NOT NULL").select(F.col("gone").alias("id"), F.col("id").alias("child"), *[F.col(f"extra_{v}").alias(v) for v in values]))
        tables.drop(f"inner-{rounds}", f"gone-{rounds}")
        made.append(f"alive-{rounds}")
    totals = raked[0]
    for part in raked[1:]:
        totals = totals.union(part)
    if spliced:
        links = spliced[0]
        for part in spliced[1:]:
            links = links.union(part)
        # A spliced node's child is spliced later or raked, so pointers lead over fewer nodes than there were rounds.
        for step in range(math.ceil(math.log2(rounds))):
            on = links.select(F.col("id").alias("via"), F.col("child").alias("next"), *[F.col(v).alias(f"next_{v}") for v in values])
            links = links.join(on, F.col("child") == F.col("via"), "left").select(
                "id", F.coalesce("next", "child").alias("child"),
                *[(F.col(v) + F.coalesce(f"next_{v}", F.lit(0))).alias(v) for v in values],
            )
            links = tables.store(links, f"links-{step}")
            made.append(f"links-{step}")
        of_child = totals.select(F.col("id").alias("child"), *[F.col(v).alias(f"child_{v}") for v in values])
        opened = links.join(of_child, "child").select("id", *[(F.col(v) + F.col(f"child_{v}")).alias(v) for v in values])
        totals = totals.union(opened)
    totals = tables.store(totals, "totals")
    tables.drop(*made)
    return totals


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A node's conv_id is its least member; the root has depth 0 and no parent.
    """
    tables = Tables(conversations.sparkSession)
    rows, ends = rebuilt(conversations, tables)
    nothing, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    name, above = F.struct("a", "b"), F.struct(F.col("pa").alias("a"), F.col("pb").alias("b"))
    everywhere = ends.select("conv_id", *[zero.alias(c) for c in ("depth", "a", "b")], nothing.alias("pa"), nothing.alias("pb"), zero.alias("chars"))
    nodes = rows.select(everywhere.columns).union(everywhere).groupBy("depth", "a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("pa").alias("pa"), F.min("pb").alias("pb"),
        F.min("chars").alias("chars"),
    )
    nodes = tables.store(
        nodes.select(name.alias("id"), F.when(F.col("depth") > 0, above).alias("parent"), "depth", "conv_id", "n_convs", "chars"), "nodes"
    )
    counts = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = tables.store(nodes.join(counts, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "counted")
    ended = tables.store(end_digests(ends), "ended")
    tables.drop("turns", "runs", "convs", "placed", "heads", "starts", "own", "nodes")
    saved = (F.col("n_convs") - 1) * F.col("chars")
    values = nodes.select("id", "parent", (F.col("n_children") == 0).cast("long").alias("n_leaves"), saved.alias("saved_tokens"))
    totals = subtree_totals(values, ["n_leaves", "saved_tokens"], tables)
    ended = ended.select(F.struct("a", "b").alias("id"), "sha")
    whole = nodes.join(totals, "id").join(ended, "id", "left")
    parents = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return whole.join(parents, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha", F.lit(sha256().hexdigest())).alias("ends_sha256"),
    )

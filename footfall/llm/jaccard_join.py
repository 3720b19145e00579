"""Exact Jaccard join of word-shingle sets by a grouped prefix join, and its connected components.

Documents with equal sets form a class. Two sets of at least ``percent`` per cent Jaccard similarity share one of the
first ``n - ceil(percent * n / 100) + 1`` tokens of each under any one order of all tokens. The order used here puts
frequent tokens last, so that passages which many documents share stay out of the prefixes. Classes with the same
prefix and the same size form a group; prefixes are joined between groups, pairs of groups are filtered by size and by
the best overlap their prefixes still allow, and only then expanded to their members. Member pairs are filtered once
more by the overlap that sketches of 256 bytes allow, and what is left is verified on whole sets. Classes go by numbers
given when they are stored, as digests would be most of what the prefix join shuffles.

A token is frequent if it is in at least ``HOT`` documents. Frequencies cover all documents, but in two steps: tokens
with a hash in the lowest quarter for all documents, the others only for documents whose lowest quarter has too few
rare tokens to fill the prefix, as no other document's prefix reaches them. The frequent tokens are the one thing
broadcast, at most ``HOT_LIMIT`` of them (the bar is raised until they are), which changes the order, never the result.

Large clusters are joined without all pairs. First every posting list is paired with its hub, the group in which the
token comes earliest, and links found are closed to components; then only groups of different components are paired,
one side of each such pair being outside the component of the list's hub.

Defined results: null and empty texts have no set and no link, and are a component each; repeated rows are one class;
null ids are ignored as smallest ids (a component of null ids only has a null); an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import Tables, slices
from footfall.llm.components import components
from footfall.llm.shingles import digest, lists, shingle_sets

HOT = 32
HOT_LIMIT = 1 << 20
QUARTER = np.uint64(1 << 62)
FILTER_BITS = 24
SKETCH = 256
SLICE = 1 << 18  # bytes of text worked on at a time; a task holds some sixty times as many


def prefix_size(n: np.ndarray | int, percent: int):
    return n - -(-percent * n // 100) + 1


def _over_texts(docs: DataFrame, schema: str, rows: Callable[..., dict]) -> DataFrame:
    """Apply ``rows(batch)`` to slices of ``docs`` (columns id, text)."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            found = rows(batch)
            yield pa.RecordBatch.from_arrays([found[name] for name in names], names)

    return docs.mapInArrow(run, schema)


def document_sets(docs: DataFrame, width: int) -> DataFrame:
    """One row per document: its columns but for text, n (set size), set (digest of the set, null if empty)."""
    carried = [f for f in docs.schema.fields if f.name != "text"]

    def rows(batch):
        values, at = shingle_sets(batch.column("text"), width)
        keys = [digest(values[a:b]) if b > a else None for a, b in zip(at[:-1], at[1:])]
        own = {f.name: batch.column(f.name) for f in carried}
        return own | {"n": pa.array(np.diff(at), pa.int64()), "set": pa.array(keys, pa.binary())}

    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in carried] + ["n long", "set binary"])
    return _over_texts(docs, schema, rows)


def _is_in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    place = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[place] == values


def _counted(docs: DataFrame, width: int, pick: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The frequent ones of the tokens that ``pick(values, offsets)`` marks, sorted; at most HOT_LIMIT."""

    def rows(batch):
        values, at = shingle_sets(batch.column("text"), width)
        token, n = np.unique(values[pick(values, at)], return_counts=True)
        return {"token": pa.array(token.view(np.int64)), "n": pa.array(n, pa.int64())}

    counts = _over_texts(docs, "token long, n long", rows).groupBy("token").agg(F.sum("n").alias("n"))
    tables = Tables(docs.sparkSession)
    hot = tables.store(counts.where(F.col("n") >= HOT).withColumn("level", F.length(F.bin("n"))), "hot")
    levels = sorted(((r["level"], r["count"]) for r in hot.groupBy("level").count().collect()), reverse=True)
    kept, bar = 0, 64
    for level, count in levels:  # at most 64 of them
        if kept + count > HOT_LIMIT:
            break
        kept, bar = kept + count, level
    chosen = hot.where(F.col("level") >= bar).select("token").toArrow().column("token").to_numpy()
    tables.drop("hot")
    return np.sort(chosen.view(np.uint64))


def _prefixes(values: np.ndarray, at: np.ndarray, percent: int, low: np.ndarray, high: np.ndarray):
    """(order, sizes): the tokens with each document's prefix first, and the prefix sizes."""
    n = np.diff(at)
    owner = np.repeat(np.arange(len(n)), n)
    hot = _is_in(values, low) | _is_in(values, high)
    order = np.lexsort((values, hot, owner))
    return order, np.where(n > 0, prefix_size(n, percent), 0)


def _sketches(values: np.ndarray, at: np.ndarray, some: np.ndarray) -> list[bytes | None]:
    """Numbers of tokens by their highest eight bits; none where a number passes a byte."""
    n = len(at) - 1
    place = np.repeat(np.arange(n), np.diff(at)) * SKETCH + (values >> np.uint64(56)).astype(np.int64)
    counts = np.bincount(place, minlength=n * SKETCH).reshape(n, SKETCH)
    return [counts[i].astype(np.uint8).tobytes() if counts[i].max() < 256 else None for i in some]


@F.pandas_udf(T.LongType())
def _overlap_bound(a: pd.Series, b: pd.Series) -> pd.Series:
    """The most tokens that two sets can share, from their sketches; null if one has none."""
    out = pd.Series([None] * len(a), dtype="Int64")
    both = (a.notna() & b.notna()).to_numpy()
    if both.any():
        x, y = (np.frombuffer(b"".join(c[both]), np.uint8).reshape(-1, SKETCH) for c in (a, b))
        out[both] = np.minimum(x, y).sum(axis=1, dtype=np.int64)
    return out


def class_prefixes(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """One row per class: set, n, sketch, key (of size and prefix), prefix (its first tokens, in the join's order), rare.

    ``rare`` is the number of tokens in the prefix that are not frequent; they come first.
    """
    spark = docs.sparkSession
    low = spark.sparkContext.broadcast(_counted(docs, width, lambda values, at: values < QUARTER))

    def unfilled(values: np.ndarray, at: np.ndarray) -> np.ndarray:
        rare = (values < QUARTER) & ~_is_in(values, low.value)
        n = np.diff(at)
        owner = np.repeat(np.arange(len(n)), n)
        short = np.bincount(owner[rare], minlength=len(n)) < prefix_size(n, percent)
        return short[owner] & (values >= QUARTER)

    high = spark.sparkContext.broadcast(_counted(docs, width, unfilled))

    def rows(batch):
        values, at = shingle_sets(batch.column("text"), width)
        order, sizes = _prefixes(values, at, percent, low.value, high.value)
        ordered = values[order]
        some = np.flatnonzero(sizes)
        keep = [ordered[at[i] : at[i] + sizes[i]] for i in some]
        joined = np.concatenate(keep) if keep else np.zeros(0, np.uint64)
        firsts = np.concatenate(([0], np.cumsum(sizes[some])))
        rare = ~(_is_in(joined, low.value) | _is_in(joined, high.value))
        return {
            "set": pa.array([digest(values[at[i] : at[i + 1]]) for i in some], pa.binary()),
            "n": pa.array(np.diff(at)[some], pa.int64()),
            "sketch": pa.array(_sketches(values, at, some), pa.binary()),
            "key": pa.array([digest(np.append(p, np.uint64(n_))) for p, n_ in zip(keep, np.diff(at)[some])], pa.binary()),
            "prefix": lists(joined, firsts),
            "rare": pa.array(np.diff(np.concatenate(([0], np.cumsum(rare)))[firsts]), pa.int64()),
        }

    every = _over_texts(docs, "set binary, n long, sketch binary, key binary, prefix array<long>, rare long", rows)
    return every.groupBy("set").agg(*[F.first(c).alias(c) for c in ("n", "sketch", "key", "prefix", "rare")])


def _needed(percent: int) -> Column:
    """Least overlap of two sets of sizes na and nb."""
    return F.expr(f"({percent} * (na + nb) + {100 + percent - 1}) DIV {100 + percent}")


def _group_pairs(left: DataFrame, right: DataFrame, percent: int, *more: Column) -> DataFrame:
    """Pairs (a, b) of groups, a < b, from postings (token, group, n, pos, spos, ...), that may still be similar enough.

    ``pos`` is a token's place in the prefix, ``spos`` its place among the prefix's tokens that other groups share.
    """
    a = left.select("token", *[F.col(c).alias(f"{c}a") for c in left.columns if c != "token"])
    b = right.select("token", *[F.col(c).alias(f"{c}b") for c in right.columns if c != "token"])
    fits = F.expr(
        f"groupa != groupb AND 100 * least(na, nb) >= {percent} * greatest(na, nb)"
        f" AND least(sposa, sposb) + least(na - posa, nb - posb) >= ({percent} * (na + nb) + {99 + percent}) DIV {100 + percent}"
    )
    met = a.join(b, "token").where(fits)
    for condition in more:
        met = met.where(condition)
    swap = F.expr("groupa > groupb")
    two = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x))
    met = met.select(
        two("groupa", "groupb").alias("a"), two("groupb", "groupa").alias("b"), two("na", "nb").alias("na"),
        two("nb", "na").alias("nb"), two("posa", "posb").alias("pa"), two("posb", "posa").alias("pb"), "token",
    )
    # A pair may meet twice on a token, once from each side; counting distinct tokens by their first place is enough.
    each = met.groupBy("a", "b", "na", "nb", "token").agg(F.min("pa").alias("pa"), F.min("pb").alias("pb"))
    seen = each.groupBy("a", "b", "na", "nb").agg(
        F.count(F.lit(1)).alias("common"), F.max("pa").alias("pa"), F.max("pb").alias("pb")
    )
    return seen.where(F.col("common") + F.expr("least(na - pa, nb - pb)") >= _needed(percent)).select("a", "b")


def _candidate_sets(docs: DataFrame, width: int, wanted: DataFrame, tables: Tables) -> DataFrame:
    """(class, tokens) of the wanted (class, set). A bit map of fixed size, 2**FILTER_BITS bits, spares the others the shuffle."""
    spark = docs.sparkSession
    place = F.conv(F.hex(F.substring("set", 1, 3)), 16, 10).cast("long")
    marks = (
        wanted.select(place.alias("p"))
        .groupBy(F.shiftright("p", 6).alias("w"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(p & 63 AS INT)))").alias("bits"))
        .toArrow()
    )
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bits[marks.column("w").to_numpy()] = marks.column("bits").to_numpy()
    held = spark.sparkContext.broadcast(bits)

    def marked(key: bytes) -> bool:
        p = int.from_bytes(key[:3], "big")
        return bool(int(held.value[p >> 6]) >> (p & 63) & 1)

    def rows(batch):
        values, at = shingle_sets(batch.column("text"), width)
        each = [(digest(values[a:b]), values[a:b]) for a, b in zip(at[:-1], at[1:]) if b > a]
        each = [x for x in each if marked(x[0])]
        joined = np.concatenate([x[1] for x in each]) if each else np.zeros(0, np.uint64)
        sizes = np.array([0] + [len(x[1]) for x in each])
        return {"set": pa.array([x[0] for x in each], pa.binary()), "tokens": lists(joined, np.cumsum(sizes))}

    found = _over_texts(docs, "set binary, tokens array<long>", rows)
    once = found.groupBy("set").agg(F.first("tokens").alias("tokens"))
    return tables.store(once.join(wanted, "set").select("class", "tokens"), "candidates")


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those of the class pairs (a, b) whose sketches leave room for enough overlap."""
    a, b = (
        classes.select(F.col("class").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"sketch_{x}")) for x in "ab"
    )
    bound = _overlap_bound("sketch_a", "sketch_b")
    met = pairs.join(a, "a").join(b, "b").withColumn("most", bound)
    return met.where(F.col("most").isNull() | (F.col("most") >= _needed(percent))).select("a", "b")


def _verified(
    docs: DataFrame, width: int, percent: int, pairs: DataFrame, classes: DataFrame, tables: Tables, label: str
) -> DataFrame:
    """Those of the class pairs (a, b) whose whole sets are similar enough."""
    pairs = tables.store(_plausible(pairs, classes, percent), f"plausible_{label}")
    wanted = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    sets = _candidate_sets(docs, width, classes.select("class", "set").join(wanted, "class", "left_semi"), tables)
    a, b = (sets.select(F.col("class").alias(x), F.col("tokens").alias(f"tokens_{x}")) for x in "ab")
    met = pairs.join(a, "a").join(b, "b").withColumn("i", F.size(F.array_intersect("tokens_a", "tokens_b")))
    good = F.expr(f"100 * i >= {percent} * (size(tokens_a) + size(tokens_b) - i)")
    found = tables.store(met.where(good).select("a", "b"), label)
    tables.drop("candidates", f"plausible_{label}")
    return found


def _postings(reps: DataFrame) -> DataFrame:
    """(token, group, n, pos, spos) of the prefixes' tokens, but for rare ones that only one group has.

    Tokens that no other prefix has cannot be common; only the others before a place count there. A rare token's list
    is short, so that its length is counted where the list lies together; frequent tokens are kept unasked.
    """
    posted = reps.select(F.col("class").alias("group"), "n", "rare", F.posexplode("prefix").alias("pos", "token"))
    frequent = F.col("pos") >= F.col("rare")
    dealt = F.when(frequent, F.col("group")).otherwise(F.lit(-1))  # a frequent token's list stays spread
    counted = posted.withColumn("others", F.count(F.lit(1)).over(Window.partitionBy("token", dealt)))
    shared = counted.where(frequent | (F.col("others") > 1))
    spos = F.row_number().over(Window.partitionBy("group").orderBy("pos"))
    return shared.select("token", "group", "n", (F.col("pos") + 1).alias("pos"), spos.alias("spos"))


def links(docs: DataFrame, width: int, percent: int, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """(links (a, b) that connect every component of the similarity graph of classes, (class, set) of all classes).

    ``docs`` has a column text. Links inside a component that other links already imply may be missing.
    """
    numbered = class_prefixes(docs, width, percent).withColumn("class", F.monotonically_increasing_id())
    classes = tables.store(numbered, "classes")
    grouped = classes.groupBy("key").agg(F.min("class").alias("first"))
    members = tables.store(classes.select("class", "key").join(grouped, "key").select("class", "first"), "members")
    reps = classes.join(members.where("class = first"), "class", "left_semi")
    postings = tables.store(_postings(reps), "postings")

    # Hub round: each list with its earliest group, each group's members with its first.
    hubs = postings.groupBy("token").agg(F.min(F.struct("pos", "group", "n", "spos")).alias("h"))
    hubs = tables.store(hubs.select("token", "h.group", "h.n", "h.pos", "h.spos"), "hubs")
    stars = _group_pairs(hubs, postings.select(*hubs.columns), percent)
    a_members = members.select(F.col("first").alias("b"), F.col("class").alias("other"))
    spread = stars.join(a_members, "b").select("a", F.col("other").alias("b"))
    back = members.select(F.col("first").alias("a"), F.col("class").alias("other"))
    spread = spread.union(stars.join(back, "a").select("b", F.col("other").alias("a"))).union(
        members.where("class != first").select("first", "class")
    )
    ordered = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    pairs = tables.store(spread.toDF("a", "b").select(*ordered).distinct(), "hub_pairs")
    found = _verified(docs, width, percent, pairs, classes, tables, "hub_links")
    tables.drop("hub_pairs")

    # Exact round: what may link two components.
    roots = components(found)
    placed = members.join(roots.select(F.col("node").alias("class"), "root"), "class", "left").select(
        "class", "first", F.coalesce("root", "class").alias("root")
    )
    placed = tables.store(placed, "placed")
    of_group = placed.groupBy("first").agg(F.min("root").alias("root"), F.max("root").alias("top"))
    one = F.when(F.col("root") == F.col("top"), F.col("root")).alias("root")
    of_group = of_group.select(F.col("first").alias("group"), one)  # null: members of several components
    post = postings.join(of_group, "group")
    of_hub = hubs.join(of_group, "group").select("token", F.col("root").alias("hub_root"))
    post = tables.store(post.join(of_hub, "token"), "placed_postings")
    tables.drop("postings", "hubs")
    minority = post.where("root IS NULL OR hub_root IS NULL OR root != hub_root").drop("hub_root")
    apart = F.expr("roota IS NULL OR rootb IS NULL OR roota != rootb")
    met = _group_pairs(minority, post.drop("hub_root"), percent, apart)
    mixed = of_group.where("root IS NULL").select(F.col("group").alias("a"), F.col("group").alias("b"))
    met = met.union(mixed)
    x = placed.select(F.col("first").alias("a"), F.col("class").alias("sa"), F.col("root").alias("ra"))
    y = placed.select(F.col("first").alias("b"), F.col("class").alias("sb"), F.col("root").alias("rb"))
    rest = met.join(x, "a").join(y, "b").where("ra != rb").select(F.col("sa").alias("a"), F.col("sb").alias("b"))
    rest = rest.select(*ordered).distinct().join(found, ["a", "b"], "left_anti")
    pairs = tables.store(rest, "pairs")
    tables.drop("placed_postings")
    found = found.union(_verified(docs, width, percent, pairs, classes, tables, "links"))
    tables.drop("pairs")
    return found, classes.select("class", "set")


def _rooted(docs: DataFrame, width: int, percent: int, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """(sets of ``docs``, (set, root) of every class): classes of one component share a root."""
    sets = tables.store(document_sets(docs, width), "sets")
    found, classes = links(docs.select("text"), width, percent, tables)
    rooted = classes.join(components(found).withColumnRenamed("node", "class"), "class", "left")
    roots = tables.store(rooted.select("set", F.coalesce("root", "class").alias("root")), "roots")
    tables.drop("classes")
    return sets, roots


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_shingles, component_id (smallest key of its component), set."""
    tables = Tables(docs.sparkSession)
    sets, roots = _rooted(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), width, percent, tables)
    least = sets.where("n > 0").groupBy("set").agg(F.min("id").alias("least")).join(roots, "set")
    named = least.groupBy("root").agg(F.min("least").alias("component_id"))
    by_set = tables.store(roots.join(named, "root").select("set", "component_id"), "class_components")
    joined = sets.join(by_set, "set", "left")
    mine = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    return joined.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), mine.alias("component_id"), "set")


def one_of_each(
    docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text", stored: bool = False
) -> DataFrame:
    """The documents with one kept of each component: that with the smallest key (null last), then the first stored.

    Documents without a word stay. Rows are known by their place, which a second scan need not give again, so they are
    stored once together with it, and both the sets and the kept rows come from there. With ``stored``, ``docs`` is as
    read from Parquet files that stay; there a file and a row's number in it are the place, and no copy is made.
    """
    tables = Tables(docs.sparkSession)
    number = F.monotonically_increasing_id()
    row = F.struct("*").alias("row")
    if stored:
        place = F.struct("_metadata.file_path", "_metadata.row_index").alias("place")
        rows = docs.select(row, place)
    else:
        rows = tables.store(docs.select(row, number.alias("place")), "rows")
        number = F.col("place")
    texts = rows.select(number.alias("id"), "place", F.col("row")[key].alias("key"), F.col("row")[text].alias("text"))
    sets, roots = _rooted(texts, width, percent, tables)
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "id")).alias("first")
    by_set = sets.where("n > 0").groupBy("set").agg(first).join(roots, "set")
    kept = by_set.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.id").alias("id"))
    # Fewer rows go than stay.
    gone = tables.store(sets.where("n > 0").join(kept, "id", "left_anti").select("place"), "gone")
    return rows.join(gone, "place", "left_anti").select("row.*")

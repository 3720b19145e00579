"""Mixing sources to target weights by Pareto order sampling.

Sources share the words of the mix by weight; a source's target stops at ``MOST`` times its words and what it leaves
is shared again. Inside a source a document's expected copies grow with the bit length of its size, up to ``MOST``;
whole copies are certain, and the remaining fraction p is the inclusion probability of one more copy. Documents are
ranked by random odds over inclusion odds, (u / (1 - u)) / (p / (1 - p)), and taken in that order.

First the documents that hold at least a hundredth of their source's words each (at most a hundred) are taken in that
order as far as they fit, then the order of the others is cut where the words come nearest to what is left, so a source
ends within half of one small document of its target unless its small documents do not suffice. The second cut is found on
counts of 65,536 classes of the rank and then among the documents of one class, so no source is sorted in one task.
What decides on a document is its own values and one row per source, so documents are not joined to documents.

Random numbers are a hash of seed, key and text: reruns agree, whatever the partitions. Defined results: null texts
have size 0 and are not taken; null sources are one source, last in order; rows equal in key and text share their
random number and fate; other columns are kept untouched; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import n_words
from footfall.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 150  # per cent of all words
MOST = 2
LARGE = 100  # a document is large from a hundredth of its source's words on
CLASSES = 65536

_BEFORE = (Window.unboundedPreceding, -1)


def random_number(key: Column, text: Column, seed: int) -> Column:
    """Uniform in (0, 1), from a hash of seed, key and text."""
    mixed = F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string"), F.md5(F.coalesce(text, F.lit("")))))
    return (F.conv(F.substring(mixed, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: int = SHARE) -> DataFrame:
    """(source, source_size, target) from (source, stratum, words): one row per source."""
    sources = sizes.groupBy("source").agg(F.sum("words").alias("source_size"))
    # One row per source from here on; so are the windows.
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    weighted = sources.withColumn("weight", weight).withColumn(
        "due", F.sum("source_size").over(everything) * (share / 100)
    )
    first_full = Window.orderBy(MOST * F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    left = F.col("due") - MOST * F.coalesce(F.sum("source_size").over(first_full.rowsBetween(*_BEFORE)), F.lit(0))
    open_weight = F.sum("weight").over(first_full.rowsBetween(0, Window.unboundedFollowing))
    levels = weighted.withColumn("level", left / open_weight)
    fits = F.when(F.col("level") * F.col("weight") <= MOST * F.col("source_size"), F.col("level"))
    level = F.max(fits).over(everything)  # of those that fit, the first in order is the greatest
    target = F.least(F.lit(float(MOST)) * F.col("source_size"), level * F.col("weight"))
    full = F.lit(float(MOST)) * F.col("source_size")
    return levels.select("source", "source_size", F.coalesce(target, full).alias("target"))


def copies_per_bit(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """targets with ``rate``: expected copies of a document are min(MOST, rate * bit length of its size)."""
    joined = sizes.where("stratum > 0").join(targets, F.expr("source <=> of")).drop("of")
    down = Window.partitionBy("source").orderBy(F.col("stratum").desc())
    left = F.col("target") - MOST * F.coalesce(F.sum("words").over(down.rowsBetween(*_BEFORE)), F.lit(0))
    open_ = F.sum(F.col("stratum") * F.col("words")).over(down.rowsBetween(0, Window.unboundedFollowing))
    rated = joined.withColumn("rate", left / open_)
    fits = rated.where(F.col("rate") * F.col("stratum") <= MOST + 1e-9)
    return fits.groupBy("source").agg(F.max_by("rate", "stratum").alias("rate"))


def _stratum(size: Column) -> Column:
    return F.when(size > 0, F.length(F.bin(size))).otherwise(0)


def _rank(expected: Column, u: Column) -> Column:
    p = expected - F.floor(expected + 1e-9)
    return F.when(p > 1e-9, (u / (1 - u)) / (p / (1 - p)))


def plan(docs: DataFrame, key: str, text: str, source: str, weights: tuple[int, ...], share: int, seed: int) -> DataFrame:
    """One row per source: of (its name), source_size, target, rate, large_ranks, class_cut, rank_cut."""
    narrow = docs.select(
        F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
        random_number(F.col(key), F.col(text), seed).alias("u"),
    )
    narrow = materialize(narrow.withColumn("stratum", _stratum(F.col("size"))), "sizes")
    strata = materialize(narrow.groupBy("source", "stratum").agg(F.sum("size").alias("words")), "strata")
    targets = source_targets(strata, weights, share).withColumnRenamed("source", "of")
    rates = copies_per_bit(strata, targets)
    known = targets.join(rates, F.expr("of <=> source"), "left").select("of", "source_size", "target", "rate")
    known = materialize(known, "targets")

    drawn = narrow.join(known, F.expr("source <=> of")).withColumn("e", F.expr(f"least({MOST}D, rate * stratum)"))
    drawn = drawn.withColumns(
        {
            "whole": (F.floor(F.col("e") + 1e-9) * F.col("size")).cast("long"),
            "rank": _rank(F.col("e"), F.col("u")),
            "large": F.col("size") * LARGE >= F.col("source_size"),
        }
    )
    drawn = drawn.withColumn("class", F.floor(CLASSES * (F.col("rank") / (1 + F.col("rank")))))

    # Expected words by stratum, in whole numbers so that the order of adding does not matter.
    part = drawn.where("rank IS NOT NULL").groupBy("of", "large", "e").agg(F.sum("size").alias("words"))
    expected = part.groupBy("of").agg(
        F.sum(F.expr("CASE WHEN large THEN CAST(floor((e - floor(e + 1e-9)) * words) AS BIGINT) ELSE 0 END")).alias("large_due")
    )
    whole = drawn.groupBy("of").agg(F.sum("whole").alias("whole"))

    one = lambda frame, name: frame.withColumnRenamed("of", name)
    room = drawn.where("NOT large AND rank IS NOT NULL").groupBy("of").agg(F.sum("size").alias("small_words"))
    sources = (
        known.join(one(whole, "w"), F.expr("of <=> w"), "left").drop("w")
        .join(one(expected, "x"), F.expr("of <=> x"), "left").drop("x")
        .join(one(room, "y"), F.expr("of <=> y"), "left").drop("y")
        .withColumn("due", F.expr("target - coalesce(whole, 0)"))
    )
    # At most LARGE documents of a source. Those of a tenth of it or more come first, each by its own chance (a rank of
    # up to 1 has probability p); the others are taken in order while that comes nearer to what is due from large
    # documents. None may go beyond what is due in all, but one is taken where leaving it would miss by more.
    giant = F.col("size") * 10 < F.col("source_size")
    large = drawn.where("large AND rank IS NOT NULL").groupBy("of").agg(
        F.array_sort(F.collect_list(F.struct(giant.alias("plain"), "rank", "size"))).alias("large_docs"),
        F.sum("size").alias("large_words"),
    )
    sources = sources.join(one(large, "l"), F.expr("of <=> l"), "left").drop("l")
    over, short = "a.words + x.size - due", "due - a.words - (a.left - x.size)"
    fold = f"""aggregate(large_docs, named_struct('words', 0L, 'left', large_words + coalesce(small_words, 0L),
          'ranks', CAST(array() AS array<double>)),
        (a, x) -> CASE WHEN {short} > 0 AND {over} < {short}
            OR {over} <= 0 AND CASE WHEN x.plain THEN a.words + x.size / 2 <= large_due ELSE x.rank <= 1 END
          THEN named_struct('words', a.words + x.size, 'left', a.left - x.size, 'ranks', array_append(a.ranks, x.rank))
          ELSE named_struct('words', a.words, 'left', a.left - x.size, 'ranks', a.ranks) END)"""
    sources = sources.withColumn("large", F.expr(fold)).withColumn("due", F.expr("due - coalesce(large.words, 0)"))
    sources = sources.withColumn("large_ranks", F.col("large.ranks")).drop(
        "large", "large_docs", "large_words", "whole", "large_due", "small_words"
    )
    sources = materialize(sources, "source_plan")

    small = drawn.where("NOT large AND rank IS NOT NULL").select("of", "size", "u", "rank", "class")
    classes = small.groupBy("of", "class").agg(F.sum("size").alias("words"))
    dues = sources.select(F.col("of").alias("s"), "due")
    up = Window.partitionBy("of").orderBy("class").rowsBetween(*_BEFORE)
    classes = classes.withColumn("before", F.coalesce(F.sum("words").over(up), F.lit(0))).join(dues, F.expr("of <=> s"))
    cut_class = classes.where("before + words >= due").groupBy("of").agg(
        F.min("class").alias("class_cut"), F.min_by("before", "class").alias("before")
    )
    cut_class = materialize(cut_class, "class_cuts")
    edge = small.join(cut_class.withColumnRenamed("of", "c"), F.expr("of <=> c AND class = class_cut")).join(
        dues, F.expr("of <=> s")
    )
    in_order = Window.partitionBy("of").orderBy("rank", "size", "u").rowsBetween(*_BEFORE)
    at = F.col("before") + F.coalesce(F.sum("size").over(in_order), F.lit(0)) + F.col("size") / 2
    rank_cut = edge.withColumn("at", at).where("at <= due").groupBy("of").agg(F.max("rank").alias("rank_cut"))
    sources = sources.join(one(cut_class.drop("before"), "c"), F.expr("of <=> c"), "left").drop("c")
    return materialize(sources.join(one(rank_cut, "r"), F.expr("of <=> r"), "left").drop("r"), "mix_plan")


def with_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: int = SHARE, seed: int = 1,
) -> DataFrame:
    """Columns row (the document), size, copies, source_size, target."""
    known = plan(docs, key, text, source, weights, share, seed)
    rows = docs.select(
        F.struct("*").alias("row"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
        random_number(F.col(key), F.col(text), seed).alias("u"),
    )
    rows = rows.withColumn("stratum", _stratum(F.col("size"))).join(known, F.expr("source <=> of"), "left")
    rows = rows.withColumn("e", F.expr(f"least({MOST}D, coalesce(rate, 0D) * stratum)"))
    rows = rows.withColumn("rank", _rank(F.col("e"), F.col("u")))
    one_more = F.expr(
        f"""CASE WHEN rank IS NULL THEN FALSE
        WHEN size * {LARGE} >= source_size THEN coalesce(array_contains(large_ranks, rank), FALSE)
        ELSE class_cut IS NULL OR floor({CLASSES} * (rank / (1 + rank))) < class_cut
          OR floor({CLASSES} * (rank / (1 + rank))) = class_cut AND coalesce(rank <= rank_cut, FALSE) END"""
    )
    copies = F.floor(F.col("e") + 1e-9).cast("int") + one_more.cast("int")
    return rows.select("row", "size", copies.alias("copies"), "source_size", "target")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with the columns of ``docs``, each as often as the mix takes it."""
    taken = with_copies(docs, **options).where("copies > 0")
    return taken.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def report(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: key, size, source_size, target, taken."""
    taken = (F.col("size") * F.col("copies")).cast("long").alias("taken")
    return with_copies(docs, key=key).select(F.col("row")[key].alias(key), "size", "source_size", "target", taken)

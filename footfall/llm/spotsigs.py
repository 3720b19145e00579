"""SpotSigs: fingerprints from chains of content words that follow common words. Built-in functions only.

An anchor is one of the common words in ``ANCHORS``; its signature is the anchor with the next ``CHAIN`` words that are
no anchors. A text's fingerprint is the set of its distinct signatures, as 64-bit hashes; a text without any has the
one signature of its whole word sequence, or of the text itself where it has no word, so a set is never empty.
Words are runs of letters and digits in lower case. Likeness is the Jaccard similarity of two sets, spared
where they are known to be equal. Only ``matches`` prunes by set lengths; the registered query does not call it.

``edited`` walks all documents in descending key order with each document's successor. Documents are dealt to ranges
of keys in one shuffle of the texts; the first document of a range goes to the range before as well, so no range waits
for another. Range bounds come from a quantile sketch of the keys; the ranges are many (``RANGES`` for each shuffle
partition), so a task holds a small part of its texts at a time.

Defined results: null and empty texts are the same text of no characters; rows with one key are ordered by text, null
keys come last; repeated rows follow each other; a lone document follows itself; other columns are not read; an empty
table gives an empty table. Keys are whole numbers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import partitions
from footfall.session import materialize

# Frequent function words of English, German, French and Spanish.
ANCHORS = (
    "a an and are at be but by for from had has have in is it not of on or that the this to was were with "
    "auf das dem den der des die ein eine für ist mit nicht sich und von zu "
    "au ce dans en est et la le les par pas pour que qui sur un une "
    "con de del el los las no por se su una"
).split()
CHAIN = 3
RANGES = 8



def factored(words: list[str]) -> str:
    """A pattern for these words that looks at each character once: common beginnings are taken out."""
    after: dict[str, list[str]] = {}
    for word in sorted(set(words)):
        if word:
            after.setdefault(word[0], []).append(word[1:])
    parts = [first + factored(rest) for first, rest in after.items()]
    if "" in words:
        return f"(?:{'|'.join(parts)})?" if parts else ""
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


_ANY = factored(ANCHORS)
_NEXT = rf" (?:(?:{_ANY}) )*+([^ ]+)"
SPOT = rf"(?<= )({_ANY})(?={_NEXT * CHAIN} )"


def signatures(text: Column) -> Column:
    """The distinct signatures of a text as an array of hashes, never empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    chain = "".join(f":${i + 2}" for i in range(CHAIN))
    marked = F.regexp_replace(words, SPOT, f"|$1{chain}|")
    spots = F.array_distinct(
        F.transform(F.regexp_extract_all(marked, F.lit(r"\|([^|]+)\|"), F.lit(1)), lambda s: F.xxhash64(s))
    )
    alone = F.array(F.xxhash64(F.when(F.trim(words) == "", text).otherwise(F.trim(words)), F.lit("whole")))
    return F.when(F.size(spots) > 0, spots).otherwise(alone)


def fingerprint(sigs: Column) -> Column:
    """SHA-256 of the sorted signatures, as lower-case hex text."""
    return F.sha2(F.array_join(F.array_sort(sigs).cast("array<string>"), ","), 256)


def likeness(a: Column, b: Column, equal: Column) -> Column:
    """Jaccard similarity of two sets; ``equal`` says that they are known to be the same."""
    common = F.size(F.array_intersect(a, b))
    return F.when(equal, F.lit(1.0)).otherwise(common / (F.size(a) + F.size(b) - common))


def _listed(bounds: list[int]) -> str:
    return f"CAST(split('{','.join(map(str, bounds))}', ',') AS array<bigint>)"


def _range_of(key: str, bounds: list[int]) -> Column:
    """How many of the descending bounds are at least the key: binary search; all of them for a null key."""
    listed = _listed(bounds)
    if not bounds:
        return F.lit(0)
    middle = "CAST((a.lo + a.hi) DIV 2 AS INT)"
    return F.expr(
        f"""aggregate(sequence(0, {math.ceil(math.log2(len(bounds) + 1))}),
        named_struct('lo', 0, 'hi', {len(bounds)}), (a, i) -> CASE WHEN a.lo >= a.hi THEN a
        WHEN {key} IS NULL OR element_at({listed}, {middle} + 1) >= {key} THEN named_struct('lo', {middle} + 1, 'hi', a.hi)
        ELSE named_struct('lo', a.lo, 'hi', {middle}) END, a -> a.lo)"""
    )


def followed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, Window]:
    """Rows (range, echo, id, text) and the window in which the next row is the next document; echoes are extra."""
    rows = docs.select(F.col(key).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    steps = RANGES * partitions(docs.sparkSession)
    cuts = F.percentile_approx("id", [i / steps for i in range(1, steps)], 4 * steps + 10000)
    seen = rows.agg(cuts.alias("cuts"), F.max("id").alias("top")).first()
    bounds = sorted(set(seen["cuts"] or []), reverse=True)
    top = F.lit(seen["top"])
    here = _range_of("id", bounds)
    # A row whose key is its range's bound may be the first of the range.
    first = F.expr(f"range > 0 AND element_at({_listed(bounds)}, greatest(range, 1)) <=> id") if bounds else F.lit(False)
    places = F.array_compact(
        F.array(
            F.struct(F.col("range").alias("range"), F.lit(0).alias("echo")),
            F.when(first, F.struct((F.col("range") - 1).alias("range"), F.lit(1).alias("echo"))),
            F.when(F.col("id").eqNullSafe(top), F.struct(F.lit(len(bounds)).alias("range"), F.lit(2).alias("echo"))),
        )
    )
    spread = rows.withColumn("range", here).withColumn("place", F.explode(places))
    spread = spread.select("place.range", "place.echo", "id", "text")
    window = Window.partitionBy("range").orderBy("echo", F.col("id").desc_nulls_last(), "text")
    return spread, window


def edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document beside its edited text and the next document: see ``report`` for the columns."""
    spread, window = followed(docs, key, text)
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    paired = spread.withColumn("next", F.lead("text").over(window)).withColumn("n_chars", n)
    new = F.concat(F.expr("substring(text, 1, n_chars - CAST(floor(n_chars / 3) AS INT))"), F.substring("next", F.lit(1), third))
    both = paired.withColumn("new", F.coalesce(new, F.lit(""))).select(
        "range", "echo", "id", "text", F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("new", 256).alias("edited_sha256"), signatures(F.col("text")).alias("sigs"),
        signatures(F.col("new")).alias("edited_sigs"),
    )
    both = both.withColumns({"fingerprint": fingerprint(F.col("sigs")), "edited_fingerprint": fingerprint(F.col("edited_sigs"))})
    return both.withColumns(
        {"next_sigs": F.lead("sigs").over(window), "next_fingerprint": F.lead("fingerprint").over(window)}
    ).where("echo = 0")


def report(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = edited(docs, key)
    near = lambda other: likeness(
        F.col("sigs"), F.col(f"{other}_sigs"), F.col("fingerprint") == F.col(f"{other}_fingerprint")
    )
    return rows.select(
        F.col("id").alias(key), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        near("edited").alias("near_edited"), near("next").alias("near_next"),
    )


def matches(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Near duplicates: (membership, pairs).

    ``membership`` has each document's key and fingerprint; equal fingerprints are one class. ``pairs`` has the pairs
    (a, b, likeness) of fingerprints, a < b, whose sets have a Jaccard similarity of at least ``percent`` per cent.

    Sets are partitioned by length so that a set's matches are in its own partition or the next longer one. Inside a
    partition sets meet on their rarest signatures, as many as the threshold leaves open; a pair is dropped when its
    lengths, or what follows the places where they met, cannot reach the threshold, and compared wholly otherwise.
    Classes that are all alike are all matches: their pairs are the result, not a by-product.
    """
    sets = docs.select(F.col(key).alias(key), signatures(F.col(text)).alias("sigs"))
    sets = sets.withColumn("fingerprint", fingerprint(F.col("sigs")))
    classes = materialize(sets.groupBy("fingerprint").agg(F.first("sigs").alias("sigs")), "spot_classes")
    each = classes.select("fingerprint", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    often = each.groupBy("sig").agg(F.count(F.lit(1)).alias("often"))
    ranked = each.join(often, "sig").withColumn(
        "pos", F.row_number().over(Window.partitionBy("fingerprint").orderBy("often", "sig"))
    )
    open_ = F.expr(f"n - ({percent} * n + 99) DIV 100 + 1")
    log = F.log(F.col("n")) / math.log(100 / percent)
    # The margin keeps lengths on a bound in both partitions' reach, whatever the rounding of the logarithm.
    index = ranked.where(F.col("pos") <= open_).select("fingerprint", "n", "pos", "sig", F.floor(log + 1e-9).alias("part"))
    index = materialize(index, "spot_index")
    reach = index.withColumn("part", F.explode(F.array(F.col("part"), F.col("part") + 1)))
    a = reach.select("sig", "part", *[F.col(c).alias(f"{c}_a") for c in ("fingerprint", "n", "pos")])
    b = index.select("sig", "part", *[F.col(c).alias(f"{c}_b") for c in ("fingerprint", "n", "pos")])
    met = a.join(b, ["sig", "part"]).where(
        f"fingerprint_a != fingerprint_b AND n_a <= n_b AND 100 * n_a >= {percent} * n_b AND {100 + percent} * "
        f"(least(pos_a, pos_b) + least(n_a - pos_a, n_b - pos_b)) >= {percent} * (n_a + n_b)"
    )
    low, high = F.least("fingerprint_a", "fingerprint_b").alias("a"), F.greatest("fingerprint_a", "fingerprint_b").alias("b")
    pairs = met.select(low, high).distinct()
    one, other = (classes.select(F.col("fingerprint").alias(x), F.col("sigs").alias(f"sigs_{x}")) for x in "ab")
    near = likeness(F.col("sigs_a"), F.col("sigs_b"), F.lit(False))
    common = F.size(F.array_intersect("sigs_a", "sigs_b"))
    enough = 100 * common >= percent * (F.size("sigs_a") + F.size("sigs_b") - common)
    found = pairs.join(one, "a").join(other, "b").where(enough).select("a", "b", near.alias("likeness"))
    return sets.select(key, "fingerprint"), found

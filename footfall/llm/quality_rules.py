"""Quality rules whose thresholds adapt to each language and source.

A mergeable sketch of each measure's distribution is kept per (lang, source): counts
of values rounded down to ``SKETCH_BITS`` leading bits. Such sketches are added up by plain counting, in any order
and with one result, have at most a few thousand cells however many rows they cover, and give quantiles with a
relative error under 1 / 2**(SKETCH_BITS - 1). Thresholds are fences read off the sketches and joined back.

A group's own fence lies ``FENCE`` times the way from its median to its 90% quantile beyond the latter, and a small
distance more. Where more than a tenth of a group is junk, that quantile is a junk value. So the fence is at most the
greater of two others: what the lower half gives when mirrored at the median, which reads no junk up to half of the
group and leaves a group its place whose good documents differ from all others; and the language's fence, the median of
the own fences of its groups, each with the bit length of its size as weight, which half of a language's sources may not
move. A group's fences are blended with its language's, and a language's with that of all groups, as if ``PRIOR``
documents more had the coarser one, so a verdict does not jump as a group grows. Junk in over a tenth of the documents of
most sources moves the fences of all.

Defined results: a null text is empty (no words; it fails the base rule); null languages and sources are groups of
their own; repeated rows are judged one by one and alike; other columns are carried along untouched, whatever their
names; very long texts are measured whole, a slice of a
batch at a time; an empty table gives an empty table.
"""

from __future__ import annotations

from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import WORDS, slices, whole, worker_cache
from footfall.session import materialize

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT = 30  # per cent of the words
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks", "n_echoes")
SCHEMA = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])
BASE = MEASURES[:5]
SKETCH_BITS = 7

# Adaptive rules: (name, value as a SQL expression over the measures in whole numbers, least distance of the fence
# from the quantile). A value beyond its fence is rejected.
RULES = (
    ("symbols", "1000 * n_symbols DIV greatest(word_chars, 1)", 60),
    ("marks", "1000 * n_marks DIV greatest(word_chars, 1)", 60),
    ("dup_lines", "1000 * n_dup_lines DIV greatest(n_lines, 1)", 350),
    ("echoes", "1000 * n_echoes DIV greatest(n_words, 1)", 40),
    ("long_words", "100 * word_chars DIV greatest(n_words, 1)", 60),
)
FENCE = 6
PRIOR = 30
SLICE = 1 << 20  # bytes of text measured at a time


def repeated_words(words: list[str], width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words which the text has twice or more, by exact ranks of windows."""
    n = len(words)
    if n <= width:
        return 0
    ids: dict[str, int] = {}
    rank = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    if len(ids) == n:
        return 0
    step = 1
    while step < width:
        pairs = rank[:-step] * (int(rank.max()) + 1) + rank[step:]
        rank = np.unique(pairs, return_inverse=True)[1]
        step *= 2
    again = np.bincount(rank)[rank] > 1
    if not again.any():
        return 0
    edges = np.zeros(n + 1, np.int64)
    edges[: len(again)] += again
    edges[width : width + len(again)] -= again
    return int((np.cumsum(edges)[:n] > 0).sum())


def measure(text: str) -> tuple[int, ...]:
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if x.strip(" \t\v\f\r")]
    chars = sum(map(len, words))
    symbols = sum(map(text.count, SYMBOLS))
    marks = sum(map(text.count, "!?;:=_~^+/\\@"))
    echoes = sum(map(eq, words, islice(words, 1, None)))
    return (len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines), marks, echoes)


@F.arrow_udf(SCHEMA)
def _measures(texts: pa.Array) -> pa.Array:
    worker_cache("measures", list)  # nothing is kept; what other operators kept goes
    batch, found = pa.record_batch({"t": texts}), []
    for part in slices([batch], "t", SLICE):
        found += [measure(whole(t)) for t in part.column("t").to_pylist()]
    columns = zip(*found) if found else [[]] * len(MEASURES)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(MEASURES))


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The document as struct ``row`` and its measures as struct ``m``.

    The explode of one keeps later filters from measuring again, in Python workers of their own.
    """
    each = docs.select(F.struct("*").alias("row"), F.col(text).alias("t"))
    return each.select("row", F.explode(F.array(_measures("t"))).alias("m"))


def _failed_base() -> Column:
    return F.expr(f"m.n_words < {MIN_WORDS} OR 100 * m.n_repeat_words > {MAX_REPEAT} * m.n_words")


def sketches(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Sketch cells (lang, source, rule, cell, n) over the documents that pass the base rule."""
    good = measured.where(~_failed_base()).select(
        F.col("row")[lang].alias("lang"), F.col("row")[source].alias("source"), "m.*"
    )
    rules = ", ".join(f"'{name}', {value}" for name, value, _ in RULES)
    values = good.selectExpr("lang", "source", f"stack({len(RULES)}, {rules}) AS (rule, value)")
    drop = f"greatest(length(bin(value)) - {SKETCH_BITS}, 0)"
    cells = values.withColumn("cell", F.expr(f"shiftleft(shiftright(value, {drop}), {drop})"))
    return cells.groupBy("lang", "source", "rule", "cell").agg(F.count(F.lit(1)).alias("n"))


def quantiles(cells: DataFrame) -> DataFrame:
    """Rows (lang, source, rule, n, q10, q50, q90): the least cell that so many per cent of the values do not pass."""
    group = Window.partitionBy("lang", "source", "rule")
    up = group.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = cells.withColumns({"reached": F.sum("n").over(up), "total": F.sum("n").over(group)})
    return ranked.groupBy("lang", "source", "rule").agg(
        F.max("total").alias("n"),
        *[F.min(F.expr(f"CASE WHEN 100 * reached >= {p} * total THEN cell END")).alias(f"q{p}") for p in (10, 50, 90)],
    )


def medians(groups: DataFrame, *keys: str) -> DataFrame:
    """Rows (keys, rule, n, fence): documents, and the median of the groups' own fences; one row per group is read."""
    part = Window.partitionBy(*keys, "rule")
    up = part.orderBy("own", "n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    weight = F.length(F.bin("n"))
    ranked = groups.withColumns({"reached": F.sum(weight).over(up), "total": F.sum(weight).over(part)})
    middle = F.min(F.expr("CASE WHEN 2 * reached > total THEN own END"))
    return ranked.groupBy(*keys, "rule").agg(F.sum("n").alias("n"), middle.alias("fence"))


def fences(cells: DataFrame) -> DataFrame:
    """One row (lang, source, fence_<rule>...) for each group that has a document passing the base rule."""
    least = "CASE rule " + " ".join(f"WHEN '{name}' THEN {distance}" for name, _, distance in RULES) + " END"
    groups = quantiles(cells).withColumns(
        {
            "own": F.expr(f"q90 + {FENCE} * (q90 - q50) + {least}"),
            "mirrored": F.expr(f"q50 + {FENCE} * (q50 - q10) + {least}"),
        }
    )
    groups = materialize(groups.select("lang", "source", "rule", "n", "own", "mirrored"), "quantiles")
    by_lang, by_all = medians(groups, "lang").alias("l"), medians(groups).alias("a")
    blend = lambda value, n, coarser: f"(({n}) * ({value}) + {PRIOR} * ({coarser})) DIV (({n}) + {PRIOR})"
    joined = groups.alias("g").join(by_lang, F.expr("g.rule = l.rule AND g.lang <=> l.lang")).join(by_all, F.expr("g.rule = a.rule"))
    joined = joined.select("g.*", F.expr(blend("l.fence", "l.n", "a.fence")).alias("coarse"))
    fence = f"least({blend('own', 'n', 'coarse')}, greatest({blend('mirrored', 'n', 'coarse')}, coarse))"
    each = [F.max(F.expr(f"CASE WHEN rule = '{name}' THEN {fence} END")).alias(f"fence_{name}") for name, _, _ in RULES]
    return joined.groupBy("lang", "source").agg(*each)


def judged(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``measured`` (row, m), which is read twice, with base_failed and kept."""
    limits = materialize(fences(sketches(measured, lang, source)), "fences").alias("f")
    rows = measured.withColumns(
        {"lang_": F.col("row")[lang], "source_": F.col("row")[source], "base_failed": _failed_base()}
    )
    joined = rows.join(limits, F.expr("lang_ <=> f.lang AND source_ <=> f.source"), "left")
    within = " AND ".join(f"{_of_struct(value)} <= fence_{name}" for name, value, _ in RULES)
    return joined.select("row", "m", "base_failed", F.expr(f"NOT base_failed AND {within}").alias("kept"))


def _of_struct(value: str) -> str:
    for name in MEASURES:
        value = value.replace(name, f"m.{name}")
    return value


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that are kept, with the columns of ``docs``.

    Texts are measured twice, for the sketches and for the verdict: a stored copy of them all would be dearer.
    """
    return judged(with_measures(docs, text), lang, source).where("kept").select("row.*")


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per document: key, the base measures, base_failed, kept. Measures are stored without the texts."""
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    measured = with_measures(slim).withColumn("row", F.col("row").dropFields("text"))
    return judged(materialize(measured, "measured")).select(
        F.col("row.key").alias(key), *[F.col(f"m.{name}").alias(name) for name in BASE], "base_failed", "kept"
    )

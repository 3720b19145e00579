"""Order messages to running totals, as Structured Streaming queries.

``start_order_stream`` parses each micro-batch once, adds up its orders per minute and stores these totals, and its
unreadable messages with their reason, in folders named by the batch's number. A replayed batch writes the same folders
again, so nothing is counted twice. Readers add the batches up; hours and days are added up from minutes. As times are
checked, a day has 1,440 minutes at most however many orders come.

Every so many batches the totals are folded into one folder that replaces all batches so far. Readers take the newest
finished fold and the batches after it. What a fold replaced is deleted by the next fold, so a reader that began
before a fold still finds its files. Rejects are folded into one folder for each such time.

Late orders count towards the day in the message. Where old days must stay closed, ``watermark`` sends orders that are
more than that much older than the newest order of earlier batches to the rejects, with reason ``late``; orders more
than ``ahead`` later than their arrival are rejected as ``future`` then, so that one wrong clock does not close the days
of all others. ``distinct`` drops orders whose id came before within that time of arrival: a keyed state with expiry.

Messages that tell where they come from (columns ``source`` and ``offset``, see ``sources.orders``) get a ledger: beside
each batch's totals stands how far it read each source, finished together with them. A query that starts without its
checkpoint goes on from there: it numbers its batches after those stored and leaves out what they read.

``start_window_stream`` keeps the totals in Spark's state store instead: event-time windows in update mode, dropped from
the state once the watermark has passed them. Each batch stores the windows it changed, as they are then.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from footfall.operators.order_stats import GRAINS, order_stats, roll_up, to_counters, to_hash_fields
from footfall.schemas import TOTALS_SCHEMA
from footfall.sources.orders import accepted_orders, parse_orders, rejected_orders

REJECT_SCHEMA = "value string, reject_reason string"
LEDGER_SCHEMA = "source string, next bigint"
# The ledger's name for the newest minute of an order, as a number.
NEWEST = "newest minute"
COUNTS = "orders"  # the observation of a batch


def _fs(spark: SparkSession, text: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _beside(root: str, name: str) -> str:
    return f"{root.rstrip('/')}_{name}"


def _finished(spark: SparkSession, root: str) -> tuple[list[tuple[int, str]], list[tuple[int, str]]]:
    """(last batch, folder) of the finished folds, newest first, and of the finished batches."""
    path, fs = _fs(spark, root)
    folds, batches = [], []
    for status in fs.listStatus(path) if fs.exists(path) else []:
        folder = status.getPath().toString()
        kind, _, rest = status.getPath().getName().partition("-")
        if kind in ("fold", "batch") and fs.exists(_fs(spark, f"{folder}/_SUCCESS")[0]):
            (folds if kind == "fold" else batches).append((int(rest.split("-")[0]), folder))
    return sorted(folds, reverse=True), sorted(batches)


def _stored(spark: SparkSession, root: str, schema, before: int | None = None) -> DataFrame | None:
    """Rows of the newest fold and of the batches after it; with ``before``, of the batches before that one."""
    folds, batches = _finished(spark, root)
    if before is not None:
        folds = [f for f in folds if f[0] < before]
        batches = [b for b in batches if b[0] < before]
    last = folds[0][0] if folds else -1
    paths = [folder for _, folder in folds[:1]] + [folder for number, folder in batches if number > last]
    return spark.read.schema(schema).parquet(*paths) if paths else None


def _last_number(spark: SparkSession, root: str) -> int:
    folds, batches = _finished(spark, root)
    return max([n for n, _ in folds[:1]] + [n for n, _ in batches[-1:]], default=-1)


def read_minutes(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """Current totals per minute; with ``before``, those of the batches before that one."""
    stored = _stored(spark, root, TOTALS_SCHEMA, before)
    if stored is None:
        return spark.createDataFrame([], TOTALS_SCHEMA)
    sums = [F.sum(c).alias(c) for c in ("total", "success", "fee")]
    return stored.groupBy(*GRAINS["minute"]).agg(*sums, F.max("batch_id").alias("batch_id"))


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """(source, next): the first offset of each source that no finished batch of the totals has read."""
    number = _last_number(spark, root)
    stored = _stored(spark, _beside(root, "offsets"), LEDGER_SCHEMA, number + 1)
    if stored is None:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return stored.groupBy("source").agg(F.max("next").alias("next"))


def starting_offsets(spark: SparkSession, root: str) -> str | None:
    """The ledger as the ``startingOffsets`` of a topic subscription; null without one."""
    topics: defaultdict[str, dict[str, int]] = defaultdict(dict)
    for r in read_ledger(spark, root).where(F.col("source") != NEWEST).collect():  # a row per topic partition
        topic, _, partition = r["source"].rpartition("-")
        topics[topic][partition] = r["next"]
    return json.dumps(topics) if topics else None


def read_totals(spark: SparkSession, root: str) -> DataFrame:
    """Current totals per day, hour and minute, marked by ``grain``."""
    return roll_up(read_minutes(spark, root))


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """All messages that were not counted, with their reason."""
    folds, batches = _finished(spark, root)
    last = folds[0][0] if folds else -1
    paths = [folder for _, folder in folds] + [folder for number, folder in batches if number > last]
    return spark.read.schema(REJECT_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], REJECT_SCHEMA)


def _fold(spark: SparkSession, root: str, last: int, rows: DataFrame, replaces: bool) -> None:
    """Store ``rows`` as the fold up to batch ``last`` and delete what the fold before replaced: the batches it holds and,
    if folds replace each other, the folds before it."""
    folds, batches = _finished(spark, root)
    rows.repartition(1).write.parquet(f"{root.rstrip('/')}/fold-{last:012d}-{uuid.uuid4().hex}")
    if folds:
        old = (folds[1:] if replaces else []) + [b for b in batches if b[0] <= folds[0][0]]
        for _, folder in old:
            path, fs = _fs(spark, folder)
            fs.delete(path, True)


def compact_totals(spark: SparkSession, root: str, read: Callable[..., DataFrame] = read_minutes) -> None:
    """Fold the finished batches into one folder and delete what the fold before replaced; the same for the ledger."""
    last = _last_number(spark, root)
    folds, _ = _finished(spark, root)
    if last < 0 or (folds and folds[0][0] == last):
        return
    _fold(spark, root, last, read(spark, root, last + 1).select(*TOTALS_SCHEMA.names), True)
    ledger = read_ledger(spark, root)
    if _finished(spark, _beside(root, "offsets"))[1]:
        _fold(spark, _beside(root, "offsets"), last, ledger, True)


def compact_rejects(spark: SparkSession, root: str, rejects: str) -> None:
    """Fold the rejects of the batches since the last such fold, up to the last finished batch of the totals."""
    folds, batches = _finished(spark, rejects)
    last = _last_number(spark, root)
    paths = [folder for number, folder in batches if (folds[0][0] if folds else -1) < number <= last]
    if paths:
        _fold(spark, rejects, last, spark.read.schema(REJECT_SCHEMA).parquet(*paths), False)


def _write_minutes(rows: DataFrame, folder: str) -> None:
    """Write totals per minute as a file or so for each day.

    They are shuffled once more, few rows, so that each part of the totals is added up in a task of its own: a
    ``coalesce(1)`` would put all parts into one task, whose memory grows with the number of shuffle partitions.
    """
    rows.select(*TOTALS_SCHEMA.names).repartition("day").write.mode("overwrite").parquet(folder)


def _at(text: Column) -> Column:
    return F.try_to_timestamp(F.concat(text, F.lit("+0000")), F.lit("yyyyMMddHHmmZ"))


def _with_late(parsed: DataFrame, root: str, watermark: str, ahead: str) -> DataFrame:
    """Mark orders that are too late for the ledger's newest minute, or too early for the clock."""
    spark = parsed.sparkSession
    newest = read_ledger(spark, root).where(F.col("source") == NEWEST).first()
    time = _at(F.substring("time", 1, 12))
    open_ = F.col("reject_reason").isNull()
    reason = F.when(open_ & (time > F.current_timestamp() + F.expr(f"INTERVAL {ahead}")), "future")
    if newest:
        limit = _at(F.lit(f"{newest['next']:012d}")) - F.expr(f"INTERVAL {watermark}")
        reason = reason.when(open_ & (time < limit), "late")
    return parsed.withColumn("reject_reason", reason.otherwise(F.col("reject_reason")))


def batch_writer(
    root: str, rejects: str, compact_every: int = 500, watermark: str | None = None, ahead: str = "1 day", first: int = 0
):
    """A ``foreachBatch`` function that stores a parsed batch's totals, rejects and ledger; the totals come last.

    ``first`` is the number of the query's first batch.
    """

    def store(parsed: DataFrame, batch_id: int) -> None:
        spark, number = parsed.sparkSession, first + batch_id
        name = f"batch-{number:012d}"
        if watermark:
            parsed = _with_late(parsed, root, watermark, ahead)
        parsed = parsed.persist()  # parsed once for all tables
        try:
            bad = rejected_orders(parsed)
            if bad.isEmpty():
                path, fs = _fs(spark, f"{rejects.rstrip('/')}/{name}")
                fs.delete(path, True)  # of the batch's first try, if it had another clock
            else:
                # Few rows from many tasks: rebalance them into few files.
                bad.hint("rebalance").write.mode("overwrite").parquet(f"{rejects.rstrip('/')}/{name}")
            good = accepted_orders(parsed)
            read = []
            if "source" in parsed.columns:
                read.append(parsed.groupBy("source").agg((F.max("offset") + 1).alias("next")))
            if watermark:
                newest = F.max(F.concat("day", "hour", "minute").cast("bigint"))
                read.append(good.agg(newest.alias("next")).select(F.lit(NEWEST).alias("source"), "next").where("next IS NOT NULL"))
            if read:
                ledger = read[0] if len(read) == 1 else read[0].unionByName(read[1])
                ledger.repartition(1).write.mode("overwrite").parquet(f"{_beside(root, 'offsets')}/{name}")
            rows = order_stats(good, "minute").withColumn("batch_id", F.lit(number).cast("bigint"))
            _write_minutes(rows, f"{root.rstrip('/')}/{name}")
        finally:
            parsed.unpersist()
        if compact_every and number % compact_every == compact_every - 1:
            compact_rejects(spark, root, rejects)
            compact_totals(spark, root)

    return store


def _begin(spark: SparkSession, messages: DataFrame, root: str, checkpoint: str) -> tuple[DataFrame, int]:
    """The messages that no batch stored before this checkpoint has read, and the number of its first batch.

    Both are kept with the checkpoint: a restart must find them as they were at its beginning.
    """
    note, fs = _fs(spark, f"{checkpoint.rstrip('/')}/resumed")
    held = f"{checkpoint.rstrip('/')}/resumed_from"
    fresh = not fs.exists(_fs(spark, f"{checkpoint.rstrip('/')}/offsets")[0])
    first = 0
    if fs.exists(note):
        first = int([s.getPath().getName() for s in fs.listStatus(note)][0])
    elif fresh and (first := _last_number(spark, root) + 1):
        read_ledger(spark, root).where(F.col("source") != NEWEST).write.mode("overwrite").parquet(held)
        fs.create(_fs(spark, f"{checkpoint.rstrip('/')}/resumed/{first}")[0], True).close()
    if not first or "source" not in messages.columns:
        return messages, first
    ledger = spark.read.schema(LEDGER_SCHEMA).parquet(held).select(F.col("source").alias("_source"), "next")
    joined = messages.join(ledger, F.col("source") == F.col("_source"), "left")
    return joined.where(F.col("next").isNull() | (F.col("offset") >= F.col("next"))).select(*messages.columns), first


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def distinct_orders(parsed: DataFrame, within: str) -> DataFrame:
    """Without orders whose id came before within that time: a producer's resend counts once.

    Time is that of arrival, so no order is too late for it, and an id is forgotten ``within`` after it came. Messages
    that are no orders, or have no id, all stay.
    """
    known = F.col("reject_reason").isNull() & F.col("orderid").isNotNull()
    arrived = parsed.where(known).withColumn("arrived", F.current_timestamp()).withWatermark("arrived", within)
    once = arrived.dropDuplicatesWithinWatermark(["orderid"]).drop("arrived")
    return once.unionByName(parsed.where(~known))


def start_order_stream(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    every: str | None = "5 seconds",
    watermark: str | None = None,
    compact_every: int = 500,
    rejects: str | None = None,
    distinct: str | None = None,
    ahead: str = "1 day",
) -> StreamingQuery:
    """Start the query. ``every=None`` works off what has arrived and stops.

    Rejects go to ``rejects``, or else beside the totals to ``<root>_rejects``.
    """
    messages, first = _begin(messages.sparkSession, messages, root, checkpoint)
    parsed = parse_orders(messages)
    if distinct:
        parsed = distinct_orders(parsed, distinct)
    wrong = F.col("reject_reason").isNotNull()
    parsed = parsed.observe(COUNTS, F.count_if(~wrong).alias("accepted"), F.count_if(wrong).alias("rejected"))
    return (
        parsed.writeStream.foreachBatch(batch_writer(root, rejects or _beside(root, "rejects"), compact_every, watermark, ahead, first))
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def read_windows(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """Totals per minute that ``start_window_stream`` left: of each minute, as the last batch that changed it has them."""
    stored = _stored(spark, root, TOTALS_SCHEMA, before)
    if stored is None:
        return spark.createDataFrame([], TOTALS_SCHEMA)
    newest = F.max(F.struct("batch_id", "total", "success", "fee")).alias("n")
    return stored.groupBy(*GRAINS["minute"]).agg(newest).select(*GRAINS["minute"], "n.total", "n.success", "n.fee", "n.batch_id")


def start_window_stream(
    messages: DataFrame, root: str, checkpoint: str, every: str | None = "5 seconds", watermark: str = "1 hour",
    ahead: str = "1 day", compact_every: int = 500,
) -> StreamingQuery:
    """Totals per minute in event-time windows of the state store, in update mode.

    A window leaves the state once the newest order is ``watermark`` past its end; orders that come later are dropped and
    counted by the query's progress. The watermark follows an order no further than ``ahead`` of its arrival.
    """
    orders = accepted_orders(parse_orders(messages))
    bound = F.current_timestamp() + F.expr(f"INTERVAL {ahead}")
    timed = orders.withColumn("at", F.least(_at(F.substring("time", 1, 12)), bound)).withWatermark("at", watermark)
    totals = order_stats(timed, "minute", F.window("at", "1 minute"))

    def store(changed: DataFrame, batch_id: int) -> None:
        rows = changed.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        _write_minutes(rows, f"{root.rstrip('/')}/batch-{batch_id:012d}")
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact_totals(changed.sparkSession, root, read_windows)

    return (
        totals.writeStream.outputMode("update").foreachBatch(store)
        .option("checkpointLocation", checkpoint).trigger(**_trigger(every)).start()
    )


def store_lookups(spark: SparkSession, root: str, target: str) -> None:
    """Write the current counters and hash fields as two tables under ``target``, each of a size of days and hours."""
    totals = read_totals(spark, root)
    counters = to_counters(totals.where(F.col("grain") == "day"))
    counters.write.mode("overwrite").parquet(f"{target.rstrip('/')}/counters")
    to_hash_fields(totals).write.mode("overwrite").parquet(f"{target.rstrip('/')}/hash_fields")


class BatchCounts(StreamingQueryListener):
    """Accepted and rejected messages of each batch of each query, as the one pass over them counts; see ``add_counts``.

    A message that a watermark turns down later counts as accepted here.
    """

    def __init__(self, note: Callable[[int, int, int], None]):
        self.note = note

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        counts = event.progress.observedMetrics.get(COUNTS)
        if counts is not None:
            self.note(event.progress.batchId, counts["accepted"], counts["rejected"])

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def add_counts(spark: SparkSession, note: Callable[[int, int, int], None]) -> BatchCounts:
    """Call ``note(batch, accepted, rejected)`` after each batch of the session's order streams."""
    listener = BatchCounts(note)
    spark.streams.addListener(listener)
    return listener


def offset_ranges(query: StreamingQuery) -> list[dict]:
    """Start and end offsets of the last finished batch, per source."""
    progress = query.lastProgress
    if progress is None:
        return []
    return [{"source": s["description"], "start": s["startOffset"], "end": s["endOffset"]} for s in progress["sources"]]

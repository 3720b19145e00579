"""Order messages: JSON text in, typed columns out; batch and streaming alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.clock import is_minute, order_day, order_hour, order_minute
from footfall.schemas import ORDER_FIELDS, ORDER_SCHEMA

_BROKEN = "_broken"
_MESSAGE_SCHEMA = T.StructType([*ORDER_SCHEMA.fields, T.StructField(_BROKEN, T.StringType())])


def kafka_options(brokers: str, topics: list[str], starting: str = "latest", **extra: str) -> dict[str, str]:
    """Options of a topic subscription. ``starting`` counts on the first start only;
    afterwards the query's checkpoint holds the offsets."""
    return {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        **extra,
    }


def read_kafka(spark: SparkSession, brokers: str, topics: list[str], **options: str) -> DataFrame:
    """Streaming message text in column ``value``, with topic partition and offset. Needs the Kafka connector package."""
    source = spark.readStream.format("kafka").options(**kafka_options(brokers, topics, **options))
    return from_topic(source.load())


def from_topic(records: DataFrame) -> DataFrame:
    """Columns value, source (topic and partition), offset of a topic's records."""
    place = F.concat_ws("-", "topic", F.col("partition").cast("string"))
    return records.select(F.col("value").cast("string").alias("value"), place.alias("source"), "offset")


def read_files(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Streaming message text from files that arrive in ``path``, one message a line; a file is a source read at once."""
    lines = spark.readStream.format("text").options(**options).load(path)
    return lines.select("value", F.col("_metadata.file_path").alias("source"), F.lit(0).cast("bigint").alias("offset"))


def parse_orders(messages: DataFrame) -> DataFrame:
    """Add the order fields, time parts, ``amount`` and ``reject_reason`` to ``value``.

    ``fee`` travels as quoted text, which a numeric JSON schema would read as null, so
    every field is read as a string and cast afterwards. A broken fee matters only on
    a paid order.
    """
    # As in the access log, explode keeps the JSON parse out of later filters.
    message = F.from_json(
        "value", _MESSAGE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    )
    cut = messages.withColumn("m", F.explode(F.array(message)))
    rows = cut.select(*messages.columns, "m.*", F.col("m").isNull().alias("_empty"))
    rows = rows.withColumns(
        {
            "day": order_day(F.col("time")),
            "hour": order_hour(F.col("time")),
            "minute": order_minute(F.col("time")),
            "amount": F.col("fee").try_cast("bigint"),
        }
    )
    paid = F.coalesce(F.col("flag") == "1", F.lit(False))
    reason = (
        F.when(F.col("_empty") | F.col(_BROKEN).isNotNull(), "json")
        .when(~is_minute(F.col("time")), "time")
        .when(paid & F.col("amount").isNull(), "fee")
    )
    return rows.withColumn("reject_reason", reason).drop("_empty", _BROKEN)


def accepted_orders(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_orders(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNotNull()).select("value", "reject_reason")


def to_messages(orders: DataFrame) -> DataFrame:
    """Order rows as JSON text in column ``value``, ready for a topic or a text file."""
    return orders.select(F.to_json(F.struct(*ORDER_FIELDS)).alias("value"))

"""Event streams: one JSON text a row, from Kafka or from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that one trigger reads, readers of a topic, and broken messages that are put up with, all defaults.
BLOCK_ROWS, READERS, MAX_BROKEN = 65_536, 3, 100


def read_events(spark: SparkSession, topic: str, fmt: str = "kafka", **options) -> DataFrame:
    """A streaming frame with the column `raw`. fmt is kafka (needs its connector) or text (topic is a folder)."""
    if fmt == "kafka":
        reader = spark.readStream.format("kafka").option("subscribe", topic).option("minPartitions", READERS).option("maxOffsetsPerTrigger", BLOCK_ROWS)
        return reader.options(**options).load().select(F.col("value").cast("string").alias("raw"))
    return spark.readStream.format(fmt).options(**options).load(topic).select(F.col("value").alias("raw"))


def split_payload(df: DataFrame) -> DataFrame:
    """Empty rows go; a JSON array becomes a row for each element, as text."""
    text = F.trim("raw")
    elements = F.transform(F.try_variant_get(F.try_parse_json(text), "$", "array<variant>"), lambda v: F.to_json(v))
    pieces = F.when(text.startswith("["), F.coalesce(elements, F.array(text))).otherwise(F.array(text))
    return df.where(F.length(text) > 0).withColumn("raw", F.explode(pieces))


def is_object(raw: Column) -> Column:
    """Whether a text is a JSON object."""
    return F.coalesce(F.schema_of_variant(F.try_parse_json(raw)).startswith("OBJECT"), F.lit(False))


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose raw is a JSON object, the others)."""
    fine = is_object(F.col("raw"))
    return df.where(fine), df.where(~fine)

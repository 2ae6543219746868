"""Append-only ingest of raw events into month partitions."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.fiscal import midnight, month_number
from ..sources.events import BLOCK_ROWS, MAX_BROKEN, is_object, split_payload


#: Raw events are long and alike texts, stored once and read seldom.
CODEC = "zstd"


def stamped(df: DataFrame, zone: str | None = None) -> DataFrame:
    """Raw rows with their time of arrival and its month."""
    return df.withColumn("event_time", F.current_timestamp()).withColumn("event_month", month_number(F.col("event_time"), zone)).select("event_time", "raw", "event_month")


def ingest(stream: DataFrame, path: str, checkpoint: str, quarantine_path: str | None = None, max_broken: int = MAX_BROKEN, every: str | None = None, zone: str | None = None) -> StreamingQuery:
    """Starts the ingest: of what is there (`every` is None), or again and again.

    Rows are written exactly once: by Spark's file sink, or, with a quarantine, into a folder
    for each batch that a repeated batch overwrites. A batch fails if a block of BLOCK_ROWS
    rows that one task read has more broken ones than max_broken.
    """
    rows = split_payload(stream)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    if quarantine_path is None:
        return stamped(rows, zone).writeStream.format("parquet").option("compression", CODEC).partitionBy("event_month").option("checkpointLocation", checkpoint).outputMode("append").trigger(**trigger).start(path)

    def write(batch: DataFrame, number: int) -> None:
        # The id's upper bits are the task, the lower 33 the row in it.
        block = F.floor(F.monotonically_increasing_id() / BLOCK_ROWS)
        rows = batch.withColumns({"_fine": is_object(F.col("raw")), "_block": block}).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            most = rows.where(~F.col("_fine")).groupBy("_block").count().agg(F.max("count")).first()[0] or 0
            if most > max_broken:
                raise ValueError(f"batch {number} has {most} broken messages in a block; {max_broken} are allowed")
            stamped(rows.where("_fine"), zone).write.mode("overwrite").option("compression", CODEC).partitionBy("event_month").parquet(f"{path}/batch_id={number}")
            if most:
                stamped(rows.where(~F.col("_fine")), zone).write.mode("overwrite").parquet(f"{quarantine_path}/batch_id={number}")
        finally:
            rows.unpersist()

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def raw_window(raw: DataFrame, day: str, zone: str | None = None) -> DataFrame:
    """The raw rows that arrived on a day (yyyy-MM-dd); the month partition, of the same zone, prunes files."""
    month = F.lit(day[:4] + day[5:7])
    out = raw.where((F.col("event_time") >= midnight(day, zone)) & (F.col("event_time") < midnight(day, zone, 1)))
    return out.where(F.col("event_month").cast("string") == month) if "event_month" in raw.columns else out

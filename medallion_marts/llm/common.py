"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one of the driver only where none is configured and all runs in one process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not hasattr(spark, "_own_shared_dir"):
        spark._own_shared_dir = tempfile.mkdtemp(prefix="spark-shared-")
    return spark._own_shared_dir


def staged(df: DataFrame, label: str) -> DataFrame:
    """Writes df to the shared folder and reads it back, which cuts its lineage.

    Lost executors then cost no recomputation beyond this point. Spark's JVM deletes
    the files when it ends.
    """
    return staged_with(df, label)[0]


#: Rows of a small table that one task is to work on.
ROWS_A_TASK = 50_000


def staged_with(df: DataFrame, label: str, **more: Column) -> tuple[DataFrame, dict]:
    """`staged`, and aggregates that are taken while it is written: `rows`, and more by name."""
    spark = df.sparkSession
    seen = Observation()
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in more.items()])
    path = f"{shared_dir(spark)}/staged-{uuid.uuid4().hex}/{label}"
    df.write.parquet(path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath.getParent())
    return spark.read.schema(df.schema).parquet(path), seen.get


def sized(df: DataFrame, rows: int) -> DataFrame:
    """df, of so many rows, in no more partitions than they are worth; tables of one partition are grouped and joined without a shuffle."""
    return df.coalesce(max(1, -(-rows // ROWS_A_TASK)))


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; -1 for a null id, so that it is in no chosen fold."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus, F.lit(-1))


#: Rows of an Arrow batch, where the session has Spark's default: texts are long, and either side of
#: a Python worker holds a batch or two.
BATCH_ROWS, DEFAULT_ROWS = 1000, "10000"


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow over small batches, whose memory goes back to the system when a task ends."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(key) == DEFAULT_ROWS:
        conf.set(key, str(BATCH_ROWS))

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return df.mapInArrow(tidied, schema)


def give_back() -> None:
    """Hands freed memory back to the system, which C libraries otherwise keep."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its memory
        pass


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema) -> DataFrame:
    """map_arrow with a function made once per task; it maps a batch to a batch, or to None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = None
        for batch in batches:
            if one is None:
                one = make()
            if batch.num_rows and (out := one(batch)) is not None:
                yield out

    return map_arrow(df, run, schema)


def keep_rows(docs: DataFrame, make: Callable[[], Callable[[pa.Array], list[bool]]], text_col: str = "text") -> DataFrame:
    """The rows of docs, with docs' own columns whatever their names, whose text a function (made once per task) says yes to."""
    where = docs.columns.index(text_col)
    rows = docs.select(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("_row"))

    def per_task():
        keep = make()
        return lambda batch: batch.filter(pa.array(keep(batch.column(0).field(where)), pa.bool_()))

    return map_batches(rows, per_task, rows.schema).select("_row.*")


def quiet_threads() -> None:
    """One thread for each Python worker: Spark already runs one worker for each core."""
    for name in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS", "MKL_NUM_THREADS"):
        os.environ.setdefault(name, "1")
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

"""Landing folder source and append sinks shared by the streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch

# What one micro-batch may read. It bounds the work of a batch and cannot change a result.
MAX_BATCH_BYTES = 1_000_000_000


def landing(spark: SparkSession, path: str, schema: T.StructType, max_bytes: int = MAX_BATCH_BYTES) -> DataFrame:
    """JSON lines as they arrive; a torn line keeps its text in ``_corrupt_record``."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return (
        spark.readStream.schema(full)
        .option("mode", "PERMISSIVE")
        .option("maxBytesPerTrigger", str(max_bytes))
        .json(path)
    )


def close_landing(spark: SparkSession, path: str, schema: T.StructType, time: str = "ts") -> None:
    """Land one last row, in the year 2200: the watermark passes all rows before it, and never the row itself.

    For landings that end. A running stream needs none: newer events move its watermark. The row has no nulls (a
    null key would turn the whole keys of its batch into floats on their way to Python).
    """
    mark = [F.lit("2200-01-01").cast(schema[time].dataType).alias(time)]
    zero = F.lit("0")
    empty = [zero.cast(f.dataType).alias(f.name) for f in schema.fields if f.name != time]
    spark.range(1).select(*mark, *empty).coalesce(1).write.mode("append").json(path)


def drain(stream: DataFrame, label: str) -> DataFrame:
    """Run everything available into a Parquet table and return the table."""
    spark = stream.sparkSession
    out = scratch(spark, label)
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch(spark, f"{label}-checkpoint"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def use_rocksdb(spark: SparkSession) -> None:
    """State store for stateful processors: state spills to local disk instead of the heap."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )

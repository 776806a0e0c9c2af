"""Session settings, shared scratch space and small literal dimensions."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A literal dimension (bands, transitions, term lists) is built on the driver, so
# its row count is known; beyond this many rows it is not marked for broadcast.
MAX_LITERAL_ROWS = 20_000

_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key's partition even where the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows go to Python in batches of so many bytes: 10,000 long texts at once would fill a worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators count on; cluster sizing stays the caller's."""
    for key, value in _RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "genomeloom", **extra: str) -> SparkSession:
    """A session for tests and the bench; a cluster passes its own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own: on a
    cluster executors on other hosts could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_base()
    return f"{base.rstrip('/')}/genomeloom/{label}-{uuid.uuid4().hex}"


_LOCAL_BASE: list[str] = []


def _local_base() -> str:
    if not _LOCAL_BASE:
        _LOCAL_BASE.append(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return _LOCAL_BASE[0]


# Tables that were written by ``materialize`` and not given back yet.
_WRITTEN: list[str] = []


def written() -> list[str]:
    return list(_WRITTEN)


def give_back(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete tables that ``materialize`` wrote; nothing may read them any more."""
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for path in paths:
        if path in _WRITTEN:
            _WRITTEN.remove(path)
            place = path_of(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, label)
    _WRITTEN.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, max_rows: int = MAX_LITERAL_ROWS) -> DataFrame:
    """Mark a dimension for broadcast only after counting that it stays under ``max_rows``.

    The count reads at most one row more than the bound. A larger table comes back
    unmarked, and the join is left to the optimizer.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def literal_table(spark: SparkSession, rows: Sequence[dict], schema: str) -> DataFrame:
    """A driver-built dimension as a local relation; broadcast up to ``MAX_LITERAL_ROWS`` rows."""
    target = spark.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    table = pa.Table.from_pylist(list(rows), schema=to_arrow_schema(target))
    made = spark.createDataFrame(table, schema=target)
    return F.broadcast(made) if len(rows) <= MAX_LITERAL_ROWS else made

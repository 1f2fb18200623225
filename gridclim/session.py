"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Settings the plans are written for. Only SQL settings: a cluster keeps its own
# executors, memory and shuffle service.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}


def local_session(cores: str = "8", app: str = "gridclim") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_base: str | None = None


def scratch_dir(spark: SparkSession) -> str:
    """A fresh path below the folder the cluster shares for checkpoints.

    The folder comes from ``spark.checkpoint.dir``. A machine-local folder is made
    up only when Spark itself is local, where it is the shared folder.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        _local_base = _local_base or tempfile.mkdtemp(prefix="spark-")
        base = _local_base
    return f"{base.rstrip('/')}/gridclim-{uuid.uuid4().hex}"


def materialise(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a result once and read it back.

    Cuts lineage in a way that survives lost executors, and gives the planner the
    file size, so a later join broadcasts it only when it is below
    ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = scratch_dir(spark)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of constants as a local relation, whose exact size the planner knows."""
    struct = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in struct]
    arrow = to_arrow_schema(struct)
    return spark.createDataFrame(
        pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow), struct
    )

"""Session construction for local runs; on a cluster the caller's session is used as it is."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tasks a core that rows are dealt to.
SPREAD = 3


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "4g") -> SparkSession:
    """A local session with adaptive execution, UTC timestamps and a small shuffle width."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("atlasweave")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point the context at the shared checkpoint folder, the session's ``spark.checkpoint.dir``; only
    where that is unset and the master is local is a temporary one made. On a cluster a folder of the
    driver's machine would be of no use, so there it is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="atlasweave-"))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, which outlives any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once, as a table in the shared checkpoint folder, which outlives any executor.

    A checkpoint's rows keep the estimate of the plan that made them, and a join's estimate is the product of its
    sides': over many joins and checkpoints the optimizer ends with numbers of millions of digits. A table has the size
    that was written, is packed, and is read by columns. Columns that parquet has no type for make it a checkpoint.
    """
    kinds = df.schema.simpleString()
    if not df.columns or "void" in kinds or "interval" in kinds:
        return checkpointed(df)
    ensure_checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    # by place, since names may differ in case alone
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    numbered.write.parquet(path)
    return df.sparkSession.read.schema(numbered.schema).parquet(path).toDF(*df.columns)


def stored_lists(df: DataFrame, column: str, sep: str = "/") -> DataFrame:
    """:func:`stored` for a ``column`` of joined values: as arrays on disk, where a value that many rows list is written once a
    block and then goes by a short number. What is read is joined again."""
    return stored(df.withColumn(column, F.split(F.col(column), sep))).withColumn(column, F.array_join(F.col(column), sep))


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over several tasks a core. A scan has no more tasks than its files have row groups, so packed rows that
    take long, such as names to be cleaned, would otherwise be the work of one or two."""
    return df.repartition(SPREAD * df.sparkSession.sparkContext.defaultParallelism)

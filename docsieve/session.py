"""Session set-up for local runs, and the two ways to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PACKAGE = os.path.dirname(os.path.abspath(__file__))
_shipped: set[str] = set()
_local_folders: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Give the session's Python workers this package, once per application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="docsieve-package-"), "docsieve.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for folder, _, files in os.walk(PACKAGE):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    packed.write(path, os.path.relpath(path, os.path.dirname(PACKAGE)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; any other
    master must name one, because its executors could not read such a folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="docsieve-checkpoint-")
    return _local_folders[application]


def stored(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts lineage like a checkpoint, but compressed, prunable and with known
    size, and survives the loss of any executor.  ``schema`` names other types
    with the same stored form to read the columns as.
    """
    path = f"{shared_folder(df.sparkSession)}/docsieve-tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def local_session(cores: int = 8, name: str = "docsieve") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("DOCSIEVE_DRIVER_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and read it back.

    The rows then survive the loss of any executor, and partition numbers and
    row order inside a partition stay fixed.
    """
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


#: Bytes of a table that every task may hold beside its own rows.
BROADCAST_BYTES = 64 << 20


def broadcast_if_small(df: DataFrame, row_bytes: Column | int = 64, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, stored, marked for broadcast if its rows, by their number and the bytes given for each, take at most ``most`` bytes.

    A larger table joins by shuffle as ever; the rows are the same either way.
    """
    kept = stored(df)
    size = kept.agg(F.sum(row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes)).alias("size")).first()["size"] or 0
    return F.broadcast(kept) if size <= most else kept


def shuffle_width(spark: SparkSession) -> int:
    """Number of partitions the session uses for a shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

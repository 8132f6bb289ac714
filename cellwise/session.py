"""Session settings the operators depend on: sizes, parallelism, durable storage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_UNITS = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}

# A hashed (BIGINT, DOUBLE) pair in a broadcast relation: 16 bytes of payload,
# plus the unsafe row header and the hash table slot.
BYTES_PER_CELL = 48


def size_setting(spark: SparkSession, key: str, default: str = "0") -> int:
    """A byte-size setting such as ``10485760b`` or ``64MB`` as a number of bytes."""
    text = spark.conf.get(key, default).strip().lower().removesuffix("ib")
    if text[-1:].isalpha():
        text = text.removesuffix("b") or text
    if text[-1:].isalpha():
        return int(text[:-1]) * _UNITS[text[-1]]
    return int(text)


def broadcast_bytes(spark: SparkSession) -> int:
    """Largest relation the session allows to be broadcast; 0 when switched off."""
    return max(0, size_setting(spark, "spark.sql.autoBroadcastJoinThreshold", "10485760"))


def fits_broadcast(spark: SparkSession, rows: int, bytes_per_row: int = BYTES_PER_CELL) -> bool:
    return rows * bytes_per_row <= broadcast_bytes(spark)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: as the cluster names it, else below the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    spark.sparkContext.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch")
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into reliable storage and drop its lineage.

    Written blocks outlive executors, and later stages read exactly these rows.
    """
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        folder = shared_folder(df.sparkSession)
        if df.sparkSession.sparkContext.getCheckpointDir() is None:
            df.sparkSession.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def sized(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` written durably and counted, with a broadcast hint if that count fits.

    For the short lists that steer a join, such as heavy keys. Planned from estimates,
    the large side would be shuffled before the list's real size is known.
    """
    written = durable(df)
    rows = written.count()
    return (F.broadcast(written) if fits_broadcast(df.sparkSession, rows) else written), rows

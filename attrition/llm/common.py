"""Small Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(id_col: str, m: int) -> Column:
    """``crc32(id as text) mod m`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(m)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


HOT_ROWS = 1_000  # rows of one key that are never too many for a task
HOT_KEYS = 50_000  # most keys that are broadcast


def meet(rows: DataFrame, found: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` with the columns of ``found``, which has one row for each key, and their number n.

    Keys of so many rows that they would crowd one task, at most ``HOT_KEYS`` of them, are broadcast.
    """
    limit = hot_limit(found.agg(F.sum("n")).first()[0] or 0)
    hot = found.where(F.col("n") > limit).drop("n")
    if hot.isEmpty():
        return rows.join(found.drop("n"), key)
    rest = rows.join(F.broadcast(hot.select(*key)), key, "left_anti").join(found.where(F.col("n") <= limit).drop("n"), key)
    return rest.unionByName(rows.join(F.broadcast(hot), key))


def hot_limit(total: int) -> int:
    """Rows beyond which a key is hot; at most ``HOT_KEYS`` keys of ``total`` rows are."""
    return max(HOT_ROWS, total // HOT_KEYS)

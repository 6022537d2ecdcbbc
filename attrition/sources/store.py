"""Model versions and fingerprinted tables.

Both live under a base folder on the cluster's shared file system and are
listed through the Hadoop FileSystem API, so local paths, HDFS and object
stores behave alike.
"""

from __future__ import annotations

import hashlib
import json
import random
import time
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.sources.assets import listing_identity, newest_table
from attrition.sources.files import _jvm_fs, path_exists, subfolders

COMMITTED = "_COMMITTED"  # put into a version's folder when all of it is there


def _versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of all version folders, complete or not."""
    numbers = (n.split("=", 1)[1] for n in subfolders(spark, folder) if n.startswith("version="))
    return sorted(int(n) for n in numbers if n.isdigit())


def _committed(spark: SparkSession, folder: str, version: int) -> bool:
    return path_exists(spark, f"{folder}/version={version}/{COMMITTED}")


def save_model(pm: PipelineModel, base: str, name: str) -> int:
    """Save as the next version of ``name``; returns the version number.

    A version is claimed by a file of its own name; the claim holds if no other
    saver's file is seen beside it afterwards (the later of two always sees the
    earlier).  Savers that meet go on to higher numbers, so no model is lost.
    The version is published by a marker written after everything else: until
    then, and for ever if the saver dies, no loader sees it.
    """
    spark = SparkSession.builder.getOrCreate()
    version = max(_versions(spark, f"{base}/{name}"), default=0) + 1
    while (others := _claim(spark, f"{base}/{name}/claims/{version}")):
        version += random.randint(1, others + 1)
    pm.write().save(f"{base}/{name}/version={version}")
    fs, marker = _jvm_fs(spark, f"{base}/{name}/version={version}/{COMMITTED}")
    fs.create(marker).close()
    return version


def _claim(spark: SparkSession, folder: str) -> int:
    """Put a claim into the folder; how many claims of others are there."""
    fs, mine = _jvm_fs(spark, f"{folder}/{uuid.uuid4().hex}")
    fs.create(mine).close()
    return len([st for st in fs.listStatus(mine.getParent()) if not st.getPath().getName().startswith(".")]) - 1


def load_model(base: str, name: str, version: int | str = "latest", with_version: bool = False):
    """Load a version, or the highest published one for ``'latest'``; with its number if asked for."""
    spark = SparkSession.builder.getOrCreate()
    folder = f"{base}/{name}"
    if version == "latest":
        version = next((v for v in reversed(_versions(spark, folder)) if _committed(spark, folder, v)), None)
        if version is None:
            raise FileNotFoundError(f"no published version of model {name!r} under {base}")
    elif not _committed(spark, folder, int(version)):
        raise FileNotFoundError(f"version {version} of model {name!r} under {base} is not published")
    model = PipelineModel.load(f"{folder}/version={int(version)}")
    return (model, int(version)) if with_version else model


def fingerprint(df: DataFrame, params: dict | None = None) -> str:
    """Content hash of a table: row count and the sum of 64-bit row hashes
    (order-free, one aggregate pass), combined with the parameters."""
    row = df.select(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")).alias("h"),
    ).first()
    payload = json.dumps({"n": row["n"], "h": str(row["h"]), "cols": df.columns, "p": params or {}}, sort_keys=True)
    return hashlib.sha256(payload.encode()).hexdigest()[:16]


def file_fingerprint(spark: SparkSession, source_path: str, params: dict | None = None) -> str:
    """Identity of a table from the listing of its files and the parameters; no job runs and no data is read."""
    payload = json.dumps({"files": listing_identity(spark, source_path), "p": params or {}}, sort_keys=True)
    return hashlib.sha256(payload.encode()).hexdigest()[:16]


def materialize(df: DataFrame, base: str, params: dict | None = None, ttl_s: float = 3600.0,
                source: DataFrame | None = None, source_path: str | None = None) -> tuple[DataFrame, bool]:
    """Write ``df`` once under ``base/fp=<fingerprint>/t=<epoch ms>`` and reuse the
    newest complete copy while it is younger than ``ttl_s``.  Returns (table, hit).

    The fingerprint covers ``params`` and the input the derived table depends on: the files under
    ``source_path`` by their listing (a hit then runs no job over the source), or else the content of
    ``source`` (default: ``df``), one scan.  A hit skips recomputing ``df``.
    A refresh writes a new ``t=`` folder instead of overwriting, so tables
    handed out earlier stay readable.
    """
    spark = df.sparkSession
    if source_path is not None:
        fp = file_fingerprint(spark, source_path, params)
    else:
        fp = fingerprint(source if source is not None else df, params)
    folder = f"{base}/fp={fp}"
    kept = newest_table(spark, folder, ttl_s)
    if kept is not None:
        return spark.read.parquet(kept), True
    path = f"{folder}/t={int(time.time() * 1000)}"
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path), False

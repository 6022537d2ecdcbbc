"""File sources and sinks (S1-S6): CSV/Parquet customer tables, prediction
exports with a write receipt, read-or-sample."""

from __future__ import annotations

import concurrent.futures as cf
import csv
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.schema import CUSTOMER
from attrition.sources import samples

KNOWN_TYPES = {f.name: f.dataType for f in CUSTOMER.fields}


def _jvm_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence through the Hadoop file system of the path (local, HDFS, object stores)."""
    fs, p = _jvm_fs(spark, path)
    return bool(fs.exists(p))


@dataclass(frozen=True)
class FileInfo:
    """A data file: name relative to the folder that was listed, full path, length, modification time (ms)."""

    name: str
    path: str
    length: int
    modified: int


def list_files(spark: SparkSession, path: str) -> list[FileInfo]:
    """The data files under a path (or the file itself), sorted by name; names that start with ``_`` or ``.`` are not data."""
    fs, p = _jvm_fs(spark, path)
    if not fs.exists(p):
        return []
    root = fs.getFileStatus(p).getPath().toString()
    out = []
    found = fs.listFiles(p, True)
    while found.hasNext():
        st = found.next()
        full = st.getPath().toString()
        name = full[len(root):].lstrip("/")
        if not any(part[:1] in ("_", ".") for part in name.split("/") if "=" not in part):
            out.append(FileInfo(name, full, int(st.getLen()), int(st.getModificationTime())))
    return sorted(out, key=lambda f: f.name)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under a path (none if it does not exist)."""
    fs, p = _jvm_fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


# Files whose first lines are read at the same time.
HEADER_READERS = 16


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, read by the file system: some buffers of it, whatever its length.

    Compressed files are decoded as far as that line.  None for an empty file.
    """
    fs, p = _jvm_fs(spark, path)
    jvm = spark.sparkContext._jvm
    raw = fs.open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(p)
        stream = raw if codec is None else codec.createInputStream(raw)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        raw.close()


def _headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files of each header; no job runs, and of each file only its beginning is read."""
    paths = [f.path for f in list_files(spark, path) if f.length]
    out: dict[tuple[str, ...], list[str]] = {}
    with cf.ThreadPoolExecutor(max_workers=HEADER_READERS) as pool:
        for file, line in zip(paths, pool.map(lambda f: first_line(spark, f), paths), strict=True):
            if line is not None:
                out.setdefault(tuple(next(csv.reader([line.removeprefix("\ufeff")]))), []).append(file)
    return out


def read_customers(spark: SparkSession, path: str, fmt: str = "csv", types: dict[str, T.DataType] | None = None) -> DataFrame:
    """Customer table with explicit types (no inference pass over the data).

    For CSV only the beginning of each file is read before the scan.  Known columns get their schema
    type, others the type that ``types`` gives, else string.  Files of one
    folder may have their columns in any order: each order is read with its own
    header; a value that does not fit its type is an error.
    """
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt != "csv":
        raise ValueError(fmt)
    kinds = KNOWN_TYPES | (types or {})
    out = None
    for header, files in _headers(spark, path).items():
        schema = T.StructType([T.StructField(c, kinds.get(c, T.StringType()), True) for c in header])
        reader = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)
        part = reader.csv(files)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(f"no CSV file under {path}")
    return out


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Parquet for intermediate tables; CSV (header, no index) for exports.

    Written as a directory of part files by all tasks in parallel (no
    ``coalesce(1)``, which would funnel the table through one task).
    """
    w = df.write.mode(mode)
    if fmt == "parquet":
        w.parquet(path)
    elif fmt == "csv":
        w.option("header", True).csv(path)
    else:
        raise ValueError(fmt)
    return path


def write_predictions(df: DataFrame, path: str, threshold: float = 0.7, fmt: str = "csv",
                      p: str = "churn_probability") -> dict:
    """Write predictions and return the receipt {path, record_count,
    high_risk_count, saved_at}; the counts are observed on the rows as they are
    written, so predictions are computed and read once."""
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("record_count"), F.count_if(F.col(p) > F.lit(threshold)).alias("high_risk_count")]
    write_table(df.observe(seen, *counts), path, fmt)
    return {
        "path": path,
        "record_count": int(seen.get["record_count"]),
        "high_risk_count": int(seen.get["high_risk_count"]),
        "saved_at": dt.datetime.now(dt.UTC).isoformat(),
    }


def load_or_sample(spark: SparkSession, path: str | None, kind: str = "labelled", n: int = 1000, seed: int = 1,
                   first_id: int = 1, fmt: str = "csv") -> DataFrame:
    """Use the file when it exists, else a sample frame of the given kind."""
    if path and path_exists(spark, path):
        return read_customers(spark, path, fmt)
    return samples.sample_customers(spark, n, seed, first_id, kind)

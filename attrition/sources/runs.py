"""Kept runs (K4): an append-only table of runs with their parameters, metrics and tags.

One row is one run: ``run_id, experiment, run_name, started_at, params map<string,string>,
metrics map<string,double>, tags map<string,string>, run_date``.  Every call of
:func:`log_runs` writes its rows to a folder of its own,
``<base>/run_date=<date>/batch=<uuid>``, so writers never touch each other's files, and a
batch counts only once Spark has put ``_SUCCESS`` there.  Readers list the committed batches of the
dates they ask for and read those alone: a query of one month opens no other month's files.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.sources.files import path_exists, subfolders

RUNS_SCHEMA = (
    "run_id string, experiment string, run_name string, started_at timestamp, "
    "params map<string,string>, metrics map<string,double>, tags map<string,string>"
)


def as_map(columns: list[str], value_type: str) -> Column:
    """A map of the columns that are not null, by name."""
    pairs = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast(value_type).alias("value")) for c in columns])
    return F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))


def run_rows(
    table: DataFrame,
    metrics: list[str],
    experiment: str,
    started_at: dt.datetime,
    params: str | None = "params",
    tags: Column | dict[str, str] | None = None,
    name: str = "run_name",
) -> DataFrame:
    """Rows to log from a table with one row for each run (see ``metrics.runs_table``).

    ``run_id`` is a hash of experiment, start and name: logging the same run again gives the same id.
    """
    if isinstance(tags, dict):
        tags = F.create_map(*[F.lit(x) for kv in tags.items() for x in kv]) if tags else None
    none = F.lit(None).cast("map<string,string>")
    run_id = F.substring(F.sha2(F.concat_ws("|", F.lit(experiment), F.lit(started_at.isoformat()), F.col(name)), 256), 1, 32)
    return table.select(
        run_id.alias("run_id"),
        F.lit(experiment).alias("experiment"),
        F.col(name).cast("string").alias("run_name"),
        F.lit(started_at).cast("timestamp").alias("started_at"),
        (F.col(params) if params and params in table.columns else none).alias("params"),
        as_map(metrics, "double").alias("metrics"),
        (tags if tags is not None else none).alias("tags"),
    )


def log_runs(rows: DataFrame, base: str, run_date: dt.date) -> str:
    """Append runs (columns of ``RUNS_SCHEMA``) under a date; returns the batch's folder."""
    path = f"{base.rstrip('/')}/run_date={run_date.isoformat()}/batch={uuid.uuid4().hex}"
    names = [c.strip().split(" ")[0] for c in RUNS_SCHEMA.split(", ")]
    rows.select(*names).write.mode("error").parquet(path)
    return path


def committed_batches(spark: SparkSession, base: str, since: dt.date | None = None, until: dt.date | None = None) -> list[str]:
    """Folders of the complete batches of the dates asked for (bounds included)."""
    base = base.rstrip("/")
    out = []
    for day in sorted(subfolders(spark, base)):
        if not day.startswith("run_date="):
            continue
        date = dt.date.fromisoformat(day.split("=", 1)[1])
        if (since is None or date >= since) and (until is None or date <= until):
            out += [f"{base}/{day}/{b}" for b in sorted(subfolders(spark, f"{base}/{day}"))
                    if path_exists(spark, f"{base}/{day}/{b}/_SUCCESS")]
    return out


def read_runs(spark: SparkSession, base: str, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
    """All runs logged on the dates asked for, with ``run_date``; of runs logged twice the row logged under the later date."""
    schema = f"{RUNS_SCHEMA}, run_date date, batch string"
    paths = committed_batches(spark, base, since, until)
    if not paths:
        return spark.createDataFrame([], schema).drop("batch")
    rows = spark.read.schema(schema).option("basePath", base.rstrip("/")).parquet(*paths)
    last = rows.groupBy("run_id").agg(F.max_by(F.struct("*"), F.struct("run_date", "batch")).alias("r"))
    return last.select("r.*").drop("batch")


def metric(name: str) -> Column:
    """A metric of a run; null where the run has none of that name."""
    return F.try_element_at(F.col("metrics"), F.lit(name))


def param(name: str) -> Column:
    return F.try_element_at(F.col("params"), F.lit(name))


def tag(name: str, default: str | None = None) -> Column:
    value = F.try_element_at(F.col("tags"), F.lit(name))
    return value if default is None else F.coalesce(value, F.lit(default))


def best_by_tag(runs: DataFrame, tag_name: str, by: str = "f1", default: str = "") -> DataFrame:
    """For each value of a tag: its runs, and the run with the highest metric (ties: the smaller name)."""
    rows = runs.select(tag(tag_name, default).alias(tag_name), "run_name", metric(by).alias("value"))
    order = F.struct(F.coalesce(-F.col("value"), F.lit(float("inf"))), F.col("run_name"))
    return rows.groupBy(tag_name).agg(
        F.count(F.lit(1)).alias("runs"), F.max("value").alias(f"best_{by}"), F.min_by("run_name", order).alias("best_run"))

"""Score newly arrived customer files exactly once (ST1).

``readStream`` over a folder of Parquet files -> ratio features -> RFM with
frozen edges -> a saved model (or the rule with frozen statistics) -> a
Parquet file sink.  The sink's checkpoint records which files were consumed,
so a second run over the same folder adds nothing and a run after new files
arrive scores only those.  Batch-relative statistics (quantiles, z-scores)
cannot be recomputed on a stream, hence the frozen state fitted beforehand.
``current_timestamp()`` is fixed per micro-batch in Structured Streaming, so
every row of a batch carries the same ``predicted_at``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from attrition.operators import models
from attrition.operators.features import ratio_features
from attrition.operators.rfm import RfmModel, apply_rfm
from attrition.operators.scoring import DECISION_THRESHOLD, rule_score_frozen
from attrition.schema import CUSTOMER, ID


def scored_stream(stream: DataFrame, rfm_model: RfmModel | None = None, pm: PipelineModel | None = None,
                  rule_stats: dict | None = None, version: str | None = None,
                  threshold: float = DECISION_THRESHOLD) -> DataFrame:
    feats = ratio_features(stream)
    if rfm_model is not None:
        feats = apply_rfm(feats, rfm_model)
    if pm is not None:
        scored = models.predict(pm, feats, threshold)
    elif rule_stats is not None:
        scored = rule_score_frozen(feats, rule_stats).withColumn(
            "churn_predicted", (F.col("churn_probability") > F.lit(threshold)).cast("long"))
    else:
        raise ValueError("give a PipelineModel or frozen rule statistics")
    cols = [F.col(ID), F.col("churn_probability"), F.col("churn_predicted")]
    if version is not None:
        cols.append(F.lit(version).alias("model_version"))
    cols.append(F.current_timestamp().alias("predicted_at"))
    return scored.select(*cols)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def disk_state_store(spark: SparkSession) -> Iterator[None]:
    """Streams started here keep their state in RocksDB: on disk, beyond the executors' memory."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def new_customers(stream: DataFrame, event_time: str | None = None, within: str = "30 days", id_col: str = ID) -> DataFrame:
    """The first row of each customer over the life of the stream.

    State is keyed by customer and spread over the shuffle partitions.  Without ``event_time`` every id is kept for
    good; with it, an id is forgotten once the watermark is ``within`` past it, which bounds the state.
    Rows of one customer in one micro-batch: one of them stays.  A null id is one customer.
    """
    if event_time is None:
        return stream.dropDuplicates([id_col])
    return stream.withWatermark(event_time, within).dropDuplicatesWithinWatermark([id_col])


def score_stream(spark: SparkSession, in_path: str, out_path: str, checkpoint: str,
                 rfm_model: RfmModel | None = None, pm: PipelineModel | None = None, rule_stats: dict | None = None,
                 version: str | None = None, schema: StructType = CUSTOMER, max_files_per_trigger: int | None = None,
                 wait: bool = True, new_only: bool = False, event_time: str | None = None,
                 within: str = "30 days") -> StreamingQuery:
    """Start (and by default finish) an available-now run over ``in_path``.

    ``new_only`` scores each customer once, ever: ids seen in any earlier file or run are state that the
    checkpoint keeps (see :func:`new_customers`), so a customer that is delivered again adds no row.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(in_path)
    out = scored_stream(new_customers(rows, event_time, within) if new_only else rows, rfm_model, pm, rule_stats, version)
    writer = (out.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
              .outputMode("append").trigger(availableNow=True))
    with disk_state_store(spark):
        q = writer.start()
    if wait:
        q.awaitTermination()
    return q

"""U11 and J25 on streams: models trained per window, used by another stream.

The training stream emits a model per closed window; each micro-batch appends
its models as versions to a table in a shared folder. The prediction stream
scores each micro-batch against that table with the as-of join of the batch
form: a row gets the latest model finished at or before its time.

Defined results: a row for which no model exists when its micro-batch runs is
scored with the initial model (``initial``); a model that arrives later does
not change rows already scored; a micro-batch that runs again rewrites its own
versions (training) and replaces its own part (prediction), so reruns agree as
long as the model table has not grown in between.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import exact_avg
from ..operators.joins import asof_join
from .runner import stream_checkpoint

MODELS = T.StructType([T.StructField("model_time", T.TimestampType()), T.StructField("model", T.DoubleType())])


def window_models_stream(rows: DataFrame, ts: str, value: str, size: str, delay: str = "0 seconds") -> DataFrame:
    """U11 on a stream: ``model_time, model`` (mean of ``value``) per closed window."""
    return (rows.withWatermark(ts, delay).groupBy(F.window(ts, size).alias("w"))
            .agg(exact_avg(value).alias("model")).select(F.col("w.end").alias("model_time"), "model"))


def save_models(models: DataFrame, folder: str, checkpoint: str | None = None):
    """Start the query that appends model versions to the table in ``folder``."""
    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    spark = models.sparkSession
    return (models.writeStream.outputMode("append").foreachBatch(append)
            .option("checkpointLocation", checkpoint or stream_checkpoint(spark, "models"))
            .trigger(availableNow=True).start())


def read_models(spark: SparkSession, folder: str) -> DataFrame:
    """All versions so far (none if no model was saved yet)."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.schema(MODELS).option("recursiveFileLookup", "true").parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MODELS)


def score_with_latest(rows: DataFrame, models: DataFrame, ts: str, initial: float) -> DataFrame:
    """``rows`` with the ``model`` in force at their time, ``initial`` before the first."""
    first = models.agg(F.min("model_time")).first()[0]
    if first is None:
        return rows.withColumn("model", F.lit(float(initial)))
    versions = models.select(F.lit(0).alias("_mk"), F.col("model_time").alias("_mt"), "model")
    known = asof_join(rows.filter(F.col(ts) >= F.lit(first)).withColumn("_pk", F.lit(0)), versions, "_pk", "_mk",
                      ts, "_mt").drop("_pk", "_mk", "_mt")
    before = rows.filter(F.col(ts).isNull() | (F.col(ts) < F.lit(first)))
    return known.unionByName(before.withColumn("model", F.lit(float(initial))))


def predict_stream(rows: DataFrame, folder: str, ts: str, out: str, predict: Callable[[DataFrame], DataFrame],
                   initial: float = 0.0, checkpoint: str | None = None):
    """Start the query that scores ``rows`` with ``predict`` (adds what it likes
    to rows with a ``model`` column) and writes each micro-batch to ``out``."""
    def score(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        scored = predict(score_with_latest(batch, read_models(spark, folder), ts, initial))
        scored.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    spark = rows.sparkSession
    return (rows.writeStream.outputMode("append").foreachBatch(score)
            .option("checkpointLocation", checkpoint or stream_checkpoint(spark, "predictions"))
            .trigger(availableNow=True).start())

"""Streaming scorer (I29): scoring requests arriving as files are scored by
the same fitted ``PipelineModel`` as the batch job.

The model is stateless per row, so the stream needs no watermark or state
store: ``readStream`` (file source with the request schema) ->
``prepare_requests`` -> ``model.transform`` -> ``writeStream`` to a Parquet
sink with a checkpoint in the shared folder.  ``availableNow`` processes
everything present and stops, which makes it usable as an incremental
batch job and in tests; a continuous deployment uses a processing-time
trigger with the same code.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from wagelens.ml.scoring import prepare_requests


def start_scoring_stream(spark: SparkSession, model: PipelineModel, source_dir: str, schema,
                         sink_dir: str, checkpoint_dir: str, keep=("job_id",),
                         available_now: bool = True, max_files_per_trigger: int | None = None):
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    requests = reader.parquet(source_dir)
    scored = model.transform(prepare_requests(requests)).select(*keep, "predicted_salary_usd")
    writer = (scored.writeStream.format("parquet").option("path", sink_dir)
              .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def run_to_completion(spark: SparkSession, model: PipelineModel, source_dir: str, schema, sink_dir: str,
                      checkpoint_dir: str, keep=("job_id",)) -> DataFrame:
    q = start_scoring_stream(spark, model, source_dir, schema, sink_dir, checkpoint_dir, keep)
    q.awaitTermination()
    return spark.read.parquet(sink_dir)

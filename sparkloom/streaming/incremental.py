"""Run per-document feature functions incrementally over new files.

The text and image features here are per document (or per image), so a
micro-batch can be processed like any batch DataFrame: Structured Streaming
tracks which input files are done (in the checkpoint), and ``foreachBatch``
applies the same ``DataFrame -> DataFrame`` function to each new batch.

Output of batch ``n`` goes to ``<sink>/batch_id=n`` with overwrite, so a
batch replayed after a failure rewrites the same folder: the sink stays
exactly-once even though ``foreachBatch`` is at-least-once.  The checkpoint
lives under the cluster's shared ``spark.checkpoint.dir`` unless given.

Features that need corpus-wide statistics (hashed TF-IDF's document
frequencies, LDA topics) are not per document and are not meant for this
runner.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sparkloom.session import staging_path


def incremental_features(
    spark: SparkSession,
    source_path: str,
    schema: StructType | str,
    transform: Callable[[DataFrame], DataFrame],
    sink_path: str,
    checkpoint_location: str | None = None,
    source_format: str = "parquet",
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start a stream that applies ``transform`` to every new batch of files under ``source_path``."""
    reader = spark.readStream.format(source_format).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(source_path)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write_batch).option(
        "checkpointLocation", checkpoint_location or staging_path(spark, "stream-checkpoint")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()

"""Score input files as they arrive (P5 + S4 + S6 as a stream).

The reference scores one input file per run (its ``predict.sh``).  Here a
folder is watched with Structured Streaming: each micro-batch of new files is
scored with the saved model and appended to a Parquet sink.  The model tables
are static; ``foreachBatch`` runs the ordinary batch ``predict`` on each
micro-batch (its distinct/aggregate steps are batch operators), and the
checkpoint location gives exactly-once output per batch: a restarted query
re-runs an unfinished batch and overwrites that batch's folder.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from charloom.functions.text import decode_ignore
from charloom.plans.model import CharModel


def input_stream(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(input_dir).select(
        decode_ignore(F.col("value")).alias("text"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))


def start(model: CharModel, input_dir: str, output_dir: str, checkpoint_location: str,
          k: int = 3, available_now: bool = True) -> StreamingQuery:
    """Start the stream; every output row is ``(file, qid, pred)`` where ``qid``
    is the line's 0-based number inside its file.  The stored contexts are scored first:
    the batches that follow only look theirs up."""
    spark = model.context_chars.sparkSession
    model.prepare(k, guess_table=True)

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        from pyspark.sql import Window
        # Inside a micro-batch the scan is a plain batch scan: ids increase along
        # each split.
        batch = batch.withColumn("row", F.monotonically_increasing_id())
        # Line number inside each file: split offset + position inside the split
        # (one row per split in the offsets table).
        splits = batch.groupBy("file", "block").agg(F.count(F.lit(1)).alias("_n"), F.min("row").alias("_m0"))
        before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        splits = splits.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        rows = batch.join(F.broadcast(splits.select("file", "block", "_m0", "_off")), ["file", "block"])
        rows = rows.select("file", (F.col("_off") + F.col("row") - F.col("_m0")).alias("line_no"), "text")
        preds = model.predict(rows, k=k, id_cols=("file", "line_no"))
        (preds.select("file", F.col("line_no").alias("qid"), "pred")
         .write.mode("overwrite").parquet(os.path.join(output_dir, f"batch={batch_id}")))

    writer = input_stream(spark, input_dir).writeStream.foreachBatch(score_batch).option(
        "checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()

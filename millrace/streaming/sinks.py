"""Validated micro-batches with a dead-letter output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.jsonx import trim_to_object
from millrace.operators.model_outputs import streamed_transaction
from millrace.streaming.windows import finish

BATCH_ROWS = 3


def text_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of arriving text files. A last line without a line break counts as a line."""
    reader = spark.readStream.schema("value string")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def model_lines(lines: DataFrame) -> DataFrame:
    """Transaction texts of a model's output: no blanks, no fences, cut to the object."""
    kept = lines.where((F.trim("value") != "") & ~F.ltrim("value").startswith("```"))
    return streamed_transaction(kept.select(trim_to_object(F.trim("value")).alias("value")), "value")


def split_sink(stream: DataFrame, check: Callable[[DataFrame], DataFrame], path: str, batch_rows: int | None = None,
               checkpoint: str | None = None, wait: float | None = None, every: str | None = None) -> StreamingQuery:
    """Write rows without violations to ``ok`` and the others to ``dlq``, each batch under its number.

    ``batch_rows`` bounds the rows per file. The checked batch is stored once and both outputs are
    read from it; running a batch again overwrites what it wrote. With ``every`` the stream goes on and rows wait for
    that interval at most: a flush takes what has arrived, in files that are full and one that is not.
    """
    def handle(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        staged = f"{path}/checked/{batch}"
        check(rows).write.mode("overwrite").parquet(staged)
        checked = spark.read.parquet(staged)
        for name, cond in (("ok", F.size("violations") == 0), ("dlq", F.size("violations") > 0)):
            writer = checked.where(cond).write.mode("overwrite")
            if batch_rows:
                writer = writer.option("maxRecordsPerFile", batch_rows)
            writer.parquet(f"{path}/{name}/batch={batch}")

    query = stream.writeStream.foreachBatch(handle).option(
        "checkpointLocation", checkpoint or f"{path}/checkpoint").trigger(
        **({"processingTime": every} if every else {"availableNow": True})).start()
    return query if every else finish(query, wait)


def micro_batch_sink(stream: DataFrame, path: str, batch_rows: int = BATCH_ROWS, every: str | None = None) -> StreamingQuery:
    """Model output lines to files of at most ``batch_rows`` validated rows, after ``every`` interval at the latest;
    failures go to ``dlq``."""
    return split_sink(stream, model_lines, path, batch_rows, every=every)

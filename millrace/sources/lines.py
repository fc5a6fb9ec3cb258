"""Line-oriented JSON: tolerant scans, cheap pre-filters and sinks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from millrace.functions.jsonx import once, parsed

# Column types of a record class; any other annotation is read as text.
FIELD_TYPES = {"int": "bigint", "float": "double", "str": "string", "bool": "boolean"}
ROLL_BYTES = 100_000


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files in ``value``; blank lines are left out."""
    return spark.read.text(path).where(F.trim("value") != "")


def jsonl_scan_defensive(lines: DataFrame, schema: StructType | str, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """Typed records of readable lines, and the unreadable lines as they came."""
    shape = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    read = once(once(lines, "_v", parsed(text)), "_r", F.try_variant_get("_v", "$", shape.simpleString()))
    kept = [c for c in lines.columns if c != text]
    return read.where(F.col("_r").isNotNull()).select(*kept, "_r.*"), read.where(F.col("_r").isNull()).select(*lines.columns)


def error_line_scan(lines: DataFrame, needle: str = "ERROR", field: str = "log", text: str = "value") -> DataFrame:
    """``field`` of the lines that contain ``needle`` anywhere. The text test comes before the parse."""
    hit = lines.where(F.col(text).contains(needle))
    read = once(hit, "_v", parsed(text)).withColumn(field, F.try_variant_get("_v", f"$.{field}", "string"))
    return read.drop("_v").where(F.col(field).isNotNull())


def prefiltered_parse_agg(lines: DataFrame, text: str = "value") -> DataFrame:
    """Sum of ``amount`` per user over successful records; unreadable lines and amounts are skipped."""
    hit = lines.where(F.col(text).contains("success"))
    rows = once(hit, "v", parsed(text)).where(F.try_variant_get("v", "$.status", "string") == "success")
    kind = F.schema_of_variant(F.try_variant_get("v", "$.amount", "variant"))
    numeric = (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL")
    has_user = F.try_variant_get("v", "$.user_id", "variant").isNotNull()
    return rows.where(has_user & numeric).groupBy(
        F.try_variant_get("v", "$.user_id", "string").alias("user_id")).agg(
        F.sum(F.try_variant_get("v", "$.amount", "double")).alias("total_amount"))


def record_schema(annotations: dict[str, str]) -> str:
    """DDL of a record class given as field name to type name."""
    return ", ".join(f"`{n}` {FIELD_TYPES.get(t, 'string')}" for n, t in annotations.items())


def ndjson_typed_scan(spark: SparkSession, path: str, annotations: dict[str, str],
                      time_column: str | None = "timestamp") -> DataFrame:
    """Lazy scan of many NDJSON files with a declared schema; the time text is parsed afterwards."""
    df = spark.read.schema(record_schema(annotations)).json(path)
    if time_column in df.columns:
        df = df.withColumn(time_column, F.try_to_timestamp(F.col(time_column)))
    return df


def csv_scan(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header line; empty cells are null."""
    return spark.read.schema(schema).option("header", True).csv(path)


def jsonl_sink(df: DataFrame, path: str) -> None:
    """Append one JSON object per line."""
    df.write.mode("append").json(path)


def rolled_file_sink(df: DataFrame, path: str, max_bytes: int = ROLL_BYTES) -> None:
    """JSON lines in files of at most ``max_bytes``; a record is never split.

    Each task starts the next file when the next line would pass the bound; a single longer line gets a
    file of its own. Files lie in folders ``file=<task>-<number>``; read them with ``recursiveFileLookup``.
    """
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, file, used = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            names = []
            for size in batch.column(1).to_pylist():
                if used and used + size > max_bytes:
                    file, used = file + 1, 0
                used += size
                names.append(f"{task}-{file}")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string())], ["value", "file"])

    lines = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    sized = lines.select("value", (F.octet_length("value") + 1).alias("bytes"))
    sized.mapInArrow(number, "value string, file string").write.mode("append").partitionBy("file").text(path)

"""JSON Lines: reading, appending, bounded files, one folder per year."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

# Fixed value: output files are meant to stay near 50 MiB.
TARGET_BYTES = 50 * 1024 * 1024


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """One object per line, of all files below the path; blank lines are skipped, a malformed
    line fails the read, a missing path is an empty table."""
    try:
        return spark.read.schema(schema).option("mode", "FAILFAST").option("recursiveFileLookup", "true").json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def append_jsonl(df: DataFrame, path: str) -> None:
    """Append one object per row; NULL fields are left out, text is UTF-8."""
    df.write.mode("append").json(path)


def write_bounded(df: DataFrame, path: str, target_bytes: int = TARGET_BYTES) -> None:
    """Append JSON Lines in files of at most ``target_bytes``; only a record that is larger
    by itself makes a larger file, alone.

    Every task sums up the sizes of its records and begins a new file before one would cross the bound: one pass, no
    shuffle. Each file lies in a folder of its own, named after this call, the task and its number; :func:`read_jsonl`
    reads through folders. A task that is repeated writes the same files.
    """
    size, part = (_unused(name, df.columns) for name in ("bytes", "part"))
    sized = df.withColumn(size, (F.octet_length(F.to_json(F.struct(*df.columns))) + 1).cast("long"))
    schema = T.StructType([*df.schema.fields, T.StructField(part, T.StringType())])
    numbered = sized.mapInArrow(_begin_files(size, part, target_bytes, uuid.uuid4().hex[:12]), schema)
    numbered.write.mode("append").partitionBy(part).json(path)


def _unused(name: str, columns: list[str]) -> str:
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def _begin_files(size: str, part: str, target_bytes: int, call: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            parts = []
            for n in batch[size].to_pylist():
                if total and total + n > target_bytes:
                    number, total = number + 1, 0
                total += n
                parts.append(f"{call}-{task}-{number}")
            kept = batch.drop_columns([size])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(parts, pa.string())], [*kept.schema.names, part])

    return run


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """file, n_bytes, n_records of the JSON Lines files below a path."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.max("_metadata.file_size").alias("n_bytes"), F.count(F.lit(1)).alias("n_records")
    )


def write_by_year(notices: DataFrame, path: str, year: str = "notice_year") -> None:
    """Append notices as JSON Lines, one folder per year.

    The rebalance hint gathers each year into few files and splits a year that
    is too large for one task.
    """
    notices.hint("rebalance", F.col(year)).write.mode("append").partitionBy(year).json(path)


def read_by_year(spark: SparkSession, path: str, schema: str, year: str = "notice_year") -> DataFrame:
    """Notices with their year; a filter on the year prunes folders."""
    return spark.read.schema(f"{schema}, {year} int").option("mode", "FAILFAST").json(path)

"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

# a word: a run of characters other than the six ASCII space characters
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lost executors then
    cost no more than the files they were writing, and the plan stays short."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """A column name for each of ``names`` that the table does not have, whatever its columns are called."""
    taken, free = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        free.append(name)
    return free


def whole_texts(docs: DataFrame, rows: int = 500) -> DataFrame:
    """For a table whose texts go to Python: at most ``rows`` of them in one Arrow batch.
    Spark's default of 10,000 rows is made for numbers; with long texts such a
    batch, which is held several times over, would take gigabytes."""
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= rows:
        conf.set(key, rows)
    return docs


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def uniform(*cols: Column | str) -> Column:
    """A number in [0, 1) that depends on the values alone."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 52)) / F.lit(float(1 << 52))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")

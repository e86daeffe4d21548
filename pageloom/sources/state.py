"""Resume state: import of a JSON state file, and snapshots of our own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

# Fields of a state file and the tables they become.
STATE_SCHEMA = (
    "fetching_queue array<array<string>>, parsing_queue array<array<string>>, visited array<string>, "
    "parsed array<string>, seen_texts array<string>, visited_identifiers array<string>"
)
TABLE_SCHEMAS = {
    "frontier": "url string, depth int, seq int",
    "pending_pages": "url string, html string, depth int, seq int",
    "visited": "url string",
    "parsed": "url string",
    "seen": "fp string",
    "identities": "content_key string",
}


def read_state(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The six state tables of one or several state files.

    A file holds one JSON object. Queue order is kept as ``seq``, page bodies
    are decoded from base64 (bytes that are no UTF-8 become U+FFFD), missing fields are empty, and a file that is no
    valid JSON counts as empty. Files are read in parallel.
    """
    try:
        raw = spark.read.schema(STATE_SCHEMA).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = spark.createDataFrame([], STATE_SCHEMA)

    def queue(field: str) -> DataFrame:
        return raw.select(F.posexplode(field).alias("seq", "item"))

    def values(field: str, name: str) -> DataFrame:
        return raw.select(F.explode(field).alias(name)).distinct()

    def item(i: int):
        return F.get("item", F.lit(i))

    return {
        "frontier": queue("fetching_queue").select(item(0).alias("url"), item(1).cast("int").alias("depth"), "seq"),
        "pending_pages": queue("parsing_queue").select(
            item(0).alias("url"),
            # bodies in another encoding, which are no UTF-8, must not end the job
            F.make_valid_utf8(F.try_to_binary(item(1), F.lit("base64")).cast("string")).alias("html"),
            item(2).cast("int").alias("depth"),
            "seq",
        ),
        "visited": values("visited", "url"),
        "parsed": values("parsed", "url"),
        "seen": values("seen_texts", "fp"),
        "identities": values("visited_identifiers", "content_key"),
    }


def write_state(tables: dict[str, DataFrame], path: str, snapshot: int) -> None:
    """Write a numbered snapshot: all tables first, then a manifest row.

    A snapshot without manifest does not exist for readers, so a job that dies
    half-way leaves the previous one in force, and writing the same number
    again repairs it. Write to a new number, never to one the plan reads.
    """
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/snapshot={snapshot}/{name}")
    spark = next(iter(tables.values())).sparkSession
    manifest = spark.createDataFrame([(snapshot, sorted(tables))], "snapshot long, tables array<string>")
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/manifest/snapshot_{snapshot}")


def latest_snapshot(spark: SparkSession, path: str) -> tuple[int, list[str]] | None:
    """Newest complete snapshot and its tables, or None."""
    try:
        manifests = spark.read.schema("snapshot long, tables array<string>").json(f"{path}/manifest/*")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    row = manifests.agg(F.max(F.struct("snapshot", "tables")).alias("m")).first()
    return None if row.m is None else (row.m.snapshot, list(row.m.tables))


def read_snapshot(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables of the newest complete snapshot; empty tables if there is none."""
    newest = latest_snapshot(spark, path)
    if newest is None:
        return {name: spark.createDataFrame([], schema) for name, schema in TABLE_SCHEMAS.items()}
    number, names = newest
    return {name: spark.read.parquet(f"{path}/snapshot={number}/{name}") for name in names}

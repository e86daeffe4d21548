"""Streaming dedup, notice feed, site pass, sessions, and resuming them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions import text as T
from ..operators.notices import high_water, new_notices
from ..plans.site_pass import run_pass
from .state import BUCKETS, BatchStore, Keyed

# Fixed value: how often a waiting feed looks for something new.
POLL_INTERVAL = "60 seconds"

PASS_STATE = {
    "seen": Keyed("fp string", "fp"),
    "visited": Keyed("url string", "url"),
    "parsed": Keyed("url string", "url"),
    "identities": Keyed("content_key string", "content_key"),
}
FRONTIER_SCHEMA = "url string, depth int, content_key string"


def stream_dedup(sdf: DataFrame, text: str = "merged_text", ts: str | None = None, within: str | None = None) -> DataFrame:
    """Emit each text fingerprint once over the life of the job.

    The state keeps every fingerprint, as long as the job lives. With ``ts``
    and ``within`` a fingerprint is remembered only that long, which bounds
    the state. Which copy survives is a matter of arrival.
    """
    with_fp = sdf.withColumn("fp", T.text_fingerprint(text))
    if within is None:
        return with_fp.dropDuplicates(["fp"])
    return with_fp.withWatermark(ts, within).dropDuplicatesWithinWatermark(["fp"])


def stream_new_notices(sdf: DataFrame, path: str, initial_mark: DataFrame) -> DataStreamWriter:
    """Writer that keeps notices above the running mark and then raises it.

    Notices are stored per micro-batch below ``path`` and committed together with the mark, which is the note of
    the :class:`BatchStore`. ``initial_mark`` holds last_article_no and last_page_url.
    """
    spark = sdf.sparkSession

    def process(batch: DataFrame, batch_id: int) -> None:
        store = BatchStore(spark, path)
        if store.is_done(batch_id):
            return
        mark = initial_mark.select("last_article_no", "last_page_url")
        if store.note is not None:
            mark = mark.unionByName(spark.createDataFrame([store.note], "last_article_no string, last_page_url string"))
        new = store.folder("notices", batch_id)
        new_notices(batch, mark).write.mode("overwrite").parquet(new)
        top = high_water(spark.read.schema(sdf.schema).parquet(new)).first()
        note = store.note if top.last_article_no is None else [str(top.last_article_no), top.last_page_url]
        store.commit(batch_id, note)

    return sdf.writeStream.foreachBatch(process)


def stream_pass(
    sdf: DataFrame,
    path: str,
    base_domain: str,
    rules: DataFrame | None = None,
    max_depth: int | None = None,
    buckets: int = BUCKETS,
) -> DataStreamWriter:
    """Writer that runs the site pass on each arriving batch of pages.

    Fingerprints, visited and parsed URLs and content keys are keyed state below ``path``: a batch reads only the buckets that
    its own keys fall into. Records and the frontier are output tables; all are committed together (:class:`BatchStore`).
    """
    spark = sdf.sparkSession

    def process(batch: DataFrame, batch_id: int) -> None:
        store = BatchStore(spark, path, PASS_STATE, buckets)
        if store.is_done(batch_id):
            return
        result = run_pass(
            batch,
            base_domain,
            seen=store.lookup("seen"),
            visited=store.lookup("visited"),
            parsed=store.lookup("parsed"),
            known_keys=store.lookup("identities"),
            rules=rules,
            max_depth=max_depth,
            small_batch=True,
        )
        result.records.write.mode("overwrite").parquet(store.folder("records", batch_id))
        frontier = store.folder("frontier", batch_id)
        result.frontier.select("url", "depth", "content_key").write.mode("overwrite").parquet(frontier)
        # read back what was admitted instead of computing it again
        admitted = spark.read.schema(FRONTIER_SCHEMA).parquet(frontier)
        met = admitted.select("url", "content_key").unionByName(result.fetched)
        added = {"seen": result.seen, "visited": met.select("url"), "parsed": result.parsed, "identities": met.select("content_key")}
        store.commit(batch_id, added={name: rows.distinct() for name, rows in added.items()})

    return sdf.writeStream.foreachBatch(process)


def stream_sessions(sdf: DataFrame, ts: str, key: str, gap_seconds: int = 120, lateness: str = "1 hour") -> DataFrame:
    """Activity runs as a stream: emitted once no late row can extend them."""
    return (
        sdf.withWatermark(ts, lateness)
        .groupBy(key, F.session_window(ts, f"{gap_seconds} seconds").alias("w"))
        .agg(F.min(ts).alias("started"), F.max(ts).alias("ended"), F.count(F.lit(1)).alias("n_rows"))
        .drop("w")
    )


def resume(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process everything that has arrived since the last run and stop.

    The checkpoint remembers what was processed, so a stopped or failed run
    continues without losing or repeating a row.
    """
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def keep_running(writer: DataStreamWriter, checkpoint: str, interval: str = POLL_INTERVAL) -> StreamingQuery:
    """Poll for new input until stopped."""
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()

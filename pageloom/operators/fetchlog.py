"""Queries over fetch and activity logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Limits of one fetch, and the idle time that ends a pass.
MAX_ATTEMPTS = 10
MAX_SECONDS = 200
GAP_SECONDS = 120
SLOTS_PER_RANGE = 4096


def _response_label() -> Column:
    status = F.col("status")
    is_html = F.coalesce(F.lower("content_type").contains("text/html"), F.lit(False))
    return (
        F.when(status.isNull() | status.between(500, 599), "retry")
        .when((status == 200) & is_html, "ok")
        .when(status == 200, "skip_type")
        .otherwise("fail")
    )


def label_responses(log: DataFrame) -> DataFrame:
    """Add ``outcome``: ok, skip_type, retry (5xx or no status) or fail."""
    return log.withColumn("outcome", _response_label())


def admit_responses(log: DataFrame) -> DataFrame:
    """Responses that carry a page: status 200 and an HTML content type."""
    return label_responses(log).where("outcome = 'ok'")


def fetch_outcomes(
    attempts: DataFrame,
    order_by: Sequence[str] = ("attempt",),
    max_attempts: int = MAX_ATTEMPTS,
    max_seconds: float = MAX_SECONDS,
) -> DataFrame:
    """Per URL: attempts used, total request time, final outcome.

    Attempts are numbered by ``order_by``. They stop at the first answer that
    is not retried, after ``max_attempts``, or once ``max_seconds`` of request
    time are used. Only the first ``max_attempts`` attempts of a URL can
    matter; Spark applies that limit before the shuffle, so a URL with very
    many log rows sends only those.
    """
    per_url = Window.partitionBy("url").orderBy(*order_by)
    first = label_responses(attempts).withColumn("n", F.row_number().over(per_url)).where(F.col("n") <= max_attempts)
    before = per_url.rowsBetween(Window.unboundedPreceding, -1)
    used = (
        first.withColumn("spent", F.sum("elapsed").over(per_url.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("done", F.coalesce(F.max(F.col("outcome") != "retry").over(before), F.lit(False)))
        .withColumn("spent_before", F.coalesce(F.sum("elapsed").over(before), F.lit(0)))
        .where(~F.col("done") & (F.col("spent_before") < max_seconds))
    )
    final = F.max_by("outcome", "n")
    return used.groupBy("url").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.max_by("spent", "n").alias("total_seconds"),
        F.when(final == "retry", "fail").otherwise(final).alias("outcome"),
    )


def progress(state: DataFrame) -> DataFrame:
    """Sizes of the state tables per pass, from rows (pass, state)."""

    def size(name: str) -> Column:
        return F.count_if(F.col("state") == name).alias(name)

    return state.groupBy("pass").agg(*[size(n) for n in ("pending", "visited", "parsed", "seen", "new")])


def micros(ts: str, without_zone: bool) -> Column:
    """Microseconds since 1970. A timestamp without zone is taken as it reads,
    whatever the session's zone and its clock changes."""
    if not without_zone:
        return F.unix_micros(ts)
    return F.expr(
        f"unix_date(cast({ts} AS date)) * 86400000000L + (hour({ts}) * 60 + minute({ts})) * 60000000L"
        f" + cast(extract(SECOND FROM {ts}) * 1000000 AS bigint)"
    )


def sessions(
    log: DataFrame, ts: str = "ts", key: str | None = None, gap_seconds: int = GAP_SECONDS, slots_per_range: int = SLOTS_PER_RANGE
) -> DataFrame:
    """Runs of a log without a gap of ``gap_seconds`` or more.

    Returns [key,] session_no, started, ended, n_rows. Rows that fall into the
    same slot of ``gap_seconds`` can never be in different runs, so rows are
    first reduced to one summary per slot with partial aggregates. Slots are numbered in two
    levels: within ranges of ``slots_per_range`` slots, which lie in different tasks, and across ranges by their first and
    last times alone. So without a key no task sees all slots, and a key that
    holds a third of all rows is no larger than others.
    """
    keys = [key] if key else []
    gap = gap_seconds * 1_000_000
    without_zone = log.schema[ts].dataType == T.TimestampNTZType()
    slot = F.floor(micros(ts, without_zone) / F.lit(gap))
    slots = (
        log.where(F.col(ts).isNotNull())
        .groupBy(*keys, slot.alias("_slot"))
        .agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n"))
    )
    slots = slots.withColumn("_range", F.floor(F.col("_slot") / F.lit(slots_per_range)))
    within = Window.partitionBy(*keys, "_range").orderBy("_slot")

    def opens(begins: str, ends: str, window: Window, first: bool) -> Column:
        idle = micros(begins, without_zone) - F.lag(micros(ends, without_zone)).over(window)
        return F.coalesce(idle >= gap, F.lit(first)).cast("int")

    # runs that begin inside a range, its first slot left out
    numbered = slots.withColumn("_opens", opens("first_ts", "last_ts", within, False)).withColumn(
        "_inner", F.sum("_opens").over(within.rowsBetween(Window.unboundedPreceding, 0))
    )
    across = Window.partitionBy(*keys).orderBy("_range")
    ranges = (
        numbered.groupBy(*keys, "_range").agg(F.min("first_ts").alias("_begins"), F.max("last_ts").alias("_ends"), F.max("_inner").alias("_in"))
        .withColumn("_opens", opens("_begins", "_ends", across, True))
        .withColumn("_before", F.sum(F.col("_opens") + F.col("_in")).over(across.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_in"))
        .select(*[F.col(k).alias("_key") for k in keys], F.col("_range").alias("_of"), "_before")
    )
    same = F.col("_range") == F.col("_of")
    if key:
        same = same & F.col(key).eqNullSafe(F.col("_key"))
    return (
        numbered.join(ranges, same)
        .groupBy(*keys, (F.col("_before") + F.col("_inner")).alias("session_no"))
        .agg(F.min("first_ts").alias("started"), F.max("last_ts").alias("ended"), F.sum("n").alias("n_rows"))
    )

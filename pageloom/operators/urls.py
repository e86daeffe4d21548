"""URL operators on a DataFrame column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.expr import column, let
from .rules import RULE_SCHEMA, exclude_urls

__all__ = [
    "RULE_SCHEMA", "absolute_only", "exclude_urls", "http_only", "in_domain", "query_params", "resolve", "split_url",
]

def split_url(df: DataFrame, url: str = "url") -> DataFrame:
    """Add scheme, netloc, path, params, query and fragment."""
    return df.withColumn("_parts", U.url_parts(url)).select(*df.columns, "_parts.*")


def query_params(df: DataFrame, url: str = "url") -> DataFrame:
    """One row per decoded, non-blank query parameter: pos, name, value."""
    with_parts = df.withColumn("_pairs", column(let(U.url_parts_sql(url), lambda p: U.query_pairs_sql(f"{p}.query"))))
    exploded = with_parts.select(*df.columns, F.posexplode("_pairs").alias("pos", "_pair"))
    return exploded.select(*df.columns, "pos", "_pair.name", "_pair.value")


def absolute_only(df: DataFrame, url: str = "url") -> DataFrame:
    """Rows whose URL has a network location."""
    return df.where(U.url_parts(url)["netloc"] != "")


def http_only(df: DataFrame, url: str = "url") -> DataFrame:
    """Rows whose URL has the scheme http or https."""
    return df.where(U.url_parts(url)["scheme"].isin("http", "https"))


def in_domain(df: DataFrame, url: str, base_domain: str) -> DataFrame:
    """Rows whose host is ``base_domain`` or below it. The port counts.

    ``base_domain`` is an expression: a quoted name or a column.
    """
    return df.where(column(U.within_domain_sql(U.netloc_sql(url), base_domain)))


def resolve(df: DataFrame, base: str, href: str, output: str = "resolved") -> DataFrame:
    """Add the absolute form of ``href`` relative to ``base``."""
    return df.withColumn(output, U.resolve_url(base, href))

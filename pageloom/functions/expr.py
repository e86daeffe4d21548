"""SQL expression text as building blocks.

The column functions of this package are composed as SQL text and parsed once
by Spark. Built from Python objects, every operator would be several calls
into the JVM, which adds up to seconds for nested expressions. A function named
``x_sql`` takes and returns expression text; ``x`` is the same as a Column.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

_names = count()


def fresh() -> str:
    """A new lambda variable name."""
    return f"v{next(_names)}"


def quote(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted_list(values: Iterable[str]) -> str:
    return ", ".join(quote(v) for v in values)


def let(value: str, body: Callable[[str], str]) -> str:
    """Evaluate ``value`` once per row and use it several times in ``body``.

    Pasting an expression at every use would make nested functions grow
    exponentially, in text and in work.
    """
    name = fresh()
    return f"get(transform(array({value}), {name} -> {body(name)}), 0)"


def map_array(array: str, body: Callable[[str], str]) -> str:
    name = fresh()
    return f"transform({array}, {name} -> {body(name)})"


def filter_array(array: str, test: Callable[[str], str]) -> str:
    name = fresh()
    return f"filter({array}, {name} -> {test(name)})"


def column(text: str) -> Column:
    return F.expr(text)

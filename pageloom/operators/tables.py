"""Tables inside pages: cells with grid positions, texts, links and images.

All of it is one fold over a page's tokens (:mod:`pageloom.functions.grid`), inside the page's row: no shuffle, no window.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import grid
from ..functions.expr import column
from ..functions.grid import CELL, TABLES
from ..functions.pieces import Cutter
from .folds import fold, unfold


def _tables_reader() -> Callable[[pa.Array, pa.Array], pa.Array]:
    cut = Cutter(grid.tag_reader(), grid.NO_TAG)
    return lambda html, base: grid.found_tables(cut, html, base).array()


def _cells_reader() -> Callable[[pa.Array, pa.Array], tuple[pa.Array, list[pa.Array]]]:
    cut = Cutter(grid.tag_reader(), grid.NO_TAG)

    def read(html: pa.Array, base: pa.Array) -> tuple[pa.Array, list[pa.Array]]:
        found = grid.found_tables(cut, html, base)
        n_cells, n_tables = np.diff(found.cells_end), np.diff(found.tables_end)
        page = np.repeat(np.repeat(np.arange(len(n_tables)), n_tables), n_cells)
        table_no = np.repeat(np.array(found.table_no, np.int32), n_cells)
        cell_no = (np.arange(len(page)) - np.repeat(np.array(found.cells_end[:-1]), n_cells)).astype(np.int32)
        return pa.array(page), [pa.array(table_no), pa.array(cell_no), *found.cell_fields().values()]

    return read


def with_tables(pages: DataFrame, base: str = "url", output: str = "tables") -> DataFrame:
    """Add the tables of each page, in order, as array of (table_no, cells).

    Nested tables are listed as well, and all rows below a table belong to it. ``table_no`` counts the opening
    tags of the page. Cells beyond the widest row are dropped, and so is a table with a span that is not a
    number, or whose cells reach beyond 2^31 columns. End tags close what stands open inside
    their element; missing ones are made up by the end of an outer element or of the page. ``base``
    is where relative links start from. Without markup (NULL) there are no tables.
    """
    copies = pages.select("*", F.col("html").alias("_html"), column(base).alias("_base"))
    return fold(copies, _tables_reader, ("_html", "_base"), output, T.StructType.fromDDL(f"t {TABLES}")["t"].dataType)


def extract_tables(pages: DataFrame, base: str = "url") -> DataFrame:
    """page_id, table_no, cells: one row per table. See :func:`with_tables`."""
    found = fold(
        pages.select("page_id", "html", column(base).alias("_base")), _tables_reader, ("html", "_base"), "_tables",
        T.StructType.fromDDL(f"t {TABLES}")["t"].dataType,
    )
    return found.select("page_id", F.inline("_tables"))


def table_cells(pages: DataFrame) -> DataFrame:
    """page_id, table_no, cell_no and the cell's fields, one row per cell."""
    made = T.StructType.fromDDL(f"table_no int, cell_no int, {CELL[len('struct<') : -1]}")
    return unfold(pages.select("page_id", "html", F.col("url").alias("_base")), _cells_reader, ("html", "_base"), made)


def cell_links(cells: DataFrame) -> DataFrame:
    """One row per link of a cell: link_no, href, link_text."""
    return cells.select(
        "page_id", "table_no", "cell_no", "row", "col", F.posexplode("links").alias("link_no", "link")
    ).select(
        "page_id", "table_no", "cell_no", "row", "col", "link_no", "link.href", F.col("link.text").alias("link_text")
    )


def cell_images(cells: DataFrame) -> DataFrame:
    """One row per image of a cell: image_no, src."""
    return cells.select(
        "page_id", "table_no", "cell_no", "row", "col", F.posexplode("img_links").alias("image_no", "src")
    )

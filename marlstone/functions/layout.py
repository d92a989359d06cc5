"""Sizes of the panel that asks for a report's parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The padding above and below, a row's height, the search button's, and the least heights with and without it.
PADDING, ROW, SEARCH = 18, 24, 28
LEAST_WITH, LEAST_WITHOUT = 46, 34


def panel_rows(parameters: Column, columns: Column) -> Column:
    """Rows of so many input parameters in so many columns; NULL without a column."""
    return F.when((columns > 0) & parameters.isNotNull(), F.ceil(F.greatest(parameters, F.lit(0)) / columns)).cast("long")


def panel_height(parameters: Column, columns: Column, search: Column) -> Column:
    """Height of the compact panel in pixels; NULL where any of the three isn't known."""
    rows = panel_rows(parameters, columns)
    natural = PADDING + rows * ROW + F.when(search, SEARCH).otherwise(0)
    return F.when(search.isNotNull() & rows.isNotNull(), F.greatest(natural, F.when(search, LEAST_WITH).otherwise(LEAST_WITHOUT))).cast("long")

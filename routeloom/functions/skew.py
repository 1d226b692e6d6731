"""Joins to a table with one row per key, where a key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(rows: DataFrame, table: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` to ``table``, which has at most one row per key.

    The join keeps both sides' exchanges as the planner made them, so adaptive execution can
    broadcast a table that turns out small, and else cut the partition of a hot key (NULL too, in
    a left join) into pieces that each meet the key's one row.  ``how`` is "inner" or "left": for
    both the side that is cut is ``rows``.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"lookup_join cannot balance a {how} join")
    return rows.join(table, on, how)

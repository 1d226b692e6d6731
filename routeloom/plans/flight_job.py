"""From a flight file to the delay report."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

from routeloom.operators.routes import average_edges, vertex_index, vertices
from routeloom.plans.delay_report import DelayReport, delay_report
from routeloom.sources.flights import check_factor, read_flights
from routeloom.workspace import freeze


def choose_factor(factor: float | None, seed: int | None = None) -> float:
    """The given factor, or without one a random value in ]0, 1[, repeatable by its seed."""
    if factor is not None:
        return check_factor(factor)
    drawn = random.Random(seed).random()
    return drawn if drawn > 0.0 else 0.5


def analyse_flights(
    spark: SparkSession,
    path: str,
    factor: float | None = None,
    mode: str = "mst",
    source: int | None = None,
    distinct: bool = True,
    seed: int | None = None,
    strict: bool = True,
) -> tuple[DataFrame, DelayReport]:
    """Read flights and analyse their delays; returns the place dictionary and the report.

    ``source`` is a place id, the start of a shortest-path tree.  ``distinct``
    counts equal delays of a route once.  Any malformed field, and any blank
    line, fails the job; with ``strict=False`` only the three fields that the
    analysis uses are read and checked.
    """
    factor = choose_factor(factor, seed)
    flights = read_flights(spark, path, strict)
    routes = freeze(flights.select("origin_id", "destination_id", "departure_delay"), "routes")
    index = freeze(vertex_index(vertices(routes)), "index")
    return index, delay_report(average_edges(routes, distinct), factor, mode, source)

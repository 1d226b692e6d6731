"""The whole analysis: tree, bottleneck outside it, relief, new tree, difference."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeloom.operators.analysis import (
    bottleneck,
    complement_strength,
    scale_vertex,
    tree_complement,
    tree_diff,
    tree_weight,
)
from routeloom.operators.trees import (
    ShortestPaths,
    as_edges,
    minimum_spanning_forest,
    relieved_forest,
)
from routeloom.sources.flights import check_factor
from routeloom.workspace import freeze


@dataclass
class DelayReport:
    """Tables of one analysis; all are lazy views of stored results."""

    edges: DataFrame
    before: DataFrame
    complement: DataFrame
    strength: DataFrame
    worst: DataFrame
    scaled: DataFrame
    after: DataFrame
    diff: DataFrame

    def rows(self) -> DataFrame:
        """The report as one table ``(section, src, dst, value)``."""

        def section(name: str, df: DataFrame, value: str, src=None, dst=None) -> DataFrame:
            nothing = F.lit(None).cast("bigint")
            return df.select(
                F.lit(name).alias("section"),
                (nothing if src is None else F.col(src)).alias("src"),
                (nothing if dst is None else F.col(dst)).alias("dst"),
                F.col(value).alias("value"),
            )

        parts = [
            section("tree_before", as_edges(self.before), "weight", "src", "dst"),
            section("total_before", tree_weight(self.before), "total"),
            section("bottleneck", self.worst, "total", "vertex"),
            section("tree_after", as_edges(self.after), "weight", "src", "dst"),
            section("total_after", tree_weight(self.after), "total"),
        ]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out


def delay_report(
    edges: DataFrame, factor: float, mode: str = "mst", source: int | None = None
) -> DelayReport:
    """Analyse ``edges(src, dst, weight)``.

    ``mode`` chooses the tree: ``mst`` for a minimum spanning forest, ``spt``
    for the shortest-path tree from ``source``.  Where every edge is in the
    tree there is no bottleneck, and the graph stays as it is.  The tree after
    the relief is made from the one before it and the relieved edges.
    """
    check_factor(factor)
    if mode not in ("mst", "spt"):
        raise ValueError(f"mode must be 'mst' or 'spt', got {mode!r}")

    edges = freeze(edges, "edges")
    if mode == "mst":
        before = minimum_spanning_forest(edges)
    else:
        paths = ShortestPaths(edges, source)
        before = paths.tree()
    complement = tree_complement(edges, before)
    strength = complement_strength(complement)
    worst = freeze(bottleneck(strength), "worst")
    scaled = scale_vertex(edges, worst, factor)
    relieved = worst.first()
    if relieved is None:
        after = before
    elif mode == "mst":
        after = relieved_forest(before, edges, relieved["vertex"], factor)
    else:
        after = paths.relieved(relieved["vertex"], factor)
    if mode == "spt":
        paths.close()
    diff = tree_diff(before, after)
    return DelayReport(edges, before, complement, strength, worst, scaled, after, diff)

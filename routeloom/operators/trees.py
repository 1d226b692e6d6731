"""Shortest-path trees and minimum spanning forests over ``edges(src, dst, weight)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routeloom.functions.ordering import dense_index
from routeloom.operators.arcs import ArcTable
from routeloom.operators.contraction import contract
from routeloom.operators.routes import symmetric
from routeloom.sources.flights import check_factor
from routeloom.sources.formats import bucketed, drop_table
from routeloom.workspace import discard, freeze, freeze_counting, releasing

TREE_COLUMNS = "parent bigint, vertex bigint, edge_weight double, dist double"
PATH_COLUMNS = ("dist", "hops", "parent", "open", "weight")
EDGE_COLUMNS = "src bigint, dst bigint, weight double"

#: Tables of improved paths that are kept side by side.
LEVELS = 8

#: Times that improvements are sent on in one job.
HOPS = 4

#: Vertices whose distances are sent in one round; the others wait.
BAND_ROWS = 50_000_000

#: What the compatible output prints for the distance of a vertex it cannot reach.
UNREACHED = 1.7976931348623157e308


class ShortestPaths:
    """Best paths from one source over ``edges(src, dst, weight)``, and after cheaper edges.

    ``paths`` has ``(vertex, dist, hops, parent, weight)`` with the source's own row; ``source`` is
    the smallest vertex with an edge unless given (None without edges).  Edges and paths stay
    stored, so that :meth:`relieved` works on what changes only; use it in a ``with`` block, at
    whose end they are deleted.
    """

    def __init__(
        self, edges: DataFrame, source: int | None = None, vertices: DataFrame | None = None
    ):
        self.spark = edges.sparkSession
        self.source = source
        self.arcs: ArcTable | None = None
        self.reached: _Reached | None = None
        self.later: list[_Reached] = []
        edges = freeze(edges.select("src", "dst", "weight"), "edges")
        try:
            self._start(edges, vertices)
        except BaseException:
            self.close()
            raise
        finally:
            discard(edges)

    def _start(self, edges: DataFrame, vertices: DataFrame | None) -> None:
        facts = edges.agg(
            F.count("*").alias("n"),
            F.min("weight").alias("least"),
            F.min(F.least("src", "dst")).alias("first"),
        ).first()
        if facts["least"] is not None and facts["least"] < 0:
            raise ValueError("shortest_path_tree needs weights >= 0")
        if self.source is None:
            self.source = facts["first"]
        elif edges.where((F.col("src") == self.source) | (F.col("dst") == self.source)).isEmpty():
            if vertices is None or vertices.where(F.col("id") == self.source).isEmpty():
                raise ValueError(f"source {self.source} is no vertex of the graph")
        if self.source is not None and facts["n"]:
            self.arcs = ArcTable(symmetric(edges), 2 * facts["n"])
            self.reached = _Reached(self.spark, self.arcs.buckets)
            start = self.spark.range(1).selectExpr(
                f"CAST({self.source} AS BIGINT) AS vertex", "0D AS dist", "0 AS hops",
                "CAST(NULL AS BIGINT) AS parent", "true AS open", "CAST(NULL AS DOUBLE) AS weight",
            )
            _relax(self.arcs, self.reached, start)

    def __enter__(self) -> ShortestPaths:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        for reached in (*self.later, self.reached):
            if reached is not None:
                reached.drop()
        if self.arcs is not None:
            self.arcs.drop()

    @property
    def paths(self) -> DataFrame:
        return self.reached.best()

    def _tree(self, reached: _Reached | None) -> DataFrame:
        """``(parent, vertex, edge_weight, dist)``, stored."""
        if reached is None:
            return self.spark.createDataFrame([], TREE_COLUMNS)
        rows = reached.best().where(F.col("vertex") != self.source)
        return freeze(rows.selectExpr("parent", "vertex", "weight AS edge_weight", "dist"), "tree")

    def tree(self) -> DataFrame:
        return self._tree(self.reached)

    def relieved(self, vertex: int, factor: float) -> DataFrame:
        """The tree after the weights of all edges at ``vertex`` are multiplied by ``factor``.

        Weights only fall, so known paths stay valid bounds: the changed edges make the first
        offers, and only vertices with better paths go on.
        """
        check_factor(factor)
        if self.arcs is None:
            return self._tree(None)
        reached = _Reached(self.spark, self.arcs.buckets, self.reached)
        self.later.append(reached)
        at_vertex = (F.col("src") == vertex) | (F.col("dst") == vertex)
        cheaper = F.when(at_vertex, F.col("weight") * float(factor)).otherwise(F.col("weight"))
        changed = self.arcs.arcs.where(at_vertex).withColumn("weight", cheaper)
        ends = self.paths.selectExpr("vertex AS src", "dist", "hops")
        offers = _best_offers(_offers(ends.join(changed, "src")), self.arcs.buckets)
        _relax(self.arcs, reached, reached.without_worse(offers), cheaper)
        return self._tree(reached)


def shortest_path_tree(
    edges: DataFrame,
    source: int | None = None,
    vertices: DataFrame | None = None,
    keep_unreached: bool = False,
) -> DataFrame:
    """Shortest-path tree of one component as ``(parent, vertex, edge_weight, dist)``.

    The source is the smallest vertex with an edge unless given, and has no row
    of its own.  Among equal distances the path with fewer edges wins, then the
    smaller parent id.  ``keep_unreached`` adds the other vertices (of
    ``vertices``, or of the edges) with NULL parent and distance.  Negative
    weights raise: an undirected negative edge has no shortest path.  So does a
    given source that is no vertex.
    """
    with ShortestPaths(edges, source, vertices) as found:
        tree, source = found.tree(), found.source
    if keep_unreached:
        known = symmetric(edges).select(F.col("src").alias("vertex")).distinct()
        if vertices is not None:
            known = vertices.select(F.col("id").alias("vertex"))
        if source is not None:
            known = known.filter(F.col("vertex") != source)
        tree = known.join(tree, "vertex", "left").select(*tree.columns)
    return tree


class _Reached:
    """Paths found so far, the better ones of later rounds beside the earlier ones.

    Every round adds a table bucketed by vertex like the offers it is compared with, so only
    offers are shuffled.  When there are ``LEVELS`` tables, the last ones of like size are merged,
    and a row is rewritten logarithmically often at most.
    """

    def __init__(self, spark: SparkSession, buckets: int, before: _Reached | None = None):
        self.spark, self.buckets = spark, buckets
        self.levels: list[tuple[str, int]] = [] if before is None else list(before.levels)
        self.borrowed = {name for name, _ in self.levels}

    def add(self, rows: DataFrame) -> tuple[DataFrame, int]:
        """Store ``rows``, which are better than what is known; they and their number."""
        name = bucketed(rows, ["vertex"], self.buckets, ["vertex"])
        stored = self.spark.table(name)
        n = stored.count()
        self.levels.append((name, n))
        return stored, n

    def merge(self) -> None:
        """Merge the last levels if there are too many; their former rows must be read no more."""
        if len(self.levels) < LEVELS:
            return
        first = len(self.levels) - 2
        while first and self.levels[first - 1][1] <= 2 * sum(n for _, n in self.levels[first:]):
            first -= 1
        old = self.levels[first:]
        del self.levels[first:]
        self.add(reduce(_newest, [self.spark.table(name) for name, _ in old]))
        for name, _ in old:
            if name not in self.borrowed:
                drop_table(self.spark, name)

    def without_worse(self, offers: DataFrame) -> DataFrame:
        """Offers that beat every known path to their vertex; the union stays bucketed."""
        held = reduce(DataFrame.unionByName, [self.spark.table(name) for name, _ in self.levels])
        held = held.selectExpr(
            "vertex AS _vertex", "dist AS _dist", "hops AS _hops", "parent AS _parent",
            "weight AS _weight",
        )
        beaten = (
            "vertex = _vertex AND (_dist < dist OR _dist = dist AND (_hops < hops OR _hops = hops "
            "AND (_parent < parent OR _parent = parent AND _weight <= weight)))"
        )
        return offers.join(held, F.expr(beaten), "left_anti")

    def best(self) -> DataFrame:
        return reduce(_newest, [self.spark.table(name) for name, _ in self.levels]).drop("open")

    def drop(self) -> None:
        for name, _ in self.levels:
            if name not in self.borrowed:
                drop_table(self.spark, name)


def _newest(older: DataFrame, newer: DataFrame) -> DataFrame:
    """A path found in a later round is always the better one."""
    return newer.unionByName(older.join(newer.select("vertex"), "vertex", "left_anti"))


def _offers(sent: DataFrame) -> DataFrame:
    """Paths by way of ``src``, from its own path and each arc ``(dst, weight)``."""
    return sent.selectExpr(
        "dst AS vertex", "dist + weight AS dist", "hops + 1 AS hops", "src AS parent",
        "true AS open", "weight",
    )


def _best_offers(offers: DataFrame, buckets: int) -> DataFrame:
    """The best of all offers to a vertex; of equal paths one that needs not be sent again."""
    least = F.expr("min(struct(dist, hops, parent, weight, open)) AS best")
    best = offers.repartition(buckets, "vertex").groupBy("vertex").agg(least)
    return best.select("vertex", *[f"best.{c}" for c in PATH_COLUMNS])


def _relax(
    arcs: ArcTable, reached: _Reached, start: DataFrame, weight: Column | None = None
) -> None:
    """Send improved distances to neighbours until nothing improves; fills ``reached``.

    ``start`` are new paths, and ``weight`` is that of an arc if it is not its own.  A job sends
    ``HOPS`` times in a row, which saves rounds.  Of more than ``BAND_ROWS`` vertices that wait to
    be sent only the nearest go, a band of that many; most others will be reached by shorter
    paths before their turn.
    """
    waiting, n = reached.add(start)
    kept: DataFrame | None = None
    while n:
        near, far = waiting, None
        if n > BAND_ROWS:
            end = F.percentile_approx("dist", BAND_ROWS / n, 10_000)
            limit = F.col("dist") <= waiting.agg(end).first()[0]
            near, far = waiting.where(limit), waiting.where(~limit)
        improved = None
        for _ in range(HOPS):
            senders = near if improved is None else improved.where("open")
            sent = arcs.send(senders.selectExpr("vertex AS src", "dist", "hops"))
            offers = _offers(sent if weight is None else sent.withColumn("weight", weight))
            if improved is not None:
                offers = offers.unionByName(improved.withColumn("open", F.lit(False)))
            improved = reached.without_worse(_best_offers(offers, arcs.buckets))
        waiting, n = reached.add(improved)
        before, kept = kept, None
        if far is not None:
            waiting = _best_offers(far.unionByName(waiting), arcs.buckets)
        waiting = waiting.where("open")
        if far is not None or len(reached.levels) >= LEVELS:
            waiting, n = freeze_counting(waiting, "waiting")
            kept = waiting
        if before is not None:
            discard(before)
        reached.merge()
    if kept is not None:
        discard(kept)


@releasing("forest")
def minimum_spanning_forest(edges: DataFrame) -> DataFrame:
    """Minimum spanning forest of all components as ``edges(src, dst, weight)``.

    Equal weights are ordered by ``(src, dst)``, so the forest is unique.
    """
    ranked = freeze(dense_index(edges, ["weight", "src", "dst"], "rank"), "ranked")
    found = contract(ranked, ranked=True).picked()
    if found is None:
        return edges.sparkSession.createDataFrame([], EDGE_COLUMNS)
    return ranked.join(found, "rank").select("src", "dst", "weight")


@releasing("forest")
def relieved_forest(
    forest: DataFrame, edges: DataFrame, vertex: int, factor: float
) -> DataFrame:
    """The minimum spanning forest after the weights of all edges at ``vertex`` are scaled.

    An edge outside the forest is the largest of a cycle through the forest, and stays so unless
    it gets cheaper.  So the new forest lies in the old one and the changed edges, and only
    these are contracted.  Negative weights rise by the factor; if there are any at ``vertex``, all
    edges are.
    """
    check_factor(factor)
    star = freeze(edges.where((F.col("src") == vertex) | (F.col("dst") == vertex)), "star")
    rest = forest if star.where("weight < 0").isEmpty() else edges
    outside = rest.where((F.col("src") != vertex) & (F.col("dst") != vertex))
    cheaper = star.select("src", "dst", (F.col("weight") * float(factor)).alias("weight"))
    return minimum_spanning_forest(outside.select("src", "dst", "weight").unionByName(cheaper))


def as_edges(tree: DataFrame) -> DataFrame:
    """The edges of either kind of tree as ``edges(src, dst, weight)``."""
    if "parent" not in tree.columns:
        return tree.select("src", "dst", "weight")
    return tree.filter("parent IS NOT NULL").select(
        F.least("parent", "vertex").alias("src"),
        F.greatest("parent", "vertex").alias("dst"),
        F.col("edge_weight").alias("weight"),
    )


def reference_rows(tree: DataFrame, source: int | None) -> DataFrame:
    """Tree rows ``(from_index, index, distance)`` with the source's own row.

    ``tree`` comes from ``keep_unreached=True``; a vertex without a path shows
    -1 and the largest double.
    """
    rows = tree.select(
        F.coalesce("parent", F.lit(-1)).alias("from_index"),
        F.col("vertex").alias("index"),
        F.coalesce("dist", F.lit(UNREACHED)).alias("distance"),
    )
    if source is None:
        return rows
    own = tree.sparkSession.range(1).select(
        F.lit(source).cast("bigint").alias("from_index"),
        F.lit(source).cast("bigint").alias("index"),
        F.lit(0.0).alias("distance"),
    )
    return rows.unionByName(own)

"""Rounds of messages along arcs, sent only by vertices that have something new to say."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeloom.operators.arcs import ArcTable
from routeloom.operators.graph import RESET
from routeloom.sources.formats import bucketed, drop_table
from routeloom.workspace import freeze, freeze_counting, releasing


class Rounds:
    """Vertex rows that change by messages until no vertex is active.

    ``start`` has one row per ``vertex`` and the columns that ``update`` names.  In every round
    each vertex for which ``active`` holds sends ``message``, an expression of its columns and the
    arc's, along its arcs; ``merge`` aggregates the messages at their ends, and ``update`` maps each
    column to an expression of the vertex's columns, ``got`` (NULL where nothing came) and ``sent``
    (whether it was active).  No arc column may be named like a vertex column.

    Vertex rows are bucketed by vertex beside the arcs, so a round shuffles active vertices and
    merged messages only: messages are combined before they move, and idle vertices stay where
    they are.  ``senders`` counts the active vertices of each round.
    """

    def __init__(
        self, layout: ArcTable, message: str, merge: str, update: dict[str, str], active: str
    ):
        self.layout, self.message, self.merge = layout, message, merge
        self.update, self.active = update, f"coalesce({active}, false)"
        self.senders: list[int] = []

    def _store(self, rows: DataFrame) -> str:
        return bucketed(rows, ["vertex"], self.layout.buckets, ["vertex"])

    def run(self, start: DataFrame, rounds: int | None = None) -> DataFrame:
        """The rows after ``rounds`` rounds, or else once no vertex is active; stored."""
        spark = self.layout.spark
        columns = ["vertex", *self.update]
        name = self._store(start.select(*columns).repartition(self.layout.buckets, "vertex"))
        try:
            while rounds is None or len(self.senders) < rounds:
                state = spark.table(name)
                waiting = state.where(self.active)
                n = waiting.count()
                if not n:
                    break
                self.senders.append(n)
                sent = self.layout.send(waiting.withColumnRenamed("vertex", "src"))
                got = (
                    sent.selectExpr("dst AS vertex", f"{self.message} AS message")
                    .groupBy("vertex")
                    .agg(F.expr(f"{self.merge} AS got"))
                )
                changed = (
                    state.withColumn("sent", F.expr(self.active))
                    .join(got, "vertex", "left")
                    .selectExpr("vertex", *[f"{e} AS {c}" for c, e in self.update.items()])
                )
                later = self._store(changed)
                drop_table(spark, name)
                name = later
            return freeze(spark.table(name), "reached")
        finally:
            drop_table(spark, name)


@releasing("ranks")
def residual_ranks(
    arcs: DataFrame, tolerance: float = 1e-6, senders: list[int] | None = None
) -> DataFrame:
    """Page ranks of ``arcs(src, dst, n)`` as ``(vertex, rank)``, scaled to sum to their number.

    As ``graph.pagerank``, but what a vertex still owes its neighbours is kept with it, and only
    vertices that owe more than ``tolerance`` send.  What is below it waits until more has come,
    so no rank is lost: unsent debts of all vertices are at most ``tolerance`` times their number.
    ``senders``, if given, gets the number of senders of each round.
    """
    arcs, n_arcs = freeze_counting(arcs.select("src", "dst", "n"), "arcs")
    ends = arcs.selectExpr(
        "inline(array(struct(src AS vertex, n AS out), struct(dst AS vertex, 0L AS out)))"
    )
    totals = freeze(ends.groupBy("vertex").agg(F.expr("sum(out) AS total")), "totals")
    keep = 1 - RESET
    with ArcTable(arcs, n_arcs) as layout:
        # with all ranks at 1, the first debts are what one full round would change
        first = layout.send(totals.where("total > 0").selectExpr("vertex AS src", "total"))
        gets = first.groupBy(F.col("dst").alias("vertex")).agg(F.expr("sum(n / total) AS got"))
        start = totals.join(gets, "vertex", "left").selectExpr(
            "vertex", "total", "1D AS rank", f"{keep}D * coalesce(got, 0D) - {keep}D AS owed"
        )
        rounds = Rounds(
            layout,
            message=f"{keep}D * owed / total * n",
            merge="sum(message)",
            update={
                "total": "total",
                "rank": "if(sent, rank + owed, rank)",
                "owed": "if(sent, 0D, owed) + coalesce(got, 0D)",
            },
            active=f"abs(owed) > {tolerance!r}D",
        )
        ranks = rounds.run(start)
    if senders is not None:
        senders.extend(rounds.senders)
    scale = ranks.agg(F.expr("count(*) / sum(rank + owed) AS scale")).first()["scale"]
    return ranks.select("vertex", ((F.col("rank") + F.col("owed")) * F.lit(scale)).alias("rank"))


@releasing("distances")
def distances_from(arcs: DataFrame, sources: DataFrame) -> DataFrame:
    """Distance to the nearest of ``sources(id)`` over ``arcs(src, dst, weight)``.

    Returns ``(vertex, dist)`` for the vertices that a path leads to and for the sources that are
    in the graph.  Weights must be at least 0; only vertices that came nearer send.
    """
    arcs, n_arcs = freeze_counting(arcs.select("src", "dst", "weight"), "arcs")
    least = arcs.agg(F.min("weight")).first()[0]
    if least is not None and least < 0:
        raise ValueError("distances_from needs weights >= 0")
    ids = arcs.selectExpr("explode(array(src, dst)) AS vertex").distinct()
    marked = sources.select(F.col("id").alias("vertex"), F.lit(0.0).alias("dist")).distinct()
    start = ids.join(marked, "vertex", "left").selectExpr("vertex", "dist", "dist IS NOT NULL AS news")
    with ArcTable(arcs, n_arcs) as layout:
        rounds = Rounds(
            layout,
            message="dist + weight",
            merge="min(message)",
            update={
                "dist": "least(dist, got)",
                "news": "coalesce(got < dist, got IS NOT NULL)",
            },
            active="news",
        )
        return rounds.run(start).where("dist IS NOT NULL").select("vertex", "dist")


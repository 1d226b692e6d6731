"""Contract a graph by letting every component pick one neighbour per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeloom.functions.skew import lookup_join
from routeloom.workspace import discard, freeze, freeze_counting

#: Steps up the parents per job; one more than needed costs a join of a shrinking table.
CLIMBS = 3


class Contraction:
    """Result of :func:`contract`: what every round picked and where it led.

    ``picks`` has a table ``(rank)`` per round, the edges that joined two
    components; ``ends`` has ``(comp, root)``, the component each ended up in.
    """

    def __init__(self) -> None:
        self.picks: list[DataFrame] = []
        self.ends: list[DataFrame] = []

    def picked(self) -> DataFrame | None:
        """Ranks of the edges that joined two components, each once."""
        chosen = None
        for picks in self.picks:
            chosen = picks if chosen is None else chosen.unionByName(picks)
        return chosen

    def roots(self) -> DataFrame | None:
        """Final component of every vertex that has an edge, as ``(comp, root)``.

        Resolved from the last round back to the first: each round has at most
        half the components of the one before, so the work is a geometric sum.
        """
        final = None
        for ends in reversed(self.ends):
            if final is None:
                final = ends
                continue
            later = final.selectExpr("comp AS root", "root AS last")
            joined = lookup_join(ends, later, "root", "left")
            final = freeze(joined.selectExpr("comp", "coalesce(last, root) AS root"), "roots")
        return final


def contract(edges: DataFrame, ranked: bool) -> Contraction:
    """Join components until no edge connects two of them.

    ``edges`` has ``src`` and ``dst``, and if ``ranked`` a number ``rank`` that
    is unique per edge.  Each round every component picks its edge of least rank
    (else its least neighbour), so their number at least halves and O(log V)
    rounds suffice.  With ranks this selects a minimum spanning forest.  Either
    way the picks can only form cycles of two, which are cut at the smaller
    component.  All minima are of single numbers, so they need no sort, and of
    parallel edges only the least goes on to the next round.
    """
    rank = ["rank"] if ranked else []
    live, n_live = freeze_counting(
        _least_per_pair(edges.selectExpr("src AS a", "dst AS b", *rank), ranked), "live"
    )
    done = Contraction()
    while n_live:
        hooks = freeze(_ranked_hooks(live) if ranked else _hooks(live), "hooks")
        roots = _jump_to_roots(hooks.select("comp", "parent"))
        if ranked:
            done.picks.append(hooks.where("comp <> parent").select("rank"))
        done.ends.append(roots)
        before = live
        live, n_live = _relabel(live, roots, ranked)
        discard(before)
    return done


def _least_per_pair(edges: DataFrame, ranked: bool) -> DataFrame:
    """One edge per pair of different ends, the smaller end first."""
    pairs = edges.where("a <> b").selectExpr(
        "least(a, b) AS a", "greatest(a, b) AS b", *(["rank"] if ranked else [])
    )
    return pairs.groupBy("a", "b").agg(F.min("rank").alias("rank")) if ranked else pairs.distinct()


#: Hooks of a pair of components that both picked their common edge, and of a one-sided pick.
_HOOKS = """inline(CASE
    WHEN n = 2
    THEN array(struct(b AS comp, a AS parent), struct(a AS comp, a AS parent))
    ELSE array(struct(owner AS comp, if(owner = a, b, a) AS parent)) END)"""


def _ranked_hooks(live: DataFrame) -> DataFrame:
    """One row per component: the neighbour it joins and the rank of the edge it uses."""
    ends = "inline(array(struct(a AS comp), struct(b AS comp)))"
    best = live.selectExpr("rank", ends).groupBy("comp").agg(F.expr("min(rank) AS rank"))
    # Two components that pick each other have picked the same edge.
    picked = best.groupBy("rank").agg(F.expr("count(*) AS n"), F.expr("min(comp) AS owner"))
    return picked.join(live, "rank").selectExpr("rank", _HOOKS)


def _hooks(live: DataFrame) -> DataFrame:
    """One row per component: the least neighbour, which it joins."""
    ends = "inline(array(struct(a AS comp, b AS other), struct(b AS comp, a AS other)))"
    best = live.selectExpr(ends).groupBy("comp").agg(F.expr("min(other) AS other"))
    # Two components that pick each other meet in one group of this aggregate.
    pairs = best.groupBy(
        F.expr("least(comp, other) AS a"), F.expr("greatest(comp, other) AS b")
    ).agg(F.expr("count(*) AS n"), F.expr("min(comp) AS owner"))
    return pairs.selectExpr(_HOOKS)


def _jump_to_roots(hooks: DataFrame) -> DataFrame:
    """Follow parents to the root by pointer jumping; ``(comp, root)``."""
    rows = hooks
    while True:
        above = rows.selectExpr("comp AS parent", "parent AS grand")
        step = rows
        for _ in range(CLIMBS):
            step = lookup_join(step, above, "parent").selectExpr(
                "comp", "parent AS below", "grand AS parent"
            )
        step = freeze(step, "jump")
        rows = step.select("comp", "parent")
        if step.where("parent <> below").isEmpty():
            return rows.withColumnRenamed("parent", "root")


def _relabel(live: DataFrame, roots: DataFrame, ranked: bool) -> tuple[DataFrame, int]:
    """Replace components by their roots and drop edges inside one component."""
    for end in ("a", "b"):
        names = roots.selectExpr(f"comp AS {end}", "root AS _root")
        live = lookup_join(live, names, end).drop(end).withColumnRenamed("_root", end)
    return freeze_counting(_least_per_pair(live, ranked), "live")

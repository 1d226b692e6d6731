"""SQL for checking the graph operators on another engine.

Trees are found by other means than the operators use: an edge is in the
minimum spanning forest when no path between its ends avoids all edges of its
rank or higher (a minimax closure), and shortest paths are unrolled rounds.
"""

from __future__ import annotations

from routeloom.sources.tables import DAY_IDS

FACTOR = 0.43

NATION_ROUTES = """
routes AS MATERIALIZED (
    SELECT CAST(s_nationkey AS BIGINT) AS origin_id, CAST(c_nationkey AS BIGINT) AS destination_id,
           l_quantity AS departure_delay
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)"""

LEAD_TIME_ROUTES = """
routes AS MATERIALIZED (
    SELECT CAST(s_nationkey AS BIGINT) AS origin_id, CAST(c_nationkey AS BIGINT) AS destination_id,
           CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS DOUBLE)
               AS departure_delay
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)"""

USER_ROUTES = """
routes AS MATERIALIZED (
    SELECT * FROM (
        SELECT user_id AS origin_id,
               lead(user_id) OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id)
                   AS destination_id,
               round(value * 100) AS departure_delay
        FROM events)
    WHERE destination_id IS NOT NULL)"""

EDGES = """
edges AS MATERIALIZED (
    SELECT src, dst, sum(delay) / count(*) AS weight
    FROM (SELECT DISTINCT least(origin_id, destination_id) AS src,
                 greatest(origin_id, destination_id) AS dst, departure_delay AS delay
          FROM routes WHERE origin_id <> destination_id)
    GROUP BY src, dst)"""

ALL_EDGES = EDGES.replace("SELECT DISTINCT least", "SELECT least")

DAILY_ROUTES = f"""
routes AS MATERIALIZED (
    SELECT day * {DAY_IDS} + origin AS origin_id, day * {DAY_IDS} + destination AS destination_id,
           departure_delay
    FROM (
        SELECT date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day, user_id AS origin,
               lead(user_id) OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id)
                   AS destination,
               round(value * 100) AS departure_delay
        FROM events)
    WHERE destination IS NOT NULL)"""

VERTICES = """
ids AS MATERIALIZED (
    SELECT origin_id AS id FROM routes UNION SELECT destination_id FROM routes)"""


SUPPLIER_PART_ROUTES = """
routes AS MATERIALIZED (
    SELECT l_suppkey * 2 AS origin_id, l_partkey * 2 + 1 AS destination_id,
           l_quantity AS departure_delay
    FROM lineitem)"""


def components(rounds: int) -> str:
    """CTEs that end in ``c{rounds}(id, component)``, after so many rounds of least labels."""
    steps = [
        """
links AS MATERIALIZED (
    SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges
    UNION SELECT id, id FROM ids),
c0 AS MATERIALIZED (SELECT id, id AS component FROM ids)"""
    ]
    for k in range(rounds):
        steps.append(
            f"""
c{k + 1} AS MATERIALIZED (
    SELECT l.a AS id, min(c.component) AS component
    FROM links l JOIN c{k} c ON c.id = l.b GROUP BY l.a)"""
        )
    return ",".join(steps)


def spanning(edges: str, name: str, rounds: int) -> str:
    """CTEs that end in ``{name}(src, dst, weight)``, the forest of ``edges``."""
    steps = [
        f"""
{name}_ranked AS MATERIALIZED (
    SELECT src, dst, weight, row_number() OVER (ORDER BY weight, src, dst) AS rk FROM {edges})""",
        f"""
{name}_m0 AS MATERIALIZED (
    SELECT src AS a, dst AS b, rk FROM {name}_ranked
    UNION ALL SELECT dst, src, rk FROM {name}_ranked
    UNION ALL SELECT src, src, 0 FROM {name}_ranked
    UNION ALL SELECT dst, dst, 0 FROM {name}_ranked)""",
    ]
    for k in range(rounds):
        steps.append(
            f"""
{name}_m{k + 1} AS MATERIALIZED (
    SELECT x.a, y.b, min(greatest(x.rk, y.rk)) AS rk
    FROM (SELECT DISTINCT * FROM {name}_m{k}) x JOIN (SELECT DISTINCT * FROM {name}_m{k}) y
      ON x.b = y.a GROUP BY x.a, y.b)"""
        )
    steps.append(
        f"""
{name} AS MATERIALIZED (
    SELECT r.src, r.dst, r.weight FROM {name}_ranked r
    JOIN {name}_m{rounds} m ON r.src = m.a AND r.dst = m.b AND r.rk = m.rk)"""
    )
    return ",".join(steps)


def shortest(edges: str, name: str, rounds: int) -> str:
    """CTEs that end in ``{name}(parent, vertex, edge_weight, dist)`` from the smallest vertex."""
    steps = [
        f"""
{name}_arcs AS MATERIALIZED (
    SELECT src, dst, weight FROM {edges} UNION ALL SELECT dst, src, weight FROM {edges})""",
        f"""
{name}_s0 AS MATERIALIZED (
    SELECT min(src) AS vertex, CAST(0 AS DOUBLE) AS dist, 0 AS hops,
           CAST(NULL AS BIGINT) AS parent, CAST(NULL AS DOUBLE) AS edge_weight
    FROM {name}_arcs)""",
    ]
    for k in range(rounds):
        steps.append(
            f"""
{name}_s{k + 1} AS MATERIALIZED (
    SELECT * FROM (
        SELECT * FROM {name}_s{k}
        UNION ALL
        SELECT a.dst, s.dist + a.weight, s.hops + 1, s.vertex, a.weight
        FROM {name}_s{k} s JOIN {name}_arcs a ON a.src = s.vertex)
    QUALIFY row_number() OVER (PARTITION BY vertex ORDER BY dist, hops, parent) = 1)"""
        )
    steps.append(
        f"""
{name}_all AS MATERIALIZED (SELECT * FROM {name}_s{rounds}),
{name} AS MATERIALIZED (
    SELECT parent, vertex, edge_weight, dist FROM {name}_all WHERE parent IS NOT NULL),
{name}_edges AS MATERIALIZED (
    SELECT least(parent, vertex) AS src, greatest(parent, vertex) AS dst, edge_weight AS weight
    FROM {name})"""
    )
    return ",".join(steps)


def relief(tree: str) -> str:
    """CTEs from a tree's edge table to ``scaled(src, dst, weight)``."""
    return f"""
complement AS MATERIALIZED (
    SELECT e.* FROM edges e
    WHERE NOT EXISTS (SELECT 1 FROM {tree} t WHERE t.src = e.src AND t.dst = e.dst)),
strength AS MATERIALIZED (
    SELECT vertex, sum(weight) AS total
    FROM (SELECT src AS vertex, weight FROM complement
          UNION ALL SELECT dst, weight FROM complement)
    GROUP BY vertex),
worst AS MATERIALIZED (SELECT * FROM strength ORDER BY total DESC, vertex LIMIT 1),
scaled AS MATERIALIZED (
    SELECT src, dst,
           CASE WHEN src IN (SELECT vertex FROM worst) OR dst IN (SELECT vertex FROM worst)
                THEN weight * CAST({FACTOR} AS DOUBLE) ELSE weight END AS weight
    FROM edges)"""


DIFF = """
    SELECT coalesce(b.src, a.src) AS src, coalesce(b.dst, a.dst) AS dst,
           CASE WHEN b.src IS NULL THEN 'added' WHEN a.src IS NULL THEN 'removed'
                WHEN b.weight = a.weight THEN 'kept' ELSE 'reweighted' END AS status,
           b.weight AS weight_before, a.weight AS weight_after
    FROM {before} b FULL OUTER JOIN {after} a ON a.src = b.src AND a.dst = b.dst"""


def query(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


def page_ranks(arcs: str, rounds: int) -> str:
    """CTEs ``pr0..pr{rounds}`` of ranks before normalisation, over ``arcs(src, dst, n)``."""
    steps = [
        f"""
places AS MATERIALIZED (SELECT src AS vertex FROM {arcs} UNION SELECT dst FROM {arcs}),
outs AS MATERIALIZED (SELECT src, sum(n) AS total FROM {arcs} GROUP BY src),
pr0 AS MATERIALIZED (SELECT vertex, CAST(1 AS DOUBLE) AS rank FROM places)"""
    ]
    for k in range(rounds):
        steps.append(
            f"""
pr{k + 1} AS MATERIALIZED (
    SELECT p.vertex, 0.15 + 0.85 * coalesce(m.got, 0) AS rank
    FROM places p LEFT JOIN (
        SELECT a.dst, sum(r.rank / o.total * a.n) AS got
        FROM {arcs} a JOIN pr{k} r ON r.vertex = a.src JOIN outs o ON o.src = a.src
        GROUP BY a.dst) m ON m.dst = p.vertex)"""
        )
    return ",".join(steps)


def distances(rounds: int, sources: str) -> str:
    """CTEs that end in ``near{rounds}(vertex, dist)``, after so many rounds over ``edges``."""
    steps = [
        f"""
either AS MATERIALIZED (
    SELECT src, dst, weight FROM edges UNION ALL SELECT dst, src, weight FROM edges),
near0 AS MATERIALIZED (
    SELECT DISTINCT src AS vertex, CAST(0 AS DOUBLE) AS dist FROM either WHERE src IN ({sources}))"""
    ]
    for k in range(rounds):
        steps.append(
            f"""
near{k + 1} AS MATERIALIZED (
    SELECT vertex, min(dist) AS dist FROM (
        SELECT * FROM near{k} UNION ALL
        SELECT b.dst, r.dist + b.weight FROM near{k} r JOIN either b ON b.src = r.vertex)
    GROUP BY vertex)"""
        )
    return ",".join(steps)


def page_ranks_until(arcs: str, rounds: int, tolerance: float) -> str:
    """As :func:`page_ranks`, ending in ``ranks``: the first round that moves no rank by more."""
    moved = " UNION ALL ".join(
        f"SELECT {k} AS k, max(abs(x.rank - y.rank)) AS moved"
        f" FROM pr{k} x JOIN pr{k - 1} y ON x.vertex = y.vertex"
        for k in range(1, rounds + 1)
    )
    every = " UNION ALL ".join(f"SELECT {k} AS k, * FROM pr{k}" for k in range(1, rounds + 1))
    return f"""{page_ranks(arcs, rounds)},
stops AS (SELECT min(k) AS k FROM ({moved}) WHERE moved <= {tolerance}),
ranks AS MATERIALIZED (
    SELECT vertex, rank FROM ({every}) WHERE k = (SELECT k FROM stops))"""

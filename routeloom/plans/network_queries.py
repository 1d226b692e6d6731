"""Registered queries of the general graph operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from routeloom.operators import graph, messages, routes
from routeloom.operators.blocks import BlockMatrix
from routeloom.plans import graph_sql as sql
from routeloom.plans.graph_queries import user_edges
from routeloom.sources.edge_list import read_edge_list, write_lines
from routeloom.sources.tables import DAY_IDS, daily_hops, table, user_hops
from routeloom.workspace import freeze, new_path

ROUNDS = 10
TOLERANCE = 0.001
SMALL = 1e-10


def _rounded(ranks):
    return ranks.withColumn("rank", F.round("rank", 6))


def pagerank(spark, folder):
    arcs = graph.count_arcs(user_hops(spark, folder))
    return _rounded(graph.pagerank(arcs, rounds=ROUNDS))


def pagerank_converged(spark, folder):
    arcs = graph.count_arcs(user_hops(spark, folder))
    return _rounded(graph.pagerank(arcs, tolerance=TOLERANCE))


def residual_ranks(spark, folder):
    arcs = graph.count_arcs(user_hops(spark, folder))
    return _rounded(messages.residual_ranks(arcs, tolerance=SMALL))


def distances_from(spark, folder):
    """Distance of every user to the nearest of those that the first region's nations are."""
    arcs = routes.symmetric(user_edges(spark, folder))
    nations = table(spark, folder, "nation").where("n_regionkey = 0")
    return messages.distances_from(arcs, nations.selectExpr("CAST(n_nationkey AS BIGINT) AS id"))


def _hop_matrix(spark, folder):
    arcs = graph.count_arcs(user_hops(spark, folder))
    return BlockMatrix.from_entries(arcs.selectExpr("src AS row", "dst AS col", "n AS value"))


def matrix_square(spark, folder):
    """Number of ways from user to user in two hops."""
    hops = _hop_matrix(spark, folder)
    return hops.multiply(hops).entries()


def matrix_sum(spark, folder):
    """Hops between two users in either direction."""
    hops = _hop_matrix(spark, folder)
    return hops.add(hops.transpose()).entries()


def matrix_gram(spark, folder):
    """Inner products of the suppliers' columns of parts by their line items."""
    line = table(spark, folder, "lineitem").selectExpr(
        "l_partkey AS row", "l_suppkey AS col", "1 AS value"
    )
    parts = BlockMatrix.from_entries(line)
    return parts.transpose().multiply(parts).entries()


def edge_list_arcs(spark, folder):
    """Hops written as an edge list and read back."""
    path = new_path(spark, "edge-list")
    write_lines(user_hops(spark, folder).select("origin_id", "destination_id"), path, " ")
    read = read_edge_list(spark, path)
    return read.groupBy("src", "dst").agg(F.count("*").alias("n"))


def saved_ranks(spark, folder):
    """Ranks saved as lines of text and read back."""
    path = new_path(spark, "ranks")
    write_lines(pagerank(spark, folder), path)
    return spark.read.csv(path, sep="\t", schema="vertex bigint, rank double")


def connected_components(spark, folder):
    hops = freeze(daily_hops(spark, folder), "routes")
    edges = routes.average_edges(hops)
    return graph.connected_components(routes.vertices(hops), edges)


def component_names(spark, folder):
    people = table(spark, folder, "customer").selectExpr("c_custkey AS user", "c_name AS name")
    found = connected_components(spark, folder).withColumn("user", F.col("id") % DAY_IDS)
    return found.join(people, "user").select("name", "component")


def triangle_total(spark, folder):
    per_vertex = graph.triangle_count(user_edges(spark, folder))
    return per_vertex.agg(F.expr("CAST(coalesce(sum(triangles), 0) / 3 AS BIGINT) AS triangles"))


def neighbor_mean(spark, folder):
    hops = user_hops(spark, folder)
    values = (
        table(spark, folder, "events")
        .groupBy(F.col("user_id").alias("vertex"))
        .agg(F.expr("CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) AS value"))
    )
    return graph.neighbor_mean(graph.count_arcs(hops), values)


def subgraph_top5(spark, folder):
    hops = freeze(user_hops(spark, folder), "routes")
    people = table(spark, folder, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "if(c_acctbal > 0, c_mktsegment, null) AS segment"
    )
    users = graph.with_attributes(routes.vertices(hops), people, ["name", "segment"])
    top = graph.top_ranked(
        graph.count_arcs(hops), freeze(users, "users"), 5, tolerance=TOLERANCE
    )
    return _rounded(top).withColumn("attrs", F.concat_ws("|", "attrs"))


QUERIES = {
    "pagerank": pagerank,
    "pagerank_converged": pagerank_converged,
    "pagerank_residual": residual_ranks,
    "distances_from": distances_from,
    "matrix_square": matrix_square,
    "matrix_sum": matrix_sum,
    "matrix_gram": matrix_gram,
    "edge_list_arcs": edge_list_arcs,
    "saved_ranks": saved_ranks,
    "connected_components": connected_components,
    "component_names": component_names,
    "triangle_count": lambda s, d: graph.triangle_count(user_edges(s, d)),
    "triangle_total": triangle_total,
    "neighbor_mean": neighbor_mean,
    "subgraph_top5": subgraph_top5,
}

_ARCS = (
    sql.USER_ROUTES,
    """
arcs AS MATERIALIZED (
    SELECT origin_id AS src, destination_id AS dst, count(*) AS n FROM routes GROUP BY ALL)""",
)


_COMPONENTS = (sql.DAILY_ROUTES, sql.VERTICES, sql.EDGES, sql.components(24))

_TRIANGLES = """
tri AS MATERIALIZED (
    SELECT x.src AS a, x.dst AS b, y.dst AS c
    FROM edges x JOIN edges y ON y.src = x.dst JOIN edges z ON z.src = x.src AND z.dst = y.dst),
corners AS (SELECT a AS vertex FROM tri UNION ALL SELECT b FROM tri UNION ALL SELECT c FROM tri)"""

_PER_VERTEX = "SELECT vertex, count(*) AS triangles FROM corners GROUP BY vertex"

_NORMAL = """
    SELECT vertex, round(rank * (SELECT count(*) / sum(rank) FROM {t}), 6) AS rank FROM {t}"""

SQL = {
    "pagerank": sql.query(
        *_ARCS, sql.page_ranks("arcs", ROUNDS), select=_NORMAL.format(t=f"pr{ROUNDS}")
    ),
    "pagerank_converged": sql.query(
        *_ARCS,
        sql.page_ranks_until("arcs", 20, TOLERANCE),
        select=_NORMAL.format(t="ranks"),
    ),
    "pagerank_residual": sql.query(
        *_ARCS, sql.page_ranks("arcs", 40), select=_NORMAL.format(t="pr40")
    ),
    "distances_from": sql.query(
        sql.USER_ROUTES,
        sql.EDGES,
        sql.distances(10, "SELECT n_nationkey FROM nation WHERE n_regionkey = 0"),
        select="SELECT vertex, dist FROM near10",
    ),
    "matrix_square": sql.query(
        *_ARCS,
        select="""
        SELECT x.src AS row, y.dst AS col, CAST(sum(x.n * y.n) AS DOUBLE) AS value
        FROM arcs x JOIN arcs y ON y.src = x.dst GROUP BY ALL""",
    ),
    "matrix_sum": sql.query(
        *_ARCS,
        select="""
        SELECT row, col, CAST(sum(n) AS DOUBLE) AS value
        FROM (SELECT src AS row, dst AS col, n FROM arcs UNION ALL SELECT dst, src, n FROM arcs)
        GROUP BY ALL""",
    ),
    "matrix_gram": """
        WITH cells AS (
            SELECT l_partkey AS part, l_suppkey AS supp, count(*) AS n FROM lineitem GROUP BY ALL)
        SELECT x.supp AS row, y.supp AS col, CAST(sum(x.n * y.n) AS DOUBLE) AS value
        FROM cells x JOIN cells y USING (part) GROUP BY ALL""",
    "edge_list_arcs": sql.query(*_ARCS, select="SELECT * FROM arcs"),
    "saved_ranks": sql.query(
        *_ARCS, sql.page_ranks("arcs", ROUNDS), select=_NORMAL.format(t=f"pr{ROUNDS}")
    ),
    "connected_components": sql.query(*_COMPONENTS, select="SELECT id, component FROM c24"),
    "component_names": sql.query(
        *_COMPONENTS,
        select="SELECT c_name AS name, component FROM c24"
        f" JOIN customer ON c_custkey = id % {DAY_IDS}",
    ),
    "triangle_count": sql.query(sql.USER_ROUTES, sql.EDGES, _TRIANGLES, select=_PER_VERTEX),
    "triangle_total": sql.query(
        sql.USER_ROUTES,
        sql.EDGES,
        _TRIANGLES,
        select="SELECT count(*) AS triangles FROM tri",
    ),
    "neighbor_mean": sql.query(
        *_ARCS,
        """
worth AS MATERIALIZED (
    SELECT user_id AS vertex, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) AS value
    FROM events GROUP BY user_id)""",
        select="""
        SELECT a.dst AS vertex, sum(s.value * a.n) / sum(a.n) AS mean
        FROM arcs a JOIN worth s ON s.vertex = a.src JOIN worth d ON d.vertex = a.dst
        WHERE s.value > d.value GROUP BY a.dst""",
    ),
    "subgraph_top5": sql.query(
        *_ARCS,
        sql.VERTICES,
        """
kept AS MATERIALIZED (
    SELECT id, c_name || '|' || c_mktsegment AS attrs
    FROM ids JOIN customer ON c_custkey = id
    WHERE c_acctbal > 0 AND c_mktsegment IS NOT NULL AND c_name IS NOT NULL),
inner_arcs AS MATERIALIZED (
    SELECT * FROM arcs WHERE src IN (SELECT id FROM kept) AND dst IN (SELECT id FROM kept))""",
        sql.page_ranks_until("inner_arcs", 20, TOLERANCE),
        select=f"""
        SELECT id, attrs, coalesce(r.rank, 0) AS rank
        FROM kept LEFT JOIN ({_NORMAL.format(t="ranks")}) r ON r.vertex = id
        ORDER BY rank DESC, id LIMIT 5""",
    ),
}
